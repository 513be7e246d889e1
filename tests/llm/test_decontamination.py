import random
import re
from collections import Counter

import numpy as np

from ruleweave.llm import decontamination as D


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingles(w, k=5):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)]


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        for item_id, item in items:
            v = words_of(item)
            if not v or len(v) > len(w):
                continue
            k = min(5, len(v))
            goal, best = Counter(shingles(v)), 0
            for a in range(len(w) - len(v) + 1):
                here = Counter(shingles(w[a:a + len(v)], k))
                both = sum((here & goal).values())
                best = max(best, both / (sum(here.values()) + sum(goal.values()) - both))
            if best >= 0.8:
                out.append((str(doc_id), item_id, round(best, 9)))
    return sorted(out)


def corpus():
    rnd = random.Random(13)
    text = lambda n: [rnd.choice("abcdefghij") + rnd.choice("klmnopÉ日") for _ in range(n)]
    items = [(i, " ".join(text(rnd.choice([8, 20, 40, 59])))) for i in range(12)]
    items += [(20, "Three Little words"), (21, None), (22, ""), (23, "!!"), (24, items[0][1]), (25, "same " * 30)]
    rows = [(0, None), (1, ""), (2, "three, little; WORDS here"), (3, "three little"), (None, items[1][1]),
            (4, "same " * 300), (5, "...")]
    for i in range(10, 50):
        parts = text(rnd.randrange(80))
        for _ in range(rnd.randrange(3)):
            passage = rnd.choice(items[:12])[1].split(" ")
            if rnd.random() < 0.6 and len(passage) > 30:
                passage[rnd.choice([0, 1, len(passage) - 1, len(passage) // 2])] = "edited"
            parts += [*passage, *text(rnd.randrange(40))]
        rows.append((i, rnd.choice([" ", "\n", ", "]).join(parts).upper() if i % 2 else " ".join(parts)))
    rows += [(10, rows[8][1]), (10, rows[9][1]), (60, " ".join(text(40_000)) + " " + items[3][1])]
    return rows, items


def frames(spark, frame, rows, items):
    return frame(rows), spark.createDataFrame(items, "item_id bigint, text string")


def test_matches_brute_force(spark, frame):
    rows, items = corpus()
    rows = [r for r in rows if r[0] != 60]
    got = D.find_contamination(*frames(spark, frame, rows, items)).collect()
    assert sorted((str(r.doc_id), r.item_id, round(r.similarity, 9)) for r in got) == brute(rows, items)


def test_very_long_text_and_ranges(spark, frame, monkeypatch):
    rows, items = corpus()
    long = [r for r in rows if r[0] == 60]
    monkeypatch.setattr(D, "_WINDOWS_AT_ONCE", 3)
    got = D.find_contamination(*frames(spark, frame, long, items)).collect()
    assert [(r.item_id, r.start_word, r.similarity) for r in got] == [(3, 40_000, 1.0)]


def test_blocks_of_items_change_nothing(spark, frame, monkeypatch):
    rows, items = corpus()
    rows = [r for r in rows if r[0] != 60]
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    got = D.find_contamination(*frames(spark, frame, rows, items)).collect()
    assert sorted((str(r.doc_id), r.item_id, round(r.similarity, 9)) for r in got) == brute(rows, items)


def test_clean_rows_stay(spark, frame):
    rows, items = corpus()
    docs, bench = frames(spark, frame, rows, items)
    kept = D.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    found = {d for d, _, _ in brute([r for r in rows if r[0] not in (10, 60)], items)}
    expected = [str(i) for i, _ in rows if str(i) not in found and i not in (10, 60)]
    expected += ["10" for i, t in rows if i == 10 and not brute([(i, t)], items)]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(expected)


def test_empty_tables(spark, frame):
    rows, items = corpus()
    assert D.find_contamination(*frames(spark, frame, [], items)).collect() == []
    docs, bench = frames(spark, frame, rows, [])
    assert D.find_contamination(docs, bench).collect() == []
    assert D.remove_contaminated(docs, bench).count() == len(rows)


def test_case_and_punctuation_do_not_hide_a_passage(spark, frame):
    item = "la réunion était à l'heure près du château où l'été finit"
    rows = [(1, "x " + item.upper() + " y"), (2, "!! ".join(item.split(" "))), (3, item.replace("é", "e"))]
    got = D.find_contamination(*frames(spark, frame, rows, [(7, item)])).collect()
    assert sorted((r.doc_id, r.similarity) for r in got) == [(1, 1.0), (2, 1.0)]


def test_blocks_hold_every_fingerprint_within_the_radius():
    rnd = random.Random(1)
    items = [(i, " ".join(f"w{rnd.randrange(1000)}" for _ in range(20))) for i in range(40)]
    index = D.ItemIndex(items, 5, D.RADIUS)
    own = index.by_length[20]["fps"]
    probes = []
    for fp in own.tolist():
        for n in (0, 1, 7, 15, D.RADIUS, D.RADIUS + 1):
            for b in rnd.sample(range(64), n):
                fp ^= 1 << b
            probes.append(fp)
    probes = np.array(probes, np.uint64)
    got = set(zip(*(x.tolist() for x in index.candidates(probes, 20))))
    assert got == {(i, j) for i, p in enumerate(probes.tolist()) for j, q in enumerate(own.tolist())
                   if (p ^ q).bit_count() <= D.RADIUS}


def test_documents_shorter_than_the_item(spark, frame):
    """A clipped item is the whole document: one window, compared like any other."""
    rnd = random.Random(5)
    items = [(i, " ".join(f"w{rnd.randrange(500)}" for _ in range(n))) for i, n in enumerate([4, 6, 9, 10, 15, 40, 59])]
    items += [(7, "same " * 30), (8, " ".join(items[5][1].split(" ")[:36]) + " other")]
    rows = []
    for _, item in items:
        w = item.split()
        for cut in range(len(w)):
            rows += [(len(rows), " ".join(w[cut:])), (len(rows) + 1, " ".join(w[:len(w) - cut]))]
            if len(w) - cut > 4:
                rows.append((len(rows), " ".join([*w[:2], "edited", *w[3:len(w) - cut]])))
    expected = []
    for doc_id, text in rows:
        w = words_of(text)
        for item_id, item in items:
            v = words_of(item)
            k, n = min(5, len(v)), min(len(v), len(w))
            goal, best = Counter(shingles(v)), 0
            for a in range(len(w) - n + 1):
                here = Counter(shingles(w[a:a + n], k))
                both = sum((here & goal).values())
                best = max(best, both / (sum(here.values()) + sum(goal.values()) - both))
            if best >= 0.8:
                expected.append((str(doc_id), item_id, n, round(best, 9)))
    docs, bench = frames(spark, frame, rows, items)
    got = [(str(r.doc_id), r.item_id, r.n_words, round(r.similarity, 9)) for r in D.find_contamination(docs, bench).collect()]
    assert sorted(got) == sorted(expected)
    clipped = [(str(i), 5) for i, t in rows if t == " ".join(items[5][1].split(" ")[:38])]
    assert clipped and set(clipped) <= {(d, i) for d, i, _, _ in got}
    found = {d for d, *_ in expected}
    assert sorted(r.doc_id for r in D.remove_contaminated(docs, bench).collect()) == [i for i, _ in rows if str(i) not in found]
