import random
import re

from ruleweave.llm import substring_dedup as D


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for a in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[a:a + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        stay = [True] * len(w)
        for a in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[a:a + window])] < i:
                stay[a:a + window] = [False] * window
        out.append((str(i), len(w), len(w) - sum(stay), " ".join(x for x, s in zip(w, stay) if s)))
    return sorted(out)


def corpus():
    rnd = random.Random(7)
    text = lambda n: [rnd.choice("abcdefgh") + rnd.choice("xyzÉ日") for _ in range(n)]
    shared = [text(70) for _ in range(3)]
    rows = [(0, None), (1, ""), (2, "\n \t"), (None, " ".join(shared[0])), (None, " ".join(shared[0]))]
    for i in range(3, 60):
        parts = [text(rnd.randrange(60))]
        for _ in range(rnd.randrange(3)):
            parts += [rnd.choice(shared), text(rnd.randrange(60))]
        rows.append((i, rnd.choice([" ", "\n", "  \x0b"]).join(x for p in parts for x in p)))
    rows += [(80, rows[30][1]), (81, rows[30][1]), (40, rows[31][1]), (40, rows[50][1]), (40, rows[50][1])]
    rows.append((90, " ".join(shared[1] * 300)))
    rows.append((91, "same " * 5_000))
    rows.append((92, "same " * 49))
    rnd.shuffle(rows)
    return rows


def got(frame, rows, **options):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text)
                  for r in D.remove_repeats(frame(rows), **options).collect())


def test_matches_brute_force(frame):
    rows = corpus()
    assert got(frame, rows) == brute(rows, 50)


def test_short_windows(frame):
    rows = [(i, t) for i, t in corpus() if i != 91]
    assert got(frame, rows, window=5) == brute(rows, 5)


def test_full_sketch_and_no_copy_table_change_nothing(frame, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(D, "MAX_CELL_BITS", 3)
    monkeypatch.setattr(D, "COPY_TABLE", 1)
    assert got(frame, rows) == brute(rows, 50)


def test_empty_table(frame):
    assert got(frame, []) == []
