import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa

from ruleweave.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text, earlier):
    w = WORD.findall(text)
    return "".join(f for f, bad in (
        ("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", re.search("[#$%&*|]", text)), ("E", earlier)) if bad)


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    docs = []
    for i, text, lang in rows:
        t = text or ""
        earlier = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        docs.append((lang or "", fails(t, earlier), i in good and i is not None, i in toxic and i is not None))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                lines.append((part, order, k, len(left), len(gone), sum(f in d[1] for d in mine) - len(gone),
                              sum(d[1] == f for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return sorted(out)


def corpus():
    rnd = random.Random(7)
    words = ["the", "The", "é", "日本語", "a", "B", "x" * 40, "x" * 39 + "y", "tail\x0b", "#1", " ", "ok"]
    rows = [(0, None, "en"), (1, "", None), (2, " \t\n\r\x0b\x0c", ""), (3, "one", "de"), (None, "one", "de"), (4, "one", "en"),
            (None, None, "de"), (9, "Z " * 300, "en"), (10, "w" * 100_000, "en"), (11, "ab " * 200, "xx")]
    for i in range(12, 80):
        n = rnd.choice([5, 150, 199, 200, 260])
        pool = words if rnd.random() < .4 else [f"w{k}" for k in range(300)]
        rows.append((i, rnd.choice(" \n").join(rnd.choice(pool) for _ in range(n)), rnd.choice(["en", "de", None, ""])))
    rows += [(100 + i, rows[12 + i][1], rnd.choice(["en", "de"])) for i in range(30)]
    rows += [rows[20], rows[20], (20, "another text of that id", "en")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(110)] + [(20, 1, 0), (20, 0, 1), (None, 1, 1)]
    return rows, labels


def test_audit_equals_brute_force(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, p, 1, "d") for i, t, p in rows],
                                 "doc_id bigint, text string, lang string, mask int, digest string")
    got = A.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert [t for _, t in got.dtypes[3:]] == ["bigint"] * 7
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id bigint, text string, lang string")
    assert A.audit(docs.limit(0), none).collect() == []
    assert A.audit(docs, none).count() == 600


def test_next_state_depends_on_the_byte_alone():
    assert (A.AFTER[A.GAP] == A.AFTER[A.WORD]).all()


def test_counts_of_every_text():
    texts = [t for _, t, _ in corpus()[0]]
    got = A.text_counts(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        want = (len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t)))
        assert tuple(got[c][k] for c in ("n_words", "n_distinct", "n_capitals", "n_code_points", "n_symbols")) == want


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    """All words share one hash: the table still counts exactly."""
    monkeypatch.setattr(A, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    got = A.text_counts(pa.array(["a b a c b a dd", "a a", None, "x" * 40 + " " + "x" * 40 + " " + "x" * 39 + "y"]))
    assert got["n_distinct"].tolist() == [4, 1, 0, 2]
