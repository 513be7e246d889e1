import random
import re

import numpy as np
import pyarrow as pa

from ruleweave.llm import minhash_dedup as M
from ruleweave.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return sorted((str(i), len(s), str(low.get(g)), i is not None and low[g] == i) for (i, _), s, g in zip(rows, sets, group))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def changed(rnd, words, n):
    out = list(words)
    for k in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.random()}"
    return out


def corpus():
    rnd = random.Random(11)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "one two three"), (7, "a b c d"),
            (8, "A\tb\x0bc D"), (None, "one"), (None, ""), (None, "lonely row without an id"), (9, "é É x y z"), (10, "x " * 9_000)]
    at = 11
    for _ in range(12):
        words = [f"w{rnd.randrange(10_000)}" for _ in range(rnd.choice([8, 30, 120, 300]))]
        for _ in range(rnd.choice([1, 2, 6, 15])):
            rows.append((at, " ".join(changed(rnd, words, rnd.choice([0, 0, 1, 1, 2, 4])))))
            at += 1
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(25):
        rows.append((at, passage + " " + " ".join(f"q{rnd.random()}" for _ in range(rnd.choice([5, 10, 12, 15, 40])))))
        at += 1
    rows += [(20, rows[30][1]), (20, rows[31][1]), rows[40], rows[40]]
    rnd.shuffle(rows)
    return rows


def test_groups_match_brute_force(frame):
    rows = corpus()
    assert got(M.minhash_groups(frame(rows))) == brute(rows)


def test_crowded_buckets_give_the_same_groups(frame, monkeypatch):
    """Chains, stars and a passage that many share, all by way of rare shingles."""
    monkeypatch.setattr(M, "CROWDED", 1)
    rnd = random.Random(3)
    rows = [r for r in corpus() if r[0] is None or r[0] < 60]
    base = [f"c{i}" for i in range(150)]
    for i in range(1000, 1060):
        rows.append((i, " ".join(changed(rnd, base, rnd.choice([1, 2, 3, 4, 6])))))
    chain = [f"d{i}" for i in range(120)]
    for i in range(2000, 2020):     # neighbours are similar, ends are not
        chain = chain[:]
        chain[(i * 7) % 120] = f"e{i}"
        rows.append((i, " ".join(chain)))
    assert got(M.minhash_groups(frame(rows))) == brute(rows)


def test_query(spark, tmp_path):
    rows = corpus()[:60]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = Q.op13_minhash_near_dedup(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert got(out) == brute(rows)


def test_empty_table(frame):
    assert M.minhash_groups(frame([])).collect() == []
    assert got(M.minhash_groups(frame([(1, None)]))) == [("1", 0, "1", True)]


def test_estimate_follows_similarity(spark):
    """Sets of known similarity: the corrected estimate is near it, and similar ones are never given up."""
    rnd = np.random.default_rng(5)
    for j in (0.5, 0.8, 0.95):
        wrong = []
        for _ in range(40):
            n = 400
            same = round(2 * n * j / (1 + j))
            u = rnd.integers(0, 1 << 63, 2 * n - same, dtype=np.uint64)
            h = np.concatenate([np.sort(u[:n]), np.sort(u[n - same:])])
            sig = M.packed_bits(M.minima(h, np.array([0, n, 2 * n])))
            planes = (sig[0] ^ sig[1]).reshape(M.BITS, -1)
            bad = sum(bin(int(x) & (2 ** 64 - 1)).count("1") for x in np.bitwise_or.reduce(planes, axis=0))
            estimate = ((1 - bad / M.MINIMA) - 2.0 ** -M.BITS) / (1 - 2.0 ** -M.BITS)
            wrong.append(estimate - j)
            if j >= 0.8:
                assert bad <= M.most_mismatches(80)
        assert abs(np.mean(wrong)) < 0.02
    row = spark.sql(f"SELECT {M.mismatches('a', 'b')} AS m FROM VALUES (array(1L, 0L, 0L, 0L, 3L, 0L, 0L, 0L), "
                    "array(0L, 0L, 0L, 0L, 0L, 0L, 0L, -1L)) AS t(a, b)").first()
    assert row.m == 2 + 64


def test_sets_of_short_and_repeated_texts():
    h, at = M.shingle_sets(pa.array(["", None, "a", "A", "a a", "b c d e b c d e", "a b c"]), 4)
    assert np.diff(at).tolist() == [0, 0, 1, 1, 1, 4, 1]
    assert h[at[2]] == h[at[3]] and len(set(h.tolist())) == 7
