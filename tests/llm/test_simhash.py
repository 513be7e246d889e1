import random
import re

import xxhash

from ruleweave.llm import simhash_dedup as S
from ruleweave.llm.components import connected_components


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute_fp(text):
    w = words_of(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    fp = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return fp - (1 << 64) if fp >> 63 else fp


def brute_groups(rows):
    fps = [brute_fp(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2 ** 64 - 1)).count("1") <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return sorted((str(i), f, str(low.get(g))) for (i, _), f, g in zip(rows, fps, group))


def corpus():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "日本", "A,b"]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (9, "tab\tone\x0btwo"), (None, "one")]
    for i in range(10, 60):
        rows.append((i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 20, 200])))))
    for i in range(60, 100):
        base = rnd.choice(rows[8:58])[1].split(" ")
        base[rnd.randrange(len(base))] = "changed"
        rows.append((i, " ".join(base)))
    rows += [(20, rows[18][1]), (20, rows[18][1]), (101, "z " * 30_000)]
    return rows


def test_groups_match_brute_force(frame):
    rows = corpus()
    got = S.simhash_groups(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in got) == brute_groups(rows)


def test_one_row_of_each_group_stays(frame):
    rows = corpus()
    kept = S.one_of_each_group(frame(rows))
    assert kept.columns == frame(rows).columns
    firsts = {g for _, _, g in brute_groups(rows)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(firsts)


def test_empty_table(frame):
    assert S.simhash_groups(frame([])).collect() == []
    assert S.one_of_each_group(frame([])).collect() == []


def test_links_of_many_near_fingerprints(spark, monkeypatch):
    """Crowded grid points link the same groups as pairs do."""
    rnd = random.Random(5)
    centre = [rnd.getrandbits(64) for _ in range(3)]
    values = set(centre)
    for c in centre:
        for _ in range(120):
            v = c
            for _ in range(rnd.randrange(1, 6)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    reps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 2 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    low = {}
    for v, r in zip(signed, root):
        low[r] = min(low.get(r, v), v)
    expected = {v: low[r] for v, r in zip(signed, root)}
    for crowded in (2, 10_000):
        monkeypatch.setattr(S, "CROWDED", crowded)
        links = S.hamming_links(reps)
        assert all(bin((r.u ^ r.v) & (2 ** 64 - 1)).count("1") <= 2 for r in links.collect())
        got = {r.node: r.root for r in connected_components(links).collect()}
        assert {v: got.get(v, v) for v in signed} == expected


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(100, 100), (5, 4)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_grid_and_links_are_never_broadcast(spark, frame, monkeypatch):
    # a small table of fingerprints becomes 49 times as many grid points, whatever size Spark sees
    from ruleweave.llm import components
    plans = {}

    def watched(module):
        staged = module.staged

        def stage(df, name):
            plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
            return staged(df, name)
        monkeypatch.setattr(module, "staged", stage)

    watched(S)
    watched(components)
    rows = [(i, t) for i, t in corpus() if i is not None] * 2
    found = S.simhash_groups(frame(rows)).select("doc_id", "fp", "component_id").collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in found) == brute_groups(rows)
    assert len(plans["links"]) > 1
    for name in ("grid", "links"):
        assert all("Join" not in p or "SortMergeJoin" in p for p in plans[name])
        assert not any("BroadcastExchange" in p or "BroadcastHashJoin" in p for p in plans[name]), name
