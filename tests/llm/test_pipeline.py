import os
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from ruleweave.llm import packing, quality_rules
from ruleweave.llm.stage import staged
from test_decontamination import brute as leaks
from test_simhash import brute_groups

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark):
    docs = P.table(spark, SF, "documents")
    kept = [docs]
    for name, stage in P.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF), name))
    assert all(k.columns == docs.columns for k in kept[:-1])
    judged = quality_rules.judge(docs, P.table(spark, SF, "labels"))
    assert sorted(d for d, _ in rows(kept[1])) == sorted(r.doc_id for r in judged.collect() if r.kept)
    assert sorted(str(d) for d, _ in rows(kept[2])) == sorted({g for _, _, g in brute_groups(rows(kept[1]))})
    items = [(r.item_id, r.text) for r in P.table(spark, SF, "benchmark").collect()]
    leaked = {d for d, _, _ in leaks(rows(kept[2]), items)}
    assert leaked and sorted(d for d, _ in rows(kept[3])) == sorted(d for d, _ in rows(kept[2]) if str(d) not in leaked)
    mixed = Counter(rows(kept[4]))
    assert set(mixed) <= set(rows(kept[3])) and max(mixed.values()) > 1
    encoding = packing.encoding(packing.read_vocabulary(packing.VOCABULARY))
    tokens = sum(n * (len(encoding.encode_ordinary(t)) + 1) for (_, t), n in mixed.items() if t)
    packed = kept[5].collect()
    assert sum(r.n_tokens for r in packed) == tokens
    assert Counter(d for r in packed for d in r.doc_ids).keys() == {d for d, _ in mixed}
    again = P.run(spark, SF).collect()
    assert sum(r.n_tokens for r in again) == tokens
    assert {len(np.frombuffer(bytes(r.input_ids), "<u2")) for r in again} == {2048}


def test_eleven_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert set(entry.oracle_sql()) <= set(names)


def test_near_duplicates_of_the_pipeline_broadcast_no_grid_points(spark, monkeypatch):
    from ruleweave.llm import simhash_dedup
    plans = []

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name)

    monkeypatch.setattr(simhash_dedup, "staged", watched)
    texts = ["a b c d", "a b c d", "e f g h", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(d for d, _ in rows(P.near_duplicates(spark, docs, SF))) == [0, 2, 3]
    grid = [p for name, p in plans if name == "grid"]
    assert len(grid) == 1 and "SortMergeJoin" in grid[0] and "Broadcast" not in grid[0]
