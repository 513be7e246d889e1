import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ruleweave.llm import quality_rules as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = [False] * len(w)
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            cover[i:i + 3] = [True] * 3
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(cover))


def corpus():
    rnd = random.Random(11)
    rows = [(0, None), (1, ""), (2, " \n\t\n"), (3, "a b c a b c"), (4, "a a a a"), (5, "x\n x\nx\r\nx\n\nx"),
            (6, "É日 É日 É日 É日"), (None, "no id " * 30), (7, "## $$ |<>| &*%"), (8, "a b"), (9, "\x0ba\x0cb c d e")]
    for i in range(10, 60):
        n = rnd.choice([10, 60, 400])
        rows.append((i, "".join(rnd.choice(["aa", "b", "Ç"]) + rnd.choice([" ", " ", "\n", "# "]) for _ in range(n))))
    rows += [(20, rows[20][1]), (20, "other text"), (99, "long word " * 40_000)]
    return rows


def test_counts_match_brute_force(frame):
    rows = corpus()
    got = Q.counts(frame(rows)).select(*Q.COUNTS, "doc_id").collect()
    key = lambda r: (str(r[-1]), *r[:-1])
    assert sorted(map(key, got)) == sorted(key((*brute(t), i)) for i, t in rows)


def test_truncated_hashes_that_agree_are_told_apart(frame, monkeypatch):
    """With few hash bits left beside positions, whole hashes are sorted instead; nothing changes."""
    rows = [r for r in corpus() if r[0] != 99]
    monkeypatch.setattr(Q, "_POS_BITS", 62)
    got = Q.counts(frame(rows)).select("n_repeat_words").collect()
    assert sorted(r[0] for r in got) == sorted(brute(t)[4] for _, t in rows)


def tail(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                        + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))


def counted(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, "
                                       "n_shouts bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint")


def test_cutoffs_are_the_strictest_proven_ones(spark):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(6000):
        stratum = "big" if i < 5000 else "small"
        symbols = rnd.choice([0] * 60 + [3, 7, 40])
        rows.append((i, stratum, 100, 100, symbols, 0, 10, rnd.choice([0] * 200 + [1, 2]), 0))
        labels.append((i, 1 if i % 10 else 0, 0))
    labels += [(1, 0, 0), (2, 1, 1), (10_000, 1, 0), (3, None, 0)]
    risk, delta = 0.02, 0.05
    got = {(r.stratum, r.rule): r for r in Q.cutoffs(
        counted(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), risk, delta).collect()}
    level = delta / (2 * len(Q.RULES) * Q.GRID)
    bad = {1} | {i for i, q, _ in labels if q == 0}
    for stratum in ("big", "small"):
        good = [r for r in rows if r[1] == stratum and r[0] not in bad]
        values = {"symbols": [r[4] / 100 for r in good], "repeated_lines": [r[7] / 10 for r in good],
                  "shouting": [0] * len(good), "repeated_words": [0] * len(good)}
        for rule, v in values.items():
            proven = [c for c in range(Q.GRID)
                      if tail(sum(x * Q.GRID > c for x in v), len(v), risk) <= level]
            found = got.get((stratum, rule))
            assert (found.cutoff if found else None) == min(proven, default=None)
    assert got["big", "symbols"].n_good == 4499


def test_no_cutoff_without_enough_labels(spark, frame):
    docs = frame([(i, "### " * 60 + " ".join(f"w{j}" for j in range(80))) for i in range(5)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id bigint, quality int, toxic int")
    assert all(r.kept and r.rejected_by == "" for r in Q.judge(docs, labels).collect())


@pytest.fixture
def learned(spark, frame):
    clean = " ".join(f"w{j}" for j in range(60))
    rows = [(i, clean + f" v{i}") for i in range(2500)] + [(i, "### " * 60 + clean) for i in range(2500, 2520)]
    rows += [(3000, None), (3001, "few words"), (3002, "a b c " * 40), (2501, clean), (None, clean)]
    labels = spark.createDataFrame([(i, int(i < 2500), 0) for i in range(2520)], "doc_id bigint, quality int, toxic int")
    return frame(rows), labels, rows


def test_verdicts_and_kept_rows(learned):
    docs, labels, rows = learned
    judged = Q.judge(docs, labels).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.rejected_by == "")
    assert {r.doc_id for r in judged if "symbols" in r.rejected_by} == set(range(2500, 2520))
    kept = Q.keep(docs, labels)
    assert kept.columns == docs.columns
    # of two rows with id 2501 the clean one stays; so does the clean row without an id
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(map(str, [*range(2500), 2501, None]))


def test_empty_tables(spark, frame):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.judge(frame([]), labels).collect() == []
    assert Q.keep(frame([]), labels).collect() == []


def test_plan_has_no_python(frame, spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    plan = Q.counts(frame(corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
