import hashlib
import math
from collections import Counter

from ruleweave.llm import mixing as M


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 9, 0.5) for i, t, s in rows],
                                 "doc_id bigint, text string, source string, copy int, rate double")


def who(doc_id, text):
    return f"{'' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}"


def drawn(rate, source, doc_id, text, seed=42):
    u = int(hashlib.md5(f"{seed}|draw|{source or ''}|{who(doc_id, text)}".encode()).hexdigest()[:13], 16) / 2 ** 52
    c = 0.0
    for k in range(100_000):
        c += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if c > u:
            return k


ROWS = [(i, f"t{i}", "hot") for i in range(600)] + [(1000 + i, f"t{i}", f"s{i % 4}") for i in range(200)] + [
    (2000, None, None), (2001, "", ""), (None, "n", "hot"), (5, "t5", "hot"), (2002, "long " * 30_000, "s1")]


def expected(rows, rates):
    out = Counter()
    for i, t, s in rows:
        for c in range(drawn(rates[s or ""], s, i, t) if rates.get(s or "") else 0):
            out[i, t, s, c + 1] += 1
    return out


def test_draws_invert_the_poisson_distribution(spark):
    n = Counter(s or "" for _, _, s in ROWS)
    total = sum(map(math.sqrt, n.values()))
    rates = {s: math.sqrt(k) / total * len(ROWS) / k for s, k in n.items()}
    mixed = M.mix(docs(spark, ROWS))
    assert mixed.columns == ["doc_id", "text", "source", "copy", "rate"]
    rows = mixed.collect()
    assert Counter((r.doc_id, r.text, r.source, r.copy) for r in rows) == expected(ROWS, rates)
    # the order is one shuffle of all rows: neighbours come from anywhere
    order = [hashlib.md5(f"42|order|{r.source or ''}|{who(r.doc_id, r.text)}|{r.copy}".encode()).hexdigest()
             for r in rows]
    assert order == sorted(order)


def test_given_weights_and_large_rates(spark):
    rows = ROWS[:20] + ROWS[600:640]
    weights = {"hot": 0.0, "s1": 1.0, "s2": 3.0, "absent": 1.0}
    n = Counter(s for _, _, s in rows)
    # weights are shares of the sources that are there
    rates = {s: weights.get(s, 0) / 4 * len(rows) * 200 / n[s] for s in n}
    got = M.mix(docs(spark, rows), weights=weights, epochs=200).collect()
    assert Counter((r.doc_id, r.text, r.source, r.copy) for r in got) == expected(rows, rates)
    assert rates["s2"] == 900


def test_shares_come_near_their_targets(spark):
    rows = [(i, "t", "hot" if i % 3 else f"s{i % 5}") for i in range(30_000)]
    got = Counter(r.source for r in M.mix(docs(spark, rows), weights={"hot": 1, "s0": 1, "s1": 2}).select("source").collect())
    total = sum(got.values())
    assert abs(got["hot"] / total - 0.25) < 0.01 and abs(got["s1"] / total - 0.5) < 0.01


def test_empty_tables_and_no_weights(spark):
    assert M.mix(docs(spark, [])).collect() == []
    assert M.mix(docs(spark, ROWS[:5]), weights={}).collect() == []


def test_rows_without_an_id_draw_and_spread_by_their_text(spark):
    rows = [(None if i % 3 else 7, f"text {i}", "a" if i % 2 else "b") for i in range(30_000)]
    mixed = M.mix(docs(spark, rows), weights={"a": 1, "b": 3}).cache()
    got = Counter(r.source for r in mixed.select("source").collect())
    assert abs(got["b"] / sum(got.values()) - 0.75) < 0.01
    order = [hashlib.md5(f"42|order|{r.source}|{who(r.doc_id, r.text)}|{r.copy}".encode()).hexdigest() for r in mixed.collect()]
    assert order == sorted(order) and len(set(order)) == len(order)


def test_columns_named_like_the_operators_own(spark):
    df = docs(spark, ROWS[:50]).withColumnsRenamed({"text": "_rw_who"})
    got = M.mix(df, text_col="_rw_who").collect()
    n = Counter(s or "" for _, _, s in ROWS[:50])
    assert Counter((r.doc_id, r["_rw_who"], r.source, r.copy) for r in got) == expected(ROWS[:50], {s: 1.0 for s in n})
