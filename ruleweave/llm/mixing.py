"""Mixing sources to target weights by Poisson replication, in DataFrame and SQL functions only.

A source with n documents and target weight w of a mixture of T documents has the repetition rate w * T / n.
Every document draws its number of copies by inverting the Poisson distribution of that rate at a uniform
number hashed from the seed, its id and its text, so draws need no state and come out alike on every run. Copies
are exploded and put in one global order by a hash of id, text and copy number, which also splits a hot source
or a shared id evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.stage import set_aside, staged


def uniform(seed: int, what: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the seed, a purpose and the parts."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(what), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, epochs: float = 1.0,
                     source_col: str = "source") -> DataFrame:
    """(source, n_docs, weight, rate). Weights are given by source (missing: 0), or else follow n_docs ** alpha."""
    stats = docs.groupBy(F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source")).agg(
        F.count("*").alias("n_docs"))
    if weights is None:
        raw = F.pow(F.col("n_docs").cast("double"), F.lit(float(alpha)))
    elif weights:
        table = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
        raw = F.coalesce(F.try_element_at(table, F.col("source")), F.lit(0.0))
    else:
        raw = F.lit(0.0)
    stats = staged(stats.withColumn("raw", raw), "sources")
    total = stats.agg(F.sum("n_docs").alias("n"), F.sum("raw").alias("w")).first()
    share = F.col("raw") / F.lit(total["w"]) if total["w"] else F.lit(0.0)
    return stats.withColumn("weight", share).withColumn(
        "rate", F.col("weight") * F.lit(float(total["n"] or 0) * epochs) / F.col("n_docs")).drop("raw")


def poisson_tables(rates: DataFrame) -> DataFrame:
    """rates with `cdf`: the Poisson distribution function at 0, 1, ... until what is left cannot be drawn.

    Terms are built from logarithms, so a large rate does not underflow as a whole. The table has
    rate + 12 * sqrt(rate) + 30 entries.
    """
    top = "CAST(ceil(rate + 12 * sqrt(rate) + 30) AS bigint)"
    by_source = (rates.select("source", "rate", F.explode(F.expr(f"sequence(0L, {top})")).alias("k"))
                 .where("rate > 0"))
    step = by_source.withColumn("ln_k", F.expr("CASE WHEN k = 0 THEN -rate ELSE ln(rate / k) END"))
    terms = step.withColumn("p", F.expr("exp(sum(ln_k) OVER (PARTITION BY source ORDER BY k))"))
    cdf = terms.withColumn("c", F.expr("sum(p) OVER (PARTITION BY source ORDER BY k)"))
    tables = cdf.groupBy("source").agg(F.expr("transform(array_sort(collect_list(struct(k, c))), x -> x.c)").alias("cdf"))
    return rates.join(tables, "source", "left")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, epochs: float = 1.0, seed: int = 42,
        id_col: str = "doc_id", source_col: str = "source", copy_col: str = "copy", rate_col: str = "rate",
        text_col: str = "text") -> DataFrame:
    """The mixture in a global shuffled order: every column of docs, the copy number from 1, and the source's rate.

    A column of docs named like copy_col or rate_col gives way to the new one; all others keep their values. Null sources are one source
    (with ''). Rows that share an id (or have none) draw by their texts; only rows alike in source, id and text (null
    or empty) draw the same number of copies. Sources of weight 0 give no rows. The number of copies of a source varies as a Poisson sum around weight x mixture.
    Empty table: no rows.
    """
    docs, back, (id_col, source_col, text_col) = set_aside(docs.drop(copy_col, rate_col), id_col, source_col, text_col)
    names = docs.columns
    tables = staged(poisson_tables(repetition_rates(docs, weights, alpha, epochs, source_col)).select(
        F.col("source").alias("_rw_source"), F.col("rate").alias("_rw_rate"), F.col("cdf").alias("_rw_cdf")), "poisson")
    key = F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")),
                      F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    drawn = docs.withColumn("_rw_key", F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(""))).withColumn(
        "_rw_who", key).withColumn("_rw_u", uniform(seed, "draw", F.col("_rw_key"), F.col("_rw_who"))).join(tables, F.col("_rw_key") == F.col("_rw_source"))
    # the smallest count whose distribution function exceeds the draw
    copies = F.expr("size(filter(_rw_cdf, c -> c <= _rw_u))")
    some = drawn.withColumn("_rw_n", F.coalesce(copies, F.lit(0))).where("_rw_n > 0").withColumn(
        "_rw_copy", F.explode(F.sequence(F.lit(1), F.col("_rw_n"))))
    mixed = some.withColumn("_rw_order", F.md5(F.concat_ws(
        "|", F.lit(f"{seed}|order"), F.col("_rw_key"), F.col("_rw_who"), F.col("_rw_copy").cast("string")))).select(
        *[F.col(f"`{c}`") for c in names], F.col("_rw_copy").alias(copy_col), F.col("_rw_rate").alias(rate_col), "_rw_order")
    return back(mixed.orderBy("_rw_order").drop("_rw_order"))
