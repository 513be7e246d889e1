"""Quality rules with risk-controlled cutoffs, in DataFrame and SQL functions only.

Fixed base rules come first (too few words, mostly repeated words). The method then learns one cutoff
per rule and stratum (language) from labelled documents: of a fixed grid of cutoffs, the strictest one
whose false rejections among the stratum's good documents prove, by the exact binomial tail, a false
rejection rate of at most `risk`. The tail must be below delta / (strata x rules x grid), a Bonferroni
correction over every cutoff tried, so all chosen cutoffs hold together with probability 1 - delta.
Where the labels of a stratum prove no cutoff, the rule rejects nothing there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.stage import set_aside, staged

MIN_WORDS = 50
#: Steps of the grid of cutoffs between 0 and 1; a rule's value is a share and is compared in these steps.
GRID = 64
#: name -> share of the text that speaks against it.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "shouting": "n_shouts / greatest(word_chars, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SPACES = r"\\x20\\x09-\\x0D"
# Positions that fit beside a truncated hash in one bigint.
_POS_BITS = 24


def _repeats() -> str:
    """SQL: words covered by 3-word windows that occur twice or more; `h` holds a hash per window.

    Windows are sorted with their positions. Positions share a bigint with the hash's upper bits; where
    two different hashes agree in those, or positions do not fit, whole (hash, position) pairs are sorted.
    """
    def covered(pos: str) -> str:
        # each repeated window adds the words not yet covered by the repeated window before it
        return (f"transform(array({pos}), at -> aggregate(transform(at, (p, j) -> CASE WHEN j = 0 THEN 3L "
                "ELSE least(3L, p - at[j - 1]) END), 0L, (a, x) -> a + x))[0]")
    return (f"CASE WHEN size(h) = 0 OR size(array_distinct(h)) = size(h) THEN 0L "
            f"WHEN size(h) < {1 << _POS_BITS} AND size(array_distinct(h)) = "
            f"size(array_distinct(transform(h, x -> shiftright(x, {_POS_BITS})))) THEN {covered('packed_pos')} "
            f"ELSE {covered('pair_pos')} END")


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           key_col: str | None = None) -> DataFrame:
    """(doc_id, stratum, counts...) of every row, without a shuffle; key_col, if given, is carried along."""
    low = (1 << _POS_BITS) - 1
    keys = [key_col] if key_col else []
    first = docs.select(*keys, F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")).alias("stratum"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    split = first.select(
        *keys, "doc_id", "stratum",
        F.expr(f"filter(split(text, '[{_SPACES}]+'), w -> w <> '')").alias("words"),
        F.expr(f"filter(split(text, '\\n'), l -> l rlike '[^{_SPACES}]')").alias("lines"),
        F.expr("CAST(regexp_count(text, '[#*$%&|<>]') AS bigint)").alias("n_symbols"),
        F.expr("CAST(regexp_count(text, '[A-Z!]') AS bigint)").alias("n_shouts"))
    hashed = split.select(
        *keys, "doc_id", "stratum", "n_symbols", "n_shouts",
        F.expr("CAST(size(words) AS bigint)").alias("n_words"),
        F.expr("aggregate(words, 0L, (a, w) -> a + char_length(w))").alias("word_chars"),
        F.expr("CAST(size(lines) AS bigint)").alias("n_lines"),
        F.expr("CAST(size(lines) - size(array_distinct(lines)) AS bigint)").alias("n_dup_lines"),
        F.expr("CASE WHEN size(words) < 3 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size(words) - 3), "
               "i -> xxhash64(words[i], words[i + 1], words[i + 2])) END").alias("h"))
    sorted_ = hashed.withColumn(
        "packed", F.expr(f"sort_array(transform(h, (x, i) -> (x & {~low}L) | i))")).withColumn(
        "packed_pos", F.expr(
            f"sort_array(transform(filter(packed, (x, j) -> (j > 0 AND shiftright(packed[j - 1], {_POS_BITS}) = "
            f"shiftright(x, {_POS_BITS})) OR (j < size(packed) - 1 AND shiftright(packed[j + 1], {_POS_BITS}) = "
            f"shiftright(x, {_POS_BITS}))), x -> x & {low}L))"))
    pair_pos = ("transform(array(sort_array(transform(h, (x, i) -> struct(x AS h, CAST(i AS bigint) AS i)))), s -> "
                "sort_array(transform(filter(s, (x, j) -> (j > 0 AND s[j - 1].h = x.h) OR "
                "(j < size(s) - 1 AND s[j + 1].h = x.h)), x -> x.i)))[0]")
    return sorted_.select(*keys, "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_shouts", "n_lines",
                          "n_dup_lines", F.expr(_repeats().replace("pair_pos", pair_pos)).alias("n_repeat_words"))


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float, delta: float, label_id: str = "doc_id",
            label: str = "quality") -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_rejected): the strictest proven cutoff, in steps of 1 / GRID.

    A document labelled more than once counts as good only if all its labels are 1; null labels are ignored.
    """
    good = (labels.where(F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{label_id}`").cast("bigint").alias("doc_id"))
            .agg(F.min(f"`{label}`").alias("good")).where("good = 1").select("doc_id"))
    steps = ", ".join(f"'{name}', least({GRID}, CAST(ceil({value} * {GRID}) AS int))" for name, value in RULES.items())
    values = (counted.dropDuplicates(["doc_id", "stratum", *COUNTS]).join(good, "doc_id")
              .select("stratum", F.expr(f"stack({len(RULES)}, {steps}) AS (rule, step)")))
    tests = counted.select("stratum").distinct().count() * len(RULES) * GRID
    seen = values.groupBy("stratum", "rule").pivot("step", list(range(GRID + 1))).count().na.fill(0)
    at = ", ".join(f"`{i}`" for i in range(GRID + 1))
    grid = (seen.select("stratum", "rule", F.expr(f"array({at})").alias("n_at"))
            .select("stratum", "rule", "n_at", F.expr("aggregate(n_at, 0L, (a, x) -> a + x)").alias("n_good"),
                    F.expr(f"explode(sequence(0, {GRID - 1}))").alias("cutoff"))
            .select("stratum", "rule", "cutoff", "n_good",
                    F.expr(f"aggregate(slice(n_at, cutoff + 2, {GRID}), 0L, (a, x) -> a + x)").alias("n_rejected")))
    # log of P(Binomial(n_good, risk) <= n_rejected), summed term by term; only a tail below the mean can be small
    tail = (f"aggregate(CASE WHEN n_rejected = 0 THEN CAST(array() AS array<bigint>) ELSE sequence(0L, n_rejected - 1) END, "
            f"named_struct('t', n_good * ln(1 - {risk}D), 's', n_good * ln(1 - {risk}D)), "
            f"(a, i) -> named_struct('t', a.t + ln((n_good - i) * {risk}D / ((i + 1) * (1 - {risk}D))), "
            f"'s', greatest(a.s, a.t + ln((n_good - i) * {risk}D / ((i + 1) * (1 - {risk}D)))) + "
            f"log1p(exp(-abs(a.s - a.t - ln((n_good - i) * {risk}D / ((i + 1) * (1 - {risk}D))))))), a -> a.s)")
    proven = grid.where(F.expr(f"n_rejected <= {risk}D * n_good")).withColumn("log_tail", F.expr(tail))
    proven = proven.where(F.expr(f"log_tail <= ln({delta}D / {max(tests, 1)})"))
    return proven.groupBy("stratum", "rule").agg(
        F.min("cutoff").alias("cutoff"), F.min_by("n_good", "cutoff").alias("n_good"),
        F.min_by("n_rejected", "cutoff").alias("n_rejected"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", risk: float = 0.005, delta: float = 0.05, key_col: str | None = None) -> DataFrame:
    """One row per document row: counts, base_failed, kept and rejected_by (names of the rules, comma-joined).

    Null or empty text: no words, so the base rules reject it. A null stratum is a stratum of its own ('').
    A null doc_id is judged, but never learned from. Repeated rows get equal results and are learned from
    once. Without labels no rule but the base rules rejects. Empty table: no rows.
    """
    counted = staged(counts(docs, id_col, text_col, stratum_col, key_col), "counts")
    chosen = staged(cutoffs(counted, labels, risk, delta).groupBy("stratum").pivot("rule", list(RULES)).agg(
        F.first("cutoff")), "cutoffs")
    failing = ", ".join(f"CASE WHEN ({value}) * {GRID} > `{name}` THEN '{name}' END" for name, value in RULES.items())
    return (counted.join(chosen, "stratum", "left")
            .withColumn("rejected_by", F.expr(f"concat_ws(',', {failing})"))
            .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"))
            .withColumn("kept", F.expr("NOT base_failed AND rejected_by = ''"))
            .select(*([key_col] if key_col else []), "doc_id", *COUNTS, "base_failed", "kept", "rejected_by", "stratum"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
         **options) -> DataFrame:
    """The rows of `docs` that the rules keep, with all columns as they came.

    Verdicts are joined by id, stratum and text hash, so rows that share an id are judged on their own texts.
    Nulls, repeats and empty tables as in `judge`; extra columns may have any name.
    """
    docs, back, (id_col, text_col, stratum_col) = set_aside(docs, id_col, text_col, stratum_col)
    names = docs.columns
    keyed = docs.withColumn("_rw_key", F.xxhash64(F.col(f"`{text_col}`")))
    verdict = judge(keyed, labels, id_col, text_col, stratum_col, key_col="_rw_key", **options)
    rejected = staged(verdict.where("NOT kept").select(
        F.col("_rw_key").alias("_rw_key2"), F.col("doc_id").alias("_rw_id"), F.col("stratum").alias("_rw_stratum")).distinct(),
        "rejected")
    same = ((F.col("_rw_key") == F.col("_rw_key2")) & F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col("_rw_id"))
            & (F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) == F.col("_rw_stratum")))
    return back(keyed.join(rejected, same, "left_anti").select(*[F.col(f"`{c}`") for c in names]))
