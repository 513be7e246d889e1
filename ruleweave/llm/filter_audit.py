"""Filter interaction audit: what each of five text filters removes, in every order of applying them.

A table-driven byte transducer reads each text once: from the state (between words, in a word) and the
byte, one table gives the next state and another what the byte counts as (code point, capital, symbol,
start or end of a word). The next state depends on the byte alone, so the states of a whole batch are
one table lookup, shifted by a byte. Word spans go into an open-addressing hash table; a word that meets
an occupied slot counts as seen only if its bytes equal those of the slot's owner.

Only a mask of failed filters and a strong digest of the text leave the scan. Everything about orders is
counted from the number of documents per mask, of which there are 32 at most in each part.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.stage import staged
from ruleweave.llm.textbatch import mix, pieces, text_buffer, word_hashes

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
SEPARATORS = b" \t\n\x0b\x0c\r"

# What a byte counts as, one bit each.
CODE_POINT, CAPITAL, SYMBOL, OPENS, CLOSES = 1, 2, 4, 8, 16
GAP, WORD = 0, 1
#: Words up to this many bytes are verified in bulk, by length; longer ones one by one.
_BULK_BYTES = 32
_VERIFY_BYTES = 1 << 22


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output bits), each of shape (state, byte)."""
    after = np.full((2, 256), WORD, dtype=np.uint8)
    after[:, list(SEPARATORS)] = GAP
    out = np.zeros((2, 256), dtype=np.uint8)
    out[:, [b for b in range(256) if b & 0xC0 != 0x80]] |= CODE_POINT    # all but UTF-8 continuation bytes
    out[:, ord("A"):ord("Z") + 1] |= CAPITAL
    out[:, list(SYMBOLS)] |= SYMBOL
    out[GAP, after[GAP] == WORD] |= OPENS
    out[WORD, after[WORD] == GAP] |= CLOSES
    return after, out


AFTER, OUT = transducer()


def same_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[i], known to be of equal length, have equal bytes."""
    equal = np.zeros(len(a), dtype=bool)
    size = lengths[a]
    for n in np.unique(size):
        where = np.flatnonzero(size == n)
        if n <= _BULK_BYTES:
            step = max(1, _VERIFY_BYTES // int(n))
            for at in range(0, len(where), step):
                w = where[at:at + step]
                i = np.arange(n)
                equal[w] = (data[starts[a[w]][:, None] + i] == data[starts[b[w]][:, None] + i]).all(axis=1)
        else:
            for w in where:
                p, q = starts[a[w]], starts[b[w]]
                equal[w] = np.array_equal(data[p:p + n], data[q:q + n])
    return equal


def first_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A flag per word: it is the one of its kind that holds a slot of its row's hash table.

    The tables of all rows share one array (the row is part of the key). All words probe in step: the
    first to reach an empty slot takes it, equal words of the row are found there, others move on.
    """
    lengths = ends - starts
    key = mix(word_hashes(data, starts, ends) + mix(rows.astype(np.uint64) + np.uint64(1)))
    mask = np.uint64((1 << max(4, int(2 * len(starts)).bit_length())) - 1)
    table = np.full(int(mask) + 1, -1, dtype=np.int64)
    slot, step = key & mask, (key >> np.uint64(32)) | np.uint64(1)
    holds = np.zeros(len(starts), dtype=bool)
    left = np.arange(len(starts))
    while len(left):
        at = slot[left].astype(np.int64)
        free = table[at] < 0
        table[at[free]] = left[free]
        owner = table[at]
        mine = owner == left
        holds[left[mine]] = True
        maybe = ~mine & (rows[owner] == rows[left]) & (lengths[owner] == lengths[left])
        seen = np.zeros(len(left), dtype=bool)
        seen[maybe] = same_words(data, starts, lengths, left[maybe], owner[maybe])
        left = left[~(mine | seen)]
        slot[left] = (slot[left] + step[left]) & mask
    return holds


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """n_words, n_distinct, n_capitals, n_code_points and n_symbols of every text; null: empty."""
    data, offsets = text_buffer(column)
    n = len(offsets) - 1
    full = np.flatnonzero(np.diff(offsets) > 0)
    counts = {name: np.zeros(n, dtype=np.int64) for name in
              ("n_words", "n_distinct", "n_capitals", "n_code_points", "n_symbols")}
    if len(full) == 0:
        return counts
    after = AFTER[GAP][data]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[offsets[:-1][full]] = GAP
    out = OUT.ravel()[before.astype(np.uint16) * 256 + data]
    first = offsets[:-1][full]
    for name, bit in (("n_words", OPENS), ("n_capitals", CAPITAL), ("n_code_points", CODE_POINT), ("n_symbols", SYMBOL)):
        counts[name][full] = np.add.reduceat((out & bit) != 0, first, dtype=np.int64)
    starts = np.flatnonzero(out & OPENS)
    closed = np.zeros(len(data) + 1, dtype=bool)
    closed[:-1] = (out & CLOSES) != 0
    last = offsets[1:][full]
    closed[last[after[last - 1] == WORD]] = True
    ends = np.flatnonzero(closed)
    rows = np.repeat(np.arange(n), counts["n_words"])
    if len(starts):
        counts["n_distinct"] = np.bincount(rows[first_words(data, starts, ends, rows)], minlength=n)
    return counts


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask) of every row; bits 0 to 3 of the mask are filters A to D. No shuffle."""
    schema = "doc_id bigint, part string, digest binary, mask int"

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "text"):
                c = text_counts(p.column(3))
                mask = ((c["n_words"] < MIN_WORDS) * 1
                        + (100 * c["n_distinct"] < MIN_DISTINCT_PERCENT * c["n_words"]) * 2
                        + (100 * c["n_capitals"] > MAX_CAPITAL_PERCENT * c["n_code_points"]) * 4
                        + (c["n_symbols"] > 0) * 8)
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1), p.column(2), pa.array(mask, pa.int32())],
                                                 ["doc_id", "part", "digest", "mask"])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text")).mapInArrow(run, schema)


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang", label_id: str = "doc_id", good_col: str = "quality",
                toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents per part and set of failed filters (bit 4 is filter E).

    A row without an id is neither later nor earlier than any other, so E never fails it, and it has no
    labels. Rows of one id and text count singly and stand or fall together. A document with several
    labels is good (toxic) if any of them says so. Empty table: no rows.
    """
    rows = failed_filters(docs, id_col, text_col, part_col).groupBy("doc_id", "part", "digest", "mask").agg(
        F.count("*").alias("n"))
    flag = lambda c: F.max(F.when(F.col(f"`{c}`") == 1, 1).otherwise(0))
    marks = staged(labels.where(F.col(f"`{label_id}`").isNotNull())
                   .groupBy(F.col(f"`{label_id}`").cast("bigint").alias("id"))
                   .agg(flag(good_col).alias("good"), flag(toxic_col).alias("toxic")).where("good + toxic > 0"), "marks")
    # rows without an id meet no label: dealt by their text, not by one key
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("bigint"))
    marked = (rows.withColumn("spread", spread)
              .join(marks.select(F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("spread"), "good", "toxic"),
                    ["doc_id", "spread"], "left").fillna(0, ["good", "toxic"]))
    kinds = (marked.groupBy("digest", "part", "mask", "good", "toxic")
             .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
                  F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")))
    lowest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    stay = F.col("n_null") + F.when(F.col("first.doc_id") == lowest, F.col("first.n")).otherwise(0)
    split = kinds.select("part", "mask", "good", "toxic", "n", stay.alias("stay")).select(
        "part", "good", "toxic", F.inline(F.array(F.struct(F.col("mask"), F.col("stay").alias("n")),
                                                  F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("stay")).alias("n")))))
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"),
        F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"))


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, filter order and step: what the step's filter does there.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley. `columns` and the treatment of nulls, ties and repeats are those of `mask_counts`. In a
    document that fails k filters each of them comes first in 1/k of the orders, which gives shapley
    without a sum over orders. Null parts are the part ''. Empty table: no rows.
    """
    counts = staged(mask_counts(docs, labels, **columns), "masks")
    orders = ",".join("".join(p) for p in permutations(FILTERS))
    steps = (counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
             .withColumn("bit", F.expr("shiftleft(1, ascii(substring(filter_order, step, 1)) - 65)"))
             .withColumn("before", F.expr("aggregate(filter(split(substring(filter_order, 1, step - 1), ''), x -> x <> ''), "
                                          "0, (a, x) -> a | shiftleft(1, ascii(x) - 65))")))
    total = lambda value, when: F.expr(f"sum(CASE WHEN {when} THEN {value} ELSE 0 END)")
    fails, earlier = "mask & bit <> 0", "mask & before <> 0"
    removed = f"{fails} AND NOT {earlier}"
    n_orders = len(orders.split(","))
    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", "mask & (before | bit) = 0").alias("kept"), total("n", removed).alias("removed"),
        total("n", f"{fails} AND {earlier}").alias("redundant"), total("n", "mask = bit").alias("unique_fails"),
        total("n_good", removed).alias("good_lost"), total("n_toxic", removed).alias("toxic_lost"),
        total(f"n * CAST({n_orders} / bit_count(mask) AS bigint)", fails).alias("shapley"))

