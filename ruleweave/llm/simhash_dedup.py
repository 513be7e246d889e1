"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is cut into 32 segments of two bits. The vector of segment popcounts embeds it
in a grid where the Manhattan distance never exceeds the Hamming distance. Two points at Manhattan
distance 2 or less share a grid point at distance 1 or less of both, so every distinct fingerprint is
dealt to its own grid point and the ones next to it (49 on average) and joined there by equality;
pairs are then verified by their exact Hamming distance. Grid points with many fingerprints are not
paired off: there, members are grouped by the single-bit neighbours that fall on the grid point
(equal neighbours prove a distance of two or less), which is linear in the members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.components import connected_components
from ruleweave.llm.stage import dropped, set_aside, staged
from ruleweave.llm.textbatch import LOWER, WHITESPACE_WORDS, pieces, text_buffer, word_bounds

#: The grid covers this Hamming distance (a midpoint argument: one step from either side).
MAX_BITS = 2
#: Above this many fingerprints on a grid point, members meet over single-bit neighbours instead of in pairs.
CROWDED = 32
_HASHES_AT_ONCE = 1 << 18


def simhash_rows(column: pa.Array, shingle: int) -> np.ndarray:
    """The fingerprint (int64) of every text: per bit, the majority over XXH64 (seed 42) of its shingles."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets, WHITESPACE_WORDS)
    lengths = ends - starts
    to = np.cumsum(lengths + 1) - (lengths + 1)
    plain = np.full(int((lengths + 1).sum()), 32, dtype=np.uint8)
    inside = np.flatnonzero(WHITESPACE_WORDS[data])
    plain[inside + np.repeat(to - starts, lengths)] = data[inside]
    text = plain.tobytes()
    n_words = np.diff(rows)
    counts = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    row_of = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(rows[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(len(row_of))
    last = first + np.repeat(np.minimum(n_words, shingle), counts) - 1
    begin, end = to[first].tolist(), (to + lengths)[last].tolist()
    digest = xxhash.xxh64_intdigest
    sums = np.zeros((len(counts), 64), dtype=np.int64)
    for at in range(0, len(begin), _HASHES_AT_ONCE):
        to_at = at + _HASHES_AT_ONCE
        h = np.array([digest(text[s:e], 42) for s, e in zip(begin[at:to_at], end[at:to_at])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        part = row_of[at:to_at]
        edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sums[part[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    return np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; text_hash tells rows of one doc_id apart. Null text: empty, fp 0."""
    schema = "doc_id bigint, text_hash bigint, fp bigint"

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1),
                     pa.array(simhash_rows(part.column(2), shingle), pa.int64())], ["doc_id", "text_hash", "fp"])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(run, schema)


# Even bits of a bigint, and of it the lowest.
_EVEN = 0x5555555555555555


def _popcounts(fp: str) -> str:
    """SQL: the counts (0..2) of all two-bit segments, two bits each, in one bigint."""
    low, high = f"({fp} & {_EVEN}L)", f"(shiftrightunsigned({fp}, 1) & {_EVEN}L)"
    return f"(shiftleft({low} & {high}, 1) | ({low} ^ {high}))"


def grid_points(reps: DataFrame) -> DataFrame:
    """(cell, fp, step): each fingerprint at its grid point (step 64) and at those one step away.

    Steps 0..31 change a count between 0 and 1 (xor 01), steps 32..63 between 1 and 2 (xor 11).
    """
    return (reps.select("fp", F.expr(_popcounts("fp")).alias("home"))
            .select("fp", "home", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("step"))
            .withColumn("count", F.expr("shiftrightunsigned(home, 2 * (step % 32)) & 3L"))
            .where("step = 64 OR (step < 32 AND count < 2) OR (step >= 32 AND step < 64 AND count > 0)")
            .select(F.expr("CASE WHEN step = 64 THEN home WHEN step < 32 THEN home ^ shiftleft(1L, 2 * step) "
                           "ELSE home ^ shiftleft(3L, 2 * (step - 32)) END").alias("cell"), "fp", "step"))


def hamming_links(reps: DataFrame) -> DataFrame:
    """(u, v): links between distinct fingerprints with at most two differing bits.

    Every such pair is connected: directly where its grid point is not crowded, else through the
    smallest fingerprint around a common single-bit neighbour, itself within two bits of both.
    """
    # 65 steps a fingerprint: spread over the session's partitions before they multiply; on a staged table, as
    # after an aggregate by fingerprint Spark would drop the shuffle and run on as few tasks as eight-byte rows fill
    points = grid_points(reps.repartition(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp"))
    crowd = points.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    # never broadcast: Spark sizes what is exploded as before it multiplied, and staged fingerprints as they are packed
    shared = staged(points.hint("merge").join(crowd, "cell"), "grid")
    few = shared.where(F.col("n") <= CROWDED).select("cell", "fp")
    pairs = (few.hint("merge").alias("a").join(few.alias("b"), F.expr("a.cell = b.cell AND a.fp < b.fp"))
             .where(F.expr(f"bit_count(a.fp ^ b.fp) <= {MAX_BITS}"))
             .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    around = (shared.where(F.col("n") > CROWDED)
              .select("cell", "fp", F.explode(F.expr(
                  "CASE WHEN step = 64 THEN array(fp) ELSE array(fp ^ shiftleft(1L, 2 * (step % 32)), "
                  "fp ^ shiftleft(1L, 2 * (step % 32) + 1)) END")).alias("near"))
              .where(F.expr(f"{_popcounts('near')} = cell")).select("near", "fp"))
    hubs = around.groupBy("near").agg(F.min("fp").alias("hub"), F.count("*").alias("k")).where("k > 1")
    stars = around.hint("merge").join(hubs, "near").where("fp <> hub").select(F.col("hub").alias("u"), F.col("fp").alias("v"))
    return pairs.unionByName(stars).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document row: (doc_id, text_hash, fp, component_id).

    component_id is the smallest doc_id reachable over links, itself included. Null or empty texts
    have fingerprint 0 and link like any other. Repeated rows get equal results. A null doc_id takes
    part in links, but is never a component_id unless all of its group are null. Empty table: no rows.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"the grid is built for {MAX_BITS} bits")
    marks = staged(fingerprints(docs, id_col, text_col, shingle), "simhash")
    reps = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    roots = connected_components(hamming_links(reps))
    linked = reps.join(roots, F.col("fp") == F.col("node")).select("fp", "rep", "root")
    low = linked.groupBy("root").agg(F.min("rep").alias("low"))
    linked = linked.join(low, "root").select("fp", "low")
    # staged, so that both sides of the last join are plain shuffles and a fingerprint of many copies can be split
    whole = staged(reps.join(linked, "fp", "left").select("fp", F.coalesce("low", "rep").alias("component_id")), "groups")
    return marks.join(whole, "fp").select("doc_id", "text_hash", "fp", "component_id")


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay: of each group the row with the smallest doc_id (then text hash), once.

    All columns are returned as they came, whatever their names. Null doc_ids come after all others.
    """
    docs, back, (id_col, text_col) = set_aside(docs, options.pop("id_col", "doc_id"), options.pop("text_col", "text"))
    groups = simhash_groups(docs, id_col=id_col, text_col=text_col, **options)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "fp")
    group = F.coalesce(F.col("component_id"), F.col("fp"))
    first = (groups.groupBy(F.col("component_id").isNull().alias("none"), group.alias("g"))
             .agg(F.min(order).alias("first"))
             .select(F.col("first.doc_id").alias("_rw_id"), F.col("first.text_hash").alias("_rw_hash")))
    copies = groups.groupBy("doc_id", "text_hash").agg(F.count("*").alias("_rw_n")).select(
        F.col("doc_id").alias("_rw_id2"), F.col("text_hash").alias("_rw_hash2"), "_rw_n")
    keys = staged(first.join(copies, F.col("_rw_id").eqNullSafe(F.col("_rw_id2"))
                             & (F.col("_rw_hash") == F.col("_rw_hash2"))).select("_rw_id", "_rw_hash", "_rw_n"), "kept")
    names = docs.columns
    mine = docs.withColumn("_rw_key", F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    kept = mine.join(keys, F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col("_rw_id"))
                     & (F.col("_rw_key") == F.col("_rw_hash")))
    plain = [F.col(f"`{c}`") for c in names]
    once = kept.where("_rw_n = 1").select(*plain)
    if keys.where("_rw_n > 1").isEmpty():
        return back(once)
    again = kept.where("_rw_n > 1").dropDuplicates(["_rw_id", "_rw_hash"]).select(*plain)
    return back(once.unionByName(again))
