"""Repeated-passage removal over windows of consecutive words, with a count-min prefilter.

Pass 1 sketches the corpus. A window is counted under its anchor, the smallest hash among its short
word grams; a run of windows with one anchor counts once. Equal windows have equal anchors, so the
merged counters overestimate how often a window occurs and never miss a repeated one, at a few
percent of the rows that counting every window would take. Partition sketches are merged by summing
cells in a shuffle; the cells reached twice or more come back as bitmaps whose size has a fixed bound.
Pass 2 deals out a 96-bit hash of only those windows estimated repeated, groups them exactly, and marks
every window that also starts in a document with a smaller id.

Exact copies would emit all their windows to lose them all; the copies of the most repeated texts
(a bounded broadcast table) are left out of both passes and removed whole: every window of a copy
starts in its first occurrence too. Copies beyond that table take the ordinary way, with equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.stage import dropped, staged
from ruleweave.llm.textbatch import (WHITESPACE_WORDS, WORD_BASES, mix, pieces, text_buffer, window_hashes,
                                     window_rows, word_bounds, word_hashes)

#: Words of the grams among which a window's anchor is chosen.
GRAM = 8
#: Cells per sketch row: eight per expected anchor, up to this power of two (two bitmaps of 128 MB).
#: Beyond, more windows pass the prefilter; the exact grouping takes them all.
MAX_CELL_BITS = 30
#: Texts whose exact copies are removed without windows (32-byte digest and id each).
COPY_TABLE = 50_000
_U = np.uint64


def _anchors(words: np.ndarray, window: int) -> np.ndarray:
    """The smallest gram hash of every window start (over the whole array)."""
    gram = min(GRAM, window)
    low, span, width = window_hashes(words, gram), window - gram + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def _cells(anchor: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of an anchor in each of the two sketch rows (the second row's cells follow the first's)."""
    shift = _U(64 - bits)
    return anchor * _U(WORD_BASES[0]) >> shift, (mix(anchor ^ _U(WORD_BASES[1])) >> shift) + (_U(1) << _U(bits))


def _windows(part: pa.RecordBatch, window: int):
    """(words' hashes, row and start of every window, row offsets in words, anchors by window)."""
    data, offsets = text_buffer(part.column(part.schema.get_field_index("text")))
    starts, ends, rows = word_bounds(data, offsets, WHITESPACE_WORDS)
    words = word_hashes(data, starts, ends)
    row, start = window_rows(rows, window)
    if not len(row):
        return words, row, start, rows, np.zeros(0, _U)
    return words, row, start, rows, _anchors(words, window)[start]


def _sketch(window: int, bits: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                _, row, start, _, anchor = _windows(part, window)
                if not len(row):
                    continue
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
                cell, n = np.unique(np.concatenate(_cells(anchor[new], bits)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(n.astype(np.int64))],
                                                 ["cell", "n"])
    return run


def _suspects(window: int, bits: int, bitmaps):
    def run(batches):
        flags = np.frombuffer(bitmaps.value, np.uint8)

        def reached(cell):
            cell = cell.astype(np.int64)
            return (flags[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for part in pieces(batch, "text"):
                words, row, start, rows, anchor = _windows(part, window)
                if not len(row):
                    continue
                one, two = _cells(anchor, bits)
                hit = np.flatnonzero(reached(one) & reached(two))
                if not len(hit):
                    continue
                row, start = row[hit], start[hit]
                h1 = window_hashes(words, window)[start].view(np.int64)
                h2 = (window_hashes(mix(words ^ _U(WORD_BASES[1])), window, WORD_BASES[1])[start] >> _U(32))
                pos = (start - rows[:-1][row]).astype(np.int32)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2.astype(np.uint32).view(np.int32)), part.column(0).take(row),
                     part.column(1).take(row), pa.array(pos)], ["h1", "h2", "doc_id", "tag", "pos"])
    return run


def _keep(window: int):
    def run(batches):
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            ids, text, copy, cover = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                words = text[i].as_py().encode().split()
                n_words.append(len(words))
                if copy[i].as_py() and len(words) >= window:
                    words = []
                elif cover[i].is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    pos = cover[i].values.to_numpy()
                    np.add.at(edge, pos, 1)
                    np.add.at(edge, pos + window, -1)
                    stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    words = [words[j] for j in stay.tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per document row: (doc_id, n_words, n_removed, kept_text).

    A word goes if a window of `window` words over it also starts in a document with a smaller id.
    Windows are judged on the input texts. Null or empty text: no words, empty kept_text. Rows with
    one doc_id never remove each other's words. A null doc_id neither removes nor loses words. Other
    columns are ignored, whatever their names. Empty table: no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.hash(text).alias("tag"),
                       text.alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    texts = staged(base.where("doc_id IS NOT NULL").groupBy(digest.alias("digest")).agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n"), F.max(F.length("text")).alias("chars")), "texts")
    chars = texts.agg(F.sum(F.col("n") * F.col("chars"))).first()[0] or 0
    bits = min(MAX_CELL_BITS, max(16, int(chars // 16).bit_length()))
    heavy = texts.where("n > 1").orderBy(F.desc(F.col("n") * F.col("chars")), "digest").limit(COPY_TABLE)
    heavy = staged(heavy.select("digest", "first"), "copies")
    marked = base.withColumn("digest", digest).join(F.broadcast(heavy), "digest", "left").select(
        "doc_id", "tag", "text", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).alias("copy"))
    judged = marked.where("doc_id IS NOT NULL AND NOT copy").select("doc_id", "tag", "text")

    # Pass 1: partition sketches, merged; cells reached at least twice.
    cells = judged.mapInArrow(_sketch(window, bits), "cell bigint, n bigint").groupBy("cell").agg(
        F.sum("n").alias("n")).where("n > 1")
    maps = cells.groupBy(F.expr("cell div 32768").alias("block")).agg(
        F.expr("bitmap_construct_agg(cell % 32768)").alias("bits"))
    flags = np.zeros((2 << bits) // 8, np.uint8)
    for row in maps.toLocalIterator():
        part = np.frombuffer(row["bits"], np.uint8)
        flags[row["block"] * 4096:][:4096] = part[:len(flags) - row["block"] * 4096]
    bitmaps = spark.sparkContext.broadcast(flags.tobytes())

    # Pass 2: exact groups of the windows estimated repeated.
    suspects = judged.mapInArrow(_suspects(window, bits, bitmaps),
                                 "h1 bigint, h2 int, doc_id bigint, tag int, pos int")
    groups = staged(suspects.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                    .where("first < last").select("h1", "h2", "first"), "windows")
    cover = staged(suspects.join(groups, ["h1", "h2"]).where("doc_id > first").groupBy("doc_id", "tag").agg(
        F.collect_list("pos").alias("cover")), "cover")
    dropped(texts)
    whole = marked.join(cover, ["doc_id", "tag"], "left").select("doc_id", "text", "copy", "cover")
    return whole.mapInArrow(_keep(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
