"""Benchmark decontamination with SimHash over item-sized windows.

Texts and benchmark items are cut into lower-cased words. For every item, the windows of a document with
the item's number of words get a 64-bit SimHash of their word shingles; a multi-index over eight 8-bit
blocks finds every item fingerprint within the radius (if at most r of 64 bits differ, some block differs
in at most r // 8), and the weighted (multiset) Jaccard similarity of the shingles verifies each candidate
exactly. A window that shares no shingle with an item has similarity 0, so windows are fingerprinted only
around words where a benchmark shingle occurs; this loses nothing and leaves clean text at one hash a word.
A document of fewer words than an item is one window, all of it, and is verified without the fingerprints.

The benchmark is held in blocks of items; each block is a bounded broadcast and one more pass.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.stage import set_aside, staged
from ruleweave.llm.textbatch import (ALNUM_WORDS, LOWER, pieces, text_buffer, window_hashes, word_bounds,
                                     word_hashes)

#: Characters of benchmark text in one broadcast block.
BLOCK_CHARS = 1_000_000
SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
_BLOCKS = 8
#: Windows fingerprinted at once (256 bytes each).
_WINDOWS_AT_ONCE = 1 << 16


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, with A-Z and the accented capitals of Latin-1 lower-cased."""
    data = LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[accented] += 0x20
    starts, ends, rows = word_bounds(data, offsets, ALNUM_WORDS)
    return word_hashes(data, starts, ends), rows


def _simhash(bits: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all runs of `size` consecutive shingles; bits: their 64 hash bits each."""
    run = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=run[1:])
    return np.packbits(2 * (run[size:] - run[:-size]) > size, axis=1, bitorder="little").view("<u8").ravel()


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


class ItemIndex:
    """The items of one block: shingles by length of shingle, and a multi-index of fingerprints by window length."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, radius: int):
        self.shingle, self.radius = shingle, radius
        texts = pa.array([t for _, t in items], pa.string())
        words, rows = _words(*text_buffer(texts))
        self.by_length: dict[int, dict] = {}
        every = defaultdict(list)
        patterns = [sum(1 << b for b in c) for n in range(radius // _BLOCKS + 1)
                    for c in itertools.combinations(range(8), n)]
        for (item_id, _), a, b in zip(items, rows[:-1], rows[1:]):
            n = int(b - a)
            if not n:
                continue
            k = min(shingle, n)
            h = window_hashes(words[a:b], k)
            entry = self.by_length.setdefault(n, {"k": k, "items": [], "fps": [], "hashes": [], "index": defaultdict(list)})
            at = len(entry["items"])
            fp = int(_simhash(_bits(h), len(h))[0])
            entry["items"].append((item_id, Counter(h.tolist())))
            entry["fps"].append(fp)
            entry["hashes"].append(h)
            for i in range(_BLOCKS):
                for p in patterns:
                    entry["index"][i, (fp >> 8 * i & 255) ^ p].append(at)
            every[k].append(h)
        for entry in self.by_length.values():
            entry["fps"] = np.array(entry["fps"], np.uint64)
            entry["hashes"] = np.stack(entry["hashes"])     # a row of shingles per item
            entry["index"] = {key: np.array(v) for key, v in entry["index"].items()}
            # per block: the items that each of the 256 values may belong to, as bit rows
            entry["table"] = np.zeros((_BLOCKS, 256, -(-len(entry["items"]) // 8)), np.uint8)
            for (i, value), at in entry["index"].items():
                row = np.zeros(len(entry["items"]), np.uint8)
                row[at] = 1
                entry["table"][i, value] = np.packbits(row, bitorder="little")
            del entry["index"]
        self.shingles = {k: np.unique(np.concatenate(v)) for k, v in every.items()}

    def candidates(self, fps: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs with at most `radius` differing bits."""
        entry = self.by_length[n]
        may = np.zeros((len(fps), entry["table"].shape[2]), np.uint8)
        for i in range(_BLOCKS):
            may |= entry["table"][i][(fps >> np.uint64(8 * i)) & np.uint64(255)]
        window, item = np.nonzero(np.unpackbits(may, axis=1, bitorder="little"))
        near = np.bitwise_count(fps[window] ^ entry["fps"][item]) <= self.radius
        return window[near], item[near]

    def search(self, words: np.ndarray, hits: dict[int, np.ndarray], threshold: float):
        """(item_id, start word, words, similarity) of the best window per item in one document."""
        found: dict[int, tuple] = {}
        for n, entry in self.by_length.items():
            k = entry["k"]
            if k not in hits:
                continue
            size = n - k + 1
            if n > len(words):
                similar = self._whole(words, len(hits[k]), entry, size, threshold)
            else:
                similar = self._windows(words, hits[k], n, size)
            for item_id, start, n_words, similarity in similar:
                best = found.get(item_id)
                if similarity >= threshold and (best is None or similarity > best[3]):
                    found[item_id] = (item_id, start, n_words, similarity)
        return [found[x] for x in sorted(found)]

    def _windows(self, words: np.ndarray, hits: np.ndarray, n: int, size: int):
        """The windows of n words near an item in fingerprint, with their similarity."""
        entry = self.by_length[n]
        for low, high in _ranges(hits, size, len(words) - n):
            h = window_hashes(words[low:high + n], entry["k"])
            for w, i in zip(*self.candidates(_simhash(_bits(h), size), n)):
                item_id, shingles = entry["items"][i]
                yield item_id, int(low + w), n, overlap(Counter(h[w:w + size].tolist()), shingles)

    @staticmethod
    def _whole(words: np.ndarray, n_hits: int, entry: dict, size: int, threshold: float):
        """A document shorter than the items as the one window. Similarity is at most the share of an item's
        shingles that the document has, so only items with enough of them are compared."""
        if n_hits / size < threshold:
            return
        h = window_hashes(words, entry["k"])
        own = Counter(h.tolist())
        for i in np.flatnonzero(np.isin(entry["hashes"], h).sum(axis=1) / size >= threshold):
            item_id, shingles = entry["items"][i]
            yield item_id, 0, len(words), overlap(own, shingles)


def _ranges(hits: np.ndarray, size: int, last: int):
    """Merged ranges of window starts whose windows hold a hit, cut to bounded length."""
    for low, high in _merged(hits, size, last):
        for at in range(low, high + 1, _WINDOWS_AT_ONCE):
            yield at, min(high, at + _WINDOWS_AT_ONCE - 1)


def _merged(hits: np.ndarray, size: int, last: int):
    low = None
    for hit in hits.tolist():
        a, b = max(0, hit - size + 1), min(hit, last)
        if a > b:
            continue
        if low is not None and a <= high + 1:
            high = max(high, b)
        else:
            if low is not None:
                yield low, high
            low, high = a, b
    if low is not None:
        yield low, high


def _scan(index, threshold: float):
    def run(batches):
        own: ItemIndex = index.value
        for batch in batches:
            out = []
            for part in pieces(batch, "text"):
                words, rows = _words(*text_buffer(part.column(2)))
                hits: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
                for k, known in own.shingles.items():
                    h = window_hashes(words, k)
                    if not len(h):
                        continue
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    start = np.flatnonzero(known[at] == h)
                    row = np.searchsorted(rows, start, side="right") - 1
                    fits = start + k <= rows[row + 1]
                    start, row = start[fits], row[fits]
                    for r in np.unique(row).tolist():
                        hits[r][k] = start[row == r] - rows[r]
                for r in sorted(hits):
                    row = (part.column(0)[r].as_py(), part.column(1)[r].as_py())
                    out += [(*row, *x) for x in own.search(words[rows[r]:rows[r + 1]], hits[r], threshold)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 5 + [pa.float64()])],
                    ["row_id", "text_hash", "item_id", "start_word", "n_words", "similarity"])
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
                       threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): per document row and item the best window, if similar enough.

    Items of fewer words than a shingle are one shingle and match exactly. A document of fewer words than
    the item is one window, with its own number of words as n_words. Null or empty texts and items
    match nothing; a repeated document row gives repeated results; items may share texts. Of equally
    similar windows the first counts. A null id is carried as null. Empty tables: no rows.
    """
    return _found(docs, benchmark, id_col, text_col, item_col, item_text_col, shingle, threshold, radius).select(
        F.col("row_id").alias("doc_id"), "item_id", "start_word", "n_words", "similarity")


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
           threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("row_id"), F.xxhash64(text).alias("text_hash"),
                         text.alias("text"))
    schema = ("row_id bigint, text_hash bigint, item_id bigint, start_word bigint, n_words bigint, similarity double")
    found = None
    for items in _blocks(benchmark, item_col, item_text_col):
        index = spark.sparkContext.broadcast(ItemIndex(items, shingle, radius))
        part = source.mapInArrow(_scan(index, threshold), schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """The items in blocks of at most BLOCK_CHARS characters (or one item), fetched one block at a time."""
    items, chars = [], 0
    rows = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("i"), F.col(f"`{text_col}`").alias("t")).where(
        "t IS NOT NULL AND t <> ''").distinct().orderBy("i", "t")
    for row in rows.toLocalIterator():
        if items and chars + len(row["t"]) > BLOCK_CHARS:
            yield items
            items, chars = [], 0
        items.append((row["i"], row["t"]))
        chars += len(row["t"])
    if items:
        yield items


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        **options) -> DataFrame:
    """The rows of `docs` without any benchmark item in them, with all columns as they came.

    Rows are told apart by id and text hash, so rows that share an id are judged on their own texts.
    Null and empty texts stay, an empty table gives no rows, extra columns may have any name.
    """
    docs, back, (id_col, text_col) = set_aside(docs, id_col, text_col)
    names = docs.columns
    found = staged(_found(docs, benchmark, id_col, text_col, **options).select(
        F.col("row_id").alias("_rw_id"), F.col("text_hash").alias("_rw_hash")).distinct(), "contaminated")
    keyed = docs.withColumn("_rw_key", F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    same = (F.col("_rw_key") == F.col("_rw_hash")) & F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col("_rw_id"))
    return back(keyed.join(found, same, "left_anti").select(*[F.col(f"`{c}`") for c in names]))
