"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword. One binary classifier per bit (a linear log-odds model over hashed n-grams)
predicts that bit of the codeword; decoding weighs each bit by its logistic loss and chooses the codeword with
the smallest total. The n-gram counts behind the classifiers are summed over all training rows in Spark. They pass
the driver one language at a time, where they are added to the classifiers of their codeword's bits; the model is
bits x buckets weights and languages x bits codewords, of one byte each.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.stage import dropped, staged
from ruleweave.llm.textbatch import MIX_2, pieces, text_buffer

#: Hash buckets of the n-gram counts, and the n-gram lengths in bytes.
BUCKETS, ORDERS = 1 << 13, (2, 3, 4)
#: Up to this many languages have rows of a Hadamard matrix as codewords, further ones hashed words of this many bits.
HADAMARD, HASHED_BITS = 128, 511
#: Entries of the rows x languages losses that are decoded at once, and sums that a learning task holds at once.
_LOSSES, _SUMS = 1 << 22, 256
#: Two codewords whose decoded probability differs by less are ambiguous.
MARGIN = 0.2
_U = np.uint64
# Lower-cases A-Z and turns digits, ASCII punctuation and controls into spaces: they say nothing of a language.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def _buckets(data: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte (the last order - 1 bytes have none)."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.full(n, order, _U)
    for i in range(order):
        key = (key << _U(8)) | data[i:n + i]
    return ((key * _U(MIX_2)) >> _U(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def ngram_counts(column: pa.Array) -> np.ndarray:
    """rows x BUCKETS counts of all n-grams of each whole text."""
    data, offsets = text_buffer(column)
    data = _FOLD[data]
    out = np.zeros((len(column), BUCKETS), np.float32)
    for order in ORDERS:
        at = _buckets(data, order)
        for i in range(len(column)):
            part = at[offsets[i]:max(offsets[i], offsets[i + 1] - order + 1)]
            if len(part):
                out[i] += np.bincount(part, minlength=BUCKETS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """n x bits codewords of -1 and 1: every split of the languages up to 7 of them, rows of a Hadamard matrix up to
    HADAMARD, else hashed words. Among 100,000 of those, any two differ in about 180 bits or more of 511."""
    if n <= 2:
        return np.array([[1], [-1]], np.int8)[:n]
    if n <= 7:
        splits = [s for s in itertools.product((1, -1), repeat=n) if s[0] > 0 and -1 in s]
        return np.array(splits, np.int8).T
    if n <= HADAMARD:
        h = np.ones((1, 1), np.int8)
        while len(h) < 2 * n:
            h = np.block([[h, h], [h, -h]])
        return h[:n, 1:]
    words = np.random.default_rng(HASHED_BITS).integers(0, 2, (n, HASHED_BITS), np.int8) * np.int8(2) - np.int8(1)
    words[0] = 1            # every bit has a language on its side of 1
    return words


class LanguageModel:
    """Codewords and per-bit linear weights learned from the n-gram counts of each language, in order."""

    def __init__(self, languages: list[str], counts: Iterable[np.ndarray]):
        self.languages = languages
        self.code = codewords(len(languages))
        bits = self.code.shape[1] if languages else 0
        plus, minus, every = np.zeros((bits, BUCKETS)), np.zeros((bits, BUCKETS)), np.zeros(BUCKETS)
        # each language counts alike on its side, however many rows it has
        for word, row in zip(self.code, counts):
            share = (row + 0.5) / (row.sum() + 0.5 * BUCKETS)
            plus[word > 0] += share
            minus[word < 0] += share
            every += share
        if languages:
            on = (self.code > 0).sum(axis=0)[:, None]
            off = len(languages) - on
            minus = np.where(off > 0, minus / np.maximum(off, 1), every / len(languages))
            self.weights = (np.log(plus / on) - np.log(minus)).astype(np.float32).T
        else:
            self.weights = np.zeros((BUCKETS, 0), np.float32)

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, probability, ambiguous) per row of counts.

        A bit's margin is its mean evidence per n-gram, scaled by the root of their number, so that long
        texts are surer than short ones without drowning the other bits. The rows' losses against all
        codewords are two matrix products, taken for some rows at a time where languages are many.
        """
        step = max(1, _LOSSES // max(1, len(self.code)))
        parts = [self._decode(counts[i:i + step]) for i in range(0, max(1, len(counts)), step)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        margin = (counts @ self.weights / np.sqrt(size)).astype(np.float64)
        ones = (self.code.T > 0).astype(np.float64)
        loss = np.logaddexp(0, -margin) @ ones + np.logaddexp(0, margin) @ (1 - ones)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        first = p.max(axis=1)
        second = np.partition(p, -2, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
        return best, first, first - second < MARGIN


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel:
    """Learn from all rows with a language and a text; counts are summed per language and bucket in Spark.

    Any number of languages can be learned. Null languages and texts, and texts without
    an n-gram, teach nothing; an empty table learns no language.
    """
    def flushed(sums):
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))],
                ["lang", "bucket", "n"])

    def run(batches):
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for part in pieces(batch, "text", 1 << 18, 512):
                counts = ngram_counts(part.column(1))
                langs = np.array(part.column(0).to_pylist())
                for lang in np.unique(langs).tolist():
                    sums[lang] = sums.get(lang, 0) + counts[langs == lang].sum(axis=0, dtype=np.float64)
                if len(sums) > _SUMS:
                    yield from flushed(sums)
                    sums = {}
            yield from flushed(sums)

    source = rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    sums = source.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = staged(sums.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("n")),
                   "languages")

    def counts():
        for row in table.orderBy("lang").toLocalIterator():
            out = np.zeros(BUCKETS)
            out[list(row["n"])] = list(row["n"].values())
            yield out

    languages = [r["lang"] for r in table.select("lang").orderBy("lang").collect()]
    model = LanguageModel(languages, counts())
    dropped(table)
    return model


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: (doc_id, lang_pred, score, ambiguous).

    `und` with score 0 if the text is null or has no letter, or if no language was learned. Repeated rows get
    equal results; a null doc_id stays null; other columns are ignored. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own: LanguageModel = shared.value
        for batch in batches:
            for part in pieces(batch, "text", 1 << 18, 512):
                texts = part.column(1)
                letters = np.array([has_letter(t.as_py()) for t in texts], bool)
                if own.languages:
                    best, score, unsure = own.decode(ngram_counts(texts))
                else:
                    letters[:] = False
                    best, score, unsure = (np.zeros(len(texts), int) for _ in range(3))
                names = [own.languages[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0).astype(float)),
                     pa.array(np.where(letters, unsure, True).astype(bool))], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")


def held_out(id_col: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row, learned from the rows not held out.

    Rows with a null id or language are predicted, but not learned from.
    """
    key = F.col(f"`{id_col}`")
    model = learn(docs.where(key.isNotNull() & ~held_out(key)), lang_col, text_col)
    return predict(docs, model, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
