"""Whole-batch text work over Arrow buffers: word bounds and rolling hashes without a Python loop per word.

A batch is cut into pieces of bounded bytes first, so memory per task does not depend on the
number of rows in an Arrow batch. All functions treat a null text as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (a longer text is handled alone).
PIECE_BYTES = 1 << 20

_M = np.uint64
# Odd multipliers of the rolling hashes and of the 64-bit finalizer (MurmurHash3, public domain).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX_1, MIX_2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def lut_from_pattern(separators: bytes) -> np.ndarray:
    """256 flags: True where a byte belongs to a word, i.e. is not one of the separators."""
    lut = np.ones(256, dtype=bool)
    lut[list(separators)] = False
    return lut


#: Words `[^\x20\x09-\x0D]+`.
WHITESPACE_WORDS = lut_from_pattern(b" \t\n\x0b\x0c\r")
#: Words of a-z, 0-9 and every non-ASCII character, once A-Z is lower-cased.
ALNUM_WORDS = lut_from_pattern(bytes(b for b in range(128) if not (chr(b).isalnum())))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes of text (or one row) and `rows` rows each."""
    if batch.num_rows == 0:
        return
    _, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, row offsets from 0)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, word ends, per-row offsets into them); words never cross rows."""
    inside = lut[data]
    size = len(data)
    first = np.zeros(size + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(size, dtype=bool)
    if size:
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.zeros(size, dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept up to a piece's length)."""
    key = (base, 1 << max(10, int(n - 1).bit_length()))
    if key not in _POWERS:
        p = np.full(key[1], base, dtype=_M)
        p[0] = 1
        with np.errstate(over="ignore"):
            p = np.cumprod(p, dtype=_M)
        if key[1] > 4 * PIECE_BYTES:
            return p[:n]
        _POWERS[key] = p
    return _POWERS[key][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _M(33))
    h = h * _M(MIX_1)
    h ^= h >> _M(33)
    h = h * _M(MIX_2)
    return h ^ (h >> _M(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: a polynomial over its bytes, finalized with its length.

    Works through the words in runs of bounded bytes, so one very long text needs 8 bytes a word.
    """
    out = np.empty(len(starts), dtype=_M)
    inverse = pow(BYTE_BASE, -1, 1 << 64)
    at = 0
    while at < len(starts):
        low = starts[at]
        end = max(at + 1, int(np.searchsorted(ends, low + PIECE_BYTES, side="right")))
        part = data[low:ends[end - 1]]
        run = np.zeros(len(part) + 1, dtype=_M)
        np.cumsum((part.astype(_M) + _M(1)) * powers(BYTE_BASE, len(part)), dtype=_M, out=run[1:])
        s, e = starts[at:end] - low, ends[at:end] - low
        h = (run[e] - run[s]) * powers(inverse, len(part))[s]
        out[at:end] = mix(h ^ ((e - s).astype(_M) * _M(MIX_2)))
        at = end
    return out


def window_hashes(words: np.ndarray, k: int, base: int = WORD_BASES[0]) -> np.ndarray:
    """A 64-bit hash of every k consecutive words (over the whole array; the caller drops those that cross rows)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_M)
    run = np.zeros(len(words) + 1, dtype=_M)
    np.cumsum(words * powers(base, len(words)), dtype=_M, out=run[1:])
    return mix((run[k:] - run[:n]) * powers(pow(base, -1, 1 << 64), n))


def window_rows(word_offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, start word within the batch) of every k-word window that stays within its row."""
    counts = np.maximum(np.diff(word_offsets) - k + 1, 0)
    total = int(counts.sum())
    rows = np.repeat(np.arange(len(counts)), counts)
    base = np.repeat(word_offsets[:-1] - (np.cumsum(counts) - counts), counts)
    return rows, base + np.arange(total)
