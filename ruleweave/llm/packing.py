"""Token-id packing: documents tokenized, split losslessly, and packed best-fit-decreasing into rows of fixed length.

Each task packs its own partition in chunks of bounded tokens, so nothing is shuffled and memory does not
depend on the partition's size. Pieces of full length are rows by themselves; the others are placed, longest
first, into the open row with the least room that still fits, found by a segment tree over room sizes.

Every output row is one row of a packed id matrix, in little-endian binary columns: the ids, and position ids
that start again from 0 at each segment; beside them the cumulative segment lengths, and for each segment its
document and where in the document's tokens it starts.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public splitting pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_TOKENS = 2048
#: Tokens that a task holds before it packs them.
CHUNK_TOKENS = 1 << 21
_ROWS_AT_ONCE = 256
SCHEMA = ("shard int, row bigint, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
          "doc_ids array<bigint>, token_starts array<bigint>")


def read_vocabulary(path: str) -> bytes:
    """The rank file's bytes (about a megabyte), read once at the driver and broadcast."""
    with open(path, "rb") as f:
        return f.read()


def encoding(vocabulary: bytes) -> tiktoken.Encoding:
    """Special tokens' strings are ordinary text; the first id past the ranks ends a document."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class RoomTree:
    """A segment tree over room sizes 0..limit that counts open rows, to find the least room of at least n."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(limit + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = self.size + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, its room) of an open row with the least room of at least `need`, removed from the tree."""
        at = self.size + need
        while not self.count[at]:
            # climb to the next subtree on the right
            while at & 1:
                at >>= 1
            if at <= 1:
                return None
            at += 1
        while at < self.size:
            at <<= 1
            if not self.count[at]:
                at += 1
        room = at - self.size
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return row, room


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Rows of piece numbers, each of at most `limit` tokens; equal lengths keep their order."""
    tree, rows = RoomTree(limit), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[piece])
        found = tree.take(n) if n < limit else None
        if found is None:
            rows.append([piece])
            row, room = len(rows) - 1, limit
        else:
            row, room = found
            rows[row].append(piece)
        if room > n:
            tree.add(room - n, row)
    return rows


def _packed(pieces: list[tuple[int | None, int, np.ndarray]], limit: int, end_id: int, kind: str, shard: int, first: int):
    rows = best_fit_decreasing(np.array([len(p[2]) for p in pieces]), limit)
    for at in range(0, len(rows), _ROWS_AT_ONCE):
        part = rows[at:at + _ROWS_AT_ONCE]
        ids = np.full((len(part), limit), end_id, kind)
        positions = np.zeros((len(part), limit), kind)
        bounds, used = [], []
        for i, row in enumerate(part):
            ends = np.cumsum([len(pieces[p][2]) for p in row])
            bounds.append([0, *ends.tolist()])
            used.append(int(ends[-1]))
            for p, a, b in zip(row, bounds[-1], bounds[-1][1:]):
                ids[i, a:b] = pieces[p][2]
                positions[i, a:b] = np.arange(b - a)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard] * len(part), pa.int32()), pa.array(range(first + at, first + at + len(part)), pa.int64()),
             pa.array(used, pa.int32()), pa.array([r.tobytes() for r in ids], pa.binary()),
             pa.array([r.tobytes() for r in positions], pa.binary()), pa.array(bounds, pa.list_(pa.int32())),
             pa.array([[pieces[p][0] for p in row] for row in part], pa.list_(pa.int64())),
             pa.array([[pieces[p][1] for p in row] for row in part], pa.list_(pa.int64()))],
            ["shard", "row", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "token_starts"])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         row_tokens: int = ROW_TOKENS, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Packed rows of `row_tokens` ids: see the module; columns as in SCHEMA.

    Every text is followed by the end id (the first id past the vocabulary), which also pads rows past
    n_tokens. Ids and positions take two bytes each, or four for vocabularies or rows past 65,536. A null or
    empty text has no tokens and no segment. A null id is a null in doc_ids. Repeated rows are packed as often
    as they occur. Rows are numbered within their shard (the task's partition). Empty table: no rows.
    """
    spark: SparkSession = docs.sparkSession
    raw = read_vocabulary(vocabulary)
    end_id = encoding(raw).max_token_value + 1
    kind = "<u2" if max(end_id, row_tokens - 1) < 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(raw)

    def run(batches):
        encode = encoding(shared.value).encode_ordinary
        shard = TaskContext.get().partitionId()
        held, tokens, done = [], 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                ids = np.array([*encode(text), end_id], kind)
                name = doc_id.as_py()
                held += [(name, a, ids[a:a + row_tokens]) for a in range(0, len(ids), row_tokens)]
                tokens += len(ids)
                if tokens >= chunk_tokens:
                    first = done
                    for out in _packed(held, row_tokens, end_id, kind, shard, first):
                        done += out.num_rows
                        yield out
                    held, tokens = [], 0
        if held:
            yield from _packed(held, row_tokens, end_id, kind, shard, done)

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, SCHEMA)
