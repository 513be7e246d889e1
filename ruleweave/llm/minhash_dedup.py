"""MinHash near-duplicates with b-bit signatures, confirmed on the full shingle sets.

A document's set is its distinct 4-word shingles, as 64-bit hashes. Documents of equal sets form one
class, and classes are linked where their sets are at least 80 % similar:

* 128 minima per set. Bands of four whole minima make candidate classes meet in buckets: of two sets
  of similarity 0.8, one pair in 20 million meets in none of the 32.
* Of each minimum only four bits are kept and packed in bit planes. XOR and a bit count give the
  similarity, corrected for the 1/16 of other minima that agree by chance; clearly lower pairs go.
* What is left is confirmed on the full sets, read again for the classes concerned.

Only the connected groups are wanted, so pairs already connected need no comparison. First all members
of a bucket meet its most central one, then members that are still apart meet each other. Crowded
buckets hand those members to an exact way that does not pair them off: similar sets share a shingle
among their rarest, so they meet over those, again over central members first, and only at places from
where enough shingles are left to share.
"""

from __future__ import annotations

from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.components import connected_components
from ruleweave.llm.stage import dropped, staged
from ruleweave.llm.textbatch import (LOWER, WHITESPACE_WORDS, mix, pieces, text_buffer, window_hashes, window_rows,
                                     word_bounds, word_hashes)

MINIMA = 128
BAND = 4
BITS = 4
#: Buckets with more members than this are not paired off.
CROWDED = 32
#: The share of similar pairs that the signature's estimate may lose.
ESTIMATE_RISK = 1e-12
#: Members of a crowded bucket that meet all others: one, then this many; then all that are still apart.
HUBS = 64
_GOLDEN = 0x9E3779B97F4A7C15


def _constants(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_GOLDEN))


_XOR, _ODD = _constants(MINIMA, 1 << 20), _constants(MINIMA, 1 << 21) | np.uint64(1)
_BANDS = _constants(MINIMA // BAND, 1 << 22)


def most_mismatches(percent: int) -> int:
    """The number of differing minima that sets of that similarity exceed with a chance of ESTIMATE_RISK at most."""
    p = percent / 100 + (1 - percent / 100) / 2 ** BITS
    tail = 0.0
    for same in range(MINIMA + 1):
        tail += comb(MINIMA, same) * p ** same * (1 - p) ** (MINIMA - same)
        if tail > ESTIMATE_RISK:
            return MINIMA - same
    return 0


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per row): the distinct shingles of every text, sorted. Fewer words: the whole sequence."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets, WHITESPACE_WORDS)
    words = word_hashes(data, starts, ends)
    n_words = np.diff(rows)
    row, first = window_rows(rows, shingle)
    parts, of = [window_hashes(words, shingle)[first]], [row]
    for k in range(1, shingle):
        short = np.flatnonzero(n_words == k)
        if len(short):
            parts.append(mix(window_hashes(words, k)[rows[:-1][short]] + np.uint64(k)))
            of.append(short)
    h, row = np.concatenate(parts), np.concatenate(of)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(n_words) + 1))


def minima(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, MINIMA): the smallest value of each hash function over a set; rows must not be empty."""
    out = np.empty((len(offsets) - 1, MINIMA), dtype=np.uint64)
    for i in range(MINIMA if len(out) else 0):
        out[:, i] = np.minimum.reduceat((hashes ^ _XOR[i]) * _ODD[i], offsets[:-1])
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """(rows, bands): a bucket number per band, of its whole minima."""
    key = np.broadcast_to(_BANDS, (len(low), len(_BANDS)))
    for i in range(BAND):
        key = mix(key ^ mix(low[:, i::BAND] + np.uint64(i)))
    return key.view(np.int64)


def packed_bits(low: np.ndarray) -> np.ndarray:
    """(rows, BITS * MINIMA / 64): the low bits of the (mixed) minima, plane by plane."""
    bits = mix(low)
    planes = [np.packbits(((bits >> np.uint64(j)) & np.uint64(1)).astype(np.uint8), axis=1) for j in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


def mismatches(a: str, b: str) -> str:
    """SQL: the number of differing minima of two packed signatures."""
    half = MINIMA // 64
    return " + ".join("bit_count(" + " | ".join(f"({a}[{j * half + i}] ^ {b}[{j * half + i}])" for j in range(BITS)) + ")"
                      for i in range(half))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel().view(np.int64), pa.int64()))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))


def signatures(keyed: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, set_id, n, sig, keys) of every row; set_id is null where there are no words."""
    schema = "doc_id bigint, text_hash bigint, set_id binary, n bigint, sig array<bigint>, keys array<bigint>"

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "text"):
                h, at = shingle_sets(p.column(2), shingle)
                n = np.diff(at)
                full = np.flatnonzero(n)
                low = minima(h, at[np.append(full, len(n))]) if len(full) else minima(h, at[:1])
                raw = h.tobytes()
                ids = [blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None for a, b in zip(at, at[1:])]
                sig, keys = packed_bits(low), band_keys(low)
                has = np.append(0, np.cumsum(n > 0))
                yield pa.RecordBatch.from_arrays(
                    [p.column(0), p.column(1), pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                     _lists(sig, has * sig.shape[1]), _lists(keys, has * keys.shape[1])],
                    ["doc_id", "text_hash", "set_id", "n", "sig", "keys"])

    return keyed.mapInArrow(run, schema)


def _full_sets(keyed: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(set_id, h) of the wanted classes, from the text of one of their documents."""
    rows = classes.join(wanted, "set_id").select("set_id", "row.doc_id", "row.text_hash")
    keys = rows.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "set_id")
    texts = keyed.join(keys, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))).select(
        "set_id", "text")

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "text"):
                h, at = shingle_sets(p.column(1), shingle)
                yield pa.RecordBatch.from_arrays([p.column(0), _lists(h, at)], ["set_id", "h"])

    # copies of the document give the same set again
    return texts.mapInArrow(run, "set_id binary, h array<bigint>").groupBy("set_id").agg(F.max("h").alias("h"))


def _confirmed(pairs: DataFrame, keyed: DataFrame, classes: DataFrame, shingle: int, percent: int,
               full: DataFrame | None = None) -> DataFrame | None:
    """(u, v): the pairs of classes whose full sets are similar; None if the estimate leaves none."""
    pairs = staged(pairs.distinct(), "pairs")
    side = lambda k: classes.select(F.col("set_id").alias(k), F.col("sig").alias(f"sig_{k}"), F.col("n").alias(f"n_{k}"))
    likely = staged(
        pairs.join(side("u"), "u").join(side("v"), "v")
        .where(F.expr(f"100 * least(n_u, n_v) >= {percent} * greatest(n_u, n_v)"))
        .where(F.expr(f"{mismatches('sig_u', 'sig_v')} <= {most_mismatches(percent)}")).select("u", "v", "n_u", "n_v"), "likely")
    dropped(pairs)
    if likely.isEmpty():
        return None
    own = full is None
    if own:
        wanted = likely.select(F.col("u").alias("set_id")).union(likely.select("v")).distinct()
        full = staged(_full_sets(keyed, classes, wanted, shingle), "sets")
    both = (likely.join(full.select(F.col("set_id").alias("v"), F.col("h").alias("h_v")), "v")
            .join(full.select(F.col("set_id").alias("u"), F.col("h").alias("h_u")), "u")
            .select("u", "v", "n_u", "n_v", F.size(F.array_intersect("h_u", "h_v")).cast("bigint").alias("common")))
    links = staged(both.where(F.expr(f"100 * common >= {percent} * (n_u + n_v - common)")).select("u", "v"), "links")
    dropped(likely)
    if own:
        dropped(full)
    return links


def _rooted(roots: DataFrame | None, links: DataFrame | None) -> DataFrame | None:
    """(node, root) of the groups so far, joined by further links."""
    if links is None or links.isEmpty():
        return roots
    known = links if roots is None else links.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
    after = staged(connected_components(known), "roots")
    dropped(links)
    return after


def _either(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    return a if b is None else b if a is None else a.union(b)


def _apart(members: DataFrame, key: str, roots: DataFrame | None) -> DataFrame:
    """The members of buckets that are not yet one connected group, with their root; columns as they came, and root."""
    names = members.columns
    rooted = members.withColumn("root", F.col("set_id")) if roots is None else members.join(
        roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    rooted = staged(rooted.select(*names, "root"), "rooted")
    divided = rooted.groupBy(key).agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select(key)
    apart = staged(rooted.join(divided, key), "apart")
    dropped(rooted)
    return apart


def _pairs(left: DataFrame, right: DataFrame, key: str, able: str = "true") -> DataFrame:
    """(u, v) of members l and r of one bucket, but not of one root, that `able` does not rule out."""
    same = F.expr(f"l.{key} = r.{key} AND l.root <> r.root AND {able}")
    return left.alias("l").join(right.alias("r"), same).select(
        F.least("l.set_id", "r.set_id").alias("u"), F.greatest("l.set_id", "r.set_id").alias("v"))


def _join_by_rare_shingles(crowd: DataFrame, roots: DataFrame | None, pending: DataFrame | None, keyed: DataFrame,
                           classes: DataFrame, shingle: int, percent: int) -> DataFrame | None:
    """Groups (node, root) after pending links and all links among the given classes, found by their rare shingles.

    Sets order their shingles from rare to common. Two sets that share no shingle before a place have at most
    the shingles from there on in common, and of those only the ones that occur in other sets too. So
    similar sets share one early enough, and each pair is met only at such places.
    """
    full = staged(_full_sets(keyed, classes, crowd, shingle), "crowd")
    counts = staged(full.select("set_id", F.explode("h").alias("s")).groupBy("s").agg(
        F.count("*").alias("df"), F.min("set_id").alias("one")), "counts")
    # a set of which too many shingles occur nowhere else has no partner
    alone = counts.where("df = 1").groupBy(F.col("one").alias("set_id")).agg(F.count("*").alias("own"))
    able = full.join(alone, "set_id", "left").select("set_id", "h", F.size("h").alias("n"), F.coalesce("own", F.lit(0)).alias("own"))
    items = able.where(f"100 * (n - own) >= {percent} * n").select("set_id", "n", F.explode("h").alias("s"))
    common = counts.where("df > 1").select("s", "df")
    known = items.join(common, "s").groupBy("set_id").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "s"))).alias("known"))
    # rest: how many of a set's shingles that occur elsewhere stand at this place or after it
    places = known.select("set_id", "n", F.size("known").alias("c"), F.posexplode("known.s").alias("at", "s")).select(
        "set_id", "n", "s", F.expr("c - at").alias("rest")).where(f"100 * rest >= {percent} * n")
    members = staged(places, "members")
    least = members.groupBy("s").agg(F.min("n").alias("n_min"), F.count("*").alias("k")).where("k > 1").select("s", "n_min")
    able = members.join(least, "s").where(f"100 * rest >= {percent} * (n + greatest(n_min, rest) - rest)")
    central = F.struct((F.col("rest") / F.col("n")).alias("share"), "set_id")
    sizes = able.groupBy("s").agg(F.count("*").alias("k"), F.max(central)["set_id"].alias("hub")).where("k > 1")
    groups = staged(able.join(sizes, "s").select("s", "set_id", "n", "rest", "k", "hub"), "groups")
    dropped(members)
    dropped(counts)
    bound = f"100 * least(l.rest, r.rest) >= {percent} * (l.n + r.n - least(l.rest, r.rest))"
    hubs = 1
    while True:
        apart = _apart(groups, "s", roots)
        most = apart.agg(F.max("k")).first()[0]
        if most is not None:
            # the central member, then some by hash, at last all meet the members of other groups
            few = F.pmod(F.xxhash64("set_id"), F.lit(1 << 30)) * F.col("k") < F.lit(hubs << 30)
            last = hubs >= most or hubs > HUBS or (hubs > 1 and most <= HUBS ** 2)
            pairs = (_pairs(apart, apart, "s", f"{bound} AND l.set_id < r.set_id") if last else
                     _pairs(apart.where(F.col("set_id") == F.col("hub") if hubs == 1 else few), apart, "s", bound))
            pending = _either(pending, _confirmed(pairs, keyed, classes, shingle, percent, full))
        dropped(apart)
        if most is None or last:
            dropped(groups)
            dropped(full)
            return _rooted(roots, pending)
        roots, pending = _rooted(roots, pending), None
        hubs *= HUBS


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   percent: int = 80) -> DataFrame:
    """One row per document row: (doc_id, n_shingles, component_id, kept).

    component_id is the smallest doc_id reachable over links, itself included; kept marks the row with
    that id. Documents without words are linked with nothing. Rows of one doc_id are linked by their own
    texts; they share a component_id only if their texts do. A null doc_id takes part in links, but
    is never a component_id; where a group has no other id, or a wordless row has none, component_id is
    null and kept is false. Empty table: no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    marks = staged(signatures(keyed, shingle), "minhash")
    classes = staged(marks.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"), F.min("doc_id").alias("low"), F.max("n").alias("n"),
        F.max("sig").alias("sig"), F.max("keys").alias("keys")), "classes")
    buckets = classes.select("set_id", F.explode("keys").alias("key"))
    counts = buckets.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    shared = staged(buckets.join(counts, "key"), "buckets")
    weights = shared.groupBy("set_id").agg(F.sum("k").alias("weight"))
    hubs = shared.join(weights, "set_id").groupBy("key").agg(F.max(F.struct("weight", "set_id"))["set_id"].alias("hub"))
    stars = shared.join(hubs, "key").where("set_id <> hub").select(
        F.least("set_id", "hub").alias("u"), F.greatest("set_id", "hub").alias("v"))
    roots = _rooted(None, _confirmed(stars, keyed, classes, shingle, percent))
    apart = _apart(shared, "key", roots)
    dropped(shared)
    few = apart.where(F.col("k") <= CROWDED)
    more = _confirmed(_pairs(few, few, "key", "l.set_id < r.set_id"), keyed, classes, shingle, percent)
    crowd = staged(apart.where(F.col("k") > CROWDED).select("set_id").distinct(), "crowd")
    dropped(apart)
    roots = _rooted(roots, more) if crowd.isEmpty() else _join_by_rare_shingles(crowd, roots, more, keyed, classes, shingle,
                                                                                percent)
    whole = classes.select("set_id", "low")
    if roots is not None:
        whole = whole.join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
        least = whole.where("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("least"))
        whole = whole.join(least, "root", "left").select("set_id", F.coalesce("least", "low").alias("low"))
    whole = staged(whole, "groups")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    # rows without a set meet no group: dealt by their text, not by one key
    spread = F.coalesce(F.col("set_id"), F.encode(F.col("text_hash").cast("string"), "UTF-8"))
    placed = marks.select("doc_id", "n", "set_id", spread.alias("at")).join(
        whole.select(F.col("set_id").alias("at"), "low"), "at", "left")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
