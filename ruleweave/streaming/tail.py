"""The tail of the burst stream (A9): how many matches per (rule, key, time) can still be counted.

It lies in buckets by key, each written as a whole by the micro-batch that last touched it. A small
manifest per micro-batch says which files are current, so a replayed batch starts from the same files and
writes the same ones. Files that a batch replaced go once that batch is known to be committed.

A rule's clock is the median of its keys' newest times (of the buckets' medians, to be exact, so that it
needs only the manifest). A key is forgotten once that clock has moved on by more than its reach (span
and lateness) since the key was last seen. One host whose clock is ahead does not move the median.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAIL_SCHEMA = "_rw_rid string, _rw_epoch long, _rw_key string, _rw_t long, _rw_n long, _rw_seen long"


@dataclass
class TailState:
    """The tail after a micro-batch. Rules are (rule id, epoch) pairs."""

    path: str
    buckets: int
    versions: dict[int, int] = field(default_factory=dict)          # bucket -> batch that wrote it
    stats: dict[tuple, dict] = field(default_factory=dict)          # (*rule, bucket) -> keys, middle, newest, first, last
    clocks: dict[tuple, int] = field(default_factory=dict)          # rule -> its clock
    forgot: dict[tuple, int] = field(default_factory=dict)          # rule -> newest time of any forgotten key
    replaced: list[tuple[int, int]] = field(default_factory=list)   # (bucket, batch) that this batch made useless

    @classmethod
    def load(cls, spark: SparkSession, state: str, batch_id: int, buckets: int) -> "TailState":
        """The tail after that batch; before the first, an empty one. The number of buckets stays as it began."""
        if batch_id < 0:
            return cls(state, buckets)
        m = json.loads(spark.read.text(f"{state}/manifest/batch_id={batch_id}").first().value)
        return cls(state, m["buckets"], {int(b): v for b, v in m["versions"].items()},
                   {(rid, epoch, b): s for rid, epoch, b, s in m["stats"]}, {(rid, epoch): t for rid, epoch, t in m["clocks"]},
                   {(rid, epoch): t for rid, epoch, t in m["forgot"]}, [tuple(r) for r in m["replaced"]])

    def bucket_of(self, rid: Column, epoch: Column, key: Column) -> Column:
        return F.pmod(F.xxhash64(rid, epoch, key), F.lit(self.buckets)).cast("int")

    def folder(self, bucket: int, version: int) -> str:
        return f"{self.path}/tail/batch_id={version}/_rw_bucket={bucket}"

    def read(self, spark: SparkSession, touched: set[int]) -> DataFrame | None:
        """The rows of those buckets, None if there are none."""
        folders = [self.folder(b, self.versions[b]) for b in sorted(touched) if b in self.versions]
        return spark.read.schema(TAIL_SCHEMA).parquet(*folders) if folders else None

    def advance(self, stats: dict[tuple, dict], reach: dict[tuple, int]) -> None:
        """Take over what a batch found in the buckets it touched, and move the clocks.

        ``reach`` are the rules that run. Buckets in which every rule is forgotten or no longer runs are
        dropped unread.
        """
        self.stats = {t: s for t, s in {**self.stats, **stats}.items() if t[:2] in reach}
        clocks = {}
        for rule in reach:
            own = sorted((s["middle"], s["keys"]) for t, s in self.stats.items() if t[:2] == rule)
            half, total = (sum(n for _, n in own) + 1) // 2, 0
            for middle, n in own:
                total += n
                if total >= half:
                    clocks[rule] = max(middle, self.clocks.get(rule, middle))
                    break
        self.clocks = clocks
        for t, s in list(self.stats.items()):
            if t not in stats and clocks[t[:2]] - s["last"] > reach[t[:2]]:
                self.note_forgotten(t[:2], s["newest"])
                del self.stats[t]
        self.forgot = {r: t for r, t in self.forgot.items() if r in reach}

    def note_forgotten(self, rule: tuple, newest: int) -> None:
        self.forgot[rule] = max(newest, self.forgot.get(rule, newest))

    def write(self, spark: SparkSession, rows: DataFrame | None, batch_id: int, touched: set[int]) -> None:
        """Write the touched buckets and the manifest of this batch."""
        if batch_id:
            self._remove(spark)
        if touched:
            rows.repartition(len(touched), "_rw_bucket").write.mode("overwrite").partitionBy("_rw_bucket").parquet(
                f"{self.path}/tail/batch_id={batch_id}")
        live = {b for _, _, b in self.stats}
        versions = {b: v for b, v in {**self.versions, **dict.fromkeys(touched, batch_id)}.items() if b in live}
        replaced = [(b, v) for b, v in self.versions.items() if versions.get(b) != v]
        manifest = {"buckets": self.buckets, "versions": versions, "stats": [[*t, s] for t, s in sorted(self.stats.items())],
                    "clocks": [[*r, t] for r, t in sorted(self.clocks.items())],
                    "forgot": [[*r, t] for r, t in sorted(self.forgot.items())], "replaced": replaced}
        spark.range(0, 1, 1, 1).select(F.lit(json.dumps(manifest)).alias("value")).write.mode("overwrite").text(
            f"{self.path}/manifest/batch_id={batch_id}")

    def _remove(self, spark: SparkSession) -> None:
        """Files that the previous batch replaced: it is committed, so no replay reads them."""
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for bucket, version in self.replaced:
            p = jvm.org.apache.hadoop.fs.Path(self.folder(bucket, version))
            p.getFileSystem(conf).delete(p, True)
