"""Alert store (K2, K5, A11) and store queries (Q1-Q7).

The store is a Parquet folder written one micro-batch at a time: batch ``b`` goes to
``<store>/batch_id=b`` with overwrite, so replaying a batch rewrites the same files
(idempotent). Inside a batch, documents lie in folders by a hash of their id, so a lookup by
id reads one bucket of each batch. Reading resolves each alert id to its last write (highest
batch, then the last row inside it in the given order), which is the "document id = alert id,
last write wins" rule. Writes cost the batch, not the store; ``compact`` folds old batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ruleweave.functions.fields import quote
from ruleweave.operators.evaluate import ALERT_COLUMNS

# K5: the stored document layout.
STORE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), c != "alert_id") for c in ALERT_COLUMNS])


def latest_per_id(alerts: DataFrame, order: list[Column], id_col: str = "alert_id") -> DataFrame:
    """One row per alert id, the one that is last in ``order``.

    A ``max_by`` aggregate: partial aggregation runs before the shuffle, so a hot id (all
    alerts of a burst share one) is reduced on the map side instead of piling into a task.
    """
    others = [c for c in alerts.columns if c != id_col]
    key = F.struct(*order)
    agg = alerts.groupBy(F.col(quote(id_col))).agg(
        F.max_by(F.struct(*[F.col(quote(c)) for c in others]), key).alias("_rw_doc"))
    return agg.select(F.col(quote(id_col)), *[F.col(f"_rw_doc.{quote(c)}").alias(c) for c in others])


#: Folders per batch. Lookups by id read one of them.
BUCKETS = 16
_READ_SCHEMA = T.StructType([*STORE_SCHEMA.fields, T.StructField("_rw_pos", T.StringType()),
                             T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])


def id_bucket(alert_id: Column) -> Column:
    return F.pmod(F.xxhash64(alert_id), F.lit(BUCKETS)).cast("int")


def write_batch(alerts: DataFrame, store_path: str, batch_id: int, order: list[Column]) -> None:
    """K2 write side: dedup the batch (last in ``order`` wins) and write it as its own folder."""
    doc_cols = [f.name for f in STORE_SCHEMA.fields]
    ordered = alerts.withColumn("_rw_pos", F.struct(*order))
    _write(latest_per_id(ordered.select(*doc_cols, "_rw_pos"), [F.col("_rw_pos")]).withColumn(
        "_rw_pos", F.to_json(F.col("_rw_pos"))), store_path, batch_id)


def _write(docs: DataFrame, store_path: str, batch_id: int) -> None:
    (docs.withColumn("bucket", id_bucket(F.col("alert_id"))).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{store_path.rstrip('/')}/batch_id={int(batch_id)}"))


def read_store(spark: SparkSession, store_path: str, alert_id: str | None = None) -> DataFrame:
    """K2 read side: the current document per alert id, or of one id. A store not written yet is empty."""
    try:
        raw = spark.read.schema(_READ_SCHEMA).option("basePath", store_path).parquet(store_path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], _READ_SCHEMA)
    if alert_id is not None:
        raw = raw.where((F.col("bucket") == spark.range(1).select(id_bucket(F.lit(alert_id))).first()[0])
                        & (F.col("alert_id") == alert_id))
    cur = latest_per_id(raw.drop("bucket"), [F.col("batch_id"), F.col("_rw_pos")])
    return cur.drop("batch_id", "_rw_pos")


def compact(spark: SparkSession, store_path: str, out_path: str, batch_id: int = 0) -> None:
    """Write the current document per alert id as a single batch of a new store.

    Readers switch to ``out_path`` once it is written; new batches continue there with ids
    above ``batch_id``. The old store is left untouched (nothing is deleted here).
    """
    _write(read_store(spark, store_path).withColumn("_rw_pos", F.lit("{}")), out_path, batch_id)


# --- Q1-Q7 -----------------------------------------------------------------------------

def count_alerts(store: DataFrame) -> DataFrame:
    """Q1."""
    return store.agg(F.count(F.lit(1)).alias("alert_count"))


def alerts_by_terms(store: DataFrame, **terms: str) -> DataFrame:
    """Q2 / Q3: exact-term filter on keyword fields, ANDed."""
    cond = F.lit(True)
    for k, v in terms.items():
        cond = cond & (F.col(quote(k)) == F.lit(v))
    return store.where(cond)


def bucket_counts(store: DataFrame, keys: list[str], top: int | None = None) -> DataFrame:
    """Q4: document count per keyword bucket; ``top`` keeps the k largest buckets."""
    out = store.groupBy(*[F.col(quote(k)) for k in keys]).agg(F.count(F.lit(1)).alias("doc_count"))
    if top is not None:
        out = out.orderBy(F.col("doc_count").desc(), *[F.col(quote(k)) for k in keys]).limit(top)
    return out


def duplicate_ids(alerts: DataFrame) -> DataFrame:
    """Q5: alert ids seen more than once (expected for bursts on the topic, T10)."""
    return (alerts.groupBy("alert_id").agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def quiet_hosts(hosts: DataFrame, store: DataFrame, host_col: str = "host") -> DataFrame:
    """Q6: hosts without any stored alert (anti join on host).

    Both sides are reduced to distinct hosts first (partial aggregation before the shuffle),
    so a host that owns a large share of the alerts does not skew the join.
    """
    return hosts.select(F.col(quote(host_col)).alias("host")).distinct().join(
        store.select("host").distinct(), on="host", how="left_anti")


def embedded_field(store: DataFrame, field: str, alias: str | None = None) -> Column:
    """Q7: a top-level field of the embedded raw log, as text."""
    return F.get_json_object(F.col("raw_log"), "$['" + field + "']").alias(alias or field)
