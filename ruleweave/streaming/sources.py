"""Stream sources.

Kafka is the production transport (``raw-logs`` keyed by host, ``rule-updates``,
``alerts``). Its connector jar is not part of a plain PySpark install, so the Kafka
readers only build the reader; file streams (text, JSON lines, Parquet) are what the
tests run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.functions.fields import quote
from ruleweave.functions.jsontext import marked_parse, sole_object
from ruleweave.operators.evaluate import ALERT_COLUMNS


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """``value`` text plus ``partition``, ``offset`` (the arrival order) and record time."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                           "partition", "offset", F.col("timestamp").alias("record_time"))


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                glob: str | None = None) -> DataFrame:
    """S1 offline: one JSON log per line from files dropped into ``path``.

    The arrival order is (file name, line position); Spark gives no line number, so the
    order uses the file name and a monotonically increasing id within the micro-batch.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select(F.col("value"), F.input_file_name().alias("source_file"))


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """A Parquet table of ``folder`` read as a stream (``<name>.parquet`` files only).

    ``min_partitions`` spreads each micro-batch over that many tasks (round robin) when the
    files cannot be split (few files of one row group each); Kafka sources have their own
    ``minPartitions`` option instead.
    """
    if schema is None:
        schema = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.parquet(folder)
    return df.repartition(min_partitions) if min_partitions else df


# The alert message layout; ``raw_log`` may be missing, any other key is required.
ALERT_KEYS = ALERT_COLUMNS


def checked_alerts(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``raw`` with ``_rw_ok`` and the fields of each alert message, NULL where it is to be quarantined.

    A message is parsed once for the check and once for all its fields.
    """
    v = F.col(quote(value_col))
    required = F.array(*[F.lit(k) for k in ALERT_KEYS if k != "raw_log"])
    allowed = F.array(*[F.lit(k) for k in ALERT_KEYS])

    def check(keys):
        whole = (F.size(F.array_except(required, keys)) == 0) & (F.size(F.array_except(keys, allowed)) == 0)
        # as alerts are published, all keys once and in order, there is nothing to look up
        return F.when(keys == allowed, F.struct(F.lit(True).alias("ok"), F.lit(False).alias("repeats"))).otherwise(
            F.struct(whole.alias("ok"), (F.size(F.array_distinct(keys)) < F.size(keys)).alias("repeats")))

    # made by generators, so that neither uses of the keys nor filters parse the text again, and by compiled code
    parsed = raw.select("*", F.explode_outer(F.array(marked_parse(v))).alias("_rw_parsed"))
    keys = F.map_keys(sole_object(F.col("_rw_parsed"), v))
    rows = parsed.select(*[F.col(quote(c)) for c in raw.columns], F.explode_outer(F.array(
        F.when(keys.isNotNull(), check(keys)))).alias("_rw_checked")).select("*", F.json_tuple(v, *ALERT_KEYS).alias(
            *[f"_rw_j{i}" for i in range(len(ALERT_KEYS))]))
    ok = F.coalesce(F.col("_rw_checked.ok"), F.lit(False))
    # of a key given twice, the first value counts
    texts = [F.when(F.col("_rw_checked.repeats"), F.get_json_object(v, f"$.{k}")).otherwise(F.col(f"_rw_j{i}"))
             for i, k in enumerate(ALERT_KEYS)]
    return rows.select(*[F.col(quote(c)) for c in raw.columns], ok.alias("_rw_ok"), *[F.when(ok, F.coalesce(
        t, F.lit("{}")) if k == "raw_log" else t).alias(f"_rw_{k}") for k, t in zip(ALERT_KEYS, texts)])


def decode_alerts(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Strict decode of alert JSON; a missing or an extra key quarantines the message."""
    parsed = checked_alerts(raw, value_col)
    good = parsed.where("_rw_ok").select(*[F.col(f"_rw_{k}").alias(k) for k in ALERT_KEYS])
    bad = parsed.where(~F.col("_rw_ok")).select(*[F.col(quote(c)) for c in raw.columns])
    return good, bad


def read_changelog_kafka(spark: SparkSession, servers: str, topic: str = "rule-updates") -> DataFrame:
    """S5 batch side: the whole rule-updates topic from the earliest offset, as changelog rows.

    The record timestamp is the time from which a change applies; partition and offset
    give the order (a single-partition topic keeps the global order).
    """
    from ruleweave.operators.lifecycle import decode_envelopes
    raw = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
           .option("startingOffsets", "earliest").option("endingOffsets", "latest").load())
    raw = raw.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"),
                     F.unix_micros(F.col("timestamp")).alias("at_us"))
    return decode_envelopes(raw, seq_col="seq", at_col="at_us")
