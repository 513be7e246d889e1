"""Log views over the driver's test tables.

``events`` becomes a log stream: ``host`` = user id, ``log_type`` = event type, and the
event time as ISO-8601 text in the ``timestamp`` field. ``lineitem`` becomes a second,
larger stream with day-grain times (many ties): ``host`` = supplier key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.sources.logs import LogView, table_view

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its files hold one row group, so a scan is one task; a session may ask for more with
    ``spark.ruleweave.read.minPartitions`` (local sessions do, see ``build_session``). Unset: no shuffle."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    least = spark.conf.get("spark.ruleweave.read.minPartitions", None)
    return df.repartition(int(least)) if least else df


def events_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_logs_from(read_table(spark, sf_dir, "events"))


def events_logs_from(ev: DataFrame) -> DataFrame:
    """The log view of an events frame (batch or stream)."""
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("host"),
        F.col("event_type").alias("log_type"),
        F.col("props"),
        F.date_format("ts", ISO_FORMAT).alias("timestamp"),
        F.col("value"),
        F.col("ts").alias("_rw_ts"),
        F.col("user_id").cast("bigint").alias("_rw_user"),
    )


def events_view(spark: SparkSession, sf_dir: str, df: DataFrame | None = None) -> LogView:
    logs = events_logs(spark, sf_dir) if df is None else df
    return table_view(logs, time_col="_rw_ts", id_time_col="_rw_ts", order_cols=["event_id"],
                      keep=["event_id"], sources={"host": "_rw_user"})


def lineitem_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_suppkey").cast("string").alias("host"),
        F.col("l_returnflag"), F.col("l_linestatus"),
        F.col("l_quantity"), F.col("l_discount"),
        F.date_format("l_shipdate", ISO_FORMAT).alias("timestamp"),
        F.col("l_shipdate").alias("_rw_ts"),
    )


def lineitem_view(spark: SparkSession, sf_dir: str) -> LogView:
    return table_view(lineitem_logs(spark, sf_dir), time_col="_rw_ts", id_time_col="_rw_ts",
                      order_cols=["l_orderkey", "l_linenumber"], keep=["l_orderkey", "l_linenumber"])
