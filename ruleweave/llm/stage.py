"""Staging of intermediate results in the cluster's shared folder, and small frame helpers."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ruleweave-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove a staged frame's files once nothing reads them any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/ruleweave-" in path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def set_aside(docs: DataFrame, *columns: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], tuple[str, ...]]:
    """``docs`` with its columns named ``_rw_...`` under other names, as operators call their own so.

    Also returns what gives a result its names back, and ``columns`` as they are called meanwhile.
    A table without such names is returned as it is.
    """
    taken = {c.lower() for c in docs.columns}
    free = (f"aside_{i}" for i in itertools.count() if f"aside_{i}" not in taken)
    away = {c: next(free) for c in docs.columns if c.lower().startswith("_rw_")}
    if not away:
        return docs, lambda df: df, columns
    home = {v: k for k, v in away.items()}

    def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])

    return renamed(docs, away), lambda df: renamed(df, home), tuple(away.get(c, c) for c in columns)
