"""Attack-stage analysis (R1, R2): a label per log and the observed transition matrix.

Stages are ordered (stage name, selection group) pairs: the first group a log satisfies
names its stage, else the default. Transitions follow each host's logs in (time, order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.functions.timeutil import MICROS, floor_div
from ruleweave.operators.burst import counting_time
from ruleweave.plans.compile import group_predicate
from ruleweave.sources.logs import LogView

# Stages of the Windows attack sequence (first match wins).
WINDOWS_STAGES = [
    ("brute_forcing", {"event_id": "4625"}),
    ("compromised", {"event_id": ["4624", "4672"]}),
    ("lateral_movement", {"event_id": "4688", "process_name|contains": ["powershell", "cmd", "psexec", "wmic"]}),
]
DEFAULT_STAGE = "idle"


def stage_labels(view: LogView, stages, default: str = DEFAULT_STAGE) -> DataFrame:
    """``host, t_us, order..., stage`` plus the view's kept columns."""
    expr = None
    for name, group in stages:
        p = group_predicate(view.fields, group, "stages", name)
        expr = F.when(p, F.lit(name)) if expr is None else expr.when(p, F.lit(name))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return view.df.select(
        view.host.alias("host"), counting_time(view).alias("t_us"),
        *[o.alias(f"_rw_o{i}") for i, o in enumerate(view.order)],
        *[F.col(k) for k in view.keep], expr.alias("stage"))


def stage_transitions(labels: DataFrame, chunk_seconds: int = 3600, by_host: bool = False) -> DataFrame:
    """R2: ``from_stage, to_stage, transitions, share`` over consecutive logs of a host
    (``by_host``: one matrix per host, shares within the host's row of the matrix).

    Each host is cut into time chunks. Inside a chunk ``lag`` gives the transitions; the
    transition into a chunk pairs the previous chunk's last stage with this chunk's first,
    taken from a per-chunk summary. A busy host is spread over its chunks, whose width does
    not change the result. Logs without an event time are placed as burst logs are (A8).
    """
    order = [c for c in labels.columns if c.startswith("_rw_o")]
    chunk_us = chunk_seconds * MICROS
    rows = labels.withColumn("_rw_chunk", floor_div(F.col("t_us"), chunk_us))
    # one window pass per (host, chunk): the step inside the chunk, and the chunk's first
    # and last stage for the step into the next chunk
    inner_w = Window.partitionBy("host", "_rw_chunk").orderBy("t_us", *order)
    whole = inner_w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = (rows.withColumn("from_stage", F.lag("stage").over(inner_w))
               .withColumn("_rw_rn", F.row_number().over(inner_w))
               .withColumn("_rw_last", F.last("stage").over(whole)))
    inner = (stepped.where(F.col("from_stage").isNotNull())
             .select("host", "from_stage", F.col("stage").alias("to_stage")))
    summary = stepped.where(F.col("_rw_rn") == 1).select("host", "_rw_chunk", F.col("stage").alias("_rw_first"),
                                                         "_rw_last")
    edge_w = Window.partitionBy("host").orderBy("_rw_chunk")
    edges = (summary.withColumn("from_stage", F.lag("_rw_last").over(edge_w))
             .where(F.col("from_stage").isNotNull())
             .select("host", "from_stage", F.col("_rw_first").alias("to_stage")))
    keys = (["host"] if by_host else []) + ["from_stage", "to_stage"]
    counts = inner.unionByName(edges).groupBy(*keys).agg(F.count(F.lit(1)).alias("transitions"))
    share = F.col("transitions") / F.sum("transitions").over(Window.partitionBy(*keys[:-1]))
    return counts.withColumn("share", share)
