"""Log views (S2, S7, J5, J9): how rules see a table or a stream of JSON text.

A :class:`LogView` bundles a DataFrame with the expressions the operators need: field
access, the host, the raw-log text, the canonical text used in alert ids, event time and
a tie-breaking order. Internal columns start with ``_rw_`` and are never rule fields.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.functions.fields import ColumnFields, Fields, MapFields, field_value_text, quote
from ruleweave.functions.ids import canonical_json
from ruleweave.functions.jsontext import strict_object
from ruleweave.functions.pyjson import canonical_text
from ruleweave.functions.timeutil import epoch_micros, iso_text_micros

INTERNAL = "_rw_"
FIELDS_MAP = "_rw_fields"


@dataclass
class LogView:
    df: DataFrame
    fields: Fields
    field_names: list[str] | None          # None: open schema (JSON maps)
    host: Column                           # J5: str(log.get("host", ""))
    raw_json: Column                       # J9: the raw log as JSON text
    canonical: Column                      # J2: key-sorted JSON used in content ids
    event_us: Column                       # A8: event time (epoch micros) that drives bursts
    id_time_us: Column                     # J4: epoch micros of the "timestamp" field
    order: list[Column] = field(default_factory=list)   # A2: arrival order among equal times
    keep: list[str] = field(default_factory=list)       # columns carried into alert rows
    arrival_us: Column | None = None       # A8: arrival time (epoch micros), for logs without an event time

    def with_df(self, df: DataFrame) -> "LogView":
        return replace(self, df=df)


def table_view(df: DataFrame, *, time_col: str, order_cols: list[str], fields: list[str] | None = None,
               id_time_col: str | None = None, keep: list[str] | None = None,
               sources: dict[str, str] | None = None) -> LogView:
    """A columnar log view: each non-internal column is a field.

    ``sources``: integer columns (usually internal) behind text fields, see ``ColumnFields``.

    ``time_col`` drives bursts (event time, D1); ``id_time_col`` (default: ``timestamp``
    when present, else ``time_col``) feeds the burst-id bucket.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in (fields or df.columns) if not c.startswith(INTERNAL)]
    schema = T.StructType([f for f in df.schema.fields if f.name in names])
    cf = ColumnFields(schema, sources)
    id_col = id_time_col or ("timestamp" if "timestamp" in types else time_col)
    canonical = canonical_json(schema)
    return LogView(
        df=df, fields=cf, field_names=names,
        host=field_value_text(cf, "host"),
        raw_json=canonical,
        canonical=canonical,
        event_us=epoch_micros(time_col, types[time_col]),
        id_time_us=epoch_micros(id_col, types[id_col]),
        order=[F.col(quote(c)) for c in order_cols],
        keep=list(keep or []),
    )


def decode_json_logs(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split raw JSON text into (decoded rows, quarantined rows).

    Decoded rows get a ``map<string,string>`` of the top-level keys; objects only. Nested
    values keep their compact JSON text. A repeated key keeps its last value, as JSON
    loaders do. Text that is not one JSON object (arrays, scalars, trailing text, broken
    JSON) is quarantined. One parse per row.
    """
    parsed = df.withColumn(FIELDS_MAP, strict_object(F.col(quote(value_col)))).withColumn(
        "_rw_ok", F.col(FIELDS_MAP).isNotNull())
    fm = F.col(FIELDS_MAP)
    dup = F.size(F.array_distinct(F.map_keys(fm))) < F.size(fm)
    entries = F.map_entries(fm)
    last_wins = F.map_from_entries(F.filter(
        entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(fm) - i - 1, F.lit(0))),
                                        lambda x: x["key"] == e["key"])))
    parsed = parsed.withColumn(FIELDS_MAP, F.when(dup, last_wins).otherwise(fm))
    good = parsed.where(F.col("_rw_ok")).drop("_rw_ok")
    bad = parsed.where(~F.col("_rw_ok")).drop("_rw_ok", FIELDS_MAP)
    return good, bad


def json_view(decoded: DataFrame, value_col: str = "value", order_cols: list[str] | None = None,
              keep: list[str] | None = None, time: str = "event", arrival_col: str | None = None) -> LogView:
    """A view over decoded JSON logs (see :func:`decode_json_logs`).

    Event time is the ``timestamp`` field (ISO-8601); naive text is read as UTC. ``arrival_col``
    (a timestamp, e.g. the record time) stands in where it is missing or unreadable; with
    ``time="arrival"`` it drives the windows of all logs. Id buckets stay with the field (J4).
    """
    if time not in ("event", "arrival") or (time == "arrival" and not arrival_col):
        raise ValueError("time is 'event', or 'arrival' with an arrival_col")
    arrival = epoch_micros(arrival_col, decoded.schema[arrival_col].dataType) if arrival_col else None
    mf = MapFields(FIELDS_MAP)
    raw = F.col(quote(value_col))
    ts_text = F.when(mf.present("timestamp"), mf.text("timestamp"))
    us = iso_text_micros(ts_text)
    return LogView(
        df=decoded, fields=mf, field_names=None,
        host=field_value_text(mf, "host"),
        raw_json=raw,
        # logs with repeated keys fall back to their decoded fields
        canonical=F.coalesce(canonical_text(raw),
                             F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.col(FIELDS_MAP)))))),
        event_us=arrival if time == "arrival" else us,
        id_time_us=us,
        order=[F.col(quote(c)) for c in (order_cols or [])],
        keep=list(keep or []),
        arrival_us=arrival,
    )


def partition_by_host(df: DataFrame, partitions: int, host_col: str = "host") -> DataFrame:
    """Co-locate a host's rows (the topic's key partitioning) for a later keyed step."""
    return df.repartition(partitions, F.col(quote(host_col)))
