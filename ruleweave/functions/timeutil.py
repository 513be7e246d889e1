"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.errors import RuleError
from ruleweave.functions.fields import quote

# Timeframe syntax and unit lengths in seconds.
TIMEFRAME_PATTERN = re.compile(r"^(\d+)([smh])$")
TIMEFRAME_UNITS = {"s": 1, "m": 60, "h": 3600}

MICROS = 1_000_000


def parse_timeframe(text) -> int:
    """``'60s'`` / ``'5m'`` / ``'2h'`` to seconds; anything else is a RuleError."""
    m = TIMEFRAME_PATTERN.match(str(text).strip())
    if not m:
        raise RuleError(f"invalid timeframe {text!r}; expected '<N>s', '<N>m' or '<N>h'")
    return int(m.group(1)) * TIMEFRAME_UNITS[m.group(2)]


def epoch_micros(name: str, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 UTC for the column ``name`` of type ``dtype``.

    TIMESTAMP_NTZ values are read as UTC wall clock, independent of the session zone.
    Strings are parsed as ISO-8601 (``Z`` and offsets honoured); bad text gives NULL.
    """
    c = F.col(quote(name))
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86400 * MICROS)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("long") * F.lit(MICROS)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (c * F.lit(MICROS)).cast("long")
    return iso_text_micros(c.cast("string"))


def ntz_micros(c: Column) -> Column:
    """Epoch micros of a TIMESTAMP_NTZ read as UTC: calendar day plus time of day, no zone rules."""
    day = F.unix_date(F.to_date(c)).cast("long") * F.lit(86400 * MICROS)
    tod = (F.hour(c).cast("long") * F.lit(3600 * MICROS) + F.minute(c).cast("long") * F.lit(60 * MICROS)
           + (F.date_part(F.lit("SECOND"), c) * F.lit(MICROS)).cast("long"))
    return day + tod


def iso_text_micros(text: Column) -> Column:
    """Parse ISO-8601 text to epoch micros, as ``datetime.fromisoformat`` reads it.

    Accepts ``T`` or a space, a date alone (midnight), ``HH:MM`` without seconds, any
    number of fraction digits (cut to microseconds), and ``Z`` / ``+hh:mm`` / ``+hhmm``
    offsets. Text without an offset is read as UTC. Unparsable text gives NULL.
    """
    # the usual layouts, complete to the second, are cast as they are: rewriting them takes six regular expressions
    usual = r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?"
    cast = lambda c: F.unix_micros(c.try_cast("timestamp"))
    return (F.when(text.rlike(usual + r"(Z|[+-]\d{2}:\d{2})\z"), cast(text))
            .when(text.rlike(usual + r"\z"), cast(F.concat(text, F.lit("Z")))).otherwise(_rewritten_micros(text)))


def _rewritten_micros(text: Column) -> Column:
    """ISO-8601 text of any layout brought to one that Spark parses."""
    t = F.regexp_replace(F.trim(text), "T", " ")
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2})$", "$1 00:00:00")
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2})(?=$|[+-]|Z)", "$1:00")
    t = F.regexp_replace(t, r"(\.\d{6})\d+", "$1")
    t = F.regexp_replace(t, "Z$", "+00:00")
    t = F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")
    has_zone = t.rlike(r"[+-]\d{2}:\d{2}$")
    aware = F.unix_micros(F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX")))
    # parsed without a zone, so a session zone with a gap (summer time) does not shift it
    ntz = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"), t.try_cast("timestamp_ntz"))
    return F.when(has_zone, aware).otherwise(ntz_micros(ntz))


def floor_div(a: Column, b: int) -> Column:
    """Floor division of a long column by a positive constant (exact, also below zero)."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")
