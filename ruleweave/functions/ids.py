"""Deterministic alert ids as native Spark expressions (no Python in the hot path).

An alert id is a name-based UUID (RFC 4122, version 5, SHA-1) in the OID namespace:

* plain rules: name = ``rule_id + ":" + canonical JSON of the raw log``, so the same
  rule and the same log content always give the same id;
* burst rules: name = ``rule_id + ":" + host + ":" + bucket`` with
  ``bucket = floor(epoch seconds of the log's timestamp / window seconds)``, 0 when the
  timestamp is missing or unparsable.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.functions.fields import quote, sql_text
from ruleweave.functions.timeutil import MICROS, floor_div

# Fixed value: the RFC 4122 OID namespace UUID, as hex.
NAMESPACE_OID_HEX = "6ba7b8129dad11d180b400c04fd430c8"


def uuid5_sql(name_sql: str) -> str:
    """UUIDv5(OID, name) as SQL: SHA-1 of namespace bytes + UTF-8 name, then the version
    nibble set to 5 and the variant bits to ``10``."""
    h = f"sha1(concat(unhex('{NAMESPACE_OID_HEX}'), encode({name_sql}, 'UTF-8')))"
    return (f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', "
            f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab'), substr({h}, 18, 3), '-', "
            f"substr({h}, 21, 12))")


def uuid5(name: Column) -> Column:
    """UUIDv5(OID, name) for a Column (the SHA-1 is computed once per row by codegen CSE)."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_OID_HEX)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def json_string_sql(expr: str) -> str:
    """JSON string literal (quoted, escaped) of a text expression; NULL stays NULL."""
    return f"CASE WHEN {expr} IS NOT NULL THEN substring(to_json(array({expr})), 2, length(to_json(array({expr}))) - 2) END"


def json_value_sql(name: str, dtype: T.DataType) -> str:
    """Text of one value as Python's ``json.dumps(..., default=str)`` writes it.

    Nested values are written as compact JSON (deviation D6); NULL stays NULL so that the
    caller can drop absent fields.
    """
    c = quote(name)
    if isinstance(dtype, T.StringType):
        return json_string_sql(c)
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {c} THEN 'true' WHEN NOT {c} THEN 'false' END"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):   # NaN and infinities have no JSON number: as text
        return (f"CASE WHEN isnan({c}) OR abs({c}) = double('Infinity') THEN concat('\"', {c}, '\"') "
                f"ELSE CAST({c} AS STRING) END")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return f"CAST({c} AS STRING)"
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return f"CASE WHEN {c} IS NOT NULL THEN to_json({c}) END"
    return json_string_sql(f"CAST({c} AS STRING)")


def canonical_json_sql(schema: T.StructType, names: list[str] | None = None) -> str:
    fields = {f.name: f.dataType for f in schema.fields}
    keys = sorted(names if names is not None else fields)
    pairs = [f"concat({sql_text(json.dumps(k) + ': ')}, {json_value_sql(k, fields[k])})" for k in keys]
    return f"concat('{{', concat_ws(', ', {', '.join(pairs)}), '}}')" if pairs else "'{}'"


def canonical_json(schema: T.StructType, names: list[str] | None = None) -> Column:
    """Key-sorted JSON of the given columns in Python's default layout (``", "`` / ``": "``).

    NULL columns are absent from the object (columnar logs have no JSON null).
    """
    return F.expr(canonical_json_sql(schema, names))


def content_alert_id(rule_id: Column, canonical: Column) -> Column:
    """Id of a plain-rule alert."""
    return uuid5(F.concat(rule_id, F.lit(":"), canonical))


def time_bucket(epoch_us: Column, window_seconds: int) -> Column:
    """``floor(epoch / window)``; 0 when the time is unknown."""
    return F.coalesce(floor_div(epoch_us, window_seconds * MICROS), F.lit(0).cast("long"))


def bucket_alert_id(rule_id: Column, host: Column, bucket: Column, key: Column | None = None) -> Column:
    """Id of a burst alert, one per (rule, host, bucket).

    ``key`` is the value of a ``by`` field other than the host, NULL for rules by host; it
    tells the keys of one host apart.
    """
    parts = [rule_id, host, bucket.cast("string")]
    return uuid5(F.concat_ws(":", *parts, *([] if key is None else [F.concat(F.lit("by="), key)])))
