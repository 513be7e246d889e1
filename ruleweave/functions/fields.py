"""Field access over log rows, as Spark SQL text.

Logs come in two shapes:

* columnar tables (Parquet, a view over a table): each field is a top-level column.
  NULL means "no value", so it is treated as an absent field. Fields not in the schema
  fold to ``false`` at compile time, which lets Catalyst drop whole rules.
* decoded JSON (``map<string,string>``): a key may be present with a JSON ``null``;
  such a value is present and compares as the text ``None``.

Both sides of a comparison are text (an integer 4625 equals the rule text ``'4625'``).
Accessors return SQL fragments so that a whole rule becomes one expression for Catalyst
to parse (one call into the JVM per rule, instead of one per operator).
"""

from __future__ import annotations

import re
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_CANONICAL_INT = re.compile(r"^-?(0|[1-9][0-9]*)$")
_PLAIN_TEXT = re.compile(r"^[^'\\\x00-\x1f]*$")


def quote(name: str) -> str:
    """Back-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A SQL string literal for any text.

    Plain text is written as ``'...'``; text with quotes, backslashes or control
    characters goes through ``decode(unhex(...))``, which Catalyst folds to a literal, so the
    result never depends on the parser's escape settings.
    """
    if _PLAIN_TEXT.match(value):
        return "'" + value + "'"
    return f"decode(unhex('{value.encode('utf-8').hex()}'), 'UTF-8')"


class Fields(Protocol):
    def has(self, name: str) -> bool: ...

    def present_sql(self, name: str) -> str: ...

    def text_sql(self, name: str) -> str: ...

    def equals_any_sql(self, name: str, values: list[str]) -> str: ...


class _ColumnApi:
    """Column-returning wrappers around the SQL accessors."""

    def present(self, name: str) -> Column:
        return F.expr(self.present_sql(name))

    def text(self, name: str) -> Column:
        return F.expr(self.text_sql(name))


def _in_list(expr: str, values: list[str]) -> str:
    if len(values) == 1:
        return f"{expr} = {values[0]}"
    return f"{expr} IN ({', '.join(values)})"


class ColumnFields(_ColumnApi):
    """Fields are the top-level columns of a DataFrame with the given schema.

    ``sources`` names, for a text field made by casting an integer column, that column: equality is
    then tested on it and reaches the Parquet scan.
    """

    def __init__(self, schema: T.StructType, sources: dict[str, str] | None = None):
        self._types = {f.name: f.dataType for f in schema.fields}
        self._sources = sources or {}

    def has(self, name: str) -> bool:
        return name in self._types

    def present_sql(self, name: str) -> str:
        return f"{quote(name)} IS NOT NULL" if name in self._types else "false"

    def text_sql(self, name: str) -> str:
        if name not in self._types:
            return "CAST(NULL AS STRING)"
        if isinstance(self._types[name], T.StringType):
            return quote(name)
        return f"CAST({quote(name)} AS STRING)"

    def equals_any_sql(self, name: str, values: list[str]) -> str:
        """Text equality, kept in the column's own type where that is exact.

        ``cast(bigint as string) = '4625'`` holds exactly when the column equals 4625, and
        never for texts such as ``'04625'``; comparing in the integral type lets the
        predicate reach the Parquet scan.
        """
        if name not in self._types:
            return "false"
        source = self._sources.get(name, name)
        if source != name or isinstance(self._types[name], _INTEGRAL):
            nums = sorted({int(v) for v in values if _CANONICAL_INT.match(v) and -(2 ** 63) <= int(v) < 2 ** 63})
            return _in_list(quote(source), [f"{n}L" for n in nums]) if nums else "false"
        return _in_list(self.text_sql(name), [sql_text(v) for v in dict.fromkeys(values)])


class MapFields(_ColumnApi):
    """Fields are the keys of a ``map<string,string>`` column (decoded JSON objects)."""

    def __init__(self, column: str = "fields"):
        self._col = column

    def has(self, name: str) -> bool:
        return True

    def present_sql(self, name: str) -> str:
        return f"map_contains_key({quote(self._col)}, {sql_text(name)})"

    def text_sql(self, name: str) -> str:
        return f"coalesce({quote(self._col)}[{sql_text(name)}], 'None')"

    def equals_any_sql(self, name: str, values: list[str]) -> str:
        return _in_list(self.text_sql(name), [sql_text(v) for v in dict.fromkeys(values)])


def rule_text(value) -> str:
    """Text form of a rule-side scalar (YAML or JSON).

    Booleans are lowered to ``true``/``false`` so they meet Spark's text form of a
    boolean column or a JSON boolean (deviation D5).
    """
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def field_value_sql(fields: Fields, name: str, default: str = "") -> str:
    return f"CASE WHEN {fields.present_sql(name)} THEN {fields.text_sql(name)} ELSE {sql_text(default)} END"


def field_value_text(fields: Fields, name: str, default: str = "") -> Column:
    """``str(log.get(name, default))``: the text of a field, or ``default`` if absent."""
    return F.expr(field_value_sql(fields, name, default))


def any_of(cols: list[Column]) -> Column:
    """OR of many predicates as a balanced tree: depth log2(n), still pushable to the scan.

    A left-deep chain of hundreds of ORs overflows the JVM stack during analysis.
    """
    if not cols:
        return F.lit(False)
    while len(cols) > 1:
        cols = [cols[i] | cols[i + 1] if i + 1 < len(cols) else cols[i] for i in range(0, len(cols), 2)]
    return cols[0]


def case_of(k: Column, values: list[Column]) -> Column:
    """``values[k]`` for a small integer column ``k`` (one flat CASE, no nesting)."""
    if len(values) == 1:
        return values[0]
    expr = F.when(k == 0, values[0])
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(k == i, v)
    return expr
