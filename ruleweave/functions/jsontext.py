"""Strict reading of JSON text: one whole object and nothing else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: The key of the mark. The mark itself is a value: the JSON reader remembers every new key.
_MARK = "_rw_mark"


def _mark(value: Column) -> Column:
    return F.hex(F.xxhash64(value))


def marked_parse(value: Column) -> Column:
    """The text parsed as the first element of an array whose second element is a mark made from the text itself."""
    return F.from_json(F.concat(F.lit("["), value, F.lit(f',{{"{_MARK}":"'), _mark(value), F.lit('"}]')),
                       "array<map<string,string>>", {"allowSingleQuotes": "false"})


def sole_object(parsed: Column, value: Column) -> Column:
    """The object of a :func:`marked_parse`, NULL unless the text is exactly one: a text that closes the array
    early or adds elements does not end up in front of its mark."""
    mark = F.try_element_at(F.get(parsed, F.lit(1)), F.lit(_MARK))
    return F.when((F.size(parsed) == 2) & (mark == _mark(value)), F.get(parsed, F.lit(0)))


def strict_object(value: Column) -> Column:
    """The top-level keys of a JSON object as ``map<string,string>``, or NULL.

    The text must be exactly one JSON object in double quotes: broken JSON, trailing or
    repeated values, arrays and scalars give NULL.
    """
    # bound by a lambda, so that the text is parsed once
    return F.transform(F.array(marked_parse(value)), lambda p: sole_object(p, value))[0]
