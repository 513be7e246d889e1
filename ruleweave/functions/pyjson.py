"""Key-sorted JSON text of a log in the layout that alert ids are made from.

The layout: keys sorted by code point at every level, ``", "`` and ``": "`` as separators, ASCII only with
``\\uXXXX`` escapes, the shortest decimal text of a float. VARIANT sorts the keys, but changes numbers
and escapes; so every key and scalar goes through it as hex text and is put back afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for an escaped backslash and an escaped quote; neither may occur raw in JSON text.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_TOKENS = r'"[^"]*"|[\{\}\[\]:,]|[^\s"\{\}\[\]:,]+'
_PLAIN = r"^[ -\[\]-~]*$"
_PARTS = r"\\u[0-9a-fA-F]{4}|\\.|[\x01\x02]|[ -\[\]-~]+|[^ -~\x01\x02]+"
# Code units with a short escape.
_SHORT = {"0022": '\\"', "005C": "\\\\", "0008": "\\b", "0009": "\\t", "000A": "\\n", "000C": "\\f", "000D": "\\r"}


def _hex(text: Column) -> Column:
    return F.hex(F.encode(text, "UTF-8"))


def _unhex(text: Column) -> Column:
    return F.decode(F.unhex(text), "UTF-8")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _unit(code: Column) -> Column:
    """Text of an escaped UTF-16 code unit (four upper-case hex digits)."""
    out = F.when(code == "0022", F.lit(_SHORT["0022"]))
    for unit, text in list(_SHORT.items())[1:]:
        out = out.when(code == unit, F.lit(text))
    return out.when(code.between("0020", "007E"), _unhex(F.substring(code, 3, 2))).otherwise(
        F.concat(F.lit("\\u"), F.lower(code)))


def _part(p: Column) -> Column:
    """A piece of a string's content: an escape, a run of printable ASCII, or a run of other characters."""
    return (F.when(p == _BACKSLASH, F.lit("\\\\")).when(p == _QUOTE, F.lit('\\"')).when(p == "\\/", F.lit("/"))
            .when(p.startswith("\\u"), _unit(F.upper(F.substring(p, 3, 4))))
            .when(p.startswith("\\") | p.rlike("^[ -~]"), p)
            .otherwise(F.regexp_replace(F.lower(F.hex(F.encode(p, "UTF-16BE"))), "(....)", r"\\u$1")))


def _string(token: Column) -> Column:
    """A string token (quotes included) in the layout."""
    parts = F.regexp_extract_all(F.substring(token, F.lit(2), F.length(token) - 2), F.lit(_PARTS), F.lit(0))
    return F.when(token.rlike(_PLAIN), token).otherwise(
        F.concat(F.lit('"'), F.array_join(F.transform(parts, _part), ""), F.lit('"')))


def _decimal(text: Column) -> Column:
    """Struct (sign, sig, exp) of a decimal text: significant digits, and the exponent of the first of them."""
    mantissa = F.regexp_extract(text, r"^-?([0-9]+)", 1)
    digits = F.concat(mantissa, F.regexp_extract(text, r"^-?[0-9]+\.([0-9]+)", 1))
    bare = F.regexp_replace(digits, "^0+", "")
    power = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]\+?(-?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    return F.struct(F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
                    F.regexp_replace(bare, "0+$", "").alias("sig"),
                    (power + F.length(mantissa) - 1 - (F.length(digits) - F.length(bare))).alias("exp"))


def _written(s: Column) -> Column:
    sig, e = s["sig"], s["exp"]
    n = F.length(sig)
    plain = (F.when(e >= n - 1, F.concat(sig, F.repeat(F.lit("0"), e - n + 1), F.lit(".0")))
             .when(e >= 0, F.concat(F.substring(sig, F.lit(1), e + 1), F.lit("."), F.substring(sig, e + 2, n)))
             .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), sig)))
    point = F.when(n > 1, F.concat(F.lit("."), F.substring(sig, F.lit(2), n))).otherwise(F.lit(""))
    power = F.format_string("%02d", F.abs(e))
    scientific = F.concat(F.substring(sig, 1, 1), point, F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")), power)
    return F.concat(s["sign"], F.when(n == 0, F.lit("0.0")).when(e.between(-4, 15), plain).otherwise(scientific))


def _float(token: Column) -> Column:
    """Shortest decimal text of a float: plain for exponents -4 to 15, else ``d.ddde+XX``."""
    def layout(d: Column) -> Column:
        text = d.cast("string")

        def shortest(s: Column) -> Column:
            # the JVM's text can have a digit more than it takes to tell the number from others
            shorter = F.printf(F.concat(F.lit("%."), F.greatest(F.length(s["sig"]) - 2, F.lit(0)).cast("string"), F.lit("e")), d)
            return _bound(F.when((F.length(s["sig"]) > 1) & (shorter.cast("double") == d), _decimal(shorter)).otherwise(s), _written)

        return F.when(text.endswith("Infinity"), text).otherwise(_bound(_decimal(text), shortest))

    return _bound(token.cast("double"), layout)


def _scalar(token: Column) -> Column:
    return (F.when(token.startswith('"'), _string(token))
            .when(token.rlike("^-?[0-9]+$"), F.when(token == "-0", F.lit("0")).otherwise(token))
            .when(token.rlike("^-?[0-9]"), _float(token)).otherwise(token))


def _key_order(token: Column) -> Column:
    """Hex of a key's UTF-8 text: its order is the order by code points."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    spelled = F.replace(F.replace(token, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return _hex(F.when(token.rlike(_PLAIN), inner).otherwise(
        F.from_json(F.concat(F.lit("["), spelled, F.lit("]")), "array<string>")[0]))


def canonical_text(raw: Column) -> Column:
    """The layout above for valid JSON text of an object; NULL where a key is repeated within an object.

    Integers keep all their digits. Numbers too large for a float become ``Infinity``.
    """
    text = F.replace(F.replace(raw, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))

    def coded(tokens: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            key = F.concat(F.lit('"'), _key_order(t), F.lit("-"), _hex(_string(t)), F.lit('"'))
            return (F.when(t.rlike(r"^[\{\}\[\]:,]$"), t)
                    .when(F.coalesce(F.get(tokens, i + 1) == ":", F.lit(False)), key)
                    .otherwise(F.concat(F.lit('"'), _hex(_scalar(t)), F.lit('"'))))
        return F.array_join(F.transform(tokens, one), "")

    hexed = _bound(F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0)), coded)
    # between quotes: hex text (of a key: order, "-", text); elsewhere only punctuation
    ordered = F.split(F.to_json(F.try_parse_json(hexed)), '"')
    back = F.transform(ordered, lambda p, i: F.when(i % 2 == 1, _unhex(F.regexp_replace(p, "^.*-", ""))).otherwise(
        F.replace(F.replace(p, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))))
    return F.array_join(back, "")
