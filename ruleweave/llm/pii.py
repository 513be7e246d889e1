"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, address schemes and identifier cues. Local
parsers expand each anchor to the left and right and validate what they find: email addresses, handles,
web addresses, and account identifiers named by a cue. Number kinds whose anchor is any digit (ip, card,
phone) are read by linear patterns, only in texts that have a digit. Offsets count code points.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order of kinds in results; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "handle", "account")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
#: Words that name an identifier; matched in lower, title and upper case, as whole words.
CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn", "token",
        "secret", "api_key", "apikey", "access_key", "password", "passwort")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A run of digits is entered only at its first digit and never given back, which keeps matching linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`|\\^{}]+")
# A user part is bounded, so that an anchor without a host is given up at once.
_HOST = re.compile(r"(?:[^\s/?#@<>\"']{1,128}@)?(?:\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|localhost)(?::[0-9]+)?(?![A-Za-z0-9@])")
_HANDLE = re.compile(r"[A-Za-z0-9_]{2,30}(?![A-Za-z0-9_])")
_ASSIGNED = re.compile(r"(?:[ _-]?(?:number|nummer|no|nr|id)\b\.?)?[ \t]*[:=#][ \t]*[\"']?"
                       # further groups as bank identifiers are written: up to four upper-case characters with a digit
                       r"([A-Za-z0-9][A-Za-z0-9_-]*(?: (?=[A-Z]*[0-9])[A-Z0-9]{2,4}(?![A-Za-z0-9]))*)")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    for kind, words in (("url", SCHEMES), ("cue", CUES)):
        for word in words:
            for form in {word, word.capitalize(), word.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _email(text: str, at: int, after: int) -> tuple[int, int] | None:
    """The address around an at-sign, not reaching before `after`."""
    start = at
    while start > after and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _handle(text: str, at: int) -> tuple[int, int] | None:
    if at and (text[at - 1].isalnum() or text[at - 1] in "@/._-%+"):
        return None
    name = _HANDLE.match(text, at + 1)
    return (at, name.end()) if name and any(c.isalpha() for c in name[0]) else None


def _url(text: str, start: int, host: int, after: int) -> tuple[int, int] | None:
    if start < after or start and text[start - 1].isalnum():
        return None
    name = _HOST.match(text, host)
    if not name:
        return None
    end = name.end()
    if text[end:end + 1] in ("/", "?", "#"):
        end = _URL.match(text, end).end()
        while text[end - 1] in ".,;:!?)]*&%$#" and end > name.end():
            end -= 1
    return start, end


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The identifier that a cue assigns: six characters or more, four of them digits."""
    if start and (text[start - 1].isalnum() or text[start - 1] == "_") or text[end:end + 1].isalpha():
        return None
    found = _ASSIGNED.match(text, end)
    if not found or len(found[1]) < 6 or len(_digits(found[1])) < 4:
        return None
    return found.span(1)


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind as listed in KINDS, then by start."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    ends = dict.fromkeys(KINDS, 0)

    def add(kind: str, span: tuple[int, int] | None) -> bool:
        if span and span[0] >= ends[kind]:
            spans[kind].append(span)
            ends[kind] = span[1]
            return True
        return False

    for last, (what, n) in anchors.iter(text):
        start = last - n + 1
        if what == "@":
            if not add("email", _email(text, last, ends["email"])):
                add("handle", _handle(text, last))
        elif what == "url":
            add("url", _url(text, start, last + 1, ends["url"]))
        else:
            add("account", _account(text, start, last + 1))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                spans["ip"].append(m.span())
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans["card"].append(m.span())
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                spans["phone"].append(m.span())
    return [(kind, *span) for kind in KINDS for span in spans[kind]]


def _scan(batches):
    anchors = _automaton()
    element = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        found = [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t.as_py() or "", anchors)]
                 for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(element))], ["doc_id", "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id and its spans (kind, start, end), by kind as in KINDS, then start.

    Null or empty text: no spans. Repeated rows get equal results, a null doc_id stays null, other columns
    are ignored. Empty table: no rows. Spans of different kinds may overlap; spans of one kind do not.
    """
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _scan, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def spans_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in angle brackets; of overlapping spans the longest first."""
    def run(batches):
        anchors = _automaton()
        for batch in batches:
            out = []
            for value in batch.column(1):
                text, end, parts = value.as_py() or "", 0, []
                for kind, a, b in sorted(find_spans(text, anchors), key=lambda s: (s[1], -s[2])):
                    if a >= end:
                        parts += [text[end:a], f"<{kind}>"]
                    end = max(end, b)
                out.append("".join([*parts, text[end:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id bigint, text string")
