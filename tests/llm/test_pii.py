import random
import re

import pytest

from ruleweave.llm import pii


def brute(text):
    """The base kinds by their plain patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@pytest.fixture(scope="module")
def anchors():
    return pii._automaton()


def test_base_kinds_match_their_patterns(anchors):
    rnd = random.Random(17)
    for alphabet in ("aé.@1-+ ", "0123456789.", "0123456789 -", "+1 (2).-5 é", "a.@b-%_+@. "):
        for _ in range(6000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40)))
            assert [s for s in pii.find_spans(text, anchors) if s[0] in pii.BASE_KINDS] == brute(text), text


def test_cards(anchors):
    text = "é 4111 1111 1111 1111, 4111111111111112 and 4111-1111-1111-1111"
    assert [text[a:b] for k, a, b in pii.find_spans(text, anchors) if k == "card"] == [
        "4111 1111 1111 1111", "4111-1111-1111-1111"]


@pytest.mark.parametrize("text, kind, found", [
    ("see https://example.com/a?b=1).", "url", ["https://example.com/a?b=1"]),
    ("ssh://user@10.0.0.1:22/x and xhttp://example.com", "url", ["ssh://user@10.0.0.1:22/x"]),
    ("http:// nothing http://-", "url", []),
    ("by @jane_doe, not a@b or @1 or x@", "handle", ["@jane_doe"]),
    ("mail jane@example.com", "handle", []),
    ("Account number: 12345678; account of note", "account", ["12345678"]),
    ("password=7602ad27cf55 TOKEN = \"1beb58b8\"", "account", ["7602ad27cf55", "1beb58b8"]),
    ("IBAN: DE89 3704 0044 0532 0130 00", "account", ["DE89 3704 0044 0532 0130 00"]),
    ("tokens: 123456 mytoken=123456 token: abcdef", "account", []),
])
def test_anchors_expand_to_validated_bounds(anchors, text, kind, found):
    got = [text[a:b] for k, a, b in pii.find_spans(text, anchors) if k == kind]
    assert [g.strip() for g in got] == found


def test_long_hostile_texts_stay_linear(anchors):
    for text in ("1" * 300_000, "1." * 150_000, "+1" * 150_000, "a" * 300_000 + "@", "@" * 300_000, "a@" * 150_000,
                 "+" + "1 " * 150_000 + "x", "a." * 150_000 + "@b", "http://" * 40_000, "http://a.b/" * 30_000,
                 "token: " + "a1 " * 100_000):
        pii.find_spans(text, anchors)


def test_rows(frame, spark):
    rows = [(1, None), (2, ""), (None, "a@b.cc"), (3, "é a@b.cc 1.2.3.4"), (3, "é a@b.cc 1.2.3.4"), (4, "x " * 50_000 + "1.2.3.4")]
    got = sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in pii.find_pii(frame(rows)).collect())
    assert got == [("1", []), ("2", []), ("3", [("email", 2, 8), ("ip", 9, 16)]), ("3", [("email", 2, 8), ("ip", 9, 16)]),
                   ("4", [("ip", 100_000, 100_007)]), ("None", [("email", 0, 6)])]
    clean = {(r.doc_id, r.text) for r in pii.redact(frame(rows)).collect()}
    assert (3, "é <email> <ip>") in clean and (1, "") in clean
    assert pii.find_pii(frame([])).collect() == []
