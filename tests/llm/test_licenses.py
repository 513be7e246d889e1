import random
import re

import pytest

from ruleweave.llm import licenses as L


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_phrases(text):
    w = words_of(text)
    return sorted((i, label) for phrase, label in L.PHRASES.items() for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split())


def as_pattern(markup):
    """The same template as a regular expression over words with a trailing space each."""
    out = ""
    for token in markup.split():
        region = re.fullmatch(r"\{(\d+)-(\d+)\}", token)
        out += ("(?:" if token == "[[" else ")?" if token == "]]" else
                rf"(?:\S+ ){{{region[1]},{region[2]}}}" if region else f"(?:{token}) ")
    return out


@pytest.mark.parametrize("markup", [
    "a b c", "a [[ b ]] c d", "x|y {0-2} c d", "[[ a {1-2} ]] b c", "a [[ b [[ c ]] ]] d {2-3} a b"])
def test_automata_accept_what_the_markup_means(markup):
    rnd = random.Random(23)
    automaton = L.TokenAutomaton("t", markup)
    pattern = re.compile(as_pattern(markup))
    for _ in range(1500):
        text = "".join(rnd.choice("abcdxyz") + " " for _ in range(rnd.randrange(14)))
        _, hits = L.scan_text(text, [automaton])
        assert bool(hits) == bool(pattern.search(text)), text


def test_phrases_match_brute_force():
    rnd = random.Random(29)
    parts = ["GNU", "general-public", "license", "CC", "by", "mit", "Apache", "É", "日", "\n", "x1", "general", "public"]
    for _ in range(3000):
        text = rnd.choice(["", " "]).join(rnd.choice(parts) + rnd.choice([" ", ".", "/"]) for _ in range(rnd.randrange(30)))
        n, hits = L.scan_text(text, [])
        assert n == len(words_of(text))
        assert sorted((h[2], h[1]) for h in hits) == brute_phrases(text)


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2",
     {"gpl", "gpl-2.0"}),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", {"apache", "apache-2.0"}),
    ("Licensed under the Apache License, Version 1.1", {"apache"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
    ("Released under the MIT License.", {"mit"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this thing, to deal in the Software "
     "without restriction", {"mit"}),
    ("Copyright (c) 2020 A. Person. All rights reserved.", {"all-rights-reserved"}),
    ("permission is hereby granted, free of cost", set()),
    ("All rights are reserved", set()),
])
def test_templates(text, labels):
    _, hits = L.scan_text("x " + text + " y", L.compile_templates(L.TEMPLATES))
    assert {h[1] for h in hits} == labels


def test_rows(frame):
    rows = [(1, None), (2, ""), (None, "MIT license"), (3, "CC BY"), (3, "CC BY"), (4, "x " * 60_000 + "mit license " * 2000)]
    got = {(r.doc_id, r.n_words, len(r.hits), r.score) for r in L.scan_licenses(frame(rows)).collect()}
    assert got == {(1, 0, 0, 0.0), (2, 0, 0, 0.0), (None, 2, 1, 0.5), (3, 2, 1, 0.5), (4, 64_000, 2000, 0.5)}
    assert L.scan_licenses(frame([])).collect() == []
