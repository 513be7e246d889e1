"""Licence scan by template markup: licence wordings with optional and replaceable regions as token automata.

Markup: plain words are mandatory; `a|b` accepts either word; `[[ ... ]]` is optional; `{0-8}` stands for
that many words of any text. A template compiles to a nondeterministic automaton over words. Its longest
run of mandatory plain words is looked up in the text first; around each occurrence the automaton runs
from every start its leading regions allow, and accepts where all mandatory wording matches exactly.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Licence wordings in markup, by label; standard notices and opening or closing words of licence texts.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0 [[ the license you may not use this file except in compliance "
        "with the license ]]"],
    "gpl-2.0": [
        "under the [[ terms of the ]] gnu general public license [[ as published by the free software foundation ]] "
        "[[ either ]] version 2"],
    "gpl-3.0": [
        "under the [[ terms of the ]] gnu general public license [[ as published by the free software foundation ]] "
        "[[ either ]] version 3"],
    "mit": [
        "released|licensed|distributed under the [[ terms of the ]] mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of {1-12} to deal in the software "
        "without restriction"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met"],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted"],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2 0"],
    "cc-by-4.0": ["under [[ a|the ]] [[ creative commons ]] cc by 4 0", "creative commons attribution 4 0 international"],
    "cc-by-nc-4.0": ["under [[ a|the ]] cc by nc 4 0", "creative commons attribution noncommercial 4 0 international"],
    "cc-by-sa-4.0": ["under [[ a|the ]] cc by sa 4 0", "creative commons attribution sharealike 4 0 international"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "all-rights-reserved": ["[[ copyright {0-6} ]] all rights reserved"],
}

# Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: every other byte becomes a space.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))
_ANY = None


class TokenAutomaton:
    """One template: `steps[state]` lists (accepted words or any, next state); `free[state]` states reached without a word."""

    def __init__(self, label: str, markup: str):
        self.label = label
        self.steps: list[list[tuple[frozenset | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        opened: list[int] = []
        run: list[bytes] = []
        self.anchor: list[bytes] = []
        self.before = lead = longest = 0
        at = 0
        for token in markup.split():
            region = re.fullmatch(r"\{(\d+)-(\d+)\}", token)
            plain = not (opened or region or token in ("[[", "]]") or "|" in token)
            if token == "[[":
                opened.append(at)
            elif token == "]]":
                self.free[opened.pop()].append(at)
            elif region:
                low, high = map(int, region.groups())
                skips = []
                for i in range(high):
                    if i >= low:
                        skips.append(at)
                    at = self._add(at, _ANY)
                for s in skips:
                    self.free[s].append(at)
                lead += high
            else:
                at = self._add(at, frozenset(w.encode() for w in token.split("|")))
                lead += 1
            if plain:
                run.append(token.encode())
                if len(run) > longest:
                    longest, self.anchor, self.before = len(run), list(run), lead - len(run)
            else:
                run = []
        self.end = at
        # every text before the anchor takes at most `before` words
        self.needle = b" " + b" ".join(self.anchor) + b" "

    def _add(self, at: int, words: frozenset | None) -> int:
        self.steps.append([])
        self.free.append([])
        self.steps[at].append((words, len(self.steps) - 1))
        return len(self.steps) - 1

    def _open(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accepts(self, words: list[bytes], start: int) -> int | None:
        """The end of the longest match from `start`, or None."""
        states, found = self._open({0}), None
        for at in range(start, len(words) + 1):
            if self.end in states:
                found = at
            if at == len(words):
                break
            states = self._open({to for s in states for want, to in self.steps[s] if want is _ANY or words[at] in want})
            if not states:
                break
        return found


def _places(joined: bytes, needle: bytes) -> list[int]:
    """Word indexes of all occurrences (overlapping ones too); joined has one space before and after each word."""
    out, at, word, done = [], joined.find(needle), 0, 0
    while at >= 0:
        word += joined.count(b" ", done, at)
        out.append(word)
        done = at
        at = joined.find(needle, at + 1)
    return out


def scan_text(text: str, automata: list[TokenAutomaton]) -> tuple[int, list[tuple[str, str, int, int]]]:
    """(number of words, hits as (kind, label, start word, end word) in order of kind and start)."""
    words = text.encode().translate(_TO_WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    hits = []
    for phrase, label in PHRASES.items():
        length = len(phrase.split())
        hits += [("phrase", label, w, w + length) for w in _places(joined, f" {phrase} ".encode())]
    for automaton in automata:
        done = -1
        for place in _places(joined, automaton.needle):
            for start in range(max(0, place - automaton.before, done), place + 1):
                end = automaton.accepts(words, start)
                if end is not None and end > place:
                    hits.append(("template", automaton.label, start, end))
                    done = end
                    break
    return len(words), sorted(hits, key=lambda h: (h[0], h[2], h[1], h[3]))


def compile_templates(templates: dict[str, list[str]]) -> list[TokenAutomaton]:
    return [TokenAutomaton(label, markup) for label, texts in templates.items() for markup in texts]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document row: (doc_id, n_words, hits, score).

    hits: all places of base phrases and all accepted templates, with label and word range. score: 1 where a
    template is accepted, 0.5 where only a phrase occurs, else 0. Null or empty text: no words, no hits.
    Repeated rows get equal results, a null doc_id stays null. Empty table: no rows.
    """
    element = pa.struct([("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        automata = compile_templates(TEMPLATES if templates is None else templates)
        for batch in batches:
            found = [scan_text(t.as_py() or "", automata) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[dict(zip(("kind", "label", "start", "end"), h)) for h in hits] for _, hits in found],
                          pa.list_(element))], ["doc_id", "n_words", "hits"])

    found = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id bigint, n_words bigint, hits array<struct<kind:string,label:string,start:bigint,end:bigint>>")
    return found.withColumn("score", F.expr("CASE WHEN exists(hits, h -> h.kind = 'template') THEN 1D "
                                            "WHEN size(hits) > 0 THEN 0.5D ELSE 0D END"))
