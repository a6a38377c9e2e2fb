"""License notices by template matching.

A template is the wording of a notice with optional parts and replaceable ones. It is compiled into an
automaton over words: a mandatory word is an edge, an optional part may be skipped, a replaceable part
takes up to so many words of any kind. A text has the label where the automaton reaches its end, so all
mandatory words must stand there, in order and unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.session import package_on_workers

#: Every byte that belongs to a word stands for itself (A-Z for a-z), all others for a blank.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# Phrases whose places are counted, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices. [words] may be missing; {n} stands for up to n words.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "spdx license identifier mit"),
    ("apache-2", "licensed under the apache license version 2 [0] [the license] [you may not use this file except in compliance with the license]"),
    ("apache-2", "spdx license identifier apache 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "[licensed] [released] under [the terms of] the [new] [simplified] [{1} clause] bsd license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "[licensed] [released] [distributed] under [the terms of] the gnu general public license [as published by the free software foundation] [version {1}]"),
    ("lgpl", "under [the terms of] the gnu lesser general public license [version {1}]"),
    ("agpl", "under [the terms of] the gnu affero general public license [version {1}]"),
    ("mpl", "subject to the terms of the mozilla public license [v] [version] {2}"),
    ("mpl", "under [the terms of] the mozilla public license [version {2}]"),
    ("cc0", "cc0 1 0 [universal]"),
    ("cc-by", "[licensed] under [a] [the] creative commons attribution [{2}] international license"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "copyright [c] {6} all rights reserved"),
]


@dataclass
class Automaton:
    """States are numbers; from each, words lead on, any word may, and some steps are free."""

    label: str
    base: bool
    by_word: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    by_any: list[int | None] = field(default_factory=lambda: [None])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    needs: frozenset[bytes] = frozenset()

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append(None)
        self.free.append([])
        return len(self.free) - 1

    def _read(self, template: str) -> None:
        at, depth, begun, needs = 0, 0, [], set()
        for part in re.findall(r"\[|\]|\{\d+\}|[^\s\[\]{}]+", template):
            if part == "[":
                begun.append(at)
                depth += 1
            elif part == "]":
                self.free[begun.pop()].append(at)
                depth -= 1
            elif part[0] == "{":
                starts = [at]
                for _ in range(int(part[1:-1])):
                    self.by_any[at] = at = self._state()
                    starts.append(at)
                for s in starts[:-1]:
                    self.free[s].append(at)
            else:
                word = part.encode()
                target = self._state()
                self.by_word[at][word] = target
                at = target
                if not depth:
                    needs.add(word)
        self.needs = frozenset(needs)

    @classmethod
    def of(cls, label: str, template: str, base: bool = False) -> Automaton:
        made = cls(label, base)
        made._read(template)
        return made

    def _spread(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def starts(self) -> set[bytes]:
        return {w for s in self._spread({0}) for w in self.by_word[s]}

    def end(self, words: list[bytes], at: int) -> int | None:
        """The place after the longest match that starts at ``at``."""
        last, states, best = len(self.free) - 1, self._spread({0}), None
        while True:
            if last in states:
                best = at
            if at == len(words):
                return best
            word = words[at]
            states = {s for s in (self.by_word[s].get(word) for s in states) if s is not None} | {self.by_any[s] for s in states if self.by_any[s] is not None}
            if not states:
                return best
            states = self._spread(states)
            at += 1


def compiled(base: dict[str, str], templates: list[tuple[str, str]]) -> list[Automaton]:
    return [Automaton.of(label, phrase, True) for phrase, label in base.items()] + [Automaton.of(label, t) for label, t in templates]


def scan_text(text: bytes, automata: list[Automaton]) -> tuple:
    """(n_words, n_base, first, last, base labels, labels, score, matches) of one text."""
    plain = text.translate(WORDS)
    words = plain.split()
    base_at: list[int] = []
    matches: list[tuple[str, int, int]] = []
    covered: set[int] = set()
    base_labels = set()
    for a in automata:
        if not all(w in plain for w in a.needs):
            continue
        starts, beyond = a.starts(), 0
        for at in (i for i, w in enumerate(words) if w in starts):
            if not a.base and at < beyond:
                continue
            end = a.end(words, at)
            if end is None or end == at:
                continue
            beyond = end
            matches.append((a.label, at, end))
            covered.update(range(at, end))
            if a.base:
                base_at.append(at)
                base_labels.add(a.label)
    labels = base_labels | {m[0] for m in matches}
    first, last = (min(base_at), max(base_at)) if base_at else (None, None)
    return len(words), len(base_at), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), len(covered) / len(words) if words else 0.0, sorted(matches, key=lambda m: (m[1], m[2], m[0]))


SCANNED = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, matches array<struct<label:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Labels and places of license notices in every document.

    Texts are lower-cased in A-Z; words are runs of letters, digits and non-ASCII characters. ``base``
    phrases are templates without optional parts; each of their places counts, also overlapping ones.
    Returns doc_id, n_words, n_base, first_word and last_word (their smallest and largest start, null
    without one), base_labels, labels (sorted, joined by commas), score (share of words in a notice) and
    matches (label, first word, word after the last).

    A null text is empty: no words, empty labels, score 0. Rows with equal or null ids are scanned one by
    one. Empty tables give empty results; other columns are ignored.
    """
    package_on_workers(docs.sparkSession)
    automata = compiled(BASE if base is None else base, TEMPLATES if templates is None else templates)
    kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("matches", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t or b"", automata) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            matches = [[{"label": n, "start": a, "end": b} for n, a, b in m] for m in columns[7]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip([*columns[:7], matches], kinds.types[1:], strict=True))], schema=kinds)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, SCANNED)
