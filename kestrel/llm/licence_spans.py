"""Licence scans by a generalised suffix automaton of licence words.

The templates are compiled into one suffix automaton over words: every run of
words that occurs in any template is a path, and each state knows, per template,
where one of its occurrences ends.  A text is streamed through the automaton,
which gives at each word the longest run ending there that some template holds
(matching statistics).  Maximal runs of ``min_run`` words or more become matches
(text place, template place, length), and matches of one template are chained
where both places go on, with at most ``max_gap`` words between.  A chain that
covers enough of its template labels a span of the text.

Phrases are found exactly, wherever their words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import text_slices

#: Words of a text once A-Z is lower case: ASCII letters and digits, and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Phrase -> label (fixed values of the contract).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label -> notices by which files state a licence (fixed values: the public notices' wording).
TEMPLATES = {
    "apache": ["licensed under the apache license version 2 0",
               "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
               "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
               "without warranties or conditions of any kind either express or implied"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
            "licensed under the bsd license"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "mit": ["released under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
            "to deal in the software without restriction"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}


class Automaton:
    """Generalised suffix automaton of word-id sequences; state 0 is the empty run."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]  # template -> place behind one occurrence of the state's longest run
        for t, words in enumerate(sequences):
            last = 0
            for place, w in enumerate(words, 1):
                last = self._add(last, w)
                self.ends[last].setdefault(t, place)
        for s in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):  # a run's suffixes end where it ends
            for t, place in self.ends[s].items():
                self.ends[self.link[s]].setdefault(t, place)

    def _state(self, size: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.ends.append({})
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the runs that come over ``state``; moves of shorter runs go to it."""
        copy = self._state(self.size[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _add(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # known from another template
            return target if self.size[target] == self.size[last] + 1 else self._split(last, word, target)
        new, at = self._state(self.size[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            self.link[new] = target if self.size[target] == self.size[at] + 1 else self._split(at, word, target)
        return new

    def step(self, state: int, size: int, word: int) -> tuple[int, int]:
        """Matching statistics: (state, length of the longest run ending at this word)."""
        while state and word not in self.next[state]:
            state = self.link[state]
            size = self.size[state]
        if word in self.next[state]:
            return self.next[state][word], size + 1
        return 0, 0


class Scanner:
    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str], min_run: int, max_gap: int, cover: float):
        self.labels = [label for label, texts in templates.items() for _ in texts]
        split = [t.encode().split() for texts in templates.values() for t in texts]
        self.sizes = [len(s) for s in split]
        self.ids = {w: i for i, w in enumerate(sorted({w for s in split for w in s} | {w.encode() for p in phrases for w in p.split()}))}
        self.automaton = Automaton([[self.ids[w] for w in s] for s in split])
        self.phrases = [([self.ids[w.encode()] for w in p.split()], label) for p, label in phrases.items()]
        self.min_run, self.max_gap, self.cover = min_run, max_gap, cover

    def matches(self, places: list[int], ids: list[int]) -> list[tuple[int, int, int, int]]:
        """(template, text place, template place, length) of maximal runs; ``places`` are those of the known words."""
        a, out, state, size, before = self.automaton, [], 0, 0, -2

        def report(end: int) -> None:
            if size >= self.min_run:
                out.extend((t, end - size, behind - size, size) for t, behind in a.ends[state].items())

        for place, word in zip(places, ids, strict=True):
            if place != before + 1:
                report(before + 1)
                state, size = 0, 0
            new = a.step(state, size, word)
            if new[1] <= size:  # the run didn't grow: it was maximal
                report(place)
            (state, size), before = new, place
        report(before + 1)
        return out

    def spans(self, places: list[int], ids: list[int]) -> list[tuple[int, int, str, float]]:
        """(first word, last word, label, part of the template covered) of the chains that cover enough."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for t, x, y, n in self.matches(places, ids):
            by.setdefault(t, []).append((x, y, n))
        out = []
        for t, found in by.items():
            chains: list[list[int]] = []  # first place, place behind in the text, place behind in the template, words covered
            near: list[list[int]] = []  # those that may still go on
            for x, y, n in sorted(set(found)):
                near = [c for c in near if x - c[1] <= self.max_gap]
                # goes on behind in text and template, after a small gap or overlap
                best = max((c for c in near if x + n > c[1] and y + n > c[2] and -self.min_run < x - c[1] <= self.max_gap and -self.min_run < y - c[2] <= self.max_gap),
                           key=lambda c: c[3], default=None)
                if best is None:
                    chains.append([x, x + n, y + n, n])
                    near.append(chains[-1])
                else:
                    best[1:] = [x + n, y + n, best[3] + min(n, x + n - best[1], y + n - best[2])]
            out += [(c[0], c[1] - 1, self.labels[t], min(1.0, c[3] / self.sizes[t])) for c in chains if c[3] >= self.cover * self.sizes[t]]
        return sorted(out)

    def scan(self, text: bytes) -> tuple:
        """(words, phrase places, spans)."""
        words = WORD.findall(text.lower())
        known = self.ids
        places = [i for i, w in enumerate(words) if w in known]
        ids = [known[words[i]] for i in places]
        at = {p: i for i, p in enumerate(places)} if places else {}
        hits = []
        for p, i in zip(places, ids, strict=True):
            for phrase, label in self.phrases:
                if i == phrase[0] and all(p + k in at and ids[at[p + k]] == w for k, w in enumerate(phrase)):
                    hits.append((p, label))
        return len(words), hits, self.spans(places, ids) if len(places) >= self.min_run else []


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None, min_run: int = 3, max_gap: int = 6,
         cover: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, phrase places (word, label), spans (first_word, last_word, label, cover).

    A null or empty text has no words.  ``cover`` is the least part of a template
    that a chain must cover; ``min_run`` the least words of a match.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    schema = ("doc_id long, n_words long, phrases array<struct<word:long,label:string>>, "
              "spans array<struct<first_word:long,last_word:long,label:string,cover:double>>")
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(templates, phrases, min_run, max_gap, cover)
        for (ids,), texts in text_slices(batches):
            found = [scanner.scan(t) for t in texts]
            columns = [ids, [f[0] for f in found], [[{"word": w, "label": x} for w, x in f[1]] for f in found],
                       [[{"first_word": a, "last_word": b, "label": x, "cover": c} for a, b, x, c in f[2]] for f in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], names=kinds.names)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)
