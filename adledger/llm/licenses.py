"""License scans by template-markup matching.

A template is a license's wording with markup: ``<<beginOptional>> ... <<endOptional>>`` may be left out, and
``<<var;match=...;words=a-b>>`` stands for a to b words that each match. Templates are compiled to automata over words.
A text has a license where an automaton accepts a run of its words, so all mandatory wording stands there exactly and in
order. Fixed phrases are found beside them.

Words are runs of ASCII letters and digits and of anything beyond ASCII, lower-cased in A-Z. An automaton is only started
where its first mandatory run of words stands, and only in texts that have the longest such run of each template.

Defined cases: a null text is empty and has no words, no labels and score 0. Repeated rows and null ids are scanned like
all others. An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from adledger.llm.rows import bodies, slices

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Wording of public licenses and of the notices that name them.
TEMPLATES = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        <<beginOptional>><<var;match=https?>><<endOptional>> www.apache.org/licenses/LICENSE-2.0<<endOptional>>""",
    "cc-by-family": """<<beginOptional>>This <<var;match=[a-z]+;words=1-2>> is<<endOptional>> Licensed under
        <<beginOptional>>a Creative Commons<<endOptional>> <<beginOptional>>the<<endOptional>> CC BY
        <<beginOptional>><<var;match=nc|nd|sa;words=1-2>><<endOptional>> <<var;match=[1-4]>> <<var;match=0|5>>
        <<beginOptional>>International<<endOptional>> <<beginOptional>>License<<endOptional>>""",
    "gpl-notice": """<<beginOptional>>This <<var;match=[a-z]+;words=1-2>> is<<endOptional>> licensed under the
        <<beginOptional>>terms of the<<endOptional>> GNU <<beginOptional>><<var;match=lesser|affero|library>><<endOptional>>
        General Public License <<beginOptional>>version <<var;match=[123]>> <<beginOptional>><<var;match=[01]>><<endOptional>>
        <<beginOptional>>or <<beginOptional>>at your option<<endOptional>> any later version<<endOptional>><<endOptional>>""",
    "mit-notice": """<<var;match=released|licensed|distributed|available>> under the <<beginOptional>>terms of the<<endOptional>>
        MIT <<beginOptional>>open source<<endOptional>> License""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in
        all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND <<var;words=1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: <<var;match=1|a;words=0-1>> Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. <<var;match=2|b;words=0-1>> Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution. <<beginOptional>><<var;match=3|c;words=0-1>> Neither the name of
        <<var;words=1-16>> may be used to endorse or promote products derived from this software without specific prior written
        permission.<<endOptional>> THIS SOFTWARE IS PROVIDED BY <<var;words=1-16>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
}

#: Every byte to what words are made of: letters lower-cased, everything that separates words to a space.
FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
MARKUP = re.compile(r"<<(beginOptional|endOptional|var[^<>]*)>>")


def words_of(body: bytes) -> list[bytes]:
    return body.translate(FOLD).split()


@dataclass
class Automaton:
    """States with steps on a word (a literal, or a pattern for any word) and steps on nothing."""

    literal: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    pattern: list[list[tuple[re.Pattern, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    runs: list[list[bytes]] = field(default_factory=list)
    #: The state before the first mandatory word.
    begin: int = -1

    def _state(self) -> int:
        self.literal.append({})
        self.pattern.append([])
        self.free.append([])
        return len(self.free) - 1

    @classmethod
    def compiled(cls, template: str) -> Automaton:
        """``runs``: the mandatory runs of words, outside of all markup."""
        a, at, open_, run = cls(), 0, [], []
        for k, part in enumerate(MARKUP.split(template)):
            if k % 2 == 0:
                for w in words_of(part.encode()):
                    if not open_:
                        run.append(w)
                        a.begin = at if a.begin < 0 else a.begin
                    new = a._state()
                    a.literal[at][w] = new
                    at = new
                continue
            if run:
                a.runs.append(run)
                run = []
            if part == "beginOptional":
                open_.append(at)
                new = a._state()
                a.free[at].append(new)
                at = new
            elif part == "endOptional":
                new = a._state()
                a.free[at].append(new)
                a.free[open_.pop()].append(new)
                at = new
            else:
                given = dict(x.split("=", 1) for x in part.split(";")[1:])
                least, most = map(int, given.get("words", "1-1").split("-"))
                test, ways = re.compile(given.get("match", ".+").encode(), re.DOTALL), [at] if not least else []
                for n in range(1, most + 1):
                    new = a._state()
                    a.pattern[at].append((test, new))
                    at = new
                    if n >= least:
                        ways.append(at)
                end = a._state()
                for way in ways:
                    a.free[way].append(end)
                at = end
        if open_:
            raise ValueError("an optional region is not closed")
        if run:
            a.runs.append(run)
        if not a.runs:
            raise ValueError("a template needs mandatory wording")
        a.last = at
        return a

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words: list[bytes], start: int) -> int:
        """Where the longest accepted run of words from ``start`` ends, or -1."""
        states, end = self._closed({0}), -1
        for at in range(start, len(words) + 1):
            if self.last in states:
                end = at
            if at == len(words) or not states:
                break
            w = words[at]
            after = {self.literal[s][w] for s in states if w in self.literal[s]}
            after |= {t for s in states for test, t in self.pattern[s] if test.fullmatch(w)}
            states = self._closed(after)
        return end

    def reach(self) -> int:
        """Most words before the first mandatory run. Every step leads to a state of a higher number, so one pass is enough."""
        depth = {0: 0}
        for s in range(self.begin):
            if s in depth:
                for t, step in [*((t, 0) for t in self.free[s]), *((t, 1) for t in self.literal[s].values()), *((t, 1) for _, t in self.pattern[s])]:
                    depth[t] = max(depth.get(t, 0), depth[s] + step)
        return depth[self.begin]


def _places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers where a phrase starts, in words joined and framed by single spaces."""
    found, at, counted, n = [], joined.find(phrase), 0, 0
    while at >= 0:
        n += joined.count(b" ", counted, at)
        counted = at
        found.append(n)
        at = joined.find(phrase, at + 1)
    return found


def framed(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


class Matcher:
    """Compiled templates, each with its first mandatory run, where it starts, and all runs, which a text must have."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.rules = []
        for label, template in templates.items():
            a = Automaton.compiled(template)
            needed = sorted((framed(r) for r in a.runs), key=len, reverse=True)
            self.rules.append((label, a, needed, framed(a.runs[0]), a.reach()))

    def matches(self, words: list[bytes], joined: bytes) -> list[tuple[str, int, int]]:
        """(label, start, end) of accepted runs, longest first start, not overlapping for a label."""
        found = []
        for label, a, needed, first, reach in self.rules:
            if not all(n in joined for n in needed):
                continue
            done = 0
            for place in _places(joined, first):
                for start in range(max(done, place - reach), place + 1):
                    end = a.longest(words, start)
                    if end > place:
                        found.append((label, start, end))
                        done = end
                        break
        return found


def _scan(batches: Iterator[pa.RecordBatch], templates: dict[str, str], phrases: dict[str, str]) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(templates)
    fixed = [(framed(words_of(p.encode())), len(p.split()), label) for p, label in phrases.items()]
    match = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "matches", "score"]
    for batch in slices(batches):
        rows = []
        for body in batch.column(1).to_pylist():
            words = words_of(body)
            joined = framed(words)
            places = [(p, p + n, label) for phrase, n, label in fixed for p in _places(joined, phrase)]
            matches = matcher.matches(words, joined)
            spans, covered, at = sorted([(s, e) for s, e, _ in places] + [(s, e) for _, s, e in matches]), 0, 0
            for s, e in spans:
                covered += max(0, e - max(s, at))
                at = max(at, e)
            starts = [p for p, _, _ in places]
            rows.append((len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, _, x in places}), [{"label": x, "start": s, "end": e} for x, s, e in matches], covered / len(words) if words else 0.0))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), match, pa.float64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, places of the phrases, their labels, ``matches`` (label, start, end in words) and ``score``.

    ``score`` is the share of the text's words that phrases and matches cover.
    """
    run = partial(_scan, templates=TEMPLATES if templates is None else templates, phrases=PHRASES if phrases is None else phrases)
    return bodies(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, matches array<struct<label:string,start:long,end:long>>, score double",
    )
