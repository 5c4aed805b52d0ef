"""License scans: wording templates with optional and replaceable regions, compiled into token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a text that a task holds as words at a time; longer texts go in pieces.
PIECE_BYTES = 1 << 20

#: Capitals to small letters, every other ASCII character that is no digit or letter to a blank; bytes of longer characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text whose A-Z are lower-cased."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    """Wording that gives a text a label.

    ``markup`` is text with regions in double angle brackets: what stands between ``<<beginOptional>>`` and ``<<endOptional>>`` may be
    left out (regions may be nested), ``<<var;words=LOW-HIGH>>`` stands for any LOW to HIGH words, ``<<var;match=a|b c>>`` for one of
    the wordings listed.  All other words are mandatory, in this order and with nothing between them.  ``score`` says how much a place
    tells: the terms themselves, a notice, a mention.  ``base`` marks the phrases that are reported apart.
    """

    label: str
    markup: str
    score: float
    base: bool = False


# A parsed template is a list of items: a word (bytes), ("words", low, high), ("any", [items, ...]); an optional region is an
# ("any", [items, []]).
_MARK = re.compile(r"<<(.*?)>>", re.S)


def parse(markup: str) -> list:
    """The items of a template; raises ValueError for marks that are unknown or not closed."""
    stack: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(markup):
        stack[-1] += words_of(markup[at : mark.start()].encode())
        at = mark.end()
        kind, _, rest = mark[1].partition(";")
        name, _, value = rest.partition("=")
        if kind == "beginOptional" and not rest:
            stack.append([])
        elif kind == "endOptional" and not rest and len(stack) > 1:
            inner = stack.pop()
            stack[-1].append(("any", [inner, []]))
        elif kind == "var" and name == "words" and re.fullmatch("[0-9]+-[0-9]+", value):
            low, high = map(int, value.split("-"))
            if low > high:
                raise ValueError(f"no number of words fits {mark[0]}")
            stack[-1].append(("words", low, high))
        elif kind == "var" and name == "match" and value:
            stack[-1].append(("any", [words_of(v.encode()) for v in value.split("|")]))
        else:
            raise ValueError(f"unknown mark {mark[0]}")
    if len(stack) > 1:
        raise ValueError("an optional region is not closed")
    return stack[0] + words_of(markup[at:].encode())


@dataclass(frozen=True)
class Automaton:
    """States of all templates together: ``steps`` by state, word (None: any word) to the states behind it.

    States are closed over what may be left out.  ``accepts`` has the templates that end in a state; ``starts`` the states behind the
    first word, so a scan looks at one dictionary per word until a word begins some template.
    """

    templates: tuple[Template, ...]
    steps: list[dict] = field(repr=False)
    accepts: list[tuple[int, ...]] = field(repr=False)
    first: frozenset[int] = field(repr=False)

    @cached_property
    def starts(self) -> dict[bytes, frozenset[int]]:
        words = {w for s in self.first for w in self.steps[s] if w is not None}
        return {w: self.step(self.first, w) for w in words}

    @cached_property
    def longest(self) -> int:
        """Most words that a template can take."""
        return max(_length(parse(t.markup)) for t in self.templates)

    def step(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        out: set[int] = set()
        for s in states:
            on = self.steps[s]
            out.update(on.get(word, ()))
            out.update(on.get(None, ()))
        return frozenset(out)

    def places(self, words: Sequence[bytes], upto: int) -> Iterator[tuple[int, int, int]]:
        """(template, start, end) of the accepted places that start before ``upto``; of a template and start the longest."""
        starts = self.starts
        for at in [i for i, w in enumerate(words[:upto]) if w in starts]:
            states, end = starts[words[at]], at + 1
            found: dict[int, int] = {}
            while states:
                for s in states:
                    for t in self.accepts[s]:
                        found[t] = end
                if end == len(words):
                    break
                states = self.step(states, words[end])
                end += 1
            for t in sorted(found):
                yield t, at, found[t]


def _length(items: list) -> int:
    return sum(1 if isinstance(x, bytes) else x[2] if x[0] == "words" else max(map(_length, x[1])) for x in items)


def build(templates: Sequence[Template]) -> Automaton:
    """One automaton of all templates.  A template must not be empty and must begin with a word of its own wording."""
    empty: list[set[int]] = []  # states reached without a word
    steps: list[dict] = []
    ends: dict[int, int] = {}

    def state() -> int:
        steps.append({})
        empty.append(set())
        return len(steps) - 1

    def add(items: list, at: int) -> int:
        for x in items:
            if isinstance(x, bytes):
                steps[at].setdefault(x, set()).add(to := state())
            elif x[0] == "words":
                to, skip = at, state()
                for k in range(x[2]):
                    if k >= x[1]:
                        empty[to].add(skip)
                    steps[to].setdefault(None, set()).add(nxt := state())
                    to = nxt
                empty[to].add(skip)
                to = skip
            else:
                to = state()
                for wording in x[1]:
                    begin = state()
                    empty[at].add(begin)
                    empty[add(wording, begin)].add(to)
            at = to
        return at

    root = state()
    for i, t in enumerate(templates):
        begin = state()
        empty[root].add(begin)
        ends[add(parse(t.markup), begin)] = i

    def closed(states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in empty[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return frozenset(seen)

    closure = [{w: closed(to) for w, to in on.items()} for on in steps]
    accepts = [(ends[s],) if s in ends else () for s in range(len(steps))]
    first = closed({root})
    if any(accepts[s] or None in steps[s] for s in first):
        raise ValueError("a template must have a word and begin with one of its own")
    return Automaton(tuple(templates), closure, accepts, first)


def scan(text: bytes, automaton: Automaton, piece: int = PIECE_BYTES) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words of a UTF-8 text and its accepted places (template, first word, word behind the last).

    A long text goes in pieces cut behind a word; words at the end of a piece that a place may need are looked at with the next one.
    """
    held: list[bytes] = []
    done, at, found = 0, 0, []
    folded = text.translate(_FOLD)
    while at < len(folded):
        upto = len(folded)
        if upto - at > piece:
            upto = folded.find(b" ", at + piece)
            upto = len(folded) if upto < 0 else upto
        held += folded[at:upto].split()
        at = upto
        sure = len(held) if at == len(folded) else max(0, len(held) - automaton.longest)
        found += [(t, a + done, b + done) for t, a, b in automaton.places(held, sure)]
        done += sure
        del held[:sure]
    return done, found


# License wordings and how they are named.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY <<var;words=1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "<<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. <<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "<<beginOptional>>3<<endOptional>> Neither the name of <<var;words=1-12>> nor the names of <<var;match=its|the>> contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission. "
)
_GPL = (
    "<<var;match=licensed|released|distributed|published>> under the <<beginOptional>>terms of the<<endOptional>> GNU {} <<beginOptional>>as published by the "
    "Free Software Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> <<var;match=version {}|v{}>>"
)
TEMPLATES: tuple[Template, ...] = (
    Template("mit", "under the mit license", 0.5, base=True),
    Template("apache-2", "apache license version 2", 0.5, base=True),
    Template("cc-by-nc", "cc by nc", 0.5, base=True),
    Template(
        "mit",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this <<var;words=1-6>> and associated documentation files (the '
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next "
        "paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
        1.0,
    ),
    Template("bsd-2", _BSD_2 + _AS_IS, 1.0),
    Template("bsd-3", _BSD_2 + _BSD_3 + _AS_IS, 1.0),
    Template(
        "isc",
        "Permission to use, copy, modify, <<var;match=and|and/or>> distribute this software for any purpose with or without fee is hereby granted, provided "
        'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-12>> DISCLAIMS '
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
        1.0,
    ),
    Template(
        "apache-2",
        'Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License")<<endOptional>>; you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at <<beginOptional>><<var;match=http|https>> www.apache.org/licenses/"
        "LICENSE-2.0<<endOptional>> Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
        0.9,
    ),
    Template("apache-2", "Apache <<beginOptional>>Software<<endOptional>> License <<beginOptional>>Version<<endOptional>> 2.0", 0.5),
    Template(
        "gpl-notice",
        "is free software: you can redistribute it and/or modify it under the terms of the GNU <<beginOptional>><<var;match=lesser|affero>><<endOptional>> General "
        "Public License as published by the Free Software Foundation",
        0.9,
    ),
    Template("gpl-2", _GPL.format("General Public License", 2, 2), 0.8),
    Template("gpl-3", _GPL.format("General Public License", 3, 3), 0.8),
    Template("lgpl-3", _GPL.format("Lesser General Public License", 3, 3), 0.8),
    Template("agpl-3", _GPL.format("Affero General Public License", 3, 3), 0.8),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. <<beginOptional>>If a copy of the MPL was not distributed "
        "with this file, You can obtain one at<<endOptional>> <<beginOptional>><<var;match=http|https>> mozilla.org/MPL/2.0<<endOptional>>",
        0.9,
    ),
    Template("cc-by", "licensed under <<beginOptional>>a<<endOptional>> <<var;match=CC BY|Creative Commons Attribution>> <<var;match=2.0|2.5|3.0|4.0>>", 0.8),
    Template("cc-by-nc", "<<var;match=Creative Commons>> Attribution NonCommercial", 0.5),
    Template("cc-by-sa", "<<var;match=CC BY SA|Creative Commons Attribution ShareAlike>>", 0.5),
    Template("cc0", "CC0 1.0 <<beginOptional>>Universal<<endOptional>>", 0.5),
    Template("mit", "SPDX-License-Identifier: MIT", 0.8),
    Template("apache-2", "SPDX-License-Identifier: Apache-2.0", 0.8),
)


PLACES = "array<struct<template:int,label:string,base:boolean,score:double,first:bigint,behind:bigint>>"


def find_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, ``n_words`` and ``places`` of each row of ``docs`` (doc_id, text): array of (template, label, base, score, first, behind).

    A place is where the words from ``first`` to before ``behind`` (from 0) are the wording of a template: every mandatory word, in
    order, nothing between; of places of a template that start alike the longest.  Places are sorted by first word, then template, and
    may overlap; a text may have any number of them.

    Every text is read whole, in pieces of bounded size.  A null or empty text has no words and no places; repeated rows are scanned each;
    an empty table gives an empty result; other columns are not read.  One pass over each row, no shuffle.
    """
    automaton = build(templates)
    kinds = [(i, t.label, t.base, t.score) for i, t in enumerate(templates)]
    fields = [("template", pa.int32()), ("label", pa.string()), ("base", pa.bool_()), ("score", pa.float64()), ("first", pa.int64()), ("behind", pa.int64())]
    kind = pa.list_(pa.struct(fields))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places = [], []
            texts = batch["text"].cast(pa.large_binary())
            for i in range(len(texts)):
                n, found = scan(texts[i].as_py() or b"", automaton)
                counts.append(n)
                found.sort(key=lambda f: (f[1], f[0]))
                places.append([dict(zip((f[0] for f in fields), (*kinds[t], a, b))) for t, a, b in found])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(places, kind)], ["doc_id", "n_words", "places"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scanned, f"doc_id bigint, n_words bigint, places {PLACES}")


def summary(found: DataFrame) -> DataFrame:
    """One flat row per document: words, base places with their ends, labels of the base and of all templates, and the score.

    ``score`` is that of the template that tells most, 0 where no place is.
    """
    base = F.filter("places", lambda p: p["base"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )
