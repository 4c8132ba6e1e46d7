"""License scans: templates with optional and replaceable regions, compiled to automata over words.

A template is a license's wording in the markup of public license templates: ``<<beginOptional>>...<<endOptional>>``
may be left out, ``<<var;match=N>>`` stands for up to N words. Each is compiled to a deterministic automaton over
words; a text is accepted if some run of its words is, with all mandatory wording in place and in order, word for word.

Texts are lower-cased (A-Z) and cut into words; whole texts are scanned. An automaton is only started where one of the
words stands that can begin its template, found for all texts of a batch at once. Beside the templates, fixed phrases
are counted, which give labels of their own.

``score`` is 1 where a template accepts, 0.5 where only a phrase occurs, else 0. Null and empty texts have no words
and no labels. Rows of equal ids are scanned each for itself; other columns are not looked at. An empty table gives an
empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import arrow_schema
from distributary.llm.text import PLAIN, Texts, batch_of, texts_of, words_of

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# The wording that the BSD licenses share.
BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code must retain the above"
    " copyright notice this list of conditions and the following disclaimer <<beginOptional>>2<<endOptional>>"
    " redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
    " disclaimer in the documentation and or other materials provided with the distribution "
)
BSD_DISCLAIMER = (
    "this software is provided by <<var;match=14>> and any express or implied warranties including but not limited to"
    " the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall"
    " <<var;match=14>> be liable for any direct indirect incidental special exemplary or consequential damages including"
    " but not limited to procurement of substitute goods or services loss of use data or profits or business interruption"
    " however caused and on any theory of liability whether in contract strict liability or tort including negligence or"
    " otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)

# Mandatory, optional and replaceable wording of common licenses (BSD, ISC and MIT whole) and notices, by their public identifiers.
TEMPLATES = {
    "agpl-3.0": "gnu affero general public license <<beginOptional>>as published by the free software foundation"
    " either<<endOptional>> version 3",
    "apache-2.0": "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0",
    "bsd-2-clause": BSD_CONDITIONS + BSD_DISCLAIMER,
    "bsd-3-clause": BSD_CONDITIONS + "<<beginOptional>>3<<endOptional>> neither the name of <<var;match=14>> nor the"
    " names of its contributors may be used to endorse or promote products derived from this software without specific"
    " prior written permission " + BSD_DISCLAIMER,
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons"
    " <<beginOptional>>cc by<<endOptional>> attribution 4.0",
    "cc-by-4.0 short": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>>"
    " cc by <<beginOptional>>attribution<<endOptional>> 4.0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> cc by nc 4.0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a<<endOptional>> cc by sa 4.0",
    "copyright": "copyright <<beginOptional>>c<<endOptional>> <<var;match=8>> all rights reserved",
    "gpl-2.0": "gnu general public license <<beginOptional>>as published by the free software foundation"
    " either<<endOptional>> version 2",
    "gpl-3.0": "gnu general public license <<beginOptional>>as published by the free software foundation"
    " either<<endOptional>> version 3",
    "isc": "permission to use copy modify <<beginOptional>>and<<endOptional>> <<beginOptional>>or<<endOptional>>"
    " distribute this software for any purpose with or without fee is hereby granted provided that the above copyright"
    " notice and this permission notice appear in all copies the software is provided <<var;match=2>> and"
    " <<var;match=8>> disclaims all warranties with regard to this software including all implied warranties of"
    " merchantability and fitness in no event shall <<var;match=8>> be liable for any special direct indirect or"
    " consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of"
    " contract negligence or other tortious action arising out of or in connection with the use or performance of this"
    " software",
    "lgpl": "gnu lesser general public license <<beginOptional>>as published by the free software foundation"
    " either<<endOptional>> version <<var;match=2>>",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of <<var;match=8>> to deal in the"
    " software without restriction including without limitation the rights to use copy modify merge publish distribute"
    " sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
    " subject to the following conditions the above copyright notice and this permission notice <<beginOptional>>"
    "including the next paragraph<<endOptional>> shall be included in all copies or substantial portions of the software"
    " the software is provided <<var;match=2>> without warranty of any kind express or implied including but not limited"
    " to the warranties of merchantability fitness for a particular purpose and <<var;match=2>> in no event shall"
    " <<var;match=12>> be liable for any claim damages or other liability whether in an action of contract tort or"
    " otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit-notice": "released under the mit license",
    "mpl-2.0": "subject to the terms of the mozilla public license <<beginOptional>>v<<endOptional>>"
    " <<beginOptional>>version<<endOptional>> 2.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double"
)


def label_of(name: str) -> str:
    """The label of a template: its name up to a blank, what follows tells wordings of one label apart."""
    return name.split(" ")[0]


MARKUP = re.compile(r"<<(beginOptional|endOptional|var;match=\d+)>>")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ANY = None


def parts_of(template: str) -> list[tuple[str, str | int]]:
    """The template as words, ends of optional regions, and replaceable regions."""
    found: list[tuple[str, str | int]] = []
    for i, part in enumerate(MARKUP.split(template)):
        if i % 2 == 0:
            found += [("word", w) for w in WORD.findall(part.lower())]
        elif part.startswith("var"):
            found.append(("any", int(part.split("=")[1])))
        else:
            found.append((part, ""))
    return found


class Automaton:
    """Deterministic automaton of a template; states are numbered as they are first needed."""

    def __init__(self, template: str) -> None:
        self.steps: list[list[tuple[str | None, int]]] = [[]]  # by state: (word or ANY, next state)
        self.free: list[list[int]] = [[]]  # by state: next states without a word
        opened, state = [], 0
        for kind, value in parts_of(template):
            if kind == "word":
                state = self.follow(state, [str(value)])
            elif kind == "any":
                end = self.new_state()
                for _ in range(int(value)):
                    self.free[state].append(end)
                    state = self.follow(state, [ANY])
                self.free[state].append(end)
                state = end
            elif kind == "beginOptional":
                opened.append(state)
            else:
                state_after = self.new_state()
                self.free[state].append(state_after)
                self.free[opened.pop()].append(state_after)
                state = state_after
        self.last = state
        self.known: dict[tuple[frozenset[int], str], frozenset[int]] = {}
        self.start = self.closed({0})
        if self.last in self.start:
            raise ValueError("a template needs mandatory words")
        first = [w for s in self.start for w, _ in self.steps[s]]
        if ANY in first:
            raise ValueError("a template must begin with a word")
        self.first = {str(w) for w in first}
        self.words = {w for steps in self.steps for w, _ in steps if w is not ANY}

    def new_state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def follow(self, state: int, words: list[str | None]) -> int:
        end = self.new_state()
        self.steps[state] += [(w, end) for w in words]
        return end

    def closed(self, states: set[int]) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for s in self.free[open_.pop()]:
                if s not in found:
                    found.add(s)
                    open_.append(s)
        return frozenset(found)

    def next(self, states: frozenset[int], word: str) -> frozenset[int]:
        word = word if word in self.words else ""  # all words that the template does not name act alike
        if (states, word) not in self.known:
            reached = {end for s in states for w, end in self.steps[s] if w is ANY or w == word}
            self.known[states, word] = self.closed(reached)
        return self.known[states, word]

    def accepts(self, words: list[str], at: int) -> int:
        """Words of the shortest run from ``at`` that the template accepts, or 0."""
        states = self.start
        for i in range(at, len(words)):
            states = self.next(states, words[i])
            if not states:
                return 0
            if self.last in states:
                return i + 1 - at
        return 0


def hashes_of(words: list[str]) -> np.ndarray:
    texts = next(iter(texts_of(pa.array([" ".join(words)]))))
    return words_of(texts, PLAIN).hashes()


class Scanner:
    """All templates and phrases with the hashes of the words they begin with."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]) -> None:
        self.automata = {label: Automaton(t) for label, t in templates.items()}
        first = sorted({w for a in self.automata.values() for w in a.first})
        self.first = np.sort(hashes_of(first))
        self.phrases = {label: hashes_of(p.split()) for p, label in phrases.items()}

    def scan(self, texts: Texts) -> list[tuple]:
        """Per text: words, phrase places, first and last of them, labels of phrases, all labels, score."""
        texts = texts.lowered()
        words = words_of(texts, PLAIN)
        hashes, rows, bounds = words.hashes(), words.rows(), words.bounds
        base: list[dict[str, np.ndarray]] = [{} for _ in range(len(texts))]
        for label, phrase in self.phrases.items():
            n = max(len(hashes) - len(phrase) + 1, 0)
            same = np.ones(n, dtype=bool)
            for j, h in enumerate(phrase):
                same &= hashes[j : j + n] == h
            at = np.flatnonzero(same & (rows[:n] == rows[len(phrase) - 1 :][:n]))
            for i in np.unique(rows[at]):
                base[i][label] = at[rows[at] == i] - bounds[i]
        begins = np.flatnonzero(np.isin(hashes, self.first))
        labels: list[set[str]] = [set(b) for b in base]
        accepted: set[int] = set()
        for i, places in zip(*grouped(rows[begins], begins), strict=True):
            own = [
                texts.data[a:b].tobytes().decode()
                for a, b in zip(words.start[bounds[i] : bounds[i + 1]], words.end[bounds[i] : bounds[i + 1]], strict=True)
            ]
            for at in (places - bounds[i]).tolist():
                for label, automaton in self.automata.items():
                    if own[at] in automaton.first and automaton.accepts(own, at):
                        labels[i].add(label_of(label))
                        accepted.add(i)
        results = []
        for i, (found, every) in enumerate(zip(base, labels, strict=True)):
            places = np.concatenate([np.zeros(0, np.int64), *found.values()])
            score = 1.0 if i in accepted else 0.5 if found else 0.0
            ends = (int(places.min()), int(places.max())) if len(places) else (None, None)
            joined = [",".join(sorted(x)) for x in (found, every)]
            results.append((int(bounds[i + 1] - bounds[i]), len(places), *ends, *joined, score))
        return results


def grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by key; keys are in order."""
    if not len(keys):
        return [], []
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate([[0], cuts])].tolist(), np.split(values, cuts)


@lru_cache(maxsize=1)
def standard_scanner() -> Scanner:
    return Scanner(TEMPLATES, PHRASES)


def license_scan(documents: DataFrame) -> DataFrame:
    """Words, phrase places, labels and score of every document, in one narrow pass."""
    schema = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = standard_scanner()
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [ids, *zip(*scanner.scan(texts), strict=True)])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)


def pattern(template: str) -> str:
    """The template as a regular expression over words that are each followed by a space; for SQL and tests."""
    found = []
    for kind, value in parts_of(template):
        if kind == "word":
            found.append(f"{value} ")
        elif kind == "any":
            found.append(f"([^ ]+ ){{0,{value}}}")
        else:
            found.append("(" if kind == "beginOptional" else ")?")
    return "".join(found)
