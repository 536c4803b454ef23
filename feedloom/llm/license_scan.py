"""License scan by template matching.

Templates are license notices and whole license texts with markup: ``<<opt>> ..
<</opt>>`` may be left out, ``<<any>>`` is a replaceable region (a loop on any
word, which ends where the wording after it stands for the first time, at most
``REGION_WORDS`` words on), ``<<var N>>`` stands for up to N words, everything else
is mandatory wording, of which a template must have some. All templates are compiled into one token automaton over the
words of the templates (a word outside them is symbol 0). A text is matched from
every place whose two first words can begin a template; the subset construction
runs on demand and is kept. Two places whose runs come to the same states at the
same word go on as one, so a text with many beginnings of one region is read once.
A match is accepted when all mandatory wording was
read exactly, in order and without gaps other than the marked regions.

Words: runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII.

Defined cases: null and wordless texts have no words and no label; a text with
several notices gets all their labels; equal rows get equal results; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import prepare

CHUNK_BYTES = 4 << 20

# Phrases of the base search and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of a replaceable region at most. Published license templates allow 5,000
#: characters for a copyright region, about 1,000 words of the least length met.
REGION_WORDS = 1000

# Wording of published licenses, with the copyright holder and the
# parts that copies leave out as regions.
_WARRANTY = ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
             "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any "
             "claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software "
             "or the use or other dealings in the software")
_BSD_HEAD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
             "<<opt>>1<</opt>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
             "<<opt>>2<</opt>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
             "in the documentation and or other materials provided with the distribution")
_BSD_THIRD = ("<<opt>>3<</opt>> neither the name of <<any>> may be used to endorse or promote products derived from this software without specific prior "
              "written permission")
_BSD_TAIL = ("this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
             "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright "
             "<<opt>>holder<</opt>> <<opt>>owner<</opt>> or contributors be liable for any direct indirect incidental special exemplary or consequential "
             "damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however "
             "caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of "
             "the use of this software even if advised of the possibility of such damage")

#: (label, template).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license <<opt>>version<</opt>> 2 0 <<opt>>the license<</opt>>"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain "
                   "a copy of the license at <<any>> unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
                   "language governing permissions and limitations under the license"),
    ("mit", "released under the <<opt>>terms of the<</opt>> mit license"),
    ("mit", "licensed under the <<opt>>terms of the<</opt>> mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "<<opt>>the software<</opt>> to deal in the software without restriction <<any>> "
            "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                 "<<opt>>the software<</opt>> to deal in the software without restriction including without limitation the rights to use copy modify merge "
                 "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
                 "to the following conditions the above copyright notice and this permission notice <<opt>>including the next paragraph<</opt>> shall be "
                 "included in all copies or substantial portions of the software " + _WARRANTY),
    ("isc", "permission to use copy modify and <<opt>>or<</opt>> distribute this software for any purpose with or without fee is hereby granted provided that the "
            "above copyright notice and this permission notice appear in all copies the software is provided as is and <<any>> disclaims all warranties with "
            "regard to this software including all implied warranties of merchantability and fitness in no event shall <<any>> be liable for any special "
            "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
            "negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("gpl-3.0", "licensed under the <<opt>>terms of the<</opt>> <<opt>>gnu<</opt>> general public license <<opt>>gpl<</opt>> "
                "<<opt>>as published by the free software foundation<</opt>> <<opt>>either<</opt>> version 3 <<opt>>of the license<</opt>> "
                "<<opt>>or at your option any later version<</opt>>"),
    ("gpl-2.0", "licensed under the <<opt>>terms of the<</opt>> <<opt>>gnu<</opt>> general public license <<opt>>gpl<</opt>> "
                "<<opt>>as published by the free software foundation<</opt>> <<opt>>either<</opt>> version 2 <<opt>>of the license<</opt>>"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("bsd-2-clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("bsd-3-clause", f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}"),
    ("cc-by-4.0", "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> <<opt>>creative commons<</opt>> cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> <<opt>>creative commons<</opt>> cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> <<opt>>creative commons<</opt>> cc by sa 4 0"),
    ("reserved", "all rights reserved"),
    ("copyright", "copyright <<opt>>c<</opt>> <<any>> all rights reserved"),
]


class TemplateAutomaton:
    """One automaton for all templates. A state set maps states to nothing
    else; ``accepts`` names the templates whose end is in the set."""

    def __init__(self, templates: list[tuple[str, str]], extra_words: list[str] = ()):
        self.labels = [label for label, _ in templates]
        tokens = [re.findall(r"<<.*?>>|[^\s<>]+", text) for _, text in templates]
        known = sorted({t for ts in tokens for t in ts if not t.startswith("<<")} | set(extra_words))
        hashes = np.array([W.hash_bytes(x.encode()) for x in known], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.symbol = {known[i]: k + 1 for k, i in enumerate(order)}
        self.on_word: list[dict[int, int]] = []   # state -> symbol -> state
        self.on_any: list[int | None] = []
        self.free: list[set[int]] = []            # moves without a word
        self.end: dict[int, int] = {}
        self.loops: set[int] = set()              # states inside a region
        self.longest: list[int] = []              # words of a match of each template, at most
        self.progress: list[tuple[int, float]] = []
        starts = [self._compile(k, ts) for k, ts in enumerate(tokens)]
        self.start = self._close(starts)
        self._next: dict[tuple[frozenset, int], frozenset] = {}
        self._met: dict[frozenset, tuple] = {}
        v = len(known) + 1
        self.begins = np.zeros((v, v), dtype=bool)  # pairs of words that can begin a template
        for a in range(1, v):
            after = self.step(self.start, a)
            for b in range(v) if after else ():
                self.begins[a, b] = bool(self.step(after, b)) or bool(self.accepts(after))

    def _state(self, template: int, read: int) -> int:
        self.on_word.append({})
        self.on_any.append(None)
        self.free.append(set())
        self.progress.append((template, read))
        return len(self.on_word) - 1

    def _compile(self, k: int, tokens: list[str]) -> int:
        read, opened = 0, []
        depth = 0
        mandatory = 0
        for t in tokens:
            depth += (t == "<<opt>>") - (t == "<</opt>>")
            mandatory += not t.startswith("<<") and depth == 0
        if not mandatory:
            raise ValueError(f"template {k} ({self.labels[k]}) has no mandatory wording")
        self.longest.append(sum(REGION_WORDS if t == "<<any>>" else int(t[5:-2]) if t.startswith("<<var") else not t.startswith("<<") for t in tokens))
        start = at = self._state(k, 0.0)
        for t in tokens:
            if t == "<<opt>>":
                opened.append(at)
            elif t == "<</opt>>":
                self.free[opened.pop()].add(at)
            elif t == "<<any>>":
                new = self._state(k, read / mandatory)
                self.free[at].add(new)
                self.on_any[new] = new
                self.loops.add(new)
                at = new
            elif t.startswith("<<var"):
                first = at
                chain = []
                for _ in range(int(t[5:-2])):
                    new = self._state(k, read / mandatory)
                    self.on_any[at] = new
                    chain.append(new)
                    at = new
                out = self._state(k, read / mandatory)
                for s in (first, *chain):
                    self.free[s].add(out)
                at = out
            else:
                read += not opened
                new = self._state(k, read / mandatory)
                self.on_word[at][self.symbol[t]] = new
                at = new
        self.end[at] = k
        return start

    def _close(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def step(self, states: frozenset, symbol: int) -> frozenset:
        key = (states, symbol)
        if key not in self._next:
            moved = [self.on_word[s][symbol] for s in states if symbol in self.on_word[s]]
            moved += [self.on_any[s] for s in states if self.on_any[s] is not None]
            self._next[key] = self._close(moved)
        return self._next[key]

    def accepts(self, states: frozenset) -> list[int]:
        return [self.end[s] for s in states if s in self.end]

    def _meets(self, states: frozenset) -> tuple[frozenset, list[int], float, bool]:
        """What a set of states means: the states to go on with (of an accepted
        template with regions, those after all its wording), templates accepted, the best share read,
        and whether a region is open."""
        if states not in self._met:
            done = self.accepts(states)
            regions = {self.progress[s][0] for s in self.loops} & set(done)
            left = frozenset(s for s in states if self.progress[s][0] not in regions or (s not in self.loops and self.progress[s][1] >= 1.0))
            self._met[states] = left, done, max((self.progress[s][1] for s in states), default=0.0), bool(left & self.loops)
        return self._met[states]

    def match(self, symbols: np.ndarray) -> tuple[list[tuple[int, int, int]], float]:
        """(template, first word, end word) of the match of every template at
        every place (the longest one; a region ends as soon as it can), and the
        largest share of a template's mandatory wording that was read anywhere."""
        found, best, known = [], 0.0, {}
        places = np.flatnonzero(self.begins[symbols, np.append(symbols[1:], 0)]) if len(symbols) else ()
        for place in places:
            states, at, ends, path = self.start, int(place), {}, []
            while states and at < len(symbols):
                states = self.step(states, int(symbols[at]))
                at += 1
                key = (states, at)
                if key in known:
                    ends = known[key]
                    break
                states, done, share, is_open = self._meets(states)
                best = max(best, share)
                if done or is_open:
                    path.append((key if is_open else None, done, at))
            for key, done, end in reversed(path):
                if done:
                    ends = {k: end for k in done} | ends
                if key is not None:
                    known[key] = ends
            found += [(k, int(place), e) for k, e in ends.items() if e - place <= self.longest[k]]
        return found, best


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, n_words``, ``places`` (phrase label,
    first word; every place of a phrase), ``matches`` (template label, first and
    end word) and ``score`` (largest share of a template's mandatory wording
    found in a row; 1 for an accepted template)."""
    prepare(docs.sparkSession)
    phrases = BASE_PHRASES if phrases is None else phrases
    automaton = TemplateAutomaton(TEMPLATES if templates is None else templates, [w for p in phrases for w in p.split()])
    wanted = [([automaton.symbol[w] for w in p.split()], label) for p, label in phrases.items()]
    sent = docs.sparkSession.sparkContext.broadcast((automaton, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, base = sent.value
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            w = W.split(W.texts_of(chunk, "text"), W.ALNUM_WORDS)
            symbols = W.find(machine.hashes, W.hash_words(w)) + 1
            text = w.doc_of()
            places: list[list] = [[] for _ in range(chunk.num_rows)]
            for phrase, label in base:
                n = len(phrase)
                hit = np.ones(max(0, len(symbols) - n + 1), dtype=bool)
                for k, s in enumerate(phrase):
                    hit &= symbols[k:k + len(hit)] == s
                at = np.flatnonzero(hit)
                for i in at[text[at] == text[at + n - 1]].tolist():
                    places[text[i]].append({"label": label, "first": i - int(w.bounds[text[i]])})
            matches: list[list] = [[] for _ in range(chunk.num_rows)]
            score = np.zeros(chunk.num_rows)
            last = np.zeros(len(symbols), dtype=bool)  # the last word of a text begins no pair with the next text
            last[w.bounds[1:][np.diff(w.bounds) > 0] - 1] = True
            begin = machine.begins[symbols, np.where(last, 0, np.append(symbols[1:], 0))] if len(symbols) else np.empty(0, bool)
            for d in np.unique(text[begin]).tolist():
                found, score[d] = machine.match(symbols[w.bounds[d]:w.bounds[d + 1]])
                matches[d] = [{"label": machine.labels[k], "first": a, "end": b} for k, a, b in sorted(found)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(w.counts), pa.array(places, pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))),
                 pa.array(matches, pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))), pa.array(score)],
                ["doc_id", "n_words", "places", "matches", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, places array<struct<label: string, first: long>>, "
             "matches array<struct<label: string, first: long, end: long>>, score double")
