"""License scans by template markup: regions become token automata, mandatory words must match.

Markup of a template, which is a license text otherwise as it stands (case and marks do not count):

* ``word``            mandatory wording, matched exactly;
* ``[[ ... ]]``       optional region, may nest;
* ``<a/b/c>``         replaceable region with listed wordings (one word each);
* ``{{2..9}}``        replaceable region of two to nine words of any kind.

A template compiles to a nondeterministic automaton over words. A text matches where the
automaton, started at some word, reaches its end; the longest end counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from skytally.llm.common import as_bytes, map_batches, split_words

# The phrases every scan looks for, and the label each stands for.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of common license notices, label first.
TEMPLATES = (
    ("mit", "<released/licensed/distributed/available/provided> under [[the terms of]] the mit [[open source]] license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this"
            " <software/work/code> and associated documentation files [[the software]] to deal in the"
            " software without restriction"),
    ("apache-2.0", "licensed under [[the terms of]] the apache license version 2 0"),
    ("gpl-3.0", "[[this {{1..4}} is]] <licensed/released/distributed> under [[the terms of]] the gnu"
                " general public license [[as published by the free software foundation either]]"
                " <version/v> 3 [[0]] [[or {{0..3}} any later version]]"),
    ("gpl-2.0", "<licensed/released/distributed> under [[the terms of]] the gnu general public license"
                " [[as published by the free software foundation either]] <version/v> 2 [[0]]"
                " [[or {{0..3}} any later version]]"),
    ("cc-by-nc-4.0", "licensed under [[a]] [[creative commons]] cc by nc 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international [[public]] license"),
    ("cc-by-4.0", "licensed under [[a]] [[creative commons]] cc by 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are"
            " permitted provided that the following conditions are met"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "copyright [[c]] {{1..12}} all rights reserved"),
)

# Whole license texts, label first. Names, list marks and the wordings that are commonly
# exchanged are regions.
PERMISSIVE_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY {{1..12}} "AS IS" AND ANY [[EXPRESS OR]] [[EXPRESSED OR]] IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
{{1..12}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
TWO_CLAUSES = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: [[<1/a>]] Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. [[<2/b>]] Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
LICENSE_TEXTS = (
    ("mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this <software/work/code> and associated
documentation files [[(the "Software")]], to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice [[(including the next paragraph)]] shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{1..12}} BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd-2-clause", TWO_CLAUSES + PERMISSIVE_DISCLAIMER),
    ("bsd-3-clause", TWO_CLAUSES + """
[[<3/c>]] Neither the name of {{1..15}} nor the names of [[its]] [[{{1..3}}]] contributors may be used to endorse or promote
products derived from this software without specific prior written permission.""" + PERMISSIVE_DISCLAIMER),
    ("isc", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
{{1..6}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL {{1..6}} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: [[1]] The origin of
this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. [[2]] Altered source versions
must be plainly marked as such, and must not be misrepresented as being the original software. [[3]] This notice may not be
removed or altered from any source distribution."""),
    ("apache-2.0", """
Licensed under the Apache License, Version 2.0 [[(the "License")]]; you may not use this <file/software/work> except in compliance
with the License. You may obtain a copy of the License at [[{{1..8}}]] Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-3.0", """
[[This {{1..4}} is free software:]] you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. {{1..6}} is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
)
ALL_TEMPLATES = TEMPLATES + LICENSE_TEXTS

PIECE = re.compile(r"\[\[|\]\]|\{\{(\d+)\.\.(\d+)\}\}|<([^>]+)>|([^\s\[\]{}<>]+)")


@dataclass
class Automaton:
    """States are numbers; ``words`` has the exact steps, ``free`` the states any word leaves."""

    words: list[dict[bytes, set[int]]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    empty: list[set[int]] = field(default_factory=list)
    labels: dict[int, str] = field(default_factory=dict)
    starts: dict[bytes, set[int]] = field(default_factory=dict)
    anchors: set[bytes] = field(default_factory=set)

    def state(self) -> int:
        self.words.append({})
        self.free.append(set())
        self.empty.append(set())
        return len(self.words) - 1

    def closure(self, states: set[int]) -> set[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.empty[todo.pop()] - seen:
                seen.add(nxt)
                todo.append(nxt)
        return seen

    def add(self, label: str, template: str) -> None:
        begin = now = self.state()
        opened, mandatory = [], []
        for piece in PIECE.finditer(template):
            low, high, listed, wording = piece.groups()
            if piece[0] == "[[":
                opened.append(now)
                continue
            if piece[0] == "]]":
                self.empty[opened.pop()].add(now)
                continue
            if low is not None:
                for i in range(int(high)):
                    nxt = self.state()
                    self.free[now].add(nxt)
                    if i >= int(low):
                        self.empty[now].add(nxt)
                    now = nxt
                continue
            # a listed region is one step with a choice, wording one step for each of its words
            choices = [split_words(listed.encode().replace(b"/", b" "))] if listed else [[w] for w in split_words(wording.encode())]
            for choice in choices:
                nxt = self.state()
                for w in choice:
                    self.words[now].setdefault(w, set()).add(nxt)
                if wording and not opened:
                    mandatory.append(choice[0])
                now = nxt
        if opened or not mandatory:
            raise ValueError(f"template without mandatory word or with an open region: {template}")
        self.labels[now] = label
        self.anchors.add(max(mandatory, key=len))
        first = self.closure({begin})
        if now in first or any(self.free[s] for s in first):
            raise ValueError(f"template must begin with wording: {template}")
        for s in first:
            for w, to in self.words[s].items():
                self.starts.setdefault(w, set()).update(to)

    def run(self, words: list[bytes], at: int) -> dict[str, int]:
        """Labels accepted from word ``at``, each with its furthest end (exclusive)."""
        found: dict[str, int] = {}
        active = self.closure(set(self.starts.get(words[at], ())))
        end = at + 1
        while active:
            for s in active:
                if s in self.labels:
                    found[self.labels[s]] = end
            if end == len(words):
                break
            nxt = set()
            for s in active:
                nxt |= self.words[s].get(words[end], set())
                nxt |= self.free[s]
            active, end = self.closure(nxt), end + 1
        return found

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """Every (label, first word, end word) in a text."""
        return [(label, i, end) for i, w in enumerate(words) if w in self.starts
                for label, end in sorted(self.run(words, i).items())]


def compile_templates(templates=ALL_TEMPLATES) -> Automaton:
    automaton = Automaton()
    for label, template in templates:
        automaton.add(label, template)
    return automaton


@lru_cache(maxsize=4)
def compiled(templates) -> Automaton:
    """One automaton per Python worker."""
    return compile_templates(templates)


def base_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after another."""
    found = []
    for phrase, label in phrases:
        last, at = phrase[-1], -1
        try:
            while True:
                at = words.index(last, at + 1)
                begin = at - len(phrase) + 1
                if begin >= 0 and words[begin:at + 1] == phrase:
                    found.append((begin, label))
        except ValueError:
            pass
    return found


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, matches array<struct<label:string,first:long,end:long>>")


def scan_licenses(documents: DataFrame, templates=ALL_TEMPLATES) -> DataFrame:
    """License notices of every document.

    Reads doc_id and text, ignores other columns. Null and empty texts have no words and score
    0; repeated rows give repeated rows; an empty table gives no rows. ``matches`` lists what
    the templates accepted, in word order. The score is 1 where a template's whole mandatory
    wording stands, 0.5 where only a base phrase does, else 0. Texts are read whole, one batch
    at a time; no shuffle.
    """
    def scan(batch: pa.RecordBatch) -> dict:
        automaton = compiled(templates)
        phrases = [([w.encode() for w in p.split()], label) for p, label in BASE_PHRASES.items()]
        out: dict[str, list] = {n: [] for n in (
            "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")}
        for text in as_bytes(batch.column("text")):
            words = split_words(text)
            base = base_places(words, phrases) if b"icense" in text or b"ICENSE" in text or \
                b"license" in text.lower() else []
            distinct = set(words) if words else set()
            matches = automaton.scan(words) if not automaton.anchors.isdisjoint(distinct) else []
            base_labels = {label for _, label in base}
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(min((i for i, _ in base), default=None))
            out["last_word"].append(max((i for i, _ in base), default=None))
            out["base_labels"].append(",".join(sorted(base_labels)))
            out["labels"].append(",".join(sorted(base_labels | {m[0] for m in matches})))
            out["score"].append(1.0 if matches else 0.5 if base else 0.0)
            out["matches"].append([{"label": a, "first": b, "end": c} for a, b, c in matches])
        return out | {"doc_id": batch.column("doc_id").cast(pa.int64())}

    return map_batches(documents.select("doc_id", "text"), scan, SCHEMA)
