"""License scan with a generalised suffix automaton over the words of licence notices.

Texts stream through the automaton, which gives at each word the longest run of words ending there that occurs in some
notice (matching statistics). Runs of MIN_RUN words or more that can't be extended are chained, in order in text and
notice, into spans of a notice; a span that covers enough of it, and has the words that tell the licence from its neighbours,
yields the notice's label. Fixed phrases yield theirs wherever their words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, map_arrow

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Licence texts and notices in common use (fixed values), with their labels.
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public
License along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("gpl-2", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("lgpl-3", """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("agpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE
IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be
misrepresented; you must not claim that you wrote the original software."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    # openings, which often stand alone
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License."""),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
)
#: Words that must stand consecutively in a span for its label: one phrase of every group. They tell a licence from its
#: neighbours of other versions and terms, whose texts differ in these words alone.
NEEDED = {
    "gpl-3": (("the gnu general public license",), ("version 3",)),
    "gpl-2": (("the gnu general public license",), ("version 2 of", "license version 2")),
    "lgpl-3": (("gnu lesser general public license",), ("version 3",)),
    "agpl-3": (("gnu affero general public license",), ("version 3",)),
    "apache-2": (("version 2",),),
    "mpl-2": (("v 2", "version 2"),),
    "cc-by": (("attribution 4", "attribution 3", "attribution 2"),),
    "cc-by-nc": (("by nc 4", "by nc 3", "by nc 2", "attribution noncommercial 4", "attribution noncommercial 3", "attribution noncommercial 2"),),
    "cc-by-sa": (("attribution sharealike 4", "attribution sharealike 3", "attribution sharealike 2"),),
    "bsd": (("are permitted provided that the following conditions are met",),),
    "zlib": (("origin of this software must not be misrepresented",),),
}
#: MIN_COVER: the share of a notice, of whatever size, that a span must cover.
MIN_RUN, MAX_GAP, MIN_COVER = 3, 6, 0.75


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class SuffixAutomaton:
    """Of several token sequences. `ends[s]`: the (sequence, end) places of the strings of state s."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[set[tuple[int, int]]] = [set()]
        for k, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c, own)
                own[last].add((k, i))
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            own[self.link[s]] |= own[s]
        self.ends = [sorted(x) for x in own]

    def _state(self, length: int, link: int, arcs: dict[int, int], own: list) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        own.append(set())
        return len(self.link) - 1

    def _split(self, p: int, c: int, own: list) -> int:
        """The state that reading c in p leads to, made to hold no longer string than p's longest with c."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        new = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), own)
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int, own: list) -> int:
        if c in self.next[last]:
            return self._split(last, c, own)
        new, p = self._state(self.length[last] + 1, 0, {}, own), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c, own)
        return new


class Scanner:
    def __init__(self, notices=NOTICES, phrases=PHRASES, needed=NEEDED):
        self.needed = {label: [[b" %s " % b" ".join(words_of(p)) for p in group] for group in groups] for label, groups in needed.items()}
        self.labels = [label for label, _ in notices]
        sequences = [words_of(t) for _, t in notices]
        self.ids: dict[bytes, int] = {}
        for w in (w for s in sequences for w in s):
            self.ids.setdefault(w, len(self.ids))
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton([[self.ids[w] for w in s] for s in sequences])
        self.anchors: dict[bytes, list[tuple[int, list[bytes], str]]] = {}
        for phrase, label in phrases:
            ws = words_of(phrase)
            at = min(range(len(ws)), key=lambda i: (ws[i] in (b"the", b"by", b"under"), -len(ws[i])))
            self.anchors.setdefault(ws[at], []).append((at, ws, label))
            for w in ws:
                self.ids.setdefault(w, len(self.ids))

    def base(self, words: list[bytes], hits: list[int]) -> list[tuple[int, str]]:
        """(start, label) of every place of every phrase."""
        out = []
        for i in hits:
            for at, ws, label in self.anchors.get(words[i], ()):
                if i >= at and words[i - at : i - at + len(ws)] == ws:
                    out.append((i - at, label))
        return out

    def runs(self, words: list[bytes], hits: list[int]) -> list[tuple[int, int, int]]:
        """(first word, length, state) of the runs of MIN_RUN words or more that no word extends."""
        a, ids, out = self.automaton, self.ids, []
        state = length = 0
        before = -2
        for i in hits:
            c = ids[words[i]]
            if i != before + 1:
                if length >= MIN_RUN:
                    out.append((before + 1 - length, length, state))
                state = length = 0
            if c not in a.next[state] and length >= MIN_RUN:
                out.append((i - length, length, state))
            while state and c not in a.next[state]:
                state = a.link[state]
                length = a.length[state]
            if c in a.next[state]:
                state = a.next[state][c]
                length += 1
            before = i
        if length >= MIN_RUN:
            out.append((before + 1 - length, length, state))
        return out

    def spans(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """(notice, first word, end, words covered) of chained runs. A notice's open chain takes a run that goes on after it,
        with a gap of MAX_GAP words or fewer in the text and in the notice; other runs further on close it and open another."""
        open_: dict[int, tuple[int, int, int, int]] = {}  # notice: first, end in the text, end in the notice, covered
        done = []
        for first, length, state in runs:
            for k, end in self.automaton.ends[state]:
                start = end - length + 1
                if k in open_:
                    f, e, n, cover = open_[k]
                    cut = max(0, e - first, n - start)  # what overlaps counts once
                    if first - e <= MAX_GAP and start - n <= MAX_GAP and n - start < length and cut < length:
                        if cover + length - cut > cover:
                            open_[k] = f, first + length, end + 1, cover + length - cut
                        continue
                    if first + length <= e:
                        continue
                    done.append((k, f, e, cover))
                open_[k] = first, first + length, end + 1, length
        return done + [(k, f, e, cover) for k, (f, e, _, cover) in open_.items()]

    def tells(self, label: str, span: list[bytes]) -> bool:
        """Whether a span has a phrase of each group that its label needs."""
        if label not in self.needed:
            return True
        text = b" %s " % b" ".join(span)
        return all(any(p in text for p in group) for group in self.needed[label])

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, float]]]:
        """Number of words, base places, and (label, first word, end, covered share) of the spans that suffice."""
        words = words_of(text)
        ids = self.ids
        hits = [i for i, w in enumerate(words) if w in ids]
        found = []
        for k, f, e, cover in self.spans(self.runs(words, hits)):
            if cover >= MIN_COVER * self.sizes[k] and self.tells(self.labels[k], words[f:e]):
                found.append((cover, self.labels[k], f, e, min(1.0, cover / self.sizes[k])))
        # licences share sentences: a span yields to one of another label that covers more of the same words
        kept: list[tuple[str, int, int, float]] = []
        for _, label, f, e, share in sorted(found, key=lambda x: (-x[0], -x[4], x[1:])):
            if all(label == other or 2 * (min(e, z) - max(f, a)) < e - f for other, a, z, _ in kept):
                kept.append((label, f, e, share))
        return len(words), self.base(words, hits), sorted(kept, key=lambda x: (x[1], x[0], x[2]))


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


SPANS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,end:long,share:double>>"


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document. Null and empty texts have no words, labels or spans and the score 0; the score is the
    largest covered share of a notice, 0.5 at least where a phrase stands. Rows are handled one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner()
        span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span]
        for b in batches:
            out: list[list] = [[] for _ in types]
            for text in b.column(1).to_pylist():
                n, base, found = s.scan(text)
                starts = [i for i, _ in base]
                labels = {x for _, x in base}
                row = (n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {x[0] for x in found})), max([0.5 if base else 0.0, *(x[3] for x in found)]), [dict(zip(("label", "first", "end", "share"), x, strict=True)) for x in found])
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return map_arrow(documents(docs), run, SPANS)
