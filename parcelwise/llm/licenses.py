"""Licence scans: rare template words are looked up by position, key phrases are verified."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import store

# The contract's phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Passages and whole standard wordings of public licences with the phrases that must occur, in this order.
TEMPLATES: dict[str, tuple[str, list[str]]] = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ["permission is hereby granted free of charge", "sublicense and or sell copies"],
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        ["apache license version 2 0"],
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
        ["redistribution and use in source and binary forms", "retain the above copyright notice"],
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        ["permission to use copy modify", "distribute this software for any purpose with or without fee", "provided that the above copyright notice"],
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
        ["terms of the gnu general public license"],
    ),
    "gpl-work": (
        "This work is licensed under the GNU General Public License, version 3",
        ["licensed under the gnu general public license"],
    ),
    "lgpl": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
        ["gnu lesser general public license"],
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license v 2 0"],
    ),
    "mpl-2.0-version": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, Version 2.0",
        ["mozilla public license version 2 0"],
    ),
    "mpl-2.0-bare": (
        "Licensed under the Mozilla Public License 2.0",
        ["mozilla public license 2 0"],
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        ["cc by nc"],
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        ["cc by sa"],
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        ["waived all copyright and related or neighboring rights"],
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain",
        ["free and unencumbered software released into the public domain"],
    ),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ["permission is hereby granted free of charge", "sublicense and or sell copies"],
    ),
    "apache-2.0-text": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        ["apache license version 2 0"],
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        ["redistribution and use in source and binary forms", "retain the above copyright notice"],
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
        ["permission to use copy modify", "distribute this software for any purpose with or without fee", "provided that the above copyright notice"],
    ),
    "gpl-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/.",
        ["terms of the gnu general public license"],
    ),
    "lgpl-text": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details. You should have received a copy of the GNU Lesser General Public License along with this "
        "library; if not, see https://www.gnu.org/licenses/.",
        ["gnu lesser general public license"],
    ),
    "mpl-2.0-text": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        ["mozilla public license v 2 0"],
    ),
    "cc-by-nc-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        ["creative commons attribution noncommercial"],
    ),
    "cc-by-sa-text": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        ["creative commons attribution sharealike"],
    ),
    "cc-by-nc-sa": (
        "Licensed under CC BY-NC-SA 4.0",
        ["cc by nc sa"],
    ),
    "cc-by-nc-sa-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        ["creative commons attribution noncommercial sharealike"],
    ),
    "cc-by-nc-nd": (
        "Licensed under CC BY-NC-ND 4.0",
        ["cc by nc nd"],
    ),
    "cc-by-nc-nd-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        ["creative commons attribution noncommercial noderivatives"],
    ),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        ["free and unencumbered software released into the public domain"],
    ),
}
#: The label a template stands for, where it differs from its name.
LABELS = {"gpl-work": "gpl", "mpl-2.0-version": "mpl-2.0", "mpl-2.0-bare": "mpl-2.0"} | {name: name.removesuffix("-text") for name in TEMPLATES if name.endswith("-text")}
#: Inserted or missing words within a notice: up to half the template and this many. So wide is the band of relative positions.
DRIFT = 16
#: A template's rarest words vote for it: so many places, and the least share of their weight that must agree on a band.
VOTERS, VOTED = 12, 0.6
#: Least share of a template's words that must lie in order.
MATCH = 0.8
#: Weight of a word that every text holds.
LEAST_IDF = 1e-3
#: Comment words, numbers and bullets that open a line; the templates are looked up with and without them.
LEAD = re.compile(rb"^[ \t]*+(?:dnl|rem|c|[0-9]{1,6}[.):]?|\(?[a-z0-9]{1,3}[.)])[ \t]++", re.I | re.M)

_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII, A-Z lower-cased."""
    return data.translate(_TABLE).split()


@dataclass(frozen=True)
class Key:
    """A key phrase, its place in the template, the place of its rarest word and the longer phrases that begin with it."""

    words: list[bytes]
    place: int
    anchor: int
    longer: list[list[bytes]]


@dataclass(frozen=True)
class Index:
    """Templates as words, the postings of their rarest words, bit sets of each word's places, key phrases in order and idf of all words."""

    words: dict[str, list[bytes]]
    voters: dict[str, list[tuple[bytes, int]]]
    bits: dict[str, dict[bytes, int]]
    keys: dict[str, list[Key]]
    idf: dict[bytes, float]


def build_index(templates: dict[str, tuple[str, list[str]]], counts: dict[bytes, int], total: int) -> Index:
    words = {name: words_of(text.encode()) for name, (text, _) in templates.items()}
    bits: dict[str, dict[bytes, int]] = {}
    for name, sequence in words.items():
        places = bits[name] = {}
        for at, word in enumerate(sequence):
            places[word] = places.get(word, 0) | 1 << at
    split = {name: [words_of(k.encode()) for k in phrases] for name, (_, phrases) in templates.items()}
    phrases = [k for found in split.values() for k in found]
    idf = {w: max(log((total + 1) / (counts.get(w, 0) + 1)), LEAST_IDF) for x in [*words.values(), *phrases] for w in x}
    voters = {name: sorted(((w, at) for at, w in enumerate(x)), key=lambda v: (-idf[v[0]], v[1]))[:VOTERS] for name, x in words.items()}
    keys: dict[str, list[Key]] = {}
    for name, found in split.items():
        keys[name], low = [], 0
        for k in found:
            place = next((i for i in range(low, len(words[name])) if words[name][i : i + len(k)] == k), low)
            longer = [p for p in phrases if len(p) > len(k) and p[: len(k)] == k]
            keys[name].append(Key(k, place, max(range(len(k)), key=lambda i: (idf[k[i]], -i)), longer))
            low = place + len(k)
    return Index(words, voters, bits, keys, idf)


def _places(words: list[bytes], phrase: list[bytes], first: list[int]) -> list[int]:
    n = len(phrase)
    return [i for i in first if words[i : i + n] == phrase]


def _in_order(words: list[bytes], bits: dict[bytes, int], size: int) -> int:
    """Length of the longest common subsequence of ``words`` and a template (bit-parallel)."""
    every = row = (1 << size) - 1
    for word in words:
        if places := bits.get(word):
            u = row & places
            row = (row + u | row - u) & every
    return size - row.bit_count()


def _chains(keys: list[Key], places: list[list[int]], drift: int) -> Iterator[tuple[int, int]]:
    """Least and greatest relative position of each chain of all key phrases in order."""
    for first in places[0]:
        start = first - keys[0].place
        low, high, end = start, start, first + len(keys[0].words)
        for key, found in zip(keys[1:], places[1:], strict=True):
            i = bisect_left(found, max(end, start + key.place - drift))
            if i == len(found) or found[i] > start + key.place + drift:
                break
            at = found[i] - key.place
            low, high, end = min(low, at), max(high, at), found[i] + len(key.words)
        else:
            yield low, high


def drift_of(size: int) -> int:
    return DRIFT + size // 2


def voted_bands(voters: list[tuple[bytes, int]], at: dict[bytes, list[int]], idf: dict[bytes, float], drift: int) -> list[tuple[int, int]]:
    """Ranges of relative positions that the rarest words of a template agree on.

    Every place of a voter in the file votes for the start of the template that it implies. A
    band of ``drift`` starts is voted if the voters with a start in it hold at least VOTED of the
    weight of all; overlapping bands are joined.
    """
    need = VOTED * sum(idf[w] for w, _ in voters)
    if sum(idf[w] for w, _ in voters if w in at) < need:
        return []
    starts = sorted((i - place, k) for k, (w, place) in enumerate(voters) for i in at.get(w, ()))
    held, weight, first = [0] * len(voters), 0.0, 0
    bands: list[tuple[int, int]] = []
    for start, k in starts:
        held[k] += 1
        weight += idf[voters[k][0]] if held[k] == 1 else 0.0
        while starts[first][0] < start - drift:
            gone = starts[first][1]
            held[gone] -= 1
            weight -= idf[voters[gone][0]] if held[gone] == 0 else 0.0
            first += 1
        if weight >= need * (1 - 1e-9):
            low = starts[first][0]
            if bands and low <= bands[-1][1]:
                bands[-1] = (bands[-1][0], start)
            else:
                bands.append((low, start))
    return bands


def scan(words: list[bytes], index: Index) -> dict[str, float]:
    """Templates found in a file with the share of their words that lie in order.

    The file's places of each template's rarest words are looked up and their postings
    intersected by relative position, summed over a band, so inserted or missing words shift
    some votes without losing them. In a voted band all key phrases must follow each other
    (of two phrases that begin at one word the longer counts), and at least MATCH of the
    template's words must lie in order (longest common subsequence of template and stretch).
    """
    at: dict[bytes, list[int]] = {}
    idf = index.idf
    for i, word in enumerate(words):
        if word in idf:
            at.setdefault(word, []).append(i)
    found: dict[str, float] = {}
    for name, keys in index.keys.items():
        sequence = index.words[name]
        drift = drift_of(len(sequence))
        bands = voted_bands(index.voters[name], at, idf, drift)
        if not bands:
            continue
        places = []
        for key in keys:
            anchor = key.words[key.anchor]
            held = _places(words, key.words, [i - key.anchor for i in at.get(anchor, []) if i >= key.anchor])
            held = [i for i in held if not any(words[i : i + len(p)] == p for p in key.longer)]
            if not held:
                break
            places.append(held)
        if len(places) < len(keys):
            continue
        slack, ends = len(sequence) // 10 + 1, [high for _, high in bands]
        for low, high in _chains(keys, places, drift):
            near = bisect_left(ends, low - drift)
            if near == len(bands) or bands[near][0] > high + drift:
                continue
            # The band's words belong to the notice, too, as far as it may drift.
            first, last = max(min(low, bands[near][0]), low - drift), min(max(high, bands[near][1]), high + drift)
            stretch = words[max(0, first - slack) : last + len(sequence) + slack]
            share = _in_order(stretch, index.bits[name], len(sequence)) / len(sequence)
            if share >= MATCH:
                found[name] = max(found.get(name, 0.0), share)
            if share == 1.0:
                break
    return found


def scan_text(data: bytes, words: list[bytes], index: Index) -> dict[str, float]:
    """Templates found in a text as it is or without the comment words, numbers and bullets of its lines."""
    found = scan(words, index)
    bare, n = LEAD.subn(b"", data)
    if n:
        for name, held in scan(words_of(bare), index).items():
            found[name] = max(held, found.get(name, 0.0))
    return found


def _licence_words(docs: DataFrame, text_col: str, words: frozenset[bytes]) -> DataFrame:
    """``(word, n, docs)`` per batch: in how many texts each licence word occurs, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for x in batch.column(0):
                counts.update(words.intersection(words_of(x.as_py() or b"")))
            counts[b""] = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row.

    Base labels come from the places of the phrases. The method adds the labels of the
    templates it finds; ``score`` is the best share of a template's words in order, 1 for a
    base phrase, 0 without either. NULL and empty texts have no words, empty labels and
    score 0. Rows are independent; repeated rows, NULL ids and further columns change
    nothing; an empty table gives an empty result. Document frequencies of the templates'
    words (a fixed, small set) are counted over all texts first.
    """
    vocabulary = frozenset(w for text, keys in templates.values() for x in [text, *keys] for w in words_of(x.encode()))
    counted = {bytes(r["word"]): r["n"] for r in store(_licence_words(docs, text_col, vocabulary), "idf").collect()}  # one row per template word
    index = build_index(templates, counted, counted.pop(b"", 0))
    base = [(words_of(p.encode()), label) for p, label in phrases.items()]
    starts = {p[0] for p, _ in base}

    def one(data: bytes | None) -> tuple:
        words = words_of(data or b"")
        joined = starts.intersection(words)
        places, labels = [], set()
        for phrase, label in base:
            if phrase[0] in joined:
                found = _places(words, phrase, [i for i, w in enumerate(words) if w == phrase[0]])
                places += found
                labels |= {label} if found else set()
        matched = scan_text(data or b"", words, index)
        every = labels | {LABELS.get(m, m) for m in matched}
        score = 1.0 if labels else max(matched.values(), default=0.0)
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), score)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(x.as_py()) for x in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(run, schema)
