"""Operator 5: licence scan by Dice coefficient over word bigrams.

A text is normalised to its words (lower case; only letters, digits, and dots inside versions), so line breaks,
comment signs and padding do not count. A licence template is the multiset of its word bigrams, and every window of
the text's words is a candidate for it. A window of ``n`` bigrams can reach a Dice coefficient ``d`` with a template
of ``m`` only if ``n`` lies between ``m*d/(2-d)`` and ``m*(2-d)/d`` and at least ``m*d/(2-d)`` of its bigrams are
the template's. So only the places of template bigrams are looked at (a best window begins and ends with one), a
template is discarded where no stretch of ``m*(2-d)/d`` bigrams holds that many of them, and the windows that are
left are scored exactly. Found windows are taken from the best one down; a window that overlaps a taken one is not a
notice of its own.

Defined cases: NULL and empty texts give no licence (``license`` NULL, ``score`` 0, ``n_matches`` 0); of equal
scores the longer window wins, then the earlier one, then the template named first; a text of any length is
scanned whole, and repeated notices count each; rows are independent, so repeated rows and other columns change
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text

MIN_DICE = 0.8
# ---------------------------------------------------------------------------
# Licence names, the notices by which texts state them, and the texts of short licences.
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
    "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _gnu(kind: str, version: str) -> str:
    """The notice that the GNU licences ask for."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} License as published by the Free Software "
        f"Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {kind} License for more details."
    )


TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-3.0", _gnu("General Public", "3")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", _gnu("General Public", "2")),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", _gnu("Lesser General Public", "3")),
    ("LGPL-2.1", _gnu("Lesser General Public", "2.1")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", _gnu("Affero General Public", "3")),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_MIT_REST}"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_3} {_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_3}"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_1} {_BSD_2} {_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_1} {_BSD_2}"),
    ("BSD", _BSD),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use "
        "of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions:",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
        "one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
]
# ---------------------------------------------------------------------------
WORDS = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
Match = tuple[float, int, int, int]  # score, first bigram, bigram after the last, template


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


class Templates:
    def __init__(self, templates: list[tuple[str, str]], least: float):
        self.least, self.names = least, [n for n, _ in templates]
        texts = [words_of(t) for _, t in templates]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        v = len(self.vocabulary)
        pairs = [[self.vocabulary[a] * v + self.vocabulary[b] for a, b in zip(t, t[1:])] for t in texts]
        self.pairs = np.unique([p for t in pairs for p in t])
        self.sizes = [len(t) for t in pairs]
        #: how often each template holds each bigram
        self.held = np.array([[Counter(t)[p] for p in self.pairs.tolist()] for t in pairs], dtype=np.int64).reshape(len(pairs), len(self.pairs))
        eps = 1e-9
        self.fewest = [max(1, int(np.ceil(m * least / (2 - least) - eps))) for m in self.sizes]
        self.longest = [int(m * (2 - least) / least + eps) for m in self.sizes]

    def windows(self, text: str) -> list[Match]:
        """For every template and place the best window beginning there, where it reaches the least score."""
        ids = np.fromiter(map(self.vocabulary.get, words_of(text), repeat(-1)), dtype=np.int64)
        if not len(self.pairs) or len(ids) < 2:
            return []
        place = np.flatnonzero((ids[1:] >= 0) & (ids[:-1] >= 0))
        pair = ids[place] * len(self.vocabulary) + ids[place + 1]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = self.pairs[at] == pair
        place, at = place[known], at[known]
        out: list[Match] = []
        for t, (size, fewest, longest) in enumerate(zip(self.sizes, self.fewest, self.longest)):
            mine = self.held[t, at] > 0
            if np.count_nonzero(mine) < fewest:
                continue
            p, b = place[mine], at[mine]
            near = np.flatnonzero(p[fewest - 1 :] - p[: len(p) - fewest + 1] < longest)
            if len(near):
                out += self._score(t, size, longest, p.tolist(), b.tolist(), near.tolist())
        return out

    def _score(self, t: int, size: int, longest: int, p: list[int], b: list[int], starts: list[int]) -> Iterator[Match]:
        held = self.held[t].tolist()
        for i in starts:
            left: dict[int, int] = {}
            shared, best, end, first = 0, 0.0, i, p[i]
            for k in range(i, len(p)):
                n = p[k] - first + 1
                if n > longest:
                    break
                of = left.get(b[k], held[b[k]])
                if of:
                    left[b[k]] = of - 1
                    shared += 1
                    score = 2.0 * shared / (n + size)
                    if score >= best:  # of equal scores the longer window
                        best, end = score, k
            if best >= self.least:
                yield best, first, p[end] + 1, t

    def notices(self, text: str) -> list[Match]:
        """Windows from the best one down, without those that overlap a better one."""
        taken: list[Match] = []
        covered: set[int] = set()
        for m in sorted(self.windows(text), key=lambda m: (-m[0], m[1] - m[2], m[1], m[3])):
            # a window overlaps a taken one only if it holds one of its ends or lies inside it
            if m[1] in covered or m[2] - 1 in covered or any(m[1] < f < m[2] for _, f, _, _ in taken):
                continue
            taken.append(m)
            covered.update(range(m[1], m[2]))
        return taken


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = MIN_DICE) -> DataFrame:
    """``doc_id``, ``license`` (of the best notice), ``score``, ``n_matches`` (notices) and ``licenses`` (all names)."""
    known = Templates(templates or TEMPLATES, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: list[list] = [[], [], [], []]
                for text in part.column(1).to_pylist():
                    hits = known.notices(text or "")
                    row = (known.names[hits[0][3]] if hits else None, hits[0][0] if hits else 0.0, len(hits), sorted({known.names[h[3]] for h in hits}))
                    for c, v in zip(out, row):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.string()))],
                    names=["doc_id", "license", "score", "n_matches", "licenses"],
                )

    return id_text(docs).mapInArrow(run, "doc_id long, license string, score double, n_matches long, licenses array<string>")
