"""Licence scans: Dice coefficient over word bigrams against templates."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Mapping
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as
published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."""
_KINDS = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}

#: Licence texts and the usual one-line notices, by licence.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [_MIT_GRANT, "Released under the MIT License.", "Licensed under the MIT License."],
    "BSD-2-Clause": [f"{_BSD_HEAD} {_BSD_TAIL}", "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": [f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}", "Licensed under the BSD 3-Clause License."],
    "ISC": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""", "Licensed under the ISC License."],
    "Zlib": ["""This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that
        you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as
        such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered
        from any source distribution."""],
    "Unlicense": ["""This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means."""],
    "Apache-2.0": ["""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
                   "Licensed under the Apache License, Version 2.0."],
    "MPL-2.0": ["""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
                "Licensed under the Mozilla Public License, version 2.0."],
    **{f"{k}-{v}": [_GNU.format(kind=n, v=v), f"This work is licensed under the GNU {n}, version {v}."]
       for k, n in _KINDS.items() for v in {"GPL": "23", "LGPL": "3", "AGPL": "3"}[k]},
    **{f"CC-{k.replace(' ', '-')}-4.0": [f"Licensed under CC {k} 4.0."] for k in
       ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")},
    "CC0-1.0": ["""To the extent possible under law, the author has waived all copyright and related or neighboring
        rights to this work."""],
    "All-rights-reserved": ["All rights reserved."],
}
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def words(text: str) -> list[tuple[str, int, int]]:
    """Normalised words with their places: lower case, letters and digits,
    a version number as one word; all else separates."""
    return [(m[0], m.start(), m.end()) for m in WORD.finditer(text.lower())]


class Scanner:
    """Templates as bigram sets with an inverted index from bigram to template."""

    def __init__(self, templates: Mapping[str, list[str]], min_dice: float) -> None:
        self.min_dice = min_dice
        self.names, self.grams = [], []
        for name, texts in templates.items():
            for t in texts:
                w = WORD.findall(t.lower())
                self.names.append(name)
                self.grams.append(frozenset(zip(w, w[1:])))
        self.index: dict[tuple[str, str], list[int]] = {}
        for k, g in enumerate(self.grams):
            for x in g:
                self.index.setdefault(x, []).append(k)
        self.opening = {a for a, _ in self.index}

    def best(self, w: list[str], k: int, i: int, stop: int) -> tuple | None:
        """The best span of template k that begins with the text's bigram i
        and ends before bigram ``stop``: (-dice, -length, k, i, last bigram),
        None if none reaches the coefficient; of equals the shortest.

        With s of its n distinct bigrams shared, a span reaches it only while
        n - s is at most (2 / min_dice - 2) t; spans of more than twice the
        template's bigrams are more than one copy."""
        grams, need = self.grams[k], self.min_dice
        t, found, seen, shared, other = len(grams), None, set(), 0, 0
        for e in range(i, min(stop, i + 2 * t + 1)):
            g = w[e], w[e + 1]
            if g in seen:
                continue
            seen.add(g)
            if g not in grams:
                other += 1
                if other > (2 / need - 2) * t + 1e-9:
                    break
                continue
            shared += 1
            dice = 2 * shared / (shared + other + t)
            if dice >= need and (found is None or -dice < found[0]):
                found = (-dice, i - e, k, i, e)
            if shared == t:
                break
        return found

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(licence, dice, first character, end) of every match in a text.

        The inverted index gives each template the text's places that hold one
        of its bigrams.  A template of t bigrams is pruned by size if the text
        has too few of them (a span needs t min_dice / (2 - min_dice)); else
        every place begins a span, whose best end is sought within bounds.  Of
        matches that overlap the one with the higher coefficient stays, then
        the longer, then the first template; a span that runs into one that
        stays is sought anew before it."""
        if not text:
            return []
        lower = text.lower()
        w = WORD.findall(lower)
        hits: dict[int, list[int]] = {}
        for i, (a, b) in enumerate(zip(w, w[1:])):
            if a in self.opening and (a, b) in self.index:
                for k in self.index[a, b]:
                    hits.setdefault(k, []).append(i)
        need, spans = self.min_dice, []
        for k, at in hits.items():
            if len({(w[i], w[i + 1]) for i in at}) * (2 - need) >= need * len(self.grams[k]) - 1e-9:
                spans += [x for i in at if (x := self.best(w, k, i, len(w) - 1))]
        if not spans:
            return []
        heapify(spans)
        firsts: list[int] = []  # of the matches that stay, in text order
        kept: list[tuple] = []
        while spans:
            dice, _, k, i, e = heappop(spans)
            n = bisect_right(firsts, i)
            if n and kept[n - 1][2] >= i:
                continue
            if n < len(firsts) and firsts[n] <= e + 1:
                again = self.best(w, k, i, firsts[n] - 1)
                if again:
                    heappush(spans, again)
                continue
            firsts.insert(n, i)
            kept.insert(n, (k, -dice, e + 1, i))
        places = [(m.start(), m.end()) for m in WORD.finditer(lower)]
        # Lower-casing may change a text's length; places count in the lower-cased text.
        return [(self.names[k], dice, places[i][0], places[e][1]) for k, dice, e, i in kept]


MATCHES = "array<struct<license:string,dice:double,first:int,end:int>>"


def license_matches(text: Column, templates: Mapping[str, list[str]] = TEMPLATES, min_dice: float = 0.8) -> Column:
    """Every licence match of a whole text, in text order, in Arrow batches."""
    scanner = Scanner(templates, min_dice)

    @F.pandas_udf(MATCHES)
    def run(texts: pd.Series) -> pd.Series:
        keys = ("license", "dice", "first", "end")
        return pd.Series([[dict(zip(keys, m)) for m in scanner.scan(t)] for t in texts], dtype=object)

    return run(text)


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_dice: float = 0.8) -> DataFrame:
    """One row per document: doc_id, license and dice of its best match (null
    if none; ties go to the first in the text), n_matches, matches (licence,
    coefficient, first character and end in the lower-cased text).

    Null and empty texts have no match; identical rows are scanned each; an
    empty table gives no rows; further columns are ignored."""
    out = df.select(F.col(id_col).alias("doc_id"), license_matches(F.col(text_col), min_dice=min_dice).alias("matches"))
    top = F.array_max(F.transform("matches", lambda m, i: F.struct(m["dice"].alias("dice"), (-i).alias("nth"), m["license"].alias("license"))))
    return out.select("doc_id", top["license"].alias("license"), top["dice"].alias("dice"),
                      F.size("matches").cast("long").alias("n_matches"), "matches")
