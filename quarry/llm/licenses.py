"""License scans: normalised text against license templates by Dice over word bigrams, sizes pruning first.

Compared are single lines, the whole text, and windows of as many words as a template has, wherever they begin. So a notice on a
line of its own is found, one that is cut short or lengthened too, and so is a licence's body or header inside a longer text, whatever its line breaks.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.tables import numbered, table, utf8

#: Notices that the named licenses, or their stewards, ask for or that are in common use, then licenses' bodies and standard headers.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the authors have waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the
License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of
the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see
https://www.gnu.org/licenses/."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to
anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
)

#: ASCII digits and letters, lower-cased, and bytes that are not ASCII make words.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 10 if b == 10 else 0x20 for b in range(256))


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


class Templates:
    """Templates in order of size. Dice of at least t between sets of a and b needs t/(2-t) <= a/b <= (2-t)/t."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.least = least
        sets = [(bigrams(utf8(text).translate(_FOLD).split()), name) for name, text in templates]
        self.sets = sorted(((len(s), name, s) for s, name in sets if s), key=lambda x: x[:2])
        self.sizes = [n for n, _, _ in self.sets]
        self.low = ceil(self.sizes[0] * least / (2 - least) - 1e-9) if self.sizes else 1
        self.high = floor(self.sizes[-1] * (2 - least) / least + 1e-9) if self.sizes else 0

        self._index([(name, utf8(text).translate(_FOLD).split()) for name, text in templates])

    def _index(self, texts: list[tuple[str, list[bytes]]]) -> None:
        """For windows: the templates' bigrams as numbers, the templates that have each, and how many one must share."""
        self.windowed = [(name, len(w), bigrams(w)) for name, w in texts if len(w) > 1]
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in texts for w in words), 1)}
        whose: dict[int, list[int]] = defaultdict(list)
        for t, (_, _, grams) in enumerate(self.windowed):
            for a, b in grams:
                whose[self.number[a] * (len(self.number) + 1) + self.number[b]].append(t)
        self.codes = np.array(sorted(whose), np.int64)
        self.has = np.zeros((len(self.codes), len(self.windowed)), bool)
        for i, c in enumerate(self.codes.tolist()):
            self.has[i, whose[c]] = True
        self.need = np.array([ceil(len(g) * self.least / (2 - self.least) - 1e-9) for _, _, g in self.windowed], np.int64)

    def windows(self, words: list[bytes]) -> list[tuple[float, str, int]]:
        """(dice, license, first word) of each template's best window of at least ``least``, the first of equals.

        A window shares at least g * t / (2 - t) of a template's g bigrams if its Dice is t or more, so a text that has fewer of
        them is passed over, and so is a window that covers fewer.
        """
        if len(words) < 2 or not self.windowed:
            return []
        ids = np.fromiter((self.number.get(w, 0) for w in words), np.int64, len(words))
        at = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
        code = ids[at] * (len(self.number) + 1) + ids[at + 1]
        gram = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[gram] == code
        at, gram = at[hit], gram[hit]
        shared = self.has[np.unique(gram)].sum(0)
        out = []
        for t in np.flatnonzero(shared >= self.need).tolist():
            name, n, grams = self.windowed[t]
            if n > len(words):
                continue
            covered = np.zeros(len(words), np.int64)
            covered[at[self.has[gram, t]] + 1] = 1
            covered = np.cumsum(covered)
            best = (0.0, name, -1)
            for s in np.flatnonzero(covered[n - 1 :] - covered[: len(words) - n + 1] >= self.need[t]).tolist():
                mine = bigrams(words[s : s + n])
                dice = 2 * len(mine & grams) / (len(mine) + len(grams))
                if dice >= self.least and dice > best[0]:
                    best = (dice, name, s)
            if best[2] >= 0:
                out.append(best)
        return out

    def best(self, words: list[bytes]) -> tuple[float, str | None]:
        """The best Dice of at least ``least``, and its template; of equals the one first by name."""
        if len(words) <= self.low:
            return 0.0, None
        mine = bigrams(words)
        n = len(mine)
        if not self.low <= n <= self.high:
            return 0.0, None
        a = bisect_left(self.sizes, ceil(n * self.least / (2 - self.least) - 1e-9))
        b = bisect_right(self.sizes, floor(n * (2 - self.least) / self.least + 1e-9))
        found = [(-2 * len(mine & s) / (n + m), name) for m, name, s in self.sets[a:b]]
        found = [x for x in found if -x[0] >= self.least]
        if not found:
            return 0.0, None
        dice, name = min(found)
        return -dice, name


KIND = "lines array<struct<line:long,license:string,dice:double>>, windows array<struct<word:long,license:string,dice:double>>, license string, dice double"
_UNIT = lambda place: pa.list_(pa.struct([(place, pa.int64()), ("license", pa.string()), ("dice", pa.float64())]))
_ARROW = pa.struct([("lines", _UNIT("line")), ("windows", _UNIT("word")), ("license", pa.string()), ("dice", pa.float64())])


def scan_text(text: str | None, templates: Templates) -> dict:
    lines = [x.split() for x in utf8(text).translate(_FOLD).split(b"\n")]
    found = [{"line": i, "license": name, "dice": dice} for i, w in enumerate(lines) if len(w) > templates.low for dice, name in [templates.best(w)] if name]
    words = [w for x in lines for w in x]
    whole = templates.best(words) if len(lines) > 1 else (0.0, None)
    windows = [{"word": at, "license": name, "dice": dice} for dice, name, at in templates.windows(words)]
    best = min([(-x["dice"], x["license"]) for x in [*found, *windows]] + ([(-whole[0], whole[1])] if whole[1] else []), default=(0.0, None))
    return {"lines": found, "windows": windows, "license": best[1], "dice": -best[0] + 0.0}


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8, column: str = "licenses") -> DataFrame:
    """Return ``docs`` with a struct ``column``: lines (line, license, dice) and windows (word, license, dice) that match, and the best license and dice.

    Each line of a text, the whole text, and every window of as many words as a template has, is compared as a set of word bigrams (ASCII folded to
    lower case, other ASCII signs parting words) with each template whose size allows a Dice of
    ``least``; ``windows`` has the best window of each template, the first of equals. Templates are a stated, bounded list; those of fewer than two words match nothing.
    Null, empty and one-word texts match nothing: no lines, no windows, a null license, dice 0. Ties go to the
    license first by name. Repeated rows are scanned each; an empty table gives an empty one;
    extra columns pass through, but one named ``column`` is replaced. One narrow pass.
    """
    docs = docs.drop(column)
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.StructType.fromDDL(KIND))])

    def run(batches):
        known = Templates(templates, least)
        for b in batches:
            rows = [scan_text(t.as_py(), known) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, _ARROW)], names=schema.names)

    return numbered(docs).mapInArrow(run, schema)


def query(spark, sf_dir):
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "cast(size(licenses.lines) as long) AS n_lines", "cast(size(licenses.windows) as long) AS n_windows", "licenses.license AS license", "round(licenses.dice, 9) AS dice")


_VALUES = ", ".join(f"({i}, '{name}', '{text.replace("'", "''")}')" for i, (name, text) in enumerate(TEMPLATES))
SQL = r"""
WITH t AS (
  SELECT id, name, len(w) AS n, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM (SELECT id, name, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (VALUES {VALUES}) v(id, name, text))
), u AS (
  SELECT doc_id, 0 AS unit, text FROM documents WHERE contains(text, chr(10))
  UNION ALL
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS unit, unnest(string_split(text, chr(10))) AS text FROM documents
), w AS (
  SELECT doc_id, unit, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM u
), g AS (
  SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) >= 2
), m AS (
  SELECT doc_id, unit, name, 2.0 * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice FROM g, t
  WHERE len(g.g) <= 1.5 * len(t.g) AND len(t.g) <= 1.5 * len(g.g)
), dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), c AS (
  SELECT b.doc_id, tb.id FROM (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM dw)) b
  JOIN (SELECT id, unnest(g) AS gram FROM t) tb ON b.gram = tb.gram JOIN t ON t.id = tb.id GROUP BY b.doc_id, tb.id, len(t.g) HAVING 3 * count(*) >= 2 * len(t.g)
), x AS (
  SELECT doc_id, id, name, g, list_distinct(list_transform(range(i, i + n - 1), lambda j: w[j] || ' ' || w[j + 1])) AS mine
  FROM (SELECT dw.doc_id, t.id, t.name, t.g, t.n, dw.w, unnest(range(1, len(dw.w) - t.n + 2)) AS i FROM c JOIN dw ON c.doc_id = dw.doc_id JOIN t ON c.id = t.id WHERE len(dw.w) >= t.n)
), y AS (
  SELECT doc_id, id, name, max(2.0 * len(list_intersect(mine, g)) / (len(mine) + len(g))) AS dice FROM x GROUP BY doc_id, id, name
), f AS (
  SELECT doc_id, unit, name, dice FROM m WHERE dice >= 0.8 UNION ALL SELECT doc_id, -1, name, dice FROM y WHERE dice >= 0.8
), b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name) AS k FROM f
)
SELECT d.doc_id, coalesce(max(l.n), 0) AS n_lines, coalesce(max(l.windows), 0) AS n_windows, max(b.name) AS license, round(coalesce(max(b.dice), 0.0)::DOUBLE, 9) AS dice
FROM documents d LEFT JOIN (SELECT doc_id, count(DISTINCT unit) FILTER (WHERE unit > 0) AS n, count(*) FILTER (WHERE unit = -1) AS windows FROM f GROUP BY doc_id) l ON d.doc_id = l.doc_id
LEFT JOIN b ON d.doc_id = b.doc_id AND b.k = 1 GROUP BY d.doc_id
""".replace("{VALUES}", _VALUES)
