"""Licence scan in DataFrame expressions alone: normalised text against licence templates by the Dice coefficient.

A text is lower-cased, marks and runs of white space are turned into single spaces, and what is compared is the set of
its word bigrams: of the whole text, of each line, and of its windows: for each template, the runs of as many words as
the template has (up to the text's end) that begin with one of its bigrams, so a notice that is wrapped over lines or
stands within prose is found. A template of b bigrams can only reach a Dice coefficient of t with a set of a bigrams if
a * t / (2 - t) <= b <= a * (2 - t) / t, and then shares b * t / (2 - t) of its bigrams at least. A unit's templates
are pruned by the first bound before they are compared, and a text's windows are only looked at for templates of which
the whole text has so many bigrams. The templates are short notices and the short licences (fixed values), so the whole
table of them is a literal in the plan.

Narrow but for one aggregation, keyed by row and partly done in its task.

Defined cases: a null or empty text has no match (null licence, score 0); lines of one word have no bigram and match
nothing; ties go to the longer template, then to the name that sorts first; repeated rows and ids keep a row each; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence notices as their stewards publish them (fixed values): (name, notice).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
)
THRESHOLD = 0.8


def normalised_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^0-9a-z]+", "".join(c.lower() if c.isascii() else " " for c in text)) if w]


@cache
def templates() -> tuple[tuple[str, int, tuple[str, ...]], ...]:
    """(name, words, distinct bigrams in order) of each template."""
    out = []
    for name, notice in TEMPLATES:
        w = normalised_words(notice)
        out.append((name, len(w), tuple(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))))
    return tuple(out)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^0-9a-z]+", " "), " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    """In order, repeats included."""
    return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))


def _dice(t: Column, grams: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(t["grams"], grams)) / (t["b"] + F.size(grams))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, license, score, n_matches, n_units, n_window_templates): the best match at or over the threshold among a
    text's units (the whole and each line) and windows, how many units match, how many there are, and how many
    templates match a window."""
    found = templates()
    sizes = [len(b) for _, _, b in found]
    low, high = min(sizes) * threshold / (2 - threshold), max(sizes) * (2 - threshold) / threshold
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("words"), F.lit(len(b)).alias("b"), F.array(*[F.lit(x) for x in b]).alias("grams")) for n, k, b in found])
    every = F.array(*[F.lit(x) for x in dict.fromkeys(x for _, _, b in found for x in b)])
    def match(score: Column, t: Column) -> Column:
        return F.struct(score.alias("score"), t["b"].alias("b"), _rank(found, t["name"]).alias("rank"), t["name"].alias("name"))

    def best_of_set(rows: DataFrame, name: str) -> DataFrame:
        """rows with the best match of the bigram set g at or over the threshold."""
        a = F.size("g")
        near = F.filter(table, lambda t: (t["b"] * (2 - threshold) >= a * threshold) & (t["b"] * threshold <= a * (2 - threshold)))
        best = F.array_max(F.transform(near, lambda t: match(_dice(t, F.col("g")), t)))
        return rows.withColumn(name, F.when(F.col("g").isNotNull() & (a > 0) & (a <= int(high)), best)).withColumn(name, F.when(F.col(f"{name}.score") >= threshold, F.col(name)))

    def best_window(t: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(1), F.size("o")), lambda i: F.array_contains(t["grams"], F.element_at("o", i)))
        return F.array_max(F.transform(begins, lambda i: _dice(t, F.array_distinct(F.slice("o", i, t["words"] - 1)))))

    # The whole text: its set, and its windows, for templates that it has enough bigrams of.
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), text.alias("text"), F.array_union(F.array(text), F.split(text, "\n")).alias("units"))
    keys = ["rid", "id", F.size("units").cast("long").alias("n_units"), F.slice("units", F.lit(2), F.size("units")).alias("lines")]
    whole = rows.select(*keys, _words(F.col("text")).alias("w"))
    keys = ["rid", "id", "n_units", "lines"]
    whole = whole.select(*keys, F.when(F.size("w") - 1 >= int(low), _bigrams(F.col("w"))).alias("o"))
    whole = best_of_set(whole.select(*keys, "o", F.array_distinct("o").alias("g")), "m0")
    met = whole.select(*keys, "m0", "o", F.array_intersect("g", every).alias("met"))
    enough = F.filter(table, lambda t: F.size(F.array_intersect(t["grams"], F.col("met"))) * (2 - threshold) >= t["b"] * threshold)
    met = met.select(*keys, "m0", "o", F.when(F.size("met") >= int(low), enough).alias("enough"))
    windows = F.filter(F.transform("enough", lambda t: match(best_window(t), t)), lambda m: m["score"] >= threshold)
    found_whole = met.select(*keys, "m0", windows.alias("windows")).select(*keys, "m0", F.array_max("windows").alias("m1"), F.greatest(F.size("windows"), F.lit(0)).cast("long").alias("n_window_templates"))
    # Its lines, each for itself.
    keys = ["rid", "id", "n_units", "m0", "m1", "n_window_templates"]
    words = found_whole.select(*keys, F.explode_outer("lines").alias("unit")).select(*keys, _words(F.col("unit")).alias("w"))
    grams = words.select(*keys, F.when(F.size("w") - 1 >= int(low), F.array_distinct(_bigrams(F.col("w")))).alias("g"))
    top = best_of_set(grams, "m").groupBy(*keys).agg(F.max("m").alias("m"), F.count("m").alias("n_lines"))
    top = top.withColumn("m", F.greatest("m", "m0", "m1"))
    n_matches = F.col("n_lines") + F.when(F.col("m0").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return top.select(F.col("id").alias(id_col), F.col("m.name").alias("license"), F.coalesce("m.score", F.lit(0.0)).alias("score"), n_matches.alias("n_matches"), "n_units", "n_window_templates")


def _rank(found, name: Column) -> Column:
    """Greater for names that sort first."""
    names = sorted({n for n, _, _ in found})
    return F.lit(len(names)) - F.array_position(F.array(*[F.lit(n) for n in names]), name)
