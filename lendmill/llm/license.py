"""License scan: canonical digests of entire texts, joined to the digests of known licenses.

The canonical form of a text: lower case, copyright lines removed, everything but letters and
digits read as one blank, equivalent spellings made equal. Two texts with equal canonical forms
are the same license whatever their case, punctuation, line breaks or copyright holder. Entire
texts are matched: the whole document, and every line of it (notices). Known texts are short
license texts and the usual notices, built from names and sentence frames.

All of it is DataFrame expressions and one equi-join on SHA-256 digests. Lines and texts without
a word that every known text contains cannot match and skip the canonical form; the check
``words_suffice`` makes sure of that for the known texts given.

Defined results: null and empty texts match nothing; a row repeated in the input is repeated in
the result; a digest known under several names reports the first by name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COPYRIGHT_LINE = (r"(^|\n)[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|<|[0-9]|by )|\(c\)|©|"
                  r"all rights reserved)[^\n]*")

# Spellings that license matching treats as equal (pattern, replacement).
SPELLINGS = [
    ("licenc", "licens"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("(author|initial|organ|optim|recogn|util)is(e|ed|es|ing|ation|ations)\\b", "\\1iz\\2"),
    ("behaviour", "behavior"),
    ("cancelled", "canceled"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfil\\b", "fulfill"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("programme\\b", "program"),
    ("sub license", "sublicense"),
    ("while st|whilst", "while"),
    ("https", "http"),
    ("\\bv ?([0-9])", "version \\1"),
]
STEMS = "licen|permi|redistrib|domain|releas|distribut|availab"

# Identifier, names and the usual notice frames.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MIT": ["MIT License", "MIT licence"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GPL version 2 license"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GPL version 3 license"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "ISC": ["ISC License"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0",
                     "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0",
                     "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
}
FRAMES = [
    "Licensed under {}.", "Licensed under the {}.", "Released under {}.",
    "Released under the {}.", "Distributed under the {}.", "Available under the {}.",
    "This work is licensed under {}.", "This work is licensed under the {}.",
    "This work is licensed under a {}.", "This software is licensed under the {}.",
    "This project is licensed under the {}.", "This program is licensed under the {}.",
    "This file is licensed under the {}.", "License: {}", "SPDX-License-Identifier: {}",
]

# Entire short license texts.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY
OF SUCH DAMAGE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it
under the terms of the GNU General Public License as published by the Free Software Foundation,
either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
for more details. You should have received a copy of the GNU General Public License along with this
program. If not, see <https://www.gnu.org/licenses/>.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone
is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more
information, please refer to <https://unlicense.org>""",
}
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED BY", """3. Neither
the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. THIS SOFTWARE IS
PROVIDED BY""")


def known_texts() -> list[tuple[str, str]]:
    """(identifier, text) of every known license text and notice."""
    found = list(TEXTS.items())
    for spdx, names in NAMES.items():
        for name in [*names, spdx]:
            found += [(spdx, frame.format(name)) for frame in FRAMES]
    for spdx in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"):  # with the usual title line
        found.append((spdx, f"{NAMES[spdx][0]}\n{TEXTS[spdx]}"))
    return found


def steps() -> list[tuple[str, str]]:
    """(pattern, replacement with \\1) pairs that make a lower-case text canonical, in order."""
    return [(COPYRIGHT_LINE, r"\1"), (r"[^a-z0-9]+", " "), *SPELLINGS]


def canonical(text: Column) -> Column:
    out = F.translate(text, UPPER, LOWER)
    for pattern, to in steps():
        out = F.regexp_replace(out, pattern, to.replace("\\", "$"))
    return F.trim(out)


def words_suffice(texts: list[tuple[str, str]]) -> bool:
    return all(re.search(STEMS, text.lower()) for _, text in texts)


def known(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """(digest, license), one row per digest."""
    if not words_suffice(texts):
        raise ValueError("a known text has none of the words that candidates must contain")
    table = spark.createDataFrame(texts, "license string, text string")
    return table.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license") \
        .groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: list[tuple[str, str]] | None = None, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Per row: doc_id, text_license (of the whole text, or null), notices (identifiers of
    license lines, sorted, joined by commas) and n_notices (number of such lines)."""
    spark = docs.sparkSession
    table = known(spark, known_texts() if texts is None else texts)
    candidate = F.lower(F.col(text)).rlike(STEMS)
    # rows without a candidate keep one empty unit, so that each row comes back once
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: F.lower(x).rlike(STEMS)),
                        lambda x: F.struct(F.lit(True).alias("line"), x.alias("body")))
    whole = F.array(F.struct(F.lit(False).alias("line"),
                             F.when(candidate, F.col(text)).alias("body")))
    units = docs.select(F.col(doc_id).alias("doc_id"),
                        F.monotonically_increasing_id().alias("row"),
                        F.when(candidate, F.concat(whole, lines)).otherwise(whole).alias("units"))
    units = units.select("doc_id", "row", F.explode("units").alias("unit"))
    units = units.select("doc_id", "row", "unit.line",
                         F.when(F.col("unit.body").isNotNull(),
                                F.sha2(canonical(F.col("unit.body")), 256)).alias("digest"))
    found = units.join(table, "digest", "left")
    notice = F.when(F.col("line"), F.col("license"))
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(~F.col("line"), F.col("license"))).alias("text_license"),
        F.array_join(F.array_sort(F.collect_set(notice)), ",").alias("notices"),
        F.count(notice).alias("n_notices")).drop("row")


def oracle(texts: list[tuple[str, str]] | None = None) -> str:
    """DuckDB SQL of ``scan`` over ``documents``: the canonical form of every line."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def form(column: str) -> str:
        out = f"translate({column}, '{UPPER}', '{LOWER}')"
        for pattern, to in steps():
            out = f"regexp_replace({out}, {quote(pattern)}, {quote(to)}, 'g')"
        return f"sha256(trim({out}))"

    rows = ", ".join(f"({quote(spdx)}, {quote(text)})"
                     for spdx, text in (known_texts() if texts is None else texts))
    return f"""
WITH known AS (
  SELECT {form('body')} AS digest, min(license) AS license
  FROM (VALUES {rows}) AS t(license, body) GROUP BY 1
), numbered AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents
), whole AS (
  SELECT rid, license FROM numbered JOIN known ON {form('text')} = digest
), lines AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line FROM numbered
), notices AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices,
         count(*) AS n_notices
  FROM lines JOIN known ON {form('line')} = digest GROUP BY rid
)
SELECT doc_id, whole.license AS text_license, coalesce(notices, '') AS notices,
       CAST(coalesce(n_notices, 0) AS BIGINT) AS n_notices
FROM numbered LEFT JOIN whole USING (rid) LEFT JOIN notices USING (rid)"""
