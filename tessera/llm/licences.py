"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case, equivalent spellings made one, copyright lines taken out,
every run of other characters than letters and digits made one blank. The digest of the entire canonical text
is hash-joined to the digests of known licences. Each document is looked up as a whole and each of its lines
as a notice of its own; a line of a licence of several lines is no licence.

Up to `MOST` known digests are broadcast and documents are not shuffled; more are joined by a shuffle, where only
the digests and places of the documents' lines travel.

Defined results: one row per match; null and empty texts, and texts of copyright lines alone, match nothing;
repeated rows each give their matches; a licence known under two names gives a row for each; extra columns
are left out; an empty table gives no rows. A very long text is read as a whole by one task, in the JVM.
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

MOST = 10_000

# Spellings that mean the same in a licence text.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("programme", "program"),
    ("per cent", "percent"),
    ("https:", "http:"),
    ("(c)", "copyright"),
    ("©", "copyright"),
    ("&", "and"),
)

# Licence texts and notices, as their stewards publish them.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
KNOWN = (
    (
        "MIT",
        "MIT License\n\nCopyright (c) <year> <copyright holders>\n\nPermission is hereby granted, free of charge, to any person obtaining a copy "
        'of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the Software.\n\n" + _WARRANTY,
    ),
    (
        "ISC",
        "ISC License\n\nCopyright (c) <year> <owner>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END,
    ),
    (
        "0BSD",
        "Zero-Clause BSD\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _ISC_END,
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may '
        "obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, "
        'software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
        'under copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <http://unlicense.org/>",
    ),
)
# Names of licences, as they stand in the line that names a file's licence.
NAMES = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "MIT", "MPL-2.0", "Unlicense", "Zlib",
)

#: Lines left out of an entire text: those that only say who holds the copyright.
_COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*copyright[^\p{L}\n][^\n]*$"
_OTHER = r"[^\p{L}\p{N}]+"


def _spelt(text: Column) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, F.lower(text))


def _blanked(spelt: Column) -> Column:
    return F.btrim(F.regexp_replace(spelt, _OTHER, " "))


def canonical(text: Column) -> Column:
    """Canonical form of an entire text."""
    return _blanked(F.regexp_replace(_spelt(text), _COPYRIGHT_LINE, " "))


def known_texts() -> tuple[tuple[str, str], ...]:
    """KNOWN, lines that name a licence, and the longer texts of licence_texts.json, with their variants of title and closing part."""
    path = os.path.join(os.path.dirname(__file__), "licence_texts.json")
    with open(path, encoding="utf-8") as f:
        return (*KNOWN, *((name, f"SPDX-License-Identifier: {name}") for name in NAMES), *((name, text) for name, text in json.load(f)))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(license, digest, known_lines): digests of the known texts, lines counted as written."""
    known = known_texts() if known is None else known
    rows = spark.createDataFrame([(name, text) for name, text in known], "license string, known string")
    one_line = ~F.col("known").contains("\n")
    form = F.when(one_line, _blanked(_spelt(F.col("known")))).otherwise(canonical(F.col("known")))
    return rows.select("license", F.md5(form.cast("binary")).alias("digest"), one_line.alias("one_line")).distinct()


def scan(documents: DataFrame, known: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, unit ('text' or 'line'), line_no (from 1; 0 for the entire text), license and digest of every match."""
    few = known.limit(most + 1).count() <= most
    rows = documents.select(F.col("doc_id").cast("long"), _spelt(F.col("text").cast("string")).alias("text"))
    whole = F.struct(F.lit(0).cast("long").alias("line_no"), _blanked(F.regexp_replace("text", _COPYRIGHT_LINE, " ")).alias("form"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).cast("long").alias("line_no"), _blanked(x).alias("form")))
    units = rows.select("doc_id", F.explode(F.concat(F.array(whole), lines)).alias("u")).where("u.form <> ''")
    found = units.select("doc_id", "u.line_no", F.md5(F.col("u.form").cast("binary")).alias("d")).join(F.broadcast(known) if few else known, F.col("d") == F.col("digest"))
    found = found.where("line_no = 0 or one_line")
    return found.select("doc_id", F.when(F.col("line_no") == 0, "text").otherwise("line").alias("unit"), "line_no", "license", "digest")


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known licence or notice in `documents`."""
    return scan(common.table(spark, sf_dir, "documents"), known_digests(spark))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql() -> str:
    spelt = reduce(lambda t, pair: f"replace({t}, {_quoted(pair[0])}, {_quoted(pair[1])})", SPELLINGS, "lower({})")
    blank = r"trim(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    whole = r"regexp_replace({}, '(?m)^[^\p{{L}}\p{{N}}\n]*copyright[^\p{{L}}\n][^\n]*$', ' ', 'g')"
    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known_texts())
    return f"""
WITH k AS (SELECT license, known, NOT contains(known, chr(10)) AS one_line, {spelt.format('known')} AS s FROM (VALUES {values}) v(license, known)),
kd AS (SELECT DISTINCT license, one_line, md5(CASE WHEN one_line THEN {blank.format('s')} ELSE {blank.format(whole.format('s'))} END) AS digest FROM k),
d AS (SELECT doc_id, {spelt.format('text')} AS s FROM documents),
u AS (
  SELECT doc_id, 0 AS line_no, {blank.format(whole.format('s'))} AS form FROM d
  UNION ALL
  SELECT doc_id, line_no, {blank.format('line')} AS form
  FROM (SELECT doc_id, unnest(string_split(s, chr(10))) AS line, unnest(range(1, len(string_split(s, chr(10))) + 1)) AS line_no FROM d))
SELECT doc_id, CASE WHEN line_no = 0 THEN 'text' ELSE 'line' END AS unit, line_no, license, digest
FROM u JOIN kd ON md5(form) = digest
WHERE form <> '' AND (line_no = 0 OR one_line)"""


QUERIES = {"op9_licences": op9_licences}
SQL = {"op9_licences": _sql()}
