"""Licence scan by canonical digests of entire texts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.common import plain, read_documents
from treeshred.llm.license_digests import DIGESTS

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# Public licence texts, and notices that stand for a licence.
TEXTS = {
    "MIT": """MIT License
Copyright (c) <year> <copyright holders>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License
Copyright (c) <year> <owner>
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
""" + _AS_IS,
    "0BSD": """Zero-Clause BSD
Copyright (c) <year> <owner>
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
""" + _AS_IS,
    "Zlib": """zlib License
Copyright (c) <year> <owner>
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "WTFPL": """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
Version 2, December 2004
Copyright (C) 2004 Sam Hocevar
Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is
allowed as long as the name is changed.
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION
0. You just DO WHAT THE FUCK YOU WANT TO.""",
}
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "SPDX-License-Identifier: MIT": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is dedicated to the public domain.": "CC0-1.0",
    "All rights reserved.": "All-Rights-Reserved",
}
# Spellings that licence texts use for each other; a canonical text has the second one.
SPELLINGS = {
    "licence": "license", "licenced": "licensed", "sublicence": "sublicense", "acknowledgement": "acknowledgment",
    "merchantibility": "merchantability", "non infringement": "noninfringement", "organisation": "organization",
    "copyright owner": "copyright holder", "per cent": "percent", "https": "http", "v2 0": "version 2 0", "v3": "version 3",
}


OWNER_LINE = r"^[^\p{L}\p{N}\n©(]*(?:©|\(c\)|copyright *(?:©|\(c\)|[0-9<]))[^\n]*$"


def canonical_lines(rows: DataFrame) -> DataFrame:
    """Replace ``text`` by ``lines``: small letters, no punctuation, one spelling, single spaces, no copyright and no empty lines.

    A copyright line is one that begins with the sign, with (c), or with the word before either or a year. A
    null text has no lines.
    """
    # The signs count as punctuation afterwards.
    unowned = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), f"(?md){OWNER_LINE}", "")
    rows = rows.withColumn("text", F.regexp_replace(unowned, r"[^\p{L}\p{N}\n]+", " "))
    # Looking for the letters is much cheaper than the patterns, and few texts have any.
    spelled, has_any = F.col("text"), F.lit(False)
    for other, usual in SPELLINGS.items():
        spelled = F.regexp_replace(spelled, rf"\b{other}\b", usual)
        has_any = has_any | F.contains("text", F.lit(other))
    rows = rows.withColumn("text", F.when(has_any, spelled).otherwise(F.col("text")))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return rows.withColumn("lines", lines).drop("text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def known_digests(spark: SparkSession, texts: dict[str, str] = TEXTS, notices: dict[str, str] = NOTICES,
                  digests: dict[str, str] = DIGESTS) -> DataFrame:
    """digest, license, whole: canonical digests of the known texts and notices, in the way documents are digested.

    ``digests`` are of longer texts and headers, by digest; they are taken as they are.
    """
    rows = [(t, name, True) for name, t in texts.items()] + [(t, name, False) for t, name in notices.items()]
    listed = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(name).alias("license"), F.lit(w).alias("whole")) for t, name, w in rows])
    table = spark.range(1).select(F.explode(listed).alias("k")).select("k.*")
    found = canonical_lines(table).select(digest(F.array_join("lines", " ")).alias("digest"), "license", "whole")
    if digests:
        given = F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(name).alias("license"), F.lit(True).alias("whole"))
                          for d, name in digests.items()])
        found = found.unionByName(spark.range(1).select(F.explode(given).alias("k")).select("k.*"))
    return found.dropDuplicates(["digest"])


def license_scan(docs: DataFrame, texts: dict[str, str] = TEXTS, notices: dict[str, str] = NOTICES,
                 digests: dict[str, str] = DIGESTS) -> DataFrame:
    """One row per document: doc_id, text_digest, license, notices.

    ``license`` is the known licence whose entire canonical text, standard header or notice is the document's; found by a
    hash join of digests with the known ones, whose number is fixed. ``notices`` are the sorted licences whose notice is
    an entire line of the document, found in the same digests. Null and empty texts, and texts of punctuation or copyright lines
    alone, have the digest of the empty text and no licence. Rows are independent: repeated rows and null ids pass
    through; extra columns are dropped; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    known = known_digests(spark, texts, notices, digests)
    notes = known.where(~F.col("whole")).collect()
    rows = canonical_lines(plain(docs, "doc_id", "text")).withColumn("text_digest", digest(F.array_join("lines", " ")))
    if notes:
        names = F.create_map(*[F.lit(x) for r in notes for x in (r["digest"], r["license"])])
        hits = F.filter(F.transform("lines", digest), lambda d: d.isin([r["digest"] for r in notes]))
        found = F.array_sort(F.array_distinct(F.transform(hits, lambda d: F.element_at(names, d))))
    else:
        found = F.array().cast("array<string>")
    whole = known.select(F.col("digest").alias("k_digest"), "license")
    return rows.select("doc_id", "text_digest", found.alias("notices")).join(
        F.broadcast(whole), F.col("text_digest") == F.col("k_digest"), "left").select("doc_id", "text_digest", "license", "notices")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence and notices of every document, the notices joined by commas."""
    found = license_scan(read_documents(spark, sf_dir))
    return found.select("doc_id", "text_digest", "license", F.array_join("notices", ",").alias("notices"))


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(regexp_replace(lower(coalesce({text}, '')), '(?m){OWNER_LINE}', '', 'g'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for other, usual in SPELLINGS.items():
        out = f"regexp_replace({out}, '\\b{other}\\b', '{usual}', 'g')"
    return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _rows_sql(rows: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in rows.items())


OP7_SQL = f"""
WITH notes AS (SELECT sha256(array_to_string({_canonical_sql('t')}, ' ')) AS digest, license FROM (VALUES {_rows_sql(NOTICES)}) AS v(t, license)),
known AS (SELECT sha256(array_to_string({_canonical_sql('t')}, ' ')) AS digest, license
          FROM (VALUES {_rows_sql({t: name for name, t in TEXTS.items()})}) AS v(t, license) UNION SELECT digest, license FROM notes
          UNION SELECT digest, license FROM (VALUES {_rows_sql(DIGESTS)}) AS v(digest, license)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_canonical_sql('text')} AS lines FROM documents),
hits AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
         FROM (SELECT rid, unnest(lines) AS line FROM d) JOIN notes ON sha256(line) = digest GROUP BY rid)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS text_digest, license, coalesce(notices, '') AS notices
FROM d LEFT JOIN hits USING (rid) LEFT JOIN known ON sha256(array_to_string(lines, ' ')) = known.digest
"""
