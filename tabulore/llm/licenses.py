"""License scans by canonical digests.

Texts are brought to one form (case, copyright lines, equivalent spellings, punctuation), and the digests of the
entire text and of each of its lines are hash-joined with the digests of known licences and notices. Only
expressions of Spark SQL are used. What is looked up is always a whole unit: a word more or less is no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The wording of public licences. Copyright lines are left out, as the canonical form drops them.
_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
FULL_TEXTS = (
    ("MIT", _PERMISSION),
    ("MIT", "MIT License\n\n" + _PERMISSION),
    ("MIT", "The MIT License (MIT)\n\n" + _PERMISSION),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
)
#: SPDX identifiers and the names that notices use.
NAMES = (
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
)
NOTICES = ("", "License: ", "Licensed under ", "Released under ", "Distributed under ", "This work is licensed under ",
           "This software is licensed under ", "This project is licensed under ")

#: What becomes one spelling, in this order, after lower-casing. Patterns mean the same in Java and RE2.
COPYRIGHT = r"(^|\n)[^\n\p{L}\p{N}]*(copyright|\(c\)|©)[^\n]*"
SPELLINGS = (
    (r"all rights reserved", " "),
    (r"licence", "license"),
    (r"sub-license", "sublicense"),
    (r"merchantibility", "merchantability"),
    (r"non-infringement", "noninfringement"),
    (r"copyright owner", "copyright holder"),
    (r"https://", "http://"),
    (r"(^|[^\p{L}\p{N}])v(\.|er\.|ersion)? ?([0-9])", r"$1version $3"),
    (r"&", " and "),
)
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
#: COPYRIGHT without lines of a wrapped text that go on about copyright, unless they have a year or sign; the SQL cannot
#: look ahead and has COPYRIGHT.
NOTICE = COPYRIGHT.replace("(copyright|", (
    r"(copyright(?![^\n\p{L}\p{N}]+(notice|holder|owner|law|licen[cs]e|statement)s?([^\p{L}\p{N}]|$)"
    r"(?![^\n]*((19|20)[0-9][0-9]|\(c\)|©)))|"
), 1)


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form: words with single blanks between them, empty lines left out."""
    out = F.regexp_replace(F.lower(text), NOTICE, "\n")
    for pattern, spelling in SPELLINGS:
        out = F.regexp_replace(out, pattern, spelling)
    lines = F.transform(F.split(F.regexp_replace(out, PUNCTUATION, " "), "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def digest(canonical: Column) -> Column:
    return F.md5(canonical.cast("binary"))


def catalog_rows() -> list[tuple[str, str]]:
    rows = list(FULL_TEXTS)
    for spdx, name in NAMES:
        rows += [(spdx, f"{notice}{article}{name}") for notice in NOTICES for article in ("", "the ")]
        rows += [(spdx, f"SPDX-License-Identifier: {spdx}"), (spdx, f"License: {spdx}"), (spdx, spdx)]
    return rows


def known_licenses(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest) of the catalog, one licence per digest."""
    literals = [F.struct(F.lit(a).alias("license"), F.lit(b).alias("text")) for a, b in rows or catalog_rows()]
    known = spark.range(1).select(F.inline(F.array(*literals)))
    return (
        known.select("license", digest(F.array_join(canonical_lines(F.col("text")), " ")).alias("digest"))
        .groupBy("digest").agg(F.min("license").alias("license"))
    )


def scan_licenses(df: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_license, line_licenses) per row.

    ``text_license`` is the licence whose text the entire document is, ``line_licenses`` the sorted, distinct
    licences of which a whole line is a text or notice. A null or empty text, or one of nothing but a copyright
    line, has none (null and an empty array). Every row stays, repeated rows and null keys too: hits are kept by
    the digest of the raw text, so equal texts are looked up once and no text is shuffled. ``known`` is
    (license, digest) with one row per digest; the catalog of this module, a few hundred rows, is broadcast,
    a given one only if Spark finds it small.
    """
    known = known if known is not None else F.broadcast(known_licenses(df.sparkSession))
    raw = F.md5(F.col(f"`{text}`").cast("binary"))
    lines = df.select(raw.alias("raw"), canonical_lines(F.col(f"`{text}`")).alias("lines"))
    entire = F.array(F.struct(F.lit(True).alias("entire"), digest(F.array_join("lines", " ")).alias("digest")))
    each = F.transform(F.array_distinct("lines"), lambda x: F.struct(F.lit(False).alias("entire"), digest(x).alias("digest")))
    hits = (
        lines.select("raw", F.explode(F.when(F.size("lines") > 0, F.concat(entire, each))).alias("unit")).select("raw", "unit.entire", "unit.digest")
        .join(known, "digest")
        .groupBy("raw").agg(
            F.min(F.when(F.col("entire"), F.col("license"))).alias("text_license"),
            F.array_sort(F.collect_set(F.when(~F.col("entire"), F.col("license")))).alias("line_licenses"),
        )
    )
    rows = df.select(F.col(f"`{key}`"), raw.alias("raw"))
    return rows.join(hits, "raw", "left").select(
        F.col(f"`{key}`"), "text_license", F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses")
    )


def scan_sql(table: str = "documents") -> str:
    """DuckDB SQL for ``scan_licenses`` with the licences of the lines joined by commas."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(lower(text), {quote(COPYRIGHT)}, chr(10), 'g')"
    for pattern, spelling in SPELLINGS:
        out = f"regexp_replace({out}, {quote(pattern)}, {quote(spelling.replace('$', chr(92)))}, 'g')"
    lines = (
        f"list_filter(list_transform(string_split(regexp_replace({out}, {quote(PUNCTUATION)}, ' ', 'g'), chr(10)), "
        "lambda x: trim(x)), lambda x: x <> '')"
    )
    values = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in catalog_rows())
    return f"""
WITH catalog(license, text) AS (VALUES {values}),
known AS (SELECT md5(array_to_string({lines}, ' ')) AS digest, min(license) AS license FROM catalog GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lines} AS lines FROM {table}),
entire AS (SELECT r, license FROM docs JOIN known ON digest = md5(array_to_string(lines, ' ')) WHERE len(lines) > 0),
each_line AS (SELECT r, md5(unnest(lines)) AS digest FROM docs),
per_line AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
  FROM each_line JOIN known USING (digest) GROUP BY r)
SELECT doc_id, e.license AS text_license, coalesce(p.line_licenses, '') AS line_licenses
FROM docs LEFT JOIN entire e USING (r) LEFT JOIN per_line p USING (r)
"""
