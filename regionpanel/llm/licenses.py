"""Find licence texts by the digest of their canonical form.

A text is brought to canonical form (lower case, copyright lines out, equivalent spellings to one, punctuation and
blanks to single spaces) and its digest is joined to the digests of known licences. Whole texts are looked up, and
every line by itself, which finds notices that stand in front of other text.

Defined results: null, empty and blank-only texts have no canonical form and match nothing; of known texts with the
same digest the smallest name counts; repeated rows are answered alike; unknown texts have a null name; very long texts are
normalised whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_hash

#: Spellings that count as the same in licence texts, (lower-case spelling, what it becomes).
EQUIVALENT = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("whilst", "while"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("acknowledgement", "acknowledgment"),
    ("https:", "http:"),
    ("&", " and "),
)

#: A line that only states who holds the copyright.
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*(?:\d{4}|\(c\)|©|all rights reserved)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}\n]+"

#: Licences that are short enough to be quoted, and the notices by which the others are named.
KNOWN = (
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
)


def canonical_lines(text: Column) -> Column:
    """Canonical form with the line breaks left in."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for spelling, same in EQUIVALENT:
        t = F.replace(t, F.lit(spelling), F.lit(same))
    return F.regexp_replace(t, NOT_WORD, " ")


def canonical(text: Column) -> Column:
    """Canonical form of a text; null where nothing is left."""
    return one_line(canonical_lines(text))


def one_line(lines: Column) -> Column:
    t = F.trim(F.regexp_replace(F.translate(lines, "\n", " "), " {2,}", " "))
    return F.when(t != "", t)


def digests(known: DataFrame, name: str = "license", text: str = "text") -> DataFrame:
    """One name for each digest of the known texts."""
    rows = known.select(F.md5(canonical(F.col(text))).alias("digest"), F.col(name).alias("license"))
    return rows.dropna().groupBy("digest").agg(F.min("license").alias("license"))


def known_licenses(spark: SparkSession, pairs: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    return digests(spark.createDataFrame(list(pairs), "license string, text string"))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: digest of the whole text, licence it is, licences its lines are, first such line (from 0).

    The text is brought to canonical form once. Its digest and those of its lines are the keys of one hash join with
    ``known``; the answers are grouped again by document, a few small values for each.
    """
    lines = canonical_lines(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_hash(F.col(text)).alias("text_hash"), lines.alias("_lines"))
    each = F.transform(F.split("_lines", "\n"), lambda x: F.md5(F.trim(x)))
    keys = F.concat(F.array(F.md5(one_line(F.col("_lines")))), F.coalesce(each, F.array().cast("array<string>")))
    rows = rows.select("doc_id", "text_hash", F.posexplode(keys).alias("pos", "digest"))
    blank = F.md5(F.lit(""))
    rows = rows.withColumn("digest", F.when((F.col("pos") == 0) | (F.col("digest") != blank), F.col("digest")))
    rows = rows.filter((F.col("pos") == 0) | F.col("digest").isNotNull()).join(known, "digest", "left")
    whole = F.col("pos") == 0
    named = ~whole & F.col("license").isNotNull()
    out = rows.groupBy("doc_id", "text_hash").agg(
        F.max(F.when(whole, F.col("digest"))).alias("digest"),
        F.max(F.when(whole, F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(named, F.col("license")))), " ").alias("line_licenses"),
        F.min(F.when(named, F.col("pos") - 1)).cast("long").alias("first_line"),
        F.count(F.when(whole, F.lit(1))).cast("int").alias("_copies"),
    )
    # Rows alike in id and text came together; each gets its row again.
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
    return out.select("doc_id", "digest", "license", "line_licenses", "first_line")
