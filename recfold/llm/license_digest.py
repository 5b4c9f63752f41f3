"""License scans: entire texts in a canonical form, looked up by digest among known licences."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recfold.llm.license_texts import DIGESTS
from recfold.llm.rows import HASH, ID, NO_ID, identity

# Equivalent spellings, replaced in this order as whole words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("sub licence", "sublicense"), ("non infringement", "noninfringement"), ("organisation", "organization"),
    ("merchantibility", "merchantability"), ("whilst", "while"), ("copyright owner", "copyright holder"),
    ("https", "http"),
)

# A copyright statement goes to the end of its line, or to where the line goes on with a licence
# that is known to open so: texts whose line breaks were lost.
OPENINGS = (
    "permission is hereby granted", "permission to use", "redistribution and use", "licensed under", "released under",
    "this work is licensed", "this program is free software", "this library is free software", "this software is provided",
)
COPYRIGHT = (
    r"^[^a-z0-9\n(©]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9])|\(c\)|©)[^\n]*?(" + "|".join(OPENINGS) + "|$)"
)

# One-sentence notices that name a licence, and two texts. Entire texts of more
# licences are known by their digests alone (``license_texts.py``).
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("ISC", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    )),
    ("MIT", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    )),
)


def canonical(text: Column) -> Column:
    """Lower case, no copyright statements, words of ASCII letters and digits, one spelling."""
    plain = F.regexp_replace(F.lower(text), "(?md)" + COPYRIGHT, " $1")
    plain = F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), "[^a-z0-9]+", "  ")
    for found, used in SPELLINGS:
        plain = F.replace(plain, F.lit(_apart(found)), F.lit(_apart(used)))
    return F.trim(plain)


def _apart(words: str) -> str:
    """Words with a space on either side of each, so that neighbours don't share one."""
    return "".join(f" {word} " for word in words.split())


def digest(text: Column) -> Column:
    """Digest of the canonical form, never NULL: a join need not compute it again to look for NULLs."""
    return F.coalesce(F.sha2(canonical(F.coalesce(text, F.lit(""))).cast("binary"), 256), F.lit(""))


def known_digests(spark: SparkSession, known=KNOWN, digests=DIGESTS) -> DataFrame:
    """``digest``, ``license`` of a list of texts and of digests; the smallest name where two are equal.

    A text of which nothing is left is none.
    """
    made = [(value, name) for name, values in digests.items() for value in values]
    ready = spark.createDataFrame(made, "digest string, license string")
    rows = F.array(*(F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in known))
    listed = spark.range(1).select(F.inline(rows)).select(digest(F.col("text")).alias("digest"), "license")
    nothing = hashlib.sha256(b"").hexdigest()
    return listed.union(ready).filter(F.col("digest") != nothing).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id``, ``license``, ``notices``, ``n_notices`` of every distinct row of ``docs``.

    ``license`` is the known licence that the entire text is, else NULL. ``notices`` joins the
    names of licences that entire lines are, sorted, each once; ``n_notices`` counts such lines.
    ``known`` has ``digest`` (distinct) and ``license``. NULL and empty texts have none; rows of
    equal id and text are one row, rows without an id stay apart by their text; an empty table
    gives no rows. Other columns are not looked at.
    """
    rows = docs.select(*identity(), F.col("text").cast("string").alias("text"))
    whole = rows.select(ID, HASH, digest(F.col("text")).alias("digest"), F.lit(True).alias("whole"))
    lines = rows.filter(F.contains("text", F.lit("\n"))).select(ID, HASH, F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.filter("line != ''").select(ID, HASH, digest(F.col("line")).alias("digest"), F.lit(False).alias("whole"))
    found = whole.union(lines).join(known, "digest").groupBy(ID, HASH).agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"),
        F.count_if(~F.col("whole")).alias("lines"),
        F.count_if(F.col("whole")).alias("texts"),
    )
    return rows.select(ID, HASH).distinct().join(found, [ID, HASH], "left").select(
        F.when(F.col(ID) != NO_ID, F.col(ID)).alias("doc_id"), "license",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.greatest(F.coalesce("lines", F.lit(0)), F.when(F.col("texts") > 0, 1).otherwise(0)).cast("long").alias("n_notices"),
    )
