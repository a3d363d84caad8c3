"""Licence scans by digest of the canonical text.

A text is put into a canonical form: lower case, copyright lines dropped, punctuation
and white space turned into single spaces, spellings that licence matching treats as
equal made equal. The digest of the whole form is joined with the digests of known
licences. Units are the whole document and each of its lines, the latter for notices
of one line; known texts are both.

DataFrame functions only. A licence in a third of all documents is one row of the known
side, joined with rows of the other; hits of a document are few.

Defined cases: a null text has a null digest and no licence; a text that is empty in
canonical form matches nothing; known texts with equal canonical form are reported
under each of their ids; repeated rows are reported each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.text import contains_any
from tallyport.llm.common import Stage, let, lower_ascii, row_key, table

# Spellings that licence matching guidelines treat as equal.
SAME_SPELLING = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "noncommercial": "non commercial",
    "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "sublicence": "sublicense", "sub license": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful", "https": "http",
}


def either(words: list[str]) -> str:
    """A regular expression for any of the words that tries each letter once, as a tree of common beginnings."""
    ends = {w[0]: [v[1:] for v in words if v[:1] == w[0]] for w in words if w}
    branches = [f"{head}{either(rest)}" for head, rest in ends.items()] + [""] * ("" in words)
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


ANY_RESPELT = rf"\b{either(list(SAME_SPELLING))}\b"
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A notice: a copyright sign or word followed by a year or another sign, or by at most six words that begin no
# sentence of a licence; or the reservation alone. Other lines that begin so are text.
NOT_A_NAME = r"(the\s+)?(above\s|holder|owner|notice|licen[sc]e|law|statement|interest|claim|disclaimer|protect|act\b|treat|and\b|or\b|" \
    r"in\b|is\b|are\b|as\b|to\b|of\b|on\b|for\b|that\b|which\b|you\b|may\b|must\b|shall\b|if\b|information)"
COPYRIGHT = r"^[^a-z0-9]*((copyright|\(c\)|©)[\s:,]*(by\s+)?(\(c\)|©|copyright\s*(\(c\)|©|[0-9])|[<\[{(]?([0-9]{4}|y{4}|year)\b)|" \
    rf"©|(copyright|\(c\))[\s:,]+(by\s+)?(?!{NOT_A_NAME})\S+(\s+\S+){{0,5}}\s*$|all rights reserved[^a-z0-9]*$)"
# Each match of COPYRIGHT holds one of these.
COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved")

# Licence texts and one-line notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
KNOWN = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]


def canonical_line(line: Column) -> Column:
    """One line in canonical form; empty if it is a copyright line."""

    def respell(plain: Column) -> Column:
        out = plain
        for word, other in SAME_SPELLING.items():
            out = F.regexp_replace(out, rf"\b{word}\b", other)
        return out

    def body(low: Column) -> Column:
        plain = F.trim(F.regexp_replace(low, PUNCTUATION, " "))
        notice = contains_any(low, COPYRIGHT_SIGNS) & low.rlike(COPYRIGHT)
        return F.when(notice, "").otherwise(let(plain, lambda p: F.when(p.rlike(ANY_RESPELT), respell(p)).otherwise(p)))

    return let(lower_ascii(line), body)


def digests(docs: DataFrame, *more: Column) -> DataFrame:
    """digest of the whole canonical text and the distinct digests of its lines, empty ones left out."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), canonical_line), lambda x: x != "")
    sha = lambda x: F.unhex(F.sha2(x, 256))
    whole = lambda x: F.when(F.size(x) > 0, F.sha2(F.array_join(x, " "), 256))
    both = let(lines, lambda x: F.struct(whole(x).alias("digest"), F.array_distinct(F.transform(x, sha)).alias("lines")))
    return docs.select(*more, both.alias("both")).select(*[c for c in docs.select(*more).columns], "both.digest", "both.lines")


def known_digests(known: DataFrame) -> DataFrame:
    """(licence_id, text) -> (licence_id, known_digest), once each."""
    found = digests(known, F.col("licence_id"))
    return found.filter("digest IS NOT NULL").select("licence_id", F.col("digest").alias("known_digest")).distinct()


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, licences (ids of the whole text), notices (ids of its lines), both sorted, joined by commas.

    Digests are written once: rows and lines are both read from there, no text is made canonical again.
    """
    rows = Stage(docs.sparkSession, "licences").keep(digests(docs, *row_key(), F.col("doc_id")))
    ids = known_digests(known)
    whole = ids.groupBy("known_digest").agg(F.array_join(F.array_sort(F.collect_set("licence_id")), ",").alias("licences"))
    by_line = ids.select(F.unhex("known_digest").alias("line"), "licence_id")
    lines = rows.select("k1", "k2", F.explode("lines").alias("line"))
    notices = lines.join(by_line, "line").groupBy("k1", "k2").agg(
        F.array_join(F.array_sort(F.collect_set("licence_id")), ",").alias("notices"))
    met = rows.drop("lines").join(whole, rows.digest == whole.known_digest, "left").join(notices, ["k1", "k2"], "left")
    return met.select("doc_id", "digest", F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("notices", F.lit("")).alias("notices"))


def built_in(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence_id string, text string")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), built_in(spark))
