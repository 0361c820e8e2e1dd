"""Licence scan: whole texts looked up among known licences by a canonical digest.

Built-in functions only.  The canonical form drops copyright lines and list numbers,
folds A-Z, turns every run of ASCII punctuation, quotes, dashes and white space into one
space and unifies equivalent spellings; its SHA-256 is joined with the digests
of known licences.  Nothing but the digest is shuffled, and a digest that a
third of all documents share is a skewed key of a plain equality join, which
adaptive execution splits (or avoids, while the known side is small).

``known`` tables may be of any size; texts in them pass the same expressions.

Defined results: a null or empty text has the digest of the empty string, which
is never a licence; a known text given twice, or under two names, names the
first by order; repeated rows keep their row; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as the same, in the order they are replaced.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authoris", "authoriz"), ("behaviour", "behavior"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categoris", "categoriz"), ("centre", "center"), ("emphasis", "emphasiz"),
    ("favour", "favor"), ("honour", "honor"), ("initialis", "initializ"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximis", "maximiz"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimis", "optimiz"),
    ("organis", "organiz"), ("per cent", "percent"), ("practise", "practice"), ("programme", "program"),
    ("realis", "realiz"), ("recognis", "recogniz"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("non commercial", "noncommercial"), ("copyright owner", "copyright holder"), ("utilis", "utiliz"),
    ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
)

# A line that states a copyright: it begins with the sign, or with the word and a sign, a year or a placeholder.
COPYRIGHT_LINE = (
    r"(^|\n)[^A-Za-z0-9\n\x{a9}]*"
    r"((copyright[ \t]*(\([cC]\)|\x{a9}|[0-9<\[{]|by[ \t]|:)|\([cC]\)[ \t]*[0-9<\[{]|\x{a9})[^\n]*"
    r"|all rights reserved[. \t]*)"
)
# What only numbers a list: a number or a letter with a point or a bracket at the start of a line.
LIST_MARK = r"(^|\n)[ \t]*\(?([0-9]{1,2}|[a-z])[.)][ \t]"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{a0}\x{a9}\x{2010}-\x{201F}\x{2022}\x{2026}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """The text as it counts for the comparison."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    # a copyright line takes the line break before it along, so that the next line is looked at too
    unmarked = F.regexp_replace(F.regexp_replace(folded, COPYRIGHT_LINE, "\n"), LIST_MARK, "\n")
    plain = F.trim(F.regexp_replace(unmarked, SEPARATORS, " "))
    for other, same in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(same))
    return plain


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_END = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_MIT = _MIT_GRANT + """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

""" + _MIT_END
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.

"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# The wording of short licences, without titles' variants and copyright lines.
KNOWN_TEXTS = (
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
    ("MIT-0", _MIT_GRANT + ".\n\n" + _MIT_END), ("MIT-0", "MIT No Attribution\n\n" + _MIT_GRANT + ".\n\n" + _MIT_END),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n"
     + _ISC_END),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + ", provided that the above copyright notice and this permission notice "
     "appear in all copies.\n" + _ISC_END),
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_END), ("0BSD", "BSD Zero Clause License\n\n" + _ISC_GRANT + ".\n\n" + _ISC_END),
    ("BSD-2-Clause", _BSD_START + _BSD_END), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_START + _BSD_THIRD + _BSD_END),
)

# Digests of the canonical form of long licences.
KNOWN_DIGESTS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "72083b058d325a216c948b17cd4a94aebe681e1c5b51a7106e6d5cb106b15480"),
    ("CC0-1.0", "51c4bf27767d074bdefc84db7420b4c55e27827dac6d8de3ef0d37b2042fb6fa"),
    ("GFDL-1.2", "11b443626816c538e555b7fb60eaba9f2a83a9ecb67ad4a1663e07c118b8e550"),
    ("GFDL-1.3", "cc84a6c6a2b84e8cde0619ed37d987e1a9b39e53ddcaf34f4735e2138dfe6e4a"),
    ("GPL-1.0", "c306b3615801c36b1db5bea9ea7a151745b51407263b2ad066cec7e2dcf13f6b"),
    ("GPL-2.0", "900758e41e829e2d70e5d6efd9883ea34bd2f990abef5f05b12ece4bafa17d2b"),
    ("GPL-3.0", "819b06c3996f37850917e7a4bd9811c4ff2e4e1b9fa0722a8cfb495eab6588cf"),
    ("LGPL-2.0", "62c306bba7828a02209a0800a2da19ae063811f86f71a2638a0ef1d8b335004f"),
    ("LGPL-2.1", "b62d04c0ab535d82cb96aefa3f4237155d798a1f839aca5ae98ba49f03f3bc7b"),
    ("LGPL-3.0", "cb8c0f424bdd5c42a0b18285893829d988e9fb9a00d0cd604a59ebe8da7eeb45"),
    ("MPL-1.1", "661007e231ca5b302d4c3ee263967beb6a810bf9cb12a246d2d15ac0c31860b5"),
    ("MPL-2.0", "aa2454656efbeaddad9c489182749a958bde3f72d5a8f29cf0a5bf66202adab0"),
)


def known_licenses(spark: SparkSession) -> DataFrame:
    """digest and license_id of the licences this module knows."""
    texts = spark.createDataFrame(list(KNOWN_TEXTS), "license_id string, text string")
    from_texts = texts.select(digest(F.col("text")).alias("digest"), "license_id")
    if not KNOWN_DIGESTS:
        return from_texts
    return from_texts.unionByName(spark.createDataFrame(
        [(d, name) for name, d in KNOWN_DIGESTS], "digest string, license_id string"
    ))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license_id (null if the text is no known licence) of every document.

    ``known`` has digest and license_id, as ``known_licenses`` has.
    """
    known = known if known is not None else known_licenses(docs.sparkSession)
    empty = F.sha2(F.lit(""), 256)
    once = known.filter((F.col("digest") != empty) & F.col("license_id").isNotNull()).groupBy("digest").agg(
        F.min("license_id").alias("license_id")
    )
    return docs.select("doc_id", digest(F.col("text")).alias("digest")).join(once, "digest", "left").select(
        "doc_id", "digest", "license_id"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The same in DuckDB's SQL."""

    def canonical_sql(text: str) -> str:
        plain = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
        plain = f"regexp_replace({plain}, {_quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
        plain = f"regexp_replace({plain}, {_quoted(LIST_MARK)}, chr(10), 'g')"
        plain = f"trim(regexp_replace({plain}, {_quoted(SEPARATORS)}, ' ', 'g'), ' ')"
        for other, same in SPELLINGS:
            plain = f"replace({plain}, {_quoted(other)}, {_quoted(same)})"
        return plain

    texts = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN_TEXTS)
    digests = "".join(f" UNION ALL SELECT {_quoted(d)}, {_quoted(name)}" for name, d in KNOWN_DIGESTS)
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id FROM (
    SELECT sha256({canonical_sql('text')}) AS digest, license_id FROM (VALUES {texts}) AS k(license_id, text)
    {digests}) GROUP BY digest),
d AS (SELECT doc_id, sha256({canonical_sql('text')}) AS digest FROM documents)
SELECT d.doc_id, d.digest, known.license_id FROM d LEFT JOIN known USING (digest)
"""
