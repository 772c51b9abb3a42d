"""Operator 5: licence texts by canonical digest [DataFrame functions only].

A text is made canonical: lower case; copyright lines out; everything but
letters and digits to single spaces; equivalent spellings to one of them.
The digest of the whole canonical text is joined with the digests of the
known licences, which are made canonical by the same expression. The known
table is a parameter with a fixed number of rows, so it is broadcast; the
documents are only scanned. ``line_notices`` does the same for every whole
line, which finds notices inside longer documents, and ``license_report``
gives both for every document. A full licence text of several lines inside a
longer document is not found.

Defined cases: null and empty texts, and texts of copyright lines alone, have
the digest of the empty text and no licence; equal canonical texts of two
known licences give the smaller name; repeated rows stay; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.shared import pick

# Equivalent spellings, the left is written as the right.
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisation", "capitalization"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright holder", "copyright owner"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"),
    ("fulfil ", "fulfill "), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("non commercial", "noncommercial"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("sub license", "sublicense"), ("sub program", "subprogram"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"), ("with out", "without"),
]

# Known licence texts and notices, by name.
KNOWN = [
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
     "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
     "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
     "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
     "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE "
     "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
     "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
     "PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
     "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
     "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
     "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT-notice", "Released under the MIT License."),
]

_BSD_1 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
          "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
          "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
          "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
          "distribution.\n\n")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
          "derived from this software without specific prior written permission.\n\n")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
            "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
            "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _full_texts() -> list[tuple[str, str]]:
    """The texts in ``licences/``, and without what follows their terms."""
    out = []
    for f in sorted((Path(__file__).parent / "licences").glob("*.txt")):
        text = f.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(f.stem, t) for t in dict.fromkeys([text, terms + end, terms])]
    return out


KNOWN += [("BSD-2-Clause", _BSD_1 + _BSD_END), ("BSD-3-Clause", _BSD_1 + _BSD_3 + _BSD_END), *_full_texts()]

# A line that begins, but for signs, with a copyright word.
COPYRIGHT_LINE = r"\n[^a-z0-9\n]*(copyright |\(c\) |©)[^\n]*"
SIGNS = r"[^0-9a-z\x{C0}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """The canonical form of a whole text; '' for null."""
    t = F.concat(F.lit("\n"), F.lower(F.coalesce(text, F.lit(""))))
    t = F.regexp_replace(t, COPYRIGHT_LINE, "")
    t = F.concat(F.lit(" "), F.regexp_replace(t, SIGNS, " "), F.lit(" "))
    t = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), EQUIVALENT, t)
    return F.trim(t)


def known_digests(spark, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, licence) of the known texts; one row a digest."""
    rows = spark.createDataFrame(known, "licence string, text string")
    return (rows.select(F.md5(canonical(F.col("text"))).alias("digest"), "licence")
            .groupBy("digest").agg(F.min("licence").alias("licence")))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(doc_id, digest, licence): the digest of every whole text, and the
    known licence with this digest, else null."""
    base = pick(docs, {"doc_id": id_col, "text": text_col})
    table = F.broadcast(known_digests(docs.sparkSession, known))  # as many rows as the parameter
    return base.select("doc_id", F.md5(canonical(F.col("text"))).alias("digest")).join(table, "digest", "left") \
        .select("doc_id", "digest", "licence")


def line_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(doc_id, line_no, licence) of every whole line with a known digest."""
    base = pick(docs, {"doc_id": id_col, "text": text_col}).where("text is not null")
    lines = base.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    table = F.broadcast(known_digests(docs.sparkSession, known))
    return (lines.select("doc_id", "line_no", F.md5(canonical(F.col("line"))).alias("digest"))
            .join(table, "digest").select("doc_id", "line_no", "licence"))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``license_scan`` with ``notices``, the sorted distinct licences of the
    ``line_notices`` of the doc_id (empty if none; rows that repeat a doc_id
    have those of all its rows)."""
    lines = (line_notices(docs, id_col, text_col, known).groupBy(F.col("doc_id").alias("_id"))
             .agg(F.sort_array(F.collect_set("licence")).alias("_found")))
    whole = license_scan(docs, id_col, text_col, known)
    return (whole.join(lines, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
            .select("doc_id", "digest", "licence", F.coalesce("_found", F.array().cast("array<string>")).alias("notices")))
