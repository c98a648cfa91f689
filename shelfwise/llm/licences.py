"""Licence scan by canonical digests: whole texts, and whole lines, that are a known licence text or notice."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

TEXTS = Path(__file__).parent / "licence_texts"
#: Text files by the identifier that a document of that text alone is given, and the titles it may begin with.
TEXT_FILES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("Apache-2.0", "Apache-2.0", ()),
    ("Apache-2.0.notice", "Apache-2.0", ()),
    ("BSD-2-Clause", "BSD-2-Clause", ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License")),
    ("BSD-3-Clause", "BSD-3-Clause", ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License")),
    ("BSL-1.0", "BSL-1.0", ()),
    ("CC0-1.0", "CC0-1.0", ()),
    ("GPL-2.0", "GPL-2.0-only", ()),
    ("GPL-2.0.notice", "GPL-2.0-or-later", ()),
    ("GPL-3.0", "GPL-3.0-only", ()),
    ("GPL-3.0.notice", "GPL-3.0-or-later", ()),
    ("LGPL-2.0", "LGPL-2.0-only", ()),
    ("LGPL-2.1", "LGPL-2.1-only", ()),
    ("LGPL-2.1.notice", "LGPL-2.1-or-later", ()),
    ("LGPL-3.0", "LGPL-3.0-only", ()),
    ("MPL-1.1", "MPL-1.1", ()),
    ("MPL-2.0", "MPL-2.0", ()),
    ("MPL-2.0.notice", "MPL-2.0", ()),
    ("Unlicense", "Unlicense", ("The Unlicense",)),
    ("Zlib", "Zlib", ("zlib License", "The zlib License")),
)
#: After this line some texts explain how to apply them; both forms are in use.
LAST_LINE = "END OF TERMS AND CONDITIONS"


def _whole_texts() -> list[tuple[str, str]]:
    out = []
    for file, licence, titles in TEXT_FILES:
        text = (TEXTS / f"{file}.txt").read_text(encoding="utf-8")
        forms = [text]
        if LAST_LINE in text:
            terms = text[: text.index(LAST_LINE)]
            forms += [terms, terms + LAST_LINE]
        out += [(licence, form) for form in forms]
        out += [(licence, f"{title}\n{text}") for title in titles]
    return out


#: Public licence texts and the usual one-line notices, by SPDX identifier.
KNOWN_LICENCES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", _ISC),
    ("ISC", "Released under the ISC License."),
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    *_whole_texts(),
)

#: Spellings counted as one, on text already in lower case with single spaces.
SAME_SPELLING: tuple[tuple[str, str], ...] = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("https", "http"),
    ("v", "version"),
)

#: Words after which a line that begins with "copyright" goes on with a sentence of the licence itself.
_IN_SENTENCE = r"(?:holders?|owners?|ownership|notices?|laws?|licen[cs]es?|interests?|permission|treaty|doctrines|statement|resulting|disclaimer|and|or|on|of|if|are)"
COPYRIGHT_LINE = (
    rf"(?m)^[ \t]*(?:copyright\b(?![ \t]*[\r\n])(?![;.)-]|,[ \t]*[a-z]|[ \t]+the library,)(?![ \t\"]+{_IN_SENTENCE}\b)"
    r"|\(c\)(?![ \t]+(?:you must|under patent|the licenses|representations))|©).*$"
    r"|^[ \t]*all rights reserved\.?[ \t]*$"
)


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, no punctuation (hyphens and dots too), single spaces, one spelling."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for odd, usual in SAME_SPELLING:
        out = F.replace(out, F.lit(f" {odd} "), F.lit(f" {usual} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN_LICENCES) -> DataFrame:
    """licence, digest: a table as long as ``known``."""
    table = spark.createDataFrame(list(known), "licence string, licence_text string")
    return table.select("licence", digest(F.col("licence_text")).alias("digest")).distinct()


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, whole_licence, line_licences, n_lines (lines that are a licence).

    The whole text, and each whole line of it, is brought to canonical form and looked up by digest. A null
    text holds no licence; texts and lines without letters and digits have no digest. Repeated rows keep
    their rows. Where two licences share a canonical text, the first by name counts. Line licences are
    distinct, by name. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    known = known_digests(spark) if known is None else known
    # One digest per licence text: the caller's list, a fixed table.
    known = F.broadcast(known.groupBy("digest").agg(F.min("licence").alias("licence")))
    row = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.select("doc_id", "text", row.alias("row"))
    units = texts.select(
        "doc_id",
        "row",
        F.posexplode(
            F.filter(
                F.transform(
                    F.concat(F.array("text"), F.split("text", r"\r\n|\n|\r")),
                    lambda t, i: F.struct((i == 0).alias("whole"), canonical(t).alias("canon")),
                ),
                lambda u: F.length(u["canon"]) > 0,
            )
        ).alias("pos", "unit"),
    ).select("doc_id", "row", "unit.whole", F.sha2("unit.canon", 256).alias("digest"))
    line = F.when(~F.col("whole"), F.col("licence"))
    # Copies of a row find the same hits; the smallest count over whole rows is per row.
    hits = (
        units.join(known, "digest")
        .groupBy("doc_id", "row")
        .agg(
            F.min(F.when(F.col("whole"), F.col("licence"))).alias("whole_licence"),
            F.array_sort(F.collect_set(line)).alias("line_licences"),
            F.count(line).alias("hits"),
        )
    )
    copies = texts.groupBy(F.col("doc_id").alias("copy_id"), F.col("row").alias("copy_row")).agg(
        F.count("*").alias("copies")
    )
    hits = hits.join(copies, F.col("copy_id").eqNullSafe(F.col("doc_id")) & (F.col("copy_row") == F.col("row")))
    hits = hits.select(
        F.col("doc_id").alias("hit_id"), F.col("row").alias("hit_row"), "whole_licence", "line_licences",
        (F.col("hits") / F.col("copies")).cast("long").alias("n_lines"),
    )
    return texts.drop("text").join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row") == F.col("hit_row")), "left"
    ).select(
        "doc_id",
        "whole_licence",
        F.concat_ws(",", "line_licences").alias("line_licences"),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
    )
