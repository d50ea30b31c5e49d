"""Licence scans in DataFrame functions only: whole texts are looked up by digest in a table of known licences.

A text is made canonical (case, punctuation, white space, copyright lines, equivalent spellings) and its digest is
joined with the digests of the known texts, made canonical by the same columns. Looked up are the whole document,
each of its paragraphs and lines, and the runs of successive paragraphs that have as many words as a known text and
begin and end with the same words. Most texts hold no word that every known licence holds one of, and are passed over
before anything is made canonical; that is a necessary condition and is checked when the table is built.
"""

from __future__ import annotations

import itertools
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.text import let, part, scan_array
from hazardlens.llm.storage import save

# Names of licences as their own texts and common notices spell them.
NAMES = {
    "MIT": ("MIT License", "MIT License (MIT)"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal license"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
PHRASES = (
    "Licensed under {}",
    "Licensed under the {}",
    "Released under {}",
    "Released under the {}",
    "Distributed under {}",
    "Distributed under the {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This work is licensed under a {}",
    "This software is licensed under the {}",
    "This project is licensed under the {}",
)
# Whole texts of short licences.
TEXTS = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
}
# First lines that the texts above and below stand under, or not.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        "The BSD 3-Clause License",
        'BSD 3-Clause "New" or "Revised" License',
        "New BSD License",
        "Modified BSD License",
    ),
}
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: {} Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. {} Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT {} AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ENDORSE = (
    "{} Neither the name of {} nor the names of {} contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
#: Whole texts of long licences, a file each, and where their terms end and advice on using them begins.
LONG_TEXTS = Path(__file__).parent / "license_texts"
ADVICE = ("APPENDIX: How to apply", "How to Apply These Terms to Your New Programs", "Exhibit A - Source Code Form")


def whole_texts() -> list[tuple[str, str]]:
    """(licence, text) pairs of whole licences, in the wordings they are in use, with and without a title."""
    texts = list(TEXTS.items())
    texts.append(("ISC", TEXTS["ISC"].replace("and/or distribute", "and distribute")))
    texts.append(("Apache-2.0", TEXTS["Apache-2.0"].replace("http:", "https:")))
    for marks, one, two in itertools.product(
        (("1.", "2.", "3."), ("-", "-", "-"), ("a.", "b.", "c."), ("i.", "ii.", "iii.")),
        ("HOLDERS", "HOLDER"),
        ("HOLDER", "HOLDERS", "OWNER"),
    ):
        texts.append(("BSD-2-Clause", _BSD.format(*marks[:2], "", one, two)))
        for name, its in itertools.product(
            ("the copyright holder", "the copyright holders", "the copyright owner", "the author", "the authors"), ("its", "any", "their")
        ):
            texts.append(("BSD-3-Clause", _BSD.format(*marks[:2], _ENDORSE.format(marks[2], name, its), one, two)))
    for path in sorted(LONG_TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        texts.append((path.stem, text))
        texts += [(path.stem, text[: text.index(a)]) for a in ADVICE if a in text]
    return texts + [(k, f"{title}\n\n{t}") for k, t in texts for title in TITLES.get(k, ())]


# Spellings that mean the same in a licence, after case and punctuation are gone.
EQUIVALENT = (
    ("(?:licences?|licenses)(?![^ ])", "license"),
    ("licenced(?![^ ])", "licensed"),
    ("sub licen[sc]e(?![^ ])", "sublicense"),
    ("non commercial(?![^ ])", "noncommercial"),
    ("merchantibility(?![^ ])", "merchantability"),
    ("non infringement(?![^ ])", "noninfringement"),
    ("v(?:er(?:sion)?)? ?(?=[0-9])", "version "),
    ("and or(?![^ ])", "or"),
    ("per cent(?![^ ])", "percent"),
    ("https(?![^ ])", "http"),
)
#: Every known text holds one of these.
ANCHORS = r"(?i)licen[sc]e|permission|redistribution|(?:released|distributed)[^\p{L}\p{N}]+under"
# Words after which a line that begins with "copyright" is one of a licence's own.
_TERMS = (
    "notices?|holders?|owners?|laws?|licen[sc]es?|licensors?|statements?|and|or|in|on|of|to|is|are|as|by|the|that|this|acts?|"
    "interests?|related|rights?|disclaimers?|protection|assignments?|claims?|under|treaty|similar|permission|infringement|"
    "material|control|works?|status|for|with|from|which|may|shall|must|will|has|have|information|conditions?|terms?"
)
# A line of its own: copyright and (c), a year, a blank to fill in or a holder; (c) and a year or a holder; all rights reserved.
_COPYRIGHT = (
    r"(?m)^[^\p{L}\p{N}\n(©]*+(?:"
    r"(?:(?i:portions)[^\S\n]++)?(?i:copyright)(?:[^\p{L}\p{N}\n(©<\[{]*+(?:\((?i:c)\)|©|[<\[{]|[12][0-9]{3}(?![0-9])"
    rf"|(?i:by)[^\S\n]++\p{{Lu}})|[^\p{{L}}\p{{N}}\n(©<\[{{]++(?!(?i:{_TERMS})(?![\p{{L}}\p{{N}}]))\p{{Lu}})[^\n]*+$"
    r"|©[^\n]*+$|\((?i:c)\)[^\S\n]*+(?:(?i:copyright)(?![\p{L}\p{N}])|[12][0-9]{3}(?![0-9]))[^\n]*+$"
    r"|\((?i:c)\)[^\S\n]*+(?:\p{Lu}[^\s]*+[^\S\n]*+){1,12}+$"
    r"|(?i:all rights reserved)[^\p{L}\p{N}\n]*+$)"
)
# What lies between paragraphs of a run: at least one line without letters and digits.
_BETWEEN = r"\n[^\p{L}\p{N}]*\n"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one blank between words, one spelling for each word."""
    text = F.regexp_replace(text, _COPYRIGHT, " ")
    text = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    for pattern, spelling in EQUIVALENT:
        text = F.regexp_replace(text, rf"(?<![^ ])(?:{pattern})", spelling)
    return F.trim(F.regexp_replace(text, " +", " "))


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license, digest`` of each known text, its ``first`` and ``last`` word and number ``n`` of words.

    A parameter's worth of rows. ``texts``: (licence, text) pairs.
    """
    if texts is None:
        texts = [(k, p.format(n)) for k, names in NAMES.items() for n in names for p in PHRASES]
        texts += [(k, f"SPDX-License-Identifier: {k}") for k in NAMES]
        texts += whole_texts()
    rows = spark.createDataFrame(texts, "license string, text string")
    missed = rows.where(~F.col("text").rlike(ANCHORS)).count()
    if missed:
        raise ValueError(f"{missed} known texts hold none of the words that {ANCHORS!r} asks for")
    known = rows.select("license", canonical(F.col("text")).alias("text")).dropDuplicates(["text"])
    known = known.select(
        "license",
        F.sha2("text", 256).alias("digest"),
        F.substring_index("text", " ", 1).alias("first"),
        F.substring_index("text", " ", -1).alias("last"),
        F.size(F.split("text", " ")).alias("n"),
    )
    return spark.createDataFrame(known.collect(), known.schema)


def _runs(text: Column, shapes: Column) -> Column:
    """Digests of the runs of successive paragraphs that have a shape: first word, last word and number of words.

    Linear in the paragraphs for each shape, whatever they hold.
    """
    paragraphs = F.filter(F.transform(F.split(text, _BETWEEN), canonical), lambda p: p != "")

    def placed(x: Column) -> Column:
        sizes = F.transform(x, lambda p: F.size(F.split(p, " ")))
        at = scan_array(sizes, F.lit(0), lambda at, n: at + n, lambda at, _: at, "int")
        return F.struct(
            F.split(F.array_join(x, " "), " ").alias("words"),
            F.zip_with(
                F.arrays_zip(at.alias("start"), sizes.alias("size")),
                x,
                lambda a, p: F.struct(
                    a["start"].alias("start"),
                    (a["start"] + a["size"]).alias("end"),
                    F.substring_index(p, " ", 1).alias("first"),
                    F.substring_index(p, " ", -1).alias("last"),
                ),
            ).alias("places"),
        )

    def ends(places: Column, shape: Column) -> Column:
        return F.array_intersect(
            F.transform(F.filter(places, lambda p: p["first"] == shape["first"]), lambda p: p["start"] + shape["n"]),
            F.transform(F.filter(places, lambda p: p["last"] == shape["last"]), lambda p: p["end"]),
        )

    def found(x: Column) -> Column:
        possible = F.filter(
            shapes,
            lambda s: F.array_contains(x["places"]["first"], s["first"]) & F.array_contains(x["places"]["last"], s["last"]),
        )
        return F.flatten(
            F.transform(
                possible,
                lambda s: F.transform(
                    ends(x["places"], s),
                    lambda e: F.sha2(F.array_join(part(x["words"], e - s["n"] + 1, e), " "), 256),
                ),
            )
        )

    return let(paragraphs, lambda x: let(placed(x), found))


def scan(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, whole_license, n_license_units, licenses`` per row.

    ``whole_license`` is the licence that the whole text is, else null. ``licenses`` lists, sorted and once each, the
    licences that the text, a run of its paragraphs (between blank lines) or one of its lines is; ``n_license_units``
    counts the different canonical texts among those. ``known`` is a table as ``known_licenses`` makes it. Null and empty texts are no licence. Rows that repeat an id, or
    have none, are scanned as rows of their own. An empty table gives no rows. Other columns are not looked at.

    The table of digests that is written in between has a row per document, nearly all of them without digests.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    shapes = sorted(tuple(r) for r in known.select("first", "last", "n").distinct().collect())
    shapes = F.array(
        *[F.struct(F.lit(a).alias("first"), F.lit(b).alias("last"), F.lit(n).alias("n")) for a, b, n in shapes]
    )
    text = F.col("text")

    def unit(whole: bool):
        return lambda u: F.struct(F.sha2(canonical(u), 256).alias("digest"), F.lit(whole).alias("whole"))

    def parts(cut: str) -> Column:
        return F.transform(F.filter(F.split(text, cut), lambda u: u.rlike(ANCHORS)), unit(False))

    units = F.when(
        text.rlike(ANCHORS),
        F.array_distinct(
            F.concat(
                F.transform(F.array(text), unit(True)),
                parts(r"\n\s*\n"),
                parts("\n"),
                F.transform(_runs(text, shapes), lambda d: F.struct(d.alias("digest"), F.lit(False).alias("whole"))),
            )
        ),
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = save(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", units.alias("units")), "licenses")
    met = rows.select("row", F.explode("units").alias("unit")).select("row", "unit.digest", "unit.whole")
    found = (
        met.join(known.select("license", "digest"), "digest")
        .groupBy("row")
        .agg(
            F.max(F.when(F.col("whole"), F.col("license"))).alias("whole_license"),
            F.countDistinct("digest").alias("n"),
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("found"),
        )
    )
    return rows.join(found, "row", "left").select(
        "doc_id",
        "whole_license",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_license_units"),
        F.coalesce("found", F.lit("")).alias("licenses"),
    )
