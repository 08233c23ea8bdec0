"""License scan by canonical digest: whole texts are normalised, digested and hash-joined to known digests."""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spellings treated as equal (left becomes right), after lower-casing, whole words only.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("acknowledgements", "acknowledgments"), ("analogue", "analog"),
    ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorise", "authorize"),
    ("authorised", "authorized"), ("behaviour", "behavior"), ("centre", "center"), ("favour", "favor"),
    ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("merchantibility", "merchantability"),
    ("organisation", "organization"), ("organise", "organize"), ("programme", "program"), ("recognise", "recognize"),
    ("utilisation", "utilization"), ("wilful", "willful"), ("https", "http"), ("noncommercial", "non commercial"),
)

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
          "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
          "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
          "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
          "PERFORMANCE OF THIS SOFTWARE.")
#: Texts and notices of common licenses.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            'rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to '
            'permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above '
            'copyright notice and this permission notice shall be included in all copies or substantial portions of the '
            'Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
            'LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT '
            'SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF '
            'CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS '
            'IN THE SOFTWARE.'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _AS_IS),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
_MIT, _ISC, _0BSD = (next(t for k, t in reversed(KNOWN) if k == i) for i in ("MIT", "ISC", "0BSD"))
#: Whole license texts kept in ``known_licenses``, with the number of lines that form the title.
TITLED = (
    ("Apache-2.0", 3), ("Artistic-1.0-Perl", 1), ("BSL-1.0", 1), ("CC0-1.0", 2), ("GFDL-1.2", 2), ("GFDL-1.3", 2), ("GPL-1.0", 2),
    ("GPL-2.0", 2), ("GPL-3.0", 2), ("LGPL-2.0", 2), ("LGPL-2.1", 2), ("LGPL-3.0", 2), ("MPL-1.1", 2), ("MPL-2.0", 1),
)
#: Titles that are put before texts that have none of their own.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License",
                     'BSD 2-Clause "Simplified" License', "FreeBSD License", "BSD License", "The BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "BSD License", "The BSD License"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
}
_END = re.compile("^ *END OF TERMS AND CONDITIONS *$", re.M)
#: Most rows of the known table that may be sent to every executor; a larger table is joined by a shuffle.
BROADCAST_ROWS = 100_000
_COPYRIGHT = "^[^a-z0-9]*(copyright|\\(c\\)|©|all rights reserved)"
_OWNER_MARKS = ("copyright", "(c)", "©", "all rights reserved")
#: ASCII other than letters and digits, but for the line break, and common typographic marks.
_MARKS = "\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F‘’“”–—©\u00a0\ufeff"
_VARIANT = " (" + "|".join(a for a, _ in EQUIVALENT) + ") "


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line breaks.

    Lower case; no copyright lines (those that begin, but for punctuation, with "copyright", "(c)", the sign, or "all
    rights reserved"); punctuation as spaces, one between words and none around line breaks; blank lines left out;
    one spelling per word.
    """
    low = F.lower(text)
    marked = F.lit(False)
    for m in _OWNER_MARKS:
        marked = marked | F.contains(low, F.lit(m))
    kept = F.when(marked, F.array_join(F.filter(F.split(low, "\n"), lambda x: ~x.rlike(_COPYRIGHT)), "\n")).otherwise(low)
    flat = F.regexp_replace(F.regexp_replace(kept, f"(?<![{_MARKS}])[{_MARKS}]*+\n[{_MARKS}\n]*+", "\n"), f"[{_MARKS}]+", " ")
    padded = F.concat(F.lit(" "), F.replace(F.replace(F.btrim(flat, F.lit(" \n")), F.lit("\n"), F.lit(" \n ")), F.lit(" "), F.lit("  ")), F.lit(" "))
    spelled = padded
    for a, b in EQUIVALENT:
        spelled = F.replace(spelled, F.lit(f" {a} "), F.lit(f" {b} "))
    trimmed = F.btrim(flat, F.lit(" \n"))
    around = F.concat(F.lit(" "), F.replace(trimmed, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    return F.when(around.rlike(_VARIANT), F.btrim(F.regexp_replace(F.regexp_replace(spelled, " +", " "), " ?\n ?", "\n"))).otherwise(trimmed)


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, one space for punctuation and breaks, one spelling per word."""
    return F.replace(canonical_lines(text), F.lit("\n"), F.lit(" "))


def _digest(c: Column) -> Column:
    return F.when(c != "", F.sha2(c, 256))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text; NULL where nothing is left of it."""
    return _digest(canonical(text))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(license_id, digest) of known texts, one row per digest (the least id where two licenses share a text)."""
    rows = spark.createDataFrame(list(known), T.StructType([T.StructField("license_id", T.StringType()),
                                                            T.StructField("text", T.StringType())]))
    return (rows.select("license_id", digest(F.col("text")).alias("digest")).where("digest is not null")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def _kept(name: str) -> str:
    return pkgutil.get_data(__package__, f"known_licenses/{name}.txt").decode()


def _bsd_texts() -> list[tuple[str, str]]:
    """BSD texts of two and three clauses, numbered or with bullets, naming a holder, an owner or the Regents."""
    three = [_kept("BSD-3-Clause"), _kept("BSD-3-Clause-UC")]
    named = [("BSD-3-Clause", t) for t in three] + [("BSD-2-Clause", re.sub("(?ms)^3\\. Neither.*?\n\n", "\n", three[0]))]
    named += [(i, t.replace("HOLDER OR CONTRIBUTORS", "OWNER OR CONTRIBUTORS")) for i, t in named]
    return named + [(i, re.sub(r"(?m)^ *\d\. ", "* ", t)) for i, t in named]


def whole_texts() -> tuple[tuple[str, str], ...]:
    """(license_id, text) of whole license texts: each with its title, with each ending of it and without, and, where the
    terms have a marked end, also without what follows it and without the mark."""
    found = []
    for license_id, n_title in TITLED:
        text = _kept(license_id)
        end = _END.search(text)
        for body in [text] + ([text[:end.end()], text[:end.start()]] if end else []):
            lines = [x for x in body.split("\n") if x.strip()]
            found += [(license_id, "\n".join(lines[n:])) for n in range(n_title + 1)]
    plain = [("MIT", _MIT), ("ISC", _ISC), ("0BSD", _0BSD), ("Unlicense", _kept("Unlicense")), ("Zlib", _kept("Zlib")), *_bsd_texts()]
    for license_id, text in plain:
        found += [(license_id, text), *[(license_id, f"{title}\n\n{text}") for title in TITLES[license_id]]]
    return tuple(dict.fromkeys(found))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Look up each whole text, and each of its lines as a text of its own, among the known digests.

    Returns one row per input row: ``doc_id, digest, license_id`` (of the whole text, else NULL),
    ``notice_ids`` (sorted ids of lines that are known notices), ``n_notices`` (such lines, repeats included).
    NULL and empty texts, and texts of punctuation or copyright lines only, have no digest and match nothing.
    Repeated rows each keep their row; a NULL id is an id like any other. No known rows: nothing matches. No documents: no rows.
    Other columns are ignored. A long text is one row, canonical in time linear in its length.

    Lines become rows on the map side, meet the known digests in a broadcast hash join (only where the
    known table is proven to have at most BROADCAST_ROWS rows, else a shuffled one that AQE may split),
    and are summed per row before anything is shuffled, so a hot text or line costs no more than others.
    """
    small = known.select("digest", "license_id").limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    table = F.broadcast(known) if small else known
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The whole text's columns come first: beside an explode they would be computed for every line.
    flat = rows.select("doc_id", F.xxhash64("text").alias("text_key"), canonical_lines(F.col("text")).alias("flat"))
    wholes = flat.select("doc_id", _digest(F.replace("flat", F.lit("\n"), F.lit(" "))).alias("whole"), "text_key",
                         F.split("flat", "\n").alias("lines"))
    units = wholes.select("doc_id", "whole", "text_key", F.posexplode_outer("lines").alias("at", "line"))
    lines = units.select("doc_id", "whole", "text_key", "at", _digest(F.col("line")).alias("digest"))
    found = lines.join(table.select("digest", F.col("license_id").alias("notice_id")), "digest", "left")
    per_text = found.groupBy("doc_id", "whole", "text_key").agg(
        F.count_if(F.col("at") == 0).alias("copies"), F.sort_array(F.collect_set("notice_id")).alias("notice_ids"),
        F.count("notice_id").alias("n_found"))
    named = per_text.join(table.select(F.col("digest").alias("whole"), "license_id"), "whole", "left")
    return named.select("doc_id", F.col("whole").alias("digest"), "license_id",
                        F.array_join("notice_ids", ",").alias("notice_ids"),
                        F.expr("n_found div copies").alias("n_notices"),
                        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_")).drop("_")
