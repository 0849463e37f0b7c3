"""Licence scan by canonical digests.

A text is brought to a canonical form (ASCII lower case, copyright lines dropped, punctuation and white space to single
spaces, equivalent spellings to one) and its digest is hash-joined to the digests of known licences. Entire units are
looked up: the whole document, its paragraphs (between blank lines) and its lines. Null and empty texts hold no licence.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A line that begins with a copyright mark (after other characters than letters).
_COPYRIGHT = "(?m)^[^a-z\\n]*(?:copyright|\\(c\\)|©)[^\\n]*$"

#: Letters and groups that equivalent spellings differ in, each with its common form.
SPELLINGS = (
    ("ou", "o"), ("ll", "l"), ("ogue ", "og "), ("gement", "gment"), ("mme ", "m "), ("tre ", "ter "), ("artef", "artif"),
    ("whilst ", "while "), ("non sommersial", "nonsommersial"), ("per sent ", "persent "), ("sopyright owner", "sopyright holder"),
)

#: Known licence notices and short licence texts.
KNOWN = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "MPL-2.0": ("Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "ISC": (
        "SPDX-License-Identifier: ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
}


#: Whole licence texts, one file each, and the words from which a paragraph of one is known by itself.
TEXTS, PARAGRAPH_WORDS = Path(__file__).with_name("licence_texts"), 20


def _plain(text: str) -> str:
    """``canonical`` of a constant."""
    lower = text.translate(str.maketrans(_UPPER, _LOWER))
    form = f" {re.sub('[^a-z0-9]+', ' ', re.sub(_COPYRIGHT, '', lower)).strip(' ')} ".translate(str.maketrans("cz", "ss"))
    for variant, common in SPELLINGS:
        form = form.replace(variant, common)
    return form.strip(" ")


def _with_texts(known: dict[str, tuple[str, ...]]) -> dict[str, tuple[str, ...]]:
    """``known`` with the texts of the files and with their paragraphs, but for those that stand in several licences."""
    whole = {f.stem: f.read_text(encoding="utf-8").strip() for f in sorted(TEXTS.glob("*.txt"))}
    mit = known["MIT"][-1].splitlines()
    whole["MIT"] = "\n\n".join(["\n".join(mit[:4]), mit[4], "\n".join(mit[5:])])
    parts = {name: re.split("\n[ \t]*\n", text) for name, text in whole.items()}
    parts["MIT"] = parts["MIT"][:1]  # the others also stand in other licences of its family
    holders: dict[str, set[str]] = {}
    for name, texts in parts.items():
        for text in texts:
            holders.setdefault(_plain(text), set()).add(name)
    seen = {_plain(text) for texts in known.values() for text in texts}
    out = {}
    for name in [*known, *(n for n in whole if n not in known)]:
        own = [whole[name]] if name in whole else []
        own += [t for t in parts.get(name, []) if len(_plain(t).split()) >= PARAGRAPH_WORDS and len(holders[_plain(t)]) == 1]
        added = []
        for text in own:
            if _plain(text) not in seen:
                seen.add(_plain(text))
                added.append(text)
        out[name] = (*added, *known.get(name, ()))
    return out


KNOWN = _with_texts(KNOWN)


def canonical(text) -> F.Column:
    lower = F.translate(text, _UPPER, _LOWER)
    words = F.regexp_replace(F.regexp_replace(lower, _COPYRIGHT, ""), "[^a-z0-9]+", " ")
    # A blank at either end makes the endings of SPELLINGS apply to the last word as well.
    form = F.translate(F.concat(F.lit(" "), F.trim(words), F.lit(" ")), "cz", "ss")
    for variant, common in SPELLINGS:
        form = F.replace(form, F.lit(variant), F.lit(common))
    return F.trim(form)


def known_digests(spark: SparkSession, known: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``(digest, licence)`` of the known texts."""
    rows = [F.struct(F.lit(name).alias("licence"), F.lit(text).alias("text")) for name, texts in (known or KNOWN).items() for text in texts]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    return table.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence").distinct()


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``licences`` (sorted names found) and ``entire`` (name if the whole text is a licence).

    ``known`` is joined without a hint: Spark broadcasts it where its size allows.
    """
    units = F.array_distinct(F.concat(F.array(text), F.split(text, "\n[ \\t]*\n"), F.split(text, "\n")))
    rows = docs.select(F.col(id).alias("id"), F.monotonically_increasing_id().alias("row_id"), units.alias("units"))
    rows = rows.select("id", "row_id", F.posexplode_outer("units").alias("at", "unit"))
    rows = rows.select("id", "row_id", F.coalesce("at", F.lit(0)).alias("at"), F.sha2(canonical(F.col("unit")), 256).alias("digest"))
    found = rows.join(known, "digest", "left").where("at = 0 or licence is not null")
    found = found.groupBy("row_id", "id").agg(
        F.array_sort(F.collect_set("licence")).alias("licences"), F.min(F.when(F.col("at") == 0, F.col("licence"))).alias("entire")
    )
    return found.select(F.col("id").alias(id), "licences", "entire")


def query(documents: DataFrame) -> DataFrame:
    known = F.broadcast(known_digests(documents.sparkSession))  # a fixed table of a few dozen rows
    found = scan(documents.select("doc_id", "text"), known)
    return found.select(
        "doc_id", F.size("licences").cast("long").alias("n_licences"), F.array_join("licences", ",").alias("licences"), F.col("entire").isNotNull().alias("entire")
    )


def _sql_canonical(column: str) -> str:
    lower = f"translate({column}, '{_UPPER}', '{_LOWER}')"
    words = f"regexp_replace(regexp_replace({lower}, '{_COPYRIGHT}', '', 'g'), '[^a-z0-9]+', ' ', 'g')"
    form = f"translate(' ' || trim({words}, ' ') || ' ', 'cz', 'ss')"
    for variant, common in SPELLINGS:
        form = f"replace({form}, '{variant}', '{common}')"
    return f"sha256(trim({form}, ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_VALUES = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, texts in KNOWN.items() for text in texts)

#: DuckDB counterpart of ``query``.
SQL = f"""
WITH k AS (SELECT DISTINCT licence, {_sql_canonical("t")} AS digest FROM (VALUES {_VALUES}) v(licence, t)),
u AS (
  SELECT doc_id, text AS t, true AS whole FROM documents
  UNION ALL SELECT doc_id, unnest(string_split_regex(text, '\\n[ \\t]*\\n')), false FROM documents
  UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))), false FROM documents),
m AS (SELECT doc_id, whole, licence FROM (SELECT doc_id, whole, {_sql_canonical("t")} AS digest FROM u) JOIN k USING (digest)),
g AS (
  SELECT doc_id, count(DISTINCT licence) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names, bool_or(whole) AS entire
  FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licences, coalesce(names, '') AS licences, coalesce(entire, false) AS entire
FROM documents LEFT JOIN g USING (doc_id)
"""
