"""Licence texts found by the digest of their canonical form, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import license_table
from shelfwise.llm.common import numbered
from shelfwise.session import checked_broadcast

_GRANT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

# SPDX names and the texts or notices that they stand for.
KNOWN: tuple[tuple[str, str], ...] = (
    (
        "MIT",
        """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

"""
        + _GRANT,
    ),
    (
        "ISC",
        """ISC License

Copyright <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
)

#: Spellings that mean the same; the pattern works on lower case without punctuation.
SAME = (
    (r"\b(sub)?licenc(e|ed|es|ing|or|ee)\b", "{1}licens{2}"),
    (r"\bnon (commercial|infringement)\b", "non{1}"),
    (r"\b(version|ver|v) ?([0-9])", "version {2}"),
)


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, without blank lines and copyright lines.

    Lower case; a run of anything but letters, digits and line ends is one space; spellings
    that mean the same are replaced; lines that begin with "copyright" or "c" and a year go.
    """
    plain = F.lower(F.coalesce(text, F.lit("")))
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")
    for pattern, put in SAME:
        plain = F.regexp_replace(plain, pattern, put.replace("{", "$").replace("}", ""))
    lines = F.transform(F.split(plain, "\n"), lambda x: F.trim(x))
    notice = r"^(copyright( |$)|c (copyright|[0-9]{4})( |$))"
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(notice))


def known_texts() -> list[tuple[str, str]]:
    """``KNOWN``, its full texts by other headings, and the common licences."""
    out = list(KNOWN)
    heads = {"MIT": ("", "The MIT License\n", "The MIT License (MIT)\n"), "ISC": ("", "The ISC License\n")}
    for name, text in KNOWN[:2]:
        body = text.split("\n", 1)[1]
        out += [(name, head + body) for head in heads[name]]
    return [*out, *license_table.common()]


def digest_of(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_digests(
    spark: SparkSession, known: Sequence[tuple[str, str]] | DataFrame | None = None
) -> DataFrame:
    """(``license``, ``digest``) of known licence texts, given as pairs or as a table;
    ``known_texts`` without these."""
    if known is None:
        known = known_texts()
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(
        list(known), "license string, text string"
    )
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return (
        texts.select("license", digest_of(whole).alias("digest"))
        .groupBy("digest")
        .agg(F.min("license").alias("license"))
    )


def scan(
    docs: DataFrame, known: Sequence[tuple[str, str]] | DataFrame | None = None
) -> DataFrame:
    """One row per row of ``docs`` with the licence that its text is, and those of its lines.

    ``doc_id``, ``digest`` (of the entire canonical text), ``license`` (null if the digest is not
    known), ``line_licenses`` (sorted, distinct) and ``n_license_lines``: lines that are in
    themselves a known text or notice. A null, empty or blank text has the digest of the
    empty text and no licence. Both look-ups are equality joins on digests; a table of up
    to 100,000 known digests is broadcast, so no line is shuffled.
    """
    rows = numbered(docs, "documents", "doc_id", "text")
    digests = checked_broadcast(known_digests(docs.sparkSession, known))
    lined = rows.select("rid", "doc_id", canonical_lines(F.col("text")).alias("lines"))
    whole = lined.select(
        "rid", "doc_id", digest_of(F.array_join("lines", " ")).alias("digest")
    ).join(digests, "digest", "left")
    lines = (
        lined.select("rid", F.explode("lines").alias("line"))
        .select("rid", digest_of(F.col("line")).alias("digest"))
        .join(digests, "digest")
        .groupBy("rid")
        .agg(
            F.sort_array(F.collect_set("license")).alias("line_licenses"),
            F.count("*").alias("n_license_lines"),
        )
    )
    return whole.join(lines, "rid", "left").select(
        "doc_id",
        "digest",
        "license",
        F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql(table: str = "documents", known: Sequence[tuple[str, str]] = KNOWN) -> str:
    """The same rows in DuckDB's SQL, for documents with no licence beyond ``KNOWN``; lists are compared as their text."""

    def lines(column: str) -> str:
        text = rf"regexp_replace(lower(coalesce({column}, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
        for pattern, put in SAME:
            put = put.replace("{", "\\").replace("}", "")
            text = f"regexp_replace({text}, '{pattern}', '{put}', 'g')"
        split = f"list_transform(string_split({text}, chr(10)), lambda x: trim(x))"
        notice = "^(copyright( |$)|c (copyright|[0-9]{4})( |$))"
        return f"list_filter({split}, lambda x: x <> '' and not regexp_matches(x, '{notice}'))"

    values = ", ".join(f"({_sql_text(a)}, {_sql_text(b)})" for a, b in known)
    return f"""
with known as (
  select sha256(array_to_string({lines("t")}, ' ')) as digest, min(l) as license
  from (values {values}) as v(l, t) group by 1),
docs as (
  select row_number() over () as rid, doc_id, {lines("text")} as lines from {table}),
found as (
  select rid, list_sort(list(distinct license)) as ls, count(*) as n
  from (select rid, unnest(lines) as line from docs) as x
  join known on sha256(x.line) = known.digest group by rid)
select doc_id, sha256(array_to_string(lines, ' ')) as digest, license,
       array_to_string(coalesce(ls, []), ',') as line_licenses,
       cast(coalesce(n, 0) as bigint) as n_license_lines
from docs left join known on known.digest = sha256(array_to_string(lines, ' '))
left join found using (rid)
"""
