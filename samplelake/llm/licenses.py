"""License scans: canonical digests of entire texts, joined with those of known licences.

A unit is a whole document, a paragraph or a line.  Its canonical form has one case, no
punctuation, no copyright lines and one spelling of equivalent words; a unit is a
licence where the digest of its whole canonical form is a known one.  All of it is
built-in expressions and one hash join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.llm.common import take
from samplelake.operators.joins import join_narrow

# Short public licences and notices, by identifier and kind.
KNOWN = (
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "attribution", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "restricted", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-only", "copyleft", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "copyleft", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "permissive", "Released under the ISC License."),
    (
        "ISC",
        "permissive",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "permissive",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
)
# Spellings that count as equal, after case and punctuation are gone.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("honour", "honor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
COPYRIGHT_LINE = r"(?m)^[^\p{L}\n]*?(\(c\)[^\p{L}\n]*)?(copyright\b|all rights reserved)[^\n]*$"
# Every known canonical form has one of these, and no canonical step makes or breaks one.
ANCHOR = "(?i)licen[cs]e|permission"


def canonical(text: Column) -> Column:
    """One case, words only, no copyright lines, one spelling; a null text stays null."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for spelled, usual in SPELLINGS:
        out = F.replace(out, F.lit(f" {spelled} "), F.lit(f" {usual} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_licenses(spark: SparkSession, known: tuple[tuple[str, str, str], ...] = KNOWN) -> DataFrame:
    """``digest, license, kind``, one row per digest: of equal texts the first name counts."""
    named = spark.createDataFrame(list(known), "license string, kind string, text string")
    first = F.min(F.struct("license", "kind")).alias("first")
    return named.groupBy(digest(F.col("text")).alias("digest")).agg(first).select("digest", "first.*")


def units(text: Column) -> Column:
    """The whole text, then its paragraphs and lines, where there are several."""
    lines, paragraphs = F.split(text, "\n"), F.split(text, r"\n[\x20\t]*\n")
    both = F.array_distinct(F.concat(F.array(text), paragraphs, lines))
    return F.filter(both, lambda u: u.rlike(ANCHOR))


def licensed(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Result of the query: ``doc_id, n_matches, licenses, kinds, whole``, one row per document.

    licenses and kinds are sorted, distinct and joined by commas; whole says that the
    entire text is one licence.  Equal units of one text count once.  Null and empty texts
    have none; repeated rows are judged each by itself.
    """
    rows = take(docs, doc_id="doc_id", text="text").withColumn("row", F.monotonically_increasing_id())
    body = F.coalesce(F.col("text"), F.lit(""))
    # A text without an anchor goes along as one unit that no licence has.
    parts = F.when(body.rlike(ANCHOR), F.transform(units(body), lambda u: F.struct(digest(u).alias("digest"), (u == body).alias("whole"))))
    every = rows.select("row", "doc_id", F.explode_outer(parts).alias("unit"))
    every = every.select("row", "doc_id", "unit.whole", F.coalesce("unit.digest", F.lit("none")).alias("digest"))
    found = join_narrow(every, known, ["digest"])
    # Units of a row meet in its task before the shuffle.
    return (
        found.groupBy("row", "doc_id")
        .agg(
            F.count("license").alias("n_matches"),
            F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
            F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"),
            F.coalesce(F.bool_or(F.col("whole") & F.col("license").isNotNull()), F.lit(False)).alias("whole"),
        )
        .drop("row")
    )


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql(known: tuple[tuple[str, str, str], ...] = KNOWN) -> str:
    def form(column: str) -> str:
        out = f"regexp_replace(lower({column}), '{COPYRIGHT_LINE}', '', 'g')"
        out = rf"' ' || regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
        for spelled, usual in SPELLINGS:
            out = f"replace({out}, ' {spelled} ', ' {usual} ')"
        return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"

    rows = ", ".join(f"({_sql_text(a)}, {_sql_text(b)}, {_sql_text(c)})" for a, b, c in known)
    return rf"""
WITH known AS (
    SELECT sha256({form("t")}) AS digest, min((license, kind)) AS first FROM (VALUES {rows}) k(license, kind, t) GROUP BY 1
), named AS (
    SELECT digest, first[1] AS license, first[2] AS kind FROM known
), units AS (
    SELECT DISTINCT doc_id, unnest(list_distinct([t] || regexp_split_to_array(t, '\n[\x20\t]*\n') || string_split(t, chr(10)))) AS u, t
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), found AS (
    SELECT doc_id, license, kind, u = t AS whole FROM units JOIN named ON sha256({form("u")}) = digest
), told AS (
    SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
        string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, bool_or(whole) AS whole
    FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(licenses, '') AS licenses, coalesce(kinds, '') AS kinds,
    coalesce(whole, FALSE) AS whole
FROM documents LEFT JOIN told USING (doc_id)
"""
