"""Quality rules: a table of thresholds compiled into one projection.

Counts of a whole text, ratios of them, and bounds on the ratios; everything is a
built-in expression of the text alone, so documents never shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import take
from samplelake.llm.secrets import let

# Fixed values of the base rules.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3

STOP_WORDS = (
    "the be to of and that have with in is it for on was as at by this from or are an "
    "der die das und ist von mit zu den des ein eine nicht auf im sich als für "
    "le la les de des et est un une que qui dans pour pas sur avec au ce il "
    "el los las del y en por con una es lo se no al como su para más"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts that must lie within bounds; no denominator passes."""

    name: str
    above: str
    below: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("symbols", "n_symbols", "n_words", most=0.5),
    Rule("stop_words", "n_stop_words", "n_words", least=0.01),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3),
)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
    "n_bullet_lines", "n_ellipsis_lines",
)


def words(text: Column) -> Column:
    """Runs of other characters than the six spaces; one character to split at is Java's fast way."""
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def repeated_words(found: Column) -> Column:
    """Words inside windows that occur twice or more.

    Equal windows have equal hashes, so without equal hashes there is nothing to do.
    Where there are some, windows are sorted with their places and compared with their
    neighbours, which is exact and nearly linear.
    """
    last = F.size(found) - WINDOW + 1

    def windows(of) -> Column:
        every = F.transform(found, lambda w, i: of(w, *[F.get(found, i + k) for k in range(1, WINDOW)]))
        return F.slice(every, F.lit(1), F.greatest(last, F.lit(0)))

    def neighbours(s: Column) -> Column:
        same = F.filter(s, lambda x: F.lit(True))
        marked = F.transform(
            same,
            lambda x, k: F.when(
                F.coalesce(F.get(s, k - 1)["w"] == x["w"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["w"] == x["w"], F.lit(False)),
                F.sequence(x["i"], x["i"] + WINDOW - 1),
            ).otherwise(F.array().cast("array<int>")),
        )
        return F.size(F.array_distinct(F.flatten(marked)))

    hashes = windows(lambda *w: F.xxhash64(*w))
    texts = windows(lambda *w: F.concat_ws(" ", *w))
    placed = F.sort_array(F.transform(texts, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    again = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when((last > 1) & again, let(placed, neighbours)).otherwise(0)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of the base and the method, all long; a null text has none of anything."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn("_words", words(body)).withColumn(
        "_lines", F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    )
    made = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate(body, SPACES, "")),
        "n_symbols": F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_lines": F.size("_lines"),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))),
        "n_ellipsis_lines": F.size(
            F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))
        ),
    }
    return docs.withColumns({n: c.cast("long") for n, c in made.items()}).drop("_words", "_lines")


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule table as one condition over the counts."""
    out = F.lit(True)
    for rule in rules:
        ratio = F.col(rule.above) / F.when(F.col(rule.below) > 0, F.col(rule.below))
        if rule.least is not None:
            out = out & F.coalesce(ratio >= rule.least, F.lit(True))
        if rule.most is not None:
            out = out & F.coalesce(ratio <= rule.most, F.lit(True))
    return out


def judged(docs: DataFrame) -> DataFrame:
    """Result of the query, one row per document; repeated rows get equal answers."""
    found = counts(take(docs, doc_id="doc_id", text="text")).drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passes())


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    bounds = [
        f"coalesce(CAST({r.above} AS DOUBLE) / nullif({r.below}, 0) {sign} {bound}, TRUE)"
        for r in rules
        for sign, bound in ((">=", r.least), ("<=", r.most))
        if bound is not None
    ]
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS x
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1
), places AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY doc_id
), c AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
        CAST(len(list_filter(l, lambda x: substr(ltrim(x, ' '), 1, 1) IN ('-', '*', '•'))) AS BIGINT) AS n_bullet_lines,
        CAST(len(list_filter(l, lambda x: suffix(rtrim(x, ' '), '...') OR suffix(rtrim(x, ' '), '…'))) AS BIGINT) AS n_ellipsis_lines
    FROM d LEFT JOIN places USING (doc_id)
), b AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM c
)
SELECT *, NOT base_failed AND {" AND ".join(bounds)} AS kept FROM b
"""
