"""Secret scans: fixed patterns, and character Markov models compared by likelihood ratio.

Three patterns find labelled secrets.  Their values are the labelled samples of random
strings; every other long token is a sample of ordinary identifiers.  Two Markov models
of character pairs are counted over all documents, each a table no larger than the
alphabet squared.  A token is a secret where the log of the likelihood ratio of the two
is high, in sum and per character.  All of it is built-in expressions: places in a text
come from the lengths of matches and of what stands between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import keyed, take

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
# Runs are maximal, so a least length inside the pattern drops just the short ones.
HEX = "[0-9a-f]{16,}"
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
# Log likelihood ratio (natural) a token needs, in sum and on average per character.
LEAST_RATIO, LEAST_MEAN_RATIO = 14.0, 0.5
# Weight of the single characters' shares in the pairs' shares, in counts.
LEAN = 1000.0
KINDS = ("assign", "access", "hex", "markov")
PLACEHOLDER = "<secret>"

_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also inside lambdas of ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def running_sums(steps: Column) -> Column:
    """Inclusive running sums of an int array that is not empty, by blocks: nearly linear."""

    def from_blocks(s: Column, sums: Column) -> Column:
        before = F.transform(sums, lambda _, i: _sum(F.slice(sums, F.lit(1), i)))
        return let(
            before,
            lambda b: F.transform(
                s,
                lambda _, i: F.get(b, F.floor(i / _BLOCK).cast("int"))
                + _sum(F.slice(s, i - i % _BLOCK + 1, i % _BLOCK + 1)),
            ),
        )

    def whole(s: Column) -> Column:
        begins = F.sequence(F.lit(0), F.size(s) - 1, F.lit(_BLOCK))
        return let(F.transform(begins, lambda b: _sum(F.slice(s, b + 1, F.lit(_BLOCK)))), lambda k: from_blocks(s, k))

    return let(steps, whole)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def between(text: Column, pattern: str) -> Column:
    """What stands before, between and behind the matches: one piece more than matches."""
    return F.split(text, pattern, -1)


def starts(gaps: Column, found: Column) -> Column:
    """Code point at which each match starts."""
    steps = F.zip_with(gaps, F.concat(F.array(F.lit("")), found), lambda g, m: F.length(g) + F.length(m))
    return F.slice(running_sums(steps), F.lit(1), F.size(found))


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, keep: Callable[[], Column]) -> Column:
    """Spans of the matches for which ``keep()``, an array of booleans, has true."""
    found = F.arrays_zip(
        starts(between(text, pattern), matches(text, pattern)).alias("start"),
        matches(text, pattern).alias("match"),
        keep().alias("keep"),
    )
    spans = F.transform(
        F.filter(found, lambda x: x["keep"]),
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["match"])).alias("end")
        ),
    ).cast(_SPANS)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _long_enough(text: Column, pattern: str, group: int, least: int) -> Callable[[], Column]:
    return lambda: F.transform(matches(text, pattern, group), lambda x: F.length(x) >= least)


def base_spans(text: Column) -> Column:
    """Spans ``start, kind, end`` of the three patterns, by start and then by kind."""
    return F.sort_array(
        F.concat(
            _spans(text, ASSIGN, 0, _long_enough(text, ASSIGN, 2, LEAST_ASSIGN)),
            _spans(text, ACCESS, 1, _long_enough(text, ACCESS, 0, LEAST_ACCESS)),
            _spans(text, HEX, 2, _long_enough(text, HEX, 0, 16)),
        )
    )


def _values(text: Column) -> Column:
    """What the patterns hold to be secret: values of assignments, access keys and hex runs."""
    none = F.array().cast("array<string>")
    kept = [(ASSIGN, 2, LEAST_ASSIGN), (ACCESS, 0, LEAST_ACCESS), (HEX, 0, 16)]
    return F.concat(
        *[
            F.when(text.rlike(p), F.filter(matches(text, p, g), lambda x: F.length(x) >= n)).otherwise(none)
            for p, g, n in kept
        ]
    )


def _letters(token: Column) -> Column:
    """Places in the alphabet, 0 for the start; characters outside it are left out."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.concat(F.array(F.lit(0)), F.filter(places, lambda i: i > 0))


def train(docs: DataFrame, text: str = "text") -> list[float]:
    """Log ratios of all character pairs, place ``before * (alphabet + 1) + after``, over all rows.

    Pairs are counted in Spark and summed per task before the shuffle; no more rows than
    twice the alphabet squared come to the driver.  A pair's share leans on the share of
    its second character, which leans on an even one, so without samples all ratios are zero.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    tokens = F.when(body.rlike(TOKEN), matches(body, TOKEN)).otherwise(F.array().cast("array<string>"))
    samples = docs.select(_values(body).alias("secret"), tokens.alias("token")).filter(
        (F.size("secret") > 0) | (F.size("token") > 0)
    )
    ordinary = F.filter("token", lambda t: ~F.exists("secret", lambda s: F.contains(t, s)))
    labelled = F.concat(
        F.transform("secret", lambda t: F.struct(F.lit(1).alias("random"), t.alias("token"))),
        F.transform(ordinary, lambda t: F.struct(F.lit(0).alias("random"), t.alias("token"))),
    )
    width = len(ALPHABET) + 1
    letters = samples.select(F.explode(labelled).alias("s")).select(
        F.col("s.random").alias("random"), _letters(F.col("s.token")).alias("c")
    )
    pairs = F.zip_with(
        F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: a * width + b
    )
    counts = letters.select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count().collect()
    seen = {(r["random"], r["pair"]): r["count"] for r in counts}

    def log_shares(kind: int) -> list[float]:
        table = [[seen.get((kind, a * width + b), 0) for b in range(width)] for a in range(width)]
        single = [sum(row[b] for row in table) + 1 for b in range(1, width)]
        share = [0.0, *[n / sum(single) for n in single]]
        return [
            math.log((row[b] + LEAN * share[b]) / (sum(row) + LEAN)) if b else 0.0 for row in table for b in range(width)
        ]

    return [a - b for a, b in zip(log_shares(1), log_shares(0))]


def ratio(token: Column, model: list[float]) -> Column:
    """Log likelihood ratio of random over ordinary for a token."""
    width = len(ALPHABET) + 1
    # One literal, which the optimizer folds.
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    zero = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        F.slice(_letters(token), F.lit(2), F.length(token)),
        zero,
        lambda s, c: F.struct(
            c.alias("before"), (s["sum"] + F.get(table, s["before"] * width + c)).alias("sum")
        ),
        lambda s: s["sum"],
    )


def is_random(token: Column, model: list[float]) -> Column:
    return let(ratio(token, model), lambda r: (r >= LEAST_RATIO) & (r >= LEAST_MEAN_RATIO * F.length(token)))


def markov_spans(text: Column, model: list[float], base: Column) -> Column:
    """Spans of tokens the models hold to be random, without those a pattern has whole at that place."""
    spans = _spans(text, TOKEN, 3, lambda: F.transform(matches(text, TOKEN), lambda t: is_random(t, model)))

    def elsewhere(b: Column, k: Column) -> Column:
        return F.filter(
            spans,
            lambda s: ~(
                F.exists(b, lambda x: (x["start"] <= s["start"]) & (s["end"] <= x["end"]))
                & F.array_contains(k, F.substring(text, s["start"] + 1, s["end"] - s["start"]))
            ),
        )

    return let(base, lambda b: let(_values(text), lambda k: elsewhere(b, k)))


def scan(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """Add ``base`` and ``added``: spans ``start, kind, end`` in code points, end exclusive.

    A null text is empty and has none.  Each row is judged by itself.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn("base", base_spans(body))
    return found.withColumn("added", markov_spans(body, model, F.col("base")))


def _told(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """Result of the query, one row per document; nothing found is empty text."""
    docs = take(docs, doc_id="doc_id", text="text")
    found = scan(docs, train(docs)).select("doc_id", "base", "added")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *map(count, range(3)),
        F.size("added").cast("long").alias("n_markov"),
        F.sha2(_told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _told(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def _rebuilt(text: Column, pattern: str, drop: Callable[[], Column]) -> Column:
    """The text with a placeholder for each match for which ``drop()`` has true."""
    kept = F.zip_with(matches(text, pattern), drop(), lambda m, d: F.when(d, F.lit(PLACEHOLDER)).otherwise(m))
    pieces = F.zip_with(F.concat(F.array(F.lit("")), kept), between(text, pattern), lambda m, g: F.concat(m, g))
    return F.when(text.rlike(pattern), F.array_join(pieces, "")).otherwise(text)


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents, all rows and columns, with a placeholder in place of each secret.

    The length column, where there is one, is brought up to date for changed texts.
    """
    named, back = keyed(docs, text=text)
    model = train(named)
    place = f"_c{docs.columns.index(text)}"
    out = named.withColumn("before", F.col("text"))
    for pattern, drop in (
        (ASSIGN, _long_enough(F.col("text"), ASSIGN, 2, LEAST_ASSIGN)),
        (ACCESS, _long_enough(F.col("text"), ACCESS, 0, LEAST_ACCESS)),
        (HEX, _long_enough(F.col("text"), HEX, 0, 16)),
        (TOKEN, lambda: F.transform(matches(F.col("text"), TOKEN), lambda t: is_random(t, model))),
    ):
        out = out.withColumn("text", _rebuilt(F.col("text"), pattern, drop))
    changed = {place: F.col("text")}
    if length in docs.columns:
        at = docs.columns.index(length)
        kind = docs.schema[at].dataType
        changed[f"_c{at}"] = F.when(F.col("text") != F.col("before"), F.length("text").cast(kind)).otherwise(F.col(f"_c{at}"))
    return back(out.withColumns(changed))


def sql() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def matched(kind: int, pattern: str, group: int) -> str:
        p = quoted(pattern)
        return f"""SELECT doc_id, {kind} AS kind, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS g,
        string_split_regex(t, {p}) AS gaps FROM d WHERE regexp_matches(t, {p})"""

    size = len(ALPHABET)
    names = "['" + "', '".join(KINDS) + "'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS (
    {matched(0, ASSIGN, 2)} UNION ALL {matched(1, ACCESS, 0)} UNION ALL {matched(2, HEX, 0)} UNION ALL {matched(3, TOKEN, 0)}
), places AS (
    SELECT doc_id, kind, m[i] AS m, g[i] AS g, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)
), base AS (
    SELECT doc_id, kind, start, start + length(m) AS stop, g FROM places
    WHERE kind < 3 AND length(g) >= [{LEAST_ASSIGN}, {LEAST_ACCESS}, 16][kind + 1]
), tokens AS (
    SELECT doc_id, start, m FROM places WHERE kind = 3
), samples AS (
    SELECT 1 AS random, g AS s FROM base
    UNION ALL SELECT 0, m FROM tokens t WHERE NOT EXISTS (FROM base b WHERE b.doc_id = t.doc_id AND contains(t.m, b.g))
), letters AS (
    SELECT random, '^' || regexp_replace(s, '[^A-Za-z0-9+/_=-]', '', 'g') AS s FROM samples
), pairs AS (
    SELECT random, a, b, count(*) AS n
    FROM (SELECT random, s[i] AS a, s[i + 1] AS b FROM (SELECT *, unnest(range(1, length(s))) AS i FROM letters)) GROUP BY ALL
), every AS (
    SELECT random, a, b, s FROM (VALUES (0), (1)) r(random),
        (SELECT DISTINCT s[i] AS a, s[i + 1] AS b, s[i : i + 1] AS s FROM
            (SELECT '^' || m AS s, unnest(range(1, length(m) + 1)) AS i FROM tokens))
), share AS (
    SELECT random, b, (1 + coalesce(n, 0)) / ({size} + coalesce(total, 0)) AS share
    FROM (SELECT DISTINCT random, b FROM every) LEFT JOIN (SELECT random, b, sum(n) AS n FROM pairs GROUP BY ALL) USING (random, b)
        LEFT JOIN (SELECT random, sum(n) AS total FROM pairs GROUP BY ALL) USING (random)
), logs AS (
    SELECT random, a, b, ln((coalesce(n, 0) + {LEAN} * share) / (coalesce(n_a, 0) + {LEAN})) AS l
    FROM every JOIN share USING (random, b) LEFT JOIN pairs USING (random, a, b)
        LEFT JOIN (SELECT random, a, sum(n) AS n_a FROM pairs GROUP BY ALL) USING (random, a)
), ratios AS (
    SELECT a, b, sum(CASE WHEN random = 1 THEN l ELSE -l END) AS r FROM logs GROUP BY a, b
), judged AS (
    SELECT doc_id, start, m, sum(r) AS r
    FROM (SELECT doc_id, start, m, s[i] AS a, s[i + 1] AS b FROM
            (SELECT *, '^' || m AS s, unnest(range(1, length(m) + 1)) AS i FROM tokens)) JOIN ratios USING (a, b)
    GROUP BY doc_id, start, m
), added AS (
    SELECT doc_id, 3 AS kind, start, start + length(m) AS stop FROM judged j
    WHERE r >= {LEAST_RATIO} AND r >= {LEAST_MEAN_RATIO} * length(m)
        AND NOT (EXISTS (FROM base b WHERE b.doc_id = j.doc_id AND b.start <= j.start AND j.start + length(j.m) <= b.stop)
            AND EXISTS (FROM base b WHERE b.doc_id = j.doc_id AND b.g = j.m))
), spans AS (
    SELECT doc_id, kind, start, stop FROM base UNION ALL SELECT * FROM added
), told AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        count(*) FILTER (kind = 3) AS n_markov, string_agg({names}) FILTER (kind < 3) AS base, string_agg({names}) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    coalesce(n_markov, 0) AS n_markov, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""
