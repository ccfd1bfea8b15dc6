"""Spelling variants: words one edit apart, each hung below the commoner one it may be a slip of.

Two words one edit apart, the shorter of ``c`` characters, share their first or their
last ``c // 2`` characters.  Words are dealt to buckets by both; what a bucket shares is
cut off, and the rests are sorted.  For each word the sorted list is scanned once: rows
of the edit matrix, three cells around the diagonal, are kept by depth and reused as far
as a word agrees with the one before it, and where the row shows more than one edit, all
words with that beginning are skipped by a search in the list.  A pair that shares both
halves is found in the bucket of the first one only, so no pair is found twice.

A crowded bucket is dealt anew by the halves of its rests.  Halving ends at rests of at
most two characters, which the alphabet bounds, so a bucket always fits a task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import ASCII_UPPER, crc32_sql, lower_ascii, take
from samplelake.operators.joins import join_narrow
from samplelake.staging import scope, stage

RUN = "[a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
# One run in so many loses a character, as the contract has it.
SLIP = 97
# Words of a bucket above which it is dealt anew; the alphabet's pairs of characters are fewer.
MOST_WORDS = 20_000
LAST = "\U0010ffff"


def runs_of(docs: DataFrame, slip: int | None = SLIP) -> DataFrame:
    """``word`` per run of letters, A to Z in lower case, with the contract's deletions."""
    body = F.coalesce(F.col("text"), F.lit(""))
    # Where all is ASCII, the built-in lower case is the same and faster.
    low = F.when(F.octet_length(body) == F.length(body), F.lower(body)).otherwise(lower_ascii(body))
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    if slip is None:
        return found.select(F.col("run").alias("word"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    marked = found.withColumn("h", F.crc32(name.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return marked.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(runs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of words that are long and frequent enough; counts are summed per task first."""
    counts = runs.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


_KEY = ["c", "head", "tail", "within"]


def _halves(half: Column, rest: Column, head: Column, tail: Column, within: Column) -> Column:
    """The two buckets of a rest: by its first and by its last characters.

    ``within`` is how many first characters of the rests must differ somewhere, -1 for none.
    """
    first = F.struct(
        F.concat(head, F.substring(rest, F.lit(1), half)).alias("head"),
        tail.alias("tail"),
        F.substring(rest, half + 1, F.length(rest)).alias("rest"),
        F.when(within >= 0, F.greatest(within - half, F.lit(0))).otherwise(-1).alias("within"),
    )
    last = F.struct(
        head.alias("head"),
        F.concat(F.substring(rest, F.length(rest) - half + 1, half), tail).alias("tail"),
        F.substring(rest, F.lit(1), F.length(rest) - half).alias("rest"),
        F.when(within >= 0, F.least(within, half)).otherwise(half).alias("within"),
    )
    return F.array(first, last)


def buckets(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = MOST_WORDS) -> DataFrame:
    """``c, head, tail, within, rest, n``: words of ``c`` or ``c + 1`` characters by what they share."""
    size, none = F.length("word"), F.lit("")
    classes = F.explode(F.array_remove(F.array(F.when(size > least_length, size - 1).otherwise(0), size), 0)).alias("c")
    dealt = words.select("word", "n", classes)
    halves = _halves(F.floor(F.col("c") / 2).cast("int"), F.col("word"), none, none, F.lit(-1))
    open_ = dealt.select("c", "n", F.explode(halves).alias("b")).select("c", "n", "b.*")
    done = []
    while True:
        open_ = stage(open_, "buckets")
        half = F.floor((F.col("c") - F.length("head") - F.length("tail")) / 2).cast("int")
        crowded = open_.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > most).filter(half > 0)
        crowded = stage(crowded.select(*_KEY), "crowded")
        if crowded.isEmpty():
            done.append(open_)
            break
        done.append(open_.join(crowded, _KEY, "left_anti"))
        anew = _halves(half, F.col("rest"), F.col("head"), F.col("tail"), F.col("within"))
        # Rests that must differ in none of their characters have no pairs.
        open_ = open_.join(crowded, _KEY, "left_semi").select("c", "n", F.explode(anew).alias("b")).select("c", "n", "b.*")
        open_ = open_.filter("within <> 0")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def shared_lengths(words: list[str]) -> list[int]:
    """How many first characters each word of a sorted list shares with the one before it."""
    return [0, *(len(commonprefix(pair)) for pair in zip(words, words[1:]))]


def one_edit_apart(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places ``i < j`` of words of a sorted list without repeats that are exactly one edit apart."""
    shared, count = shared_lengths(words), len(words)
    # Cells of the rows by depth: one column left of the diagonal, on it, one right of it; 2 stands for more than one.
    depth = max(map(len, words), default=0) + 2
    low, mid, high = [1] * depth, [0] * depth, [1] * depth
    for i in range(count - 1):
        word = words[i]
        end = len(word)
        j = i + 1
        d = shared[j]
        # As far as the next word agrees with this one, a row is 1, 0, 1.
        equal = d
        while j < count:
            other = words[j]
            long = len(other)
            if d <= equal:
                equal = d
                a, b, e = 1, 0, 1
            else:
                a, b, e = low[d], mid[d], high[d]
            alive = True
            while d < long:
                x = other[d]
                # Row d + 1: columns d, d + 1 and d + 2 of the word.
                na = a if 0 < d <= end and word[d - 1] == x else a + 1
                if b + 1 < na:
                    na = b + 1
                nb = 2
                if d < end:
                    nb = b if word[d] == x else b + 1
                    if e + 1 < nb:
                        nb = e + 1
                    if na + 1 < nb:
                        nb = na + 1
                ne = 2
                if d + 1 < end:
                    ne = e if word[d + 1] == x else e + 1
                    if nb + 1 < ne:
                        ne = nb + 1
                if na > 1 and nb > 1 and ne > 1:
                    alive = False
                    break
                d += 1
                low[d] = a = na if na < 2 else 2
                mid[d] = b = nb if nb < 2 else 2
                high[d] = e = ne if ne < 2 else 2
            if alive:
                if (b if long == end else a if long == end + 1 else e if long == end - 1 else 2) == 1:
                    yield i, j
                j += 1
                if j < count:
                    d = shared[j]
                continue
            # The edit is spent, so only characters that match a cell of 1 can go on; all between are skipped.
            going = [word[k] for cell, k in ((a, d - 1), (b, d), (e, d + 1)) if cell == 1 and 0 <= k < end and word[k] > x]
            j = bisect_left(words, other[:d] + (min(going) if going else LAST), j + 1)
            if j < count:
                d = min(d, shared[j])


def near_words(dealt: DataFrame) -> DataFrame:
    """``word, near, near_n`` both ways for every pair of words exactly one edit apart."""

    def pairs(key: tuple, rests: list[str], counts: list[int]) -> Iterator[tuple[str, str, int]]:
        c, head, tail, within = key
        longer = c + 1 - len(head) - len(tail)
        for i, j in one_edit_apart(rests):
            x, y = rests[i], rests[j]
            # Two of the longer words meet in their own class.
            if len(x) == len(y) == longer or (within >= 0 and x[:within] == y[:within]):
                continue
            yield head + x + tail, head + y + tail, counts[j]
            yield head + y + tail, head + x + tail, counts[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(found: list[tuple[str, str, int]]) -> pa.RecordBatch:
            columns = zip(*found) if found else ([], [], [])
            kinds = (pa.string(), pa.string(), pa.int64())
            made = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(made, ["word", "near", "near_n"])

        open_, rests, counts, found = None, [], [], []
        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in _KEY))
            for key, rest, n in zip(keys, batch.column("rest").to_pylist(), batch.column("n").to_pylist()):
                if key != open_:
                    if len(rests) > 1:
                        for pair in pairs(open_, rests, counts):
                            found.append(pair)
                            if len(found) == 10_000:
                                yield told(found)
                                found = []
                    open_, rests, counts = key, [], []
                rests.append(rest)
                counts.append(n)
        if len(rests) > 1:
            found += pairs(open_, rests, counts)
        yield told(found)

    placed = dealt.select(*_KEY, "rest", "n").repartition(*_KEY).sortWithinPartitions(*_KEY, "rest")
    return placed.mapInArrow(run, "word string, near string, near_n long")


def forms(words: DataFrame, near: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n``: the commonest near word, if it is common enough."""
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    found = words.join(best, "word", "left")
    common = -F.col("best.less") >= times * F.col("n")
    return found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"),
        F.when(common, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of words with a form.

    Counts grow along forms, so these end; each round doubles the steps a word has gone.
    """
    hung = stage(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("up")), "hung")
    while True:
        above = hung.select(F.col("word").alias("up"), F.col("up").alias("above"))
        moved = join_narrow(hung, above, ["up"], "left")
        moved = moved.select("word", F.coalesce("above", "up").alias("up"), F.col("above").isNotNull().alias("moved"))
        moved = stage(moved, "hung")
        if moved.filter("moved").isEmpty():
            return hung.withColumnRenamed("up", "root")
        hung = moved.select("word", "up")


def variants(
    runs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    most: int = MOST_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent ``word`` of the runs."""
    with scope() as grouping:
        words = stage(vocabulary(runs, least_length, least_count), "words")
        near = near_words(buckets(words, least_length, most))
        formed = stage(forms(words, near, times), "forms")
        found = formed.join(roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))
        return grouping.keep(found.select("word", "form", "root", "n", "n_near", "form_n"), "variants")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Result of the query, one row per word of at least five characters found at least three times.

    Null and empty texts have no words; a null id counts as empty text in the checksum.
    Repeated rows are counted each; an empty table gives no word.
    """
    return variants(runs_of(take(docs, doc_id="doc_id", text="text")))


# Pairs one edit apart in SQL: equal after the same place is deleted from both, or after one place from one.
SQL = f"""
WITH RECURSIVE runs AS (
    SELECT name, run, count(*) AS n FROM (
        SELECT CAST(doc_id AS VARCHAR) || ':' || run AS name, run FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '{RUN}')) AS run FROM documents)
    ) GROUP BY ALL
), slips AS (
    SELECT run, n, {crc32_sql("name")} AS h FROM runs
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM slips
    ) WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), cut AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT *, unnest(range(0, length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
    UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
), best AS (
    SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= {TIMES} * n THEN best[2] END AS form,
        CASE WHEN -best[1] >= {TIMES} * n THEN -best[1] END AS form_n
    FROM words LEFT JOIN best USING (word)
), way(word, at_, form) AS (
    SELECT word, word, form FROM formed
    UNION ALL
    SELECT y.word, f.word, f.form FROM way y JOIN formed f ON f.word = y.form
)
SELECT word, f.form, y.at_ AS root, n, n_near, form_n FROM formed f JOIN way y USING (word) WHERE y.form IS NULL
"""
