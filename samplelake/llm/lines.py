"""Line dedup: lines that several documents share stay only in the first of these.

Lines are exploded with their places, normalised and hashed; hashes are counted by
distinct document, and the places of lines over the threshold are gathered by document,
which is then put together again from the places left.  What moves is a hash and a place
a line, no text; texts move once, to meet the places dropped from them.  All of it is
built-in expressions, joins and groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import ASCII_UPPER, keyed, lower_ascii
from samplelake.llm.secrets import let
from samplelake.staging import scope, stage

LEAST_DOCUMENTS, LEAST_LENGTH = 2, 10
SPACES = " \t\n\x0b\f\r"
HASH = ["h1", "h2"]
# A hash with more than one of so many lines is looked up in a broadcast table; there are at most so many.
HOT_SHARE = 10_000


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_of(line: Column) -> Column:
    """A line without the six spaces at its ends, A to Z in lower case."""
    bare = F.trim(line, F.lit(SPACES))
    # Where all is ASCII, the built-in lower case is the same and faster.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(lower_ascii(bare))


def _named(docs: DataFrame, text: Column) -> DataFrame:
    """Rows with ``t``, which tells texts of one id apart; rows equal in both have equal answers."""
    return docs.withColumn("t", F.xxhash64(text))


def hashed_lines(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``doc_id, t, at, h1, h2``: place and 128 hash bits of each line with a key long enough."""
    lines = _named(docs, F.col("text")).select("doc_id", "t", F.posexplode(split_lines(F.col("text"))).alias("at", "line"))
    keys = lines.select("doc_id", "t", "at", key_of(F.col("line")).alias("key")).filter(F.length("key") >= least_length)
    return keys.select("doc_id", "t", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def shared_hashes(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``h1, h2, first, n_lines`` of hashes found in enough documents; first is the smallest id.

    Rows of one id are one document, and those without an id are one, behind all others.
    Lines of a document meet in its task, so both sums start before their shuffles.
    """
    per_document = lines.groupBy(*HASH, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    per_hash = per_document.groupBy(*HASH).agg(
        F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first"), F.sum("n").alias("n_lines")
    )
    return per_hash.filter(F.col("documents") >= least_documents).drop("documents")


def dropped_places(lines: DataFrame, shared: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """``doc_id, t, places`` of documents that lose lines.

    The few hashes that hold a large share of the lines are broadcast; their number is
    bounded by the share.  The others are joined by a shuffle in which none weighs much.
    """
    total = shared.agg(F.sum("n_lines")).first()[0] or 0
    is_hot = F.col("n_lines") * hot_share > total
    hot, rest = F.broadcast(shared.filter(is_hot)), shared.filter(~is_hot)
    met = lines.join(hot, HASH).unionByName(lines.join(hot.select(*HASH), HASH, "left_anti").join(rest, HASH))
    lost = met.filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    return lost.groupBy("doc_id", "t").agg(F.collect_set("at").alias("places"))


def marked(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_length: int = LEAST_LENGTH, hot_share: int = HOT_SHARE
) -> DataFrame:
    """Rows ``doc_id, text`` and more, with ``kept``, ``n_lines`` and ``n_dropped`` added."""
    with scope() as finding:
        lines = stage(hashed_lines(docs, least_length), "lines")
        shared = stage(shared_hashes(lines, least_documents), "shared")
        places = finding.keep(dropped_places(lines, shared, hot_share), "places")
    same = F.col("d.t").eqNullSafe(F.col("p.t")) & F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
    both = _named(docs, F.col("text")).alias("d").join(places.alias("p"), same, "left")
    lines_of, lost = split_lines(F.col("d.text")), F.col("p.places")

    def rebuilt(found: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(found) - 1), lost)
        return F.array_join(F.transform(left, lambda i: F.get(found, i)), "\n")

    kept = F.when(lost.isNull(), F.coalesce(F.col("d.text"), F.lit(""))).otherwise(let(lines_of, rebuilt))
    return both.select(
        *[F.col(f"d.{c}") for c in docs.columns],
        kept.alias("kept"),
        F.size(lines_of).cast("long").alias("n_lines"),
        F.coalesce(F.size(lost), F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_shared_lines(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """All documents and columns, the text without the lines that earlier documents hold.

    Order is that of ids, which may have gaps; rows without an id come last, and where no
    holder has an id a line stays in all.  Rows that share an id keep and lose lines
    together.  Null texts stay null, empty ones empty; an empty table gives none.
    """
    named, back = keyed(docs, doc_id="doc_id", text="text")
    at = f"_c{docs.columns.index('text')}"
    found = marked(named, least_documents, least_length)
    return back(found.withColumn(at, F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))))


def line_dedup(docs: DataFrame) -> DataFrame:
    """Result of the query: ``doc_id, n_lines, n_dropped, kept_sha256``, one row per row.

    A null or empty text is one empty line, too short to be shared.  A document that loses
    all its lines has the digest of empty text.  Repeated rows are one document and get
    equal answers, each its own row.
    """
    named, _ = keyed(docs, doc_id="doc_id", text="text")
    found = marked(named.select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
    SELECT doc_id, i, l[i] AS line
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), keys AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        '{ASCII_UPPER}', '{ASCII_UPPER.lower()}') AS key FROM lines
), shared AS (
    SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= {LEAST_LENGTH}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCUMENTS}
), judged AS (
    SELECT doc_id, i, line, first IS NOT NULL AND first <> doc_id AS lost FROM keys LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
