"""URL filters by a sort-merge range join of reversed hosts.

A host is written from its last label to its first, with a dot behind each.  A rule for
a host then stands before all of its subdomains, and what it covers is one interval of
keys.  URLs and rules are dealt by ranges of the key and sorted together; a sweep keeps
the stack of rules whose intervals are open.  Rules that were opened before a range
begins are those whose keys are prefixes of its first key: they are found by an equality
join on a few prefixes per range, and opened again there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.llm.common import ASCII_UPPER, take
from samplelake.staging import stage

# Verdict, host and path of the rules of the query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# The verdict where no rule fits.
OTHERWISE = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path, without query and fragment; both empty without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise("")
    rest = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
    host = F.regexp_extract(rest, r"(?s)^[^/]*", 0)
    return F.translate(host, ASCII_UPPER, ASCII_UPPER.lower()), F.substring(rest, F.length(host) + 1, F.length(rest))


def key_of(host: Column) -> Column:
    """Labels from last to first with a dot behind each; the empty host has the key of one empty label."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rules_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judged(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per row with ``page_id, url``.

    The longest fitting rule wins: by the length of host and path together, then of the
    host.  Of rules with equal host and path the smallest verdict counts; rules with a
    null host or path are left out.  A null url, or one without ``://``, has an empty host,
    which only a rule for an empty host fits.  Repeated rows give repeated rows.
    """
    host, path = host_and_path(F.col("url"))
    urls = take(pages, page_id="page_id", url="url").select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("key", key_of(F.col("host")))
    known = take(rules, verdict="verdict", host="host", path="path").filter("host IS NOT NULL AND path IS NOT NULL")
    known = known.withColumn("host", F.translate("host", ASCII_UPPER, ASCII_UPPER.lower()))
    known = known.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    known = known.select(
        F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"),
        "host",
        "path",
        key_of(F.col("host")).alias("key"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    known = stage(known, "rules")
    nothing = F.lit(None).cast("string")
    events = urls.withColumns({"rule": nothing, "verdict": nothing}).unionByName(known)
    # Urls of one host spread by their ids, so a hot host fills as many ranges as it needs.
    spread = events.withColumns({"is_url": F.col("rule").isNull(), "salt": F.xxhash64("page_id", "path")})
    dealt = stage(
        spread.repartitionByRange("key", "is_url", "salt").withColumn("part", F.spark_partition_id()).drop("salt"),
        "ranges",
    )
    first = dealt.groupBy("part").agg(F.min("key").alias("first"))
    labels = F.slice(F.split("first", r"\."), F.lit(1), F.size(F.split("first", r"\.")) - 1)
    prefixes = F.transform(labels, lambda _, i: F.concat(F.array_join(F.slice(labels, F.lit(1), i + 1), "."), F.lit(".")))
    carried = first.select("part", F.explode(prefixes).alias("key")).join(known, "key")
    carried = carried.withColumn("is_url", F.lit(False)).select(dealt.columns)
    swept = (
        dealt.unionByName(carried).repartition("part").sortWithinPartitions("part", "key", "is_url", "rule")
    )
    kind = urls.schema["page_id"].dataType.simpleString()
    return swept.mapInArrow(_sweep(otherwise), f"page_id {kind}, host string, path string, rule string, verdict string")


def _sweep(otherwise: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_ = None, []  # open rules: key, length, host length, path, name, verdict
        for batch in batches:
            part, key, host, path, rule, verdict = (
                batch.column(n).to_pylist() for n in ("part", "key", "host", "path", "rule", "verdict")
            )
            kept, names, verdicts = [], [], []
            for i, here in enumerate(key):
                if part[i] != at:
                    at, open_ = part[i], []
                while open_ and not here.startswith(open_[-1][0]):
                    open_.pop()
                if rule[i] is not None:
                    open_.append((here, len(rule[i]), len(host[i]), path[i], rule[i], verdict[i]))
                    continue
                fits = [r for r in open_ if path[i].startswith(r[3])]
                won = max(fits, key=lambda r: r[1:3], default=None)
                kept.append(i)
                names.append(won[4] if won else None)
                verdicts.append(won[5] if won else otherwise)
            out = batch.take(pa.array(kept, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*[out.column(n) for n in ("page_id", "host", "path")], pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return run


def sql(rules: tuple[tuple[str, str, str], ...] = RULES, otherwise: str = OTHERWISE) -> str:
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return rf"""
WITH rules(verdict, rhost, rpath) AS (VALUES {rows}), rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '(?s)^[^?#]*') ELSE '' END AS r
    FROM pages
), parts AS (
    SELECT page_id, regexp_extract(r, '(?s)^[^/]*') AS raw, substr(r, length(regexp_extract(r, '(?s)^[^/]*')) + 1) AS path FROM rest
), p AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), fits AS (
    SELECT page_id, rhost || rpath AS rule, verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS place
    FROM p JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, '{otherwise}') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)
"""

