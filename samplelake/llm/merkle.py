"""Merkle manifest of a dataset: a tree of digests per source and one over the sources.

Every three consecutive nodes become the digest of their joined hex text.  A parent
keeps a copy of its hash state from before each child; to fold a changed child, the
state of its place is resumed with the replacement and the siblings to its right, and
what stands to its left is never hashed again.

Leaves are numbered in order of source and id by a range partition.  A task takes a
block of consecutive nodes with all levels of the tree below the block's top, so a
source of any size is shared by many tasks, and each round over the tops leaves one node
of a block.  On the way back a block meets one row: the siblings of its top on each
level above, from which it makes the states of these levels once for all its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import crc32_sql, take
from samplelake.operators.joins import join_narrow
from samplelake.operators.numbering import number_rows
from samplelake.staging import scope, stage

ARITY = 3
# Levels of a tree that one task holds, and so the most nodes of a block.
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree string, at long, n long, digest binary"
_PATHS = "tree string, at long, top binary, left array<binary>, right array<binary>"
_PROOFS = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (column.split(" ") for column in ddl.split(", "))])



def field(value: Column) -> Column:
    """``-`` for null, else the bytes of the value as text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Binary digest of a row's fields."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def tampered_leaf(doc_id: Column, *values: Column) -> Column:
    """The leaf with the line ends of its last field deleted, where 2 divides the id's checksum; else null.

    A null id counts as empty text.
    """
    text = values[-1]
    chosen = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 2 == 0
    changed = leaf_of(*values[:-1], F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(chosen & F.contains(text, F.lit("\n")), changed)


class Block:
    """Consecutive nodes and all levels made of them in one task."""

    def __init__(self, nodes: list[bytes], levels: int | None):
        """``levels`` are made in any case, or, without a number, until one node is left."""
        self.runs: list[list[list[bytes]]] = []
        self.states: list[list[list]] = []
        while len(self.runs) < levels if levels is not None else len(nodes) > 1:
            runs = [nodes[i : i + ARITY] for i in range(0, len(nodes), ARITY)]
            made = [parent(run) for run in runs]
            self.runs.append(runs)
            self.states.append([states for states, _ in made])
            nodes = [digest for _, digest in made]
        self.top = nodes[0]

    def siblings(self, at: int) -> Iterator[tuple[bytes, bytes]]:
        """Hex text left and right of a node, level by level."""
        for runs in self.runs:
            run, slot = runs[at // ARITY], at % ARITY
            yield b"".join(run[:slot]), b"".join(run[slot + 1 :])
            at //= ARITY

    def steps(self, at: int) -> Iterator[tuple[object, bytes, bytes]]:
        """States to resume for a node, with the text left and right of it, level by level."""
        for (left, right), states in zip(self.siblings(at), self.states):
            yield states[at // ARITY][at % ARITY], left, right
            at //= ARITY


def parent(children: list[bytes]) -> tuple[list, bytes]:
    """Copies of the hash state from before each child, and the digest of all, as hex text."""
    state, states = hashlib.sha256(), []
    for child in children:
        states.append(state.copy())
        state.update(child)
    return states, state.hexdigest().encode()


def resume(state, replacement: bytes, right: bytes) -> bytes:
    """The parent's digest with another child in the place the state belongs to."""
    state = state.copy()
    state.update(replacement + right)
    return state.hexdigest().encode()


def _hex(value: bytes | None) -> bytes:
    return (value or b"").hex().encode()


def _block(nodes: pa.Table, levels: int) -> Block:
    n = nodes.column("n")[0].as_py()
    # A tree of several blocks has all levels in each; the only one of a tree ends at its top.
    return Block([_hex(d) for d in nodes.column("digest").to_pylist()], levels if n > ARITY**levels else None)


def _above(paths: pa.Table) -> tuple[list[bytes], list[bytes], bytes]:
    row = paths.to_pylist()[0]
    return row["left"], row["right"], row["top"]


def _block_of(levels: int) -> Column:
    return F.call_function("div", F.col("at"), F.lit(ARITY**levels).cast("long")).alias("block")


def tops(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The top node of each block of ``tree, at, n, digest``: the same, of the next round."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        row = {"tree": tree, "at": key[1].as_py(), "n": -(-n // ARITY**levels)}
        made = bytes.fromhex(_block(table, levels).top.decode())
        return pa.Table.from_pylist([row | {"digest": made}], schema=_schema(_NODES))

    return nodes.groupBy("tree", _block_of(levels)).applyInArrow(run, _NODES)


def rounds_of(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Nodes of each round, from those given to one node a tree."""
    rounds = [nodes]
    while not rounds[-1].filter("n > 1").isEmpty():
        rounds.append(stage(tops(rounds[-1], levels), "tops"))
    return rounds


def node_paths(nodes: DataFrame, above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``tree, at, top, left, right`` of nodes from those ``above``, of their blocks' tops."""
    schema = _schema(_PATHS)

    def run(table: pa.Table, paths: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        block, (left, right, top) = _block(table, levels), _above(paths)
        tree = paths.column("tree")[0].as_py()
        rows = []
        for k, at in enumerate(table.column("at").to_pylist()):
            near = list(block.siblings(k))
            rows.append(
                {"tree": tree, "at": at, "top": top}
                | {"left": [x for x, _ in near] + left, "right": [y for _, y in near] + right}
            )
        return pa.Table.from_pylist(rows, schema=schema)

    both = nodes.groupBy("tree", _block_of(levels)).cogroup(above.groupBy("tree", F.col("at").alias("block")))
    return both.applyInArrow(run, _PATHS)


def block_paths(rounds: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Paths of the tops of the first round's blocks, from those of the trees' tops."""
    for nodes in reversed(rounds[1:-1]):
        above = stage(node_paths(nodes, above, levels), "paths")
    return above


def folded(leaves: DataFrame, above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, proof_sha256, folded_root`` of leaves with a ``replacement``, null for themselves."""
    schema = _schema(_PROOFS)

    def run(table: pa.Table, paths: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        block, (left, right, top) = _block(table, levels), _above(paths)
        beyond = b"".join(x + y for x, y in zip(left, right))
        # The states of the levels above the block, each made once.
        upper = [(parent([x, b""])[0][1], y) for x, y in zip(left, right)]
        digests = table.column("digest").to_pylist()
        columns: list[list] = [[], []]
        for k, (digest, other) in enumerate(zip(digests, table.column("replacement").to_pylist())):
            proof, at = hashlib.sha256(), _hex(other if other is not None else digest)
            for state, x, y in block.steps(k):
                proof.update(x + y)
                at = resume(state, at, y)
            for state, y in upper:
                at = resume(state, at, y)
            proof.update(beyond)
            columns[0].append(proof.hexdigest())
            columns[1].append(at.decode())
        made = [
            table.column("doc_id").cast(pa.int64()),
            pa.array([d.hex() for d in digests], pa.string()),
            pa.array([top.hex()] * len(digests), pa.string()),
            *[pa.array(c, pa.string()) for c in columns],
        ]
        return pa.Table.from_arrays(made, schema=schema)

    both = leaves.groupBy("tree", _block_of(levels)).cogroup(above.groupBy("tree", F.col("at").alias("block")))
    return both.applyInArrow(run, _PROOFS)


@dataclass
class Manifest:
    """Trees of a dataset as staged tables; ``trees`` names sources by ``=`` and the source, or nothing for null."""

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    subroot_rounds: list[DataFrame]
    root: str | None
    levels: int

    def sources(self) -> DataFrame:
        """``source, n_rows, subroot`` of each source: what a copy of the dataset is held against."""
        sizes = self.leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n_rows"))
        named = F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).alias("source")
        found = self.subroots.select(F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot"))
        return found.join(sizes, "tree").select(named, "n_rows", "subroot")

    def proofs(self) -> DataFrame:
        """What :func:`folded` gives for all leaves."""
        nothing = F.array().cast("array<binary>")
        top = self.subroot_rounds[-1].select(
            "tree", "at", F.col("digest").alias("top"), nothing.alias("left"), nothing.alias("right")
        )
        above = node_paths(self.subroots, block_paths(self.subroot_rounds, top, self.levels), self.levels)
        # The path of a source's subroot is where the paths of its own tree begin.
        named = self.subroots.select("at", F.col("name").alias("tree"), F.col("digest").alias("top"))
        begin = above.drop("tree", "top").join(named, "at").select("tree", F.lit(0).cast("long").alias("at"), "top", "left", "right")
        begin = stage(begin, "paths")
        return folded(self.leaves, block_paths(self.rounds, begin, self.levels), self.levels)


def _numbered(leaves: DataFrame) -> DataFrame:
    """Add ``at``, the place in the row's tree, and ``n``, the tree's size."""
    # Rows equal in all else are told apart, so that a range partition can cut between them.
    placed = number_rows(leaves.withColumn("tie", F.monotonically_increasing_id()), ["tree", "doc_id", "digest", "tie"], "place")
    sizes = placed.groupBy("tree").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    found = join_narrow(placed, stage(sizes, "sizes"), ["tree"], "inner")
    return found.withColumn("at", F.col("place") - F.col("start")).drop("place", "start", "tie")


def build(docs: DataFrame, levels: int = LEVELS) -> Manifest:
    """The trees over the documents: leaves by ascending id, null ids first, equal ids by digest.

    Null sources are a source of their own, before all others.  A null field counts as
    ``-``, which no value has.  Repeated rows are leaves of their own.  Without rows there
    is no root.
    """
    rows = take(docs, **{name: name for name in FIELDS})
    values = [F.col(name) for name in FIELDS]
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(*values).alias("digest"),
        tampered_leaf(F.col("doc_id"), *values).alias("replacement"),
    )
    leaves = stage(_numbered(leaves), "leaves")
    rounds = rounds_of(leaves.select("tree", "at", "n", "digest"), levels)
    # Sources in byte order of their names: one leaf each of the tree above.
    named = rounds[-1].select(F.col("tree").alias("name"), "digest")
    above = number_rows(named, ["name"], "at").withColumn("tree", F.lit(""))
    subroots = stage(above.withColumn("n", F.lit(named.count()).cast("long")), "subroots")
    above_rounds = rounds_of(subroots.select("tree", "at", "n", "digest"), levels)
    top = above_rounds[-1].first()
    return Manifest(leaves, rounds, subroots, above_rounds, top["digest"].hex() if top else None, levels)


def merkle_manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Result of the query, one row per document: its leaf, its source's subroot, the root and the folded leaf.

    Every leaf is folded: the tampered one where the rule asks for it, else the leaf as it
    is, and verified says that the root came out.  Null and empty texts differ; neither
    has line ends to lose, so they are verified.  An empty table gives no row.
    """
    with scope() as building:
        tree = build(docs, levels)
        root = F.lit(tree.root).cast("string")
        found = tree.proofs().select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root")
        found = building.keep(found.withColumn("verified", F.col("folded_root") == F.col("root")), "proofs")
    return found


def _leaf_sql(text: str) -> str:
    fields = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(fields)})"


SQL = f"""
WITH RECURSIVE named AS (
    SELECT *, coalesce('=' || source, '') AS tree, CAST(doc_id AS VARCHAR) AS name FROM documents
), leaves AS (
    SELECT tree, doc_id, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n,
        {_leaf_sql("text")} AS leaf,
        CASE WHEN {crc32_sql("name")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS other
    FROM named
), nodes(tree, level, i, n, digest) AS (
    SELECT tree, 0, i, n, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, i // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 3
), subroots AS (
    SELECT tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), above(level, i, n, digest) AS (
    SELECT 0, i, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, i // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY level, i // 3
), every AS (
    SELECT tree, level, i, n, digest FROM nodes UNION ALL SELECT NULL, level, i, n, digest FROM above
), runs AS (
    SELECT tree, level, i // 3 AS run, list(digest ORDER BY i) AS children FROM every WHERE n > 1 GROUP BY ALL
), path(doc_id, tree, level, i, n, proof, folded) AS (
    SELECT doc_id, tree, 0, i, n, '', other FROM leaves
    UNION ALL
    SELECT doc_id,
        CASE WHEN p.n = 1 THEN NULL ELSE p.tree END,
        CASE WHEN p.n = 1 THEN 0 ELSE p.level + 1 END,
        CASE WHEN p.n = 1 THEN s.i ELSE p.i // 3 END,
        CASE WHEN p.n = 1 THEN s.n ELSE (p.n + 2) // 3 END,
        CASE WHEN p.n = 1 THEN proof ELSE proof || array_to_string(list_filter(children, lambda x, k: k <> p.i % 3 + 1), '') END,
        CASE WHEN p.n = 1 THEN folded ELSE sha256(array_to_string(
            list_transform(children, lambda x, k: CASE WHEN k = p.i % 3 + 1 THEN folded ELSE x END), '')) END
    FROM path p LEFT JOIN runs r ON r.tree IS NOT DISTINCT FROM p.tree AND r.level = p.level AND r.run = p.i // 3
        LEFT JOIN subroots s ON s.name = p.tree
    WHERE p.n > 1 OR p.tree IS NOT NULL
)
SELECT doc_id, leaf, s.digest AS subroot, a.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
    folded = a.digest AS verified
FROM path p JOIN leaves l USING (doc_id) JOIN subroots s ON s.name = l.tree, (SELECT digest FROM above WHERE n = 1) a
WHERE p.n = 1 AND p.tree IS NULL
"""
