"""A Merkle manifest of a documents table, stored in van Emde Boas order.

Leaves are digests of rows, in one tree per language; the roots of those trees are the leaves of a last
tree. A tree is cut into aligned blocks of 512 leaves. A block is one binary value: its subtree split at
half height, the upper part first and the lower parts behind it, each laid out in the same way, so that
the place of a node follows from its depth and index alone. The roots of a tree's blocks are the leaves of the
next tier, until one block is left. No task holds more than a block and no tree is ever whole in one place.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.llm.shared import documents, written
from clickflow.scratch import fresh_dir

#: Nodes under one node, and levels of digests in a block besides the leaves: 8^3 leaves.
FAN_OUT = 8
BLOCK_LEVELS = 3
BLOCK_LEAVES = FAN_OUT**BLOCK_LEVELS
_DIGEST = 32
#: The tree key of the last tree. No language's key equals it: those are ``-`` or begin with ``=``.
_TOP = "top"


# --- leaves -----------------------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: str | Column = "text") -> Column:
    """The digest of a documents row, in hexadecimal. Each field counts with its length; a null is ``-``."""
    text = F.col(text) if isinstance(text, str) else text
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*map(_field, fields)), 256)


def tree_key(lang: str | Column = "lang") -> Column:
    """A key that is never null and sorts as languages do: null first, then by bytes."""
    lang = F.col(lang) if isinstance(lang, str) else lang
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


# --- layout -----------------------------------------------------------------------------------


def subtree_size(levels: int) -> int:
    """Nodes of a complete subtree of so many levels, leaves included."""
    return (FAN_OUT**levels - 1) // (FAN_OUT - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0: the root) in a block of ``levels`` levels."""
    index = np.asarray(index, dtype=np.int64)
    place = np.zeros_like(index)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        levels, depth = levels - upper, depth - upper
        below = FAN_OUT**depth
        place += subtree_size(upper) + index // below * subtree_size(levels)
        index = index % below
    return place


def height(leaves: int) -> int:
    """Rounds of hashing that leave one node of so many."""
    rounds, nodes = 0, leaves
    while nodes > 1:
        rounds, nodes = rounds + 1, -(-nodes // FAN_OUT)
    return rounds


def node_counts(leaves: int, rounds: int) -> list[int]:
    """Nodes that a block has at each depth, from its root to its leaves."""
    counts = [leaves]
    for _ in range(rounds):
        counts.append(-(-counts[-1] // FAN_OUT))
    return counts[::-1]


def hash_run(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def build_block(leaves: list[str], rounds: int) -> bytes:
    """The block's nodes in van Emde Boas order. Places of nodes that do not exist are zeros."""
    store = np.zeros((subtree_size(rounds + 1), _DIGEST), dtype=np.uint8)
    level = leaves
    for depth in range(rounds, -1, -1):
        raw = np.frombuffer(bytes.fromhex("".join(level)), dtype=np.uint8).reshape(-1, _DIGEST)
        store[address(rounds + 1, depth, np.arange(len(level)))] = raw
        if depth:
            level = [hash_run(level[i : i + FAN_OUT]) for i in range(0, len(level), FAN_OUT)]
    return store.tobytes()


def block_level(store: bytes, rounds: int, depth: int, count: int) -> list[str]:
    """The digests at one depth of a stored block, in hexadecimal."""
    nodes = np.frombuffer(store, dtype=np.uint8).reshape(-1, _DIGEST)
    whole = nodes[address(rounds + 1, depth, np.arange(count))].tobytes().hex()
    return [whole[i : i + 2 * _DIGEST] for i in range(0, len(whole), 2 * _DIGEST)]


def block_paths(store: bytes, rounds: int, leaves: int) -> list[list[tuple[str, str]]]:
    """For each leaf, from below to the block's root: the digests left and right of it in its run."""
    counts = node_counts(leaves, rounds)
    paths: list[list[tuple[str, str]]] = [[] for _ in range(leaves)]
    for depth in range(rounds, 0, -1):
        level, below = block_level(store, rounds, depth, counts[depth]), FAN_OUT ** (rounds - depth)
        sides = []
        for i in range(len(level)):
            start = i - i % FAN_OUT
            sides.append(("".join(level[start:i]), "".join(level[i + 1 : start + FAN_OUT])))
        for leaf, path in enumerate(paths):
            path.append(sides[leaf // below])
    return paths


def fold(leaf: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf gives with its siblings."""
    for left, right in path:
        leaf = hash_run((left, leaf, right))
    return leaf


def proof_digest(path: Iterable[tuple[str, str]]) -> str:
    """The digest of all siblings, from below to the root, left to right."""
    return hash_run(left + right for left, right in path)


# --- building ---------------------------------------------------------------------------------


def with_positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place in their ``tree`` from 0, and ``total``, the tree's rows.

    Rows are range-partitioned by tree and order and written; a place is the row's number in its file and
    the rows of the same tree in the files before. A tree may so lie in any number of files.
    """
    ordered = written(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order), "ordered")
    table = ordered.select(
        "*",
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("part"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    parts = table.groupBy("part", "tree").agg(F.min("row_index").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "part",
        "tree",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("total"),
    )
    placed = table.join(starts, ["part", "tree"]).withColumn("pos", F.col("row_index") + F.col("shift"))
    return placed.drop("part", "row_index", "shift", "first")


_BLOCK = "tree string, block long, leaves int, rounds int, total long, nodes binary, root string"


def _blocks(leaves: DataFrame) -> DataFrame:
    """One row per block of ``tree, pos, digest, total``; ``leaves`` are few enough for any task."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        digests, total = group["digest"].to_pylist(), group["total"][0].as_py()
        rounds = min(BLOCK_LEVELS, height(total))
        store = build_block(digests, rounds)
        return pa.table(
            {
                "tree": [group["tree"][0].as_py()],
                "block": [group["block"][0].as_py()],
                "leaves": pa.array([len(digests)], pa.int32()),
                "rounds": pa.array([rounds], pa.int32()),
                "total": [total],
                "nodes": [store],
                "root": [block_level(store, rounds, 0, 1)[0]],
            }
        )

    block = F.floor(F.col("pos") / BLOCK_LEAVES).cast("long").alias("block")
    rows = leaves.select("tree", block, "pos", "digest", "total")
    return rows.groupBy("tree", "block").applyInArrow(build, _BLOCK)


def _write_tree(leaves: DataFrame, path: str) -> list[DataFrame]:
    """Write the blocks of all trees, tier over tier; the tables in order. The last has one block a tree."""
    spark, tiers = leaves.sparkSession, []
    most = leaves.agg(F.max("total").alias("most")).first()["most"] or 0
    while True:
        target = f"{path}/tier={len(tiers)}"
        _blocks(leaves).write.option("compression", "zstd").parquet(target)
        tiers.append(spark.read.schema(_BLOCK).parquet(target))
        most = -(-most // BLOCK_LEAVES)
        if most <= 1:
            return tiers
        leaves = tiers[-1].where(F.col("total") > BLOCK_LEAVES).select(
            "tree",
            F.col("block").alias("pos"),
            F.col("root").alias("digest"),
            F.ceil(F.col("total") / BLOCK_LEAVES).cast("long").alias("total"),
        )


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """``tree, digest``: the root of each tree, which is in the tier where one block is left of it."""
    single = [t.where(F.col("total") <= BLOCK_LEAVES).select("tree", F.col("root").alias("digest")) for t in tiers]
    found = single[0]
    for more in single[1:]:
        found = found.unionByName(more)
    return found


class Manifest:
    """The tables of a written manifest: blocks of the language trees and of the tree over them."""

    def __init__(self, spark: SparkSession, path: str, tiers: int, top_tiers: int):
        read = spark.read.schema(_BLOCK)
        self.tiers = [read.parquet(f"{path}/languages/tier={i}") for i in range(tiers)]
        self.top = [read.parquet(f"{path}/top/tier={i}") for i in range(top_tiers)]

    def subroots(self) -> DataFrame:
        """``tree, digest``."""
        return _roots(self.tiers)

    def root(self) -> str | None:
        """The digest of everything, null for an empty table."""
        found = _roots(self.top).first()
        return None if found is None else found["digest"]


def write_manifest(leaves: DataFrame, path: str) -> Manifest:
    """Write the blocks of ``tree, pos, total, digest`` to a new folder."""
    spark = leaves.sparkSession
    tiers = _write_tree(leaves, f"{path}/languages")
    subroots = _roots(tiers).withColumn("name", F.col("tree")).withColumn("tree", F.lit(_TOP))
    ranked = with_positions(subroots, "name")
    top = _write_tree(ranked, f"{path}/top")
    return Manifest(spark, path, len(tiers), len(top))


# --- proofs -----------------------------------------------------------------------------------

_PATH = "array<struct<left:string,right:string>>"


def _path_type() -> pa.DataType:
    return pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _as_path(value: list[dict] | None) -> list[tuple[str, str]]:
    return [(p["left"], p["right"]) for p in value or ()]


def _node_paths(tier: DataFrame, above: DataFrame | None) -> DataFrame:
    """``tree, pos, path`` of every leaf of a tier, with the path of its block where a tier is above."""
    blocks = tier.select("tree", "block", "leaves", "rounds", "nodes")
    if above is None:
        blocks = blocks.withColumn("path", F.lit(None).cast(_PATH))
    else:
        blocks = blocks.join(above.withColumnRenamed("pos", "block"), ["tree", "block"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rest, first = _as_path(row["path"]), row["block"] * BLOCK_LEAVES
                paths = block_paths(row["nodes"], row["rounds"], row["leaves"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(paths)),
                        pa.array(range(first, first + len(paths)), pa.int64()),
                        pa.array([[{"left": a, "right": b} for a, b in p + rest] for p in paths], _path_type()),
                    ],
                    ["tree", "pos", "path"],
                )

    return blocks.mapInArrow(run, f"tree string, pos long, path {_PATH}")


def _paths_above(tiers: list[DataFrame]) -> DataFrame | None:
    """Paths of the blocks of the lowest tier; null if it is the only one."""
    above = None
    for tier in reversed(tiers[1:]):
        above = _node_paths(tier, above)
    return above


def _block_table(manifest: Manifest) -> DataFrame:
    """The lowest blocks with their path to the root of everything and both roots. One row a block."""
    above = _paths_above(manifest.tiers)
    low = manifest.tiers[0]
    if above is None:
        low = low.withColumn("path", F.lit(None).cast(_PATH))
    else:
        low = low.join(above.withColumnRenamed("pos", "block"), ["tree", "block"], "left")
    # The languages in the order of the last tree's leaves.
    ranked = with_positions(
        manifest.subroots().select(F.col("tree").alias("name"), F.col("digest").alias("subroot"), F.lit(_TOP).alias("tree")),
        "name",
    )
    top = _node_paths(manifest.top[0], _paths_above(manifest.top)).withColumnRenamed("path", "top_path")
    named = ranked.join(top, ["tree", "pos"]).select(F.col("name").alias("tree"), "subroot", "top_path")
    nothing = F.array().cast(_PATH)
    return low.join(named, "tree").select(
        "tree",
        "block",
        "leaves",
        "rounds",
        "nodes",
        "subroot",
        F.concat(F.coalesce("path", nothing), F.coalesce("top_path", nothing)).alias("path"),
    )


_CHECKED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def check_claims(manifest: Manifest, claims: DataFrame) -> DataFrame:
    """Fold every claimed digest of ``tree, pos, doc_id, claimed`` with the stored siblings of its place.

    Returns ``doc_id``, the stored ``leaf``, its ``subroot``, the ``root``, ``proof_sha256`` (the digest of the
    siblings), ``folded_root`` and whether that equals the root.
    """
    root = manifest.root()

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in _CHECKED.split(", ")}
        if block.num_rows and asked.num_rows:
            held = block.slice(0, 1).to_pylist()[0]
            rest = _as_path(held["path"])
            paths = block_paths(held["nodes"], held["rounds"], held["leaves"])
            leaves = block_level(held["nodes"], held["rounds"], held["rounds"], held["leaves"])
            for row in asked.to_pylist():
                place = row["pos"] % BLOCK_LEAVES
                path = paths[place] + rest
                folded = fold(row["claimed"], path)
                values = (row["doc_id"], leaves[place], held["subroot"], root, proof_digest(path), folded, folded == root)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds, strict=True)})

    block = F.floor(F.col("pos") / BLOCK_LEAVES).cast("long").alias("block")
    asked = claims.select("tree", block, "pos", "doc_id", "claimed")
    blocks = _block_table(manifest)
    return (
        blocks.groupBy("tree", "block").cogroup(asked.groupBy("tree", "block")).applyInArrow(run, _CHECKED)
    )


def _tampered() -> Column:
    """The text with A-Z in lower case where 3 divides the crc32 of the decimal ``doc_id``."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower)


def placed_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, digest, claimed, pos, total`` of every row of a documents table.

    Every row is a leaf, repeated ones too; equal ids go by the digest, equal rows in any order, which changes
    nothing. A null ``doc_id`` comes first and is never tampered with. ``claimed`` is the digest of the tampered
    row, or the row's own. A null text, language or other field is ``-``; an empty one is ``0:``.
    """
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        tree_key().alias("tree"),
        leaf_digest().alias("digest"),
        F.when(_tampered().isNotNull(), leaf_digest(_tampered())).alias("changed"),
        F.monotonically_increasing_id().alias("place"),
    )
    digests = written(rows, "leaves")
    claimed = F.coalesce("changed", "digest").alias("claimed")
    return with_positions(digests.select("tree", "doc_id", "digest", "place", claimed), "doc_id", "digest", "place")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaf, roots and proof, and whether its possibly changed row verifies.

    An empty table gives no row. Columns beyond those of documents are not read.
    """
    leaves = written(placed_leaves(documents(spark, sf_dir)).drop("place"), "placed")
    manifest = write_manifest(leaves, fresh_dir(spark, "manifest"))
    return check_claims(manifest, leaves)


#: The tree in SQL: a round per level, in which runs of eight digests become one. Every leaf's path is read off the levels.
OP11_SQL = """
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), docs AS (
  SELECT doc_id, lang, text, source, n_chars,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
      lambda c, d: xor(c >> 8, CAST(t[(xor(c, d) & 255) + 1] AS BIGINT)))) % 3 = 0 AS hit
  FROM documents, steps
), fields AS (
  SELECT doc_id, lang, hit, text,
    COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
      || COALESCE(strlen(lang) || ':' || lang, '-') || COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM docs
), digests AS (
  SELECT doc_id, COALESCE('=' || lang, '-') AS tree,
    sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || COALESCE(strlen(text) || ':'
      || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM digests
), nodes(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), CAST(ceil(any_value(n) / 8) AS BIGINT)
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 8
), subroots AS (
  SELECT tree, digest, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1
), tops(level, pos, digest, n) AS (
  SELECT 0, pos, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), CAST(ceil(any_value(n) / 8) AS BIGINT)
  FROM tops WHERE n > 1 GROUP BY level, pos // 8
), sides AS (
  SELECT a.tree, a.level, a.pos,
    string_agg(CASE WHEN b.pos < a.pos THEN b.digest ELSE '' END, '' ORDER BY b.pos) AS lefts,
    string_agg(CASE WHEN b.pos > a.pos THEN b.digest ELSE '' END, '' ORDER BY b.pos) AS rights
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos
), top_sides AS (
  SELECT a.level, a.pos,
    string_agg(CASE WHEN b.pos < a.pos THEN b.digest ELSE '' END, '' ORDER BY b.pos) AS lefts,
    string_agg(CASE WHEN b.pos > a.pos THEN b.digest ELSE '' END, '' ORDER BY b.pos) AS rights
  FROM tops a JOIN tops b ON a.level = b.level AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY a.level, a.pos
), paths AS (
  SELECT l.tree, l.pos, s.level, s.lefts, s.rights
  FROM leaves l JOIN sides s ON s.tree = l.tree AND s.pos = l.pos // CAST(pow(8, s.level) AS BIGINT)
  UNION ALL
  SELECT l.tree, l.pos, r.height + t.level, t.lefts, t.rights
  FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN top_sides t ON t.pos = r.pos // CAST(pow(8, t.level) AS BIGINT)
), proofs AS (
  SELECT tree, pos, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof,
    list(struct_pack(l := lefts, r := rights) ORDER BY level) AS path
  FROM paths GROUP BY tree, pos
), folds(tree, pos, level, digest, path) AS (
  SELECT l.tree, l.pos, 0, COALESCE(l.changed, l.leaf), COALESCE(p.path, [])
  FROM leaves l LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos
  UNION ALL
  SELECT tree, pos, level + 1, sha256(path[level + 1].l || digest || path[level + 1].r), path
  FROM folds WHERE level < len(path)
)
SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, COALESCE(p.proof, sha256('')) AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified
FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN tops t ON t.n = 1
JOIN folds f ON f.tree = l.tree AND f.pos = l.pos AND f.level = len(f.path)
LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos
"""
