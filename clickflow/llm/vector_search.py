"""Nearest neighbours by inner product over stable projections indexed by kd-trees.

Vectors are lifted by one coordinate to equal length, so that the largest inner product is the smallest
distance, and projected to a few dimensions by Gaussian directions. For a point at distance ``d``, the
squared projected distance over ``d * d`` follows a chi-square law. A kd-tree over the projections
yields points by growing projected distance; each is verified in the original space, until the law says that a
nearer point would by now have shown up with the wanted certainty.

The upper levels of the tree, fitted to a bounded sample, split all rows into cells, one Spark group each;
large cells are split further by hash. A query visits its own cell first. With the distances found there it visits
the cells that the stopping test does not rule out. Queries meet a cell in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import written

PROJECTED = 8
CERTAINTY = 0.99
SAMPLE_ROWS = 20_000
CELL_ROWS = 8_192
QUERY_BLOCK = 2_048
_LEAF_ROWS = 32
_SEED = 7


def chi_square(x: np.ndarray, dims: int = PROJECTED) -> np.ndarray:
    """The chi-square distribution function for an even number of dimensions."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700)
    term = total = np.ones_like(half)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stop_factor(certainty: float, dims: int = PROJECTED) -> float:
    """The ratio of squared projected to squared true distance at which the test stops."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array([mid]), dims)[0] < certainty else (low, mid)
    return high


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows that are not zero, also where squares of their components underflow or overflow."""
    largest = np.abs(vectors).max(axis=1)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Frame:
    """What lifts and projects a vector: the largest squared length, and the directions."""

    top: float
    directions: np.ndarray

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        flat = vectors @ self.directions[:-1]
        if query:
            # A query has no lifted part, and its length does not change which product is largest.
            length = _lengths(vectors)[:, None]
            return flat / length * math.sqrt(self.top)
        rest = np.sqrt(np.maximum(self.top - (vectors * vectors).sum(axis=1), 0))
        return flat + rest[:, None] * self.directions[-1]


def _boxes(points: np.ndarray, rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halves along the widest dimension."""
    out, stack = [], [rows]
    while stack:
        part = stack.pop()
        if len(part) <= leaf:
            out.append(part)
            continue
        wide = int(np.argmax(np.ptp(points[part], axis=0)))
        order = part[np.argsort(points[part, wide], kind="stable")]
        stack += [order[: len(order) // 2], order[len(order) // 2 :]]
    return out


def _box_distance(low: np.ndarray, high: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distance of each point (row) to each box (column)."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d][:, None]
        gap = np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0)
        out += gap * gap
    return out


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in one order whatever stands beside, so that equal vectors tie."""
    return (vectors * query).sum(axis=1)


def search_cell(
    frame: Frame,
    ids: np.ndarray,
    vectors: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    known: np.ndarray,
    k: int,
    factor: float,
) -> list[tuple[int, int, float]]:
    """The ``k`` best rows of one cell for each query, as (query id, row id, product).

    ``known``: a product that ``k`` rows elsewhere reach, or minus infinity. Leaves are verified by growing
    projected distance, twice as many at each step, until the stopping test holds for the next leaf.
    """
    points = frame.project(vectors, False)
    leaves = _boxes(points, np.arange(len(ids)), _LEAF_ROWS)
    low = np.array([points[leaf].min(axis=0) for leaf in leaves])
    high = np.array([points[leaf].max(axis=0) for leaf in leaves])
    spots = frame.project(queries, True)
    out = []
    for i, query_id in enumerate(query_ids.tolist()):
        query = queries[i]
        length = float(_lengths(query[None])[0])
        slack = 1e-9 * length * math.sqrt(frame.top)
        reach = _box_distance(low, high, spots[i : i + 1])[0]
        order = np.argsort(reach, kind="stable")
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0)
        at, step = 0, 4
        while at < len(order):
            bound = max(known[i], best[k - 1] if len(best) >= k else -np.inf)
            # In the lifted space, with the query scaled to the common length.
            apart = max(2 * frame.top - 2 * math.sqrt(frame.top) / length * bound, 0.0)
            if reach[order[at]] > factor * apart + 1e-9 * frame.top:
                break
            rows = np.concatenate([leaves[leaf] for leaf in order[at : at + step]])
            rows = rows[ids[rows] != query_id]
            # A matrix product passes over what cannot come in; the rest is summed exactly.
            rows = rows[vectors[rows] @ query >= bound - slack]
            all_ids = np.concatenate([best_ids, ids[rows]])
            scores = np.concatenate([best, _products(vectors[rows], query)])
            keep = np.lexsort((all_ids, -scores))[:k]
            best_ids, best = all_ids[keep], scores[keep]
            at, step = at + step, step * 2
        out += [(query_id, int(v), float(s)) for v, s in zip(best_ids, best, strict=True) if s >= known[i]]
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if len(flat) == 0:
        return np.empty((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` in double precision, without null, empty, zero or non-finite vectors and null ids."""
    vector = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        "vec_id is not null and vector is not null and size(vector) > 0 "
        "and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(vector, x -> x <> 0)"
    )


@dataclass(frozen=True)
class Cells:
    """The upper tree: per inner node its dimension and value, level by level; and the boxes of the cells."""

    depth: int
    dims: np.ndarray
    values: np.ndarray

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for level in range(self.depth):
            at = node + (1 << level) - 1
            right = points[np.arange(len(points)), self.dims[at]] > self.values[at]
            node = 2 * node + right
        return node


def _split(points: np.ndarray, depth: int) -> Cells:
    dims = np.zeros((1 << depth) - 1, dtype=np.int64)
    values = np.zeros((1 << depth) - 1)
    parts = [np.arange(len(points))]
    for level in range(depth):
        following = []
        for node, part in enumerate(parts):
            at = node + (1 << level) - 1
            if len(part):
                dims[at] = int(np.argmax(np.ptp(points[part], axis=0)))
                values[at] = np.median(points[part, dims[at]])
            right = points[part, dims[at]] > values[at]
            following += [part[~right], part[right]]
        parts = following
    return Cells(depth, dims, values)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    certainty: float = CERTAINTY,
    sample_rows: int = SAMPLE_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vec_id, embedding`` that ``queries`` selects, its ``k``
    other rows with the largest inner product, ties to the smaller id; all others, if they are fewer.

    Null, zero and non-finite vectors and null ids take no part. All vectors have one length, or the job
    stops. Rows with one ``vec_id`` and vector count once; of rows that repeat an id with other vectors,
    the least in order counts. Other columns are not read. A result may lack a neighbour with a chance of about
    ``1 - certainty`` each; scores are exact. Every row is indexed; ``sample_rows`` bounds what places the cells.
    """
    spark = vectors.sparkSession
    rows = written(
        valid_vectors(vectors).groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors"
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.agg(
        F.count("*").alias("n"), F.max(square).alias("top"),
        F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high"),
    ).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], result)
    if facts["low"] != facts["high"]:
        raise ValueError(f"vectors of {facts['low']} and of {facts['high']} components cannot be compared")
    directions = np.random.default_rng(_SEED).standard_normal((facts["high"] + 1, PROJECTED))
    frame = Frame(facts["top"] * (1 + 1e-12), directions)
    factor = stop_factor(certainty)

    depth = max(0, math.ceil(math.log2(facts["n"] / cell_rows)))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").toArrow()
    cells = _split(frame.project(_matrix(sample.column(0)), False), depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = frame.project(_matrix(batch.column(1)), False)
                spots = pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), PROJECTED).cast(
                    pa.list_(pa.float64())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cells.of(points)), spots],
                    ["vec_id", "vector", "cell", "spot"],
                )

    placed = written(
        rows.mapInArrow(place, "vec_id long, vector array<double>, cell long, spot array<double>"), "placed"
    )
    # Per cell its rows and its box: one line for every ``cell_rows`` rows.
    bounds = [f(F.col("spot")[d]).alias(f"{n}{d}") for n, f in (("low", F.min), ("high", F.max)) for d in range(PROJECTED)]
    table = placed.groupBy("cell").agg(F.count("*").alias("n"), *bounds).toPandas().sort_values("cell")
    low = table[[f"low{d}" for d in range(PROJECTED)]].to_numpy()
    high = table[[f"high{d}" for d in range(PROJECTED)]].to_numpy()
    names = table["cell"].to_numpy(np.int64)
    parts = np.ceil(table["n"].to_numpy() / (2 * cell_rows)).astype(np.int64)
    splits = spark.createDataFrame(pd.DataFrame({"cell": names, "parts": parts}), "cell long, parts long")
    indexed = placed.join(splits, "cell").select(
        "vec_id", "vector", "cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part")
    )
    asked = rows.where(queries).select("vec_id", "vector")

    def route(others: bool):
        """Where queries go: to the nearest cell; or to the others that the stopping test leaves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    ids, matrix = part.column(0).to_numpy(), _matrix(part.column(1))
                    bound = part.column(2).to_numpy()
                    reach = _box_distance(low, high, frame.project(matrix, True))
                    home = reach.argmin(axis=1)
                    if others:
                        length = _lengths(matrix)
                        apart = np.maximum(2 * frame.top - 2 * math.sqrt(frame.top) / length * bound, 0)
                        visit = reach <= (factor * apart + 1e-9 * frame.top)[:, None]
                        visit[np.arange(len(ids)), home] = False
                    else:
                        visit = np.zeros(reach.shape, dtype=bool)
                        visit[np.arange(len(ids)), home] = True
                    who, cell = np.nonzero(visit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[who]), part.column(1).take(pa.array(who)), pa.array(bound[who]), pa.array(names[cell])],
                        ["query_id", "vector", "known", "cell"],
                    )

        return run

    def visit(wanted: DataFrame, others: bool) -> DataFrame:
        routed = wanted.mapInArrow(route(others), "query_id long, vector array<double>, known double, cell long")
        per_cell = routed.groupBy("cell").agg(F.count("*").alias("queries"))
        blocks = F.ceil(F.col("queries") / QUERY_BLOCK).cast("long")
        sized = written(per_cell.select("cell", blocks.alias("blocks")), "cell-queries")
        # A part of a cell is there once for each block of queries, a query once for each part of its cell.
        left = indexed.join(sized, "cell").select(
            "cell", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            "vec_id", "vector",
        )
        right = routed.join(sized, "cell").join(splits, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("query_id"), F.col("blocks")).alias("block"), "query_id", "vector", "known",
        )

        def search(cell: pa.Table, ask: pa.Table) -> pa.Table:
            found = []
            if cell.num_rows and ask.num_rows:
                found = search_cell(
                    frame, cell.column("vec_id").to_numpy(), _matrix(cell.column("vector")),
                    ask.column("query_id").to_numpy(), _matrix(ask.column("vector")), ask.column("known").to_numpy(),
                    k, factor,
                )
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.float64()]
            return pa.table(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"]
            )

        key = ["cell", "part", "block"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
            search, "query_id long, vec_id long, score double"
        )

    never = F.lit(float("-inf"))
    first = written(visit(asked.withColumn("known", never), False), "first-visit")
    # At most k rows from each part of the one cell visited.
    worst = first.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list("score"), False), 1, k).alias("s"))
    bounds = worst.select(
        F.col("query_id").alias("vec_id"),
        F.when(F.size("s") >= k, F.element_at("s", -1)).otherwise(never).alias("known"),
    )
    again = asked.join(bounds, "vec_id", "left").select("vec_id", "vector", F.coalesce("known", never).alias("known"))
    both = first.unionByName(visit(again, True))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "score")))
    return (
        both.groupBy("query_id")
        .agg(F.slice(ranked, 1, k).alias("found"))
        .select("query_id", F.posexplode("found").alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score")
    )


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20)
