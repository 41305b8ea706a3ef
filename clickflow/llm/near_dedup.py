"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles is reduced to registers: truncated, exponentially spaced minima
of exponentially distributed hashes, ``floor(1 - log_b(min))``. Registers of a union are the maxima of
the registers, and equal registers become likely with the overlap of two sets. Documents that agree in a
band of registers are candidates. A candidate's overlap is estimated from all registers and both set
sizes by maximum likelihood; what is far below the threshold goes, the rest is checked on the full sets.

With 16 bands of 4 registers, a pair at the threshold of 0.85 shares no band once in 100,000 times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.linking import link_buckets
from clickflow.llm.shared import documents, written

WORDS = 5
BANDS = 16
BAND_REGISTERS = 4
#: The bands take the first 64 registers; all of them serve the estimate.
REGISTERS = 256
#: Base, rate and largest register of the sketch: steps of 0.1 % in two bytes.
BASE, RATE, TOP = 1.001, 20.0, 65_535
#: Estimates so many standard deviations below the threshold are not checked further.
SLACK = 5

_RANDOM = np.random.default_rng(20_001)
_MULTIPLY = _RANDOM.integers(0, 2**64, REGISTERS, dtype=np.uint64) | np.uint64(1)
_ADD = _RANDOM.integers(0, 2**64, REGISTERS, dtype=np.uint64)
_WORD_FACTORS = _RANDOM.integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)
_SHORT = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; of all words, if there are fewer.

    Words are the bytes between ASCII white space; A-Z are lowered. No words, or no text: none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - WORDS + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(min(WORDS, len(words))):
        total += hashes[i : i + n] * _WORD_FACTORS[i]
    if len(words) < WORDS:
        total += np.uint64(_SHORT * len(words) % 2**64)
    return np.unique(_mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes, as 16-bit registers."""
    least = np.full(REGISTERS, 2**64 - 1, dtype=np.uint64)
    for start in range(0, len(hashes), 256):
        part = hashes[start : start + 256, None] * _MULTIPLY + _ADD
        np.minimum(least, part.min(axis=0), out=least)
    smallest = -np.log1p(-np.minimum((least.astype(np.float64) + 0.5) / 2.0**64, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(BASE)), 0, TOP).astype("<u2")


_GRID = np.linspace(0, 1, 401)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The overlap that makes the comparison of the registers (one pair per row) most likely."""
    above, below = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    limit = np.minimum(u / v, v / u)
    overlap = _GRID[None, :] * limit

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / math.log(BASE)

    p_above, p_below = chance(u - v * overlap), chance(v - u * overlap)
    equal = np.clip(1 - p_above - p_below, 1e-9, 1)
    score = above * np.log(p_above) + below * np.log(p_below) + (a.shape[1] - above - below) * np.log(equal)
    return np.take_along_axis(overlap, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_shingles", "set_high", "set_low", "sketch"]
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            rows = []
            for text in part.column(1).to_pylist():
                found = shingles(text)
                if len(found) == 0:
                    rows.append((0, None, None, None))
                    continue
                name = xxhash.xxh3_128_digest(found.tobytes())
                high, low = np.frombuffer(name, "<i8").tolist()
                rows.append((len(found), high, low, registers(found).tobytes()))
            counts, high, low, sketch = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), pa.array(sketch, pa.binary())],
                names,
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            found = [shingles(t).view(np.int64) for t in part.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "items"])


#: Members of an open bucket are compared in blocks of about so many members or shingles, whichever is fewer.
BLOCK_MEMBERS = 2_048
BLOCK_SHINGLES = 1 << 20


def _block_links(members: pa.Table, floor: float, percent: int) -> pa.Table:
    """Links among one block of members, or between two, that join different groups.

    Sketches choose whom to compare; sets decide. Members that a link found here has joined are not
    compared again, so a block gives fewer links than it has members.
    """
    ids, component, n, side = (members.column(c).to_numpy() for c in ("id", "component", "n", "side"))
    sketch = np.frombuffer(b"".join(members.column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)
    lists = members.column("items").combine_chunks()
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    order = np.lexsort((ids, n))
    component, n, side, sketch = component[order].copy(), n[order], side[order], sketch[order]
    # Sizes ascend: who is small enough for a row to reach the threshold with it comes before this place.
    ends = np.searchsorted(n * percent, n * 100, side="right")
    single = side.min() == side.max()
    sizes = n.astype(np.float64)
    links = []
    for i in range(len(order) - 1):
        j = np.arange(i + 1, ends[i])
        j = j[(component[j] != component[i]) & (single | (side[j] != side[i]))]
        if len(j):
            # Equal registers alone come near enough to the estimate to pass over most at once.
            j = j[(sketch[j] == sketch[i]).mean(axis=1) >= floor - 0.05]
        if len(j):
            mine = np.broadcast_to(sketch[i], (len(j), REGISTERS))
            j = j[estimate(mine, sketch[j], np.broadcast_to(sizes[i], len(j)), sizes[j]) >= floor]
        own = values[offsets[order[i]] : offsets[order[i] + 1]]
        for k in j.tolist():
            if component[k] == component[i]:
                continue
            other = values[offsets[order[k]] : offsets[order[k] + 1]]
            common = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * common >= percent * (len(own) + len(other) - common):
                x, y = int(ids[order[i]]), int(ids[order[k]])
                links.append((max(x, y), min(x, y)))
                component[component == component[k]] = component[i]
    columns = list(zip(*links, strict=True)) or [(), ()]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _likely(floor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS)
                for i in (2, 3)
            )
            sizes = [batch.column(i).to_numpy().astype(np.float64) for i in (4, 5)]
            keep = pa.array(estimate(a, b, *sizes) >= floor)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets.
    ``component_id`` is the smallest ``doc_id`` that links reach; the row of that id is kept. Documents
    with equal sets are one class from the start, whose smallest ``doc_id`` stands for it in all
    pairs. A document without words is linked with nothing and kept. A null ``doc_id`` takes no part:
    its component is null and it is kept. Rows that repeat a ``doc_id`` each go by their own text. Other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    sketched = written(
        rows.mapInArrow(
            _sketched, "doc_id long, n_shingles long, set_high long, set_low long, sketch binary"
        ),
        "sketches",
    )
    classes = written(
        sketched.where("doc_id is not null and n_shingles > 0")
        .groupBy("set_high", "set_low")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    width = 2 * BAND_REGISTERS
    keys = [
        F.xxhash64(F.lit(i), F.substring("sketch", 1 + width * i, width)) for i in range(BANDS)
    ]
    buckets = classes.select(F.explode(F.array(*keys)).alias("key"), "id")
    share = percent / 100
    floor = share - SLACK * math.sqrt(share * (1 - share) / REGISTERS)

    def sets_of(ids: DataFrame) -> DataFrame:
        """``id, items`` for classes by their ``id``, from the whole texts."""
        wanted = ids.select(F.col("id").alias("doc_id")).distinct()
        held = rows.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets, "id long, items array<long>")
        return written(held, "sets")

    def verify(pairs: DataFrame) -> DataFrame:
        def side(end: str) -> DataFrame:
            return classes.select(
                F.col("id").alias(end), F.col("sketch").alias(f"sketch_{end}"), F.col("n").alias(f"n_{end}")
            )

        near = (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
            .select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b")
            .mapInArrow(_likely(floor), "a long, b long")
        )
        near = written(near.distinct(), "likely")
        sets = sets_of(near.select(F.col("a").alias("id")).union(near.select("b")))
        both = near.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b"
        )
        common = F.size(F.array_intersect("items_a", "items_b"))
        union = F.size("items_a") + F.size("items_b") - F.col("common")
        return (
            both.withColumn("common", common)
            .where(100 * F.col("common") >= percent * union)
            .select("a", "b")
            .distinct()
        )

    def cross(members: DataFrame) -> DataFrame:
        known = classes.select("id", "n", "sketch")
        sized = members.join(classes.select("id", "n"), "id")
        need = F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum("n") / BLOCK_SHINGLES)
        blocks = sized.groupBy("key").agg(F.ceil(need).cast("long").alias("blocks"))
        dealt = (
            members.join(blocks, "key")
            .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("key", "id", "component", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
        )
        return (
            dealt.join(known.join(sets_of(members), "id"), "id")
            .groupBy("key", "i", "j")
            .applyInArrow(lambda table: _block_links(table, floor, percent), "a long, b long")
        )

    labels = link_buckets(buckets, verify, cross)
    named = classes.select("set_high", "set_low", "id").join(labels, "id", "left").select(
        "set_high", "set_low", F.coalesce("component", "id").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        sketched.select("doc_id", "n_shingles", "set_high", "set_low")
        .join(named, ["set_high", "set_low"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), percent=85)
