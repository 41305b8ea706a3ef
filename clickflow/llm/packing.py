"""Pack token sequences into windows of one capacity by multiway differencing.

Every document is encoded and cut into whole windows and a rest. Rests are packed block by block: each
rest starts as a partial partition of all windows of the block; the two partitions with the widest
imbalance are merged, largest sums against smallest, until one is left. Its windows are nearly equal.
If the fullest exceeds the capacity, the block gets one more window and starts again.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import documents, written
from clickflow.llm.tokens import encoder, id_lists, slices, texts_of

CAPACITY = 2048
BLOCK_PIECES = 1024
#: Rests are cut into pieces of at most this many tokens: with several pieces a window, differencing
#: comes close to the mean. Longer pieces break fewer texts and leave more padding.
REST_TOKENS = 512


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The item numbers of each of ``windows`` groups with nearly equal sums."""
    left: list[int] = []
    right: list[int] = []
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, dtype=np.int64)
        nodes = np.full(windows, -1, dtype=np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-size if windows > 1 else 0, i, sums, nodes))
    heapq.heapify(heap)
    n = serial = len(sizes)
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        sums = a + b[::-1]
        other = b_nodes[::-1]
        nodes = np.where(a_nodes >= 0, a_nodes, other)
        for slot in np.flatnonzero((a_nodes >= 0) & (other >= 0)):
            left.append(int(a_nodes[slot]))
            right.append(int(other[slot]))
            nodes[slot] = n + len(left) - 1
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums -= sums[-1]
        heapq.heappush(heap, (-int(sums[0]), serial, sums, nodes))
        serial += 1
    groups = []
    for node in heap[0][3] if heap else []:
        items, stack = [], [int(node)] if node >= 0 else []
        while stack:
            x = stack.pop()
            if x < n:
                items.append(x)
            else:
                stack += (left[x - n], right[x - n])
        groups.append(sorted(items))
    return groups


def fit_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Differencing with the fewest windows that hold; one item per window always does."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, windows)
        if all(sum(sizes[i] for i in g) <= capacity for g in groups):
            return [g for g in groups if g]
        windows += 1


def _cut(length: int, capacity: int, rest_tokens: int) -> list[tuple[int, int]]:
    whole = length // capacity * capacity
    cuts = [(s, capacity) for s in range(0, whole, capacity)]
    return cuts + [(s, min(rest_tokens, length - s)) for s in range(whole, length, rest_tokens)]


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, rest_tokens: int, added: bool = False
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids``: each id of each document in exactly one piece."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, False, added)
        for part in slices(batches):
            rows, packed = [], []
            for doc_id, ids in zip(
                part.column(0).to_pylist(), enc.encode(texts_of(part.column(1))), strict=True
            ):
                ids += end
                total = len(ids) // 4
                for start, length in _cut(total, capacity, rest_tokens):
                    rows.append((doc_id, start, length, total))
                    packed.append(ids[4 * start : 4 * (start + length)])
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*columns, id_lists(packed)], ["doc_id", "start", "length", "doc_tokens", "ids"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, ids array<int>"
    )


def _placements(rests: DataFrame, capacity: int, block_pieces: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(ids: list[int], sizes: list[int]) -> pa.RecordBatch:
            out = []
            for group in fit_windows(sizes, capacity):
                first, offset = ids[group[0]], 0
                for i in group:
                    out.append((ids[i], 2 * first + 1, offset))
                    offset += sizes[i]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["piece_id", "sequence_id", "offset"]
            )

        ids: list[int] = []
        sizes: list[int] = []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            sizes += batch.column(1).to_pylist()
            while len(ids) >= block_pieces:
                yield block(ids[:block_pieces], sizes[:block_pieces])
                del ids[:block_pieces], sizes[:block_pieces]
        if ids:
            yield block(ids, sizes)

    return rests.mapInArrow(run, "piece_id long, sequence_id long, offset long")


def _joined(pieces: DataFrame, placed: DataFrame, *payload: str) -> DataFrame:
    return pieces.join(placed, "piece_id", "left").select(
        "doc_id", "start", "length", "doc_tokens", *payload,
        F.coalesce("sequence_id", 2 * F.col("piece_id")).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).alias("offset"),
    )


def pieces_and_placements(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    rest_tokens: int = REST_TOKENS,
    block_pieces: int = BLOCK_PIECES,
    added: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The numbered pieces of all documents, and the window and offset of every rest.

    Pieces are written once, so that texts are encoded once; only piece numbers and lengths are
    shuffled for packing.
    """
    pieces = written(
        token_pieces(docs, tokenizer, end_id, capacity, rest_tokens, added).withColumn(
            "piece_id", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rests = (
        pieces.where(F.col("length") < capacity)
        .select("piece_id", "length")
        .repartition(spread, F.xxhash64("piece_id"))
        .sortWithinPartitions("piece_id")
    )
    return pieces, written(_placements(rests, capacity, block_pieces), "placements")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    rest_tokens: int = REST_TOKENS,
    block_pieces: int = BLOCK_PIECES,
    added: bool = False,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids, sequence_id, offset`` for every piece of ``doc_id, text``.

    ``sequence_id`` is unique, not dense: twice the number of the window's first piece, plus one if
    the window holds rests. Offsets in a window are gapless from 0. A null text is the end id alone; a
    null or repeated ``doc_id`` is kept like any other; an empty table gives no row; other columns are
    not read. With ``added``, strings of the file's added tokens get those tokens' ids.
    """
    pieces, placed = pieces_and_placements(docs, tokenizer, end_id, capacity, rest_tokens, block_pieces, added)
    return _joined(pieces, placed, "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.num_columns - 1)
        offsets = ids.offsets.to_numpy()
        data = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        names = [*batch.schema.names[:-1], "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names)


def pack_digests(docs: DataFrame, tokenizer: str, end_id: int, added: bool = False) -> DataFrame:
    """Like ``pack``, with the checksum of each piece's ids instead of the ids, taken before the join."""
    pieces, placed = pieces_and_placements(docs, tokenizer, end_id, added=added)
    sums = pieces.select("doc_id", "start", "length", "doc_tokens", "piece_id", "ids").mapInArrow(
        _checksums,
        "doc_id long, start long, length long, doc_tokens long, piece_id long, ids_crc32 long",
    )
    return _joined(sums, placed, "ids_crc32")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, added=True)
