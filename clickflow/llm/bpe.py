"""Byte-level BPE over a whole corpus: each distinct word is merged once.

Documents are split into pre-tokens block by block. A pre-token that is itself a token has its id at
once. The others get numbers within their block, in the order of their hash buckets; their positions stay
with the block as number sequences. Each block sends its distinct words to the buckets, where
every distinct word of the corpus is merged once; the ids go back to the blocks and take the place of
the numbers. Blocks lie in a bucketed table, so that only words and their ids are shuffled.

Words travel packed, one row per block and bucket. A bucket's task keeps the distinct words of that
bucket alone; use more ``buckets`` for a larger vocabulary. A word met in every block is one entry per
block, however often it occurs.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import documents
from clickflow.llm.tokens import id_lists, slices, splitter, texts_of
from clickflow.scratch import fresh_dir, fresh_table

BLOCK_CHARS = 8 << 20
#: Rows of a block that are no words: its documents, and the numbers that theirs stand for.
_DOCUMENT, _NUMBERS = -1, -2


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


_READ: dict[tuple[str, str], object] = {}


def _once(kind: str, path: str, make):
    """Per worker process: the tables of a vocabulary file, whose size is fixed."""
    if (kind, path) not in _READ:
        _READ[kind, path] = make()
    return _READ[kind, path]


def _known_words(path: str) -> dict[str, int]:
    known = {}
    for token, rank in read_ranks(path).items():
        try:
            known[token.decode()] = rank
        except UnicodeDecodeError:  # part of a character; no text has it as a pre-token
            continue
    return known


def pack_ragged(items: list[bytes]) -> bytes:
    """Byte strings as one compressed string: their number, their lengths, their content."""
    lengths = np.array([len(items), *map(len, items)], dtype="<u4")
    return zstandard.compress(lengths.tobytes() + b"".join(items), 3)


def unpack_ragged(data: bytes) -> tuple[np.ndarray, bytes]:
    """Lengths, and the content as one string."""
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    return np.frombuffer(raw, "<u4", n, 4), raw[4 * (n + 1) :]


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte by byte: all lowest bytes first, the mostly empty highest ones last."""
    return zstandard.compress(numbers.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


class _Block:
    """The documents of one block: pre-tokens as vocabulary ids or numbers of the block's own words."""

    def __init__(self, known: dict[str, int], limit: int):
        self.known, self.limit = known, limit
        self.code: dict[str, int] = {}
        self.own: list[bytes] = []
        self.docs: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.chars = 0

    def add(self, doc_id: int | None, words: list[str], chars: int) -> None:
        code, known = self.code, self.known
        for word in set(words).difference(code):
            rank = known.get(word)
            if rank is None:
                rank = self.limit + len(self.own)
                self.own.append(word.encode())
            code[word] = rank
        self.docs.append(np.fromiter(map(code.__getitem__, words), dtype="<u4", count=len(words)))
        self.doc_ids.append(doc_id)
        self.chars += chars

    def rows(self, block: int, buckets: int) -> Iterator[tuple]:
        """``block, bucket, doc_id, body``: words by bucket, then documents.

        A document's numbers are places in the list of the block's numbers by falling frequency, so that most fit one byte.
        """
        place = np.fromiter(map(zlib.crc32, self.own), dtype=np.uint32, count=len(self.own)) % buckets
        order = np.argsort(place, kind="stable")
        number = np.empty(len(order), dtype="<u4")
        number[order] = np.arange(self.limit, self.limit + len(order), dtype="<u4")
        for members in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            if len(members):
                words = [self.own[i] for i in members.tolist()]
                yield block, int(place[members[0]]), None, pack_ragged(words)
        counts = np.zeros(self.limit + len(self.own), dtype=np.int64)
        for codes in self.docs:
            np.add.at(counts, codes, 1) if len(codes) < 1_000 else np.add(
                counts, np.bincount(codes, minlength=len(counts)), out=counts
            )
        by_count = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
        rank = np.empty(len(counts), dtype="<u4")
        rank[by_count] = np.arange(len(by_count), dtype="<u4")
        own = by_count >= self.limit
        by_count[own] = number[by_count[own] - self.limit]
        yield block, _NUMBERS, None, _pack_numbers(by_count.astype("<u4"))
        for doc_id, codes in zip(self.doc_ids, self.docs, strict=True):
            yield block, _DOCUMENT, doc_id, _pack_numbers(rank[codes])


_BLOCK_ROWS = "block long, bucket int, doc_id long, body binary"


def _blocks(docs: DataFrame, ranks: str, buckets: int, block_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _once("known", ranks, lambda: _known_words(ranks))
        limit = max(known.values()) + 1
        split = splitter(True)
        task = TaskContext.get().partitionId() << 32
        names = ["block", "bucket", "doc_id", "body"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]

        def flush(full: _Block) -> Iterator[pa.RecordBatch]:
            rows = full.rows(task + number, buckets)
            while part := list(itertools.islice(rows, 1024)):
                columns = [pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

        block, number = _Block(known, limit), 0
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True):
                block.add(doc_id, split(text), len(text))
                if block.chars >= block_chars:
                    yield from flush(block)
                    block, number = _Block(known, limit), number + 1
        yield from flush(block)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _BLOCK_ROWS
    )


def _merge_words(words: DataFrame, ranks: str) -> DataFrame:
    """``block, bucket, body`` with the packed ids of each word instead of the words."""

    def merger():
        import tiktoken

        return tiktoken.Encoding(
            "words", pat_str=".+", mergeable_ranks=read_ranks(ranks), special_tokens={}
        )._encode_single_piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _once("merge", ranks, merger)
        current, memo = None, {}
        for batch in batches:
            bodies = []
            for bucket, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if bucket != current:
                    current, memo = bucket, {}
                lengths, raw = unpack_ragged(body)
                ids, counts, at = [], [], 0
                for length in lengths.tolist():
                    word = raw[at : at + length]
                    at += length
                    found = memo.get(word)
                    if found is None:
                        found = memo[word] = array("I", merge(word)).tobytes()
                    ids.append(found)
                    counts.append(len(found) // 4)
                joined = np.frombuffer(b"".join(ids), "<u4")
                bodies.append(_pack_numbers(np.concatenate([[len(counts)], counts, joined]).astype("<u4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bodies, pa.binary())], ["block", "bucket", "body"]
            )

    return words.mapInArrow(run, "block long, bucket int, body binary")


def _ragged_take(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values`` of the runs given by start and length, one run after the other."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return values[np.arange(len(shift)) + shift]


def _assemble(docs: pa.Table, words: pa.Table, limit: int) -> pa.Table:
    words = words.sort_by("bucket")
    found = [_unpack_numbers(body) for body in words.column("body").to_pylist()]
    lengths = np.concatenate([np.ones(limit, np.int64), *(f[1 : f[0] + 1].astype(np.int64) for f in found)])
    values = np.concatenate([np.arange(limit, dtype="<u4"), *(f[f[0] + 1 :] for f in found)])
    starts = np.cumsum(lengths) - lengths
    kinds = docs.column("bucket").to_numpy()
    (place,) = np.flatnonzero(kinds == _NUMBERS)
    numbers = _unpack_numbers(docs.column("body")[int(place)].as_py())
    docs = docs.filter(pa.array(kinds == _DOCUMENT))
    packed = []
    for body in docs.column("body").to_pylist():
        codes = numbers[_unpack_numbers(body)]
        packed.append(_ragged_take(starts[codes], lengths[codes], values).tobytes())
    return pa.table({"doc_id": docs.column("doc_id"), "ids": id_lists(packed)})


def encode(
    docs: DataFrame, ranks: str, buckets: int | None = None, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``doc_id`` and ``ids`` of ``doc_id, text`` by a file of ranks, without special tokens.

    A null text is an empty one and has no ids. Null and repeated ``doc_id`` are kept; an empty table gives
    no row; other columns are not read. ``buckets`` splits the distinct words (default: the shuffle
    partitions); a block holds ``block_chars`` of text or one task's input, whichever is less.
    """
    spark = docs.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or spread
    table = fresh_table(spark, "bpe")
    (
        _blocks(docs, ranks, buckets, block_chars)
        .write.bucketBy(spread, "block")
        .option("path", fresh_dir(spark, "bpe-blocks"))
        .option("compression", "none")  # bodies are compressed already
        .saveAsTable(table)
    )
    blocks = spark.table(table)
    words = (
        blocks.where("bucket >= 0")
        .select("block", "bucket", "body")
        .repartition(spread, "bucket")
        .sortWithinPartitions("bucket", "block")
    )
    merged = _merge_words(words, ranks)
    limit = max(read_ranks(ranks).values()) + 1

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        return _assemble(left, right, limit)

    return (
        blocks.where("bucket < 0")
        .groupBy("block")
        .cogroup(merged.groupBy("block"))
        .applyInArrow(assemble, "doc_id long, ids array<int>")
    )


def decode(tokens: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids, bytes``: each id joined to its bytes, in order.

    The table of token bytes has one row per token of the vocabulary file, so every task holds it; an id
    that the file does not have stops the job. A null list has no bytes.
    """

    return tokens.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(batches, ranks), "doc_id long, ids array<int>, bytes binary"
    )


def _byte_table(ranks: str) -> np.ndarray:
    known = read_ranks(ranks)
    table = np.full(max(known.values()) + 1, None, dtype=object)
    for token, rank in known.items():
        table[rank] = token
    return table


def _decoded(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    table = _once("bytes", ranks, lambda: _byte_table(ranks))
    for part in slices(batches):
        ids = part.column(1)
        found = table[ids.flatten().to_numpy(zero_copy_only=False)].tolist()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
        out = [b"".join(found[a:b]) for a, b in itertools.pairwise([0, *ends.tolist()])]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), ids, pa.array(out, pa.binary())], ["doc_id", "ids", "bytes"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(1)
        counts = pc.list_value_length(ids).cast(pa.int64())
        data = memoryview(ids.flatten().to_numpy().astype("<u4", copy=False)).cast("B")
        ends = [0, *np.cumsum(4 * counts.to_numpy()).tolist()]
        sums = [hashlib.sha256(data[a:b]).hexdigest() for a, b in itertools.pairwise(ends)]
        decoded = [hashlib.sha256(b).hexdigest() for b in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), counts, pa.array(sums, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # Decoded and digested in one pass over the ids.
    return encode(documents(spark, sf_dir), ranks).mapInArrow(
        lambda batches: _digests(_decoded(batches, ranks)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
