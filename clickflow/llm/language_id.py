"""Language identification by cross-parsing against suffix automata.

For every language a bounded sample of labelled text is turned into a suffix automaton, which follows any
substring of the sample. A text is parsed greedily: each phrase is the longest match from where the last
one ended. The fewer phrases, the closer the text is to the sample: with a pointer's cost of
``log2(sample size)`` bits per phrase, the language needing the fewest bits per letter wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickflow.llm.shared import documents, written

#: The bound of the labelled sample, per language: so many documents, so many characters from anywhere in each.
SAMPLE_DOCS = 64
DOC_CHARS = 1_024
#: Texts are parsed in blocks of so many symbols, side by side. A phrase ends with its block.
BLOCK = 1_024
UNKNOWN = "und"


@dataclass(frozen=True)
class Samples:
    """Sample text by language; small, and all a task needs to build the automata."""

    texts: tuple[tuple[str, str], ...]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _points(text: str) -> np.ndarray:
    """Code points of the lowered text, every run of other than letters as one 32."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.where(_letters()[points], points, np.uint32(32))
    blank = points == 32
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start. A path from it spells a substring of ``symbols``."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = moves[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return moves


class Parser:
    """The automaton of one language as a table: where a symbol leads, and how many phrases it ends.

    A symbol without a transition ends the open phrase and starts the next; one that the sample does not
    have is a phrase of its own.
    """

    def __init__(self, sample: str):
        points = _points(sample)
        self.alphabet = np.unique(points)
        self.width = len(self.alphabet) + 1  # the last: no symbol of the sample
        moves = suffix_automaton(np.searchsorted(self.alphabet, points).tolist())
        table = np.zeros((len(moves), self.width), dtype=np.int64)
        start = np.zeros(self.width, dtype=np.int64)
        for symbol, to in moves[0].items():
            start[symbol] = to * self.width
        table[:] = start * 4 + 1
        for state, known in enumerate(moves):
            for symbol, to in known.items():
                table[state, symbol] = to * self.width * 4
        table[1:, -1], table[0, -1] = 2, 1
        self.table = table.astype(np.int32 if table.max(initial=0) < 2**31 else np.int64).ravel()
        self.bits = math.log2(max(2, len(points)))

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        return np.where(known, at, self.width - 1).astype(np.int32)

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases in each row of symbols; rows are ordered from the longest to the shortest."""
        count = np.zeros(len(blocks), dtype=np.int64)
        state = np.zeros(len(blocks), dtype=self.table.dtype)
        columns = np.ascontiguousarray(blocks.T)
        active = len(blocks)
        for i in range(blocks.shape[1]):
            while active and lengths[active - 1] <= i:
                active -= 1
            if not active:
                break
            found = self.table[state[:active] + columns[i, :active]]
            count[:active] += found & 3
            state[:active] = found >> 2
        return count + (state > 0)


_PARSERS: dict[Samples, list[tuple[str, Parser]]] = {}


def parsers(samples: Samples) -> list[tuple[str, Parser]]:
    """Built once per worker process."""
    if samples not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[samples] = [(lang, Parser(text)) for lang, text in samples.texts]
    return _PARSERS[samples]


def costs(texts: list[str | None], models: list[tuple[str, Parser]], block: int = BLOCK) -> np.ndarray:
    """Bits per symbol of each text (row) under each language (column); NaN without a letter."""
    points = [_points(t or "") for t in texts]
    sizes = np.array([len(p) for p in points])
    spelled = np.array([bool((p != 32).any()) for p in points], dtype=bool)
    pieces = [(i, p[s : s + block]) for i, p in enumerate(points) for s in range(0, len(p), block)]
    pieces.sort(key=lambda x: -len(x[1]))
    owner = np.array([i for i, _ in pieces], dtype=np.int64)
    lengths = np.array([len(p) for _, p in pieces], dtype=np.int64)
    out = np.full((len(texts), len(models)), np.nan)
    if not len(pieces):
        return out
    flat = np.concatenate([p for _, p in pieces])
    distinct, inverse = np.unique(flat, return_inverse=True)
    inside = np.arange(lengths[0])[None, :] < lengths[:, None]
    for k, (_, parser) in enumerate(models):
        blocks = np.zeros(inside.shape, dtype=np.int32)
        blocks[inside] = parser.symbols(distinct)[inverse]
        total = np.bincount(owner, weights=parser.phrases(blocks, lengths), minlength=len(texts))
        out[spelled, k] = total[spelled] * parser.bits / sizes[spelled]
    return out


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents that fitting never sees."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(
    labelled: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    doc_chars: int = DOC_CHARS,
) -> Samples:
    """Samples of ``doc_id, text, lang``: per language the documents with the smallest hashes of ``doc_id``.

    Bounded by the parameters: per language ``sample_docs`` documents and ``doc_chars`` characters of each, from a place
    that a hash of ``doc_id`` gives. The ranking keeps that many rows per language and task before its
    shuffle and reads no text; it is written, so that texts are only shuffled to it if its measured size is beyond Spark's
    limit for a broadcast. Null texts, languages and ids take no part. No language: an empty model.
    """
    named = labelled.where("lang is not null and text is not null and doc_id is not null")
    hashed = F.xxhash64("doc_id")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "doc_id"))
    ranked = named.select("doc_id", "lang", rank.alias("rank")).where(F.col("rank") <= sample_docs)
    chosen = written(ranked.select("doc_id", "lang").distinct(), "chosen")
    places = F.greatest(F.length("text") - doc_chars + 1, F.lit(1))
    start = F.pmod(F.xxhash64("doc_id", F.lit("place")), places.cast("long")).cast("int") + 1
    rows = (
        named.select("doc_id", "lang", "text")
        .join(chosen, ["doc_id", "lang"], "left_semi")
        .select("doc_id", "lang", F.substring(F.col("text"), start, F.lit(doc_chars)).alias("text"))
        .distinct()
        .collect()
    )
    texts: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        texts[row["lang"]] = texts.get(row["lang"], "") + row["text"] + "\n"
    return Samples(tuple(sorted(texts.items())))


def verdicts(texts: list[str | None], samples: Samples) -> tuple[list[str], list[float]]:
    """Language and score of each text. The score is how far the second best language is behind, 0 to 1."""
    models = parsers(samples)
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not models:
        return names, scores
    for i, row in enumerate(costs(texts, models)):
        if np.isnan(row[0]):
            continue
        order = np.argsort(row, kind="stable")
        names[i] = models[order[0]][0]
        scores[i] = 1.0 if len(order) == 1 else float(1 - row[order[0]] / row[order[1]])
    return names, scores


def predict(docs: DataFrame, samples: Samples) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred`` and ``score`` of its ``text``; no other column is an input.

    ``und`` with score 0 for a null text or one without a letter, or if the model is empty. Equal costs
    go to the language first in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                names, scores = verdicts(part.column(1).to_pylist(), samples)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["row", "lang_pred", "score"],
                )

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    samples = fit(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text")
    return predict(rows, samples).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )
