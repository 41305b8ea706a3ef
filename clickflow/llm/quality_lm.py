"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model predicts a character from the three before it. N-grams are exact, of any characters, and their tables
grow with the text. Counts, continuation counts, context totals, discounts and probabilities are groupings and
joins sharded by n-gram, over every n-gram that any document holds. Log probabilities go back to the documents in two
ways: those of the n-grams most frequent among all documents, up to a fixed number, are sent to the tasks; every other
n-gram of a document is a row that is joined by n-gram and summed. Being infrequent, none of these is a
hot key.

Half of the trusted documents make the model. Accepted perplexities come from quantiles per language: the upper end
from the other half, which the model has not seen, the lower end from both. A mean over ``n`` characters
spreads by ``1 / sqrt(n)``, so quantiles are of the distance from the language's median times ``sqrt(n)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from clickflow.llm.shared import documents, written

ORDER = 4
#: A symbol is a code point plus one, 0 standing before a text. Two of them make a half of an n-gram.
_BITS = 21
_MASK = (1 << _BITS) - 1
LOW_QUANTILE, HIGH_QUANTILE = 0.005, 0.995
#: Languages with fewer trusted documents outside the model take the quantiles of all.
MIN_TRUSTED = 50
ACCURACY = 10_000
#: At most so many n-grams are sent to every task, 28 bytes each.
SENT_GRAMS = 1 << 20
_SLICE_CHARS = 4 << 20
_SLICE_DOCS = 1_024
_GRAM = "head long, tail long"


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, str, str]]]:
    """``(text, up to three characters before, characters)`` in lists of bounded size; long texts come in several."""
    found: list[tuple[int, str, str]] = []
    room = _SLICE_CHARS
    for i, text in enumerate(texts):
        at = 0
        while at < len(text or ""):
            body = text[at : at + room]
            found.append((i, text[max(0, at - ORDER + 1) : at], body))
            at += len(body)
            room -= len(body)
            if not room:
                yield found
                found, room = [], _SLICE_CHARS
    if found:
        yield found


def distinct_grams(pieces: list[tuple[int, str, str]]) -> tuple[np.ndarray, ...]:
    """Halves of the distinct n-grams of the pieces; for each character its n-gram's place among them and its text."""
    joined = "".join(part for _, lead, body in pieces for part in (lead.rjust(ORDER - 1, "\0"), body))
    symbols = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4") + np.uint32(1)
    sizes = np.array([len(body) for _, _, body in pieces])
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER - 1)[:-1]])
    ends = np.ones(len(symbols), dtype=bool)
    leads = np.array([len(lead) for _, lead, _ in pieces])
    for i in range(ORDER - 1):
        ends[starts + i] = False
        symbols[starts[leads < ORDER - 1 - i] + i] = 0
    at = np.flatnonzero(ends)
    present = np.zeros(_MASK + 1, dtype=bool)
    present[symbols] = True
    alphabet = np.flatnonzero(present)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if ORDER * bits <= 64:
        kind = np.uint32 if ORDER * bits <= 32 else np.uint64
        number = np.zeros(_MASK + 1, dtype=kind)
        number[alphabet] = np.arange(len(alphabet), dtype=kind)
        local = number[symbols]
        keys = np.zeros(len(at), dtype=kind)
        for i in reversed(range(ORDER)):
            keys = (keys << kind(bits)) | local[at - i]
        keys, place = np.unique(keys, return_inverse=True)
        parts = [
            alphabet[(keys >> kind(bits * i)) & kind((1 << bits) - 1)].astype(np.int64) for i in reversed(range(ORDER))
        ]
        head, tail = parts[0] << _BITS | parts[1], parts[2] << _BITS | parts[3]
    else:  # more symbols than 64 bits have room for: pairs are numbered first
        pairs = symbols[:-1].astype(np.int64) << _BITS | symbols[1:]
        pairs, number = np.unique(pairs, return_inverse=True)
        keys, place = np.unique(number[at - 3].astype(np.int64) << 32 | number[at - 1], return_inverse=True)
        head, tail = pairs[keys >> 32], pairs[keys & 0xFFFFFFFF]
    return head, tail, place, np.repeat([i for i, _, _ in pieces], sizes)


def gram_counts(texts: DataFrame) -> DataFrame:
    """``head, tail, n, n_all`` of ``text, fit``: how often the n-gram is met in texts to fit, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE_DOCS):
                part = batch.slice(start, _SLICE_DOCS)
                fit = part.column(1).to_numpy(zero_copy_only=False).astype(float)
                for pieces in _pieces(part.column(0).to_pylist()):
                    head, tail, place, owner = distinct_grams(pieces)
                    n = np.bincount(place, weights=fit[owner], minlength=len(head)).astype(np.int64)
                    counts = [head, tail, n, np.bincount(place, minlength=len(head))]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, counts)), ["head", "tail", "n", "n_all"])

    counted = texts.select("text", "fit").mapInArrow(run, f"{_GRAM}, n long, n_all long")
    return counted.groupBy("head", "tail").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def _suffix(order: int) -> tuple[Column, Column]:
    """Key of the last ``order`` symbols."""
    head, tail = F.col("head"), F.col("tail")
    nothing = F.lit(0).cast("long")
    if order <= 2:
        return nothing, tail if order == 2 else tail.bitwiseAND(F.lit(_MASK))
    return head.bitwiseAND(F.lit(_MASK)), tail


def _discounts(grams: DataFrame) -> list[float]:
    row = grams.agg(*(F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in range(1, 5))).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in range(1, 5))
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]  # too little text to fit them
    y = n1 / (n1 + 2 * n2)
    fitted = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(fitted, 1)]


def log_probabilities(grams: DataFrame) -> DataFrame:
    """``head, tail, n_all, log``: natural logarithm of the probability of each n-gram's last symbol.

    ``grams`` as ``gram_counts`` gives them; those with ``n`` 0 make no part of the model and get their probability from
    shorter ones. The characters of the texts to fit and one for all others are equally likely before any is seen.
    """
    orders = [grams]
    for order in range(ORDER - 1, 0, -1):
        met = F.count(F.when(F.col("n") > 0, 1)).alias("n")
        head, tail = _suffix(order)
        orders.append(written(orders[-1].groupBy(head.alias("head"), tail.alias("tail")).agg(met), "ngrams"))
    symbols = orders[-1].where("n > 0").count() + 1
    lower = None
    for order, counts in enumerate(reversed(orders), 1):
        d1, d2, d3 = _discounts(counts)
        n = F.col("n")
        discount = F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        # A context has one row per symbol at most, so no key of these joins is hot.
        named = counts.withColumns(
            {
                "context_head": F.col("head"),
                "context_tail": F.shiftright("tail", _BITS),
                "discount": discount,
            }
        )
        contexts = named.groupBy("context_head", "context_tail").agg(
            F.sum("n").alias("total"), F.sum("discount").alias("spared")
        )
        joined = named.join(contexts, ["context_head", "context_tail"])
        if lower is None:
            joined = joined.withColumn("p_lower", F.lit(1.0 / symbols))
        else:
            head, tail = _suffix(order - 1)
            joined = joined.withColumns({"lower_head": head, "lower_tail": tail}).join(
                lower, ["lower_head", "lower_tail"]
            )
        seen = F.col("total") > 0
        p = F.when(seen, (n - F.col("discount") + F.col("spared") * F.col("p_lower")) / F.col("total")).otherwise(
            F.col("p_lower")
        )
        if order == ORDER:
            return written(joined.select("head", "tail", "n_all", F.log(p).alias("log")), "logs")
        lower = written(
            joined.select(F.col("head").alias("lower_head"), F.col("tail").alias("lower_tail"), p.alias("p_lower")),
            "shares",
        )


def _mixed(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    mixed = head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed + tail.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Sent:
    """Log probabilities of the most frequent n-grams, in the order of a hash."""

    mixed: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    logs: np.ndarray

    def find(self, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """NaN for an n-gram that is not among them."""
        if not len(self.mixed):
            return np.full(len(head), np.nan)
        mixed = _mixed(head, tail)
        at = np.minimum(np.searchsorted(self.mixed, mixed), len(self.mixed) - 1)
        return np.where((self.head[at] == head) & (self.tail[at] == tail), self.logs[at], np.nan)


def _most_frequent(logs: DataFrame, most: int) -> Sent:
    """At most ``most`` n-grams: all beyond a count, which a histogram of counts gives."""
    step = F.floor(F.log2("n_all") * 16).cast("int")
    steps = logs.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in steps:
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    chosen = logs.where(step >= least) if least is not None else logs.limit(0)
    table = chosen.select("head", "tail", "log").toArrow()
    head, tail, values = (table.column(i).to_numpy() for i in range(3))
    # Of n-grams with one hash the first is sent; the others are joined like infrequent ones.
    mixed, first = np.unique(_mixed(head, tail), return_index=True)
    return Sent(mixed, head[first], tail[first], values[first])


def perplexity(docs: DataFrame, logs: DataFrame, sent_grams: int = SENT_GRAMS) -> DataFrame:
    """``doc_id, lang, digest, size, log_perplexity`` of every row of ``docs``: the mean negative log probability of a
    character of ``text``. Null for a null text and one of white space only.

    ``logs`` holds every n-gram of ``docs``, as ``log_probabilities`` gives them. ``digest`` is the text's MD5, ``size`` its characters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_most_frequent(logs, sent_grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE_DOCS):
                part = batch.slice(start, _SLICE_DOCS)
                texts = [None if t is None or not t or t.isspace() else t for t in part.column(1).to_pylist()]
                sums = np.zeros(len(texts))
                rest: list[tuple[np.ndarray, ...]] = []
                for pieces in _pieces(texts):
                    head, tail, place, owner = distinct_grams(pieces)
                    found = sent.find(head, tail)
                    missing = np.isnan(found)
                    sums += np.bincount(owner, weights=np.where(missing, 0.0, found)[place], minlength=len(texts))
                    left = missing[place]
                    pairs, n = np.unique(owner[left] * len(head) + place[left], return_counts=True)
                    rest.append((pairs // len(head), head[pairs % len(head)], tail[pairs % len(head)], n))
                if not rest:
                    rest = [tuple(np.zeros(0, dtype=np.int64) for _ in range(4))]
                owner, *fields = (np.concatenate(column) for column in zip(*rest, strict=True))
                order = np.argsort(owner, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
                entries = pa.StructArray.from_arrays([pa.array(f[order]) for f in fields], ["head", "tail", "n"])
                columns = [
                    part.column(0),
                    pa.array([len(t) if t else None for t in texts], pa.int64()),
                    pa.array(sums),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", "size", "known", "rest"])

    text = F.col("text").cast("string")
    # The identifiers are fixed by writing the table.
    keys = F.struct(F.monotonically_increasing_id().alias("place"), "doc_id", "lang", F.md5(text).alias("digest"))
    rows = docs.select(keys.alias("row"), text.alias("text"))
    schema = StructType([rows.schema["row"]]).add("size", "long").add("known", "double")
    schema = schema.add("rest", ArrayType(StructType().add("head", "long").add("tail", "long").add("n", "long")))
    scored = written(rows.mapInArrow(run, schema), "scored")
    others = (
        scored.select("row.place", F.explode("rest").alias("gram"))
        .select("place", "gram.*")
        .join(logs.select("head", "tail", "log"), ["head", "tail"])
        .groupBy("place")
        .agg(F.sum(F.col("n") * F.col("log")).alias("others"))
    )
    total = F.col("known") + F.coalesce("others", F.lit(0.0))
    return (
        scored.select("row.*", "size", "known")
        .join(others, "place", "left")
        .select("doc_id", "lang", "digest", "size", (-total / F.col("size")).alias("log_perplexity"))
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` with a label of good quality and none of toxic or bad."""
    return (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .where("quality = 1 and toxic = 0")
        .select("doc_id")
    )


def fitted(doc_id: Column) -> Column:
    """The half of the documents whose trusted ones make the model."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0


def marked_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, fit`` of all documents. Labels grow with the documents, so both are shuffled, at any size."""
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    to_fit = trusted_ids(labels).where(fitted(F.col("doc_id"))).withColumn("fit", F.lit(True))
    known = texts.where("doc_id is not null").join(to_fit.hint("merge"), "doc_id", "left")
    unknown = texts.where("doc_id is null").withColumn("fit", F.lit(False))
    return known.unionByName(unknown).select("text", F.coalesce("fit", F.lit(False)).alias("fit"))


def ranges(trusted: DataFrame) -> DataFrame:
    """``range_lang, mid, low, high`` of ``lang, size, log_perplexity, unseen``; the null language is for all others.

    ``low`` and ``high`` are distances from ``mid`` times the root of ``size``. Without unseen documents, the others stand in.
    """
    score = F.col("log_perplexity")
    unseen = F.col("unseen")

    def quantile(value: Column, share: float) -> Column:
        return F.coalesce(
            F.percentile_approx(F.when(unseen, value), share, ACCURACY), F.percentile_approx(value, share, ACCURACY)
        )

    scored = trusted.where("log_perplexity is not null")
    every = scored.withColumns({"own": F.lit(False), "lang": F.lit(None).cast("string")})
    scored = scored.where("lang is not null").withColumn("own", F.lit(True)).unionByName(every)
    mids = (
        scored.groupBy("own", F.col("lang").alias("range_lang"))
        .agg(quantile(score, 0.5).alias("mid"), F.count(F.when(unseen, 1)).alias("n"))
        .where(f"not own or n >= {MIN_TRUSTED}")
        .withColumnRenamed("own", "range_own")
    )
    apart = (score - F.col("mid")) * F.sqrt("size")
    return (
        scored.join(mids, (F.col("own") == F.col("range_own")) & F.col("lang").eqNullSafe(F.col("range_lang")))
        .groupBy("range_lang", "mid")
        .agg(
            F.percentile_approx(apart, LOW_QUANTILE, ACCURACY).alias("low"),
            quantile(apart, HIGH_QUANTILE).alias("high"),
        )
    )


def verdicts(docs: DataFrame, labels: DataFrame, sent_grams: int = SENT_GRAMS) -> DataFrame:
    """``doc_id, lang, digest, log_perplexity, low, high, kept``, a row for each of ``docs`` (doc_id, lang, text).

    ``labels`` has doc_id, quality and toxic. A document is kept if its log perplexity lies within its language's
    range for its length; a language that is null or has few trusted documents takes the range of all.
    Null and blank texts are not kept. Rows that repeat are judged alike. Without any trusted document, every
    text that is not blank is kept. Empty tables give an empty one.
    """
    logs = log_probabilities(written(gram_counts(marked_texts(docs, labels)), "ngrams"))
    scores = written(perplexity(docs, logs, sent_grams), "scores")
    trusted = scores.join(trusted_ids(labels), "doc_id", "left_semi").withColumn("unseen", ~fitted(F.col("doc_id")))
    found = written(ranges(trusted.select("lang", "size", "log_perplexity", "unseen")), "ranges")
    every = found.where("range_lang is null").first()
    own = found.where("range_lang is not null")

    def limit(name: str, default: float) -> Column:
        return F.coalesce(name, F.lit(every[name] if every else default))

    score, root, mid = F.col("log_perplexity"), F.sqrt("size"), limit("mid", 0.0)
    return (
        scores.join(own, F.col("lang") == F.col("range_lang"), "left")
        .select(
            "doc_id",
            "lang",
            "digest",
            "log_perplexity",
            (mid + limit("low", float("-inf")) / root).alias("low"),
            (mid + limit("high", float("inf")) / root).alias("high"),
        )
        .withColumn("kept", F.coalesce(score.between(F.col("low"), F.col("high")), F.lit(False)))
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``: doc_id, text, lang and any more), ``log_perplexity, low, high, kept``.

    Joins each row with its verdict, as ``verdicts`` describes them. Columns may have any names.
    """
    keys = ["doc_id", "lang", "digest"]
    found = verdicts(docs.select("doc_id", "lang", "text"), labels).dropDuplicates(keys)
    found = found.select(F.struct(*keys).alias("key"), "log_perplexity", "low", "high", "kept")
    digest = F.md5(F.col("text").cast("string")).alias("digest")
    rows = docs.select(F.struct("*").alias("row"), F.struct("doc_id", "lang", digest).alias("row_key"))
    joined = rows.join(found, F.col("row_key").eqNullSafe(F.col("key")))
    return joined.select("row", "log_perplexity", "low", "high", "kept")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    return verdicts(docs, labels).select(
        "doc_id", "lang", F.round("log_perplexity", 6).alias("log_perplexity"), "low", "high", "kept"
    )
