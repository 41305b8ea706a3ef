"""Web-server access logs in the common log format."""

from __future__ import annotations

from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickflow.operators.checks import keep_or_raise

# The grammar of an access-log line and its columns. The pattern is anchored at the
# start only, so text after the size (combined format) is accepted. It has no capturing groups,
# which halves the cost of a match.
LOG_PATTERN = r'^\S+ \S+ \S+ \[[\w:/]+\s[+\-]\d{4}\] "\S+ \S+ \S+" \d{3} \d+'
LOG_COLUMNS = {
    "ipAddress": "string",
    "clientIdented": "string",
    "userId": "string",
    "dateTime": "string",
    "method": "string",
    "endpoint": "string",
    "protocol": "string",
    "responseCode": "int",
    "contentSize": "bigint",
}


def valid_log_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that match the grammar; a ``-`` for the size does not."""
    return lines.where(F.col(column).rlike(LOG_PATTERN))


def access_log(
    lines: DataFrame, column: str = "value", on_bad: Literal["fail", "drop"] = "fail"
) -> DataFrame:
    """The nine typed columns of every valid line; other lines are left out.

    A valid line whose size exceeds 64 bits stops the job, or is left out with ``on_bad="drop"``.

    The regular expression runs once per line and yields the matched text, or nothing. No field
    but the date holds a space, so the match is then cut at its spaces; the date has one white
    space, mostly a space too, and makes one or two pieces. A filter with nine ``regexp_extract``
    would run the expression ten times. The one-element explode keeps the optimizer from copying
    it into the filter and every column.
    """
    pieces = _pieces(lines, column).where(_whole())
    return _checked(pieces.select(*_typed()), on_bad)


_PIECES = "p"


def _whole() -> Column:
    """Are there enough pieces? An invalid line gives an empty match."""
    return F.size(_PIECES) >= len(LOG_COLUMNS)


def _accepted() -> Column:
    """A whole line whose size fits 64 bits; false for a null line."""
    size = F.try_element_at(_PIECES, F.lit(-1)).try_cast(LOG_COLUMNS["contentSize"])
    return F.coalesce(_whole() & size.isNotNull(), F.lit(False)).alias("valid")


def _pieces(lines: DataFrame, column: str, *keep: str) -> DataFrame:
    """Each line's match, cut at its spaces."""
    match = F.regexp_extract(F.col(column), LOG_PATTERN, 0)
    return lines.select(*keep, F.explode(F.array(F.split(match, " "))).alias(_PIECES))


def _typed() -> list[Column]:
    """The nine columns from the pieces of a valid line."""

    def first(i: int) -> Column:
        return F.get(_PIECES, F.lit(i))

    def last(i: int) -> Column:
        return F.try_element_at(_PIECES, F.lit(-i))

    def inside(text: Column, before: int, after: int) -> Column:
        return F.substring(text, F.lit(1 + before), F.length(text) - (before + after))

    date = F.when(F.size(_PIECES) == len(LOG_COLUMNS), first(3)).otherwise(
        F.concat_ws(" ", first(3), first(4))
    )
    texts = [
        first(0),
        first(1),
        first(2),
        inside(date, 1, 1),
        inside(last(5), 1, 0),
        last(4),
        inside(last(3), 0, 1),
        last(2),
        last(1),
    ]
    columns = [
        text if kind == "string" else text.try_cast(kind)
        for text, kind in zip(texts, LOG_COLUMNS.values(), strict=True)
    ]
    return [column.alias(name) for column, name in zip(columns, LOG_COLUMNS, strict=True)]


def _checked(rows: DataFrame, on_bad: Literal["fail", "drop"]) -> DataFrame:
    """The rows whose size fits 64 bits; another one stops the job or is left out."""
    if on_bad not in ("fail", "drop"):
        raise ValueError(f"on_bad must be 'fail' or 'drop', not {on_bad!r}")
    fits = F.col("contentSize").isNotNull()
    if on_bad == "fail":
        address = F.concat(F.lit("size beyond 64 bits in a line of "), F.col("ipAddress"))
        fits = keep_or_raise(fits, address)
    return rows.where(fits)


#: Names of the counts of ``counted_access_log``.
COUNTS = ("read", "valid", "rejected")


def _counts(valid: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(COUNTS[0]),
        F.count_if(valid).alias(COUNTS[1]),
        F.count_if(~valid).alias(COUNTS[2]),
    ]


def counted_access_log(lines: DataFrame, column: str = "value") -> tuple[DataFrame, Observation]:
    """``access_log`` with ``on_bad="drop"``, and the numbers of lines read, valid and rejected.

    The lines are counted as they pass by, in the same pass that parses them. The observation's ``get`` waits for the first
    action on the table and then gives ``read``, ``valid`` and ``rejected``; valid and rejected add up to read. A null line
    is a rejected one. On a stream, the counts of each batch are in the query's progress under ``access_log``.
    """
    observation = Observation("access_log")
    stream = lines.isStreaming
    rows = _pieces(lines, column).select(_PIECES, _accepted())
    seen = rows.observe("access_log" if stream else observation, *_counts(F.col("valid")))
    return seen.where("valid").select(*_typed()), observation


class SplitLog(NamedTuple):
    """``rows``: the valid lines' columns. ``rejects``: the other lines, in ``value``. ``counts``: read, valid, rejected."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def split_access_log(lines: DataFrame, path: str, column: str = "value") -> SplitLog:
    """Write valid and rejected lines to two folders below ``path`` in one pass of the text.

    Valid lines are written as their columns, rejected ones as they are; null lines stay null. A size beyond 64 bits is
    rejected. The path must be new.
    """
    spark = lines.sparkSession
    observation = Observation("split_access_log")
    parsed = _pieces(lines, column, column).select(F.col(column).alias("value"), _PIECES, _accepted())
    valid = F.col("valid")
    sorted_out = parsed.observe(observation, *_counts(valid)).select(
        F.when(~valid, F.col("value")).alias("value"), *[F.when(valid, c).alias(n) for c, n in zip(_typed(), LOG_COLUMNS, strict=True)], valid
    )
    sorted_out.write.partitionBy("valid").parquet(path)
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in LOG_COLUMNS.items())
    written = spark.read.schema(f"value string, {kinds}, valid boolean").parquet(path)
    return SplitLog(
        written.where("valid").select(*LOG_COLUMNS), written.where("not valid").select("value"), observation.get
    )
