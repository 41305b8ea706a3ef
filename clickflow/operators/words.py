"""Lines, words and word counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators.salting import DEFAULT_SALT, salted_join
from clickflow.operators.sizes import DEFAULT_BROADCAST_BYTES, if_small

# The punctuation tokens that are not counted.
STOP_TOKENS = [",", ".", "#", "$", "!", "?", "@"]


def lines_of(df: DataFrame, column: str) -> DataFrame:
    """The lines of a multi-line text column, as a text file of them would give.

    One line feed at the very end does not start another line.
    """
    text = F.col(column)
    body = F.when(
        F.endswith(text, F.lit("\n")), F.substring(text, F.lit(1), F.length(text) - 1)
    ).otherwise(text)
    return df.select(F.explode(F.split(body, "\n")).alias("value"))


def words(lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The words between single spaces, with JVM ``split`` rules.

    Empty words at the start and in the middle count, those at the end do not; an empty line is one
    empty word, a line of spaces is none. ``keep`` names columns to repeat beside each word.
    """
    line = F.col(column)
    trimmed = F.rtrim(line)
    return lines.where((line == "") | (trimmed != "")).select(
        *keep, F.explode(F.split(trimmed, " ")).alias("word")
    )


def drop_stop(
    words: DataFrame,
    stop: Iterable[str] | DataFrame,
    column: str = "word",
    salt: int = DEFAULT_SALT,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Words that are no stop token. Only whole tokens match: ``,`` goes, ``word,`` stays.

    The list is written into the query. A table (its first column) is broadcast once per executor
    if its measured size allows; Spark then drops stop words where they are read, before any count.
    A larger table is joined by shuffling, with hot words salted. For counts, drop the stop words
    from the counts, with ``salt=0``: the join stays behind the count and meets each word once.
    """
    if not isinstance(stop, DataFrame):
        return words.where(~F.col(column).isin(list(stop)))
    table = stop.select(F.col(stop.columns[0]).alias(column)).distinct()
    small = if_small(table, max_bytes)
    if small is not None:
        return words.join(F.broadcast(small), column, "left_anti")
    # An anti join would be moved below a count, and so shuffle every raw word; an outer one stays.
    marked = salted_join(words, table.withColumn("_stop", F.lit(True)), [column], "left", salt)
    return marked.where(F.col("_stop").isNull()).drop("_stop")


def word_count(words: DataFrame, column: str = "word") -> DataFrame:
    return words.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
