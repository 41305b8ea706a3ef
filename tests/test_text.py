"""Tokenising, stop tokens, predicates."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickflow.operators import (
    STOP_TOKENS,
    drop_stop,
    lines_of,
    non_blank,
    top_by,
    word_count,
    words,
)
from tests.conftest import rows


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def jvm_split(line):
    """Java's ``split(" ")``: empty pieces at the end go, an empty line stays one piece."""
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a b", ["a", "b"]),
        ("a b  ", ["a", "b"]),
        (" a  b", ["", "a", "", "b"]),
        ("", [""]),
        ("   ", []),
        ("a\tb", ["a\tb"]),
        ("a\t ", ["a\t"]),
    ],
)
def test_words(spark, line, expected):
    assert [r.word for r in words(lines(spark, line)).collect()] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" ab,\t", max_size=8), min_size=1, max_size=30))
def test_words_follow_jvm_split(spark, texts):
    got = Counter(r.word for r in words(lines(spark, *texts)).collect())
    assert got == Counter(w for t in texts for w in jvm_split(t))


def test_words_skip_null_lines_and_keep_columns(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "id int, value string")
    assert rows(words(df, keep=["id"])) == [(1, "a"), (1, "b")]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("a\nb", ["a", "b"]), ("a\nb\n", ["a", "b"]), ("a\n\n", ["a", ""]), ("", [""]), ("\n", [""])],
)
def test_lines_of(spark, text, expected):
    assert [r.value for r in lines_of(lines(spark, text), "value").collect()] == expected


def test_stop_tokens_match_whole_words_only(spark):
    df = words(lines(spark, "one , two, ! three!"))
    assert rows(drop_stop(df, STOP_TOKENS)) == [("one",), ("three!",), ("two,",)]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_stop_table_broadcast_or_shuffled(spark, max_bytes):
    df = words(lines(spark, "one , two, ! three! , ,"))
    stop = spark.createDataFrame([(",",), ("!",), (",",)], "token string")
    kept = drop_stop(df, stop, max_bytes=max_bytes)
    assert rows(kept) == rows(drop_stop(df, [",", "!"]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (max_bytes > 0)
    assert ("SortMergeJoin" in plan) == (max_bytes == 0)


def test_word_count_is_64_bit(spark):
    counts = word_count(words(lines(spark, "a b a", "a")))
    assert counts.schema["cnt"].dataType.simpleString() == "bigint"
    assert rows(counts) == [("a", 3), ("b", 1)]


def test_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("d", 1), ("c", 2), ("b", 2), ("a", 1)], "word string, cnt long")
    assert [r.word for r in top_by(df, "cnt", "word", 3).collect()] == ["b", "c", "a"]


def test_non_blank_trims_like_the_jvm(spark):
    df = lines(spark, "", "  ", "\t", " \r\x01 ", " x ", None, "\u00a0")
    assert rows(non_blank(df, "value")) == [(" x ",), ("\u00a0",)]


def test_top_is_not_a_full_sort(spark):
    df = word_count(words(lines(spark, "a b")))
    plan = top_by(df, "cnt", "word", 3)._jdf.queryExecution().executedPlan().toString()
    assert re.search("TakeOrderedAndProject", plan)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_where_the_stop_join_sits(spark):
    counted = word_count(words(lines(spark, "a b a", "c . a")))
    stop = spark.createDataFrame([("a",), (".",)], "word string")
    small = drop_stop(counted, stop, salt=0)
    large = drop_stop(counted, stop, salt=0, max_bytes=0)
    assert rows(small) == rows(large) == [("b", 1), ("c", 1)]
    # Sent to every executor, it drops words before they are counted; shuffled, it meets the counts. The
    # root of a plan is printed first.
    text = _plan(small)
    assert text.index("HashAggregate") < text.index("BroadcastHashJoin")
    text = _plan(large)
    assert text.index("SortMergeJoin") < text.index("HashAggregate")
