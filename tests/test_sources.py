"""Scans and record layouts."""

from __future__ import annotations

import pytest

from clickflow import sources
from clickflow.sources import (
    access_log,
    csv_table,
    group_pairs,
    json_table,
    page_views,
    parquet_table,
    positional_table,
    text_lines,
    text_partition,
    track_log,
    valid_log_lines,
)
from clickflow.sources.access_log import LOG_COLUMNS
from tests.conftest import rows
from tests.test_text import lines

GOOD = '1.2.3.4 - bob [09/Mar/2031:17:45:12 +0530] "GET /q/shelf.txt HTTP/1.1" 200 8086'


def parsed(spark, *values):
    return [tuple(r) for r in access_log(lines(spark, *values)).collect()]


def test_log_line(spark):
    df = access_log(lines(spark, GOOD))
    assert dict(df.dtypes) == LOG_COLUMNS
    assert rows(df) == [
        ("1.2.3.4", "-", "bob", "09/Mar/2031:17:45:12 +0530", "GET", "/q/shelf.txt", "HTTP/1.1", 200, 8086)
    ]


def test_log_accepts_text_after_the_size(spark):
    assert parsed(spark, GOOD + ' "http://r/" "agent"') == parsed(spark, GOOD)
    assert parsed(spark, GOOD + "xyz $1") == parsed(spark, GOOD)


@pytest.mark.parametrize(
    "line",
    [
        "",
        "nonsense",
        GOOD[:-4] + "-",
        " " + GOOD,
        GOOD.replace(" 200 ", " 20 "),
        GOOD.replace('"', ""),
        GOOD.replace(" +0530", ""),
        GOOD.replace("GET /q/shelf.txt", "GET"),
        "\n".join("123456789"),
    ],
)
def test_invalid_log_lines_are_dropped(spark, line):
    assert parsed(spark, line, GOOD) == parsed(spark, GOOD)
    assert rows(valid_log_lines(lines(spark, line))) == []


def test_log_size_limits(spark):
    assert parsed(spark, GOOD[:-4] + str(2**63 - 1))[0][-1] == 2**63 - 1
    too_long = lines(spark, GOOD[:-4] + "9" * 20)
    assert rows(access_log(too_long, on_bad="drop")) == []
    with pytest.raises(Exception, match="size beyond 64 bits in a line of 1.2.3.4"):
        access_log(too_long).count()
    with pytest.raises(ValueError, match="on_bad"):
        access_log(too_long, on_bad="skip")


def test_log_odd_but_valid_fields(spark):
    odd = '- -x y$0\\ [a/b:\t+0000] ""m" "e" p"q" 404 007'
    assert parsed(spark, odd) == [("-", "-x", "y$0\\", "a/b:\t+0000", '"m"', '"e"', 'p"q', 404, 7)]


def test_log_parsing_runs_the_pattern_once(spark):
    plan = access_log(lines(spark, GOOD)).groupBy("endpoint").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_extract") == 1
    assert "RLIKE" not in text


def test_positional_rows(spark):
    df = lines(spark, "a,b,c", "d,,", "e,f,g,h")
    got = positional_table(df, ",", [("third", 2), ("first", 0)])
    assert rows(got) == [("", "d"), ("c", "a"), ("g", "e")]


@pytest.mark.parametrize("sep", ["|", ".", "||", "\\", " "])
def test_separator_is_plain_text(spark, sep):
    df = lines(spark, sep.join(["a", "b", "c"]))
    assert rows(positional_table(df, sep, [("x", 1)])) == [("b",)]


def test_short_rows(spark):
    df = lines(spark, "a\tb", "c")
    fields = [("x", 0), ("y", 1)]
    assert rows(positional_table(df, "\t", fields, on_short="drop")) == [("a", "b")]
    with pytest.raises(Exception, match="fewer than 2 fields"):
        positional_table(df, "\t", fields).count()
    with pytest.raises(ValueError, match="on_short"):
        positional_table(df, "\t", fields, on_short="maybe")


def test_group_pairs(spark):
    assert rows(group_pairs(lines(spark, "a 3", "b -1 x"))) == [("a", 3), ("b", -1)]
    assert rows(group_pairs(lines(spark, "a 3", "b x", "c"), on_short="drop")) == [("a", 3)]
    with pytest.raises(Exception, match="no int: x"):
        group_pairs(lines(spark, "b x")).count()


def test_page_views(spark):
    df = page_views(lines(spark, "\t".join("tusripc")))
    assert df.columns == ["track_time", "url", "session_id", "referer", "ip", "end_user_id", "city_id"]
    assert rows(df) == [tuple("tusripc")]


def test_track_log(spark):
    fields = [str(i) for i in range(19)]
    fields[17] = "2015-08-28 18:10:00"
    df = track_log(lines(spark, "\t".join(fields), " \t", ""))
    assert rows(df) == [("2015-08-28", "1", "5")]


def test_text_partition_reads_one_directory(spark, tmp_path):
    root = str(tmp_path / "t")
    data = [("x", "007"), ("y", "008"), ("z", "a:b")]
    spark.createDataFrame(data, "value string, date string").write.partitionBy("date").text(root)
    part = text_partition(spark, root, "date", "007")
    assert rows(part) == [("x", "007")]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "= 007)]" in plan
    assert rows(text_partition(spark, root, "date", "a:b")) == [("z", "a:b")]


def test_text_partition_with_any_character(spark, tmp_path):
    root = str(tmp_path / "t")
    values = [f"a{chr(c)}b" for c in [*range(1, 32), *range(32, 128), 0xE9, 0x65E5]] + ["", "a}b{", "."]
    data = [(str(i), v) for i, v in enumerate(dict.fromkeys(values))]
    frame = spark.createDataFrame(data, "value string, part string").coalesce(1)
    frame.write.partitionBy("part").text(root)
    for value in ("", "a}b{", "a\x7fb", "a%b", "a/b", "a=b", "a b", "a\x01b", "aéb", "a*b", "a?b", "."):
        want = [d for d in data if d[1] == value]
        assert rows(text_partition(spark, root, "part", value)) == want, value


def test_track_log_needs_a_day(spark):
    line = "\t".join(["", "u", "", "", "", "g"] + [""] * 11)
    good, short = line + "\t2031-04-05 06:07:08", line + "\t2031"
    assert rows(track_log(lines(spark, good, short), on_short="drop")) == [("2031-04-05", "u", "g")]
    with pytest.raises(Exception, match="no day in the time 2031"):
        track_log(lines(spark, short)).count()


def test_files(spark, tmp_path):
    ratings = spark.createDataFrame([(7, 315, 3.5, 1733000111)], "u int, i int, r double, t int")
    ratings.write.option("header", True).csv(str(tmp_path / "csv"))
    inferred = csv_table(spark, str(tmp_path / "csv"))
    assert inferred.dtypes == [("u", "int"), ("i", "int"), ("r", "double"), ("t", "int")]
    assert rows(inferred) == [(7, 315, 3.5, 1733000111)]
    declared = csv_table(spark, str(tmp_path / "csv"), "u string, i long, r double, t long")
    assert rows(declared) == [("7", 315, 3.5, 1733000111)]
    ratings.write.json(str(tmp_path / "json"))
    assert rows(json_table(spark, str(tmp_path / "json")).select("u", "r")) == [(7, 3.5)]
    assert rows(json_table(spark, str(tmp_path / "json"), "t int")) == [(1733000111,)]
    ratings.write.parquet(str(tmp_path / "pq"))
    pruned = parquet_table(spark, str(tmp_path / "pq")).where("u = 1").select("r")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(u,1)" in plan and "ReadSchema: struct<u:int,r:double>" in plan


def test_text_lines(spark, tmp_path):
    (tmp_path / "f.txt").write_text("a b\n\nc\n")
    assert [r.value for r in text_lines(spark, str(tmp_path / "f.txt")).collect()] == ["a b", "", "c"]


LOG = [
    '1.1.1.1 - u [01/Jan/2024:00:00:00 +0000] "GET /a HTTP/1.1" 200 5',
    '1.1.1.1 - u [01/Jan/2024:00:00:00 +0000] "GET /a HTTP/1.1" 200 -',
    '1.1.1.1 - u [01/Jan/2024:00:00:00 +0000] "GET /b HTTP/1.1" 404 7 "r" "agent 1"',
    '1.1.1.1 - u [01/Jan/2024:00:00:00 +0000] "GET /c HTTP/1.1" 200 99999999999999999999',
    "",
    None,
    "nothing of the kind",
]


def test_lines_are_counted_in_the_pass_that_parses_them(spark):
    lines = spark.createDataFrame([(line,) for line in LOG], "value string").repartition(3)
    logs, counted = sources.counted_access_log(lines)
    assert rows(logs) == rows(sources.access_log(lines, on_bad="drop"))
    assert counted.get == {"read": 7, "valid": 2, "rejected": 5}
    logs, counted = sources.counted_access_log(lines.limit(0))
    assert logs.collect() == [] and counted.get == {"read": 0, "valid": 0, "rejected": 0}


def test_the_text_is_read_once_for_both_branches(spark, tmp_path):
    text = str(tmp_path / "text")
    spark.createDataFrame([(line,) for line in LOG if line is not None], "value string").repartition(3).write.text(text)
    found = sources.split_access_log(sources.text_lines(spark, text), str(tmp_path / "split"))
    assert found.counts == {"read": 6, "valid": 2, "rejected": 4}
    assert rows(found.rows) == rows(sources.access_log(sources.text_lines(spark, text), on_bad="drop"))
    assert rows(found.rejects) == sorted((line,) for line in (LOG[1], LOG[3], LOG[4], LOG[6]))
    nulls = spark.createDataFrame([(None,), (LOG[0],)], "value string")
    found = sources.split_access_log(nulls, str(tmp_path / "nulls"))
    assert rows(found.rejects) == [(None,)] and found.rows.count() == 1
    with pytest.raises(Exception, match="(?i)exists"):
        sources.split_access_log(nulls, str(tmp_path / "nulls"))


def test_columns_that_are_not_used_are_not_cut_out(spark):
    lines = spark.createDataFrame([(line,) for line in LOG], "value string")
    logs, _ = sources.counted_access_log(lines)
    plan = logs.select("responseCode")._jdf.queryExecution().optimizedPlan().toString()
    assert "userId" not in plan and "endpoint" not in plan


def test_a_stream_reports_its_counts(spark, tmp_path):
    inbox = str(tmp_path / "in")
    spark.createDataFrame([(line,) for line in LOG if line is not None], "value string").coalesce(1).write.text(inbox)
    logs, _ = sources.counted_access_log(spark.readStream.text(inbox))
    query = (
        logs.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    counts = query.recentProgress[0]["observedMetrics"]["access_log"]
    assert (counts["read"], counts["valid"], counts["rejected"]) == (6, 2, 4)
