"""sel_max and the functions with SQL names."""

from __future__ import annotations

from dataclasses import replace

import pytest

from clickflow.functions import SEL_MAX, UserAggregate, register_aggregate, register_functions, sel_max, sel_max_sql
from clickflow.operators import register
from tests.conftest import rows

CASES = {
    "mixed": [1.0, 7.5, -2.0],
    "negative": [-1.0, -7.0],
    "nan": [float("nan"), 2.0],
    "only_nan": [float("nan")],
    "null": [None, 3.0],
    "only_null": [None],
}
EXPECTED = {"mixed": 7.5, "negative": 0.0, "nan": 2.0, "only_nan": 0.0, "null": 3.0, "only_null": 0.0}


@pytest.fixture(scope="module")
def salaries(spark):
    data = [(name, value) for name, values in CASES.items() for value in values]
    return spark.createDataFrame(data, "name string, sal double")


def test_native(salaries):
    got = salaries.groupBy("name").agg(sel_max("sal").alias("m"))
    assert {r.name: r.m for r in got.collect()} == EXPECTED


def test_native_on_nothing(salaries):
    assert rows(salaries.where("false").agg(sel_max("sal").alias("m"))) == [(0.0,)]


def test_native_combines_before_the_shuffle(salaries):
    plan = salaries.groupBy("name").agg(sel_max("sal"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Python" not in plan


def test_in_sql_text_beside_other_aggregates(spark, salaries):
    register(salaries, "salaries_all")
    got = spark.sql(
        f"SELECT name, {sel_max_sql('sal')} AS m, COUNT(*) AS n, MAX(sal) AS x FROM salaries_all GROUP BY name"
    )
    assert {r.name: r.m for r in got.collect()} == EXPECTED
    assert {r.name: r.n for r in got.collect()} == {k: len(v) for k, v in CASES.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Python" not in plan


def test_in_sql_text_with_a_falling_expression(spark):
    register(spark.createDataFrame([(1.0,), (-5.0,), (3.0,)], "x double"), "falling")
    got = spark.sql(f"SELECT {sel_max_sql('-x')} AS m, {sel_max_sql('x * 2')} AS d FROM falling")
    assert rows(got) == [(5.0, 6.0)]


def test_in_sql_text_on_nothing(spark, salaries):
    register(salaries.where("false"), "salaries_none")
    assert rows(spark.sql(f"SELECT {sel_max_sql('sal')} AS m FROM salaries_none")) == [(0.0,)]


def test_case_functions(spark):
    register_functions(spark)
    got = spark.sql("SELECT toUpper('aB') AS u, toLower('aB') AS l, toUpper(NULL) AS n")
    assert rows(got) == [("AB", "ab", None)]


def test_case_functions_stay_in_the_jvm(spark):
    register_functions(spark)
    df = spark.range(3).selectExpr("string(id) AS s").selectExpr("toUpper(s) AS u", "toLower(s) AS l")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "upper(" in plan and "lower(" in plan and "Python" not in plan


@pytest.fixture
def named(spark, salaries):
    register_aggregate(spark, SEL_MAX)
    register(salaries, "salaries_all")
    return spark


def test_by_name_beside_other_aggregates(named):
    got = named.sql(
        "SELECT name, sel_max(sal) AS m, COUNT(*) AS n, MAX(sal) AS x, COUNT(DISTINCT sal) AS d, sel_max(-sal) AS f "
        "FROM salaries_all GROUP BY name"
    )
    assert {r.name: r.m for r in got.collect()} == EXPECTED
    assert {r.name: r.n for r in got.collect()} == {k: len(v) for k, v in CASES.items()}
    assert {r.name: r.f for r in got.collect()}["negative"] == 7.0
    having = named.sql("SELECT name FROM salaries_all GROUP BY name HAVING sel_max(sal) > 3")
    assert rows(having) == [("mixed",)]


def test_by_name_over_a_window_and_on_nothing(named):
    assert rows(named.sql("SELECT sel_max(sal) AS m FROM salaries_all WHERE false")) == [(0.0,)]
    over = named.sql("SELECT DISTINCT name, sel_max(sal) OVER (PARTITION BY name) AS m FROM salaries_all")
    assert dict(rows(over)) == EXPECTED
    assert rows(named.sql("SELECT sel_max(CAST(x AS DECIMAL(5, 2))) FROM VALUES (1), (7), (null) t(x)")) == [(7.0,)]


def test_by_name_states_merge_over_partitions(named):
    spread = named.range(0, 10_000, 1, 16).selectExpr("id % 3 AS g", "CAST(id * 7 % 10007 AS DOUBLE) AS x")
    register(spread, "spread")
    got = named.sql("SELECT g, sel_max(x) AS m, max(x) AS x FROM spread GROUP BY g")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sel_max" in plan and "Python" not in plan
    assert plan.index("Exchange") < plan.index("partial_sel_max")
    assert all(r.m == r.x for r in got.collect())


MEAN_LENGTH = UserAggregate(
    name="joined_mean",
    inputs={"word": "string", "weight": "bigint"},
    state={"letters": ("double", "0.0"), "weights": ("bigint", "0L"), "any": ("boolean", "false")},
    update="letters += word.length() * (double) weight; weights += weight; any = true;",
    merge="letters += other_letters; weights += other_weights; any |= other_any;",
    result="double",
    evaluate="any ? letters / weights : -1.0",
)


def test_an_aggregate_with_several_arguments_and_states(spark):
    register_aggregate(spark, MEAN_LENGTH)
    table = spark.createDataFrame([("a", 1), ("bcd", 3), (None, 9), ("x", None)], "w string, n bigint").repartition(4)
    register(table, "weighted")
    assert rows(spark.sql("SELECT joined_mean(w, n) AS m FROM weighted")) == [(2.5,)]
    assert rows(spark.sql("SELECT joined_mean(w, n) AS m FROM weighted WHERE w IS NULL")) == [(-1.0,)]
    # The same name with another definition replaces it.
    register_aggregate(spark, replace(MEAN_LENGTH, evaluate="letters"))
    assert rows(spark.sql("SELECT joined_mean(w, n) AS m FROM weighted")) == [(10.0,)]
    register_aggregate(spark, MEAN_LENGTH)
    assert rows(spark.sql("SELECT joined_mean(w, n) AS m FROM weighted")) == [(2.5,)]


def test_longest_string_as_a_state(spark):
    longest = UserAggregate(
        name="longest",
        inputs={"word": "string"},
        state={"best": ("string", '""')},
        update="if (word.length() > best.length()) best = word;",
        merge="if (other_best.length() > best.length()) best = other_best;",
        result="string",
        evaluate="best",
    )
    register_aggregate(spark, longest)
    got = spark.sql("SELECT g, longest(w) FROM VALUES (1, 'a'), (1, 'abc'), (2, null) t(g, w) GROUP BY g")
    assert rows(got) == [(1, "abc"), (2, "")]


def test_mistakes_are_named(spark):
    with pytest.raises(ValueError, match="does not compile"):
        register_aggregate(spark, replace(SEL_MAX, name="broken", update="highest = nothing;"))
    with pytest.raises(ValueError, match="not a name"):
        replace(SEL_MAX, name="a b")
    with pytest.raises(ValueError, match="must be one of"):
        replace(SEL_MAX, result="date")
    with pytest.raises(ValueError, match="share names"):
        replace(SEL_MAX, inputs={"highest": "double"})
