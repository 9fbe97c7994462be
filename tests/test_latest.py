import pytest

from tests.helpers import make_tables, rows
from trendframe.operators.latest import latest_by
from trendframe.operators.progress import latest_schedule, latest_term


@pytest.mark.parametrize("n, expected", [(1, {(1, 5), (2, 9)}), (2, {(1, 4), (1, 5), (2, 9)})])
def test_latest_by(spark, n, expected):
    df = spark.createDataFrame([(1, 3), (1, 5), (1, 4), (2, 9)], "k long, v long")
    assert set(rows(latest_by(df, ["k"], ["v"], n))) == expected


def test_latest_by_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b")], "k long, v long, x string")
    assert rows(latest_by(df, ["k"], ["v"])) == [(1, 5, "c")]
    assert rows(latest_by(df, ["k"], ["v"], 2), "x") == [(1, 5, "b"), (1, 5, "c")]


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_by(df, ["k"], ["v"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_term_and_schedule(spark):
    t = make_tables(
        spark,
        term=[(1, 1, 20), (2, 1, 10), (3, 2, 30)],
        schedule=[(10, 1), (20, 1), (30, 2)],
    )
    assert rows(latest_term(t), "id_civil_work") == [(1, 2, 10), (2, 3, 30)]
    assert rows(latest_term(t, ("id_schedule", "id_term")), "id_civil_work") == [(1, 1, 20), (2, 3, 30)]
    assert rows(latest_schedule(t), "id_civil_work") == [(1, 20), (2, 30)]
