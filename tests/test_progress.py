import datetime as dt
import random
from decimal import Decimal

import pytest

from tests.helpers import (
    calendar_model,
    day,
    interval_model,
    intervals_model,
    make_tables,
    one_work,
    rows,
)
from trendframe.operators.intervals import calendar_intervals
from trendframe.operators.progress import (
    accumulate,
    calendar_progress,
    progress_by_calendar,
    progress_by_interval,
    status_date,
)

JAN, FEB, MAR = day("2023-01-31"), day("2023-02-28"), day("2023-03-31")


def pairs(df):
    return [(r.period, r.foreseen_progress, r.accomplished_progress) for r in df.orderBy("period").collect()]


def test_unmeasured_is_null_not_zero(spark):
    t = one_work(spark, [JAN, FEB], [(JAN, "0.1"), (FEB, "0.2")], [(JAN, 30)])
    assert pairs(progress_by_calendar(t)) == [(JAN, 10, 30), (FEB, 20, None)]


@pytest.mark.parametrize("fanout, foreseen", [("collapse", 10), ("join", 20)])
def test_two_measurements_of_one_date(spark, fanout, foreseen):
    t = one_work(spark, [JAN], [(JAN, "0.1")], [(JAN, 30), (JAN, 20)])
    assert pairs(progress_by_calendar(t, fanout=fanout)) == [(JAN, foreseen, 50)]
    assert pairs(progress_by_interval(t, fanout=fanout)) == [(JAN, foreseen, 50)]


def test_measurement_without_percentage(spark):
    t = one_work(spark, [JAN], [(JAN, "0.1")], [(JAN, None)])
    assert pairs(progress_by_calendar(t)) == [(JAN, 10, None)]
    assert pairs(progress_by_interval(t)) == [(JAN, 10, None)]


def test_dates_outside_the_calendar_are_dropped(spark):
    t = one_work(spark, [JAN], [(JAN, "0.1"), (FEB, "0.2")], [(FEB, 30)])
    assert pairs(progress_by_calendar(t)) == [(JAN, 10, None)]
    assert pairs(progress_by_interval(t)) == [(JAN, 10, None)]


def test_lower_outline_levels_do_not_count(spark):
    t = one_work(
        spark, [JAN], [], [],
        qualitative_activity=[(1000, 10, 1), (1001, 10, 2)],
        foreseen_progress=[(1000, JAN, "0.1"), (1001, JAN, "0.5")],
        real_progress=[(1, 1001, 500, JAN, 9)],
    )
    assert pairs(progress_by_calendar(t)) == [(JAN, 10, None)]
    assert pairs(progress_by_interval(t)) == [(JAN, 10, None)]


def test_latest_term_must_be_on_the_latest_schedule(spark):
    t = one_work(
        spark, [JAN], [(JAN, "0.1")], [], schedule=[(10, 1), (11, 1)], term=[(100, 1, 10), (99, 1, 11)]
    )
    assert rows(progress_by_calendar(t)) == []
    assert [r.base for r in calendar_progress(t, [("id_schedule", "id_term"), ("id_term",)]).collect()] == []


def test_measurements_of_the_interval_count(spark):
    t = one_work(
        spark, [JAN, FEB], [(JAN, "0.1"), (day("2023-02-15"), "0.2"), (FEB, "0.3")],
        [(day("2022-06-01"), 1), (JAN, 2), (day("2023-02-01"), 4), (FEB, 8), (day("2023-03-01"), 16)],
    )
    assert pairs(progress_by_interval(t)) == [(JAN, 10, 3), (day("2023-02-15"), 20, 12), (FEB, 30, 12)]


def test_rejects_unknown_fanout(spark):
    t = one_work(spark, [JAN], [], [])
    for operator in (progress_by_calendar, progress_by_interval):
        with pytest.raises(ValueError, match="fanout"):
            operator(t, fanout="both")


def test_status_date(spark):
    t = one_work(
        spark, [JAN], [], [], civil_work=[(1,), (2,)], term=[(100, 1, 10), (101, 1, 10)],
        term_activity=[(500, 100), (501, 101)],
        real_progress=[(1, 1000, 500, MAR, 1), (2, 1000, 501, JAN, 1), (3, 1000, 501, FEB, None)],
    )
    assert rows(status_date(t), "id_civil_work") == [(1, FEB), (2, None)]
    assert rows(status_date(t, latest_only=False), "id_civil_work") == [(1, MAR), (2, None)]


def accumulated(spark, series, status):
    base = spark.createDataFrame(
        [(1, p, Decimal(f), None if a is None else Decimal(a)) for p, f, a in series],
        "id_civil_work long, period date, foreseen_progress decimal(9,2), accomplished_progress decimal(19,4)",
    )
    st = spark.createDataFrame([(1, status)], "id_civil_work long, status_date date")
    out = accumulate(base, st).orderBy("period").collect()
    return [(r.foreseen_progress_accumulated, r.accomplished_progress_accumulated) for r in out]


def test_accumulated_foreseen_is_capped(spark):
    assert accumulated(spark, [(JAN, 60, 1), (FEB, 60, 2)], FEB) == [(60, 1), (100, 3)]


def test_accumulated_stops_after_the_status_date(spark):
    series = [(JAN, 10, 5), (FEB, 10, 5), (MAR, 10, None)]
    assert accumulated(spark, series, JAN) == [(10, 5), (20, None), (30, None)]
    assert accumulated(spark, series, None) == [(10, 5), (20, 10), (30, 10)]


def random_tables(rng: random.Random) -> dict:
    """Tables with shared and several calendars, unordered calendar dates, copies and gaps."""
    date = lambda: dt.date(2023, 1, 1) + dt.timedelta(rng.randint(0, 40))
    works = [(w,) for w in range(5)]
    schedule = [(w * 10 + i, w) for w in range(6) for i in range(rng.randint(0, 3))]
    term = [
        (s * 10 + i, w, s) for s, w in schedule for i in rng.sample(range(4), rng.randint(0, 2))
    ]
    inputs = [(x, rng.randint(1, 4)) for x, _, _ in term for _ in range(rng.randint(0, 3))]
    cal = [(k, rng.randint(1, 4), date()) for k in rng.sample(range(100), 30)]
    activity = [(s * 10 + i, s, rng.choice([1, 1, 2])) for s, _ in schedule for i in range(rng.randint(0, 3))]
    ids = [a for a, _, _ in activity] or [0]
    dates = [d for _, _, d in cal]
    pick = lambda: rng.choice([date(), *dates, *dates[:5], None])
    value = lambda top, scale: rng.choice([None, *(Decimal(rng.randint(0, top)) / scale for _ in range(5))])
    foreseen = [(rng.choice(ids), pick(), value(10**6, 10**6)) for _ in range(80)]
    real = [(k, rng.choice(ids), rng.randint(1, 9), pick(), value(10**6, 10**4)) for k in range(120)]
    return dict(
        civil_work=works, schedule=schedule, term=term, term_input_data=inputs, calendar=cal,
        qualitative_activity=activity, foreseen_progress=foreseen, real_progress=real,
    )


@pytest.mark.parametrize("seed", range(2))
def test_against_nested_loops(spark, seed):
    data = random_tables(random.Random(seed))
    t = make_tables(spark, **data)
    found = [tuple(r) for r in calendar_intervals(t).collect()]
    assert len(found) == len(set(found)) and set(found) == intervals_model(data)
    for fanout in ("collapse", "join"):
        got = progress_by_interval(t, fanout).collect()
        want = interval_model(data, fanout)
        assert len(got) == len(want)
        assert {(r[0], r[1]): (r.foreseen_progress, r.accomplished_progress) for r in got} == want
        for by in (("id_term",), ("id_schedule", "id_term")):
            got = progress_by_calendar(t, by, fanout).collect()
            want = calendar_model(data, by, fanout)
            assert len(got) == len(want)
            assert {tuple(r)[:4]: (r.foreseen_progress, r.accomplished_progress) for r in got} == want


@pytest.mark.parametrize("seed", range(2))
def test_both_terms_in_one_pass(spark, seed):
    t = make_tables(spark, **random_tables(random.Random(100 + seed)))
    orders = [("id_schedule", "id_term"), ("id_term",)]
    got = rows(calendar_progress(t, orders))
    apart = [(i, *r) for i, by in enumerate(orders) for r in rows(progress_by_calendar(t, by))]
    assert sorted(got, key=repr) == sorted(apart, key=repr)
