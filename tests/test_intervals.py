import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.helpers import day, make_tables, rows
from trendframe import session
from trendframe.operators import intervals as iv

BASE = dt.date(2020, 1, 1)


def calendar(spark, cal, term_input=((100, 7),)):
    return make_tables(
        spark, civil_work=[(1,), (2,)], term=[(100, 1, 10), (101, 1, 10), (102, 2, 20)],
        term_input_data=list(term_input), calendar=cal,
    )


def test_first_bound_is_open_and_key_gaps_are_not(spark):
    t = calendar(spark, [(1, 7, day("2023-01-31")), (3, 7, day("2023-02-28"))])
    assert rows(iv.calendar_intervals(t), "interval_end") == [
        (1, None, day("2023-01-31")), (1, day("2023-01-31"), day("2023-02-28")),
    ]


def test_neighbouring_keys_of_other_calendars_do_not_count(spark):
    t = calendar(
        spark, [(1, 7, day("2023-01-31")), (2, 8, day("2023-02-28"))], [(100, 7), (102, 8)]
    )
    assert rows(iv.calendar_intervals(t), "id_civil_work") == [
        (1, None, day("2023-01-31")), (2, None, day("2023-02-28")),
    ]


def test_terms_sharing_a_calendar_give_distinct_intervals(spark):
    t = calendar(spark, [(1, 7, day("2023-01-31"))], [(100, 7), (101, 7), (101, 7), (102, 7)])
    assert rows(iv.calendar_intervals(t), "id_civil_work") == [
        (1, None, day("2023-01-31")), (2, None, day("2023-01-31")),
    ]


@pytest.mark.parametrize("apart", [1, 2**21])
def test_previous_across_blocks(spark, conf, apart):
    conf(spark__sql__shuffle__partitions="7", spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(4)
    data = [(g, o * apart, rng.choice([None, *range(9)])) for g in (1, 2) for o in rng.sample(range(-50, 50), 40)]
    df = spark.createDataFrame(data, "g long, o long, v long")
    got = {(r.g, r.o): r.p for r in iv.previous_in_group(df, "g", "o", "v", "p").collect()}
    for g in (1, 2):
        ordered = sorted((o, v) for x, o, v in data if x == g)
        for (o, _), before in zip(ordered, [None] + [v for _, v in ordered]):
            assert got[g, o] == before
    assert len(got) == 80


def test_blocks_hold_equally_many_rows_whatever_the_keys(spark, conf, monkeypatch):
    """One calendar, keys 2 ** 21 apart: no task orders all of it."""
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    kept = []
    monkeypatch.setattr(iv, "stored", lambda df, name: kept.append(session.stored(df, name)) or kept[-1])
    df = spark.range(3000).selectExpr("0 as g", "id * 2097152 as o", "id as v")
    assert iv.previous_in_group(df, "g", "o", "v", "p").filter("p = v - 1").count() == 2999
    sizes = [r["count"] for r in kept[0].groupBy("_block").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1000


offset = st.integers(0, 80)
spans = st.lists(st.tuples(st.one_of(st.none(), offset), offset), max_size=6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(spans, st.lists(offset, max_size=8, unique=True)), min_size=1, max_size=25))
def test_cover_against_brute_force(spark, works):
    day_of = lambda n: None if n is None else BASE + dt.timedelta(n)
    number = lambda d: None if d is None else (d - dt.date(1970, 1, 1)).days
    intervals, points, hull, each = [], [], set(), set()
    for w, (pairs, dates) in enumerate(works):
        held = {(day_of(s), day_of(e)) for s, e in pairs}
        intervals += [(w, s, e) for s, e in held]
        points += [(w, day_of(p)) for p in dates]
        for p in map(day_of, dates):
            on = [(s, e) for s, e in held if (s is None or p > s) and p <= e]
            numbers = [(iv.OPEN if s is None else number(s), number(e)) for s, e in on]
            each |= {(w, p, lo, hi) for lo, hi in numbers}
            if on:
                hull.add((w, p, min(lo for lo, _ in numbers), max(hi for _, hi in numbers)))
    i = spark.createDataFrame(intervals, "id_civil_work long, interval_start date, interval_end date")
    p = spark.createDataFrame(points, "id_civil_work long, period date")
    got = rows(iv.covering_span(p.union(p), i.union(i)).select("id_civil_work", "period", "lo", "hi"))
    assert len(got) == len(set(got)) and set(got) == hull
    got = rows(iv.covering_intervals(p, i).select("id_civil_work", "period", "lo", "hi"))
    assert len(got) == len(set(got)) and set(got) == each


@pytest.mark.parametrize("date, end", [("2023-01-31", "2023-01-31"), ("2023-02-01", "2023-02-28"), ("2023-02-28", "2023-02-28")])
def test_bounds_are_half_open(spark, date, end):
    i = spark.createDataFrame(
        [(1, None, day("2023-01-31")), (1, day("2023-01-31"), day("2023-02-28"))],
        "id_civil_work long, interval_start date, interval_end date",
    )
    p = spark.createDataFrame([(1, day(date))], "id_civil_work long, period date")
    assert iv.covering_span(p, i).first().hi == (day(end) - dt.date(1970, 1, 1)).days
