"""Small input tables and plain-Python models of the operators."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from trendframe.schemas import TABLES
from trendframe.sources import Tables


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def make_tables(spark, **rows) -> Tables:
    """Tables from lists of tuples; decimals may be given as strings or numbers."""
    frames = {}
    for name, schema in TABLES.items():
        decimals = [i for i, f in enumerate(schema.fields) if f.dataType.typeName() == "decimal"]
        fixed = []
        for row in rows.get(name, []):
            row = list(row)
            for i in decimals:
                row[i] = None if row[i] is None else Decimal(str(row[i]))
            fixed.append(tuple(row))
        frames[name] = spark.createDataFrame(fixed, schema)
    return Tables(**frames)


def one_work(spark, periods, foreseen, real, work=1, **more) -> Tables:
    """One work with one schedule, term, calendar and activity.

    ``foreseen`` and ``real`` are (date, value) pairs.
    """
    rows = dict(
        civil_work=[(work,)],
        schedule=[(10, work)],
        term=[(100, work, 10)],
        term_input_data=[(100, 7)],
        calendar=[(i, 7, p) for i, p in enumerate(periods, 1)],
        qualitative_activity=[(1000, 10, 1)],
        foreseen_progress=[(1000, d, v) for d, v in foreseen],
        real_progress=[(i, 1000, 500, d, v) for i, (d, v) in enumerate(real, 1)],
        term_activity=[(500, 100)],
    )
    rows.update(more)
    return make_tables(spark, **rows)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]


def cents(value) -> Decimal | None:
    return None if value is None else Decimal(value).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")


def _sum(values):
    values = [v for v in values if v is not None]
    return sum(values, Decimal(0)) if values else None


def calendar_model(t: dict, by=("id_term",), fanout="collapse") -> dict:
    """{(work, schedule, term, period): (foreseen, accomplished)} by nested loops."""
    out = {}
    for (work,) in t["civil_work"]:
        terms = [
            {"id_term": a, "id_schedule": c} for a, b, c in t["term"] if b == work
        ]
        schedules = [a for a, b in t["schedule"] if b == work]
        if not terms or not schedules:
            continue
        term = max(terms, key=lambda r: tuple(r[c] for c in by))
        if term["id_schedule"] != max(schedules):
            continue
        inputs = [b for a, b in t["term_input_data"] if a == term["id_term"]]
        dates = [d for i in inputs for _, b, d in t["calendar"] if b == i]
        activities = [a for a, b, c in t["qualitative_activity"] if b == term["id_schedule"] and c == 1]
        fore, acc = defaultdict(list), defaultdict(list)
        for a in activities:
            for d in dates if fanout == "join" else set(dates):
                f = [v for x, y, v in t["foreseen_progress"] if x == a and y == d]
                r = [v for _, x, _, y, v in t["real_progress"] if x == a and y == d]
                if not f:
                    continue
                key = (work, term["id_schedule"], term["id_term"], d)
                fore[key] += f * (max(len(r), 1) if fanout == "join" else 1)
                acc[key] += r * (len(f) if fanout == "join" else 1)
        for key in fore:
            total = _sum(fore[key])
            out[key] = (None if total is None else cents(total * 100), _sum(acc[key]))
    return out


def intervals_model(t: dict) -> set:
    """{(work, start, end)}: each calendar row with the row before it."""
    bounds = defaultdict(set)
    for i in {b for _, b, _ in t["calendar"]}:
        ordered = sorted((a, d) for a, b, d in t["calendar"] if b == i)
        for (_, d), before in zip(ordered, [None] + [d for _, d in ordered]):
            bounds[i].add((before, d))
    works = {w for (w,) in t["civil_work"]}
    return {
        (w, s, e)
        for term, w, _ in t["term"]
        if w in works
        for x, i in t["term_input_data"]
        if x == term
        for s, e in bounds[i]
    }


def interval_model(t: dict, fanout="collapse") -> dict:
    """{(work, period): (foreseen, accomplished)} by nested loops."""
    intervals = intervals_model(t)
    fore, acc = defaultdict(list), defaultdict(list)
    for (work,) in t["civil_work"]:
        for schedule in [a for a, b in t["schedule"] if b == work]:
            for a in [x for x, b, c in t["qualitative_activity"] if b == schedule and c == 1]:
                for p in {y for x, y, _ in t["foreseen_progress"] if x == a and y is not None}:
                    holding = [
                        (s, e) for w, s, e in intervals if w == work and (s is None or p > s) and p <= e
                    ]
                    if not holding:
                        continue
                    f = [v for x, y, v in t["foreseen_progress"] if x == a and y == p]
                    found = [
                        [v for _, x, _, d, v in t["real_progress"]
                         if x == a and d is not None and (s is None or d > s) and d <= e]
                        for s, e in holding
                    ]
                    if fanout == "join":
                        for r in found:
                            fore[work, p] += f * max(len(r), 1)
                            acc[work, p] += r * len(f)
                    else:
                        fore[work, p] += f
                        acc[work, p] += [
                            v for _, x, _, d, v in t["real_progress"]
                            if x == a and d is not None
                            and any((s is None or d > s) and d <= e for s, e in holding)
                        ]
    out = {}
    for key in fore:
        total = _sum(fore[key])
        out[key] = (None if total is None else cents(total * 100), _sum(acc[key]))
    return out


def _div(a, b):
    return None if a is None or not b else a / b


def _avg(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def stage_model(series, previous=None, n=3):
    """One work's stage: ``series`` is [(period, foreseen, accomplished)] and ``previous`` the rows of
    the stage before as {period: (initial_deviation, trend)}. Rows as the result table has them."""
    series = sorted(series)
    if previous is not None:
        series = [r for r in series if r[0] in previous]
    dev, eligible, known = {}, [], {}
    for p, f, a in series:
        if previous is None:
            dev[p], known[p] = _div(a, f), a
            if a is not None:
                eligible.append(p)
        else:
            before_dev, before_trend = previous[p]
            dev[p] = before_dev if before_dev is not None else _div(before_trend, f)
            known[p] = a if a is not None else before_trend
            if _div(before_trend, f) is not None:
                eligible.append(p)
    last = eligible[-n:]
    earliest, newest = last[: n - 1], last[-1:]
    mobile, prev, cur = (_avg([dev[p] for p in part]) for part in (last, earliest, newest))
    if prev == 1:
        seasonal = mobile
    else:
        seasonal = None if prev is None or cur is None else (prev + cur) / 2
    out = []
    for i, (p, f, _) in enumerate(series):
        trend = known[p]
        if trend is None and i and dev[series[i - 1][0]] is not None and seasonal is not None and f is not None:
            trend = seasonal * f
        out.append(
            (p, dev[p], dev[p] if p in last else None, dev[p] if p in earliest else None,
             dev[p] if p in newest else None, seasonal, trend)
        )
    return out
