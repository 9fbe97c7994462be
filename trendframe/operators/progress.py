"""Foreseen and accomplished progress per work and period.

Facts are first summed per (activity, date). That aggregate combines on the map side, so however many
rows one activity or date has, the rows shuffled and joined later are at most one per activity and day.
Periods are dates, so every group and window after it is bounded by a number of days.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendframe.operators.intervals import (
    calendar_intervals,
    covering_intervals,
    covering_span,
    interval_rows,
)
from trendframe.operators.latest import latest_by
from trendframe.schemas import ACTIVITY, INPUT, SCHEDULE, TERM, WORK
from trendframe.session import stored
from trendframe.sources import Tables

BASE_KEYS = [WORK, SCHEDULE, TERM, "period"]


def _check_fanout(fanout: str) -> None:
    if fanout not in ("collapse", "join"):
        raise ValueError(f"fanout must be 'collapse' or 'join', not {fanout!r}")


def top_activities(t: Tables) -> DataFrame:
    """Activities of outline level 1, the only ones whose progress counts."""
    return t.qualitative_activity.filter(F.col("outline_lvl") == 1).select(ACTIVITY, SCHEDULE)


def latest_term(t: Tables, by: tuple[str, ...] = (TERM,)) -> DataFrame:
    """(work, term, schedule) of the monitoring run that is greatest by ``by``."""
    if by == (TERM,):  # the primary key: no ties, so plain maxima, which need no sort
        return t.term.groupBy(WORK).agg(
            F.max(TERM).alias(TERM), F.max_by(SCHEDULE, TERM).alias(SCHEDULE)
        )
    return latest_by(t.term.select(WORK, TERM, SCHEDULE), [WORK], list(by))


def _latest_terms(t: Tables, orders: Sequence[tuple[str, ...]]) -> DataFrame:
    """``latest_term`` by each order, with the position of the order as ``base``."""
    newest = [
        F.max(F.struct(*by, *(c for c in (TERM, SCHEDULE) if c not in by))).alias(f"_{i}")
        for i, by in enumerate(orders)
    ]
    picks = [
        F.struct(F.lit(i).alias("base"), f"_{i}.{TERM}", f"_{i}.{SCHEDULE}") for i in range(len(orders))
    ]
    rows = t.term.groupBy(WORK).agg(*newest).select(WORK, F.explode(F.array(*picks)).alias("p"))
    return rows.select(WORK, "p.*")


def current_terms(t: Tables, orders: Sequence[tuple[str, ...]]) -> DataFrame:
    """(base, work, schedule, term), stored: each work's latest term by each order, where it belongs to the latest schedule.

    The scope of the calendar base. It cuts activities and terms, so it is computed once and its plan not repeated there.
    """
    if len(orders) == 1:
        chosen = latest_term(t, orders[0]).withColumn("base", F.lit(0))
    else:
        chosen = _latest_terms(t, orders)
    current = chosen.join(latest_schedule(t), [WORK, SCHEDULE]).join(t.civil_work, WORK, "left_semi")
    return stored(current.select("base", WORK, SCHEDULE, TERM), "current-terms")


def latest_schedule(t: Tables) -> DataFrame:
    return t.schedule.groupBy(WORK).agg(F.max(SCHEDULE).alias(SCHEDULE))


def _units(column: str, digits: int) -> Column:
    """A decimal as an exact integer count of its last digit.

    Sums of these stay in long arithmetic, which has room for 9e9 rows of the largest value the column
    can hold.
    """
    return F.rint(F.col(column).cast("double") * 10**digits).cast("long")


def _decimal(units: Column, digits: int) -> Column:
    return units.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-digits))


def _dated_foreseen(t: Tables) -> DataFrame:
    return t.foreseen_progress.select(
        ACTIVITY,
        F.col("id_term_date").cast("date").alias("period"),
        _units("foreseen_fraction", 6).alias("fraction"),
    ).filter(F.col("period").isNotNull())


def dated_real(rows: DataFrame, *carried: str) -> DataFrame:
    """(activity, period, percentage) of measurements with a date; ``percentage`` counts ten-thousandths."""
    return rows.select(
        ACTIVITY,
        F.col("progress_date").cast("date").alias("period"),
        _units("progress_percentage", 4).alias("percentage"),
        *carried,
    ).filter(F.col("period").isNotNull())


def _dated_real(t: Tables) -> DataFrame:
    return dated_real(t.real_progress)


def daily_facts(t: Tables, activities: DataFrame | None = None) -> DataFrame:
    """Both fact tables summed per (activity, period), by one aggregate over their union.

    ``fraction`` counts millionths, ``percentage`` ten-thousandths of a percent; a sum is NULL where
    nothing was measured. ``n_foreseen`` and ``n_real`` count rows, ``n_measured`` measurements with a value. With
    ``activities`` only their rows are summed; they are selected before anything else is done.
    """
    none, one, zero = F.lit(None).cast("long"), F.lit(1).cast("long"), F.lit(0).cast("long")
    foreseen = _dated_foreseen(t).withColumns(
        {"percentage": none, "n_foreseen": one, "n_real": zero}
    )
    real = _dated_real(t).withColumns({"fraction": none, "n_foreseen": zero, "n_real": one})
    measures = ("fraction", "percentage", "n_foreseen", "n_real")
    rows = foreseen.unionByName(real)
    if activities is not None:
        rows = rows.join(activities.select(ACTIVITY), ACTIVITY, "left_semi")
    sums = (F.sum(m).alias(m) for m in measures)
    return rows.groupBy(ACTIVITY, "period").agg(*sums, F.count("percentage").alias("n_measured"))


def stored_daily_facts(t: Tables) -> DataFrame:
    """``daily_facts`` of all top activities, stored: for plans that need them several times."""
    return stored(daily_facts(t, top_activities(t)), "daily-facts")


def calendar_targets(t: Tables, current: DataFrame) -> DataFrame:
    """(base, work, schedule, term, period, n_calendar): the dates of the terms in ``current`` and how many calendar rows each has.

    The dates of a term are counted over all its calendars, combined before they are shuffled, so a
    term with very many calendars is one row per date when its work is joined.
    """
    term = ["base", WORK, SCHEDULE, TERM]
    links = t.term_input_data.join(current, TERM).groupBy(*term, INPUT).agg(F.count(F.lit(1)).alias("n_links"))
    dates = t.calendar.groupBy(INPUT, F.col("calendar_period").cast("date").alias("period")).agg(
        F.count(F.lit(1)).alias("n_dates")
    )
    return (
        links.join(dates, INPUT)
        .groupBy(*term, "period")
        .agg(F.sum(F.col("n_links") * F.col("n_dates")).alias("n_calendar"))
    )


def targets_progress(daily: DataFrame, owners: DataFrame, targets: DataFrame, fanout: str = "collapse") -> DataFrame:
    """Progress on ``targets`` from daily sums and the schedules that own their activities."""
    foreseen, accomplished = F.col("fraction"), F.col("percentage")
    if fanout == "join":
        foreseen = foreseen.cast("decimal(19,0)") * F.greatest(F.col("n_real"), F.lit(1))
        accomplished = accomplished.cast("decimal(19,0)") * F.col("n_foreseen")
    # Activities are summed into their schedule before it is looked up, so a schedule with very many
    # activities is one row per date by then.
    by_schedule = (
        daily.filter(F.col("n_foreseen") > 0)
        .join(owners.select(ACTIVITY, SCHEDULE), ACTIVITY)
        .groupBy(SCHEDULE, "period")
        .agg(F.sum(foreseen).alias("foreseen"), F.sum(accomplished).alias("accomplished"))
    )
    matched = by_schedule.join(targets, [SCHEDULE, "period"]).repartition(WORK)  # serves the windows of the trend stages
    times = F.col("n_calendar") if fanout == "join" else F.lit(1)
    return matched.select(
        "base",
        *BASE_KEYS,
        _decimal(F.col("foreseen") * times, 4).cast("decimal(9,2)").alias("foreseen_progress"),
        _decimal(F.col("accomplished") * times, 4).alias("accomplished_progress"),
    )


def calendar_progress(
    t: Tables, term_orders: Sequence[tuple[str, ...]], fanout: str = "collapse", daily: DataFrame | None = None
) -> DataFrame:
    """``progress_by_calendar`` for several choices of the latest term in one pass.

    ``base`` is the position of the choice in ``term_orders``. Without ``daily`` (``stored_daily_facts``), the facts
    are cut down to the activities of current schedules before they are summed.
    """
    _check_fanout(fanout)
    current = current_terms(t, term_orders)
    owners = top_activities(t)
    activities = owners.join(current, SCHEDULE, "left_semi")
    if daily is None:  # sums of current activities only, so all that is left to look up is their schedule
        daily = daily_facts(t, activities)
    else:
        owners = activities
    return targets_progress(daily, owners, calendar_targets(t, current), fanout)


def progress_by_calendar(
    t: Tables, latest_term_by: tuple[str, ...] = (TERM,), fanout: str = "collapse"
) -> DataFrame:
    """(work, schedule, term, period, foreseen_progress, accomplished_progress).

    Covers each work's latest term, if it belongs to the latest schedule, on the dates of that term's
    calendars. ``fanout="join"`` counts a foreseen value once per measurement and calendar row of its
    date and a measurement once per foreseen row, as summing after a join does; it is computed from
    row counts.
    """
    return calendar_progress(t, [latest_term_by], fanout).drop("base")


def foreseen_sums(t: Tables) -> DataFrame:
    """Foreseen progress summed per (activity, period), with the number of rows."""
    sums = (F.sum("fraction").alias("fraction"), F.count(F.lit(1)).alias("n_foreseen"))
    return _dated_foreseen(t).groupBy(ACTIVITY, "period").agg(*sums)


def stored_foreseen_sums(t: Tables) -> DataFrame:
    """``foreseen_sums`` stored: for plans that need them several times but measurements only once."""
    return stored(foreseen_sums(t), "foreseen-sums")


def progress_by_interval(
    t: Tables, fanout: str = "collapse", daily: DataFrame | None = None, planned: DataFrame | None = None
) -> DataFrame:
    """(work, period, foreseen_progress, accomplished_progress) over all schedules and terms.

    Each foreseen date is a period; its accomplished progress is what its activities measured in the
    calendar intervals that hold the date. With ``fanout="collapse"`` every row counts once per period;
    with ``"join"`` as often as a join of foreseen rows, measurements and intervals repeats it.

    The sum over ``(lo, hi]`` is a difference of running sums at ``hi`` and ``lo``: measurements and
    the two ends of each period are ordered by day within an activity, in one window. Measurements,
    the larger table as a rule, are shuffled for their daily sums and for that window only. With ``planned``
    (``stored_foreseen_sums``) foreseen progress is not read again, with ``daily`` (``stored_daily_facts``) neither fact table.
    """
    _check_fanout(fanout)
    activities = work_activities(t).select(ACTIVITY, WORK)
    if daily is None:
        planned = foreseen_sums(t) if planned is None else planned
        sums = (F.sum("percentage").alias("percentage"), F.count("percentage").alias("n_measured"), F.count(F.lit(1)).alias("n_real"))
        actual = _dated_real(t).groupBy(ACTIVITY, "period").agg(*sums)
    else:
        planned, actual = _planned(daily), _actual(daily)
    planned = planned.join(activities, ACTIVITY)
    return spans_progress(planned, actual, activities, interval_spans(t, planned, fanout), fanout)


def work_activities(t: Tables) -> DataFrame:
    """(activity, schedule, work) of all top activities of known works."""
    owners = t.schedule.select(SCHEDULE, WORK).join(t.civil_work, WORK, "left_semi")
    return top_activities(t).join(owners, SCHEDULE).select(ACTIVITY, SCHEDULE, WORK)


def _planned(daily: DataFrame) -> DataFrame:
    return daily.filter("n_foreseen > 0").select(ACTIVITY, "period", "fraction", "n_foreseen")


def _actual(daily: DataFrame) -> DataFrame:
    return daily.filter("n_real > 0").select(ACTIVITY, "period", "percentage", "n_measured", "n_real")


def interval_spans(t: Tables, planned: DataFrame, fanout: str = "collapse") -> DataFrame:
    """(work, period, lo, hi): the calendar days whose measurements count for each planned period of a work."""
    points = planned.select(WORK, "period")
    if fanout == "collapse":
        return covering_span(points, interval_rows(t))
    return covering_intervals(points.distinct(), calendar_intervals(t))


def daily_spans_progress(daily: DataFrame, activities: DataFrame, spans: DataFrame) -> DataFrame:
    """``progress_by_interval`` from daily sums, the works of activities, and spans that are known."""
    return spans_progress(_planned(daily).join(activities, ACTIVITY), _actual(daily), activities, spans, "collapse")


def spans_progress(planned: DataFrame, actual: DataFrame, activities: DataFrame, spans: DataFrame, fanout: str) -> DataFrame:
    """What was measured within the span of each planned period, and what was planned there, per work and period."""
    ends = F.explode(
        F.array(
            F.struct(F.col("lo").alias("pos"), F.lit(-1).alias("sign")),
            F.struct(F.col("hi").alias("pos"), F.lit(1).alias("sign")),
        )
    )
    probes = (
        planned.join(spans, [WORK, "period"])
        .select("*", ends.alias("e"))
        .select(ACTIVITY, WORK, "period", "lo", "hi", "fraction", "n_foreseen", "e.pos", "e.sign")
        .repartition(ACTIVITY)
    )
    measured = (
        actual.repartition(ACTIVITY)
        .join(activities.select(ACTIVITY), ACTIVITY, "left_semi")
        .select(
            ACTIVITY, F.unix_date("period").alias("pos"), F.lit(0).alias("sign"),
            "percentage", "n_measured", "n_real",
        )
    )
    # Both sides of the union are partitioned by activity, so the window shuffles neither again.
    # Measurements of a day come before the ends that fall on it: both bounds include their day.
    so_far = (
        Window.partitionBy(ACTIVITY)
        .orderBy("pos", F.col("sign") != 0)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = ("percentage", "n_measured", "n_real")
    sign = F.col("sign")
    within = (
        probes.unionByName(measured, allowMissingColumns=True)
        .withColumns({c: F.coalesce(F.sum(c).over(so_far), F.lit(0)) for c in running})
        .filter(sign != 0)
        .groupBy(ACTIVITY, WORK, "period", "lo", "hi")
        .agg(
            *(F.sum(F.col(c) * sign).alias(c) for c in running),
            F.max("fraction").alias("fraction"),
            F.max("n_foreseen").alias("n_foreseen"),
        )
    )
    fraction = F.col("fraction")
    percentage = F.when(F.col("n_measured") > 0, F.col("percentage"))
    if fanout == "join":
        fraction = fraction.cast("decimal(19,0)") * F.greatest(F.col("n_real"), F.lit(1))
        percentage = percentage.cast("decimal(19,0)") * F.col("n_foreseen")
    return (
        within.groupBy(WORK, "period")
        .agg(F.sum(fraction).alias("foreseen"), F.sum(percentage).alias("accomplished"))
        .select(
            WORK,
            "period",
            _decimal(F.col("foreseen"), 4).cast("decimal(9,2)").alias("foreseen_progress"),
            _decimal(F.col("accomplished"), 4).alias("accomplished_progress"),
        )
    )


def status_date(t: Tables, latest_only: bool = True) -> DataFrame:
    """(work, status_date): date of the last measurement, through the latest term or all terms.

    NULL for a work without measurements. Every join has one row per key on the right.
    """
    measured = t.real_progress.groupBy("id_term_activity").agg(
        F.max(F.col("progress_date").cast("date")).alias("status_date")
    )
    by_term = (
        t.term_activity.join(measured, "id_term_activity")
        .groupBy(TERM)
        .agg(F.max("status_date").alias("status_date"))
    )
    terms = latest_term(t) if latest_only else t.term
    by_work = (
        terms.select(WORK, TERM).join(by_term, TERM).groupBy(WORK).agg(F.max("status_date").alias("status_date"))
    )
    return t.civil_work.select(WORK).join(by_work, WORK, "left")


def accumulate(base: DataFrame, status: DataFrame) -> DataFrame:
    """``base`` with running totals per work: foreseen capped at 100, accomplished up to the status date.

    A NULL status date masks nothing.
    """
    by_period = Window.partitionBy(WORK).orderBy("period")
    foreseen = F.sum("foreseen_progress").over(by_period)
    accomplished = F.sum("accomplished_progress").over(by_period)
    masked = F.col("period") > F.col("status_date")
    return (
        base.join(status, WORK)
        .withColumn("foreseen_progress_accumulated", F.when(foreseen > 100, 100).otherwise(foreseen))
        .withColumn("accomplished_progress_accumulated", F.when(masked, None).otherwise(accomplished))
        .drop("status_date")
    )
