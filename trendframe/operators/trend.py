"""Deviation ratios, estimates and the three forecast stages.

A base has at most one row per work and period, and the periods are dates, so a work's window holds a
bounded number of rows. All windows of all stages share one ordering: one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendframe.functions import safe_div
from trendframe.schemas import MEASURES, SCHEDULE, TERM, WORK


def _add_stage(
    df: DataFrame,
    stage: str,
    foreseen: Column,
    accomplished: Column,
    present: Column,
    n: int,
    prior: str | None = None,
) -> DataFrame:
    """Add the six measures of one stage as ``<stage>_<measure>`` columns, NULL where not ``present``.

    ``prior`` is the prefix of the preceding stage's measures, None for the first stage.
    """
    series = Window.partitionBy(WORK).orderBy("period")
    everything = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    preceding = series.rowsBetween(Window.unboundedPreceding, -1)
    name = lambda measure: f"{stage}_{measure}"
    foreseen = foreseen.cast("double")
    accomplished = accomplished.cast("double")
    if prior is None:
        deviation = safe_div(accomplished, foreseen)
        eligible = accomplished.isNotNull()
        known = accomplished
    else:
        prior_trend = F.col(f"{prior}_trend_period")
        implied = safe_div(prior_trend, foreseen)
        deviation = F.coalesce(F.col(f"{prior}_initial_deviation"), implied)
        eligible = implied.isNotNull()
        known = F.coalesce(accomplished, prior_trend)

    dev = F.col(name("initial_deviation"))
    df = df.withColumns(
        {
            "_present": present,
            "_eligible": present & eligible,
            name("initial_deviation"): F.when(present, deviation),
        }
    )
    # The rank counts eligible rows from the newest backwards. The last n are averaged; `current` is the
    # newest of them and `previous` the n - 1 oldest, so the two overlap when fewer than n exist.
    flag = F.col("_eligible").cast("int")
    df = df.withColumns({"_count": F.sum(flag).over(everything), "_passed": F.sum(flag).over(so_far)})
    rank = F.col("_count") - F.col("_passed") + 1
    kept = F.col("_eligible") & (rank <= n)
    mobile = F.when(kept, dev)
    previous = F.when(kept & (rank >= F.least(F.col("_count"), F.lit(n)) - n + 2), dev)
    current = F.when(kept & (rank == 1), dev)
    # Deviation of the preceding row of this stage, which need not be the preceding row here.
    before = F.last(F.when(F.col("_present"), F.struct(dev.alias("dev"))), ignorenulls=True)
    df = df.withColumns(
        {
            name("mobile_deviation"): mobile,
            name("previous_estimate"): previous,
            name("current_estimate"): current,
            "_mobile": F.avg(mobile).over(everything),
            "_previous": F.avg(previous).over(everything),
            "_current": F.avg(current).over(everything),
            "_before": before.over(preceding),
        }
    )
    seasonal = F.when(F.col("_previous") == 1, F.col("_mobile")).otherwise(
        (F.col("_previous") + F.col("_current")) / 2
    )
    ahead = F.when(F.col("_before.dev").isNotNull(), seasonal * foreseen)
    return df.select(
        *(c for c in df.columns if not c.startswith("_")),
        F.when(F.col("_present"), seasonal).alias(name("seasonal_estimate")),
        F.when(F.col("_present"), F.coalesce(known, ahead)).alias(name("trend_period")),
    )


def _stage_columns(stage: str) -> list[Column]:
    return [F.col(f"{stage}_{m}").alias(m) for m in MEASURES]


def _keys(df: DataFrame) -> list[str]:
    return [k for k in (WORK, SCHEDULE, TERM) if k in df.columns]


def trend_first(base: DataFrame, n: int = 3) -> DataFrame:
    """First stage: measured progress, else the seasonal estimate one period past the measurements."""
    staged = _add_stage(
        base, "s", F.col("foreseen_progress"), F.col("accomplished_progress"), F.lit(True), n
    )
    return staged.select("period", *_stage_columns("s"), *_keys(base))


def trend_next(base: DataFrame, previous: DataFrame, n: int = 3) -> DataFrame:
    """A further stage from ``base`` and the result of the stage before; one more period is filled.

    Only periods in both survive. ``previous`` is any earlier result, such as one read back from storage.
    """
    prior = previous.select(
        WORK,
        F.col("period").cast("date").alias("period"),
        F.col("initial_deviation").alias("p_initial_deviation"),
        F.col("trend_period").alias("p_trend_period"),
    )
    staged = _add_stage(
        base.join(prior, [WORK, "period"]),
        "s", F.col("foreseen_progress"), F.col("accomplished_progress"), F.lit(True), n, "p",
    )
    return staged.select("period", *_stage_columns("s"), *_keys(base))


def _tag(bases: Sequence[DataFrame]) -> DataFrame:
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        (base.withColumn("base", F.lit(i)) for i, base in enumerate(bases)),
    )


def trend_chain(
    base: DataFrame | Sequence[DataFrame], horizon: int = 3, n: int = 3
) -> DataFrame:
    """All stages in one pass: a result row per (stage, work, period).

    ``base`` is one DataFrame for every stage or one per stage, given as a list or as one DataFrame whose
    column ``base`` counts from 0. With several, a period is in a stage if it is in that stage's base
    and in the stage before.
    """
    if not isinstance(base, DataFrame):
        if len(base) != horizon:
            raise ValueError(f"{horizon} stages need {horizon} bases, not {len(base)}")
        base = _tag(base)
    keys = [
        F.col(k) if k in base.columns else F.lit(None).cast("long").alias(k) for k in (SCHEDULE, TERM)
    ]
    values = F.struct(
        F.col("foreseen_progress").cast("double").alias("foreseen_progress"),
        F.col("accomplished_progress").cast("double").alias("accomplished_progress"),
        *keys,
    )
    if "base" in base.columns:
        source = [f"b{i}" for i in range(horizon)]
        # One row per (work, period) with the values of every base, NULL where it has none. Grouping
        # what is already partitioned by work leaves the windows nothing to shuffle.
        df = (
            base.select(WORK, "period", "base", values.alias("v"))
            .repartition(WORK)
            .groupBy(WORK, "period")
            .agg(
                *(
                    F.first(F.when(F.col("base") == i, F.col("v")), ignorenulls=True).alias(b)
                    for i, b in enumerate(source)
                )
            )
        )
    else:
        source = ["b0"] * horizon
        df = base.select(WORK, "period", values.alias("b0"))

    results = []
    present = F.lit(True)
    for k, b in enumerate(source):
        present = present & F.col(b).isNotNull()
        df = _add_stage(
            df, f"s{k}", F.col(f"{b}.foreseen_progress"), F.col(f"{b}.accomplished_progress"),
            present, n, f"s{k - 1}" if k else None,
        )
        row = F.struct(
            F.lit(k + 1).alias("stage"), "period", *_stage_columns(f"s{k}"),
            WORK, f"{b}.{SCHEDULE}", f"{b}.{TERM}",
        )
        results.append(F.when(present, row))
    stages = df.select(F.explode(F.array(*results)).alias("r"))
    return stages.filter(F.col("r").isNotNull()).select("r.*")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, where expressions of arrays would repeat it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _mean(rows: Column) -> Column:
    """Mean deviation of ``rows``, NULL if none has one."""
    known = F.filter(F.transform(rows, lambda x: x["dev"]), lambda d: d.isNotNull())
    return _let(known, lambda d: F.when(F.size(d) > 0, F.aggregate(d, F.lit(0.0), lambda a, b: a + b) / F.size(d)))


def _next_stage(rows: Column, k: Column, source: Column, n: int) -> Column:
    """The rows of stage ``k`` from those of the stage before: their deviation and trend, and the other measures."""

    def measured(r: Column) -> Column:
        v = F.get(r["v"], source)
        implied = safe_div(r["trend"], v["foreseen_progress"])
        return F.struct(
            r["period"].alias("period"),
            r["v"].alias("v"),
            v["foreseen_progress"].alias("foreseen"),
            F.coalesce(r["dev"], implied).alias("dev"),
            F.when(k == 1, r["trend"].isNotNull()).otherwise(implied.isNotNull()).alias("eligible"),
            F.coalesce(v["accomplished_progress"], r["trend"]).alias("known"),
        )

    def estimated(x: Column) -> Column:
        eligible = F.filter(x, lambda r: r["eligible"])
        last = F.slice(eligible, F.greatest(F.size(eligible) - n, F.lit(0)) + 1, n)

        def finished(last: Column) -> Column:
            earlier = F.slice(last, 1, n - 1)
            newest = F.get(last, F.size(last) - 1)
            averages = F.struct(_mean(last).alias("mobile"), _mean(earlier).alias("previous"), newest["dev"].alias("current"))

            def row(a: Column):
                seasonal = F.when(a["previous"] == 1, a["mobile"]).otherwise((a["previous"] + a["current"]) / 2)

                def one(r: Column, i: Column) -> Column:
                    within = lambda part: r["eligible"] & (r["period"] >= F.get(part, F.lit(0))["period"])
                    up_to = F.get(earlier, F.size(earlier) - 1)["period"]
                    ahead = F.when(F.get(x, i - 1)["dev"].isNotNull(), seasonal * r["foreseen"])
                    return F.struct(
                        r["period"].alias("period"),
                        r["v"].alias("v"),
                        r["dev"].alias("dev"),
                        F.coalesce(r["known"], ahead).alias("trend"),
                        F.when(within(last), r["dev"]).alias("mobile"),
                        F.when(within(earlier) & (r["period"] <= up_to), r["dev"]).alias("previous"),
                        F.when(r["eligible"] & (r["period"] == newest["period"]), r["dev"]).alias("current"),
                        seasonal.alias("seasonal"),
                    )

                return F.transform(x, one)

            return _let(averages, row)

        return _let(last, finished)

    return _let(F.transform(F.filter(rows, lambda r: F.get(r["v"], source).isNotNull()), measured), estimated)


def trend_fold(base: DataFrame, horizon: int = 3, n: int = 3) -> DataFrame:
    """``trend_chain`` as one fold over the stages of each work's sorted array of periods.

    ``base`` is one DataFrame for every stage, or one whose column ``base`` counts from 0 to ``horizon`` - 1. The plan does not grow
    with ``horizon``: an aggregate by work, which needs no exchange on a base partitioned by it, and one expression.
    """
    several = "base" in base.columns
    keys = [F.col(k) if k in base.columns else F.lit(None).cast("long").alias(k) for k in (SCHEDULE, TERM)]
    values = F.struct(
        F.col("foreseen_progress").cast("double").alias("foreseen_progress"),
        F.col("accomplished_progress").cast("double").alias("accomplished_progress"),
        *keys,
    )
    if several:
        picked = [F.first(F.when(F.col("base") == i, F.col("v")), ignorenulls=True) for i in range(horizon)]
        rows = base.select(WORK, "period", "base", values.alias("v")).repartition(WORK).groupBy(WORK, "period").agg(F.array(*picked).alias("v"))
    else:
        rows = base.select(WORK, "period", F.array(values).alias("v"))
    works = rows.groupBy(WORK).agg(F.sort_array(F.collect_list(F.struct("period", "v"))).alias("rows"))

    nothing = F.lit(None).cast("double")
    start = F.transform(
        "rows",
        lambda r: F.struct(
            r["period"].alias("period"), r["v"].alias("v"), nothing.alias("dev"),
            F.get(r["v"], F.lit(0))["accomplished_progress"].alias("trend"),
            *(nothing.alias(c) for c in ("mobile", "previous", "current", "seasonal")),
        ),
    )

    def step(state: Column, k: Column) -> Column:
        source = k - 1 if several else F.lit(0)

        def with_stage(rows: Column) -> Column:
            of_stage = lambda r: F.struct(
                k.alias("stage"), r["period"].alias("period"), r["dev"].alias("initial_deviation"), r["mobile"].alias("mobile_deviation"),
                r["previous"].alias("previous_estimate"), r["current"].alias("current_estimate"), r["seasonal"].alias("seasonal_estimate"),
                r["trend"].alias("trend_period"), F.get(r["v"], source)[SCHEDULE].alias(SCHEDULE), F.get(r["v"], source)[TERM].alias(TERM),
            )
            return F.struct(rows.alias("rows"), F.concat(state["out"], F.transform(rows, of_stage)).alias("out"))

        return _let(_next_stage(state["rows"], k, source, n), with_stage)

    measures = ", ".join(f"{m}: double" for m in MEASURES)
    out = F.array().cast(f"array<struct<stage: int, period: date, {measures}, {SCHEDULE}: long, {TERM}: long>>")
    stages = F.sequence(F.lit(1), F.lit(horizon))
    folded = F.aggregate(stages, F.struct(start.alias("rows"), out.alias("out")), step, lambda state: state["out"])
    return works.select(WORK, F.explode(folded).alias("r")).select("r.stage", "r.period", *(f"r.{m}" for m in MEASURES), WORK, f"r.{SCHEDULE}", f"r.{TERM}")
