"""The parts of a forecast that measurements do not change, and daily sums, kept apart so that a refresh reads no fact.

A frame has four tables. ``owners`` says whose each top activity is, ``targets`` on which dates of which terms the calendar
bases stand, ``spans`` which days count for each period of the interval base, and ``daily`` sums both facts per activity and day. The first three follow
from schedules, terms, calendars and plans; changes of these need a new frame. ``daily`` changes with measurements, by
adding signed sums of what was and what is.

Stored tables are partitioned by a bucket of the work, since a refresh wants whole works: the touched works prune the folders that
their scans open.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendframe.operators.progress import (
    calendar_targets,
    current_terms,
    daily_facts,
    daily_spans_progress,
    interval_spans,
    targets_progress,
    top_activities,
    work_activities,
)
from trendframe.operators.trend import trend_chain
from trendframe.schemas import ACTIVITY, SCHEDULE, TERM, WORK
from trendframe.session import stored
from trendframe.sources import Tables

#: Works per bucket that a store aims at, and buckets at most.
WORKS_PER_BUCKET, MOST_BUCKETS = 16, 4096

DAILY = f"{ACTIVITY} long, period date, fraction long, percentage long, n_foreseen long, n_real long, n_measured long"
DAILY_COLUMNS = [column.split()[0] for column in DAILY.split(", ")]
SCHEMAS = {
    "owners": f"{ACTIVITY} long, {SCHEDULE} long, {WORK} long",
    "targets": f"base int, {WORK} long, {SCHEDULE} long, {TERM} long, period date, n_calendar long",
    "spans": f"{WORK} long, period date, lo int, hi int",
    "daily": f"{DAILY}, {WORK} long",
}


@dataclass(frozen=True)
class Frame:
    owners: DataFrame
    targets: DataFrame
    spans: DataFrame
    daily: DataFrame


def frame(t: Tables) -> Frame:
    """The frame of all works. Daily sums, which several parts read, are stored; the rest is a plan."""
    daily = stored(daily_facts(t, top_activities(t)), "daily-facts")
    owners = work_activities(t)
    planned = daily.filter("n_foreseen > 0").join(owners, ACTIVITY)
    targets = calendar_targets(t, current_terms(t, [(SCHEDULE, TERM), (TERM,)]))
    return Frame(owners, targets, interval_spans(t, planned), daily.join(owners.select(ACTIVITY, WORK), ACTIVITY))


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(WORK), F.lit(buckets)).cast("int")


def buckets_for(t: Tables) -> int:
    return max(1, min(MOST_BUCKETS, t.civil_work.count() // WORKS_PER_BUCKET))


def write_frame(f: Frame, path: str, buckets: int) -> None:
    """Write each table of ``f`` with a folder per bucket of its works, sorted by work.

    Tasks take ranges of buckets, so there are no more files than buckets and tasks together, however many rows there are.
    """
    spark = f.owners.sparkSession
    # A given number, since small rows would be coalesced to one task, which would write the folders one by one.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in SCHEMAS:
        rows = getattr(f, name).select(*_names(name)).withColumn("bucket", bucket(buckets))
        # Rows of a hot work may lie in several files of its bucket: activities part them.
        if ACTIVITY in rows.columns:
            dealt = rows.repartitionByRange(tasks, "bucket", WORK, ACTIVITY)
        else:
            dealt = rows.repartition(min(tasks, buckets), "bucket")
        dealt.sortWithinPartitions("bucket", WORK).write.partitionBy("bucket").parquet(f"{path}/{name}")
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/buckets")


def _names(name: str) -> list[str]:
    return [column.split()[0] for column in SCHEMAS[name].split(", ")]


def read_frame(spark: SparkSession, path: str) -> tuple[Frame, int]:
    """The frame written below ``path``, each table with its ``bucket``, and the number of buckets."""
    tables = {f.name: spark.read.schema(f"{SCHEMAS[f.name]}, bucket int").parquet(f"{path}/{f.name}") for f in fields(Frame)}
    return Frame(**tables), spark.read.schema("buckets int").parquet(f"{path}/buckets").first()[0]


def of_works(f: Frame, works: DataFrame) -> Frame:
    """The frame of ``works``, stored rows of (work, bucket). The filter, true of all, lets the planner prune folders by them."""
    keys = works.select(WORK, "bucket").filter(F.col("bucket") >= 0)
    return Frame(**{x.name: getattr(f, x.name).join(keys, [WORK, "bucket"], "left_semi") for x in fields(Frame)})


def merged(base: DataFrame, deltas: DataFrame) -> DataFrame:
    """Daily sums (activity, work, period, ...) after signed ``deltas``; days that hold nothing any more are gone."""
    measures = ["fraction", "percentage", "n_foreseen", "n_real", "n_measured"]
    columns = [ACTIVITY, WORK, "period", *measures]
    rows = base.select(*columns).unionByName(deltas.select(*columns))
    sums = rows.groupBy(ACTIVITY, WORK, "period").agg(*(F.sum(m).alias(m) for m in measures))
    # A sum is NULL where nothing was measured, also where all that was is gone again.
    percentage = F.when(F.col("n_measured") > 0, F.col("percentage"))
    return sums.filter("n_foreseen > 0 OR n_real > 0").withColumn("percentage", percentage)


def forecast_frame(f: Frame, n: int = 3) -> DataFrame:
    """The three stages on their own bases, from a frame whose ``daily`` is stored."""
    calendar = targets_progress(f.daily.drop(WORK, "bucket"), f.owners, f.targets)
    interval = daily_spans_progress(f.daily.drop(WORK, "bucket"), f.owners.select(ACTIVITY, WORK), f.spans.select(WORK, "period", "lo", "hi"))
    return trend_chain(calendar.unionByName(interval.withColumn("base", F.lit(2)), allowMissingColumns=True), horizon=3, n=n)


def with_daily(f: Frame, daily: DataFrame) -> Frame:
    return replace(f, daily=daily)
