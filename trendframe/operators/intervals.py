"""Calendar intervals ``(start, end]`` and the intervals a date falls into."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendframe.schemas import INPUT, TERM, WORK
from trendframe.session import stored
from trendframe.sources import Tables

# Days are counted as integers from 1970-01-01; this one stands for an open lower bound.
OPEN = -(2**31)
BIN_DAYS = 31


def previous_in_group(df: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """Add ``out``: ``value`` of the preceding row of ``group`` by the unique integer ``order``.

    A plain ``lag`` over ``group`` would put a whole group into one task. Here rows are dealt by ranges of
    (group, order) with about equally many rows, whatever the keys are, and stored with the number of their range.
    They are ordered within it, and of each group only the last row of each range is ordered across.
    """
    ranges = df.repartitionByRange(group, order).withColumn("_block", F.spark_partition_id())
    df = stored(ranges, "ranges")
    in_block = Window.partitionBy(group, "_block").orderBy(order)
    across = Window.partitionBy(group).orderBy("_block")
    carried = (
        df.groupBy(group, "_block")
        .agg(F.max_by(value, order).alias("_last"))
        .select(group, "_block", F.lag("_last").over(across).alias("_carry"))
    )
    # The struct tells a preceding row with a NULL value from no preceding row.
    seen = df.withColumn("_prev", F.lag(F.struct(F.col(value).alias("v"))).over(in_block))
    previous = F.when(F.col("_prev").isNotNull(), F.col("_prev.v")).otherwise(F.col("_carry"))
    return (
        seen.join(carried, [group, "_block"]).withColumn(out, previous).drop("_block", "_prev", "_carry")
    )


def interval_rows(t: Tables) -> DataFrame:
    """``calendar_intervals`` where two calendars of a work may give the same interval twice."""
    owner = t.term.join(t.civil_work, WORK, "left_semi").select(TERM, WORK)
    used = t.term_input_data.join(owner, TERM).select(WORK, INPUT).distinct()
    bounds = (
        previous_in_group(t.calendar.select(INPUT, "sdc_cod", "calendar_period"), INPUT, "sdc_cod", "calendar_period", "interval_start")
        .select(INPUT, "interval_start", F.col("calendar_period").alias("interval_end"))
        .distinct()
    )
    return used.join(bounds, INPUT).select(WORK, "interval_start", "interval_end")


def calendar_intervals(t: Tables) -> DataFrame:
    """(work, interval_start, interval_end): distinct calendar intervals of each work.

    The start is the period of the preceding row of the same calendar, NULL (open) for its first row.
    """
    return interval_rows(t).distinct()


def covering_span(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """(work, period, lo, hi): the union ``(lo, hi]`` of the intervals that hold each period.

    ``points`` has (work, period); either input may repeat rows. All intervals holding a date overlap, so
    their union is the smallest start to the greatest end: the greatest end among intervals starting
    before the date, and the smallest start among those ending on or after it. Both are running
    extremes, so no date is ever paired with an interval. Rows are first combined per day, so a work's
    window holds at most three rows per day.
    """
    start = F.coalesce(F.unix_date("interval_start"), F.lit(OPEN))
    end = F.unix_date("interval_end")
    none = F.lit(None).cast("int")

    def mark(pos, kind, origin=none, reach=none):
        # At one position an end comes before the date and a start after it: (start, end].
        return F.struct(
            pos.alias("pos"), F.lit(kind).alias("kind"), origin.alias("origin"), reach.alias("reach")
        )

    ends = F.explode(F.array(mark(end, 0, origin=start), mark(start, 2, reach=end)))
    rows = (
        intervals.select(WORK, ends.alias("m"))
        .unionByName(points.select(WORK, mark(F.unix_date("period"), 1).alias("m")))
        .select(WORK, "m.*")
        .groupBy(WORK, "pos", "kind")
        .agg(F.min("origin").alias("origin"), F.max("reach").alias("reach"))
    )
    upward = Window.partitionBy(WORK).orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    downward = (
        Window.partitionBy(WORK).orderBy(F.desc("pos"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn("hi", F.max("reach").over(upward))
        .withColumn("lo", F.min("origin").over(downward))
        .filter((F.col("kind") == 1) & (F.col("hi") >= F.col("pos")))
        .select(WORK, F.date_from_unix_date("pos").alias("period"), "lo", "hi")
    )


def covering_intervals(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """(work, period, lo, hi): one row per period and interval holding it.

    ``points`` has distinct (work, period), ``intervals`` distinct rows.
    An equi-join on month-sized bins tests each date against the intervals of its bin only.
    """
    bin_of = lambda day: F.floor(day / F.lit(BIN_DAYS))
    dated = points.withColumn("_day", F.unix_date("period"))
    span = dated.groupBy(WORK).agg(F.min("_day").alias("_min"), F.max("_day").alias("_max"))
    lo = F.coalesce(F.unix_date("interval_start"), F.lit(OPEN))
    binned = (
        intervals.select(WORK, lo.alias("lo"), F.unix_date("interval_end").alias("hi"))
        .join(span, WORK)
        .withColumn("_from", F.greatest(F.col("lo") + F.lit(1), F.col("_min")))
        .withColumn("_to", F.least(F.col("hi"), F.col("_max")))
        .filter(F.col("_from") <= F.col("_to"))
        .withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_from")), bin_of(F.col("_to")))))
        .select(WORK, "lo", "hi", "_bin")
    )
    return (
        dated.withColumn("_bin", bin_of(F.col("_day")))
        .join(binned, [WORK, "_bin"])
        .filter((F.col("_day") > F.col("lo")) & (F.col("_day") <= F.col("hi")))
        .select(WORK, "period", "lo", "hi")
    )
