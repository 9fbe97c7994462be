"""The whole workload: input tables to the three result stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendframe.operators.progress import (
    calendar_progress,
    progress_by_calendar,
    progress_by_interval,
    stored_daily_facts,
)
from trendframe.operators.refresh import affected_works, change_log, replace_by_key, restrict
from trendframe.operators.trend import trend_chain
from trendframe.schemas import ACTIVITY, CHANGE_LOG, SCHEDULE, TABLES, TERM
from trendframe.sources import Tables


def forecast(t: Tables, n: int = 3) -> DataFrame:
    """The three stages on their own bases, as the source scripts define them.

    Stage 1 takes the term of the newest schedule, stage 2 the newest term, stage 3 the progress per
    calendar interval over all schedules. All need the daily sums of the facts, which are stored once.
    """
    daily = stored_daily_facts(t)
    calendar = calendar_progress(t, [(SCHEDULE, TERM), (TERM,)], daily=daily)
    interval = progress_by_interval(t, daily=daily).withColumn("base", F.lit(2))
    return trend_chain(calendar.unionByName(interval, allowMissingColumns=True), horizon=3, n=n)


def forecast_calendar(t: Tables, n: int = 3) -> DataFrame:
    """The three stages on the calendar base, which then needs one exchange for all of them."""
    return trend_chain(progress_by_calendar(t), horizon=3, n=n)


def trend_refresh(
    current: DataFrame, changes: DataFrame, t: Tables, folder: str, plan=forecast
) -> DataFrame:
    """``current`` results with the works touched by ``changes`` recomputed; ``t`` is from before them.

    The change log, the works and their facts are written below ``folder``.
    """
    log, works = stored_changes(changes, t, f"{folder}/log", f"{folder}/works")
    return replace_by_key(current, plan(restrict(t, log, works, f"{folder}/scope")), works)


def stored_changes(
    changes: DataFrame, t: Tables, log_path: str, works_path: str
) -> tuple[DataFrame, DataFrame]:
    """Write the log of ``changes`` and the works they touch; both are read back.

    The works come from the stored log, dead and live entries alike, so ``changes`` is evaluated once.
    """
    spark = changes.sparkSession
    change_log(changes).write.mode("overwrite").parquet(log_path)
    log = spark.read.schema(CHANGE_LOG).parquet(log_path)
    entries = log.select(ACTIVITY, F.lit(None).cast("long").alias("before_activity"))
    works = affected_works(entries, t.qualitative_activity, t.schedule)
    works.write.mode("overwrite").parquet(works_path)
    return log, spark.read.schema(TABLES["civil_work"]).parquet(works_path)
