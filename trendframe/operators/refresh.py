"""Recomputing only what a set of changes touches."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendframe.schemas import ACTIVITY, INPUT, REAL_ID, SCHEDULE, TABLES, TERM, WORK
from trendframe.sources import Tables

REAL_COLUMNS = [f.name for f in TABLES["real_progress"].fields]


def affected_works(changes: DataFrame, activity: DataFrame, schedule: DataFrame) -> DataFrame:
    """Distinct works whose measurements changed: change -> activity -> schedule -> work.

    The images before and after a change both count, so a measurement that moves touches two works.
    """
    images = F.array("before_activity", ACTIVITY)
    touched = changes.select(F.explode(images).alias(ACTIVITY)).distinct()
    schedules = touched.join(activity.select(ACTIVITY, SCHEDULE), ACTIVITY).select(SCHEDULE).distinct()
    return schedules.join(schedule.select(SCHEDULE, WORK), SCHEDULE).select(WORK).distinct()


def replace_by_key(current: DataFrame, fresh: DataFrame, keys: DataFrame) -> DataFrame:
    """``current`` without the rows of ``keys``, plus ``fresh``."""
    kept = current.join(keys, keys.columns, "left_anti").select(*current.columns)
    return kept.unionByName(fresh)


def change_log(changes: DataFrame) -> DataFrame:
    """Change rows as log entries of one (activity, measurement) each.

    The image before a change is a dead entry under its activity, the image after it a live one. So
    the newest entry per (activity, measurement) says whether the row is there, and a reader that wants
    some activities need not look at others, even if a measurement moved between them.
    """
    nothing = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in TABLES["real_progress"].fields
        if f.name not in (REAL_ID, ACTIVITY)
    ]
    dead = F.struct(
        F.lit(False).alias("live"), REAL_ID, F.col("before_activity").alias(ACTIVITY), *nothing
    )
    live = F.struct(F.lit(True).alias("live"), *REAL_COLUMNS)
    entries = F.array(
        F.when(F.col("before_activity").isNotNull(), dead), F.when(F.col(ACTIVITY).isNotNull(), live)
    )
    return (
        changes.select("seq", F.explode(entries).alias("e")).filter(F.col("e").isNotNull()).select("seq", "e.*")
    )


def current_rows(real: DataFrame, log: DataFrame) -> DataFrame:
    """The measurements after all log entries.

    A row of ``real`` counts unless the log names its activity and id; of each pair that it names the
    newest entry counts, if that is a live one. Only the log is grouped, so rows of ``real`` may repeat. ``log`` may carry
    ``batch_id``; entries are ordered by it, then by ``seq``. Both inputs may be cut down to some
    activities beforehand.
    """
    if "batch_id" not in log.columns:
        log = log.withColumn("batch_id", F.lit(0).cast("long"))
    order = ["batch_id", "seq", "live"]
    rest = [c for c in REAL_COLUMNS if c not in (ACTIVITY, REAL_ID)]
    named = log.groupBy(ACTIVITY, REAL_ID).agg(F.max(F.struct(*order, *rest)).alias("_n"))
    live = named.filter("_n.live").select(
        *(c if c in (ACTIVITY, REAL_ID) else F.col(f"_n.{c}").alias(c) for c in REAL_COLUMNS)
    )
    pair = F.col(f"r.{ACTIVITY}").eqNullSafe(F.col(f"n.{ACTIVITY}")) & F.col(f"r.{REAL_ID}").eqNullSafe(F.col(f"n.{REAL_ID}"))
    untouched = real.alias("r").join(named.alias("n"), pair, "left_anti").select(*REAL_COLUMNS)
    return untouched.unionByName(live)


def restrict(t: Tables, log: DataFrame, works: DataFrame, folder: str) -> Tables:
    """``t`` after the log, cut down to ``works``; every table that is cut is written below ``folder``.

    Each fact table is read once: the range of the touched activities is pushed to its scan, where it skips the row
    groups of others in files sorted by activity, and a semi-join keeps their rows. How that join is
    done is the planner's choice by the size of the stored activities.
    """
    spark = works.sparkSession

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}")

    schedule = kept("schedule", t.schedule.join(works, WORK, "left_semi"))
    term = kept("term", t.term.join(works, WORK, "left_semi"))
    links = kept("term_input_data", t.term_input_data.join(term, TERM, "left_semi"))
    activity = kept("qualitative_activity", t.qualitative_activity.join(schedule, SCHEDULE, "left_semi"))
    low, high = activity.agg(F.min(ACTIVITY), F.max(ACTIVITY)).first()
    keys = activity.select(ACTIVITY)
    only = lambda df: df.filter(F.col(ACTIVITY).between(low, high)).join(keys, ACTIVITY, "left_semi")
    return replace(
        t,
        civil_work=t.civil_work.join(works, WORK, "left_semi"),
        schedule=schedule,
        term=term,
        term_input_data=links,
        calendar=kept("calendar", t.calendar.join(links, INPUT, "left_semi")),
        term_activity=kept("term_activity", t.term_activity.join(term, TERM, "left_semi")),
        qualitative_activity=activity,
        foreseen_progress=kept("foreseen_progress", only(t.foreseen_progress).select(*TABLES["foreseen_progress"].names)),
        real_progress=kept("real_progress", current_rows(only(t.real_progress), only(log))),
    )
