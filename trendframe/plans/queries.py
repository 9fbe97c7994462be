"""The registered queries: every operator over whole tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendframe.functions import safe_div
from trendframe.operators import columns, dictionary
from trendframe.operators.deltas import changes_between
from trendframe.operators.intervals import calendar_intervals
from trendframe.operators.progress import (
    accumulate,
    latest_schedule,
    latest_term,
    progress_by_calendar,
    progress_by_interval,
    status_date,
    stored_foreseen_sums,
)
from trendframe.operators.refresh import affected_works
from trendframe.operators.trend import trend_chain, trend_first, trend_fold, trend_next
from trendframe.plans import fixtures
from trendframe.plans.forecast import forecast, forecast_calendar, trend_refresh
from trendframe.schemas import MEASURES, REAL_ID, SCHEDULE, TERM, WORK
from trendframe.session import scratch_dir, stored
from trendframe.sources import Tables
from trendframe.streaming import delta_stream, dictionary_stream
from trendframe.streaming.delta_stream import refresh_by_deltas

Query = Callable[[SparkSession, str], DataFrame]
COLUMN_PATTERN = "%RD[_]re[cd]%"


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in names})


def _progress(df: DataFrame) -> DataFrame:
    return _rounded(df, *(c for c in df.columns if "progress" in c))


def _trend(df: DataFrame) -> DataFrame:
    return _rounded(df, *(c for c in MEASURES if c in df.columns))


def safe_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ratio = F.round(safe_div("l_extendedprice", "l_discount"), 4)
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratio.alias("ratio"))


def q_latest_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_term(fixtures.schedule_tables(spark, sf_dir))


def q_latest_term_by_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_term(fixtures.schedule_tables(spark, sf_dir), (SCHEDULE, TERM))


def q_latest_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_schedule(fixtures.schedule_tables(spark, sf_dir))


def q_progress_by_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _progress(progress_by_calendar(fixtures.schedule_tables(spark, sf_dir)))


def q_progress_by_calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _progress(progress_by_calendar(fixtures.schedule_tables(spark, sf_dir), fanout="join"))


def q_calendar_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_intervals(fixtures.schedule_tables(spark, sf_dir))


def _interval_base(t: Tables, fanout: str = "collapse") -> DataFrame:
    """Measurements go from their table to the one plan that needs them; only foreseen sums, which it reads twice, are stored."""
    return progress_by_interval(t, fanout, planned=stored_foreseen_sums(t))


def q_progress_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _progress(_interval_base(fixtures.schedule_tables(spark, sf_dir, "all")))


def q_progress_by_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _progress(_interval_base(fixtures.schedule_tables(spark, sf_dir, "all"), "join"))


def status_date_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_date(fixtures.schedule_tables(spark, sf_dir, "all"))


def status_date_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_date(fixtures.schedule_tables(spark, sf_dir, "all"), latest_only=False)


def accumulated_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.schedule_tables(spark, sf_dir)
    return _progress(accumulate(progress_by_calendar(t), status_date(t)))


def accumulated_interval_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.schedule_tables(spark, sf_dir, "all")
    return _progress(accumulate(_interval_base(t), status_date(t, latest_only=False)))


def _calendar_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress_by_calendar(fixtures.schedule_tables(spark, sf_dir))


def _measure(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _trend(trend_first(_calendar_base(spark, sf_dir)).select(WORK, "period", name))

    return query


def q_trend_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.schedule_tables(spark, sf_dir)
    return _trend(trend_first(progress_by_calendar(t, latest_term_by=(SCHEDULE, TERM))))


def trend_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = stored(_calendar_base(spark, sf_dir), "calendar-base")  # two stages read it
    return _trend(trend_next(base, trend_first(base)))


def _stage(chain: DataFrame, k: int) -> DataFrame:
    return chain.filter(F.col("stage") == k).drop("stage")


def trend_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(_stage(trend_chain(_calendar_base(spark, sf_dir)), 3))


def trend_third_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.schedule_tables(spark, sf_dir)
    calendar = progress_by_calendar(t)
    second = _stage(trend_chain(calendar, horizon=2), 2)
    return _trend(trend_next(_interval_base(t), second))


def q_trend_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(forecast_calendar(fixtures.schedule_tables(spark, sf_dir)))


def trend_chain_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five averaged periods: the earliest four against the newest."""
    t = fixtures.schedule_tables(spark, sf_dir)
    return _trend(forecast_calendar(t, n=5))


def trend_eight_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight periods ahead, by the fold: its plan is the same for any number of stages."""
    return _trend(trend_fold(_calendar_base(spark, sf_dir), horizon=8))


def trend_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(forecast(fixtures.schedule_tables(spark, sf_dir)))


def q_affected_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.schedule_tables(spark, sf_dir)
    changes = fixtures.real_changes(spark, sf_dir, t)
    return affected_works(changes, t.qualitative_activity, t.schedule)


def _delta_store(spark: SparkSession, sf_dir: str, t: Tables) -> str:
    """A store with the forecast of ``t``, kept for the queries that start from it; they write to folders of their own."""
    return fixtures.kept_folder(spark, sf_dir, "delta-store", lambda folder: delta_stream.initialise(t, folder))


def trend_refresh_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of changes on stored results and daily sums; no fact is read."""
    t = fixtures.schedule_tables(spark, sf_dir)
    changes = fixtures.change_images(spark, sf_dir, t)
    return _trend(refresh_by_deltas(changes, _delta_store(spark, sf_dir, t), scratch_dir(spark, "refresh")))


def trend_refresh_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two versions of the measurements, which say what has changed."""
    t = fixtures.schedule_tables(spark, sf_dir)
    changes = changes_between(t.real_progress, fixtures.changed_version(spark, sf_dir, t))
    return _trend(refresh_by_deltas(changes, _delta_store(spark, sf_dir, t), scratch_dir(spark, "refresh")))


def changes_between_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What differs between two versions in which rows repeat."""
    t = fixtures.schedule_tables(spark, sf_dir)
    twice = lambda df, k: df.unionByName(df.filter(F.pmod(F.floor(F.col(REAL_ID) / 2), F.lit(k)) == 0))
    changes = changes_between(twice(t.real_progress, 10), twice(fixtures.changed_version(spark, sf_dir, t), 15))
    sides = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in t.real_progress.columns]
    return changes.select("weight", *sides)


def trend_refresh_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From change rows without their old values: the facts of touched works are read again."""
    t = fixtures.schedule_tables(spark, sf_dir)
    changes = fixtures.real_changes(spark, sf_dir, t)
    current = fixtures.kept(spark, sf_dir, "forecast", lambda: forecast(t))
    return _trend(trend_refresh(current, changes, t, scratch_dir(spark, "refresh")))


def trend_refresh_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch_dir(spark, "trend")
    t = fixtures.schedule_tables(spark, sf_dir)
    fixtures.change_images(spark, sf_dir, t).write.parquet(f"{store}/changes")
    delta_stream.initialise(t, store)
    changes = delta_stream.change_stream(spark, f"{store}/changes")
    delta_stream.start(changes, store, once=True).awaitTermination()
    return _trend(delta_stream.results(spark, store))


def dictionary_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.dictionary_snapshot(fixtures.routine_params(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def dictionary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = stored(dictionary.parse_events(fixtures.ddl_events(_events(spark, sf_dir))), "parsed-events")
    return dictionary.lookup_parameters(parsed, fixtures.customer_params(spark, sf_dir))


def dictionary_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with the payloads of a source that cuts off, empties and repeats some."""
    raw = fixtures.damaged_events(_events(spark, sf_dir))
    return dictionary.rejected_events(dictionary.read_events(raw)).drop("event_xml")


def _apply(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Events are parsed once and stored, then looked up and stored: both steps read their input several times."""
    events = _events(spark, sf_dir)
    parsed = stored(dictionary.parse_events(fixtures.ddl_events(events)), "parsed-events")
    looked_up = stored(dictionary.lookup_parameters(parsed, fixtures.event_params(events), mode), "events")
    state = dictionary.as_state(dictionary_snapshot(spark, sf_dir))
    return dictionary.dictionary(dictionary.dictionary_apply(state, looked_up, mode))


def dictionary_apply_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apply(spark, sf_dir, "each")


def dictionary_apply_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apply(spark, sf_dir, "one")


def dictionary_apply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch_dir(spark, "dictionary")
    events = _events(spark, sf_dir)
    dictionary_stream.initialise(dictionary_snapshot(spark, sf_dir), store)
    raw = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    dictionary_stream.start(
        fixtures.ddl_events(raw), fixtures.event_params(events), store, once=True
    ).awaitTermination()
    return dictionary_stream.current(spark, store)


def find_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols, tables = fixtures.part_catalog(spark, sf_dir)
    return columns.find_columns(cols, tables, COLUMN_PATTERN)


QUERIES: dict[str, Query] = {
    "safe_division": safe_division,
    "latest_term": q_latest_term,
    "latest_term_by_schedule": q_latest_term_by_schedule,
    "latest_schedule": q_latest_schedule,
    "progress_by_calendar": q_progress_by_calendar,
    "progress_by_calendar_join": q_progress_by_calendar_join,
    "calendar_intervals": q_calendar_intervals,
    "progress_by_interval": q_progress_by_interval,
    "progress_by_interval_join": q_progress_by_interval_join,
    "status_date_latest": status_date_latest,
    "status_date_all": status_date_all,
    "accumulated_progress": accumulated_progress,
    "accumulated_interval_progress": accumulated_interval_progress,
    **{name: _measure(name) for name in MEASURES if name != "trend_period"},
    "trend_first": q_trend_first,
    "trend_second": trend_second,
    "trend_third": trend_third,
    "trend_third_interval": trend_third_interval,
    "trend_chain": q_trend_chain,
    "trend_chain_five": trend_chain_five,
    "trend_eight_stages": trend_eight_stages,
    "trend_forecast": trend_forecast,
    "affected_works": q_affected_works,
    "trend_refresh_batch": trend_refresh_batch,
    "trend_refresh_versions": trend_refresh_versions,
    "trend_refresh_log": trend_refresh_log,
    "trend_refresh_stream": trend_refresh_stream,
    "changes_between_versions": changes_between_versions,
    "dictionary_snapshot": dictionary_snapshot,
    "dictionary_lookup": dictionary_lookup,
    "dictionary_rejected": dictionary_rejected,
    "dictionary_apply_batch": dictionary_apply_batch,
    "dictionary_apply_one": dictionary_apply_one,
    "dictionary_apply_stream": dictionary_apply_stream,
    "find_columns": find_columns,
}
