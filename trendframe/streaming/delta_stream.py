"""Trend results kept current from a stream of measurement changes, by signed daily sums; facts are read at the start only.

Folders below ``store``: ``frame`` what measurements do not change and daily sums, ``deltas`` the signed daily sums of each
micro-batch, ``scope`` the works that it touched, ``results`` the versions of the result rows, ``ledger`` the batches applied.
A batch reads the daily sums of touched works in their buckets and all deltas of these. A change of any age is applied, so there
is no watermark; changes may come in any order within and across batches, as sums do not ask for one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendframe.operators.deltas import daily_deltas
from trendframe.operators.refresh import replace_by_key
from trendframe.plans import frame as frames
from trendframe.schemas import ACTIVITY, CHANGE_IMAGES, TREND, WORK
from trendframe.session import stored
from trendframe.sources import Tables
from trendframe.sources.versioned import FIRST, applied, carried, carry, read_latest, record, write_version

_DELTAS = f"{frames.DAILY}, {WORK} long, batch_id long"
_SCOPE = f"{WORK} long, bucket int"


def initialise(t: Tables, store: str, buckets: int | None = None) -> None:
    """Write the frame of all works and their results as the first version."""
    spark = t.civil_work.sparkSession
    frames.write_frame(frames.frame(t), f"{store}/frame", buckets or frames.buckets_for(t))
    frame, _ = frames.read_frame(spark, f"{store}/frame")
    write_version(frames.forecast_frame(frame), t.civil_work.select(WORK), f"{store}/results", FIRST)
    spark.createDataFrame([], _DELTAS).drop("batch_id").write.parquet(f"{store}/deltas/batch_id={FIRST}")
    record(spark, store, FIRST)


def write_deltas(changes: DataFrame, frame: frames.Frame, buckets: int, store: str, batch_id: int) -> DataFrame:
    """Write the deltas of a batch and the works they touch, which are returned. ``changes`` are evaluated once."""
    spark = changes.sparkSession
    path, scope = f"{store}/deltas/batch_id={batch_id}", f"{store}/scope/batch_id={batch_id}"
    # The work is looked up once here, so that later batches find deltas by work.
    owned = daily_deltas(changes).join(frame.owners.select(ACTIVITY, WORK), ACTIVITY)
    owned.select(*frames.DAILY_COLUMNS, WORK).write.mode("overwrite").parquet(path)
    touched = spark.read.schema(_DELTAS).parquet(path).select(WORK).distinct()
    touched.withColumn("bucket", frames.bucket(buckets)).write.mode("overwrite").parquet(scope)
    return spark.read.schema(_SCOPE).parquet(scope)


def current_frame(frame: frames.Frame, works: DataFrame, store: str, through: int) -> frames.Frame:
    """The frame of ``works`` after all batches up to ``through``."""
    deltas = works.sparkSession.read.schema(_DELTAS).parquet(f"{store}/deltas").filter(F.col("batch_id") <= through)
    own = frames.of_works(frame, works)
    return frames.with_daily(own, frames.merged(own.daily, deltas.join(works.select(WORK), WORK, "left_semi")))


def refreshed(changes: DataFrame, frame: frames.Frame, buckets: int, store: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Write the deltas of a batch; the new result rows of the works it touches, and these works."""
    works = write_deltas(changes, frame, buckets, store, batch_id)
    now = current_frame(frame, works, store, batch_id)
    return frames.forecast_frame(frames.with_daily(now, stored(now.daily, "touched-daily-sums"))), works


def refresh_by_deltas(changes: DataFrame, store: str, folder: str) -> DataFrame:
    """The results of ``store`` after ``changes``; ``store`` stays as it is, what the refresh writes is below ``folder``."""
    spark = changes.sparkSession
    frame, buckets = frames.read_frame(spark, f"{store}/frame")
    fresh, works = refreshed(changes, frame, buckets, folder, FIRST + 1)
    return replace_by_key(results(spark, store), fresh, works.select(WORK))


def apply_batch(changes: DataFrame, batch_id: int, store: str) -> None:
    """Add one batch of ``CHANGE_IMAGES`` and write a new version of the works it touches.

    A rerun of a batch rewrites its own folders and reads only the deltas up to itself; one that the ledger
    of a compacted store holds already is left out, as its sums are in the daily sums there.
    """
    spark = changes.sparkSession
    if batch_id <= carried(spark, store):
        return
    frame, buckets = frames.read_frame(spark, f"{store}/frame")
    fresh, works = refreshed(changes, frame, buckets, store, batch_id)
    write_version(fresh, works.select(WORK), f"{store}/results", batch_id)
    record(spark, store, batch_id)


def start(changes: DataFrame, store: str, once: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Run ``apply_batch`` on a streaming DataFrame of ``CHANGE_IMAGES`` rows.

    ``checkpoint`` is where the stream keeps its position and batch numbers, ``<store>/checkpoint`` by default. After
    ``compact``, pass the one used before.
    """
    writer = changes.writeStream.option("checkpointLocation", checkpoint or f"{store}/checkpoint").foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, store)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def results(spark: SparkSession, store: str) -> DataFrame:
    return read_latest(spark, f"{store}/results", TREND, [WORK])


def change_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CHANGE_IMAGES).parquet(path)


def compact(spark: SparkSession, store: str, target: str) -> None:
    """Start ``target`` from the state of ``store``: deltas are added to the daily sums, old versions left behind.

    Takes what the ledger lists as applied; a batch begun after that is applied to ``target`` when it comes again. A
    stream that goes on with ``target`` must keep its old ``checkpoint``.
    """
    through = applied(spark, store)
    frame, buckets = frames.read_frame(spark, f"{store}/frame")
    deltas = spark.read.schema(_DELTAS).parquet(f"{store}/deltas").filter(F.col("batch_id") <= through)
    frames.write_frame(frames.with_daily(frame, frames.merged(frame.daily, deltas)), f"{target}/frame", buckets)
    state = read_latest(spark, f"{store}/results", TREND, [WORK], before=through + 1)
    write_version(state, state.select(WORK).distinct(), f"{target}/results", FIRST)
    spark.createDataFrame([], _DELTAS).drop("batch_id").write.parquet(f"{target}/deltas/batch_id={FIRST}")
    carry(spark, target, through)
