"""Trend results kept current from a stream of measurement changes.

Folders below ``store`` have one subfolder per micro-batch: ``log`` the change log, ``works`` the works it
touched, ``scope`` their activities and facts, ``results`` the versions of the result rows. A change of any age is applied, so there is no watermark.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendframe.operators.refresh import current_rows, restrict
from trendframe.plans.forecast import forecast, stored_changes
from trendframe.schemas import ACTIVITY, CHANGE_LOG, REAL_CHANGE, TABLES, TREND, WORK
from trendframe.sources import Tables
from trendframe.sources.versioned import FIRST, read_latest, write_version


def initialise(t: Tables, store: str, plan=forecast) -> None:
    """Write the results of all works as the first version."""
    write_version(plan(t), t.civil_work.select(WORK), f"{store}/results", FIRST)


def _log(spark: SparkSession, store: str) -> DataFrame:
    schema = T.StructType([*CHANGE_LOG.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(f"{store}/log")


def apply_batch(changes: DataFrame, batch_id: int, t: Tables, store: str, plan=forecast) -> None:
    """Log one batch of changes and write a new version of the works it touches.

    A rerun of a batch rewrites its own folders, and reads only the log up to itself.
    """
    spark = changes.sparkSession
    batch = f"batch_id={batch_id}"
    _, works = stored_changes(changes, t, f"{store}/log/{batch}", f"{store}/works/{batch}")
    log = _log(spark, store).filter(F.col("batch_id") <= batch_id)
    fresh = plan(restrict(t, log, works, f"{store}/scope/{batch}"))
    write_version(fresh, works, f"{store}/results", batch_id)


def start(
    changes: DataFrame, t: Tables, store: str, plan=forecast, once: bool = False, checkpoint: str | None = None
) -> StreamingQuery:
    """Run ``apply_batch`` on a streaming DataFrame of ``REAL_CHANGE`` rows.

    ``checkpoint`` is where the stream keeps its position and batch numbers, ``<store>/checkpoint`` by default. After
    ``compact``, pass the one used before.
    """
    writer = changes.writeStream.option("checkpointLocation", checkpoint or f"{store}/checkpoint").foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, t, store, plan)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def results(spark: SparkSession, store: str) -> DataFrame:
    return read_latest(spark, f"{store}/results", TREND, [WORK])


def change_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(REAL_CHANGE).parquet(path)


def compact(t: Tables, store: str, target: str) -> Tables:
    """Start ``target`` from the state of ``store``, without its log and old versions.

    Writes the measurements after all logged changes and the current results; a stream that goes on
    with ``target``, the returned tables and its old ``checkpoint`` reads only these and the changes that are new. A
    last batch that was applied but not yet ticked off is applied again, which changes nothing. For between two runs of
    the stream.
    """
    spark = t.real_progress.sparkSession
    current = current_rows(t.real_progress, _log(spark, store))
    current.sortWithinPartitions(ACTIVITY).write.mode("overwrite").parquet(f"{target}/real_progress")
    write_version(results(spark, store), t.civil_work.select(WORK), f"{target}/results", FIRST)
    real = spark.read.schema(TABLES["real_progress"]).parquet(f"{target}/real_progress")
    return replace(t, real_progress=real)
