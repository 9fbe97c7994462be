"""The object dictionary kept current from a stream of DDL events.

Batches must arrive in ``seq`` order; within a batch any order will do. Folders below ``store`` have a subfolder per batch: ``read`` its
events as parsed, with those that cannot be applied, ``events`` the others with their parameters, ``dictionary`` the versions;
``ledger`` lists the batches applied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendframe.operators.dictionary import (
    OBJECT,
    as_state,
    dictionary,
    dictionary_apply,
    good_events,
    lookup_parameters,
    read_events,
    rejected_events,
)
from trendframe.schemas import DICTIONARY_STATE, PARSED_EVENT, READ_EVENT
from trendframe.sources.versioned import FIRST, applied, carried, carry, read_latest, record, write_version


def initialise(snapshot: DataFrame, store: str) -> None:
    """Write a snapshot (it may be empty) as the first version of the dictionary."""
    write_version(
        as_state(snapshot), snapshot.select(*OBJECT).distinct(), f"{store}/dictionary", FIRST
    )
    record(snapshot.sparkSession, store, FIRST)


def apply_batch(
    raw: DataFrame, batch_id: int, params: DataFrame, store: str, mode: str = "each"
) -> None:
    """Apply one batch of (seq, event_xml) rows and write a new version of the objects it names.

    Payloads are parsed once; what cannot be applied stays in ``rejected``. A rerun of a batch rewrites its own folders, from
    the versions before it. A batch that a compacted store holds already is left out: its state is of after that batch, and rows that it
    created must not be created again.
    """
    spark = raw.sparkSession
    if batch_id <= carried(spark, store):
        return
    read, folder = f"{store}/read/batch_id={batch_id}", f"{store}/events/batch_id={batch_id}"
    read_events(raw).write.mode("overwrite").parquet(read)
    good = good_events(spark.read.schema(READ_EVENT).parquet(read))
    lookup_parameters(good, params, mode).write.mode("overwrite").parquet(folder)
    events = spark.read.schema(PARSED_EVENT).parquet(folder)
    objects = events.select(*OBJECT).distinct()
    before = read_latest(
        spark, f"{store}/dictionary", DICTIONARY_STATE, OBJECT, before=batch_id, only=objects
    )
    write_version(
        dictionary_apply(before, events, mode), objects, f"{store}/dictionary", batch_id
    )
    record(spark, store, batch_id)


def rejected(spark: SparkSession, store: str) -> DataFrame:
    """(batch_id, seq, event_xml, defect, n): payloads of all batches that were not applied."""
    schema = T.StructType([*READ_EVENT.fields, T.StructField("batch_id", T.LongType())])
    read = spark.read.schema(schema).parquet(f"{store}/read")
    return rejected_events(read, "batch_id")


def start(
    raw: DataFrame, params: DataFrame, store: str, mode: str = "each", once: bool = False, checkpoint: str | None = None
) -> StreamingQuery:
    """Run ``apply_batch`` on a streaming DataFrame of events; ``checkpoint`` as in ``trend_stream.start``."""
    writer = raw.writeStream.option("checkpointLocation", checkpoint or f"{store}/checkpoint").foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, params, store, mode)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, store: str) -> DataFrame:
    return dictionary(read_latest(spark, f"{store}/dictionary", DICTIONARY_STATE, OBJECT))


def compact(spark: SparkSession, store: str, target: str) -> None:
    """Start ``target`` from the state of ``store``, without its events and old versions.

    The state is that after the last batch in the ledger, which goes along: a batch that comes again because it was applied but not
    ticked off is known there, and one that was only begun is applied. A stream that goes on with ``target`` must keep its old
    ``checkpoint``.
    """
    through = applied(spark, store)
    state = read_latest(spark, f"{store}/dictionary", DICTIONARY_STATE, OBJECT, before=through + 1)
    write_version(state, state.select(*OBJECT).distinct(), f"{target}/dictionary", FIRST)
    carry(spark, target, through)
