"""Results replaced by key, as append-only versions.

Each batch writes one folder with the new rows of the keys it touched and one marker row per such key.
The current rows of a key are those of its newest version; a key whose rows are all gone has a marker
only. Nothing is deleted or rewritten, readers never see a half-replaced key, and running a batch again
overwrites the same folder. A ledger lists the batches that have been applied as a whole; a store made from the state of another
takes its last entry along, so a batch that is contained in that state is known when it comes again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST = -1


def write_version(rows: DataFrame, keys: DataFrame, path: str, batch_id: int) -> None:
    """Write ``rows`` as the whole new content of ``keys`` (distinct key columns)."""
    marked = rows.withColumn("_marker", F.lit(False)).unionByName(
        keys.withColumn("_marker", F.lit(True)), allowMissingColumns=True
    )
    marked.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: list[str],
    before: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """The current rows, or those before a batch, or those of the keys in ``only``."""
    stored = T.StructType(
        schema.fields + [T.StructField("_marker", T.BooleanType()), T.StructField("batch_id", T.LongType())]
    )
    df = spark.read.schema(stored).parquet(path)
    if before is not None:
        df = df.filter(F.col("batch_id") < before)
    newest = df.filter("_marker").groupBy(*keys).agg(F.max("batch_id").alias("_newest"))
    if only is not None:
        newest = newest.alias("n").join(only.alias("o"), _same("n", "o", keys), "left_semi")
    rows = df.filter(~F.col("_marker")).alias("r")
    current = _same("r", "n", keys) & (F.col("r.batch_id") == F.col("n._newest"))
    return rows.join(newest.alias("n"), current, "left_semi").select(*schema.names)


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def record(spark: SparkSession, store: str, batch_id: int) -> None:
    """Enter ``batch_id`` in the ledger of ``store``: all that the batch writes is there."""
    _enter(spark, store, batch_id, batch_id)


def carry(spark: SparkSession, store: str, through: int) -> None:
    """Begin the ledger of a ``store`` whose first version holds all batches up to ``through``."""
    _enter(spark, store, FIRST, through)


def _enter(spark: SparkSession, store: str, entry: int, through: int) -> None:
    row = spark.range(1).select(F.lit(through).cast("long").alias("applied"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{store}/ledger/entry={entry}")


def applied(spark: SparkSession, store: str) -> int:
    """The last batch in the ledger of ``store``. Batches are applied in ascending order."""
    return spark.read.schema("applied long").parquet(f"{store}/ledger").agg(F.max("applied")).first()[0]


def carried(spark: SparkSession, store: str) -> int:
    """The last batch that the first version of ``store`` holds."""
    return spark.read.schema("applied long").parquet(f"{store}/ledger/entry={FIRST}").first()[0]
