"""The nine input tables, read and written with declared schemas."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendframe import schemas


@dataclass(frozen=True)
class Tables:
    civil_work: DataFrame
    schedule: DataFrame
    term: DataFrame
    term_input_data: DataFrame
    calendar: DataFrame
    qualitative_activity: DataFrame
    foreseen_progress: DataFrame
    real_progress: DataFrame
    term_activity: DataFrame


def normalise(name: str, df: DataFrame) -> DataFrame:
    """``df`` under this library's column names and types; date columns lose their time of day."""
    for source, ours in schemas.SOURCE_NAMES.get(name, {}).items():
        df = df.withColumnRenamed(source, ours)
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name]))


def read_tables(spark: SparkSession, location: str) -> Tables:
    """Read ``<location>/<table>`` as Parquet for each input table."""
    return Tables(
        **{
            f.name: spark.read.schema(schemas.TABLES[f.name]).parquet(f"{location}/{f.name}")
            for f in fields(Tables)
        }
    )


def write_tables(tables: Tables, location: str) -> None:
    """Write every table as Parquet, the two fact tables sorted by activity within each file.

    The range of the activities that a refresh asks for then skips row groups of each file.
    """
    for f in fields(Tables):
        write_table(f.name, getattr(tables, f.name), location)


def write_table(name: str, df: DataFrame, location: str) -> None:
    """Write one table as ``write_tables`` does."""
    if name in ("foreseen_progress", "real_progress"):
        df = df.sortWithinPartitions(schemas.ACTIVITY)
    df.write.mode("overwrite").parquet(f"{location}/{name}")
