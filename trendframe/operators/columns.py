"""Which tables have a column whose name matches a pattern."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendframe.functions import tsql_like
from trendframe.schemas import COLUMN_CATALOG, TABLE_CATALOG


def column_catalog(
    spark: SparkSession, tables: Mapping[str, T.StructType]
) -> tuple[DataFrame, DataFrame]:
    """(columns, tables) metadata DataFrames of a set of schemas."""
    names = [(i, name) for i, name in enumerate(tables, 1)]
    columns = [
        (i, field.name, position, field.dataType.simpleString())
        for i, name in names
        for position, field in enumerate(tables[name].fields, 1)
    ]
    return spark.createDataFrame(columns, COLUMN_CATALOG), spark.createDataFrame(names, TABLE_CATALOG)


def find_columns(
    columns: DataFrame, tables: DataFrame, pattern: str, case_sensitive: bool = False
) -> DataFrame:
    """(coluna, tabela) of the columns whose name is LIKE ``pattern``."""
    matching = columns.filter(tsql_like("column_name", pattern, case_sensitive))
    return matching.join(tables, "object_id").select(
        F.col("column_name").alias("coluna"), F.col("table_name").alias("tabela")
    )
