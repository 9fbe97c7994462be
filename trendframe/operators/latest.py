"""Newest rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[str], n: int = 1) -> DataFrame:
    """The ``n`` rows of each key that are greatest by ``order``; ties fall to the other columns.

    ``n = 1`` is an aggregate, so each map task sends one row per key. Larger ``n`` rank the rows, and
    Spark cuts each map task's rows to ``n`` per key before the shuffle (``WindowGroupLimit``).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if n == 1:
        top = F.max(F.struct(*order, *rest)).alias("_top")
        return df.groupBy(*keys).agg(top).select(*(c if c in keys else f"_top.{c}" for c in df.columns))
    newest_first = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in (*order, *rest)))
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= n).drop("_rank")
