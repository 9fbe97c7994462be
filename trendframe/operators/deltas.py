"""Changes of measurements as signed daily sums, and change rows from two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendframe.operators.progress import dated_real
from trendframe.schemas import ACTIVITY, REAL_ID, TABLES
from trendframe.session import stored

REAL_COLUMNS = TABLES["real_progress"].names


def signed_rows(changes: DataFrame) -> DataFrame:
    """Rows of ``real_progress`` with a ``weight``: less the image before each change, plus the one after it."""
    weight = F.col("weight") if "weight" in changes.columns else F.lit(1).cast("long")
    images = F.array(F.struct((-weight).alias("weight"), F.col("before").alias("row")), F.struct(weight.alias("weight"), F.col("after").alias("row")))
    rows = changes.select(F.explode(images).alias("i")).filter(F.col("i.row").isNotNull())
    return rows.select("i.weight", "i.row.*")


def daily_deltas(changes: DataFrame) -> DataFrame:
    """(activity, period, fraction, percentage, n_foreseen, n_real, n_measured): what ``changes`` add to daily sums.

    Days where additions and removals cancel stay, as their activity was touched. Combined before the shuffle, so an activity and
    day may have any number of changes. Deltas of several batches may be added up in any order.
    """
    zero = F.lit(0).cast("long")
    units, weight = F.col("percentage"), F.col("weight")
    rows = dated_real(signed_rows(changes), "weight")
    return (
        rows.groupBy(ACTIVITY, "period")
        .agg(
            F.sum(units * weight).alias("percentage"),
            F.sum(weight).alias("n_real"),
            F.sum(F.when(units.isNotNull(), weight).otherwise(zero)).alias("n_measured"),
        )
        .withColumns({"fraction": F.lit(None).cast("long"), "n_foreseen": zero})
    )


def changes_between(old: DataFrame, new: DataFrame) -> DataFrame:
    """(before, after, weight): the changes that lead from one version of ``real_progress`` to another, as multisets of rows.

    Equal rows are counted, plus in ``new`` and less in ``old``, with a map-side combine: the one shuffle of whole tables, by the whole
    row, so no id is a hot key. What does not cancel is stored and grouped by id: an id with one row before and one after
    is a change from one to the other, all else rows that came or went, ``weight`` times each.
    """
    columns = [F.col(c).cast(f.dataType).alias(c) for c, f in zip(REAL_COLUMNS, TABLES["real_progress"].fields, strict=True)]
    versions = new.select(*columns, F.lit(1).cast("long").alias("weight")).unionByName(
        old.select(*columns, F.lit(-1).cast("long").alias("weight"))
    )
    counted = versions.groupBy(*REAL_COLUMNS).agg(F.sum("weight").alias("weight")).filter("weight <> 0")
    differing = stored(counted, "differing-rows")
    row, came = F.struct(*REAL_COLUMNS), F.col("weight") > 0
    count = lambda side: F.sum(F.when(side, F.abs("weight")).otherwise(0))
    # An id is a pair if it has one row on each side; maxima over the others are not looked at. Rows of a hot id that
    # is no pair stay where they are: only their number and two of them are shuffled.
    pairs = (
        differing.groupBy(REAL_ID)
        .agg(
            count(came).alias("n_after"), count(~came).alias("n_before"),
            F.max(F.when(~came, row)).alias("before"), F.max(F.when(came, row)).alias("after"),
        )
        .filter("n_after = 1 AND n_before = 1")
    )
    same_id = F.col(f"d.{REAL_ID}").eqNullSafe(F.col(f"p.{REAL_ID}"))
    single = differing.alias("d").join(pairs.select(REAL_ID).alias("p"), same_id, "left_anti")
    sided = single.select(
        F.when(~came, row).alias("before"), F.when(came, row).alias("after"), F.abs("weight").alias("weight")
    )
    return pairs.select("before", "after", F.lit(1).cast("long").alias("weight")).unionByName(sided)
