"""The input tables, derived from the test data (see FIXTURES.md).

Suppliers are the works, their shipments the progress: a schedule per supplier and year, a term per
quarter, planned progress from prices and measured progress from discounted prices.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendframe.schemas import ACTIVITY, TABLES
from trendframe.session import scratch_dir
from trendframe.sources import Tables, normalise, write_table

# Factor of the work in the id of a measurement; the rest is twice the day number, plus one for a second
# measurement of the day.
REAL_IDS = 1_000_000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shipments(spark: SparkSession, sf_dir: str, until: Callable[[Column], Column] = lambda day: day) -> DataFrame:
    """Price in cents and discounted price in hundredths of cents per supplier and day, or ``until`` of the day, as exact integers."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    percent_left = 100 - F.round(F.col("l_discount") * 100).cast("long")
    return (
        _read(spark, sf_dir, "lineitem")
        .select(
            F.col("l_suppkey").alias("s"), until(F.col("l_shipdate").cast("date")).alias("d"),
            cents.alias("price"), (cents * percent_left).alias("net"),
        )
        .groupBy("s", "d")
        .agg(F.sum("price").alias("price"), F.sum("net").alias("net"))
        .withColumn("y", F.year("d"))
    )


def _real_id(day: str):
    return F.col("s") * REAL_IDS + F.unix_date(F.col(day)) * 2


_folders: dict[tuple, str] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files below ``path``, listed without a job; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return ()
    out, left = [], system.listFiles(place, True)
    while left.hasNext():
        f = left.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _folder(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Where ``write(folder)`` has put a table for this application and input; written if it is new or gone."""
    inputs = [_files(spark, f"{sf_dir}/{table}.parquet") for table in ("lineitem", "supplier")]
    key = (spark.sparkContext.applicationId, name, sf_dir, *inputs)
    if key not in _folders or not _files(spark, f"{_folders[key]}/_done"):
        folder = scratch_dir(spark, name)
        write(folder)
        spark.range(1).write.parquet(f"{folder}/_done")
        _folders[key] = folder
    return _folders[key]


def schedule_tables(spark: SparkSession, sf_dir: str, real: str = "monthly") -> Tables:
    """All nine tables; ``real`` names the measurements: ``"monthly"``, or ``"all"``, daily and without cut-off.

    They are derived and written once per application and input, so queries read them as stored tables; the measurements,
    by far the largest if daily, are written when the first query asks for them.
    """
    if real not in ("monthly", "all"):
        raise ValueError(f"real must be 'monthly' or 'all', not {real!r}")
    folder = _folder(spark, sf_dir, "tables", lambda f: _write(spark, sf_dir, f))
    measured = _folder(spark, sf_dir, f"real-{real}", lambda f: _write_real(spark, sf_dir, folder, f, real))
    place = lambda name: measured if name == "real_progress" else folder
    return Tables(**{f.name: spark.read.schema(TABLES[f.name]).parquet(f"{place(f.name)}/{f.name}") for f in fields(Tables)})


def kept(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A result that others start from, stored once per application and input."""
    folder = _folder(spark, sf_dir, name, lambda f: make().write.parquet(f"{f}/rows"))
    return spark.read.parquet(f"{folder}/rows")


def kept_folder(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """A store that others start from, written once per application and input."""
    return _folder(spark, sf_dir, name, lambda f: write(f"{f}/store")) + "/store"


def changed_version(spark: SparkSession, sf_dir: str, t: Tables) -> DataFrame:
    """The measurements after ``change_images``, as a second stored version of the table."""

    def make() -> DataFrame:
        changes = change_images(spark, sf_dir, t)
        gone = changes.select(F.col("before.id_activity_real_progress").alias("id_activity_real_progress"))
        kept_rows = t.real_progress.join(gone, "id_activity_real_progress", "left_anti").select(*t.real_progress.columns)
        return kept_rows.unionByName(changes.filter("after IS NOT NULL").select("after.*"))

    return kept(spark, sf_dir, "changed-version", make)


def _write(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write all tables but the measurements. They follow from monthly and yearly sums, which are stored for that."""
    _shipments(spark, sf_dir, F.last_day).write.parquet(f"{folder}/_monthly")
    monthly = spark.read.parquet(f"{folder}/_monthly")
    yearly = monthly.groupBy("s", "y").agg(F.sum("price").alias("yearly"), F.max(F.quarter("d")).alias("last_quarter"))
    yearly.write.parquet(f"{folder}/_yearly")
    for name, df in _derive(spark, sf_dir, monthly, spark.read.parquet(f"{folder}/_yearly")).items():
        write_table(name, normalise(name, df), folder)


def _write_real(spark: SparkSession, sf_dir: str, tables: str, folder: str, real: str) -> None:
    """Write the measurements, with the sums that ``_write`` has stored below ``tables``."""
    monthly, year = spark.read.parquet(f"{tables}/_monthly"), spark.read.parquet(f"{tables}/_yearly")
    measured = _measurements(spark, sf_dir, _shipments(spark, sf_dir) if real == "all" else monthly, year, real)
    write_table("real_progress", normalise("real_progress", measured), folder)


def _derive(spark: SparkSession, sf_dir: str, monthly: DataFrame, year: DataFrame) -> dict[str, DataFrame]:
    supplier = _read(spark, sf_dir, "supplier")
    id_schedule = (F.col("s") * 10000 + F.col("y")).alias("id_schedule")
    first_month, months = monthly.agg(
        F.min(F.trunc("d", "month")), F.months_between(F.max(F.trunc("d", "month")), F.min(F.trunc("d", "month")))
    ).first()
    first_month, months = first_month or date(1970, 1, 1), int(months or 0)
    schedule = year.select(id_schedule, F.col("s").alias("id_civil_work"))
    term = (
        monthly.select("s", "y", F.quarter("d").alias("q"))
        .distinct()
        .select(
            (id_schedule * 10 + F.col("q")).alias("id_term"), F.col("s").alias("id_civil_work"), id_schedule
        )
    )
    # The newest term of every seventh work belongs to its oldest schedule.
    late = (
        year.filter(F.col("s") % 7 == 0)
        .groupBy("s")
        .agg(F.max("y").alias("y"), F.min("y").alias("first"))
        .select(
            (id_schedule * 10 + 9).alias("id_term"), F.col("s").alias("id_civil_work"),
            (F.col("s") * 10000 + F.col("first")).alias("id_schedule"),
        )
    )
    term = term.union(late)
    last_term = (id_schedule * 10 + F.col("last_quarter")).alias("id_term")
    month = F.explode(F.sequence(F.lit(0), F.lit(months))).alias("m")
    # Keys of a calendar leave gaps, so the preceding row is not the one with the preceding key.
    calendar = supplier.select(F.col("s_suppkey").alias("s"), month).select(
        (F.col("s") * 100000 + F.col("m") * 7).alias("sdc_cod"),
        F.col("s").alias("id_input_data"),
        F.last_day(F.add_months(F.lit(first_month), F.col("m"))).alias("calendar_period"),
    )
    level = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("part")
    activity = schedule.select("id_schedule", level).select(
        F.when(F.col("part") == 0, F.col("id_schedule"))
        .otherwise(F.col("id_schedule") * 10 + F.col("part"))
        .alias("id_qualitative_activity"),
        "id_schedule",
        F.when(F.col("part") == 0, 1).otherwise(2).alias("outline_lvl"),
    )

    share = (F.col("price").cast("double") / F.col("yearly").cast("double")).cast("decimal(9,6)")
    planned = monthly.join(year, ["s", "y"]).select(
        id_schedule, F.col("d").alias("id_term_date"), share.alias("share"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("part"),
    )
    foreseen = planned.select(
        F.when(F.col("part") == 0, F.col("id_schedule"))
        .otherwise(F.col("id_schedule") * 10 + 1)
        .alias("id_qualitative_activity"),
        "id_term_date",
        F.when(F.col("part") == 0, F.col("share")).otherwise(F.lit(0.5).cast("decimal(9,6)")).alias("foreseen_fraction"),
    )

    return {
        "civil_work": supplier.select(F.col("s_suppkey").alias("id_civil_work")),
        "schedule": schedule,
        "term": term,
        "term_input_data": term.select("id_term", F.col("id_civil_work").alias("id_input_data")),
        "calendar": calendar,
        "qualitative_activity": activity,
        "foreseen_progress": foreseen,
        "term_activity": year.select(last_term.alias("id_term_activity"), last_term),
    }


def _measurements(spark: SparkSession, sf_dir: str, measured: DataFrame, year: DataFrame, real: str) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier")
    id_schedule = (F.col("s") * 10000 + F.col("y")).alias("id_schedule")
    last_term = (id_schedule * 10 + F.col("last_quarter")).alias("id_term")
    # Works are measured up to a month of the last year that depends on their nation: January to July.
    until = 1 + F.floor(F.col("s_nationkey") / 4)
    last_year = year.agg(F.max("y")).first()[0]
    in_time = F.lit(True) if real == "all" else (F.col("y") < last_year) | (F.month("d") <= until)
    share = (F.col("net").cast("double") / F.col("yearly").cast("double")).cast("decimal(9,4)")
    percentage = F.when(F.col("part") == 0, share).otherwise(F.lit("0.25").cast("decimal(9,4)"))
    # A second measurement on each date of an even month.
    parts = F.explode(F.when(F.month("d") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        measured.join(supplier.select(F.col("s_suppkey").alias("s"), "s_nationkey"), "s")
        .filter(in_time)
        .join(year, ["s", "y"])
        .select("*", parts.alias("part"))
        .select(
            (_real_id("d") + F.col("part")).alias("id_activity_real_progress"),
            id_schedule.alias("id_qualitative_activity"),
            last_term.alias("id_term_activity"),
            F.col("d").alias("progress_date"),
            percentage.alias("progress_percentage"),
        )
    )


def change_images(spark: SparkSession, sf_dir: str, t: Tables) -> DataFrame:
    """Changes to the last measurement of a work, both images as whole rows: deleted where the supplier's balance is negative,
    followed by a new one a month later up to 1,000, raised by a tenth from 8,000 on."""
    columns = t.real_progress.columns
    last = (
        t.real_progress.withColumn("s", F.floor(F.col("id_activity_real_progress") / REAL_IDS))
        .groupBy("s")
        .agg(F.max_by(F.struct(*columns), "id_activity_real_progress").alias("old"))
    )
    balance = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), "s_acctbal")
    deleted, added = F.col("s_acctbal") < 0, F.col("s_acctbal") <= 1000
    changed = last.join(balance, "s").filter(added | (F.col("s_acctbal") >= 8000)).select("s", "s_acctbal", "old", "old.*")
    next_month = F.last_day(F.add_months(F.col("progress_date"), 1))
    raised = (F.col("progress_percentage") * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(9,4)")
    new = {
        "progress_date": F.when(added, next_month).otherwise(F.col("progress_date")),
        "progress_percentage": F.when(added, F.col("progress_percentage")).otherwise(raised),
    }
    moved = changed.withColumns(new).withColumn(
        "id_activity_real_progress", F.when(added, _real_id("progress_date")).otherwise(F.col("id_activity_real_progress"))
    )
    return moved.select(
        F.col("old.id_activity_real_progress").alias("seq"),
        F.when(deleted | ~added, F.col("old")).alias("before"),
        F.when(~deleted, F.struct(*columns)).alias("after"),
    )


def real_changes(spark: SparkSession, sf_dir: str, t: Tables) -> DataFrame:
    """``change_images`` as change rows: of the image before, its activity only."""
    columns = t.real_progress.columns
    after = [
        F.coalesce(F.col(f"after.{c}"), F.col(f"before.{c}") if c == "id_activity_real_progress" else F.lit(None)).alias(c)
        for c in columns
    ]
    changes = change_images(spark, sf_dir, t)
    return changes.select("seq", F.col(f"before.{ACTIVITY}").alias("before_activity"), *after)


# Event types of the test data and the DDL events they stand for (fixed values).
DDL_EVENTS = {
    "signup": ("CREATE_FUNCTION", "FUNCTION"),
    "click": ("ALTER_FUNCTION", "FUNCTION"),
    "error": ("DROP_FUNCTION", "FUNCTION"),
    "purchase": ("CREATE_PROCEDURE", "PROCEDURE"),
    "view": ("ALTER_PROCEDURE", "PROCEDURE"),
}


def _choose(column: str, values: dict[str, str]):
    chosen = F.lit(None).cast("string")
    for key, value in values.items():
        chosen = F.when(F.col(column) == key, value).otherwise(chosen)
    return chosen


def ddl_events(events: DataFrame) -> DataFrame:
    """(seq, event_xml) from an ``events`` DataFrame, batch or streaming."""
    kind = _choose("event_type", {k: v[0] for k, v in DDL_EVENTS.items()})
    target = _choose("event_type", {k: v[1] for k, v in DDL_EVENTS.items()})
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(
            F.lit("<EVENT_INSTANCE><EventType>"), kind,
            F.lit("</EventType><ObjectType>"), target,
            F.lit("</ObjectType><ObjectName>obj_"), F.col("user_id").cast("string"),
            F.lit("</ObjectName></EVENT_INSTANCE>"),
        ).alias("event_xml"),
    )


def damaged_events(events: DataFrame) -> DataFrame:
    """``ddl_events`` of which some come damaged: cut off where ``event_id`` is divisible by 11, blank by 13, NULL by 17, without event type
    by 19; and those divisible by 23 come three times."""
    n = F.col("seq")
    payload = F.col("event_xml")
    damaged = (
        F.when(n % 11 == 0, F.substring(payload, 1, 30))
        .when(n % 13 == 0, F.lit("  "))
        .when(n % 17 == 0, F.lit(None).cast("string"))
        .when(n % 19 == 0, F.regexp_replace(payload, "<EventType>.*</EventType>", ""))
        .otherwise(payload)
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(n % 23 == 0, 3).otherwise(1)))
    return ddl_events(events).select("seq", damaged.alias("event_xml"), copies.alias("copy")).drop("copy")


def event_params(events: DataFrame) -> DataFrame:
    """Parameters of the object as each event left it: one, and a second where ``value`` is over 10.

    Events with a value under 1 have none.
    """
    key = F.get_json_object("props", "$.k")
    extra = F.explode(F.sequence(F.lit(1), F.when(F.col("value") > 10, 2).otherwise(1)))
    return (
        events.filter(F.col("value") >= 1)
        .select(
            F.col("event_id").alias("seq"),
            F.concat(F.lit("obj_"), F.col("user_id").cast("string")).alias("routine_name"),
            key.alias("k"), extra.alias("ordinal"),
        )
        .select(
            "seq", "routine_name",
            F.concat(F.lit("@p"), F.col("ordinal").cast("string"), F.lit("_"), F.col("k")).alias("parameter_name"),
            F.when(F.col("ordinal") == 1, "int").otherwise("float").alias("data_type"),
            "ordinal",
        )
    )


def customer_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parameters for each ``obj_<c_custkey>``, for lookups by object name."""
    return (
        _read(spark, sf_dir, "customer")
        .select(
            F.concat(F.lit("obj_"), F.col("c_custkey").cast("string")).alias("routine_name"),
            F.col("c_mktsegment").alias("segment"), F.col("c_nationkey"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("ordinal"),
        )
        .select(
            "routine_name",
            F.when(F.col("ordinal") == 1, F.col("segment"))
            .otherwise(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")))
            .alias("parameter_name"),
            F.when(F.col("ordinal") == 1, "nvarchar").otherwise("int").alias("data_type"),
            "ordinal",
        )
    )


def routine_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter per part, four parts to a routine, named like the objects of the events. Sizes give the routine's type and schema; parts
    of size 1 stand for return values, which have no name."""
    number = F.floor(F.col("p_partkey") / 4)
    size = F.col("p_size")
    return _read(spark, sf_dir, "part").select(
        F.when(size == 50, "sys").otherwise("dbo").alias("routine_schema"),
        F.concat(F.lit("obj_"), number.cast("string")).alias("routine_name"),
        F.when(size <= 25, "FUNCTION").otherwise("PROCEDURE").alias("routine_type"),
        F.when(size > 1, F.concat(F.lit("@"), F.translate("p_name", " ", "_"))).alias("parameter_name"),
        F.lower("p_type").alias("data_type"),
        (F.col("p_partkey") - 4 * number + 1).cast("int").alias("ordinal"),
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(columns, tables): each part is a column, named after its type and size, of its brand's table."""
    part = _read(spark, sf_dir, "part")
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")
    columns = part.select(
        number.alias("object_id"),
        F.concat_ws("_", "p_type", F.translate("p_name", " ", "_"), F.col("p_partkey").cast("string")).alias("column_name"),
        F.col("p_size").alias("ordinal"),
        F.lit("int").alias("data_type"),
    )
    tables = part.select(number.alias("object_id"), F.col("p_brand").alias("table_name")).distinct()
    return columns, tables
