"""The object dictionary: a snapshot of routine parameters, kept current by DDL events.

Applying events needs no per-object sequence. A DROP removes every row created before it, so an object's
last DROP decides which rows live; and the row shows its object's last ALTER, if that came after the row.
Both are maxima, combined on the map side, so one object may have any number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendframe.schemas import DICTIONARY, DICTIONARY_STATE

OBJECT = ["obj_tipo", "obj_nome"]
VALUES = ["param_nome", "param_tipo", "mensagem"]

# Texts and element names that the results and payloads are made of (fixed values).
SNAPSHOT_MESSAGE = "Mensagem para o parâmetro "
EVENT_MESSAGE = "Mensagem para "
OBJECT_TYPES = ["FUNCTION", "PROCEDURE"]
# Arrays, as a payload may repeat a node; the first one counts.
EVENT_XML = "EventType ARRAY<STRING>, ObjectType ARRAY<STRING>, ObjectName ARRAY<STRING>"


def dictionary_snapshot(params: DataFrame) -> DataFrame:
    """One row per parameter of the functions and procedures of schema ``dbo``."""
    message = F.concat(F.lit(SNAPSHOT_MESSAGE), "routine_name", F.lit("."), "parameter_name")
    return params.filter(
        (F.col("routine_schema") == "dbo") & F.col("routine_type").isin(OBJECT_TYPES)
    ).select(
        F.col("routine_type").alias("obj_tipo"),
        F.col("routine_name").alias("obj_nome"),
        F.col("parameter_name").alias("param_nome"),
        F.col("data_type").alias("param_tipo"),
        message.alias("mensagem"),
    )


def as_state(snapshot: DataFrame) -> DataFrame:
    """A snapshot as the state that events apply to."""
    return snapshot.withColumn("created_seq", F.lit(None).cast("long")).select(*DICTIONARY_STATE.names)


def parse_events(df: DataFrame) -> DataFrame:
    """(seq, evento, obj_tipo, obj_nome) from the XML payload of each event.

    ``evento`` is the part of the event type before its first underscore: CREATE, ALTER or DROP.
    """
    e = F.from_xml("event_xml", EVENT_XML)
    first = lambda field: F.get(f"e.{field}", F.lit(0))
    kind = first("ObjectType")
    return df.select("seq", e.alias("e")).select(
        "seq",
        F.substring_index(first("EventType"), "_", 1).alias("evento"),
        F.when(kind.isin(OBJECT_TYPES), kind).alias("obj_tipo"),
        first("ObjectName").alias("obj_nome"),
    )


def read_events(df: DataFrame) -> DataFrame:
    """(seq, evento, obj_tipo, obj_nome, event_xml, copies, defect): ``parse_events`` with what is wrong with a payload.

    A row per distinct (seq, payload), which came ``copies`` times; each payload is parsed once. ``defect`` is NULL for an event
    that can be applied, else ``empty`` (NULL or blank), ``malformed`` (no XML) or ``incomplete`` (no event type).
    """
    counted = df.groupBy("seq", "event_xml").agg(F.count(F.lit(1)).alias("copies"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    e = F.from_xml("event_xml", f"{EVENT_XML}, _corrupt STRING", options)
    first = lambda field: F.get(f"e.{field}", F.lit(0))
    kind = first("ObjectType")
    blank = F.coalesce(F.col("event_xml"), F.lit("")).rlike(r"\A\s*\z")
    defect = (
        F.when(blank, "empty")
        .when(F.col("e._corrupt").isNotNull(), "malformed")
        .when(first("EventType").isNull(), "incomplete")
    )
    return counted.select("seq", "event_xml", "copies", e.alias("e")).select(
        "seq",
        F.substring_index(first("EventType"), "_", 1).alias("evento"),
        F.when(kind.isin(OBJECT_TYPES), kind).alias("obj_tipo"),
        first("ObjectName").alias("obj_nome"),
        "event_xml",
        "copies",
        defect.alias("defect"),
    )


def good_events(read: DataFrame) -> DataFrame:
    """The events of ``read_events`` that can be applied, each once."""
    return read.filter(F.col("defect").isNull()).select("seq", "evento", *OBJECT)


def rejected_events(read: DataFrame, *keys: str) -> DataFrame:
    """(*keys, seq, event_xml, defect, n): payloads that are not applied, ``n`` times each; ``repeated`` are copies beyond the first."""
    defect = F.coalesce(F.col("defect"), F.when(F.col("copies") > 1, "repeated"))
    n = F.when(F.col("defect").isNull(), F.col("copies") - 1).otherwise(F.col("copies"))
    return read.select(*keys, "seq", "event_xml", defect.alias("defect"), n.alias("n")).filter(F.col("defect").isNotNull())


def lookup_parameters(events: DataFrame, params: DataFrame, mode: str = "each") -> DataFrame:
    """Parsed events with the parameters of their object and the message.

    ``events`` is read twice, to cut the parameters down to its objects and to look them up; store it if parsing is part of it.

    ``mode="each"`` gives a row per parameter, ``"one"`` the first by ordinal. With a ``seq`` column in
    ``params`` the parameters are those recorded with that event, else those of the object's name. Events
    without parameters stay, with NULLs; so do events of other object types, which are not looked up.
    """
    if mode not in ("each", "one"):
        raise ValueError(f"mode must be 'each' or 'one', not {mode!r}")
    on = ["seq", "_object"] if "seq" in params.columns else ["_object"]
    named = events.withColumn("_object", F.when(F.col("obj_tipo").isNotNull(), F.col("obj_nome")))
    # Parameters of other objects go first: a left join could neither broadcast few events nor drop them.
    found = (
        params.withColumnRenamed("routine_name", "_object")
        .join(named.select(*on).distinct(), on, "left_semi")
        .select(*on, "ordinal", F.col("parameter_name").alias("param_nome"), F.col("data_type").alias("param_tipo"))
    )
    if mode == "one":
        first = F.min(F.struct("ordinal", "param_nome", "param_tipo")).alias("p")
        found = found.groupBy(*on).agg(first).select(*on, "p.*")
    message = F.concat(
        F.lit(EVENT_MESSAGE), "obj_nome", F.lit("."), F.coalesce(F.col("param_nome"), F.lit(""))
    )
    return (
        named.join(found, on, "left")
        .select("seq", "evento", *OBJECT, "param_nome", "param_tipo", message.alias("mensagem"))
    )


def dictionary_apply(state: DataFrame, events: DataFrame, mode: str = "each") -> DataFrame:
    """The state after ``events`` (rows of ``lookup_parameters``), which are all newer than it.

    ``events`` is read several times; store it first if it is costly to compute.

    CREATE inserts its rows, DROP deletes the object's rows. ALTER sets the parameters of what the
    object has: with ``mode="one"`` on every row of it; with ``"each"`` the rows of one creation are
    replaced by one per parameter. ALTER and DROP of an unknown object do nothing.
    """
    seq_of = lambda kind: F.max(F.when(F.col("evento") == kind, F.col("seq")))
    marks = (
        events.filter(F.col("evento").isin("ALTER", "DROP"))
        .groupBy(*OBJECT)
        .agg(seq_of("DROP").alias("dropped"), seq_of("ALTER").alias("altered"))
    )
    created = events.filter(F.col("evento") == "CREATE").withColumnRenamed("seq", "created_seq")
    rows = state.select(*DICTIONARY_STATE.names).unionByName(created.select(*DICTIONARY_STATE.names))

    after = lambda c: F.coalesce(F.col(c) > F.col("created_seq"), F.col(c).isNotNull())
    # NULL keys match nothing here, so rows without a known type can be neither altered nor dropped.
    live = rows.join(marks, OBJECT, "left").filter(~after("dropped"))
    kept = live.filter(~after("altered")).select(*DICTIONARY_STATE.names)
    stale = live.filter(after("altered")).select(*OBJECT, "created_seq", "altered")
    if mode == "each":
        stale = stale.distinct()
    # Only the parameters of each object's last ALTER are needed: a few rows per object.
    latest = (
        events.filter(F.col("evento") == "ALTER")
        .select(*OBJECT, F.col("seq").alias("altered"), *VALUES)
        .join(marks, [*OBJECT, "altered"], "left_semi")
    )
    altered = stale.join(latest, [*OBJECT, "altered"])
    return kept.unionByName(altered.select(*DICTIONARY_STATE.names))


def dictionary(state: DataFrame) -> DataFrame:
    """The dictionary table without the bookkeeping column."""
    return state.select(*DICTIONARY.names)
