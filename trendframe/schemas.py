"""Declared schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

WORK = "id_civil_work"
SCHEDULE = "id_schedule"
TERM = "id_term"
ACTIVITY = "id_qualitative_activity"
INPUT = "id_input_data"
REAL_ID = "id_activity_real_progress"

FRACTION = T.DecimalType(9, 6)
PERCENT = T.DecimalType(9, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _DATE, _STR, _DBL = T.LongType(), T.DateType(), T.StringType(), T.DoubleType()

TABLES: dict[str, T.StructType] = {
    "civil_work": _struct(id_civil_work=_LONG),
    "schedule": _struct(id_schedule=_LONG, id_civil_work=_LONG),
    "term": _struct(id_term=_LONG, id_civil_work=_LONG, id_schedule=_LONG),
    "term_input_data": _struct(id_term=_LONG, id_input_data=_LONG),
    "calendar": _struct(sdc_cod=_LONG, id_input_data=_LONG, calendar_period=_DATE),
    "qualitative_activity": _struct(
        id_qualitative_activity=_LONG, id_schedule=_LONG, outline_lvl=T.IntegerType()
    ),
    "foreseen_progress": _struct(
        id_qualitative_activity=_LONG, id_term_date=_DATE, foreseen_fraction=FRACTION
    ),
    "real_progress": _struct(
        id_activity_real_progress=_LONG,
        id_qualitative_activity=_LONG,
        id_term_activity=_LONG,
        progress_date=_DATE,
        progress_percentage=PERCENT,
    ),
    "term_activity": _struct(id_term_activity=_LONG, id_term=_LONG),
}

# Column names of the source database that read badly or are misnamed there, and ours (fixed values).
SOURCE_NAMES = {
    "foreseen_progress": {"id_foreseen_progress": "foreseen_fraction"},
    "real_progress": {"date": "progress_date"},
    "calendar": {"SDC_COD": "sdc_cod"},
}

MEASURES = [
    "initial_deviation",
    "mobile_deviation",
    "previous_estimate",
    "current_estimate",
    "seasonal_estimate",
    "trend_period",
]

# The result tables of the three stages in one: `stage` is 1, 2 or 3. Stage 3 built on the interval
# base spans every schedule and term, so these two keys are NULL there.
TREND = T.StructType(
    [T.StructField("stage", T.IntegerType()), T.StructField("period", _DATE)]
    + [T.StructField(name, _DBL) for name in MEASURES]
    + [T.StructField(WORK, _LONG), T.StructField(SCHEDULE, _LONG), T.StructField(TERM, _LONG)]
)

# One row per changed measurement. `before_activity` is NULL for an insert; the columns of the new
# image, `id_qualitative_activity` first, are NULL for a delete.
REAL_CHANGE = T.StructType(
    [T.StructField("seq", _LONG), T.StructField("before_activity", _LONG)]
    + TABLES["real_progress"].fields
)

# A change with both images as whole rows, as triggers see them; `before` is NULL for an insert, `after` for a delete.
CHANGE_IMAGES = T.StructType(
    [T.StructField("seq", _LONG), T.StructField("before", TABLES["real_progress"]), T.StructField("after", TABLES["real_progress"])]
)

# A change as entries of one (activity, measurement): dead for its old image, live for its new one.
CHANGE_LOG = T.StructType(
    [T.StructField("seq", _LONG), T.StructField("live", T.BooleanType())] + TABLES["real_progress"].fields
)

ROUTINE_PARAMS = _struct(
    routine_schema=_STR,
    routine_name=_STR,
    routine_type=_STR,
    parameter_name=_STR,
    data_type=_STR,
    ordinal=T.IntegerType(),
)
DDL_EVENT = _struct(seq=_LONG, event_xml=_STR)
DICTIONARY = _struct(
    obj_tipo=_STR, obj_nome=_STR, param_nome=_STR, param_tipo=_STR, mensagem=_STR
)
# An event as read, with what is wrong with its payload.
READ_EVENT = _struct(
    seq=_LONG, evento=_STR, obj_tipo=_STR, obj_nome=_STR, event_xml=_STR, copies=_LONG, defect=_STR
)
# A parsed event with its parameters: the dictionary row it would create.
PARSED_EVENT = T.StructType([T.StructField("seq", _LONG), T.StructField("evento", _STR)] + DICTIONARY.fields)
# The dictionary plus the event that created each row (NULL for rows of the first snapshot).
DICTIONARY_STATE = T.StructType(DICTIONARY.fields + [T.StructField("created_seq", _LONG)])

COLUMN_CATALOG = _struct(
    object_id=_LONG, column_name=_STR, ordinal=T.IntegerType(), data_type=_STR
)
TABLE_CATALOG = _struct(object_id=_LONG, table_name=_STR)
