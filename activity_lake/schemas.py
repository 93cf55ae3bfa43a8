"""Declared schemas; nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

HR_SHEET = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("birthday", T.StringType()),
    T.StructField("business_unit", T.StringType()),
    T.StructField("entry_date", T.StringType()),
    T.StructField("salary", T.DecimalType(10, 2)),
    T.StructField("employement_contract", T.StringType()),
    T.StructField("vacation_days", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("transport_mode", T.StringType()),
])

SPORT_SHEET = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sport_type", T.StringType()),
])

ACTIVITY_SHEET = T.StructType([
    T.StructField("employee_id", T.StringType()),
    T.StructField("sport", T.StringType()),
    T.StructField("situation", T.StringType()),
    T.StructField("distance_meters", T.IntegerType()),
    T.StructField("begin_date", T.TimestampNTZType()),
    T.StructField("duration_sec", T.IntegerType()),
    T.StructField("id", T.StringType()),
])

SPORT_DIMENSION = T.StructType([
    T.StructField("position", T.LongType()),
    T.StructField("sport", T.StringType()),
    T.StructField("alias", T.StringType()),
    T.StructField("templates", T.StringType()),
    T.StructField("strava_list", T.IntegerType()),
])

# Columns of an activity that make up its fingerprint; the id is not one.
FINGERPRINT_COLUMNS = [
    "employee_id", "sport", "situation", "distance_meters", "begin_date", "duration_sec",
]

# Columns of a stored activity, in their order.
STORED_COLUMNS = [
    "id", "employee_id", "sport", "situation", "distance_meters", "begin_date",
    "duration_sec", "comment", "fingerprint",
]

# Columns a comment writer sees, in order.
COMMENT_CONTEXT = ["id", "name", "sport", "situation", "performance"]

# Change events carry timestamps as epoch microseconds.
ACTIVITY_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("employee_id", T.StringType()),
    T.StructField("sport", T.StringType()),
    T.StructField("begin_date", T.LongType()),
    T.StructField("duration_sec", T.IntegerType()),
    T.StructField("distance_meters", T.IntegerType()),
])

EMPLOYEE_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("business_unit", T.StringType()),
    T.StructField("salary", T.DecimalType(10, 2)),
    T.StructField("distance_kms", T.DecimalType(10, 1)),
    T.StructField("margin_kms", T.DecimalType(10, 1)),
    T.StructField("sport_type", T.StringType()),
    T.StructField("transport_mode", T.StringType()),
])

COMMENT_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("comment", T.StringType()),
])

ANSWER = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("comment", T.StringType()),
    ]))),
])

TOKEN_RECORD = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("query_tokens", T.LongType()),
    T.StructField("context_tokens", T.LongType()),
    T.StructField("llm_tokens", T.LongType()),
    T.StructField("total_tokens", T.LongType()),
    T.StructField("chunks", T.LongType()),
    T.StructField("tokens", T.LongType()),
])

_POINT = [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
PLACES = T.StructType([
    T.StructField("elements", T.ArrayType(T.StructType([
        *_POINT,
        T.StructField("center", T.StructType(_POINT)),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]))),
])


def envelope(row: T.StructType, with_event: bool = True, old_image: bool = False) -> T.StructType:
    """Change envelope around ``row``; fields not named here are skipped when parsing.

    The event fields ``op``, ``ts_ms`` and the key of the old image let readers
    see deletes, whose ``after`` is null; ``lsn`` is the change's place in the
    source's log, which orders changes of one millisecond. ``old_image`` reads
    the whole old row, for sources that log it.
    """
    key = T.StructType([T.StructField("id", T.StringType())])
    event = [
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StructType([T.StructField("lsn", T.LongType())])),
        T.StructField("before", row if old_image else key),
    ]
    payload = T.StructType([*(event if with_event else []), T.StructField("after", row)])
    return T.StructType([T.StructField("payload", payload)])
