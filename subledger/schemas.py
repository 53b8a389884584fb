"""Table schemas (silver and gold) and the fixed column lists of the raw inputs."""

from __future__ import annotations

from pyspark.sql import types as T

# The event fields the silver layer guarantees (missing ones are
# added as null); any other key of an event is kept in ``extras``.
EVENT_FIELDS = (
    "event_id",
    "user_id",
    "event_type",
    "timestamp",
    "schema_version",
    "amount",
    "currency",
    "tax",
    "refers_to_event_id",
    "acquisition_channel",
)

# Subscription fields of the raw JSON records.
SUBSCRIPTION_FIELDS = (
    "subscription_id",
    "user_id",
    "plan_id",
    "price",
    "currency",
    "start_date",
    "end_date",
    "status",
    "created_at",
)

# Marketing spend CSV header.
MARKETING_FIELDS = ("date", "channel", "spend")

_S, _L, _D, _DT, _TS, _B, _I = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
    T.BooleanType(),
    T.IntegerType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE_EVENTS = _struct(
    *[(c, _S) for c in EVENT_FIELDS],
    ("extras", T.MapType(_S, _S)),
    ("_source_file", _S),
    ("_source_line_no", _L),
)
EVENTS_BAD_ROWS = _struct(("_source_file", _S), ("_source_line_no", _L), ("_raw_line", _S), ("_error", _S))
BRONZE_SUBSCRIPTIONS = _struct(*[(c, _S) for c in SUBSCRIPTION_FIELDS])
BRONZE_MARKETING = _struct(*[(c, _S) for c in MARKETING_FIELDS])

EVENTS_CLEAN = _struct(
    *[(c, _S) for c in EVENT_FIELDS],
    ("extras", T.MapType(_S, _S)),
    ("_source_file", _S),
    ("_source_line_no", _L),
    ("event_ts_utc", _TS),
    ("amount_num", _D),
    ("event_type_norm", _S),
    ("user_id_norm", _S),
)
EVENTS_REJECTED = T.StructType([*EVENTS_CLEAN.fields, T.StructField("reject_reason", _S)])
SUBSCRIPTIONS_CLEAN = _struct(
    ("subscription_id", _S),
    ("user_id", _S),
    ("plan_id", _S),
    ("price", _D),
    ("currency", _S),
    ("status", _S),
    ("created_at", _S),
    ("created_at_ts", _TS),
    ("start_date", _DT),
    ("end_date", _DT),
    ("gap_days", _I),
    ("reactivated", _B),
)
SUBSCRIPTIONS_REJECTED = _struct(
    ("subscription_id", _S),
    ("user_id", _S),
    ("plan_id", _S),
    ("price", _D),
    ("currency", _S),
    ("start_date", _S),
    ("end_date", _S),
    ("status", _S),
    ("created_at", _S),
    ("created_at_ts", _TS),
    ("gap_days", _I),
    ("reactivated", _B),
    ("reject_reason", _S),
)
MARKETING_CLEAN = _struct(("date", _DT), ("channel", _S), ("spend", _D))
MARKETING_REJECTED = _struct(("date", _DT), ("channel", _S), ("spend", _S), ("spend_num", _D), ("reject_reason", _S))
