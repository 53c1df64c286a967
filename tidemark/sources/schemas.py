"""Column types of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, INT, STRING, DOUBLE, BOOLEAN = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DoubleType(),
    T.BooleanType(),
)
TIMESTAMP = T.TimestampType()
PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)
TTL = T.DayTimeIntervalType()
DOUBLES = T.ArrayType(DOUBLE)
FEATURE_MAP = T.MapType(STRING, DOUBLE)


def _table(required: dict, optional: dict | None = None) -> T.StructType:
    fields = [T.StructField(name, kind, False) for name, kind in required.items()]
    fields += [T.StructField(name, kind, True) for name, kind in (optional or {}).items()]
    return T.StructType(fields)


USERS = _table({"user_id": LONG, "signup_ts": TIMESTAMP})
PRODUCTS = _table({"product_id": LONG, "category": STRING, "price": PRICE})
PRODUCT_VIEWS = _table(
    {"view_id": LONG, "user_id": LONG, "product_id": LONG, "view_ts": TIMESTAMP}
)
ORDERS = _table(
    {"order_id": LONG, "user_id": LONG, "order_ts": TIMESTAMP, "total_amount": AMOUNT}
)
ORDER_ITEMS = _table(
    {"order_id": LONG, "product_id": LONG, "quantity": INT, "unit_price": PRICE}
)

FEATURE_VIEWS = _table(
    {"view_name": STRING, "entity_type": STRING},
    {"description": STRING, "owner": STRING, "ttl": TTL, "source_sql": STRING},
)
FEATURE_DEFINITIONS = _table(
    {"feature_name": STRING, "view_name": STRING},
    {
        "description": STRING,
        "dtype": STRING,
        "status": STRING,
        "expected_min": DOUBLE,
        "expected_max": DOUBLE,
        "null_threshold": DOUBLE,
        "freshness_hours": INT,
    },
)

# One value of one feature for one entity, from `event_timestamp` on.
FEATURE_VALUES = _table(
    {"view_name": STRING, "feature_name": STRING, "entity_id": LONG, "event_timestamp": TIMESTAMP},
    {"value": DOUBLE, "created_at": TIMESTAMP},
)
ONLINE = _table(
    {"entity_id": LONG, "event_timestamp": TIMESTAMP}, {"values": FEATURE_MAP}
)
CHECKS = _table(
    {"name": STRING, "metric": STRING},
    {"value": DOUBLE, "status": STRING, "message": STRING},
)
MONITOR_LOG = _table(
    {"kind": STRING, "name": STRING, "metric": STRING, "snapshot_at": TIMESTAMP},
    {"value": DOUBLE, "status": STRING, "message": STRING, "checked_at": TIMESTAMP},
)
DRIFT_REFERENCE = _table({"feature_name": STRING}, {"edges": DOUBLES, "shares": DOUBLES})
PREDICTIONS = _table(
    {"model_name": STRING, "model_version": STRING, "entity_id": LONG},
    {
        "predicted_at": TIMESTAMP,
        "probability": DOUBLE,
        "features": FEATURE_MAP,
        "features_as_of": TIMESTAMP,
    },
)


def in_utc(frame: DataFrame) -> DataFrame:
    """Read zoneless timestamps as UTC moments (the session zone is UTC)."""
    zoneless = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return frame.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def zoneless(frame: DataFrame) -> DataFrame:
    """The reverse of `in_utc`, for results compared with engines without zones."""
    zoned = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
