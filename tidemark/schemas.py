"""Record schemas, fixed and explicit: nothing is inferred from data."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


LINE = _schema(("value", T.StringType()))

USER_BEHAVIOR = _schema(
    ("user_id", T.LongType()),
    ("item_id", T.LongType()),
    ("category_id", T.IntegerType()),
    ("behavior", T.StringType()),
    ("ts", T.TimestampNTZType()),
)

ITEM_VIEW_COUNT = _schema(
    ("item_id", T.LongType()),
    ("window_end", T.TimestampNTZType()),
    ("view_count", T.LongType()),
)

LOG_EVENT = _schema(
    ("ip", T.StringType()),
    ("ts", T.TimestampNTZType()),
    ("method", T.StringType()),
    ("url", T.StringType()),
)

URL_VIEW_COUNT = _schema(
    ("url", T.StringType()),
    ("window_start", T.TimestampNTZType()),
    ("window_end", T.TimestampNTZType()),
    ("view_count", T.LongType()),
)

LOGIN_EVENT = _schema(
    ("user_id", T.LongType()),
    ("ip", T.StringType()),
    ("event_type", T.StringType()),
    ("ts", T.TimestampNTZType()),
)

ORDER_EVENT = _schema(
    ("order_id", T.LongType()),
    ("event_type", T.StringType()),
    ("ts", T.TimestampNTZType()),
)

ORDER_RESULT = _schema(("order_id", T.LongType()), ("result", T.StringType()))

SENSOR_READING = _schema(
    ("id", T.StringType()),
    ("ts", T.TimestampNTZType()),
    ("temperature", T.DoubleType()),
)

FILTER_SWITCH = _schema(
    ("id", T.StringType()),
    ("ts", T.TimestampNTZType()),
    ("duration_ms", T.LongType()),
)
