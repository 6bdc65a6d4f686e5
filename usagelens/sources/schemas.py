"""Declared schemas of the four raw tables and of ``user_metrics``."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

L, D, S, TS, B, DT = (T.LongType(), T.DoubleType(), T.StringType(),
                      T.TimestampNTZType(), T.BooleanType(), T.DateType())


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USERS = _schema(("user_id", L), ("signup_date", TS), ("country", S))
SESSIONS = _schema(("session_id", L), ("user_id", L), ("session_time", TS), ("duration", D))
EVENTS = _schema(("event_id", L), ("user_id", L), ("session_id", L), ("event_type", S),
                 ("feature", S), ("event_time", TS))
PAYMENTS = _schema(("user_id", L), ("plan", S), ("revenue", D), ("payment_date", TS))

USER_METRICS = _schema(
    ("user_id", L), ("signup_date", TS), ("country", S), ("sessions_total", L),
    ("avg_session_duration", D), ("first_session", TS), ("last_session", TS),
    ("session_span_days", L), ("payments_total", D), ("last_payment", TS), ("plans", S),
    ("payment_count", L), ("days_since_last_payment", L), ("churn_flag", B),
    ("is_paid_user", B), ("renewal_rate", D),
)

SCHEMAS = {"users": USERS, "sessions": SESSIONS, "events": EVENTS,
           "payments": PAYMENTS, "user_metrics": USER_METRICS}

# The six model inputs, in model order (fixed values).
FEATURE_COLUMNS = ["sessions_total", "avg_session_duration", "session_span_days",
                   "payments_total", "payment_count", "renewal_rate"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (by name); missing columns fail loudly."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail at plan time unless ``df`` carries every column of ``schema`` with its type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    bad = [(f.name, have.get(f.name), f.dataType) for f in schema.fields
           if have.get(f.name) != f.dataType]
    if bad:
        raise TypeError(f"schema mismatch (column, have, want): {bad}")
    return df
