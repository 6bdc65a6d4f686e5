"""AN1: fold users, sessions and payments into one metrics row per user."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import round_half_even

from usagelens.functions import as_ts, whole_days

EPOCH = "1970-01-01 00:00:00"


def session_metrics(sessions: DataFrame) -> DataFrame:
    """Per user: count, mean duration, first/last session time, span in days.

    A NaN duration counts as null. The mean is a sum of doubles: its last
    bits depend on the order of addition.
    """
    return (sessions.where(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.count("session_id").alias("sessions_total"),
                 F.avg(F.when(~F.isnan("duration"), F.col("duration"))).alias("avg_session_duration"),
                 F.min("session_time").alias("first_session"),
                 F.max("session_time").alias("last_session"))
            .withColumn("session_span_days",
                        F.coalesce(whole_days(F.col("first_session"), F.col("last_session")),
                                   F.lit(0)).cast("long")))


def payment_metrics(payments: DataFrame) -> DataFrame:
    """Per user: revenue sum, last payment, modal plan (smallest on ties), count.

    ``mode`` keeps a value->count map per group (bounded by distinct plans)
    and combines map-side, so a user with a huge share of rows stays cheap.
    """
    return (payments.where(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("payments_total"),
                 F.coalesce(F.max("payment_date"), F.lit(EPOCH).cast("timestamp_ntz"))
                  .alias("last_payment"),
                 F.coalesce(F.mode("plan", True), F.lit("free")).alias("plans"),
                 F.count("payment_date").alias("payment_count")))


def user_metrics(users: DataFrame, sessions: DataFrame, payments: DataFrame,
                 as_of="2024-01-31 00:00:00", churn_days: int = 60) -> DataFrame:
    """One row per user with the 16 columns of the metrics table.

    Both aggregates come out hash-partitioned by user_id, as do the
    deduplicated users, so the two left joins need no further exchange.
    ``last_payment`` stays null for users without payment rows, and so
    does ``days_since_last_payment``.
    """
    now = as_ts(as_of)
    days_since = F.when(F.col("last_payment").isNotNull(),
                        F.greatest(whole_days(F.col("last_payment"), now), F.lit(0)))
    j = (users.select("user_id", "signup_date", "country")
         .join(session_metrics(sessions), "user_id", "left")
         .join(payment_metrics(payments), "user_id", "left"))
    return j.select(
        "user_id", "signup_date", "country",
        F.coalesce("sessions_total", F.lit(0)).cast("long").alias("sessions_total"),
        # nine digits first, so that a tie at the third does not hang on the order of addition
        round_half_even(round_half_even(F.coalesce("avg_session_duration", F.lit(0.0)), 9), 2).alias("avg_session_duration"),
        "first_session", "last_session",
        F.coalesce("session_span_days", F.lit(0)).cast("long").alias("session_span_days"),
        F.coalesce("payments_total", F.lit(0.0)).alias("payments_total"),
        "last_payment",
        F.coalesce("plans", F.lit("free")).alias("plans"),
        F.coalesce("payment_count", F.lit(0)).cast("long").alias("payment_count"),
        days_since.cast("long").alias("days_since_last_payment"),
    ).select(
        "*",
        (F.coalesce(F.col("days_since_last_payment") > churn_days, F.lit(False))
         & (F.col("payment_count") > 0)).alias("churn_flag"),
        (F.col("plans") != "free").alias("is_paid_user"),
        F.least(F.lit(1.0), F.col("payment_count")
                / F.greatest(F.lit(1), F.col("session_span_days") + 1)).alias("renewal_rate"),
    )
