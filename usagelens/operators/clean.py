"""Cleaning of the four raw tables (dedupe, null handling, type fixing)."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import keep_first

# Default "first row" orders: the raw tables have no row order, so the
# keep-first dedupe needs one. Nulls sort last in every key.
USERS_ORDER = ("signup_date", "country")
SESSIONS_ORDER = ("session_time", "duration")
EVENTS_ORDER = ("event_time",)

#: What is done to a table after its dedupe, before rows without a user go (a look at it, or nothing).
Seen = Callable[[DataFrame], DataFrame]


def unseen(df: DataFrame) -> DataFrame:
    return df


def clean_users(users: DataFrame, order_by: Sequence[str | Column] = USERS_ORDER,
                seen: Seen = unseen) -> DataFrame:
    """One row per user_id (first by ``order_by``), null country -> "Unknown"."""
    u = users.withColumn("signup_date", F.col("signup_date").cast("timestamp_ntz"))
    u = seen(keep_first(u, "user_id", order_by))
    return u.withColumn("country", F.coalesce("country", F.lit("Unknown")))


def median_of(df: DataFrame, col: str, exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """One-row frame holding the median of ``col`` (nulls ignored).

    NaN counts as null. The exact form takes two approximate quantiles that
    surely enclose the median (a sketch's rank is off by at most
    1/``accuracy`` of the rows, and they lie twice that away on either side),
    counts the rows below the lower one, and orders only the distinct values
    between them: some 6/``accuracy`` of the values meet in one task, all else
    is partial aggregates whose parallelism follows the rows. A bracket that
    does not hold the middle raises an error. ``exact=False`` uses
    ``percentile_approx``.
    """
    known = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    if not exact:
        return known.agg(F.percentile_approx("v", 0.5, 10000).alias("_median"))
    ends = known.agg(F.percentile_approx("v", [0.5 - 2 / accuracy, 0.5 + 2 / accuracy], accuracy).alias("ends")).scalar()
    hist = known.groupBy("v").agg(F.count("*").alias("c")).withColumn("ends", ends)
    inside = F.col("v").between(F.col("ends")[0], F.col("ends")[1])
    # one row of totals and the (value, count) pairs inside the bracket, in order
    found = hist.agg(F.sum("c").alias("n"), F.coalesce(F.sum(F.when(F.col("v") < F.col("ends")[0], F.col("c"))), F.lit(0)).alias("below"),
                     F.array_sort(F.collect_list(F.when(inside, F.struct("v", "c")))).alias("pairs"))
    upto = F.aggregate(
        "pairs", F.struct(F.col("below").alias("done"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")),
        lambda acc, p: F.struct(
            (acc["done"] + p["c"]).alias("done"),
            F.coalesce(acc["low"], F.when(acc["done"] + p["c"] >= F.expr("(n + 1) div 2"), p["v"])).alias("low"),
            F.coalesce(acc["high"], F.when(acc["done"] + p["c"] >= F.expr("n div 2 + 1"), p["v"])).alias("high")))
    middle = found.select("n", "below", upto.alias("m"))
    held = (F.col("below") < F.expr("(n + 1) div 2")) & F.col("m.high").isNotNull()
    return middle.select(F.when(F.col("n").isNull(), F.lit(None).cast("double"))
                         .when(held, (F.col("m.low") + F.col("m.high")) / 2)
                         .otherwise(F.raise_error(F.lit("the bracket does not hold the median")).cast("double")).alias("_median"))


def dedupe_sessions(sessions: DataFrame, order_by: Sequence[str | Column] = SESSIONS_ORDER,
                    seen: Seen = unseen) -> DataFrame:
    """First phase of session cleaning: one row per session_id, then rows
    without a user dropped."""
    s = sessions.withColumn("session_time", F.col("session_time").cast("timestamp_ntz"))
    return seen(keep_first(s, "session_id", order_by)).where(F.col("user_id").isNotNull())


def fill_duration(sessions: DataFrame, exact_median: bool = True) -> DataFrame:
    """Second phase: null duration -> median of the known durations."""
    med = median_of(sessions, "duration", exact_median).scalar()  # one value, one subquery
    return sessions.withColumn("duration", F.coalesce(F.when(~F.isnan("duration"), F.col("duration")), med))


def clean_sessions(sessions: DataFrame, order_by: Sequence[str | Column] = SESSIONS_ORDER,
                   exact_median: bool = True, seen: Seen = unseen) -> DataFrame:
    """Dedupe session_id, then drop null user_id, then fill null duration
    with the median of what remains. Null session_time stays null.

    The median is a scalar subquery over the deduplicated rows; at run time
    it reuses the dedupe shuffle of the main plan (ReusedExchange), so the
    dedupe runs once.
    """
    return fill_duration(dedupe_sessions(sessions, order_by, seen), exact_median)


def clean_events(events: DataFrame, order_by: Sequence[str | Column] = EVENTS_ORDER,
                 seen: Seen = unseen) -> DataFrame:
    """Dedupe event_id, drop null user_id, null feature -> "unknown"."""
    e = events.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    e = seen(keep_first(e, "event_id", order_by)).where(F.col("user_id").isNotNull())
    return e.withColumn("feature", F.coalesce("feature", F.lit("unknown")))


def clean_payments(payments: DataFrame) -> DataFrame:
    """Cast payment_date, lower-case plan. No dedupe, no null drop."""
    return (payments
            .withColumn("payment_date", F.col("payment_date").cast("timestamp_ntz"))
            .withColumn("plan", F.lower("plan"))
            .withColumn("revenue", F.col("revenue").cast("double")))
