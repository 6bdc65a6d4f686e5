"""Daily activity: the shared ``user_day`` rollup, DAU and MAU."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import month_start


def user_day(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct (user_id, date) pairs with a session (null times dropped).

    The distinct combines map-side, so a very active user is reduced before
    the shuffle. Each use computes it anew; ``rollup.day_bitmaps`` is the form
    to write once and share.
    """
    return (sessions.where(F.col("session_time").isNotNull() & F.col("user_id").isNotNull())
            .select(*by, "user_id", F.to_date("session_time").alias("date"))
            .distinct())


def daily_active_users(sessions: DataFrame, by: Sequence[str] = (),
                       approx_rsd: float | None = None) -> DataFrame:
    """(by..., date, dau): distinct active users per calendar day.

    ``approx_rsd`` switches to a HyperLogLog++ count with that relative
    standard deviation: fixed-size sketches instead of the (user, day) rollup.
    """
    if approx_rsd is not None:
        return (sessions.where(F.col("session_time").isNotNull() & F.col("user_id").isNotNull())
                .groupBy(*by, F.to_date("session_time").alias("date"))
                .agg(F.approx_count_distinct("user_id", approx_rsd).alias("dau")))
    return (user_day(sessions, by).groupBy(*by, "date")
            .agg(F.count("*").alias("dau")))


def monthly_active_users(sessions: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """(activity_month, mau); sessions without a time form a null month."""
    users = (F.count_distinct("user_id") if approx_rsd is None
             else F.approx_count_distinct("user_id", approx_rsd))
    return (sessions.groupBy(month_start(F.col("session_time")).alias("activity_month"))
            .agg(users.alias("mau")))
