"""RA5: the shared activity rollup: one bitmap of users per day, exact and mergeable.

A user id is a bit: ids are cut into buckets of 32,768 and a (date, bucket)
row holds the bitmap of the bucket's users active that day. Days merge into
any longer span by OR, without another distinct over users. Bitmaps have a
fixed size, so a bucket costs the same whether one or all of its users came.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import month_start


def day_bitmaps(sessions: DataFrame) -> DataFrame:
    """(month, date, bucket, users): users (long ids) with a session on each day.

    Sessions without a time form rows of a null date and month; sessions
    without a user count nowhere. Bits are set map-side, so a very active user
    or day is reduced before the shuffle; the aggregate holds a fixed 4 KB per
    group.
    """
    user = F.col("user_id").cast("long")
    return (sessions.where(user.isNotNull())
            .groupBy(F.to_date("session_time").alias("date"), F.bitmap_bucket_number(user).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))
            .select(month_start(F.col("date")).alias("month"), "date", "bucket", "users"))


def daily_from(rollup: DataFrame) -> DataFrame:
    """(date, dau) from :func:`day_bitmaps`; sessions without a time count on no day."""
    return (rollup.where(F.col("date").isNotNull()).groupBy("date")
            .agg(F.sum(F.bitmap_count("users")).cast("long").alias("dau")))


def monthly_from(rollup: DataFrame) -> DataFrame:
    """(activity_month, mau) from :func:`day_bitmaps`: days are merged by OR per bucket, then counted."""
    merged = rollup.groupBy("month", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(F.col("month").alias("activity_month")).agg(F.sum(F.bitmap_count("users")).cast("long").alias("mau"))
