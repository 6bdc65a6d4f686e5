"""AN2 / AN3: weekly cohorts by week of first activity."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions import week_start


#: A Monday: weeks are numbered from it, and 63 of them are the bits of one mask.
ORIGIN = "1970-01-05"
BITS = 63


def activity_masks(sessions: DataFrame) -> DataFrame:
    """(user_id, word, mask): a user's active weeks as bits; bit b of word w is week 63 w + b from ``ORIGIN``.

    Sessions without a user or a time count nowhere. Masks are longs merged by
    OR in a hash aggregate, map-side first, so a very active user is a few rows
    before the shuffle; a span of any length is as many words as it needs.
    """
    days = F.datediff(week_start(F.col("session_time")), F.lit(ORIGIN).cast("date"))
    known = (sessions.where(F.col("session_time").isNotNull() & F.col("user_id").isNotNull())
             .select("user_id", days.alias("days")))  # whole weeks, before the origin too
    bit = F.pmod(F.expr("days div 7"), F.lit(BITS))
    word = F.expr(f"(days div 7 - pmod(days div 7, {BITS})) div {BITS}")
    return (known.select("user_id", word.cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int")).alias("bit"))
            .groupBy("user_id", "word").agg(F.bit_or("bit").alias("mask")))


def cohort_retention_long(sessions: DataFrame, lookback_weeks: int = 12) -> DataFrame:
    """(cohort_week, week_offset, active_users, retention), observed cells only.

    cohort_week = Monday of the user's first session week; week_offset =
    whole weeks since then, kept when 0 <= offset < lookback_weeks;
    retention = active users / cohort size (active users at offset 0).

    Plan: masks of active weeks per user (:func:`activity_masks`), the first
    week as a minimum over a user's few words, then one sum per offset and
    cohort: no sets, and no row per user and week.
    """
    masks = activity_masks(sessions)
    # the lowest set bit alone has as many ones below it as its place says
    lowest = F.bit_count(F.col("mask").bitwiseAND(-F.col("mask")) - 1)
    first = F.min(F.col("word") * BITS + lowest).over(Window.partitionBy("user_id"))
    placed = masks.select("mask", (F.col("word") * BITS).alias("base"), first.alias("first"))
    cells = []
    for k in range(lookback_weeks):
        at = F.col("first") + k - F.col("base")
        set_ = F.call_function("shiftright", F.col("mask"), at.cast("int")).bitwiseAND(F.lit(1).cast("long"))
        cells.append(F.sum(F.when(at.between(0, BITS - 1), set_)).alias(f"n{k}"))
    if not cells:
        return placed.select(F.lit(None).cast("date").alias("cohort_week"), F.lit(0).alias("week_offset"),
                             F.lit(0).cast("long").alias("active_users"), F.lit(0.0).alias("retention")).where(F.lit(False))
    wide = placed.groupBy("first").agg(*cells)
    offsets = F.array(*[F.struct(F.lit(k).alias("week_offset"), F.col(f"n{k}").alias("active_users")) for k in range(lookback_weeks)])
    counts = wide.select(F.date_add(F.lit(ORIGIN).cast("date"), F.col("first") * 7).alias("cohort_week"), F.col("n0").alias("_size"),
                         F.inline(offsets)).where(F.col("active_users") > 0)
    return counts.select("cohort_week", "week_offset", "active_users",
                         F.coalesce(F.try_divide(F.col("active_users").cast("double"), F.col("_size")), F.lit(0.0)).alias("retention"))


def cohort_retention_wide(sessions: DataFrame, lookback_weeks: int = 12) -> DataFrame:
    """Cohort x offset matrix of retention, columns w0..w{lookback-1}, missing = 0."""
    long = cohort_retention_long(sessions, lookback_weeks)
    wide = (long.groupBy("cohort_week")
            .pivot("week_offset", list(range(lookback_weeks)))
            .agg(F.first("retention")))
    return wide.select("cohort_week", *[
        F.coalesce(F.col(str(k)), F.lit(0.0)).alias(f"w{k}") for k in range(lookback_weeks)])


def latest_cohort(retention_long: DataFrame, weeks: int = 4) -> DataFrame:
    """Retention of the newest cohort at offsets 0..weeks-1 (absent offsets = 0)."""
    last = retention_long.agg(F.max("cohort_week").alias("cohort_week"))
    grid = last.where(F.col("cohort_week").isNotNull()) \
        .select("cohort_week", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))).alias("week_offset"))
    return (grid.join(retention_long.select("cohort_week", "week_offset", "retention"),
                      ["cohort_week", "week_offset"], "left")
            .select("cohort_week", "week_offset",
                    F.coalesce("retention", F.lit(0.0)).alias("retention")))
