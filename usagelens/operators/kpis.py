"""AN4-AN8: conversion, churn, lifetime value and revenue records.

Each record is a one-row DataFrame (never a driver dict), so it composes,
can be joined to other records, and stays lazy.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import attach, round_exact, round_half_even

from usagelens.functions import month_start


def conversion_rates(metrics: DataFrame) -> DataFrame:
    """total_users, paid_users, conversion_rate, active_conversion_rate.

    active_conversion_rate divides ALL paid users by the users with more than
    five sessions (denominator floored at 1), so it may exceed 1. Rates are
    rounded on the exact value of the quotient.
    """
    paid = F.count_distinct(F.when(F.col("is_paid_user"), F.col("user_id")))
    active = F.count(F.when(F.col("sessions_total") > 5, F.lit(1)))
    total = F.count("*")
    return metrics.agg(
        total.alias("total_users"),
        paid.alias("paid_users"),
        round_exact(paid / F.greatest(total, F.lit(1)), 4).alias("conversion_rate"),
        round_exact(paid / F.greatest(active, F.lit(1)), 4).alias("active_conversion_rate"),
    )


def churned_by_country(metrics: DataFrame) -> DataFrame:
    """(country, churned_users): distinct churned users per country."""
    return (metrics.where(F.col("churn_flag") & F.col("country").isNotNull())
            .groupBy("country").agg(F.count_distinct("user_id").alias("churned_users")))


def top_churn_countries(metrics: DataFrame, k: int = 3) -> DataFrame:
    """The k countries with most churned users (ties: name ascending)."""
    return churned_by_country(metrics).orderBy(F.desc("churned_users"), F.asc("country")).limit(k)


def churn_rate(metrics: DataFrame) -> DataFrame:
    """global_churn_rate: mean churn flag, 4 dp (null for no users)."""
    return metrics.agg(round_half_even(F.avg(F.col("churn_flag").cast("int")), 4).alias("global_churn_rate"))


def churn_summary(metrics: DataFrame, k: int = 3) -> DataFrame:
    """global_churn_rate (4 dp) and the top-k churn countries as a comma list."""
    rate = churn_rate(metrics)
    top = top_churn_countries(metrics, k).agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("churned_users")).alias("n"), "country"))),
            lambda s: s["country"]), ",").alias("top_churn_countries"))
    return attach(rate, top)


def ltv_summary(metrics: DataFrame) -> DataFrame:
    """arpu, paid_arpu, estimated_ltv = min(arpu / churn, 24 * arpu), renewal_rate_mean.

    churn is floored at 1e-6; every figure is 0 for an empty input.
    """
    churn = F.greatest(F.avg(F.col("churn_flag").cast("double")), F.lit(1e-6))
    arpu = F.avg("payments_total")
    paid_arpu = F.coalesce(F.avg(F.when(F.col("is_paid_user"), F.col("payments_total"))), F.lit(0.0))
    ltv = F.least(arpu / churn, arpu * 24)
    z = F.lit(0.0)
    return metrics.agg(
        round_half_even(F.coalesce(arpu, z), 2).alias("arpu"),
        round_half_even(paid_arpu, 2).alias("paid_arpu"),
        round_half_even(F.coalesce(ltv, z), 2).alias("estimated_ltv"),
        round_half_even(F.coalesce(F.avg("renewal_rate"), z), 3).alias("renewal_rate_mean"),
    )


def user_records(metrics: DataFrame, k: int = 3) -> DataFrame:
    """conversion, churn, ltv and top_countries side by side as structs of one row, from one read of ``metrics``.

    ``metrics`` has one row per user. The figures are those of
    :func:`conversion_rates`, :func:`churn_summary` and :func:`ltv_summary`,
    and (country, churn_rate) of the k countries of most users. Totals and
    countries are grouping sets of one aggregate; what is collected is one
    small row per country.
    """
    known, churned, paid = F.col("user_id").isNotNull(), F.col("churn_flag"), F.col("is_paid_user")
    folded = metrics.groupingSets([["country"], []], "country").agg(
        F.grouping_id().alias("set"), F.count("*").alias("users"), F.count("user_id").alias("ids"),
        F.count_if(paid & known).alias("paid"), F.count_if(F.col("sessions_total") > 5).alias("active"),
        F.avg(churned.cast("int")).alias("churn"), F.count_if(churned).alias("churned"), F.count_if(churned & known).alias("churned_ids"),
        F.avg("payments_total").alias("arpu"), F.avg(F.when(paid, F.col("payments_total"))).alias("paid_arpu"),
        F.avg("renewal_rate").alias("renewal"))
    total = ["users", "paid", "active", "churn", "arpu", "paid_arpu", "renewal"]
    named = (F.col("set") == 0) & F.col("country").isNotNull()

    def first_k(chosen, *fields):
        return F.slice(F.array_sort(F.collect_list(F.when(named & chosen, F.struct(*fields)))), 1, k)

    row = folded.agg(
        *[F.max(F.when(F.col("set") == 1, F.col(c))).alias(c) for c in total],  # one row of the total; none without users
        first_k(F.col("churned") > 0, (-F.col("churned_ids")).alias("n"), F.col("country")).alias("worst"),
        first_k(F.lit(True), (-F.col("ids")).alias("n"), F.col("country"), F.col("churn")).alias("largest"))
    zero = F.lit(0).cast("long")
    users, paid, active = (F.coalesce(c, zero) for c in total[:3])
    arpu = F.coalesce("arpu", F.lit(0.0))
    return row.select(
        F.struct(users.alias("total_users"), paid.alias("paid_users"),
                 round_exact(paid / F.greatest(users, F.lit(1)), 4).alias("conversion_rate"),
                 round_exact(paid / F.greatest(active, F.lit(1)), 4).alias("active_conversion_rate")).alias("conversion"),
        F.struct(round_half_even("churn", 4).alias("global_churn_rate"),
                 F.array_join(F.transform("worst", lambda s: s["country"]), ",").alias("top_churn_countries")).alias("churn"),
        F.struct(round_half_even(arpu, 2).alias("arpu"),
                 round_half_even(F.coalesce("paid_arpu", F.lit(0.0)), 2).alias("paid_arpu"),
                 round_half_even(F.least(arpu / F.greatest("churn", F.lit(1e-6)), arpu * 24), 2).alias("estimated_ltv"),
                 round_half_even(F.coalesce("renewal", F.lit(0.0)), 3).alias("renewal_rate_mean")).alias("ltv"),
        F.array_sort(F.transform("largest", lambda s: F.struct(
            s["country"].alias("country"), round_half_even(s["churn"], 3).alias("churn_rate")))).alias("top_countries"))


def monthly_revenue(payments: DataFrame) -> DataFrame:
    """(month, revenue) summed per calendar month, in order; null dates are dropped, a month of nulls sums to 0."""
    return (payments.where(F.col("payment_date").isNotNull())
            .groupBy(month_start(F.col("payment_date")).alias("month"))
            .agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue")).orderBy("month"))


def revenue_summary(payments: DataFrame) -> DataFrame:
    """current_mrr, prev_mrr, mrr_growth from the last two OBSERVED months.

    prev = current when only one month exists; growth = 0 when prev = 0;
    all zero without payments. Only the two newest month rows are kept
    (TakeOrdered), so the final step is constant size.
    """
    last2 = monthly_revenue(payments).orderBy(F.desc("month")).limit(2)
    rec = last2.agg(F.max_by("revenue", "month").alias("cur"),
                    F.min_by("revenue", "month").alias("prev"))
    cur, prev = F.coalesce("cur", F.lit(0.0)), F.coalesce("prev", F.lit(0.0))
    growth = F.when(prev != 0, (cur - prev) / prev).otherwise(F.lit(0.0))
    return rec.select(round_half_even(cur, 2).alias("current_mrr"),
                      round_half_even(prev, 2).alias("prev_mrr"),
                      round_half_even(growth, 4).alias("mrr_growth"))
