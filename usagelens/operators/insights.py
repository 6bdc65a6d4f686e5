"""AN13: rule-based insight sentences as a (rule_id, text) frame."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import round_exact

# Sentence templates (fixed values).
CHURN_TEXT = "Users from %s show the highest churn within the cohort."
FEATURE_TEXT = "Feature %s drives the most interactions and keeps users engaged."
PLAN_TEXT = "Users on %s have the strongest renewal rate (%.2f)."


def _sentences(users: Column, churn_country: Column, feature: Column, plan: Column, renewal: Column) -> Column:
    """Array of (rule_id, text): a rule whose value is null has no sentence, and without users there is none at all."""
    # rounded on the exact value first: Java's %.2f rounds half up on the decimal text
    rules = [(churn_country, F.format_string(CHURN_TEXT, churn_country)), (feature, F.format_string(FEATURE_TEXT, feature)),
             (plan, F.format_string(PLAN_TEXT, plan, round_exact(renewal, 2)))]
    made = F.array(*[F.struct(F.lit(i).alias("rule_id"), F.when(value.isNotNull() & (users > 0), text).alias("text"))
                     for i, (value, text) in enumerate(rules, 1)])
    return F.filter(made, lambda s: s["text"].isNotNull())


def _top_feature(events: DataFrame) -> Column:
    """The feature of most events (ties: smaller name) as a scalar subquery; null without events."""
    usage = events.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.count("event_id").alias("n"))
    return usage.agg(F.min(F.struct((-F.col("n")).alias("n"), "feature")).alias("m")).select("m.feature").scalar()


def generate_insights(metrics: DataFrame, events: DataFrame) -> DataFrame:
    """Up to three sentences: top churn country, most used feature, best plan by mean renewal rate.

    A rule whose input is empty yields no row, and without any metrics row
    there is no sentence at all. ``metrics`` has one row per user and is read
    once: countries, plans and the guard are grouping sets of one aggregate.
    """
    folded = metrics.groupingSets([["country"], ["plans"], []], "country", "plans").agg(
        F.grouping_id().alias("set"), F.count("*").alias("users"), F.count_if("churn_flag").alias("churned"),
        F.avg("renewal_rate").alias("r"))
    by_country, by_plan, all_ = (F.col("set") == i for i in (1, 2, 3))
    top = folded.agg(
        F.min(F.when(by_country & F.col("country").isNotNull() & (F.col("churned") > 0),
                     F.struct((-F.col("churned")).alias("n"), "country"))).alias("churn"),
        F.min(F.when(by_plan & F.col("plans").isNotNull(), F.struct((-F.col("r")).alias("r"), "plans"))).alias("plan"),
        F.max(F.when(all_, F.col("users"))).alias("users"))
    said = top.withColumn("feature", _top_feature(events)).select(_sentences(
        F.coalesce("users", F.lit(0)), F.col("churn.country"), F.col("feature"), F.col("plan.plans"), -F.col("plan.r")).alias("s"))
    return said.select(F.inline("s"))


def insights_by_segment(metrics: DataFrame, events: DataFrame) -> DataFrame:
    """(country, plans, rule_id, text): the sentences of every selection of one country and one plan.

    All observed countries meet all observed plans, so a selection of nobody
    appears too, as a row without a sentence. The most used feature is that of
    all events, as in a report.
    """
    seg = metrics.where(F.col("country").isNotNull() & F.col("plans").isNotNull()).groupBy("country", "plans").agg(
        F.count("*").alias("users"), F.count_if("churn_flag").alias("churned"), F.avg("renewal_rate").alias("r"))
    plans = seg.agg(F.array_sort(F.collect_set("plans")).alias("p")).scalar()
    every = seg.select("country").distinct().select("country", F.explode(plans).alias("plans"))
    said = every.join(seg, ["country", "plans"], "left").withColumn("feature", _top_feature(events)).select(
        "country", "plans", _sentences(F.coalesce("users", F.lit(0)), F.when(F.col("churned") > 0, F.col("country")), F.col("feature"),
                                       F.when(F.col("users") > 0, F.col("plans")), F.col("r")).alias("s"))
    return said.select("country", "plans", F.inline_outer("s"))
