"""The parameterised report behind the dashboard, as lazy frames.

A report takes the clean tables plus filter arguments (countries, plans,
session window) and returns named DataFrames. Selections may be Python
lists (pushed down as ``isin``) or one-column DataFrames (semi-joined),
so a data-derived default such as "the first three countries" never
passes through the driver.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import as_ts, attach, round_half_even
from usagelens.operators import cohorts, insights, kpis, ml, segments, series
from usagelens.operators.activity import daily_active_users

Selection = Sequence[str] | DataFrame | None


def distinct_values(metrics: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values of one column."""
    return metrics.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def default_countries(metrics: DataFrame, k: int = 3) -> DataFrame:
    """The first k countries in sorted order (the dashboard default)."""
    return distinct_values(metrics, "country").limit(k)


def _apply(df: DataFrame, column: str, sel: Selection) -> DataFrame:
    if sel is None:
        return df
    if isinstance(sel, DataFrame):
        return df.join(sel.select(F.col(sel.columns[0]).alias(column)), column, "left_semi")
    values = list(sel)
    return df.where(F.col(column).isin(values)) if values else df  # empty selection = no filter


def filter_metrics(metrics: DataFrame, countries: Selection = None, plans: Selection = None) -> DataFrame:
    """Metrics rows of the selected countries and plans."""
    return _apply(_apply(metrics, "country", countries), "plans", plans)


def window_sessions(sessions: DataFrame, selected: DataFrame, start=None, end=None) -> DataFrame:
    """Sessions inside [start, end] (both inclusive) of the selected users.

    Without bounds the window is the whole observed range, i.e. every
    session with a time.
    """
    cond: Column = F.col("session_time").isNotNull()
    if start is not None:
        cond = cond & (F.col("session_time") >= as_ts(start))
    if end is not None:
        cond = cond & (F.col("session_time") <= as_ts(end))
    return sessions.where(cond).join(selected.select("user_id"), "user_id", "left_semi")


def filter_values(metrics: DataFrame) -> DataFrame:
    """D3: (dimension, value) choices for the country and plan filters."""
    return (distinct_values(metrics, "country").select(F.lit("country").alias("dimension"),
                                                       F.col("country").alias("value"))
            .unionByName(distinct_values(metrics, "plans").select(F.lit("plan").alias("dimension"),
                                                                  F.col("plans").alias("value"))))


def time_bounds(sessions: DataFrame, now) -> DataFrame:
    """D3: min/max session time; ``now`` when there is none, max falls back to min."""
    b = sessions.agg(F.min("session_time").alias("lo"), F.max("session_time").alias("hi"))
    lo = F.coalesce("lo", as_ts(now))
    return b.select(lo.alias("min_session_time"), F.coalesce("hi", lo).alias("max_session_time"))


def kpi_card(metrics: DataFrame) -> DataFrame:
    """Total users, paying users, conversion, churn on the selection."""
    conv = kpis.conversion_rates(metrics).select("total_users", "paid_users", "conversion_rate")
    return attach(conv, kpis.churn_rate(metrics))


def kpi_display(kpi: DataFrame) -> DataFrame:
    """The KPI card as display text, (position, label, value): counts with
    thousands separators, rates as percentages with two decimals."""
    # round half to even first: Java's %.2f rounds half up on the decimal text
    pct = lambda c: F.format_string("%.2f%%", round_half_even(F.col(c) * 100, 2))
    return kpi.select(
        F.format_number("total_users", 0).alias("users"), F.format_number("paid_users", 0).alias("paying"),
        pct("conversion_rate").alias("conv"), pct("global_churn_rate").alias("churn"),
    ).select(F.expr("stack(4, 1, 'Global Users', users, 2, 'Paying Users', paying, "
                    "3, 'Conversion', conv, 4, 'Churn', churn) AS (position, label, value)"))


def funnel(metrics: DataFrame, sessions: DataFrame) -> DataFrame:
    """(step, stage, users). "Active" = any session in the window."""
    m = metrics.agg(
        F.count("*").alias("signups"),
        F.count_distinct(F.when(F.col("is_paid_user"), F.col("user_id"))).alias("paid"),
        F.count_distinct(F.when(F.col("churn_flag"), F.col("user_id"))).alias("churned"))
    s = sessions.agg(F.count_distinct("user_id").alias("active"))
    return attach(m, s).select(F.expr(
        "stack(4, 1, 'Signups', signups, 2, 'Active (30d)', active, 3, 'Paid', paid, 4, 'Churned', churned)"
        " AS (step, stage, users)"))


def anomaly_table(sessions: DataFrame, z_threshold: float = 2.5, tail: int = 15) -> DataFrame:
    """Last ``tail`` days of the DAU anomaly table with a text label."""
    a = series.detect_dau_anomalies(sessions, z_threshold)
    return (a.orderBy(F.desc("date")).limit(tail)
            .withColumn("label", F.when(F.col("is_anomaly"), "Anomaly").otherwise("Normal")))


def forecast_table(sessions: DataFrame, periods: int = 14, tail: int = 10) -> DataFrame:
    """Last ``tail`` rows of history + forecast."""
    return series.forecast_dau(sessions, periods).orderBy(F.desc("date")).limit(tail)


def mrr_card(metrics: DataFrame, payments: DataFrame) -> DataFrame:
    """LTV figures of the selection and MRR of its payments."""
    pay = payments.join(metrics.select("user_id"), "user_id", "left_semi")
    return attach(kpis.ltv_summary(metrics), kpis.revenue_summary(pay))


def selected_payments(metrics: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments of the selected users."""
    return payments.join(metrics.select("user_id"), "user_id", "left_semi")


def scenario_grid(mrr: DataFrame, uplifts: Sequence[int] = range(0, 55, 5),
                  churn_cuts: Sequence[int] = range(0, 55, 5)) -> DataFrame:
    """Projected MRR = mrr * (1 + u/100) * (1 + c/200) for every (u, c).

    The grid is generated next to the one-row MRR record (two explodes),
    so no join is involved.
    """
    u = F.array(*[F.lit(int(x)) for x in uplifts])
    c = F.array(*[F.lit(int(x)) for x in churn_cuts])
    g = (mrr.select("current_mrr", F.explode(u).alias("conversion_uplift_pct"))
         .select("*", F.explode(c).alias("churn_reduction_pct")))
    proj = (F.col("current_mrr") * (F.lit(1.0) + F.col("conversion_uplift_pct") / 100.0)
            * (F.lit(1.0) + F.col("churn_reduction_pct") / 200.0))
    return g.select("conversion_uplift_pct", "churn_reduction_pct", "current_mrr",
                    proj.alias("projected_mrr"), (proj - F.col("current_mrr")).alias("mrr_delta"))


def selection(tables: dict[str, DataFrame], countries: Selection = None, plans: Selection = None,
              start=None, end=None) -> tuple[DataFrame, DataFrame]:
    """(selected metrics, windowed sessions of those users) for one filter setting.

    ``countries=None`` means the dashboard default (first three countries);
    pass ``[]`` for no country filter.
    """
    metrics = tables["user_metrics"]
    if countries is None:
        countries = default_countries(tables["users"])  # every user has one metrics row, and its country
    sel = filter_metrics(metrics, countries, plans)
    return sel, window_sessions(tables["sessions"], sel, start, end)


def report(tables: dict[str, DataFrame], countries: Selection = None, plans: Selection = None,
           start=None, end=None, now="2024-01-31 00:00:00", lookback_weeks: int = 12,
           model=None, importance: DataFrame | None = None) -> dict[str, DataFrame]:
    """All report frames for one filter setting (nothing is executed here).

    ``countries=None`` means the dashboard default (first three countries);
    pass ``[]`` for no country filter. With a model, the leaderboard and
    the explanations of the riskiest users come too; with its
    importances, the top drivers. These three cover all users, not the selection.
    """
    metrics, sessions = tables["user_metrics"], tables["sessions"]
    sel, win = selection(tables, countries, plans, start, end)
    mrr = mrr_card(sel, tables["payments"])
    of_model = {}
    if model is not None:
        feats = ml.prepare_ml_features(metrics)
        scored = ml.score(model, feats)
        of_model["leaderboard"] = ml.leaderboard(scored)
        of_model["explanations"] = ml.explain_top(scored, ml.shap_values(model, feats))
    if importance is not None:
        of_model["drivers"] = ml.top_drivers(importance)
    return of_model | {
        "filter_values": filter_values(metrics),
        "time_bounds": time_bounds(sessions, now),
        "kpi": kpi_card(sel),
        "funnel": funnel(sel, win),
        "cohorts": cohorts.cohort_retention_long(win, lookback_weeks),
        "dau": daily_active_users(win),
        "segments": segments.segment_by_country(sel).limit(6),
        "insights": insights.generate_insights(sel, tables["events"]),
        "mrr": mrr,
        "monthly_revenue": kpis.monthly_revenue(selected_payments(sel, tables["payments"])),
        "scenarios": scenario_grid(mrr),
        "anomalies": anomaly_table(win),
        "forecast": forecast_table(win),
    }
