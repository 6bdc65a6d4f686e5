"""The query catalogue exposed through ``__spark_entry__.queries()``.

Each entry is ``f(spark, sf_dir) -> DataFrame`` over the whole test tables
(mapped by ``sources/fixtures.py``). Double columns whose value depends on
summation order are rounded to ``DIGITS`` so the independent SQL oracle
can compare them; operator outputs themselves are unrounded.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import round_doubles, round_half_even
from usagelens.operators import cohorts, insights, kpis, report, rollup, segments, series
from usagelens.operators.activity import daily_active_users, user_day
from usagelens.operators.user_metrics import user_metrics
from usagelens.plans import sqllib
from usagelens.session import written
from usagelens.sources import fixtures as fx

DIGITS = 4
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def round_means(df: DataFrame) -> DataFrame:
    """Round means of sums to ``DIGITS``, after nine digits have taken away what the order of addition adds."""
    return round_doubles(round_doubles(df, 9), DIGITS)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fx.raw_tables(spark, sf_dir)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Clean tables plus ``user_metrics`` at the fixture as-of time."""
    t = fx.clean_tables(spark, sf_dir)
    t["user_metrics"] = user_metrics(t["users"], t["sessions"], t["payments"], fx.AS_OF)
    return t


# ---- cleaning and the metrics fold -----------------------------------------
@query
def clean_users(spark, sf_dir):
    return tables(spark, sf_dir)["users"]


@query
def clean_sessions(spark, sf_dir):
    return round_doubles(tables(spark, sf_dir)["sessions"], DIGITS)


@query
def clean_events(spark, sf_dir):
    return tables(spark, sf_dir)["events"]


@query
def clean_payments(spark, sf_dir):
    return tables(spark, sf_dir)["payments"]


@query
def user_metrics_table(spark, sf_dir):
    return round_doubles(tables(spark, sf_dir)["user_metrics"], DIGITS)


# ---- SQL library -------------------------------------------------------------
@query
def rollup_dau(spark, sf_dir):
    return rollup.daily_from(rollup.day_bitmaps(tables(spark, sf_dir)["sessions"]))


@query
def rollup_mau(spark, sf_dir):
    return rollup.monthly_from(rollup.day_bitmaps(tables(spark, sf_dir)["sessions"]))


@query
def sql_dau(spark, sf_dir):
    return sqllib.sql_dau(spark, tables(spark, sf_dir)["sessions"])


@query
def sql_mau(spark, sf_dir):
    return sqllib.sql_mau(spark, tables(spark, sf_dir)["sessions"])


@query
def sql_retention_4w(spark, sf_dir):
    t = tables(spark, sf_dir)
    return sqllib.sql_retention_4w(spark, t["users"], t["sessions"])


@query
def sql_funnel(spark, sf_dir):
    t = tables(spark, sf_dir)
    return sqllib.sql_funnel(spark, t["users"], t["sessions"], t["payments"], t["user_metrics"],
                             fx.AS_OF)


# ---- activity, cohorts -------------------------------------------------------
@query
def user_day_rollup(spark, sf_dir):
    return user_day(tables(spark, sf_dir)["sessions"])


@query
def cohort_retention_long(spark, sf_dir):
    return round_doubles(cohorts.cohort_retention_long(tables(spark, sf_dir)["sessions"]), DIGITS)


@query
def cohort_retention_wide(spark, sf_dir):
    return round_doubles(cohorts.cohort_retention_wide(tables(spark, sf_dir)["sessions"]), DIGITS)


@query
def latest_cohort(spark, sf_dir):
    long = cohorts.cohort_retention_long(tables(spark, sf_dir)["sessions"])
    return round_doubles(cohorts.latest_cohort(long, 4), DIGITS)


# ---- KPI records -------------------------------------------------------------
@query
def conversion(spark, sf_dir):
    return kpis.conversion_rates(tables(spark, sf_dir)["user_metrics"])


@query
def churn_summary(spark, sf_dir):
    return kpis.churn_summary(tables(spark, sf_dir)["user_metrics"])


@query
def ltv(spark, sf_dir):
    return kpis.ltv_summary(tables(spark, sf_dir)["user_metrics"])


@query
def monthly_revenue(spark, sf_dir):
    return round_doubles(kpis.monthly_revenue(tables(spark, sf_dir)["payments"]), DIGITS)


@query
def revenue_summary(spark, sf_dir):
    return kpis.revenue_summary(tables(spark, sf_dir)["payments"])


@query
def segment_country(spark, sf_dir):
    return round_means(segments.segment_by_country(tables(spark, sf_dir)["user_metrics"]))


@query
def segment_plan(spark, sf_dir):
    return round_means(segments.segment_by_plan(tables(spark, sf_dir)["user_metrics"]))


@query
def insights_text(spark, sf_dir):
    t = tables(spark, sf_dir)
    return insights.generate_insights(t["user_metrics"], t["events"])


# ---- series ------------------------------------------------------------------
@query
def dau_anomalies(spark, sf_dir):
    # no day of the fixture reaches 2.5, so the catalogue uses 1.5
    return round_doubles(series.detect_dau_anomalies(tables(spark, sf_dir)["sessions"], 1.5), 6)


@query
def dau_anomalies_by_country(spark, sf_dir):
    t = tables(spark, sf_dir)
    return round_doubles(series.detect_dau_anomalies_by(t["sessions"], t["users"], ["country"], 1.5), 6)


@query
def dau_anomalies_by_plan(spark, sf_dir):
    t = tables(spark, sf_dir)
    return round_doubles(series.detect_dau_anomalies_by(t["sessions"], t["user_metrics"], ["plans"], 1.5), 6)


@query
def mau(spark, sf_dir):
    from usagelens.operators.activity import monthly_active_users
    return monthly_active_users(tables(spark, sf_dir)["sessions"])


@query
def dau_forecast(spark, sf_dir):
    return round_doubles(series.forecast_dau(tables(spark, sf_dir)["sessions"], 14), DIGITS)


@query
def dau_forecast_by_plan(spark, sf_dir):
    t = tables(spark, sf_dir)
    return round_doubles(series.forecast_dau_by(t["sessions"], t["user_metrics"], ["plans"], 14), DIGITS)


@query
def dau_forecast_by_country(spark, sf_dir):
    t = tables(spark, sf_dir)
    return round_doubles(series.forecast_dau_by(t["sessions"], t["users"], ["country"], 14), DIGITS)




# ---- report (dashboard defaults: first three countries, all plans, full window)
def _sel(spark, sf_dir):
    t = tables(spark, sf_dir)
    sel, win = report.selection(t)
    return t, sel, win


# explicit filter setting (parameters, not data): five countries, two plans,
# the second and third week of January
FILTER = dict(countries=["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"],
              plans=["growth", "enterprise"], start="2024-01-08 00:00:00", end="2024-01-21 23:59:59")


def _sel_filtered(spark, sf_dir):
    t = tables(spark, sf_dir)
    sel, win = report.selection(t, **FILTER)
    return t, sel, win


@query
def report_funnel_filtered(spark, sf_dir):
    _, sel, win = _sel_filtered(spark, sf_dir)
    return report.funnel(sel, win)


@query
def report_dau_filtered(spark, sf_dir):
    return daily_active_users(_sel_filtered(spark, sf_dir)[2])


@query
def report_cohorts_filtered(spark, sf_dir):
    return round_doubles(cohorts.cohort_retention_long(_sel_filtered(spark, sf_dir)[2]), DIGITS)


@query
def report_filter_values(spark, sf_dir):
    return report.filter_values(tables(spark, sf_dir)["user_metrics"])


@query
def report_time_bounds(spark, sf_dir):
    return report.time_bounds(tables(spark, sf_dir)["sessions"], fx.AS_OF)


@query
def report_kpi(spark, sf_dir):
    return report.kpi_card(_sel(spark, sf_dir)[1])


@query
def report_kpi_display(spark, sf_dir):
    return report.kpi_display(report.kpi_card(_sel(spark, sf_dir)[1]))


@query
def report_funnel(spark, sf_dir):
    _, sel, win = _sel(spark, sf_dir)
    return report.funnel(sel, win)


@query
def report_dau(spark, sf_dir):
    return daily_active_users(_sel(spark, sf_dir)[2])


@query
def report_segments_top(spark, sf_dir):
    return round_means(segments.segment_by_country(_sel(spark, sf_dir)[1]).limit(6))


@query
def report_cohorts(spark, sf_dir):
    return round_doubles(cohorts.cohort_retention_long(_sel(spark, sf_dir)[2]), DIGITS)


@query
def report_insights(spark, sf_dir):
    t, sel, _ = _sel(spark, sf_dir)
    return insights.generate_insights(sel, t["events"])


@query
def report_insights_empty(spark, sf_dir):
    """The guard applied to the selection of every country and plan: one of nobody has no sentence, though there are events."""
    t = tables(spark, sf_dir)
    return insights.insights_by_segment(t["user_metrics"], t["events"])


@query
def report_mrr(spark, sf_dir):
    t, sel, _ = _sel(spark, sf_dir)
    return report.mrr_card(sel, t["payments"])


@query
def report_monthly_revenue(spark, sf_dir):
    t, sel, _ = _sel(spark, sf_dir)
    return round_doubles(kpis.monthly_revenue(report.selected_payments(sel, t["payments"])), DIGITS)


@query
def scenario_grid(spark, sf_dir):
    t, sel, _ = _sel(spark, sf_dir)
    return round_doubles(report.scenario_grid(report.mrr_card(sel, t["payments"])), DIGITS)


@query
def report_anomaly_tail(spark, sf_dir):
    return round_doubles(report.anomaly_table(_sel(spark, sf_dir)[2]), 6)


@query
def report_forecast_tail(spark, sf_dir):
    return round_doubles(report.forecast_table(_sel(spark, sf_dir)[2]), DIGITS)


# ---- churn model: Newton's fit (oracle: the same steps in SQL); boosted trees have no SQL form ----
def _model(spark, sf_dir, backend="logreg"):
    """(ml, features, model); the features are written once, for the fit and for all that follows."""
    from usagelens.operators import ml
    feats = written(ml.prepare_ml_features(tables(spark, sf_dir)["user_metrics"]))
    return ml, feats, ml.train_churn_model(feats, backend, stored=True)


def _scored(spark, sf_dir):
    """(ml, features, model, scores); scores carry nine digits, so that both engines see the same ties."""
    ml, feats, model = _model(spark, sf_dir)
    return ml, feats, model, ml.score(model, feats).withColumn("churn_probability", round_half_even("churn_probability", 9))


@query
def churn_model_weights(spark, sf_dir):
    ml, feats, model = _model(spark, sf_dir)
    weights, intercept = model.weights
    rows = [*zip(ml.FEATURES, weights), ("intercept", intercept)]
    return round_doubles(spark.createDataFrame(rows, "term string, weight double"), 6)


@query
def churn_scored(spark, sf_dir):
    return round_doubles(_scored(spark, sf_dir)[3], 6)


@query
def churn_scored_gbt(spark, sf_dir):
    ml, feats, model = _model(spark, sf_dir, "gbt")
    return ml.score(model, feats)


@query
def churn_report(spark, sf_dir):
    ml, _, _, scored = _scored(spark, sf_dir)
    return round_doubles(ml.classification_report(scored), 6)


@query
def churn_auc(spark, sf_dir):
    ml, _, _, scored = _scored(spark, sf_dir)
    return round_doubles(ml.roc_auc(scored), 9)


@query
def churn_importance(spark, sf_dir):
    ml, feats, model = _model(spark, sf_dir)
    return round_doubles(ml.feature_importance(model, feats), 6)


@query
def churn_top_drivers(spark, sf_dir):
    ml, feats, model = _model(spark, sf_dir)
    return round_doubles(ml.top_drivers(ml.feature_importance(model, feats)), 6)


@query
def churn_leaderboard(spark, sf_dir):
    ml, _, _, scored = _scored(spark, sf_dir)
    return round_doubles(ml.leaderboard(scored), 6)


@query
def churn_shap(spark, sf_dir):
    ml, feats, model = _model(spark, sf_dir)
    return round_doubles(ml.shap_values(model, feats), 6)


@query
def churn_explain_top(spark, sf_dir):
    ml, feats, model, scored = _scored(spark, sf_dir)
    return round_doubles(ml.explain_top(scored, ml.shap_values(model, feats)), 6)


@query
def churn_explain_top_gbt(spark, sf_dir):
    ml, feats, model = _model(spark, sf_dir, "gbt")
    return ml.explain_top(ml.score(model, feats), ml.shap_values(model, feats))


# ---- a linear model of fixed weights (oracle-checked) --------------------------
#: Weight of each standardised feature and the intercept: parameters, not data.
FIXED_WEIGHTS = {"sessions_total": -0.8, "avg_session_duration": 0.15, "session_span_days": -0.35,
                 "payments_total": 0.6, "payment_count": -0.45, "renewal_rate": -1.1}
FIXED_INTERCEPT = -0.25


def _fixed(spark, sf_dir):
    """(ml, features, model, scores); scores carry nine digits, so that both engines see the same ties."""
    from usagelens.operators import ml
    feats = ml.prepare_ml_features(tables(spark, sf_dir)["user_metrics"])
    model = ml.LinearModel(ml.scaler_stats(feats), tuple(FIXED_WEIGHTS[c] for c in ml.FEATURES), FIXED_INTERCEPT)
    scored = ml.score(model, feats).withColumn("churn_probability", round_half_even("churn_probability", 9))
    return ml, feats, model, scored


@query
def scaler_stats_table(spark, sf_dir):
    from usagelens.operators import ml
    return round_doubles(ml.scaler_table(ml.prepare_ml_features(tables(spark, sf_dir)["user_metrics"])), DIGITS)


@query
def linear_scored_fixed(spark, sf_dir):
    scored = _fixed(spark, sf_dir)[3]
    return round_doubles(scored.select("user_id", "plans", "churn_flag", "churn_probability"), 6)


@query
def linear_shap_fixed(spark, sf_dir):
    ml, feats, model, _ = _fixed(spark, sf_dir)
    return round_doubles(ml.linear_shap(model, feats), 6)


@query
def linear_report_fixed(spark, sf_dir):
    ml, _, _, scored = _fixed(spark, sf_dir)
    return round_doubles(ml.classification_report(scored), 6)


@query
def linear_auc_fixed(spark, sf_dir):
    ml, _, _, scored = _fixed(spark, sf_dir)
    return round_doubles(ml.roc_auc(scored), 9)


@query
def leaderboard_fixed(spark, sf_dir):
    ml, _, _, scored = _fixed(spark, sf_dir)
    return round_doubles(ml.leaderboard(scored), 6)


@query
def explain_top_fixed(spark, sf_dir):
    ml, feats, model, scored = _fixed(spark, sf_dir)
    return round_doubles(ml.explain_top(scored, ml.linear_shap(model, feats)), 6)


# ---- evaluation arithmetic on a fixed score column (oracle-checked) ----------
def _renewal_scored(spark, sf_dir):
    from usagelens.operators import ml
    return ml, ml.prepare_ml_features(tables(spark, sf_dir)["user_metrics"])


@query
def classification_report_threshold(spark, sf_dir):
    ml, feats = _renewal_scored(spark, sf_dir)
    return round_doubles(ml.classification_report(feats, score_col="renewal_rate", threshold=0.5), 6)


@query
def auc_of_score(spark, sf_dir):
    ml, feats = _renewal_scored(spark, sf_dir)
    return round_doubles(ml.roc_auc(feats, score_col="renewal_rate"), 9)


# ---- data quality, summary record ---------------------------------------------
@query
def dq_profile(spark, sf_dir):
    from usagelens.operators.quality import dq_profile as profile
    return round_doubles(profile(raw_tables(spark, sf_dir)), 6)


@query
def summary_kpis(spark, sf_dir):
    from usagelens.plans import pipeline
    return pipeline.summary_kpis(tables(spark, sf_dir))


@query
def summary_json(spark, sf_dir):
    from usagelens.operators import ml
    from usagelens.plans import pipeline
    t = tables(spark, sf_dir)
    feats = ml.prepare_ml_features(t["user_metrics"])
    model = ml.train_churn_model(feats)
    rec = pipeline.summary(t, model, ml.feature_importance(model, feats),
                           series.detect_dau_anomalies(t["sessions"]), series.forecast_dau(t["sessions"]),
                           insights.generate_insights(t["user_metrics"], t["events"]))
    return rec.select(F.to_json(F.struct(*rec.columns)).alias("summary"))
