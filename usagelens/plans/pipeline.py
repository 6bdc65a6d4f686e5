"""The batch pipeline: clean -> metrics -> analytics -> model -> summary.

The model is trained before the summary is assembled (the summary needs
its importances). Processed tables are written once and read back, so
later stages start from files instead of re-running the cleaning lineage.
"""
from __future__ import annotations

import time
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import attach
from usagelens.operators import clean as C
from usagelens.operators import cohorts, insights, kpis, ml, rollup, series
from usagelens.operators.quality import ObservedProfile
from usagelens.operators.user_metrics import user_metrics
from usagelens.sources import io

PROCESSED = ["users", "sessions", "events", "payments", "user_metrics"]


def process(raw: dict[str, DataFrame], as_of, churn_days: int = 60,
            profile: ObservedProfile | None = None) -> dict[str, DataFrame]:
    """IO6: clean the four raw tables and fold them into ``user_metrics`` (lazy).

    ``profile`` looks at the raw tables as they are cleaned.
    """
    def seen(name):
        return C.unseen if profile is None else partial(profile.unique, name)

    if profile is not None:
        raw = {name: profile.raw(name, df) for name, df in raw.items()}
    t = {
        "users": C.clean_users(raw["users"], seen=seen("users")),
        "sessions": C.clean_sessions(raw["sessions"], seen=seen("sessions")),
        "events": C.clean_events(raw["events"], seen=seen("events")),
        "payments": C.clean_payments(raw["payments"]),
    }
    t["user_metrics"] = user_metrics(t["users"], t["sessions"], t["payments"], as_of, churn_days)
    return t


def _struct_of(record: DataFrame, name: str) -> DataFrame:
    return record.select(F.struct(*record.columns).alias(name))


def _list_of(df: DataFrame, name: str, order: list) -> DataFrame:
    # only used on frames bounded by construction (days, top-k, features)
    return df.agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order])))
                  .alias(name))


def summary_kpis(t: dict[str, DataFrame]) -> DataFrame:
    """The figures of AN14 that need no model, side by side in one row."""
    folded = kpis.user_records(t["user_metrics"]).select("conversion.*", "churn.*", "ltv.*")
    return attach(folded, kpis.revenue_summary(t["payments"]))


def summary(t: dict[str, DataFrame], model: ml.LinearModel | ml.TreeModel, importance: DataFrame,
            anomalies: DataFrame, forecast: DataFrame, notes: DataFrame) -> DataFrame:
    """AN14: the nested one-row summary record."""
    parts = [
        kpis.user_records(t["user_metrics"]).select("conversion", "churn", "top_countries", "ltv"),
        _struct_of(kpis.revenue_summary(t["payments"]), "revenue"),
        _list_of(anomalies.where("is_anomaly").select("date", "dau", "z_score"), "dau_anomalies", ["date"]),
        _list_of(forecast.orderBy(F.desc("date")).limit(14), "dau_forecast", ["date"]),
        _list_of(importance, "feature_importance", ["feature"]),
        _list_of(notes, "insights", ["rule_id"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = attach(out, p)  # every part is exactly one row
    return out.withColumn("churn_backend", F.lit(model.backend))


def run(spark: SparkSession, raw: dict[str, DataFrame], out: str, as_of,
        backend: str = "logreg", lookback_weeks: int = 12, fmt: str = "parquet") -> dict[str, str]:
    """Run everything and write the artifacts to a folder of this run under ``out``; returns their paths.

    The four clean tables are written first and ``user_metrics`` is folded
    from the written files, so no later step repeats the cleaning lineage. The
    daily user bitmaps are written once, by month, and daily and monthly users,
    anomalies and forecast read them. Data quality is observed while the clean
    tables are written. ``fmt``: parquet or csv, for the tabular
    artifacts. The manifest comes last: ``io.published(spark, out)`` finds the
    run only when all of it stands.
    """
    base, run_id = out.rstrip("/"), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    out = f"{base}/runs/{run_id}"
    profile = ObservedProfile()
    clean = process(raw, as_of, profile=profile)
    paths = io.write_all({k: clean[k] for k in ("users", "sessions", "events", "payments")},
                         f"{out}/processed")
    t = {name: spark.read.parquet(p) for name, p in paths.items()}
    metrics = user_metrics(t["users"], t["sessions"], t["payments"], as_of)
    paths["user_metrics"] = io.write_table(metrics, f"{out}/processed", "user_metrics")
    t["user_metrics"] = spark.read.parquet(paths["user_metrics"])

    art = f"{out}/artifacts"
    written = {"data_quality": io.write_table(profile.frame(spark), art, "data_quality", fmt)}
    written["cohort_retention"] = io.write_table(
        cohorts.cohort_retention_wide(t["sessions"], lookback_weeks), art, "cohort_retention", fmt)
    written["day_bitmaps"] = io.write_table(rollup.day_bitmaps(t["sessions"]), art, "day_bitmaps", partition_by=["month"])
    days = spark.read.parquet(written["day_bitmaps"])
    daily = rollup.daily_from(days)
    written["dau"] = io.write_table(daily, art, "dau", fmt)
    written["mau"] = io.write_table(rollup.monthly_from(days), art, "mau", fmt)
    # both are bounded by the days: written as parquet for the summary, and in the format asked for
    anomalies = series.zscore_anomalies(daily).select("date", "dau", "z_score", "is_anomaly")
    forecast = series.ses_forecast(daily)
    for name, frame in (("dau_anomalies", anomalies), ("dau_forecast", forecast)):
        written[name] = io.write_table(frame, art, name)
        if fmt != "parquet":
            written[f"{name}_{fmt}"] = io.write_table(spark.read.parquet(written[name]), art, name, fmt)

    feats = ml.prepare_ml_features(t["user_metrics"])
    model = ml.train_churn_model(feats, backend)
    model.save(f"{art}/churn_pipeline", spark)
    written["churn_scored"] = io.write_table(ml.score(model, feats), art, "churn_scored")
    scored = spark.read.parquet(written["churn_scored"])
    if fmt != "parquet":
        written[f"churn_scored_{fmt}"] = io.write_table(scored, art, "churn_scored", fmt)
    written["churn_auc"] = io.write_table(ml.roc_auc(scored), art, "churn_auc")
    written["churn_report"] = io.write_table(ml.classification_report(scored), art, "churn_report")
    importance = ml.feature_importance(model, feats)
    written["churn_feature_importance"] = io.write_table(importance, art, "churn_feature_importance", "csv")
    importance = io.read_importance(spark, written["churn_feature_importance"])

    # at most three sentences: evaluated once, read back by the summary and the text file
    written["insights_table"] = io.write_table(
        insights.generate_insights(t["user_metrics"], t["events"]), art, "insights_table")
    notes = spark.read.parquet(written["insights_table"])
    written["analytics_summary"] = io.write_json_record(
        summary(t, model, importance, spark.read.parquet(written["dau_anomalies"]),
                spark.read.parquet(written["dau_forecast"]), notes), f"{art}/analytics_summary")
    written["insights"] = io.write_insights_text(notes, f"{art}/insights")
    io.publish(spark, base, run_id, {**paths, **written})
    return {**paths, **written}


def main(argv: list[str] | None = None) -> dict[str, str]:
    """``python -m usagelens.plans.pipeline --out DIR (--sf-dir D | --raw-dir D)``."""
    import argparse
    import json

    from usagelens.session import get_spark
    from usagelens.sources import fixtures

    ap = argparse.ArgumentParser(description="clean, fold, analyse, train and summarise")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="driver test tables, mapped by sources/fixtures.py")
    src.add_argument("--raw-dir", help="users/sessions/events/payments (declared schemas)")
    ap.add_argument("--raw-format", default="parquet", choices=["parquet", "csv"], help="of the tables in --raw-dir")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="of the tabular artifacts")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--as-of", default=fixtures.AS_OF, help="the 'now' of the run")
    ap.add_argument("--backend", default="logreg", choices=["logreg", "gbt"])
    args = ap.parse_args(argv)

    spark = get_spark(app="usagelens-pipeline")
    if args.sf_dir:
        raw = fixtures.raw_tables(spark, args.sf_dir)
    else:
        raw = {name: io.read_table(spark, args.raw_dir, name, args.raw_format)
               for name in ("users", "sessions", "events", "payments")}
    paths = run(spark, raw, args.out, args.as_of, args.backend, fmt=args.format)
    print(json.dumps(paths, indent=2))
    return paths


if __name__ == "__main__":
    main()
