"""Results that must not depend on layout or row counts, and edges the fixture tables do not reach."""
import os
import random
import statistics
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import ROOT, SF_SMALL
from usagelens.operators import clean, insights, kpis, ml, user_metrics
from usagelens.plans import sqllib
from usagelens.plans.catalog import tables


@pytest.fixture(scope="module")
def feats(spark):
    return ml.prepare_ml_features(tables(spark, SF_SMALL)["user_metrics"]).persist()


def scores(model, frame):
    return {r.user_id: r.churn_probability for r in ml.score(model, frame).collect()}


def test_fits_do_not_depend_on_layout(feats):
    for backend in ("logreg", "gbt"):
        seen = [scores(ml.train_churn_model(feats.repartition(n), backend, rounds=3), feats) for n in (1, 3, 7)]
        for other in seen[1:]:
            assert other == pytest.approx(seen[0], abs=1e-9)


def test_importance_does_not_depend_on_layout_and_keeps_all_rows(spark, feats):
    model = ml.train_churn_model(feats)
    seen = [{r.feature: r.permutation_importance for r in ml.permutation_importance(model, feats.repartition(n), repeats=2).collect()}
            for n in (1, 7)]
    assert seen[0] == pytest.approx(seen[1], abs=1e-12)
    part = feats.where("user_id % 3 = 0")  # fewer rows than the model was fitted on
    twice = feats.unionByName(feats.withColumn("user_id", F.col("user_id") + 1_000_000))
    for frame in (part, twice):
        got = ml.permutation_importance(model, frame, repeats=1).collect()
        assert len(got) == 6 and all(abs(r.permutation_importance) <= 1 for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000, 5001])
def test_median_of_all_distinct_values(spark, n):
    values = [random.Random(n).random() * 1e6 + i for i in range(n)]
    rows = [(v,) for v in values] + [(None,), (float("nan"),)]
    got = clean.median_of(spark.createDataFrame(rows, "duration double").repartition(5), "duration").first()[0]
    assert got == (statistics.median(values) if n else None)


def test_median_with_ties(spark):
    for values in ([1.0] * 9 + [2.0] * 9, [3.0] * 50, [1.0, 2.0, 2.0, 100.0] * 25 + [-5.0]):
        got = clean.median_of(spark.createDataFrame([(v,) for v in values], "d double"), "d", accuracy=1000).first()[0]
        assert got == statistics.median(values)


def test_median_plan_gathers_no_value_map(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("d"))
    plan = clean.median_of(df, "d")._jdf.queryExecution().toString()
    assert "median(" not in plan and "percentile(" not in plan


def test_no_insight_without_users(spark):
    t = tables(spark, SF_SMALL)
    assert insights.generate_insights(t["user_metrics"].where("false"), t["events"]).count() == 0
    assert insights.generate_insights(t["user_metrics"], t["events"]).count() == 3


def test_month_of_nulls_is_zero_and_months_are_sorted(spark):
    rows = [(1, "growth", None, "2024-03-05"), (1, "growth", 7.0, "2024-01-05"), (1, "growth", 2.0, "2024-02-05")]
    pay = spark.createDataFrame(rows, "user_id long, plan string, revenue double, payment_date string")
    got = [(str(r.month), r.revenue) for r in kpis.monthly_revenue(clean.clean_payments(pay)).collect()]
    assert got == [("2024-01-01", 7.0), ("2024-02-01", 2.0), ("2024-03-01", 0.0)]


def test_nan_durations_count_as_null(spark):
    rows = [(1, 1, 1e-9), (2, 1, float("nan")), (3, 1, 3e-9), (4, 2, float("nan"))]
    s = spark.createDataFrame(rows, "session_id long, user_id long, duration double").withColumn("session_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = {r.user_id: r.avg_session_duration for r in user_metrics.session_metrics(s).collect()}
    assert got == {1: pytest.approx(2e-9), 2: None}


def test_retention_of_a_hot_user(spark):
    users = spark.createDataFrame([(1, "2024-01-03"), (2, "2024-01-04"), (3, "2024-01-04"), (4, "2024-01-10")], "user_id long, d string") \
        .select("user_id", F.col("d").cast("timestamp_ntz").alias("signup_date"))
    sessions = spark.range(4000).select(F.lit(1).cast("long").alias("user_id"), F.expr("timestamp_ntz'2024-01-29' + make_dt_interval(cast(id % 90 as int))").alias("session_time"))
    late = spark.createDataFrame([(2, "2024-02-05"), (4, None), (9, "2024-01-01"), (None, "2024-01-01")], "user_id long, d string") \
        .select("user_id", F.col("d").cast("timestamp_ntz").alias("session_time"))
    got = sqllib.sql_retention_4w(spark, users, sessions.unionByName(late))
    assert [(str(r.cohort_week), r.new_users, r.retained_4w) for r in got.collect()] == [("2024-01-01", 2, 1)]


def test_session_keeps_what_the_launcher_set():
    code = ("from usagelens.session import get_spark; s = get_spark(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=6 pyspark-shell"}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    env.pop("PYSPARK_GATEWAY_SECRET", None)
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 6 UTC" in out.stdout, out.stderr[-2000:]
