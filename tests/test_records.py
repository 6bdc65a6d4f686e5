"""The records of one fold against the single ones."""
import random

import pytest

from usagelens.functions import attach
from usagelens.operators import kpis, segments
from usagelens.plans import pipeline

SCHEMA = ("user_id long, country string, sessions_total long, payments_total double, churn_flag boolean, "
          "is_paid_user boolean, renewal_rate double, plans string")


def metrics(spark, rows):
    rng = random.Random(rows)
    return spark.createDataFrame(
        [(i or None, rng.choice(["B", "A", "C", "D", None]), rng.randrange(12), rng.randrange(4000) / 8, rng.random() < 0.3,
          rng.random() < 0.5, rng.randrange(64) / 64, "free") for i in range(rows)], SCHEMA)


@pytest.mark.parametrize("rows", [0, 1, 7, 400])
def test_one_fold_equals_single_records(spark, rows):
    m = metrics(spark, rows)
    got = kpis.user_records(m)
    flat = got.select("conversion.*", "churn.*", "ltv.*").first().asDict()
    want = attach(attach(kpis.conversion_rates(m), kpis.churn_summary(m)), kpis.ltv_summary(m)).first().asDict()
    assert flat == want
    top = sorted((r.country, r.churn_rate) for r in segments.segment_by_country(m).limit(3).collect())
    assert [tuple(r) for r in got.first().top_countries] == top


def test_metrics_are_read_once(spark, scratch):
    metrics(spark, 50).write.parquet(f"{scratch}/m")
    m = spark.read.parquet(f"{scratch}/m")
    payments = spark.createDataFrame([], "payment_date timestamp_ntz, revenue double")
    plan = pipeline.summary_kpis({"user_metrics": m, "payments": payments})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
