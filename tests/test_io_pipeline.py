"""Sources and sinks, and the whole pipeline on sf0.001."""
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests import m1
from tests.conftest import SF_SMALL
from usagelens.plans import pipeline
from usagelens.sources import fixtures as fx
from usagelens.sources import io, schemas as S


def test_csv_and_parquet_roundtrip(spark, scratch):
    t = m1.tables(spark)
    for fmt in ("parquet", "csv"):
        io.write_table(t["sessions"], scratch, f"sessions_{fmt}", fmt)
        back = io.read_table(spark, scratch, f"sessions_{fmt}", fmt, S.SESSIONS)
        assert dict(back.dtypes)["session_time"] == "timestamp_ntz"
        assert sorted(back.collect()) == sorted(S.conform(t["sessions"], S.SESSIONS).collect())


def test_optional_source(spark, scratch):
    df = io.read_optional(spark, scratch, "missing", S.PAYMENTS)
    assert df.count() == 0 and df.schema == S.PAYMENTS


def test_insights_text_fallback(spark, scratch):
    empty = spark.createDataFrame([], "rule_id int, text string")
    io.write_insights_text(empty, f"{scratch}/ins")
    txt = "".join(open(p).read() for p in glob.glob(f"{scratch}/ins/part-*"))
    assert txt.strip() == io.FALLBACK_INSIGHT


def test_failing_database_is_logged_and_passed_over(spark, caplog):
    df = spark.range(2)
    failed = io.write_jdbc({"a": df, "b": df}, "jdbc:nosuchdriver:nowhere", {})
    assert failed == ["a", "b"] and "table a was not loaded" in caplog.text


def test_catalog_tables(spark):
    t = m1.tables(spark)
    names = io.save_as_tables({"um_test": t["user_metrics"]})
    assert spark.table(names[0]).count() == 4
    spark.sql(f"DROP TABLE IF EXISTS {names[0]}")


def test_pipeline_run(spark, scratch):
    out = pipeline.run(spark, fx.raw_tables(spark, SF_SMALL), scratch, fx.AS_OF)
    for key in ("users", "user_metrics", "cohort_retention", "dau_anomalies", "dau_forecast",
                "churn_scored", "churn_auc", "churn_report", "churn_feature_importance", "analytics_summary",
                "insights"):
        assert os.path.exists(out[key]), key
    doc = json.loads(open(glob.glob(f"{out['analytics_summary']}/part-*")[0]).read())
    assert doc["conversion"]["total_users"] == 150
    assert doc["churn_backend"] == "logreg" and len(doc["feature_importance"]) == 6
    assert len(doc["dau_forecast"]) == 14 and len(doc["insights"]) == 3
    lines = open(glob.glob(f"{out['insights']}/part-*")[0]).read().splitlines()
    assert len(lines) == 3 and all(x.startswith("- ") for x in lines)
    # the staged run gives the same tables as the lazy composition
    from usagelens.functions import round_doubles
    lazy = pipeline.process(fx.raw_tables(spark, SF_SMALL), fx.AS_OF)
    for name in ("sessions", "user_metrics"):
        a = round_doubles(spark.read.parquet(out[name]), 6).collect()
        b = round_doubles(lazy[name], 6).collect()
        assert sorted(a) == sorted(b), name
    imp = io.read_importance(spark, out["churn_feature_importance"])
    assert imp.count() == 6 and imp.where(F.col("permutation_importance").isNull()).count() == 0


def test_bad_csv_rows_go_aside(spark, scratch):
    os.makedirs(f"{scratch}/payments")
    with open(f"{scratch}/payments/a.csv", "w") as f:
        f.write("user_id,plan,revenue,payment_date\n1,growth,5.0,2024-01-02 03:04:05\nx7,growth,5.0,2024-01-02 03:04:05\n"
                "2,free,five,\n3,,,\n")
    good, bad = io.split_csv(spark, scratch, "payments")
    assert good.schema == S.PAYMENTS and sorted(r.user_id for r in good.collect()) == [1, 3]
    assert sorted(r.line.split(",")[0] for r in bad.collect()) == ["2", "x7"] and {r.table for r in bad.collect()} == {"payments"}


def test_importance_must_be_numbers(spark, scratch):
    os.makedirs(f"{scratch}/imp")
    with open(f"{scratch}/imp/a.csv", "w") as f:
        f.write(",model_importance,permutation_importance\nsessions_total,0.5,\n")
    assert [tuple(r) for r in io.read_importance(spark, f"{scratch}/imp").collect()] == [("sessions_total", 0.5, 0.0)]
    with open(f"{scratch}/imp/a.csv", "a") as f:
        f.write("renewal_rate,much,0.1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        io.read_importance(spark, f"{scratch}/imp").collect()


def test_run_that_fails_between_tables_leaves_the_last_one(spark, scratch, monkeypatch):
    raw = fx.raw_tables(spark, SF_SMALL)
    assert io.published(spark, scratch) == {}
    first = pipeline.run(spark, raw, scratch, fx.AS_OF, fmt="csv")
    assert io.published(spark, scratch) == first
    assert glob.glob(f"{first['dau']}/*.csv") and glob.glob(f"{first['churn_scored_csv']}/*.csv")
    real = io.write_table

    def fails(df, root, name, *args, **kw):
        if name == "churn_auc":
            raise RuntimeError("lost")
        return real(df, root, name, *args, **kw)

    monkeypatch.setattr(io, "write_table", fails)
    with pytest.raises(RuntimeError):
        pipeline.run(spark, raw, scratch, fx.AS_OF)
    assert io.published(spark, scratch) == first
    assert spark.read.parquet(first["churn_scored"]).count() == 150  # the old run is still whole


def test_bitmaps_of_any_user_id_merge_exactly(spark):
    from usagelens.operators import rollup
    rng = random.Random(6)
    ids = [0, 1, -1, 32_767, 32_768, 32_769, 10 ** 12, -10 ** 12, None]
    rows = [(rng.choice(ids), f"2024-0{rng.randrange(1, 4)}-0{rng.randrange(1, 6)} 01:00:00" if rng.random() < 0.9 else None) for _ in range(400)]
    sessions = spark.createDataFrame(rows, "user_id long, t string").select("user_id", F.col("t").cast("timestamp_ntz").alias("session_time")).repartition(5)
    days, months = {}, {}
    for u, t in rows:
        if u is not None:
            days.setdefault(t and t[:10], set()).add(u)
            months.setdefault(t and t[:7] + "-01", set()).add(u)
    rolled = rollup.day_bitmaps(sessions)
    assert {str(r.date): r.dau for r in rollup.daily_from(rolled).collect()} == {k: len(v) for k, v in days.items() if k}
    assert {str(r.activity_month): r.mau for r in rollup.monthly_from(rolled).collect()} == {str(k): len(v) for k, v in months.items()}
