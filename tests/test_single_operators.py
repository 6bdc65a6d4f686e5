"""M2-M7: single operators with hand-computed answers, plus brute-force checks."""
import random
from datetime import date, timedelta

import pytest

from tests import m1
from usagelens.operators import kpis, ml, report, series


def test_m2_zscore(spark):
    days = [(date(2024, 1, 1) + timedelta(days=i), 10) for i in range(9)] + [(date(2024, 1, 10), 20)]
    daily = spark.createDataFrame(days, "date date, dau long")
    for thr in (2.5, 3.0):
        out = {r["date"]: r for r in series.zscore_anomalies(daily, "dau", thr).collect()}
        last = out[date(2024, 1, 10)]
        assert last["z_score"] == pytest.approx(3.0) and last["is_anomaly"]
        assert not any(r["is_anomaly"] for d, r in out.items() if d != date(2024, 1, 10))
    assert series.zscore_anomalies(daily, "dau", 3.0001).where("is_anomaly").count() == 0


def _ses_direct(y, alpha, l0):
    level, sse = l0, 0.0
    for v in y:
        sse += (v - level) ** 2
        level = alpha * v + (1 - alpha) * level
    return level, sse


def test_m3_smoothing_fold(spark):
    # y = 10, 20 with alpha 0.5 and l0 = 10 -> level 15
    assert _ses_direct([10, 20], 0.5, 10) == (15.0, 100.0)
    # the fold's closed form matches the direct recurrence at its optimum
    rng = random.Random(3)
    y = [rng.randint(50, 150) for _ in range(30)]
    daily = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i), v) for i, v in enumerate(y)],
                                  "date date, dau long")
    out = series.ses_forecast(daily, periods=3, grid=20, refine=0).where("forecast IS NOT NULL").collect()
    assert len(out) == 3 and len({r["forecast"] for r in out}) == 1
    best = None
    for k in range(1, 21):
        a = k / 20
        # brute force over l0 by golden-section search of the (convex) SSE
        lo, hi = -500.0, 500.0
        for _ in range(200):
            m1_, m2_ = lo + (hi - lo) / 3, hi - (hi - lo) / 3
            if _ses_direct(y, a, m1_)[1] < _ses_direct(y, a, m2_)[1]:
                hi = m2_
            else:
                lo = m1_
        level, sse = _ses_direct(y, a, (lo + hi) / 2)
        if best is None or sse < best[0]:
            best = (sse, level)
    assert out[0]["forecast"] == pytest.approx(best[1], rel=1e-6)
    # refinement searches a finer grid around the best alpha: SSE never worse
    refined = series.ses_forecast(daily, periods=1, grid=20, refine=10).where("forecast IS NOT NULL").first()
    level = refined["forecast"]
    sse_at = {}
    for k in range(0, 201):
        a = k / 200
        if a <= 0:
            continue
        lo, hi = -500.0, 500.0
        for _ in range(200):
            m1_, m2_ = lo + (hi - lo) / 3, hi - (hi - lo) / 3
            if _ses_direct(y, a, m1_)[1] < _ses_direct(y, a, m2_)[1]:
                hi = m2_
            else:
                lo = m1_
        sse_at[a] = _ses_direct(y, a, (lo + hi) / 2)
    a_ref, (lvl_ref, sse_ref) = min(sse_at.items(), key=lambda kv: kv[1][1])
    assert sse_ref <= best[0] + 1e-6 and level == pytest.approx(lvl_ref, rel=1e-6)
    hist = series.ses_forecast(daily, periods=3, grid=20).where("forecast IS NULL").count()
    assert hist == 30


def test_m4_auc(spark):
    df = spark.createDataFrame([(1, .9), (0, .5), (1, .5), (0, .1)], "churn_flag int, p double")
    assert ml.roc_auc(df, score_col="p").first()["auc"] == pytest.approx(0.875)


def test_auc_brute_force(spark):
    rng = random.Random(7)
    data = [(rng.randint(0, 1), rng.choice([round(rng.random(), 2), 0.5])) for _ in range(600)]
    df = spark.createDataFrame(data, "churn_flag int, p double")
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for b in (1, 4, 64):  # layouts
        assert ml.roc_auc(df.repartition(b), score_col="p").first()["auc"] == pytest.approx(brute, abs=1e-12)


def test_m5_classification_report(spark):
    df = spark.createDataFrame([(1, .9), (0, .5), (1, .5), (0, .1)], "churn_flag int, p double")
    r = {x["class"]: x for x in ml.classification_report(df, score_col="p").collect()}
    assert r["1"]["precision"] == pytest.approx(2 / 3) and r["1"]["recall"] == 1.0
    assert r["1"]["f1_score"] == pytest.approx(0.8)
    assert r["0"]["precision"] == 1.0 and r["0"]["recall"] == 0.5
    assert r["0"]["f1_score"] == pytest.approx(2 / 3)
    assert r["accuracy"]["f1_score"] == 0.75 and r["accuracy"]["support"] == 4
    assert r["1"]["support"] == 2 and r["0"]["support"] == 2


def test_m6_scenario(spark):
    mrr = spark.createDataFrame([(1000.0,)], "current_mrr double")
    g = report.scenario_grid(mrr, [10], [5]).first()
    assert g["projected_mrr"] == pytest.approx(1127.5) and g["mrr_delta"] == pytest.approx(127.5)
    assert report.scenario_grid(mrr).count() == 121


def test_m7_empties(spark):
    t = m1.tables(spark, empty=True)
    m = t["user_metrics"]
    assert kpis.ltv_summary(m).first().asDict() == dict(arpu=0.0, paid_arpu=0.0, estimated_ltv=0.0,
                                                        renewal_rate_mean=0.0)
    assert kpis.revenue_summary(t["payments"]).first().asDict() == dict(current_mrr=0.0, prev_mrr=0.0,
                                                                         mrr_growth=0.0)
    assert kpis.conversion_rates(m).first().asDict() == dict(total_users=0, paid_users=0, conversion_rate=0.0,
                                                             active_conversion_rate=0.0)
    c = kpis.churn_summary(m).first()
    assert c["global_churn_rate"] is None and c["top_churn_countries"] == ""
    assert series.detect_dau_anomalies(t["sessions"]).count() == 0
    assert series.forecast_dau(t["sessions"]).count() == 0
    from usagelens.operators import cohorts, insights
    assert cohorts.cohort_retention_long(t["sessions"]).count() == 0
    assert cohorts.latest_cohort(cohorts.cohort_retention_long(t["sessions"])).count() == 0
    assert insights.generate_insights(m, t["events"]).count() == 0


def test_keep_first_order(spark):
    from usagelens.functions import keep_first
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d")], "k int, o int, v string")
    got = {r["k"]: r["v"] for r in keep_first(df, "k", ["o"]).collect()}
    assert got == {1: "c", 2: "d"}   # nulls last; a group of nulls keeps a row


def test_report_filters(spark):
    t = m1.tables(spark)
    sel = report.filter_metrics(t["user_metrics"], ["India"], [])
    assert sorted(r["user_id"] for r in sel.collect()) == [1, 4]
    sel_df = report.filter_metrics(t["user_metrics"], spark.createDataFrame([("Canada",)], "c string"))
    assert [r["user_id"] for r in sel_df.collect()] == [3]
    win = report.window_sessions(t["sessions"], sel, "2024-01-02 00:00:00", "2024-01-09 12:00:00")
    assert sorted(r["session_id"] for r in win.collect()) == [11, 12]   # both ends inclusive
    f = {r["stage"]: r["users"] for r in report.funnel(sel, win).collect()}
    assert f == {"Signups": 2, "Active (30d)": 1, "Paid": 1, "Churned": 1}
    b = report.time_bounds(t["sessions"], m1.AS_OF).first()
    assert b["min_session_time"].day == 1 and b["max_session_time"].day == 10
    assert [r["value"] for r in report.filter_values(t["user_metrics"]).where("dimension='plan'").collect()] \
        == ["enterprise", "free", "growth"]
    assert report.anomaly_table(t["sessions"], tail=2).count() == 2


def test_segment_dau_and_forecast_by(spark):
    t = m1.tables(spark)
    by = series.detect_dau_anomalies_by(t["sessions"], t["users"], ["country"])
    got = sorted((r["country"], r["date"], r["dau"]) for r in by.collect())
    assert got[0] == ("India", date(2024, 1, 1), 1) and len(got) == 4
    assert series.forecast_dau_by(t["sessions"], t["users"], ["country"]).count() == 0


def test_approx_distinct_close_to_exact(spark):
    from usagelens.operators.activity import daily_active_users, monthly_active_users
    t = m1.tables(spark)
    exact = sorted(tuple(r) for r in daily_active_users(t["sessions"]).collect())
    approx = sorted(tuple(r) for r in daily_active_users(t["sessions"], approx_rsd=0.01).collect())
    assert exact == approx   # tiny sets are counted exactly by HLL++
    assert monthly_active_users(t["sessions"], 0.01).count() == 2


def test_report_bundle(spark):
    t = m1.tables(spark)
    r = report.report(t, countries=["India", "Unknown"], plans=[], start="2024-01-01 00:00:00",
                      end="2024-01-31 00:00:00", now=m1.AS_OF, lookback_weeks=2)
    assert set(r) >= {"kpi", "funnel", "cohorts", "dau", "segments", "insights", "mrr", "scenarios",
                      "anomalies", "forecast", "filter_values", "time_bounds", "monthly_revenue"}
    kpi = r["kpi"].first()
    assert (kpi["total_users"], kpi["paid_users"], kpi["global_churn_rate"]) == (3, 1, 0.6667)
    assert r["scenarios"].count() == 121 and r["forecast"].count() == 0
    assert {x["stage"]: x["users"] for x in r["funnel"].collect()}["Active (30d)"] == 2


def test_insight_formatting_rounds_half_to_even(spark):
    from usagelens.operators import insights
    m = spark.createDataFrame([(1, "A", "growth", 0.125, False)],
                              "user_id long, country string, plans string, renewal_rate double, churn_flag boolean")
    e = spark.createDataFrame([], "event_id long, feature string")
    text = insights.generate_insights(m, e).collect()[0]["text"]
    assert text.endswith(f"({0.125:.2f}).") and "(0.12)" in text


def test_revenue_summary_edges(spark):
    from datetime import datetime as dt
    from usagelens.sources import schemas as S
    one = spark.createDataFrame([(1, "growth", 129.0, dt(2024, 3, 5)), (2, "starter", 49.0, dt(2024, 3, 9))],
                                S.PAYMENTS)
    assert kpis.revenue_summary(one).first().asDict() == dict(current_mrr=178.0, prev_mrr=178.0, mrr_growth=0.0)
    zero_prev = spark.createDataFrame([(1, "free", 0.0, dt(2024, 2, 5)), (1, "growth", 129.0, dt(2024, 3, 5))],
                                      S.PAYMENTS)
    assert kpis.revenue_summary(zero_prev).first().asDict() == dict(current_mrr=129.0, prev_mrr=0.0,
                                                                     mrr_growth=0.0)
    gap = spark.createDataFrame([(1, "growth", 100.0, dt(2024, 1, 5)), (1, "growth", 150.0, dt(2024, 4, 5))],
                                S.PAYMENTS)
    # previous OBSERVED month (January), not the empty March
    assert kpis.revenue_summary(gap).first().asDict() == dict(current_mrr=150.0, prev_mrr=100.0, mrr_growth=0.5)


def test_keep_first_matches_brute_force(spark):
    from usagelens.functions import keep_first
    rng = random.Random(11)
    rows = [(rng.randint(1, 40), rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "c"]),
             rng.choice([None, 0.5, 1.5])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, o int, p string, q double")
    got = {tuple(r) for r in keep_first(df, "k", ["o"]).collect()}

    def key(r):  # order column nulls last, then the remaining columns, nulls last
        return tuple((v is None, v if v is not None else 0) for v in (r[1], r[2], r[3]))
    want = {}
    for r in rows:
        if r[0] not in want or key(r) < key(want[r[0]]):
            want[r[0]] = r
    assert got == set(want.values())


def test_segment_dau_drops_rows_with_any_null_key(spark):
    from datetime import datetime as dt
    sessions = spark.createDataFrame([(1, 1, dt(2024, 1, 1), 1.0), (2, 2, dt(2024, 1, 1), 1.0)],
                                     "session_id long, user_id long, session_time timestamp_ntz, duration double")
    users = spark.createDataFrame([(1, "X", "growth"), (2, "X", None)], "user_id long, country string, plans string")
    got = series.segment_daily_active_users(sessions, users, ["country", "plans"]).collect()
    assert [(r["country"], r["plans"], r["dau"]) for r in got] == [("X", "growth", 1)]
