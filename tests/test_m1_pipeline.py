"""M1: the whole operator chain on a hand-computed micro-fixture."""
from datetime import date, datetime as dt

import pytest

from tests import m1
from usagelens.operators import cohorts, insights, kpis, segments, series
from usagelens.plans import sqllib


@pytest.fixture(scope="module")
def t(spark):
    return m1.tables(spark)


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_clean(t):
    users = {r["user_id"]: r["country"] for r in rows(t["users"])}
    assert users == {1: "India", 2: "Unknown", 3: "Canada", 4: "India"}
    s = {r["session_id"]: r for r in rows(t["sessions"])}
    assert sorted(s) == [10, 11, 12, 13, 15]          # dup dropped, null user dropped
    assert s[11]["duration"] == 25.0                    # median of 10, 20, 30, 40
    assert s[15]["session_time"] is None                # null time is kept
    e = {r["event_id"]: r["feature"] for r in rows(t["events"])}
    assert e == {1: "reports", 2: "reports", 3: "unknown"}
    assert sorted(r["plan"] for r in rows(t["payments"])) == [
        "enterprise", "free", "growth", "growth", "starter", "starter"]


def test_user_metrics(t):
    um = {r["user_id"]: r for r in rows(t["user_metrics"])}
    assert [um[u]["sessions_total"] for u in (1, 2, 3, 4)] == [3, 1, 1, 0]
    assert [um[u]["avg_session_duration"] for u in (1, 2, 3, 4)] == [21.67, 20.0, 40.0, 0.0]
    assert [um[u]["session_span_days"] for u in (1, 2, 3, 4)] == [7, 0, 0, 0]
    assert um[1]["first_session"] == dt(2024, 1, 1, 23) and um[1]["last_session"] == dt(2024, 1, 9, 12)
    assert um[3]["first_session"] is None and um[4]["last_session"] is None
    assert [um[u]["payments_total"] for u in (1, 2, 3, 4)] == [356.0, 0.0, 499.0, 0.0]
    assert [um[u]["plans"] for u in (1, 2, 3, 4)] == ["growth", "free", "enterprise", "free"]
    assert [um[u]["payment_count"] for u in (1, 2, 3, 4)] == [4, 1, 0, 0]
    assert um[1]["last_payment"] == dt(2024, 4, 15) and um[3]["last_payment"] == dt(1970, 1, 1)
    assert um[4]["last_payment"] is None
    assert [um[u]["days_since_last_payment"] for u in (1, 2, 3, 4)] == [61, 149, 19889, None]
    assert [um[u]["churn_flag"] for u in (1, 2, 3, 4)] == [True, True, False, False]
    assert [um[u]["is_paid_user"] for u in (1, 2, 3, 4)] == [True, False, True, False]
    assert [um[u]["renewal_rate"] for u in (1, 2, 3, 4)] == [0.5, 1.0, 0.0, 0.0]


def test_records(t):
    m = t["user_metrics"]
    assert rows(kpis.conversion_rates(m)) == [dict(total_users=4, paid_users=2, conversion_rate=0.5,
                                                   active_conversion_rate=2.0)]
    assert rows(kpis.churn_summary(m)) == [dict(global_churn_rate=0.5, top_churn_countries="India,Unknown")]
    assert rows(kpis.ltv_summary(m)) == [dict(arpu=213.75, paid_arpu=427.5, estimated_ltv=427.5,
                                              renewal_rate_mean=0.375)]
    mr = sorted((r["month"], r["revenue"]) for r in rows(kpis.monthly_revenue(t["payments"])))
    assert mr == [(date(2024, 1, 1), 129.0), (date(2024, 2, 1), 129.0), (date(2024, 3, 1), 49.0),
                  (date(2024, 4, 1), 49.0)]
    assert rows(kpis.revenue_summary(t["payments"])) == [dict(current_mrr=49.0, prev_mrr=49.0, mrr_growth=0.0)]


def test_segments(t):
    m = t["user_metrics"]
    got = [tuple(r.values()) for r in rows(segments.segment_by_country(m))]
    assert got == [("India", 2, 1.5, 178.0, 0.5), ("Canada", 1, 1.0, 499.0, 0.0), ("Unknown", 1, 1.0, 0.0, 1.0)]
    got = [tuple(r.values()) for r in rows(segments.segment_by_plan(m))]
    assert got == [("free", 2, 0.0, 0.5, 0.5), ("enterprise", 1, 499.0, 1.0, 0.0), ("growth", 1, 356.0, 3.0, 1.0)]


def test_cohorts(t):
    long = cohorts.cohort_retention_long(t["sessions"], 2)
    got = sorted((r["cohort_week"], r["week_offset"], r["retention"]) for r in rows(long))
    assert got == [(date(2024, 1, 1), 0, 1.0), (date(2024, 1, 1), 1, 1.0), (date(2024, 1, 8), 0, 1.0)]
    wide = {r["cohort_week"]: (r["w0"], r["w1"]) for r in rows(cohorts.cohort_retention_wide(t["sessions"], 2))}
    assert wide == {date(2024, 1, 1): (1.0, 1.0), date(2024, 1, 8): (1.0, 0.0)}
    latest = sorted((r["week_offset"], r["retention"]) for r in rows(cohorts.latest_cohort(long, 2)))
    assert latest == [(0, 1.0), (1, 0.0)]


def test_series(t):
    a = rows(series.detect_dau_anomalies(t["sessions"]))
    assert len(a) == 4 and all(r["dau"] == 1 and r["z_score"] == 0.0 and not r["is_anomaly"] for r in a)
    assert series.forecast_dau(t["sessions"]).count() == 0   # 4 days < 7


def test_insights(t):
    got = [r["text"] for r in insights.generate_insights(t["user_metrics"], t["events"]).orderBy("rule_id").collect()]
    assert got == ["Users from India show the highest churn within the cohort.",
                   "Feature reports drives the most interactions and keeps users engaged.",
                   "Users on free have the strongest renewal rate (0.50)."]


def test_sql_library(spark, t):
    q1 = [(r["activity_date"], r["dau"]) for r in sqllib.sql_dau(spark, t["sessions"]).collect()]
    assert q1 == [(date(2024, 1, 1), 1), (date(2024, 1, 3), 1), (date(2024, 1, 9), 1), (date(2024, 1, 10), 1)]
    q2 = [(r["activity_month"], r["mau"]) for r in sqllib.sql_mau(spark, t["sessions"]).collect()]
    assert q2 == [(date(2024, 1, 1), 2), (None, 1)]           # null month kept, last
    q3 = [tuple(r) for r in sqllib.sql_retention_4w(spark, t["users"], t["sessions"]).collect()]
    assert q3 == [(date(2024, 1, 1), 2, 2)]
    q4 = sqllib.sql_funnel(spark, t["users"], t["sessions"], t["payments"], t["user_metrics"], m1.AS_OF)
    assert tuple(q4.first()) == (4, 0, 2, 2)
