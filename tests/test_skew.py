"""A user holding a third of all rows: results equal brute force, and the
per-user aggregates combine map-side (partial aggregates before the shuffle)."""
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from usagelens.operators import clean as C
from usagelens.operators.cohorts import cohort_retention_long
from usagelens.operators.user_metrics import user_metrics
from usagelens.sources import schemas as S

AS_OF = "2024-03-01 00:00:00"


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    users = [(u, datetime(2024, 1, 1), f"C{u % 4}") for u in range(1, 301)]
    sessions, payments = [], []
    for i in range(9000):
        u = 1 if i % 3 == 0 else rng.randint(2, 300)         # user 1: a third of all sessions
        t = datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 60 * 24 * 50))
        sessions.append((i, u, t, round(rng.uniform(1, 60), 2)))
    for i in range(6000):
        u = 1 if i % 3 == 0 else rng.randint(2, 300)
        plan = rng.choice(["starter", "growth", "growth", "enterprise"])
        payments.append((u, plan, {"starter": 49.0, "growth": 129.0, "enterprise": 499.0}[plan],
                         datetime(2023, 6, 1) + timedelta(days=rng.randint(0, 200))))
    raw = {
        "users": spark.createDataFrame(users, S.USERS).repartition(4),
        "sessions": spark.createDataFrame(sessions, S.SESSIONS).repartition(6),
        "payments": spark.createDataFrame(payments, S.PAYMENTS).repartition(6),
    }
    return raw, pd.DataFrame(sessions, columns=["session_id", "user_id", "t", "duration"]), \
        pd.DataFrame(payments, columns=["user_id", "plan", "revenue", "date"])


def test_metrics_equal_brute_force(skewed):
    raw, ps, pp = skewed
    um = user_metrics(C.clean_users(raw["users"]), C.clean_sessions(raw["sessions"]),
                      C.clean_payments(raw["payments"]), AS_OF)
    got = {r["user_id"]: r for r in um.collect()}
    assert len(got) == 300
    sm = ps.groupby("user_id").agg(n=("session_id", "count"), d=("duration", "mean"),
                                   first=("t", "min"), last=("t", "max"))
    pm = pp.groupby("user_id").agg(total=("revenue", "sum"), n=("date", "count"), last=("date", "max"))
    mode = pp.groupby("user_id")["plan"].agg(lambda s: sorted(s.mode())[0])
    for u in [1, 2, 57, 300]:
        r = got[u]
        assert r["sessions_total"] == sm.loc[u, "n"]
        assert r["avg_session_duration"] == pytest.approx(round(sm.loc[u, "d"], 2), abs=0.011)
        assert r["session_span_days"] == (sm.loc[u, "last"] - sm.loc[u, "first"]).days
        assert r["payments_total"] == pytest.approx(pm.loc[u, "total"])
        assert r["payment_count"] == pm.loc[u, "n"] and r["plans"] == mode.loc[u]
    assert got[1]["sessions_total"] == 3000


def test_partial_aggregation_before_shuffle(skewed):
    raw, _, _ = skewed
    from usagelens.operators.user_metrics import payment_metrics, session_metrics
    for df in (session_metrics(raw["sessions"]), payment_metrics(raw["payments"]),
               C.keep_first(raw["sessions"], "session_id", C.SESSIONS_ORDER)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # a map-side (partial) aggregate runs before the exchange on the key
        assert "partial_" in plan and "Exchange hashpartitioning" in plan


def test_cohorts_with_hot_user(skewed):
    raw, ps, _ = skewed
    long = {(r["cohort_week"], r["week_offset"]): r["active_users"]
            for r in cohort_retention_long(C.clean_sessions(raw["sessions"])).collect()}
    wk = ps.assign(w=ps["t"].dt.to_period("W").apply(lambda p: p.start_time.date()))
    first = wk.groupby("user_id")["w"].min()
    wk["c"] = wk["user_id"].map(first)
    wk["k"] = wk.apply(lambda r: (r["w"] - r["c"]).days // 7, axis=1)
    brute = wk[wk["k"] < 12].groupby(["c", "k"])["user_id"].nunique().to_dict()
    assert long == brute
