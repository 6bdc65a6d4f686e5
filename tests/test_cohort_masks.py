"""Weekly activity as bit masks: against plain sets, long spans, and the plan."""
import datetime
import random

import pytest

from usagelens.operators import cohorts


def plain(rows, lookback):
    """{(cohort week, offset): users} of (user, time) rows, by sets."""
    weeks = {}
    for user, t in rows:
        if user is not None and t is not None:
            day = t.date()
            weeks.setdefault(user, set()).add(day - datetime.timedelta(days=day.weekday()))
    out = {}
    for seen in weeks.values():
        first = min(seen)
        for w in seen:
            k = (w - first).days // 7
            if k < lookback:
                out[first, k] = out.get((first, k), 0) + 1
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_id long, session_time timestamp_ntz")


@pytest.mark.parametrize("start, span, lookback", [("2024-01-01", 60, 12), ("2015-06-03", 4000, 12), ("1969-03-01", 900, 5),
                                                   ("2010-01-01", 3000, 150)])
def test_masks_match_plain_sets(spark, start, span, lookback):
    rng = random.Random(span)
    t0 = datetime.datetime.fromisoformat(start)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *[t0 + datetime.timedelta(minutes=rng.randrange(span * 1440))] * 20]))
            for _ in range(1500)]
    got = {(r.cohort_week, r.week_offset): (r.active_users, r.retention)
           for r in cohorts.cohort_retention_long(frame(spark, rows).repartition(5), lookback).collect()}
    want = plain(rows, lookback)
    assert {k: v[0] for k, v in got.items()} == want
    assert all(abs(r - want[c, k] / want[c, 0]) < 1e-12 for (c, k), (_, r) in got.items())


def test_neighbouring_words_and_edges(spark):
    origin = datetime.datetime(1970, 1, 5)
    at = [origin + datetime.timedelta(weeks=w) for w in (62, 63, 125, 126, -1, -63, -64)]
    rows = [(1, at[0]), (1, at[1]), (2, at[2]), (2, at[3]), (3, at[6]), (3, at[5]), (4, at[4]), (4, origin)]
    got = {(r.cohort_week, r.week_offset): r.active_users for r in cohorts.cohort_retention_long(frame(spark, rows), 70).collect()}
    assert got == plain(rows, 70)
    assert all((c, 1) in got for c, _ in got)
    words = {r.word for r in cohorts.activity_masks(frame(spark, rows)).collect()}
    assert words == {-2, -1, 0, 1, 2}


def test_hash_aggregates_only(spark):
    df = cohorts.cohort_retention_long(frame(spark, [(1, datetime.datetime(2024, 1, 1))]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_empty_and_no_lookback(spark):
    assert cohorts.cohort_retention_long(frame(spark, [])).count() == 0
    assert cohorts.cohort_retention_long(frame(spark, [(1, datetime.datetime(2024, 1, 1))]), 0).count() == 0
