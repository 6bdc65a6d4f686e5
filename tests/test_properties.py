"""Invariants on the fixture tables (sf0.001)."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from usagelens.operators import clean, cohorts, segments
from usagelens.plans.catalog import tables
from usagelens.sources import fixtures as fx


@pytest.fixture(scope="module")
def t(spark):
    return {k: v.persist() for k, v in tables(spark, SF_SMALL).items()}


def test_fixture_counts(spark, t):
    raw = fx.raw_tables(spark, SF_SMALL)
    assert [raw[k].count() for k in ("users", "sessions", "events", "payments")] == [152, 832, 1005, 1484]
    assert [t[k].count() for k in ("users", "sessions", "payments")] == [150, 826, 1484]
    m = t["user_metrics"]
    assert m.where("last_payment IS NULL").count() == 2
    assert m.agg(F.avg(F.col("churn_flag").cast("int"))).first()[0] == pytest.approx(0.7133, abs=1e-4)


def test_retention_at_zero_is_one(t):
    long = cohorts.cohort_retention_long(t["sessions"])
    assert {r[0] for r in long.where("week_offset = 0").select("retention").collect()} == {1.0}
    assert long.where("retention > 1 OR retention < 0").count() == 0


def test_segments_cover_users(t):
    m = t["user_metrics"]
    assert segments.segment_by_country(m).agg(F.sum("total_users")).first()[0] == m.count()
    assert segments.segment_by_plan(m).agg(F.sum("total_users")).first()[0] == m.count()


def test_churned_have_payments(t):
    m = t["user_metrics"]
    assert m.where("churn_flag AND payment_count = 0").count() == 0


def test_clean_is_idempotent(t):
    u = t["users"]
    assert sorted(clean.clean_users(u).collect()) == sorted(u.collect())
    e = t["events"]
    assert sorted(clean.clean_events(e).collect()) == sorted(e.collect())


def test_input_order_does_not_matter(spark, t):
    raw = fx.raw_tables(spark, SF_SMALL)
    shuffled = {k: v.orderBy(F.rand(11)).repartition(5) for k, v in raw.items()}
    from usagelens.plans.pipeline import process
    from usagelens.functions import round_doubles
    # float sums depend on addition order, so compare at 6 dp
    a = round_doubles(process(raw, fx.AS_OF)["user_metrics"], 6)
    b = round_doubles(process(shuffled, fx.AS_OF)["user_metrics"], 6)
    assert sorted(a.collect()) == sorted(b.collect())


def test_round_exact_is_pythons_round(spark):
    import random

    from usagelens.functions import round_exact
    rng = random.Random(5)
    values = [p / n for n in (1, 3, 7, 8, 800, 16000, 20000, 80000) for p in (0, 1, 3, 5, 7, 2469, 4937, 12345, 19999)]
    values += [(2 * k + 1) / 20000 for k in range(2000)] + [rng.random() * 10 ** rng.randrange(6) for _ in range(2000)]
    values += [-v for v in values[:500]] + [0.125, 2.5, 44.225, 1e8 + 0.00005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 4):
        for v, r in df.select("v", round_exact("v", digits)).collect():
            assert r == round(v, digits), v
    assert spark.range(1).select(round_exact(F.lit(None).cast("double"), 2)).first()[0] is None
