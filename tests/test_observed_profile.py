"""Data quality gathered while the clean tables are written."""
import pytest

from tests.conftest import SF_SMALL
from usagelens.operators import clean as C
from usagelens.operators.quality import ObservedProfile, dq_profile
from usagelens.plans import pipeline
from usagelens.sources import fixtures, io


def key(rows):
    return sorted(((t, m, c or "", v if v is None else round(v, 12)) for t, m, c, v in rows), key=repr)


def test_same_figures_as_a_pass_of_its_own(spark, scratch):
    raw = fixtures.raw_tables(spark, SF_SMALL)
    profile = ObservedProfile()
    clean = pipeline.process(raw, fixtures.AS_OF, profile=profile)
    paths = io.write_all({k: clean[k] for k in ("users", "sessions", "events", "payments")}, scratch)
    want = [tuple(r) for r in dq_profile(raw).select("table", "metric", "column", "value").collect()]
    assert key(profile.rows()) == key(want)
    assert key(tuple(r) for r in profile.frame(spark).collect()) == key(want)
    # and the tables are what they are without it
    plain = pipeline.process(raw, fixtures.AS_OF)
    for name in ("users", "sessions", "events"):
        assert spark.read.parquet(paths[name]).exceptAll(plain[name]).isEmpty()


@pytest.mark.parametrize("rows", [[], [(None, None, "A")], [(1, 2, None), (1, 2, None), (None, 3, "X"), (None, 3, "X"), (4, None, "x")]])
def test_null_keys_and_empty_tables(spark, scratch, rows):
    df = spark.createDataFrame([(s, u, f, None) for s, u, f in rows], "event_id long, user_id long, feature string, event_time timestamp_ntz")
    profile = ObservedProfile()
    out = C.clean_events(profile.raw("events", df), seen=lambda d: profile.unique("events", d))
    out.write.parquet(f"{scratch}/e")
    assert key(profile.rows()) == key(tuple(r) for r in dq_profile({"events": df}).select("table", "metric", "column", "value").collect())
