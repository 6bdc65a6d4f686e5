"""Map the driver's test tables onto the four raw SaaS tables.

The test tables (TPC-H-ish ``customer``/``nation``/``orders`` plus an
``events`` stream) carry no users, sessions or payments, so these views
derive them, defects included, by deterministic arithmetic that an
independent SQL engine can repeat (see ``plans/oracle.py``):

* raw_users     customer x nation; duplicate rows and null countries
* raw_sessions  events of known users after their signup; null user, null
                time, null duration, exact duplicate rows
* raw_events    every event; null user, null feature, exact duplicates
* raw_payments  orders of most customers; plan from the order priority,
                some spellings upper-cased, dates shifted into 1997..2024

Everything is lazy and reads only the columns it needs (pruned at the scan).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import clean as C

# ---- fixed values of the mapping --------------------------------------
AS_OF = "2024-01-31 00:00:00"          # the "now" every fixture query uses
SIGNUP_BASE = "2023-11-01 00:00:00"    # signup = base + (custkey*37) % 90 days
PAYMENT_SHIFT_DAYS = 8218              # order date + 8218 days = payment date
# feature by props.k % 6, in this order
FEATURES = ["billing", "reports", "dashboards", "collaboration", "alerts", "integrations"]
# plan by order priority
PLAN_BY_PRIORITY = {
    "5-LOW": "free",
    "4-NOT SPECIFIED": "starter",
    "3-MEDIUM": "growth",
    "2-HIGH": "growth",
    "1-URGENT": "enterprise",
}
# ------------------------------------------------------------------------


# Declared schemas of the source tables this mapping reads. Passing them to
# the reader skips schema inference (a footer-reading job per scan) and
# fails fast if a file does not carry the expected types.
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_if(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def _with_copies(df: DataFrame, copy_when) -> DataFrame:
    """Rows where ``copy_when`` holds appear twice (UNION ALL of the copies),
    produced by a generator in the same scan instead of a second branch."""
    n = F.when(copy_when, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(n).alias("_copy"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    signup = (F.lit(SIGNUP_BASE).cast("timestamp_ntz")
              + F.make_dt_interval(days=((F.col("c_custkey") * 37) % 90).cast("int")))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_custkey").cast("long").alias("user_id"), signup.alias("signup_date"),
                    F.col("n_name")))


def raw_users(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None) -> DataFrame:
    """One row per customer; customers with key % 100 = 3 get a second row
    with a null country."""
    customers = customers if customers is not None else _customers(spark, sf_dir)
    u = _with_copies(customers, F.col("user_id") % 100 == 3)
    country = F.when((F.col("_copy") == 1) | (F.col("user_id") % 50 == 1), F.lit(None).cast("string")) \
        .otherwise(F.col("n_name"))
    return u.select("user_id", "signup_date", country.alias("country"))


def raw_sessions(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None) -> DataFrame:
    """Events of known users at or after signup (the distinct (user, signup)
    pairs of raw_users are exactly the customer rows, so no distinct is
    needed); session_id = event_id."""
    customers = customers if customers is not None else _customers(spark, sf_dir)
    known = customers.select("user_id", "signup_date")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    j = e.join(known, (e.user_id == known.user_id) & (e.ts >= known.signup_date))
    base = j.select(
        F.col("event_id").alias("session_id"),
        _null_if(F.col("event_id") % 500 == 9, e.user_id).alias("user_id"),
        _null_if(F.col("event_id") % 100 == 7, F.col("ts")).alias("session_time"),
        _null_if(F.col("event_id") % 20 == 3, F.col("value")).alias("duration"),
    )
    return _with_copies(base, F.col("session_id") % 200 == 11).drop("_copy")


def _feature_of(k):
    expr = F.lit(None).cast("string")
    for i in reversed(range(len(FEATURES))):
        expr = F.when(k % 6 == i, F.lit(FEATURES[i])).otherwise(expr)
    return expr


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    base = e.select(
        "event_id",
        _null_if(F.col("event_id") % 500 == 9, F.col("user_id")).alias("user_id"),
        F.col("event_id").alias("session_id"),
        "event_type",
        _null_if(F.col("event_id") % 100 == 5, _feature_of(k)).alias("feature"),
        F.col("ts").alias("event_time"),
    )
    return _with_copies(base, F.col("event_id") % 200 == 11).drop("_copy")


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    plan = F.lit(None).cast("string")
    for prio, name in PLAN_BY_PRIORITY.items():
        plan = F.when(F.col("o_orderpriority") == prio, F.lit(name)).otherwise(plan)
    return (o.where(F.col("o_custkey") % 97 != 5)
            .withColumn("_plan", plan)
            .select(
                F.col("o_custkey").alias("user_id"),
                F.when(F.col("o_orderkey") % 100 == 4, F.upper("_plan")).otherwise(F.col("_plan"))
                 .alias("plan"),
                F.when(F.col("_plan") == "free", F.lit(0.0)).otherwise(F.col("o_totalprice"))
                 .alias("revenue"),
                (F.col("o_orderdate").cast("timestamp_ntz")
                 + F.expr(f"INTERVAL {PAYMENT_SHIFT_DAYS} DAYS")).alias("payment_date"),
            ))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers = _customers(spark, sf_dir)
    return {
        "users": raw_users(spark, sf_dir, customers),
        "sessions": raw_sessions(spark, sf_dir, customers),
        "events": raw_events(spark, sf_dir),
        "payments": raw_payments(spark, sf_dir),
    }


def clean_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = raw_tables(spark, sf_dir)
    return {
        "users": C.clean_users(raw["users"]),
        "sessions": C.clean_sessions(raw["sessions"]),
        "events": C.clean_events(raw["events"]),
        "payments": C.clean_payments(raw["payments"]),
    }
