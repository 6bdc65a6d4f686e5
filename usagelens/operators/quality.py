"""RA1: data-quality profile of the raw tables, as a long frame.

For each table one aggregate pass yields: row count, duplicate key rows
(rows minus distinct keys), the null rate of every column and, for
payments, plan spellings that are not lower case. The batch run gathers the
same figures while it writes (:class:`ObservedProfile`).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = {"users": "user_id", "sessions": "session_id", "events": "event_id", "payments": None}


PROFILE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if c == "value" else T.StringType())
                               for c in ("table", "metric", "column", "value")])


def _counted(df: DataFrame) -> list:
    """The aggregates that need no distinct: rows, null rates, plans that are not lower case."""
    aggs = [F.count("*").cast("double").alias("rows")]
    aggs += [F.avg(F.col(c).isNull().cast("double")).alias(f"null::{c}") for c in df.columns]
    if "plan" in df.columns:
        aggs.append(F.sum((F.col("plan") != F.lower("plan")).cast("int")).cast("double")
                    .alias("noncanonical_plan"))
    return aggs


class ObservedProfile:
    """The profile gathered while the clean tables are written, without a read of its own.

    :meth:`raw` and :meth:`unique` wrap the frames that cleaning reads and
    makes (before and after its dedupe); once the tables are written
    :meth:`rows` has the figures of :func:`dq_profile`. Only the first action
    on a wrapped frame counts, so wrap, write, then ask. Distinct keys are the
    rows left by the dedupe whose key is not null. Held on the driver: one
    number per column. A task that runs before the dedupe's shuffle and has to
    run again because its executor was lost is counted again; where that matters,
    :func:`dq_profile` reads the tables anew and is exact.
    """

    def __init__(self, keys: dict[str, str | None] = KEYS):
        self.keys = keys
        self._raw: dict[str, Observation] = {}
        self._unique: dict[str, Observation] = {}
        self._columns: dict[str, list[str]] = {}

    def raw(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as it is, its rows, nulls and plan spellings counted on the way."""
        self._raw[name], self._columns[name] = Observation(f"dq_raw_{name}"), df.columns
        return df.observe(self._raw[name], *_counted(df))

    def unique(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, one row per key, its keys counted on the way."""
        self._unique[name] = Observation(f"dq_unique_{name}")
        return df.observe(self._unique[name], F.count(self.keys[name]).cast("double").alias("keys"))

    def rows(self) -> list[tuple[str, str, str | None, float | None]]:
        """(table, metric, column, value) of every wrapped table; waits for the writes that are still running."""
        out = []
        for name, seen in self._raw.items():
            got = seen.get
            out.append((name, "rows", None, got["rows"]))
            if name in self._unique:
                out.append((name, "dup_keys", None, got["rows"] - self._unique[name].get["keys"]))
            out += [(name, "null", c, got[f"null::{c}"]) for c in self._columns[name]]
            if "noncanonical_plan" in got:
                out.append((name, "noncanonical_plan", None, got["noncanonical_plan"]))
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """:meth:`rows` as a frame."""
        return spark.createDataFrame(self.rows(), PROFILE_SCHEMA)


def profile_table(name: str, df: DataFrame, key: str | None = None) -> DataFrame:
    """(table, metric, column, value) rows for one table, from a single aggregate."""
    aggs = _counted(df)
    if key:
        aggs.insert(1, (F.count("*") - F.count_distinct(key)).cast("double").alias("dup_keys"))
    row = df.agg(*aggs)
    metrics = row.columns
    stack = ", ".join(
        f"'{m.split('::')[0] if '::' in m else m}', "
        f"{repr(m.split('::')[1]) if '::' in m else 'CAST(NULL AS STRING)'}, `{m}`"
        for m in metrics)
    return row.select(F.lit(name).alias("table"),
                      F.expr(f"stack({len(metrics)}, {stack}) AS (metric, column, value)"))


def dq_profile(raw: dict[str, DataFrame]) -> DataFrame:
    """Profile of every raw table present in ``raw``."""
    out = None
    for name, df in raw.items():
        p = profile_table(name, df, KEYS.get(name))
        out = p if out is None else out.unionByName(p)
    return out
