"""IO1-IO13: readers and writers.

Parquet is the primary format; CSV is supported with declared schemas
(never inferred). Writers overwrite per table; Spark gives per-table, not
cross-table, atomicity.
"""
from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.sources.schemas import SCHEMAS, conform

log = logging.getLogger(__name__)
CSV_TIME_IN, CSV_TIME_OUT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _path(root: str, name: str, fmt: str) -> str:
    return f"{root.rstrip('/')}/{name}.{fmt}" if fmt == "parquet" else f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """IO1 / IO2 / IO3: read ``root/name`` with the declared schema.

    Parquet columns are selected and cast to the schema (pruned at the
    scan); CSV is read with the schema directly, so timestamp columns keep
    their type (TimestampNTZ) instead of arriving as text.
    """
    schema = schema or SCHEMAS.get(name)
    if fmt == "csv":
        # a cell that does not fit its column stops the read instead of turning into a null
        r = spark.read.option("header", True).option("mode", "FAILFAST").option("timestampNTZFormat", CSV_TIME_IN)
        return r.schema(schema).csv(_path(root, name, fmt)) if schema else r.csv(_path(root, name, fmt))
    df = spark.read.parquet(_path(root, name, fmt))
    return conform(df, schema) if schema else df


BAD_ROW = "_bad_row"


def split_csv(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """IO2 / IO3: (good, bad) rows of a CSV table: those that fit the declared schema, and the others as they stand.

    bad: (table, line). Both read the file; write ``bad`` to a side table and
    count it, so one bad cell neither stops a run nor turns into a null.
    """
    schema = schema or SCHEMAS[name]
    wide = T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])
    rows = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
            .option("timestampNTZFormat", CSV_TIME_IN).schema(wide).csv(_path(root, name, "csv")))
    # every query names all columns, so that the reader parses the whole line before it is judged
    whole = F.to_json(F.struct(*schema.names))
    good = rows.where(F.col(BAD_ROW).isNull() & (F.length(whole) >= 0)).select(*schema.names)
    bad = rows.where(F.col(BAD_ROW).isNotNull()).select(F.lit(name).alias("table"), F.coalesce(F.col(BAD_ROW), whole).alias("line"))
    return good, bad


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when Spark finds ``path`` on the session's file system (analysis only, no job)."""
    try:
        spark.read.format("binaryFile").load(path).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_optional(spark: SparkSession, root: str, name: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """IO4: the table if it exists, else an empty frame of ``schema``."""
    if path_exists(spark, _path(root, name, fmt)):
        return read_table(spark, root, name, fmt, schema)
    return spark.createDataFrame([], schema)


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> str:
    """IO5 / IO9: overwrite ``root/name``; CSV with a header and no index."""
    path = _path(root, name, fmt)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", CSV_TIME_OUT).csv(path)
    else:
        w.parquet(path)
    return path


def write_all(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """IO6: write every named table; one job per table."""
    return {name: write_table(df, root, name, fmt) for name, df in tables.items()}


def save_as_tables(tables: dict[str, DataFrame], database: str | None = None) -> list[str]:
    """IO7: replace catalog tables (one overwrite per table)."""
    names = []
    for name, df in tables.items():
        full = f"{database}.{name}" if database else name
        df.write.mode("overwrite").saveAsTable(full)
        names.append(full)
    return names


def write_jdbc(tables: dict[str, DataFrame], url: str, properties: dict) -> list[str]:
    """IO7 / IO8: replace tables in an external database via JDBC.

    The URL and credentials are explicit arguments; there is no default
    connection. Best effort: a table that fails is logged, the others are
    still written; the names of the failed ones are returned.
    """
    failed = []
    for name, df in tables.items():
        try:
            df.write.jdbc(url, name, mode="overwrite", properties=properties)
        except Exception:
            log.exception("table %s was not loaded", name)
            failed.append(name)
    return failed


def write_json_record(df: DataFrame, path: str) -> str:
    """IO10: one JSON document per row (nested structs/arrays kept) as text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)
    return path


#: Fixed value: the line that stands for no insight.
FALLBACK_INSIGHT = "Insights will populate after pipeline runs with richer data."


def write_insights_text(insights: DataFrame, path: str) -> str:
    """IO11: one "- sentence" line per insight, or the fallback line when none.

    The fallback row is added by a union with an anti-empty filter, so no
    count reaches the driver.
    """
    lines = insights.select("rule_id", F.concat(F.lit("- "), "text").alias("value"))
    has_any = insights.agg(F.count("*").alias("n"))
    fallback = has_any.where(F.col("n") == 0).select(F.lit(0).alias("rule_id"),
                                                      F.lit(FALLBACK_INSIGHT).alias("value"))
    (lines.unionByName(fallback).coalesce(1).sortWithinPartitions("rule_id").select("value")
     .write.mode("overwrite").text(path))
    return path


IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("model_importance", T.DoubleType()),
    T.StructField("permutation_importance", T.DoubleType()),
])


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """IO13: read the importance CSV back with its declared schema; nulls become 0.

    A cell that is no number stops the read; the first column is the feature's
    name, whatever its header says.
    """
    return (spark.read.option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
            .schema(IMPORTANCE_SCHEMA).csv(path).na.fill(0.0))


# ---- runs that appear whole or not at all
def publish(spark: SparkSession, out: str, run_id: str, paths: dict[str, str]) -> None:
    """Write the manifest of a finished run, the last thing it does: (run, name, path) rows in a folder of its own.

    Manifests are only ever added, so a reader sees a run whole or not at
    all, and a run that ends early changes nothing that a reader finds.
    """
    rows = spark.createDataFrame([(run_id, name, path) for name, path in sorted(paths.items())], "run string, name string, path string")
    rows.coalesce(1).write.mode("error").parquet(f"{out.rstrip('/')}/manifests/{run_id}")


def published(spark: SparkSession, out: str) -> dict[str, str]:
    """{name: path} of the latest published run under ``out`` (by run id; empty if there is none)."""
    folder = f"{out.rstrip('/')}/manifests"
    if not path_exists(spark, folder):
        return {}
    found = spark.read.schema("run string, name string, path string").option("recursiveFileLookup", True).parquet(folder)
    last = found.agg(F.max("run")).first()[0]
    return {r["name"]: r["path"] for r in found.where(F.col("run") == F.lit(last)).collect()}
