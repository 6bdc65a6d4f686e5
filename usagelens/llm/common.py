"""Helpers shared by the operators: row-wise Arrow stages, chunks of long texts, components."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import checkpoint_dir

ROWS_OUT = 4096
UNSTABLE = "rows changed places between two reads: write the frame to a table first"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs started inside give back their shuffle files when they end, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: ``df`` as a table in the shared checkpoint folder, computed once and read back.

    The files outlive lost executors; the shuffles behind them are removed at once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors through Spark's own file distribution, once per application.

    Functions travel by reference; where the package is not installed on the
    executors they could not be loaded otherwise.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(top):
        target = os.path.join(tempfile.mkdtemp(), "usagelens.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(target)
    _shipped.add(sc.applicationId)


_kept_model: dict = {}


def per_worker(make: Callable, *args):
    """``make(*args)``, kept by this Python worker until it needs another model: only one is in memory at a time."""
    key = (make, *args)
    if key not in _kept_model:
        _kept_model.clear()
        _kept_model[key] = make(*args)
    return _kept_model[key]


def small(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """A frame made from ``rows`` rows of the driver, to be broadcast if they are at most ``most``."""
    return F.broadcast(df) if rows <= most else df


def per_row(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """Apply a row function to every row of ``df`` inside Arrow batches (narrow, streaming).

    ``make()`` runs once per task and returns ``row(*values) -> tuple``;
    ``schema`` names the output columns as DDL.
    """
    ship(df.sparkSession)
    empty = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                yield record_batch([row(*v) for v in zip(*(c.to_pylist() for c in part.columns))], empty)

    return df.mapInArrow(run, schema)


def record_batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Tuples to one Arrow batch of ``schema``."""
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def chunks(text: str, size: int, space: str = " ") -> Iterator[str]:
    """Cut a long text into pieces of about ``size`` characters, each cut just before a lone ``space``.

    A piece grows until such a place comes, so no word is ever cut; the
    pieces joined give the text again. Keeps memory bounded on very long texts.
    """
    at, n = 0, len(text)
    while n - at > size:
        cut = text.find(space, at + size)
        while cut > 0 and (text[cut - 1].isspace() or text[cut - 1] == "▁"):
            cut = text.find(space, cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def text_or_empty(name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def numbered(df: DataFrame, name: str, *columns) -> DataFrame:
    """Rows with a number of their own, so that repeated ids stay apart.

    The number is a function of the input partition and the place in it, so
    a task that runs again gives the same numbers; ``df`` must be a table
    scan or another stable frame.
    """
    ship(df.sparkSession)
    return df.select(F.monotonically_increasing_id().alias(name), *columns)


def rows_of(docs: DataFrame, chosen: DataFrame, *order: str) -> DataFrame:
    """The rows of ``docs`` (a table as read) that ``chosen`` (rid, doc_id, order...) names, all columns.

    A row named twice comes twice. Only the small side is hashed; texts are
    not sorted. A row found under another doc_id raises an error.
    """
    rows = numbered(docs, "rid", F.struct("*").alias("doc"))
    found = rows.join(chosen.select("rid", F.col("doc_id").alias("id"), *order).hint("shuffle_hash"), "rid")
    same = F.when(F.col("doc.doc_id").eqNullSafe(F.col("id")), F.col("doc")).otherwise(F.raise_error(F.lit(UNSTABLE)))
    return found.select("rid", *order, same.alias("doc"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u long, v long): one row (node, root) per node with an edge.

    ``root`` is the smallest node of the component. Alternates large-star and
    small-star steps: every node hooks its larger neighbours to its smallest
    one. Each step is two aggregations with map-side minimum and joins that
    AQE can split at a hot node; links never leave the executors, and each
    step's edges are written to the shared folder. The number of steps grows with the
    logarithm of the component size.
    """
    def settle(frame: DataFrame) -> tuple[DataFrame, tuple]:
        kept = written(frame)
        sign = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return kept, tuple(sign)

    pairs = edges.where(F.col("u") != F.col("v"))
    now, sign = settle(pairs.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    while sign[0]:
        both = now.select(F.col("a").alias("n"), F.col("b").alias("o")).unionAll(
            now.select(F.col("b").alias("n"), F.col("a").alias("o")))
        least = both.groupBy("n").agg(F.least(F.min("o"), F.col("n")).alias("m"))
        large = both.join(least, "n").where("o > n").select(F.col("o").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = sign
        now, sign = settle(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct())
        if sign == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
