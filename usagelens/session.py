"""Session helpers: sane defaults for local runs and checkpoint-dir handling."""
from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "usagelens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    What a launcher (spark-submit, PYSPARK_SUBMIT_ARGS or a session that is
    already running) has set stays as it is; the defaults below fill only what
    is unset. Explicit arguments win over both.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    sql = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    alone = {  # nobody has launched anything: one machine
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus,
    }
    launched = SparkSession.getActiveSession() is not None or any(
        os.environ.get(k) for k in ("PYSPARK_GATEWAY_PORT", "PYSPARK_SUBMIT_ARGS"))
    chosen = ({} if launched else sql | alone) | (extra or {})
    if master:
        chosen["spark.master"] = master
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder if launched else SparkSession.builder.appName(app)
    for k, v in chosen.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if launched:
        given = spark.sparkContext.getConf()
        for k, v in sql.items():
            if not given.contains(k) and k not in chosen:
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df):
    """Reliable checkpoint of ``df`` into the session's checkpoint folder.

    The frame is persisted first, so the checkpoint write does not run its
    lineage a second time; the cache is dropped once the files exist.
    Never a local checkpoint: the files live on the shared folder and
    survive the loss of an executor.
    """
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    with setting(df.sparkSession, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true"):
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            held.count()  # fills the cache; adaptive execution merges small partitions before the files are cut
            return held.checkpoint(eager=True)
        finally:
            held.unpersist()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when the session names none do we set one: ``fallback`` if given, else, in
    local mode (tests, ad-hoc runs), a folder under the warehouse dir. On a
    cluster without a shared folder this raises an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not fallback and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        wh = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        conf = fallback or wh.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for what runs inside; put back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Jobs started inside give back their shuffle files when they end, not when the driver collects garbage."""
    return setting(spark, CLEANUP, "true")


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
    top = os.path.dirname(os.path.abspath(__file__))
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
