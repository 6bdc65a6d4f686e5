"""Distributed prefix sums: range partitions, their totals, and a scan inside each of them."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.session import cut_lineage


def prefix_sums(df: DataFrame, order: Sequence[str | Column], sums: dict[str, str]) -> DataFrame:
    """The rows of ``df`` and, for every ``name: column`` of ``sums``, that column (long) added up over all rows before.

    Rows are dealt to range partitions of ``order`` by sampled bounds and
    sorted there; their number follows the size of the data (adaptive
    execution merges small ones). One aggregate gives each partition's totals,
    of which the driver makes the partitions' offsets (a number per partition
    and sum), and a last, narrow pass adds up row by row. Null counts as 0.
    Rows of equal order lie in one partition and follow each other in no fixed
    order: pre-aggregate keys that many rows share.

    Eager: the sorted rows are checkpointed, so offsets and rows agree when
    tasks run again.
    """
    laid = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    totals = laid.groupBy(F.spark_partition_id().alias("part")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for name, c in sums.items()]).orderBy("part").collect()
    before, start = {}, dict.fromkeys(sums, 0)
    for row in totals:
        before[row["part"]] = dict(start)
        start = {name: start[name] + row[name] for name in sums}
    columns = dict(sums)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = dict(before.get(TaskContext.get().partitionId(), {}))
        for b in batches:
            if not b.num_rows:
                continue
            out = []
            for name, column in columns.items():
                values = b.column(column).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                upto = done[name] + np.cumsum(values)
                out.append(pa.array(upto - values))
                done[name] = int(upto[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, *out], names=[*b.schema.names, *columns])

    return laid.mapInArrow(scan, T.StructType([*laid.schema.fields, *[T.StructField(name, T.LongType()) for name in columns]]))


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``df`` with contiguous numbers 0..n-1 in the order given (eager, see :func:`prefix_sums`)."""
    return prefix_sums(df.withColumn("_one", F.lit(1).cast("long")), order, {name: "_one"}).drop("_one")
