"""Centroid clustering with a Walsh-Hadamard progressive search.

Vectors and centroids are whole numbers and go through the exact integer
Walsh-Hadamard transform, which multiplies every squared distance by the
width. A vector adds up its squared coefficient differences coarse to fine
(few sign changes first): the centroid nearest on the coarsest block is
finished first and sets the mark, after each block the centroids whose sum
has passed the mark are out (strictly, so ties live on), and those that are
left at the end have all their coefficients summed.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship, written
from usagelens.llm.embeddings import hadamard

#: Rows that are searched at once.
BLOCK = 4096


def finite(vectors: DataFrame, *more: str) -> DataFrame:
    """(vec_id long, vec, more...) of the rows whose vector is not null and holds no null or non-finite component."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    vec = F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), *more).where(
        F.coalesce(F.col("vec").isNotNull() & ~odd, F.lit(False)))


def whole_numbers(x: np.ndarray, scale: int, most: float) -> np.ndarray:
    """``floor(scale * x)``: 64-bit numbers, or Python's whole numbers where one is above ``most``."""
    y = np.floor(x.astype(float) * scale)
    if y.size and np.abs(y).max() > most:
        return np.array([[int(v) for v in row] for row in y.tolist()], object).reshape(y.shape)
    return y.astype(np.int64)


def coarse_to_fine(width: int) -> np.ndarray:
    """Places of the transform's coefficients, those with the fewest sign changes first."""
    return np.argsort((np.diff(hadamard(np.eye(width)), axis=1) != 0).sum(axis=1), kind="stable")


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of every row, coarse to fine; rows are padded with zeros to a power of two."""
    width = 1 << max(x.shape[1] - 1, 0).bit_length()
    padded = np.zeros((len(x), width), x.dtype)
    padded[:, :x.shape[1]] = x
    return hadamard(padded)[:, coarse_to_fine(width)]


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, squared distance) of the nearest of ``centres`` for every row of ``x``; ties go to the smaller place.

    Both hold coefficients from :func:`walsh`.
    """
    width = x.shape[1]
    done = max(width // 8, 1)
    coarse = np.zeros((len(x), len(centres)), x.dtype)
    for f in range(done):
        gap = x[:, f, None] - centres[None, :, f]
        coarse += gap * gap
    guess = x - centres[coarse.argmin(axis=1)]
    mark = (guess * guess).sum(axis=1)
    row, col = np.nonzero(coarse <= mark[:, None])
    total = coarse[row, col]
    while done < width:
        upto = min(2 * done, width)
        gap = x[row, done:upto] - centres[col, done:upto]
        total = total + (gap * gap).sum(axis=1)
        live = total <= mark[row]
        row, col, total, done = row[live], col[live], total[live], upto
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])  # rows are in order, and so are the places in each
    least = np.minimum.reduceat(total, starts)
    hit = np.flatnonzero(total == least[row])
    first = hit[np.unique(row[hit], return_index=True)[1]]
    return col[first], least // width


def _vectors(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _search(centres: list[list[int]], scale: int, dim: int):
    """``near(column)``: (whole numbers, place, squared distance) of an Arrow column of vectors."""
    most = 2 ** 30 // (1 << (dim - 1).bit_length())  # 4 * width^2 * most^2 stays below 2^62
    exact = np.array(centres, object).reshape(-1, dim)
    fits = not exact.size or np.abs(exact).max() <= most
    coefficients = {object: walsh(exact)} | ({np.int64: walsh(exact.astype(np.int64))} if fits else {})

    def near(column):
        x = whole_numbers(_vectors(column, dim), scale, most if fits else -1)
        return x, *nearest(walsh(x), coefficients[x.dtype.type if x.dtype != object else object])

    return near


def _moments(kept: DataFrame, centres: list[list[int]], scale: int, dim: int) -> dict[int, tuple[int, list[int]]]:
    """{centroid: (vectors, sums)} of one assignment: at most one row per centroid comes to the driver."""
    def run(batches):
        near, count, sums = _search(centres, scale, dim), {}, {}
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                x, place, _ = near(b.column(0).slice(at, BLOCK))
                for c in np.unique(place).tolist():
                    of = x[place == c]
                    count[c] = count.get(c, 0) + len(of)
                    sums[c] = sums.get(c, 0) + of.sum(axis=0).astype(object)
        for c in count:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([count[c]], pa.int64()),
                 pa.array([[str(s) for s in sums[c]]], pa.list_(pa.string()))], names=["cluster", "n", "sums"])

    parts = kept.select("vec").mapInArrow(run, "cluster int, n long, sums array<string>")
    found: dict[int, tuple[int, list[int]]] = {}
    each = parts.select("cluster", "n", F.posexplode("sums").alias("place", "s")).groupBy("cluster", "place")
    for r in each.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("total")).collect():
        found.setdefault(r["cluster"], (r["n"], [0] * dim))[1][r["place"]] = int(r["total"])
    return found


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dim: int = 64,
                    seed: int = 2) -> tuple[DataFrame, list[list[int]]]:
    """(assigned, centroids): k-means over whole numbers ``floor(scale * x)`` of ``vectors`` (vec_id, embedding).

    assigned: (vec_id, cluster, distance) per vector with exactly ``dim``
    components, none null or non-finite; the others are left out. The start
    is the ``k`` vectors of smallest sha256 of ``seed:vec_id`` (a null vec_id
    last; of equal ids the smaller vector first); fewer vectors give fewer
    centroids. Each round assigns every vector to its nearest centroid (ties:
    smaller number) and replaces every centroid that has vectors by their
    floored mean. Repeated rows and ids are vectors of their own, other
    columns are not read, an empty table gives no rows and no centroids.
    Numbers of any size are exact; a distance above 64 bits raises an error.

    Eager: every round reads ``vectors`` once (a table, or another frame that
    does not change between reads) and is one narrow pass with sums per task;
    only centroids and their sums pass the driver. The assignment is written.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = finite(vectors).where(F.size("vec") == dim)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(name.asc_nulls_last(), "vec").limit(k).select("vec").collect()
    start = whole_numbers(np.array([r["vec"] for r in first], float).reshape(-1, dim), scale, 2 ** 62)
    centres = [[int(v) for v in row] for row in start]
    for _ in range(rounds if centres else 0):
        for c, (n, sums) in _moments(kept, centres, scale, dim).items():
            centres[c] = [s // n for s in sums]

    def assign(batches):
        near = _search(centres, scale, dim)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                _, place, distance = near(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(place.tolist(), pa.int32()), pa.array(distance.tolist(), pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return written(kept.mapInArrow(assign, "vec_id long, cluster int, distance long")), centres


def digests(assigned: DataFrame, centres: Sequence[Sequence[int]]) -> DataFrame:
    """The assignment with inertia per cluster and over all, and each vector's centroid as sha256.

    One row per centroid is joined to the vectors by broadcast.
    """
    spark = assigned.sparkSession
    names = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centres)]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    of = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    sums = spark.createDataFrame(list(of.items()), "cluster int, cluster_inertia long")
    return (assigned.join(F.broadcast(named), "cluster").join(F.broadcast(sums), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(of.values())).cast("long").alias("inertia"),
                    "centroid_sha256"))
