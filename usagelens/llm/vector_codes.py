"""Vector codes: product quantisation whose codebooks are learned by ball k-means.

Vectors of whole numbers are cut into equal parts, each coded by the nearest
entry of its codebook. The first assignment compares with all entries. After
it, the parts that chose an entry are its ball: the radius is their largest
distance (plus the way that the entry moved since). Entries nearer than twice
the radius are its neighbours, in order of distance. A part nearer to its
entry than half the way to the first neighbour lies in the stable core and
stays; any other lies in a ring between half the ways to two neighbours, and
only the neighbours up to that ring are compared (triangle inequality, in
exact squares, with equality kept for ties).
"""
from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.centroids import finite, whole_numbers
from usagelens.llm.common import ship, shuffles_removed, small
from usagelens.session import checkpoint_dir

BLOCK = 8192
#: Numbers of one distance table that are in memory at once.
CELLS = 1 << 21


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` and ``y``, exact: whole doubles below 2^53, or Python's whole numbers."""
    return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)


def nearest_of_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, squared distance) of the nearest entry, every entry compared; ties go to the lower place."""
    place, distance = np.empty(len(x), np.int64), np.empty(len(x), x.dtype)
    step = max(CELLS // max(len(entries), 1), 1)
    for at in range(0, len(x), step):
        d = squares(x[at:at + step], entries)
        place[at:at + step] = d.argmin(axis=1)
        distance[at:at + step] = d.min(axis=1)
    return place, distance


class Balls:
    """Entries of one part position, and for each the neighbours that its ball can reach, nearest first.

    ``reach``: a whole number per entry, no smaller than its radius.
    """

    def __init__(self, entries: np.ndarray, reach: Sequence[int]):
        self.entries = entries
        gaps = squares(entries, entries)
        self.near, self.gaps = [], []
        for j, r in enumerate(reach):
            order = np.argsort(gaps[j], kind="stable")
            order = order[(order != j) & (gaps[j][order] <= (2 * r) ** 2)]
            self.near.append(order)
            self.gaps.append(gaps[j][order])

    def nearest(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As :func:`nearest_of_all`, for parts whose entry so far is ``own``."""
        gap = x - self.entries[own]
        distance = (gap * gap).sum(axis=1)
        place = own.copy()
        order = np.argsort(own, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(own[order])) + 1) if len(own) else ():
            j = own[rows[0]]
            ring = np.searchsorted(self.gaps[j], 4 * distance[rows], side="right")
            rows, ring = rows[ring > 0], ring[ring > 0]  # the others lie in the stable core
            if not len(rows):
                continue
            inner = np.argsort(ring, kind="stable")
            rows, ring = rows[inner], ring[inner]
            at = 0
            while at < len(rows):
                upto = min(at + max(CELLS // int(ring[-1]), 1), len(rows))
                some, rings = rows[at:upto], ring[at:upto]
                near = self.near[j][:rings[-1]]
                d = squares(x[some], self.entries[near])
                inside = np.arange(len(near))[None, :] < rings[:, None]
                best = np.minimum(np.where(inside, d, distance[some][:, None]).min(axis=1), distance[some])
                lowest = np.where(inside & (d == best[:, None]), near[None, :], len(self.entries)).min(axis=1)
                place[some] = np.where(distance[some] == best, np.minimum(lowest, j), lowest)
                distance[some] = best
                at = upto
        return place, distance


class _Coder:
    """Codes the vectors of Arrow batches; made once per task.

    ``books``: entries per part position, Python's whole numbers; ``reach``: of each entry, None for a first assignment.
    """

    def __init__(self, books, reach, scale: int, dim: int):
        self.parts, self.scale, self.dim = len(books), scale, dim
        self.width = dim // self.parts
        self.most = math.isqrt(2 ** 50 // max(self.width, 1))  # 4 * width * most^2 stays below 2^53
        exact = [np.array(b, object).reshape(-1, self.width) for b in books]
        self.fits = all(not e.size or np.abs(e).max() <= self.most for e in exact)
        self.books, self.reach, self.balls = exact, reach, {}

    def _of(self, part: int, kind):
        if (part, kind) not in self.balls:
            entries = self.books[part].astype(kind)
            self.balls[part, kind] = Balls(entries, self.reach[part]) if self.reach else entries
        return self.balls[part, kind]

    def numbers(self, column: pa.ListArray) -> np.ndarray:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, self.dim)
        x = whole_numbers(x, self.scale, self.most if self.fits else -1)
        return x if x.dtype == object else x.astype(float)

    def code(self, column: pa.ListArray, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, codes, squared distances) of vectors, given their ``codes`` so far."""
        x = self.numbers(column)
        kind = object if x.dtype == object else float
        found, distances = np.empty((len(x), self.parts), np.int64), np.empty((len(x), self.parts), x.dtype)
        for p in range(self.parts):
            part, known = x[:, p * self.width:(p + 1) * self.width], self._of(p, kind)
            found[:, p], distances[:, p] = (known.nearest(part, codes[:, p]) if self.reach else nearest_of_all(part, known))
        return x, found, distances


def _codes_of(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, parts).astype(np.int64)


def _assigned(frame: DataFrame, books, reach, scale: int, dim: int) -> DataFrame:
    """``frame`` with new codes; ``error``: squared distances added up over the parts."""
    kind = {f.name: f.dataType.simpleString() for f in frame.schema}
    def run(batches):
        coder = _Coder(books, reach, scale, dim)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                codes = _codes_of(part.column("codes"), len(books)) if reach else None
                _, found, distances = coder.code(part.column("vec"), codes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), part.column("vec"),
                     pa.array([c.tobytes() for c in found.astype("<u2")], pa.binary()),
                     pa.array([int(d) for d in distances.sum(axis=1)], pa.int64())],
                    names=["vec_id", "label", "vec", "codes", "error"])

    return frame.mapInArrow(run, f"vec_id long, label {kind['label']}, vec {kind['vec']}, codes binary, error long")


def _moments(coded: DataFrame, books, scale: int, dim: int) -> dict:
    """{(part, entry): (members, sums, largest squared distance)}: at most one row per entry comes to the driver."""
    parts, width = len(books), dim // len(books)

    def run(batches):
        coder, seen = _Coder(books, None, scale, dim), {}
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x, codes = coder.numbers(part.column("vec")), _codes_of(part.column("codes"), parts)
                for p in range(parts):
                    cut, own = x[:, p * width:(p + 1) * width], codes[:, p]
                    gap = cut - coder.books[p].astype(x.dtype)[own]
                    far, order = (gap * gap).sum(axis=1), np.argsort(own, kind="stable")
                    for rows in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
                        n, sums, most = seen.get((p, int(own[rows[0]])), (0, [0] * width, 0))
                        here = [int(v) for v in cut[rows].sum(axis=0)]
                        seen[p, int(own[rows[0]])] = (n + len(rows), [a + h for a, h in zip(sums, here)], max(most, int(far[rows].max())))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.int32()),
                 pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([[str(s) for s in v[1]] for v in seen.values()], pa.list_(pa.string())),
                 pa.array([str(v[2]) for v in seen.values()], pa.string())], names=["part", "entry", "n", "sums", "far"])

    rows = coded.select("vec", "codes").mapInArrow(run, "part int, entry int, n long, sums array<string>, far string")
    # the largest distance goes along as the component after the last, where the greatest counts and not the sum
    total = F.when(F.col("place") < width, F.sum("s")).otherwise(F.max("s")).alias("total")
    each = rows.select("part", "entry", "n", F.posexplode(F.concat("sums", F.array("far"))).alias("place", "s"))
    got: dict = {}
    for r in each.withColumn("s", F.col("s").cast("decimal(38,0)")).groupBy("part", "entry", "place").agg(
            F.sum("n").alias("n"), total).collect():
        got.setdefault((r["part"], r["entry"]), (r["n"], [0] * (width + 1)))[1][r["place"]] = int(r["total"])
    return {k: (n, v[:width], v[width]) for k, (n, v) in got.items()}


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4,
             scale: int = 1024) -> tuple[DataFrame, list[list[list[int]]]]:
    """(coded, codebooks) of ``vectors`` (vec_id, embedding, label).

    coded: (vec_id, label, codes, error) for every row whose vector is not
    null and holds no null or non-finite component: ``codes`` holds an
    unsigned 16-bit place per part, ``error`` the squared distance between the
    whole numbers ``floor(scale * x)`` and the entries. codebooks: entries per
    part. They start with the parts of the ``entries`` smallest vec_ids
    (null last; of equal ids the smaller vector first; fewer vectors give
    fewer entries); ``rounds`` times all parts are assigned (ties: lower place)
    and used entries become floored means. The length is that of the first of
    these vectors; a vector of another length, or all where it is not a
    multiple of ``parts``, has null codes and error. Repeated rows and ids are
    vectors of their own; other columns are not read; an empty table gives
    nothing. Numbers of any size are exact; an error above 64 bits raises one.

    Eager: every round writes vectors and codes to one of two tables in the
    shared checkpoint folder, in turn, so that at most two copies stand there,
    and reads them once for the moments. Only codebooks and one row per entry
    pass the driver; no row is shuffled.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = finite(vectors, "label")
    front = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(1).select("vec").collect()
    dim = len(front[0]["vec"]) if front else 0
    apart = kept.where(F.lit(not dim or bool(dim % parts)) | (F.size("vec") != dim)).select(
        "vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error"))
    if not dim or dim % parts:
        return apart, [[] for _ in range(parts)]
    fit, width = kept.where(F.size("vec") == dim), dim // parts
    first = [r["vec"] for r in fit.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()]
    start = [[int(v) for v in row] for row in whole_numbers(np.array(first), scale, 2 ** 62)]
    books = [[row[p * width:(p + 1) * width] for row in start] for p in range(parts)]
    folder, now, reach = f"{checkpoint_dir(spark).rstrip('/')}/codes-{uuid.uuid4().hex}", fit, None
    for i in range(rounds + 1):
        step, path = _assigned(now, books, reach, scale, dim), f"{folder}/{i % 2}"
        if i == rounds:
            step, path = step.drop("vec"), f"{folder}/coded"
        with shuffles_removed(spark):
            step.write.mode("overwrite").parquet(path)
        now = spark.read.schema(step.schema).parquet(path)
        if i < rounds:
            books, reach = _moved(books, _moments(now, books, scale, dim))
    return now.unionByName(apart), books


def _moved(books, moments) -> tuple[list, list]:
    """New codebooks, and for every entry a whole number no smaller than its ball's radius about its new place."""
    after, reach = [], []
    for p, book in enumerate(books):
        after.append([[s // n for s in sums] if n else list(old) for old, (n, sums, _) in (
            (old, moments.get((p, j), (0, (), 0))) for j, old in enumerate(book))])
        reach.append([math.isqrt(moments.get((p, j), (0, (), 0))[2]) + 1
                      + math.isqrt(sum((a - b) ** 2 for a, b in zip(old, new))) + 1
                      for j, (old, new) in enumerate(zip(book, after[p]))])
    return after, reach


def digests(coded: DataFrame, books: Sequence) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes in hex, errors added up over equal labels (nulls together)."""
    flat = ",".join(str(v) for book in books for entry in book for v in entry)
    places = [F.substring(F.hex("codes"), 4 * p + 1, 2) for p in range(len(books))]  # low byte of each 16-bit place
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(small(totals, totals.count()), F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", F.lower(F.concat(*places)).alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(flat.encode()).hexdigest()).alias("codebooks_sha256"))
