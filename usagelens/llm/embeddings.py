"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

A vector is rotated by sign flips and Walsh-Hadamard transforms (three
rounds) and hashed to the nearest vertex of the cross-polytope: the largest
coordinate and its sign. A bucket joins ``depth`` such hashes; each table
also enters the buckets in which the least certain hash takes its second
choice (multiprobe). Vectors of one label that share a bucket are candidates,
and the cosine in double precision decides. The depth follows from the
label's own number of vectors, and the number of tables rises with it, so
that the share of pairs found does not fall as a label grows.

Identical vectors are one class with a count. Within a bucket only counts of
links and a spanning set of edges leave the task; a pair that meets in
several buckets is counted in the first. Buckets of more than ``CELL``
members are cut into cells of at most two chunks, so that every pair still
meets, in bounded memory.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import components, numbered, small, written

CELL = 2048
#: Tables at depth 1, and the growth of their number with each further hash.
TABLES, MORE, PROBES = 4, 1.6, 2
#: Members a bucket should have on average; sets how many hashes a bucket joins.
CROWD = 16
SEED = 20_240
KEYED = "bucket long, tab int, label string, cid long, n long, vec binary, codes binary"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row (a power of two wide)."""
    rows, width, half = len(x), x.shape[1], 1
    while half < width:
        x = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(rows, width)


def depth_of(members: int, dim: int, crowd: float = CROWD) -> int:
    """Hashes that a bucket joins, for so many distinct vectors of one label and length."""
    depth, reach = 1, 2 * (1 << max(dim - 1, 1).bit_length())
    while reach ** depth * crowd < members:
        depth += 1
    return depth


def tables_of(depth: int) -> int:
    return round(TABLES * MORE ** (depth - 1))


def bucket_codes(x: np.ndarray, groups: np.ndarray, depth: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Codes of the (tables x probes) buckets of every row; ``groups`` keeps labels apart."""
    n, dim = x.shape
    width = 1 << max(dim - 1, 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    out = np.empty((n, tables, probes), np.int64)
    with np.errstate(over="ignore"):
        for t in range(tables):
            first, second, gap = (np.empty((n, depth), kind) for kind in (np.int64, np.int64, float))
            for d in range(depth):
                signs = np.random.default_rng([SEED, t, d, width]).choice([-1.0, 1.0], (3, width))
                y = padded
                for s in signs:
                    y = hadamard(y * s)
                size = np.abs(y)
                two = np.argpartition(-size, 1, axis=1)[:, :2]
                a = np.take_along_axis(size, two, 1)
                two = np.where((a[:, :1] < a[:, 1:]) | ((a[:, :1] == a[:, 1:]) & (two[:, :1] > two[:, 1:])), two[:, ::-1], two)
                a = np.sort(a, axis=1)
                vertex = 2 * two + (np.take_along_axis(y, two, 1) < 0)
                first[:, d], second[:, d], gap[:, d] = vertex[:, 0], vertex[:, 1], a[:, 1] - a[:, 0]
            unsure = np.argsort(gap, axis=1, kind="stable")
            for p in range(probes):
                choice = first.copy()
                if p:  # the p-th least certain hash takes its second choice
                    at = unsure[:, min(p, depth) - 1]
                    choice[np.arange(n), at] = second[np.arange(n), at]
                code = (groups ^ (t << 32)).view(np.uint64)
                for d in range(depth):
                    code = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + choice[:, d].astype(np.uint64)
                code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                out[:, t, p] = (code ^ (code >> np.uint64(32))).view(np.int64)
    return out


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _keys(classes: DataFrame) -> DataFrame:
    crowd = CROWD

    def run(batches):
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns)))
            shapes = [(len(r[3]), depth_of(r[5], len(r[3]), crowd)) for r in rows]
            for dim, depth in sorted(set(shapes)):
                of = [r for r, shape in zip(rows, shapes) if shape == (dim, depth)]
                tables = tables_of(depth)
                x = units(np.array([r[3] for r in of], float))
                codes = bucket_codes(x, np.array([r[2] for r in of], np.int64) ^ dim, depth, tables)
                for t in range(tables):
                    for p in range(PROBES):
                        fresh = np.array([codes[i, t, p] not in codes[i, t, :p] for i in range(len(of))], bool)
                        at = np.flatnonzero(fresh)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(codes[at, t, p]), pa.array(np.full(len(at), t, np.int32)),
                            pa.array([of[i][4] for i in at], pa.string()),
                            pa.array([of[i][0] for i in at], pa.int64()), pa.array([of[i][1] for i in at], pa.int64()),
                            pa.array([x[i].tobytes() for i in at], pa.binary()),
                            pa.array([codes[i].tobytes() for i in at], pa.binary())],
                            names=["bucket", "tab", "label", "cid", "n", "vec", "codes"])

    # labels of fewer vectors have depth 1 whatever their length
    sizes = written(classes.groupBy("label", F.size("vec").alias("dim")).agg(F.count("*").alias("members")).where(F.col("members") > 4 * crowd))
    sized = classes.withColumn("dim", F.size("vec")).join(small(sizes, sizes.count()), ["label", "dim"], "left")
    return sized.select("cid", "n", F.xxhash64("label"), "vec", F.col("label").cast("string"),
                        F.coalesce("members", F.lit(1)).alias("members")).mapInArrow(run, KEYED)


def _pairs_of_cell(bucket, tab, codes, vecs, side, cut):
    """Index pairs of a cell that are near and whose first common bucket this is."""
    left = np.flatnonzero(side < 2)
    right = left if (side == 0).any() else np.flatnonzero(side == 2)
    block = 512
    for at in range(0, len(left), block):
        rows = left[at:at + block]
        near = vecs[rows] @ vecs[right].T >= cut
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        if right is left:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        a, b = codes[i], codes[j]
        first = np.ones(len(i), bool)
        for t in range(tab + 1):
            for p in range(PROBES):
                for q in range(PROBES):
                    same = a[:, t, p] == b[:, t, q]
                    first &= ~(same & (a[:, t, p] < bucket)) if t == tab else ~same
        yield i[first], j[first]


def _links(keyed: DataFrame, cut: float) -> DataFrame:
    """(u, v, links): per class and cell, its links counted there and a class it is linked with."""
    def run(batches):
        key, rows = None, []

        def close():
            if len(rows) < 2:
                return None
            bucket, tab = rows[0][0], rows[0][1]
            cid, n = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
            vecs = np.array([np.frombuffer(r[5]) for r in rows])
            codes = np.array([np.frombuffer(r[6], np.int64) for r in rows]).reshape(len(rows), -1, PROBES)
            side = np.array([r[2] for r in rows])
            count, low = np.zeros(len(rows), np.int64), np.arange(len(rows))
            ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, j in _pairs_of_cell(bucket, tab, codes, vecs, side, cut):
                np.add.at(count, i, n[j])
                np.add.at(count, j, n[i])
                ends[0].append(i)
                ends[1].append(j)
            i, j = map(np.concatenate, ends)
            while len(i):  # smallest index reachable within the cell
                before = low.copy()
                np.minimum.at(low, i, low[j])
                np.minimum.at(low, j, low[i])
                low = low[low]
                if (low == before).all():
                    break
            at = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(cid[low[at]]), pa.array(count[at])],
                                              names=["u", "v", "links"]) if len(at) else None

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[7] != key:
                    if (out := close()) is not None:
                        yield out
                    key, rows = r[7], []
                rows.append(r)
        if (out := close()) is not None:
            yield out

    sizes = keyed.groupBy("bucket").count().where(F.col("count") > CELL).select(
        "bucket", F.ceil(F.col("count") / CELL).cast("int").alias("g"))
    own = F.pmod(F.xxhash64("cid"), F.col("g")).cast("int")
    # chunk c of g meets every chunk: cells (min, max); an uncut bucket is one cell. side: 0 one chunk with
    # itself, 1 the lower and 2 the higher of two. Labels and lengths never share a cell, whatever the hash
    cells = keyed.join(sizes, "bucket", "left").withColumn("g", F.coalesce("g", F.lit(1))).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cells = cells.select("bucket", "tab", F.expr("case when own = other then 0 when own < other then 1 else 2 end").alias("side"), "cid", "n", "vec", "codes",
                         F.concat_ws(":", "bucket", F.least("own", "other"), F.greatest("own", "other"), F.octet_length("vec"),
                                      "label").alias("cell"))
    return (cells.repartition("cell").sortWithinPartitions("cell", "cid")
            .mapInArrow(run, "u long, v long, links long"))


def near_vectors(vectors: DataFrame, cut: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal label are linked at a cosine of ``cut`` or more, if a
    bucket finds them. A null label, and a vector that is null, zero or holds
    null or non-finite numbers, links with nothing: no links, its own id as
    component. Vectors of different length are never compared. Repeated rows
    and ids are vectors of their own; a null vec_id counts as larger than any.
    Other columns are not read; an empty table gives no rows. Eager: the
    links and each step of the components are written.
    """
    base = numbered(vectors, "rid", F.col("vec_id").cast("long").alias("vec_id"), "label",
                    F.col("embedding").cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("label").isNotNull() & F.col("vec").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0)
    base = base.withColumn("good", F.coalesce(good, F.lit(False)))
    valid = base.where("good")
    classes = valid.groupBy("label", "vec").agg(
        F.min("rid").alias("cid"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    known = written(classes.select("cid", "n", "least", "label", "vec"))
    found = written(_links(_keys(known), cut))
    roots = components(found.select("u", "v"))
    members = (known.select("cid", "n", "least", "label", "vec")
               .join(found.groupBy("u").agg(F.sum("links").alias("links")), F.col("cid") == F.col("u"), "left")
               .join(roots, F.col("cid") == F.col("node"), "left")
               .select("label", "vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least",
                       F.coalesce("root", "cid").alias("root")))
    lowest = members.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = members.join(lowest, "root").select("label", "vec", "n_links", "component_id")
    linked = valid.select("vec_id", "label", "vec").join(placed, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = base.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
