"""SimHash near-duplicates found by a generalised pigeonhole filter.

Fingerprints are 64 majority bits over the hashes of word shingles. To find
all pairs within ``distance`` bits, the bits are grouped into partitions and
each partition gets a threshold t >= -1 (-1: not probed) such that the sum of
(t + 1) is distance + 1: two fingerprints within ``distance`` bits are then
within t bits in at least one partition. Bits that go together (by their
co-occurrence over all fingerprints) share a partition, and dynamic
programming deals out the thresholds so that the expected number of probe
rows and candidate pairs is least; every choice finds every pair.

A partition of w bits with threshold t is probed with its C(w, t) values in
which t bits are masked: values within t bits share one of them. Fingerprints
of equal probe meet, are verified on all 64 bits, and links go on as edges.
In a crowded bucket only a spanning forest of its links is emitted.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import chunks, components, numbered, per_row, text_or_empty, written
from usagelens.llm.embeddings import hadamard

BITS = 64
SEED = 42
CHUNK = 1 << 19
#: Buckets of more fingerprints are split by further bits.
CROWD = 8192
#: Bits whose values are counted together.
BLOCK = 16
#: Runs of up to so many fingerprints are compared pair by pair; longer ones through pivots.
SMALL_RUN = 64
#: Relative cost of a probe row (shuffled and sorted) and of a candidate pair (one comparison in a task).
ROW_COST, PAIR_COST = 1.0, 0.02


# ---- fingerprints
def fingerprint(text: str, words: int = 3) -> int:
    """Majority bits of the shingles' XXH64 (seed 42) as a signed 64-bit integer; 0 without words.

    A-Z are lower-cased, words end at ASCII white space; with fewer words
    than a shingle has, the whole sequence is the only shingle.
    """
    from xxhash import xxh64_intdigest

    ones, n, left = np.zeros(BITS, np.int64), 0, []
    for part in chunks(text, CHUNK):
        left += part.encode().lower().split()
        if len(left) >= words:
            ones, n = _add(ones, n, [b" ".join(s) for s in zip(*(left[i:] for i in range(words)))], xxh64_intdigest)
            left = left[len(left) - words + 1:]
    if not n and left:
        ones, n = _add(ones, n, [b" ".join(left)], xxh64_intdigest)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def _add(ones, n, shingles, digest):
    h = np.fromiter(map(digest, shingles, repeat(SEED)), "<u8", len(shingles))
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return ones + bits.sum(axis=0, dtype=np.int64), n + len(shingles)


# ---- the plan
@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int


def _grouped(together: np.ndarray, m: int) -> list[list[int]]:
    """Bits in ``m`` groups of about equal size, each grown from its most correlated bits."""
    free, groups = set(range(BITS)), []
    for g in range(m):
        size = (BITS * (g + 1)) // m - (BITS * g) // m
        group = [max(sorted(free), key=lambda b: sum(together[b, x] for x in free if x != b))]
        free.discard(group[0])
        while len(group) < size:
            group.append(max(sorted(free), key=lambda b: sum(together[b, x] for x in group)))
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def groupings(n: int, both: np.ndarray, distance: int) -> list[list[list[int]]]:
    """The bits in 1 to ``distance`` + 1 groups of correlated bits; ``both[i, j]`` counts the ``n`` with bits i and j set."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    together = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    return [_grouped(together, m) for m in range(1, distance + 2)]


def _blocks(group: Sequence[int]) -> list[list[int]]:
    """A group's bits in blocks of about equal size, ``BLOCK`` at most."""
    return [b.tolist() for b in np.array_split(np.array(group), -(-len(group) // BLOCK))]


def pairs_by_distance(counts: np.ndarray) -> np.ndarray:
    """How many pairs (ordered, with oneself) differ in 0, 1, ... bits, from the number of rows with each value.

    The exclusive-or correlation of the counts by the Walsh-Hadamard transform.
    """
    width = len(counts).bit_length() - 1
    apart = hadamard(hadamard(counts.astype(float)[None, :]) ** 2)[0] / len(counts)
    return np.bincount(np.bitwise_count(np.arange(len(counts))), apart, width + 1)


def near_counts(prints: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """For every group of bits, how many pairs of fingerprints (distinct, column fp) differ in 0, 1, ... of them.

    Counted over all fingerprints: within each block of a group how many pairs
    differ in how many bits (a histogram of at most 2^``BLOCK`` values, one
    task a block), and exactly how many pairs agree on the whole group. Blocks
    of one group are taken as independent of each other for the rest.
    """
    blocks = [(g, block) for g, group in enumerate(groups) for block in _blocks(group)]

    def values(batches):
        total = np.zeros((len(blocks), 1 << BLOCK), np.int64)
        for b in batches:
            bits = _bits(b.column(0).to_numpy())
            for i, (_, block) in enumerate(blocks):
                total[i] += np.bincount(bits[:, block] @ (1 << np.arange(len(block))), minlength=1 << BLOCK)
        i, v = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(v, pa.int32()), pa.array(total[i, v])],
                                         names=["i", "v", "n"])

    def spread(table):
        i = table.column("i")[0].as_py()
        counts = np.zeros(1 << len(blocks[i][1]), np.int64)
        counts[table.column("v").to_numpy()] = table.column("n").to_numpy()
        return pa.table({"i": pa.array([i], pa.int32()), "apart": pa.array([pairs_by_distance(counts).tolist()], pa.list_(pa.float64()))})

    found = prints.select("fp").mapInArrow(values, "i int, v int, n long").groupBy("i", "v").agg(F.sum("n").alias("n"))
    apart = {r["i"]: np.maximum(r["apart"], 0.0) for r in found.groupBy("i").applyInArrow(spread, "i int, apart array<double>").collect()}
    masks = [F.struct(F.lit(g).alias("g"), F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))).cast("long")).alias("v")) for g, group in enumerate(groups)]
    same = (prints.select(F.explode(F.array(*masks)).alias("x")).groupBy("x.g", "x.v").agg(F.count("*").alias("n"))
            .groupBy("g").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs")))
    agree = {r["g"]: r["pairs"] for r in same.collect()}
    out = []
    for g, group in enumerate(groups):
        of = [apart[i] for i, (owner, _) in enumerate(blocks) if owner == g] if apart else [np.zeros(len(group) + 1)]
        n2 = max(of[0].sum(), 1.0)
        shares = of[0] / n2
        for other in of[1:]:
            shares = np.convolve(shares, other / n2)
        pairs = shares * n2
        pairs[0] = agree.get(g, 0.0)
        out.append(pairs)
    return out


def _signed(n: int) -> int:
    """An unsigned 64-bit number as a signed one."""
    return n - (1 << BITS) if n >> (BITS - 1) else n


def allocate(n: int, grouped: list[list[list[int]]], apart: list[np.ndarray], distance: int) -> list[Part]:
    """Partitions and thresholds for ``n`` fingerprints.

    ``apart``: for all groups of ``grouped`` in order, the pairs that differ
    in 0, 1, ... bits of the group. A pair that differs in e bits of a group
    of w meets in C(w - e, t - e) of its C(w, t) probes.
    """
    best: tuple[float, list[Part]] | None = None
    known = iter(apart)
    for groups in grouped:
        cost = []
        for g in groups:
            pairs = next(known)
            meet = [sum(pairs[e] * comb(len(g) - e, t - e) for e in range(t + 1)) - n * comb(len(g), t) for t in range(distance + 1)]
            cost.append([0.0] + [n * comb(len(g), t) * ROW_COST + max(meet[t], 0.0) / 2 * PAIR_COST for t in range(distance + 1)])
        # least[s]: least cost of the groups so far whose (t + 1) sum to s, and their thresholds
        least = {0: (0.0, [])}
        for row in cost:
            step: dict[int, tuple[float, list[int]]] = {}
            for s, (c, ts) in least.items():
                for share in range(distance + 2 - s):
                    new = (c + row[share], [*ts, share - 1])
                    if s + share not in step or new < step[s + share]:
                        step[s + share] = new
            least = step
        c, ts = least[distance + 1]
        if best is None or c < best[0]:
            best = c, [Part(tuple(g), t) for g, t in zip(groups, ts) if t >= 0]
    return best[1]


def plan_for(prints: DataFrame, distance: int) -> list[Part]:
    """Partitions and thresholds for all fingerprints (distinct, column fp), from counts over all of them."""
    n, both = cooccurrence(prints)
    grouped = groupings(n, both, distance)
    return allocate(n, grouped, near_counts(prints, [g for groups in grouped for g in groups]), distance)


def cooccurrence(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints (column fp) and how many have bits i and j set, over all of them."""
    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        n = 0
        for b in batches:
            x = _bits(b.column(0).to_numpy()).astype(np.float32)
            total += (x.T @ x).astype(np.int64)
            n += len(x)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array([*i, -1], pa.int32()), pa.array([*j, -1], pa.int32()),
                                          pa.array([*total[i, j], n], pa.int64())], names=["i", "j", "n"])

    both, n = np.zeros((BITS, BITS)), 0
    for r in prints.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        if r.i < 0:
            n = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    return n, both


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


# ---- probes and links
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def probes(fps: np.ndarray, plan: list[Part]) -> Iterator[tuple[np.ndarray, int]]:
    """For each masked value of each partition, the probe keys of all ``fps`` (equal values, equal keys) and the bits seen."""
    raw, tag = np.ascontiguousarray(fps, "<i8").view("<u8"), 0
    for part in plan:
        for masked in combinations(part.bits, part.threshold):
            tag += 1
            mask = sum(1 << b for b in part.bits if b not in masked)
            yield _mix((raw & np.uint64(mask)) ^ _mix(np.array([tag], "<u8"))).view("<i8"), mask


def narrower(key: np.ndarray, fps: np.ndarray, seen: int, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """The pigeonhole again within buckets whose members agree on the bits ``seen``: new keys and the bits seen by them.

    The other bits are dealt to ``distance`` + 1 groups; members within
    ``distance`` bits agree on one of the groups at least.
    """
    raw, free = np.ascontiguousarray(fps, "<i8").view("<u8"), [b for b in range(BITS) if not seen >> b & 1]
    for g in range(distance + 1):
        mask = sum(1 << b for b in free[g::distance + 1])
        own = _mix(np.ascontiguousarray(key, "<i8").view("<u8") ^ _mix(np.array([~g & (1 << BITS) - 1], "<u8")))
        yield _mix((raw & np.uint64(mask)) ^ own).view("<i8"), seen | mask


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits (unsigned: the count of a negative number is that of its absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _near_in_runs(key: np.ndarray, fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal keys (keys sorted)."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    found = []
    few = np.repeat((sizes > 1) & (sizes <= SMALL_RUN), sizes)
    k, f = key[few], fp[few]
    for lag in range(1, SMALL_RUN):
        at = np.flatnonzero(k[lag:] == k[:-lag]) if len(k) > lag else ()
        if not len(at):
            break
        at = at[(_differ(f[at], f[at + lag]) <= distance) & (f[at] != f[at + lag])]
        found.append((f[at], f[at + lag]))
    for s, size in zip(starts[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN]):
        found.append(spanning(np.unique(fp[s:s + size]), distance))
    return found


def spanning(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the components which all links within ``fps`` (distinct) would join.

    Pivots first: each takes in all that is near it. Afterwards only members
    outside the largest component can hold a link not yet followed, so each of
    these is compared with all. The result is exact; the work is near linear
    when most of the bucket is one cluster.
    """
    comp, seen = np.arange(len(fps)), np.zeros(len(fps), bool)
    u, v = [], []

    def follow(i: int) -> np.ndarray:
        near = np.flatnonzero(_differ(fps, fps[i]) <= distance)
        roots, first = np.unique(comp[near], return_index=True)
        if len(roots) > 1:
            others = near[first[roots != comp[i]]]
            u.extend([fps[i]] * len(others))
            v.extend(fps[others])
            comp[np.isin(comp, roots)] = roots[0]
        seen[i] = True
        return near

    taken = np.zeros(len(fps), bool)
    while not taken.all():
        taken[follow(int(np.argmin(taken)))] = True
    largest = np.bincount(comp).argmax()
    for i in np.flatnonzero((comp != largest) & ~seen):
        follow(int(i))
    return np.array(u, fps.dtype), np.array(v, fps.dtype)


def links(prints: DataFrame, plan: list[Part], distance: int) -> DataFrame:
    """Edges (u, v) of fingerprints (distinct, column fp): enough links to join all that are within ``distance``.

    Probe keys are counted before they are dealt. Buckets of up to ``CROWD``
    members are compared by one task each; the members of larger ones get
    narrower keys, until no bucket is crowded (at the latest when the bits
    not seen yet have no more than ``CROWD`` values).
    """
    def probe(batches):
        for b in batches:
            fps = b.column(0).to_numpy()
            for keys, seen in probes(fps, plan):
                yield rows(keys, fps, seen)

    def rows(keys, fps, seen):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps), pa.array(np.full(len(fps), _signed(seen), np.int64))],
                                          names=["key", "fp", "seen"])

    def narrow(batches):
        for b in batches:
            key, fp, seen = (c.to_numpy() for c in b.columns)
            for mask in np.unique(seen):
                of = seen == mask
                for keys, bits in narrower(key[of], fp[of], int(mask) & (1 << BITS) - 1, distance):
                    yield rows(keys, fp[of], bits)

    def verify(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)

        def edges(k, f):
            for u, v in _near_in_runs(k, f, distance):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for b in batches:
            key = np.concatenate([key, b.column(0).to_numpy()])
            fp = np.concatenate([fp, b.column(1).to_numpy()])
            if not len(key) or key[0] == key[-1]:
                continue
            last = int(np.searchsorted(key, key[-1]))  # the last run may go on
            yield from edges(key[:last], fp[:last])
            key, fp = key[last:], fp[last:]
        if len(key):
            yield from edges(key, fp)

    def compared(frame):
        return frame.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(verify, "u long, v long")

    shape = "key long, fp long, seen long"
    dealt, found = prints.select("fp").mapInArrow(probe, shape), []
    while True:
        crowded = written(dealt.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key"))
        if crowded.isEmpty():
            found.append(compared(dealt))
            return reduce(DataFrame.unionAll, found)
        found.append(compared(dealt.join(crowded, "key", "left_anti")))
        dealt = written(dealt.join(crowded, "key", "left_semi").mapInArrow(narrow, shape))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(rid, doc_id, fp) for every row of ``docs``; null text is empty (0)."""
    return per_row(numbered(docs, "rid", "doc_id", text_or_empty().alias("text")),
                   lambda: lambda rid, doc_id, text: (rid, doc_id, fingerprint(text, words)),
                   "rid long, doc_id long, fp long")


def simhash_groups(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """(rid, doc_id, fingerprint, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked when their fingerprints differ in at most
    ``distance`` bits; component_id is the smallest doc_id reachable. Equal
    fingerprints are one class, so a hot group of copies is one member of the
    search. Null and empty texts have fingerprint 0, linked like any other. A
    null doc_id counts as larger than any; a group of null ids only has a null
    component_id. ``kept`` marks one row per component (repeated rows too).
    Other columns are not read; an empty table gives no rows. Eager: the
    fingerprints and each step of the components are written.
    """
    prints = written(fingerprints(docs, words))
    classes = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"))
    roots = components(links(classes, plan_for(classes, distance), distance))
    members = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = members.groupBy("root").agg(F.min("first").alias("least"))
    placed = members.select("fp", "root").join(least, "root").select("fp", "least")
    return prints.join(placed, "fp").select(
        "rid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"), (F.col("rid") == F.col("least.rid")).alias("kept"))
