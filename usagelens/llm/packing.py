"""Packing documents into windows by non-negative least squares over length combinations.

A document's ids fill whole windows as far as they go; what is left over is
its rest. All combinations of at most ``depth`` rest lengths that exactly
fill a window are enumerated, the numbers of times each is used are solved
for against the histogram of rest lengths by non-negative least squares and
rounded down to what the histogram holds. Rests that no combination takes are
packed greedily, longest first, one after the other into windows; one that
does not fit is cut there. So only the last window of all is padded.

The histogram has at most a window of lengths, so it, the combinations and
the plan have a bound that does not depend on the number of documents.
Documents find their place in the plan by their rank among the rests of their
length, which comes from prefix sums over salted groups.
"""
from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import chunks, numbered, per_worker, text_or_empty, written

#: Fixed value: the split pattern of byte-level BPE.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are encoded in pieces of about so many characters.
PIECE = 1 << 20
#: Rests of one length that one task ranks.
GROUP = 65_536
#: Combinations that a length keeps after the first, rough solution; what the plan leaves is packed greedily.
KEEP = 12


# ---- ids
def encoding(path: str):
    """The byte-level BPE of a ``tokenizers`` file as a tiktoken encoding, which gives the same ids several times faster.

    Byte-level BPE whose ids follow the order of its merges is the same model
    in both libraries; a file of another kind raises an error.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {
        chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
             and not spec.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout"))
    if not plain or merged != sorted(merged) or len(ranks) != 256 + len(merged):
        raise ValueError(f"{path} is not a plain byte-level BPE with ids in merge order")
    return tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def document_ids(model, text: str, end_id: int) -> np.ndarray:
    """Ids of a text, special strings as special ids, then ``end_id``."""
    ids = [np.array(model.encode(piece, allowed_special="all"), "<u4") for piece in chunks(text, PIECE)]
    return np.concatenate([*ids, np.array([end_id], "<u4")])


# ---- plan
def combinations(held: np.ndarray, window: int, depth: int) -> np.ndarray:
    """All ways to fill ``window`` with up to ``depth`` (2 or 3) of the lengths that ``held`` marks, as rows (0: none)."""
    lengths = np.flatnonzero(held)
    both = lengths[(lengths <= window // 2) & held[window - lengths]]
    found = [np.column_stack([window - both, both, np.zeros_like(both)])]
    for a in lengths[lengths <= window // 3] if depth > 2 else ():
        b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
        b = b[held[window - a - b]]
        found.append(np.column_stack([window - a - b, b, np.full_like(b, a)]))
    return np.concatenate(found)


def solve(combos: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative repeat counts x that make the lengths used come near the histogram in least squares.

    Accelerated projected gradients with restarts; row s of ``combos`` names the lengths of combination s.
    """
    n, size = len(combos), len(histogram)

    def use(x):
        return sum(np.bincount(combos[:, i], x, size) for i in range(combos.shape[1])) * (np.arange(size) > 0)

    def back(r):
        return r[combos].sum(axis=1)

    r = use(np.ones(n))
    bound = back(r).max(initial=1.0)  # at least the largest eigenvalue: the matrix and its transpose are non-negative
    x = y = np.zeros(n)
    t = 1.0
    target = histogram.astype(float)
    target[0] = 0.0
    for _ in range(steps):
        slope = back(use(y) - target)
        after = np.maximum(y - slope / bound, 0.0)
        if (slope * (after - x)).sum() > 0:
            t = 1.0
        again = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = after, after + (t - 1) / again * (after - x), again
    return x


def _best(combos: np.ndarray, x: np.ndarray, keep: int) -> np.ndarray:
    """Marks the combinations that are among the ``keep`` of largest count of one of their lengths."""
    marked, order = np.zeros(len(combos), bool), np.argsort(-x, kind="stable")
    for i in range(combos.shape[1]):
        by_length = order[np.argsort(combos[order, i], kind="stable")]
        length = combos[by_length, i]
        first = np.flatnonzero(np.r_[True, length[1:] != length[:-1]])
        rank = np.arange(len(length)) - np.repeat(first, np.diff(np.r_[first, len(length)]))
        marked[by_length[rank < keep]] = True
    return marked


def plan(histogram: np.ndarray, window: int, depth: int = 3, keep: int = KEEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(combinations, repeats, left): whole repeats that use no more rests than there are, and the histogram they leave.

    All combinations are solved for roughly; each length keeps its best ones, and these are solved for finely.
    """
    combos = combinations(histogram > 0, window, depth)
    left = histogram.copy()
    if not len(combos):
        return combos, np.zeros(0, np.int64), left
    combos = combos[_best(combos, solve(combos, histogram, 60), keep)]
    x = solve(combos, histogram, 1000)
    repeats = np.zeros(len(combos), np.int64)
    uses = [np.unique(c[c > 0], return_counts=True) for c in combos]

    def take(s: int, wanted: int) -> None:
        lengths, each = uses[s]
        n = min(wanted, int((left[lengths] // each).min()))
        repeats[s] += n
        left[lengths] -= n * each

    by_count = np.argsort(-x, kind="stable").tolist()
    for s in by_count:
        take(s, int(x[s]))
    for s in np.argsort(-(x - np.floor(x)), kind="stable").tolist():
        take(s, 1)
    for s in by_count:  # what is still there in the right lengths
        take(s, int(left.max()))
    return combos, repeats, left


class Places:
    """Where the rest of a length and rank goes: sorted ranges of ranks with the window that each begins in.

    Windows of combinations come first, those of the greedy packing after them.
    """

    def __init__(self, combos: np.ndarray, repeats: np.ndarray, left: np.ndarray, window: int):
        self.window, slots, given, base = window, [], np.zeros(len(left), np.int64), 0
        for lengths, n in zip(combos[repeats > 0].tolist(), repeats[repeats > 0].tolist()):
            offset = 0
            for length in filter(None, lengths):
                slots.append((length, int(given[length]), base, offset))
                given[length] += n
                offset += length
            base += n
        self.greedy, at = base, 0
        for length in np.flatnonzero(left)[::-1].tolist():  # window -1: in a row from position ``at`` on
            slots.append((length, int(given[length]), -1, at))
            at += length * int(left[length])
        self.windows = base - (-at // window)
        slots = np.array(sorted(slots), np.int64).reshape(-1, 4)
        self.keys, self.first = (slots[:, 0] << 40) + slots[:, 1], slots[:, 1]
        self.base, self.offset = slots[:, 2], slots[:, 3]

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset, ids before the cut) of rests; what is cut off begins the next sequence."""
        slot = np.searchsorted(self.keys, (lengths << 40) + ranks, side="right") - 1
        nth, greedy = ranks - self.first[slot], self.base[slot] < 0
        at = self.offset[slot] + nth * lengths * greedy
        sequence = np.where(greedy, self.greedy + at // self.window, self.base[slot] + nth)
        offset = np.where(greedy, at % self.window, at)
        return sequence, offset, np.minimum(lengths, self.window - offset)


# ---- operator
SPARK_TOKENS = "rid long, doc_id long, doc_tokens long, start long, full long, ids binary"


def _tokenised(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """Documents as rows of at most ``window`` ids; ``full`` numbers the whole windows (null: a rest)."""
    rows = numbered(docs, "rid", F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task, done, out, size = per_worker(encoding, path), TaskContext.get().partitionId() << 33, 0, [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.binary() if i == 5 else pa.int64()) for i in range(6)],
                names=["rid", "doc_id", "doc_tokens", "start", "full", "ids"])

        for b in batches:
            for rid, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                ids = document_ids(model, text, end_id)
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    whole = len(part) == window
                    out.append((rid, doc_id, len(ids), start, task + done if whole else None, part.tobytes()))
                    done, size = done + whole, size + len(part)
                    if size > 1 << 20:
                        yield batch()
                        out, size = [], 0
        if out:
            yield batch()

    return rows.mapInArrow(run, SPARK_TOKENS)


def _ranked(rests: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(rid, size, rank): every rest numbered from 0 on among those of its length.

    A length of many rests is salted into groups of about ``GROUP``; a group's
    first rank is the sum over the groups before it.
    """
    spark = rests.sparkSession
    salts = spark.createDataFrame([(k, -(-n // GROUP)) for k, n in counts.items()], "size long, groups long")
    salted = rests.join(F.broadcast(salts), "size").select("rid", "size", F.pmod(F.xxhash64("rid"), F.col("groups")).alias("salt"))
    within = Window.partitionBy("size", "salt").orderBy("rid")
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("size", "salt").agg(F.count("*").alias("n")).select(
        "size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = salted.withColumn("nth", F.row_number().over(within) - 1)
    return inside.join(firsts, ["size", "salt"]).select("rid", "size", (F.col("first") + F.col("nth")).alias("rank"))


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, depth: int = 3) -> DataFrame:
    """(rid, doc_id, start, length, ids, doc_tokens, sequence_id, offset) per piece of ``docs`` (doc_id, text).

    ``ids``: unsigned 32-bit little-endian ids of the piece by the byte-level
    BPE at ``path``, ``end_id`` after each document. Every id lies in exactly
    one piece; pieces of a sequence follow each other without gaps. A null
    text counts as empty (one piece of the end id); null and repeated doc_ids
    are documents of their own (told apart by ``rid``); other columns are not
    read; an empty table gives no rows. All sequences are full but for one.

    Eager: the ids are written once, in rows of at most ``window``; the
    histogram of rest lengths comes to the driver, which solves for the plan.
    Whole windows are not shuffled; rests meet their places in one join.
    """
    tokens = written(_tokenised(docs, path, window, end_id))
    size = F.col("doc_tokens") % window
    rest = tokens.where(F.col("full").isNull())
    counts = {r["size"]: r["n"] for r in rest.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(window + 1, np.int64)
    histogram[list(counts)] = list(counts.values())
    places = Places(*plan(histogram, window, depth), window)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = places.of(*(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(f, pa.int64()) for f in found)],
                                             names=["rid", "sequence_id", "offset", "cut"])

    placed = _ranked(rest.select("rid", size.alias("size")), counts).mapInArrow(
        place, "rid long, sequence_id long, offset long, cut long")
    held = F.octet_length("ids") / 4
    parts = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("cut").alias("length"), "sequence_id", "offset"),
                    F.struct(F.col("cut").alias("from"), (held.cast("long") - F.col("cut")).alias("length"),
                             (F.col("sequence_id") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    rests = rest.join(placed.hint("shuffle_hash"), "rid").withColumn("p", F.explode(F.filter(parts, lambda p: p["length"] > 0)))
    whole = tokens.where(F.col("full").isNotNull()).select(
        "rid", "doc_id", "start", held.cast("long").alias("length"), "ids", "doc_tokens",
        (F.col("full") + places.windows).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(rests.select(
        "rid", "doc_id", (F.col("start") + F.col("p.from")).alias("start"), "p.length",
        F.expr("substring(ids, int(4 * p.from + 1), int(4 * p.length))").alias("ids"), "doc_tokens", "p.sequence_id", "p.offset"))


def windows(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, length, ids): the sequences themselves, ``pad_id`` after the last id of a short one.

    A sequence has at most ``window`` pieces, so no group grows with the input.
    """
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("offset", "ids"))), F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    pad = F.lit(np.full(window, pad_id, "<u4").tobytes())
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids")).select(
        "sequence_id", "length", F.concat("ids", F.substring(pad, F.lit(1), (4 * (window - F.col("length"))).cast("int"))).alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with their ids as an unsigned crc32."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
