"""Duplicates, vectors, passages, mixing and the pipeline: against plain versions, with ties, nulls and hot groups."""
import math
import random
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from usagelens.llm import common, embeddings, exact, language, mixing, passages, simhash, token_counts, trie_bpe
from usagelens.llm.queries import QUERIES, table, tokenizer

SF = "/root/testdata/sf0.001"


def real(spark, sf=SF):
    return [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]


def odd_rows(seed=2):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "Delta", "épsilon", "the", "of", "and"]
    base = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 2, 3, 9, 60, 200, 1500)]
    rows = [None, "", " ", "\t \n", *base, *base, *[b + " more" for b in base], *[b.replace(" ", "  ") for b in base]]
    rows += [base[6][:700] + " x " + base[7][100:900]] * 3 + [base[6]] * 40  # a hot group of copies
    return list(enumerate(rows))


def frame_of(spark, rows, parts=4):
    """The rows as a table with clashing columns."""
    path = tempfile.mkdtemp(prefix="usagelens-t-", dir="/tmp") + "/docs"
    spark.createDataFrame([(i, t, "x", None, 5) for i, t in rows], "doc_id long, text string, rid string, kept boolean, first int").repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


# ---- components
def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)] + [(600, j) for j in range(601, 700)] + [(9, 9)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    low = brute.classes(700, pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {i: low[i] for i in touched}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- exact
@pytest.mark.parametrize("block", [3, 64, 4096])
def test_exact_groups(spark, block):
    rows = odd_rows()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(frame_of(spark, rows), block).collect()}
    assert got == brute.exact(rows)


def test_exact_groups_when_hashes_clash(spark, monkeypatch):
    real_hash = F.xxhash64
    monkeypatch.setattr(exact, "_hash", lambda c: F.pmod(real_hash(c), F.lit(5)))  # five values: almost everything clashes
    rows = odd_rows()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(frame_of(spark, rows), 50).collect()}
    assert got == brute.exact(rows)


def test_exact_groups_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "a"), (3, "a"), (3, "a"), (None, "b"), (None, "b"), (5, "c")]
    got = exact.exact_groups(frame_of(spark, rows, 1)).collect()
    assert sorted(((str(r.doc_id), r.keep_id, r.group_size) for r in got), key=str) == sorted(
        [("None", 3, 4), ("None", 3, 4), ("3", 3, 4), ("3", 3, 4), ("None", None, 2), ("None", None, 2), ("5", 5, 1)], key=str)
    assert sum(r.kept for r in got) == 3 and not any(r.kept for r in got if r.doc_id is None and r.keep_id == 3)
    assert exact.exact_groups(frame_of(spark, [])).count() == 0


# ---- SimHash
def test_simhash_groups(spark):
    rows = real(spark, "/root/testdata/sf0.01") + [(5000 + i, t) for i, t in odd_rows()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(frame_of(spark, rows)).collect()}
    assert got == brute.simhash_groups(rows)


def test_simhash_edges(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (2, None), (None, "")]
    got = simhash.simhash_groups(frame_of(spark, rows, 1)).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == sorted([("None", 7), ("7", 7), ("7", 7), ("2", 2), ("None", 2)])
    assert sum(r.kept for r in got) == 2
    assert simhash.simhash_groups(frame_of(spark, [])).count() == 0


def test_long_texts_give_the_same_fingerprint(monkeypatch):
    text = " ".join(random.Random(1).choice(["Ab", "cd", "é", "x\ny"]) for _ in range(2000))
    monkeypatch.setattr(simhash, "CHUNK", 10)
    got = simhash.fingerprint(text)
    assert got & (1 << 64) - 1 == brute.simhash(text)


@pytest.mark.parametrize("n,correlated", [(100, False), (10**5, True), (10**8, False), (10**11, True)])
def test_every_plan_finds_every_near_pair(n, correlated):
    rng = np.random.default_rng(n % 97)
    both = np.full((64, 64), n / 4.0)
    if correlated:
        both[:20, :20] = n / 2
    both[np.diag_indices(64)] = n / 2
    grouped = simhash.groupings(n, both, 3)
    apart = [n * np.array([rng.random() if not correlated or min(g) > 20 else n / 2] + [math.comb(len(g), e) * n / 2 ** len(g) for e in range(1, len(g) + 1)])
             for groups in grouped for g in groups]
    plan = simhash.allocate(n, grouped, apart, 3)
    assert sum(p.threshold + 1 for p in plan) == 4 and len({b for p in plan for b in p.bits}) == sum(len(p.bits) for p in plan)
    a = rng.integers(-2**63, 2**63, 200)
    b = a.copy()
    for _ in range(3):
        b ^= np.left_shift(np.int64(1), rng.integers(0, 64, 200))
    met = np.zeros(200, bool)
    for (x, _), (y, _) in zip(simhash.probes(a, plan), simhash.probes(b, plan)):
        met |= x == y
    assert met.all()


def test_crowded_buckets_keep_their_components():
    rng = np.random.default_rng(4)
    for near in (8, 14, 40):
        fps = np.unique(rng.integers(0, 2**near, 300)) - 2**near // 2
        u, v = simhash.spanning(fps, 3)
        at = {f: i for i, f in enumerate(fps.tolist())}
        pairs = [(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j]) & (1 << 64) - 1).count("1") <= 3]
        assert brute.classes(len(fps), [(at[a], at[b]) for a, b in zip(u.tolist(), v.tolist())]) == brute.classes(len(fps), pairs)
        assert len(u) < len(fps)


def test_runs_across_batches(spark):
    """One fingerprint cluster with a run that spans Arrow batches."""
    rng = np.random.default_rng(0)
    fps = np.unique(np.bitwise_xor.reduce(np.left_shift(np.int64(1), rng.integers(0, 24, (3000, 3))), axis=1))
    frame = spark.createDataFrame([(int(f),) for f in fps], "fp long").repartition(6)
    plan = [simhash.Part(tuple(range(40, 56)), 0), simhash.Part(tuple(range(0, 20)), 2)]
    edges = [(r.u, r.v) for r in simhash.links(frame, plan, 3).collect()]
    at = {f: i for i, f in enumerate(fps.tolist())}
    pairs = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3)]
    assert brute.classes(len(fps), [(at[a], at[b]) for a, b in edges]) == brute.classes(len(fps), pairs)


def test_counts_of_near_pairs(spark):
    rng = np.random.default_rng(8)
    fps = np.unique(np.where(rng.random(700) < 0.4, rng.integers(0, 2**9, 700), rng.integers(-2**63, 2**63, 700)))
    frame = spark.createDataFrame([(int(f),) for f in fps], "fp long").repartition(3)
    groups = [list(range(3, 15)), [0, 1, 2, 63], list(range(64))]
    for group, got in zip(groups, simhash.near_counts(frame, groups)):
        mask = simhash._signed(sum(1 << b for b in group))
        want = np.zeros(len(group) + 1)
        for f in fps:
            want += np.bincount(np.bitwise_count(((fps ^ f) & mask).view(np.uint64)), minlength=len(group) + 1)
        if len(group) <= simhash.BLOCK:
            assert np.allclose(got, want)
        assert got[0] == want[0] and np.isclose(got[1:].sum() + want[0], len(fps) ** 2, rtol=0.2)
    assert all(not x.any() for x in simhash.near_counts(frame.limit(0), groups))


def test_correlated_bits_count_as_crowded(spark):
    """Bits 0 to 31 hold four values: as independent bits they would seem a fine partition."""
    rng = np.random.default_rng(2)
    low = rng.choice(rng.integers(0, 2**32, 4), 20_000)
    frame = spark.createDataFrame([(int(f),) for f in np.unique(low | rng.integers(-2**31, 2**31, 20_000) << 32)], "fp long")
    assert not any(p.threshold >= 0 and len(set(p.bits) - set(range(32))) < 6 for p in simhash.plan_for(frame, 3))


@pytest.mark.parametrize("crowd", [64, 400])
def test_crowded_keys_are_split_by_further_bits(spark, monkeypatch, crowd):
    """One probe key for all, many small clusters: no task gathers the key, no link is lost."""
    rng = np.random.default_rng(crowd)
    centres = rng.integers(0, 2**48, 500)
    near = np.concatenate([centres] + [centres ^ (1 << rng.integers(0, 48, 500)) ^ (1 << rng.integers(0, 48, 500)) for _ in range(3)])
    fps = np.unique(np.concatenate([near, rng.integers(0, 2**10, 900)]))
    frame = spark.createDataFrame([(int(f),) for f in fps], "fp long").repartition(5)
    plan = [simhash.Part(tuple(range(48, 64)), 0), simhash.Part(tuple(range(32, 48)), 0), simhash.Part(tuple(range(16)), 1)]
    monkeypatch.setattr(simhash, "CROWD", crowd)
    edges = [(r.u, r.v) for r in simhash.links(frame, plan, 3).collect()]
    at = {f: i for i, f in enumerate(fps.tolist())}
    pairs = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3)]
    assert brute.classes(len(fps), [(at[a], at[b]) for a, b in edges]) == brute.classes(len(fps), pairs)


def test_narrower_keys_join_every_near_pair():
    rng = np.random.default_rng(3)
    seen, free = (1 << 64) - (1 << 30), 30
    a = rng.integers(0, 2**free, 300)
    b = a.copy()
    for _ in range(3):
        b ^= 1 << rng.integers(0, free, 300)
    met, key = np.zeros(300, bool), np.zeros(300, np.int64)
    for (x, m), (y, _) in zip(simhash.narrower(key, a, seen, 3), simhash.narrower(key, b, seen, 3)):
        assert m & seen == seen and (m ^ seen).bit_count() in (7, 8)
        met |= x == y
    assert met.all()


# ---- embeddings
def vectors(seed=0, groups=40, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 8)) if g else 60):
            v = centre + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.1, 0.14])
            rows.append([float(x) for x in v])
    rows = [(i, v, int(rng.integers(0, 2)) if i % 7 else 0) for i, v in enumerate(rows)]
    n = len(rows)
    bad = [None, [0.0] * dim, [float("nan")] * dim, [None] + [1.0] * (dim - 1), [float("inf")] * dim, []]
    rows += [(n + i, v, 0) for i, v in enumerate(bad)] + [(n + 10, rows[0][1], None), (n + 11, rows[0][1], 0), (n + 12, [x * 1e200 for x in rows[0][1]], 0),
                                                        (n + 13, [1.0, 2.0], 0), (n + 14, [2.0, 4.0], 0), (n + 15, [3.0], 1), (n + 16, [4.0], 1)]
    return rows


@pytest.mark.parametrize("cell", [embeddings.CELL, 7])
def test_near_vectors(spark, cell, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", cell)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, cid string").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(frame).collect()}
    assert got == brute.near_vectors(rows)


@pytest.mark.parametrize("depth", [1, 2])
def test_near_vectors_recall_in_large_labels(spark, depth):
    """Planted pairs at cosines from 0.98 to 0.999 amid unrelated vectors, in labels of the size that has this depth."""
    rng = np.random.default_rng(22)
    dim, rows, want = 64, [], 0
    for label in (2, 3):
        alone = 1500 if depth == 1 else 2300
        a, b = embeddings.units(rng.normal(size=(200, dim))), rng.normal(size=(200, dim))
        b = embeddings.units(b - (b * a).sum(1)[:, None] * a)
        near = rng.uniform(0.9801, 0.999, 200)[:, None]
        x = np.concatenate([rng.normal(size=(alone, dim)), a, near * a + np.sqrt(1 - near ** 2) * b])
        assert embeddings.depth_of(len(x), dim) == depth
        unit = embeddings.units(x)
        want += int((unit @ unit.T >= 0.98).sum()) - len(x)
        rows += [(len(rows) + i, [float(v) for v in r], label) for i, r in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = sum(r.n_links for r in embeddings.near_vectors(frame).collect())
    assert want >= 800 and 0.99 * want <= got <= want


@pytest.mark.parametrize("depth", [3, 4])
def test_near_vectors_recall_does_not_fall_with_depth(spark, depth, monkeypatch):
    dim, pairs = 64, 400
    monkeypatch.setattr(embeddings, "CROWD", pairs * 4 / 128 ** depth)  # few vectors, as deep as a large label
    assert [embeddings.depth_of(n, dim) for n in (1, 2048, 2049, 262_144, 262_145)] == [1, 1, 2, 2, 3]
    rng = np.random.default_rng(21)
    a, b = embeddings.units(rng.normal(size=(pairs, dim))), rng.normal(size=(pairs, dim))
    b = embeddings.units(b - (b * a).sum(1)[:, None] * a)
    b = 0.9801 * a + np.sqrt(1 - 0.9801 ** 2) * b
    rows = [(int(i), [float(x) for x in v], 1) for i, v in enumerate(np.concatenate([a, b]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sum(r.n_links for r in embeddings.near_vectors(frame).collect()) == 2 * pairs


def test_near_vectors_edges(spark):
    ddl = "vec_id long, embedding array<float>, label int"
    assert embeddings.near_vectors(spark.createDataFrame([], ddl)).count() == 0
    got = embeddings.near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [2.0, 0.0], 1), (None, None, 1)], ddl)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == [
        ("4", 2, "4", True), ("4", 2, "4", True), ("None", 0, "None", True), ("None", 2, "4", False)]


# ---- passages
def test_remove_repeats(spark):
    rng = random.Random(3)
    body = ["".join(rng.choice("ab cdé") for _ in range(rng.randrange(0, 400))) for _ in range(25)]
    shared = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = odd_rows() + [(1000 + i, b) for i, b in enumerate(body)]
    rows += [(2000 + i, body[i % 25] + shared[:rng.randrange(40, 300)] + body[(i * 7) % 25]) for i in range(40)]
    rows += [(3000, "z" * 4000), (3001, "z" * 60), (3002, shared[10:59]), (3003, shared[10:60])] + [(3100 + i, shared + str(i)) for i in range(50)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in passages.remove_repeats(frame_of(spark, rows), with_bytes=True).collect()}
    for i, (n_bytes, n_removed, n_spans, kept) in brute.remove_repeats(rows).items():
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept or b"") if r.kept is not None else kept, r.kept_sha256) == (
            n_bytes, n_removed, n_spans, kept, brute.sha(kept)), i


def test_remove_repeats_in_segments_and_chunks(spark, monkeypatch):
    rows = real(spark)[:120]
    want = brute.remove_repeats(rows)
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in passages.remove_repeats(frame_of(spark, rows)).collect()}
    assert got == {i: (w[1], w[2], brute.sha(w[3])) for i, w in want.items()}
    data = " ".join(t for _, t in rows[:10]).encode()
    def windows(parts):
        return {int(s) + j: int(k) for key, start, n in parts for k, s, m in zip(key, start, n) for j in range(m)}
    whole = windows(passages.anchors(data))
    monkeypatch.setattr(passages, "SEGMENT", 256)
    cut = windows(passages.anchors(data))
    assert cut.keys() == whole.keys() == set(range(len(data) - 49))
    assert len({(data[s:s + 50], k) for s, k in whole.items()}) == len({data[s:s + 50] for s in whole})


def test_remove_repeats_null_and_repeated_ids(spark):
    text = "a passage of more than fifty bytes that many documents share, word by word"
    rows = [(None, text), (None, text), (4, text), (4, text), (9, text + "!"), (None, None), (8, text[:49])]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in passages.remove_repeats(frame_of(spark, rows, 1)).collect())
    n = len(text)
    assert got == sorted([("None", n, n, 1), ("None", n, n, 1), ("4", n, 0, 0), ("4", n, 0, 0), ("9", n + 1, n, 1), ("None", 0, 0, 0), ("8", 49, 0, 0)])
    assert passages.remove_repeats(frame_of(spark, [])).count() == 0


def hot_rows(seed=5, n=90):
    """A line that stands in every document in other surroundings, long runs of one byte, and copies of a piece."""
    rng = random.Random(seed)
    line = "this very common line stands in each of the documents, always in other words"
    piece = "".join(rng.choice("abcdefgh ") for _ in range(130))
    rows = []
    for i in range(n):
        around = ["".join(rng.choice("abcdefghijkl ") for _ in range(rng.randrange(30, 90))) for _ in range(4)]
        rows.append((i, line.join(around) + piece * (i % 3) + "=" * rng.choice((0, 49, 60, 200))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot, crowded, gathered, rows_in_batch", [(2, 3, 300, 5), (3, 20, 900, 400), (64, 1 << 14, 10_000, 10_000)])
def test_hot_minimisers_are_settled_in_batches_or_by_window(monkeypatch, hot, crowded, gathered, rows_in_batch):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "CROWDED", crowded)
    rows, tasks, seen = hot_rows(), 4, set()

    def table_of(batches):
        return pa.Table.from_batches([b for b in batches if b.num_rows])

    def exchange(parts, own, order, settled):
        """Deal rows as the operator does: by key, or anywhere if they are settled."""
        whole = table_of([b for p in parts for b in p])
        names = whole.schema.names
        rng = random.Random(1)
        to = np.array([rng.randrange(tasks) if done else hash(k) % tasks for k, done in zip(whole["key"].to_pylist(), settled(whole))])
        seen.update((own, bool(x)) for x in settled(whole))
        return [whole.filter(pa.array(to == t)).sort_by([(c, "ascending") for c in order]).select(names).to_batches(rows_in_batch)
                for t in range(tasks)]

    def texts(hits=None):
        of = [(r, d, t) for r, (d, t) in enumerate(rows)]
        if hits is None:
            return [[pa.RecordBatch.from_pydict({"rid": [r for r, _, _ in part], "text": [t for _, _, t in part]})] for part in (of[0::2], of[1::2])]
        places = {}
        for r, k, a in zip(*(hits[c].to_pylist() for c in ("rid", "key", "at"))):
            places.setdefault(r, []).append({"key": k, "at": a})
        of = [x for x in of if x[0] in places]
        return [[pa.RecordBatch.from_pydict({"rid": [r for r, _, _ in part], "doc": [d for _, d, _ in part], "text": [t for _, _, t in part],
                                             "hits": [places[r] for r, _, _ in part]})] for part in (of[0::2], of[1::2]) if part]

    def negative(t):
        return t["at"].to_numpy() < 0

    met = exchange([list(passages._known_shared(passages._gathered(passages._anchor_rows(p), gathered))) for p in texts()],
                   "shared", ["key", "rid"], negative)
    anchored = table_of([b for p in met for b in passages._shared(p)])
    met = exchange([list(passages._known_copies(passages._gathered(passages._marked(p), gathered))) for p in texts(anchored)],
                   "copies", ["key", "mark", "doc"], negative)
    settled = table_of([b for p in met for b in passages._settled(p)])
    whole = settled.filter(settled["whole"])
    met = exchange([list(passages._known_spans(passages._gathered(passages._cut_pieces(p), gathered)))
                    for p in texts(settled.filter(pa.compute.invert(settled["whole"])))],
                   "spans", ["key", "piece", "doc"], lambda t: np.array([p is None for p in t["piece"].to_pylist()]))
    compared = table_of([b for p in met for b in passages._spans(p)])
    gone = {r: set() for r in range(len(rows))}
    for r, a in zip(whole["rid"].to_pylist(), whole["at"].to_pylist()):
        gone[r].update(range(a >> 6, (a >> 6) + (a & 63) + 49))
    for r, s, e in zip(*(compared[c].to_pylist() for c in ("rid", "start", "end"))):
        gone[r].update(range(s, e))
    want = brute.remove_repeats(rows)
    for r, (doc, text) in enumerate(rows):
        kept = bytes(b for i, b in enumerate(text.encode()) if i not in gone[r])
        assert kept == want[doc][3], doc
    if hot < 64:
        assert {("shared", True), ("copies", True), ("spans", True)} <= seen
        assert (settled["at"].to_numpy() < 0).any()  # some minimiser was compared by window


def test_remove_repeats_with_hot_minimisers(spark):
    rows = hot_rows(n=500)
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in passages.remove_repeats(frame_of(spark, rows)).collect()}
    assert got == {i: (w[1], w[2], brute.sha(w[3])) for i, w in brute.remove_repeats(rows).items()}


def test_suffix_ranks_follow_the_suffixes():
    data = bytes(random.Random(1).choices(b"ab\x00", k=300))
    rank = passages.suffix_ranks(np.frombuffer(data, np.uint8), 50)
    for i in range(251):
        for j in range(0, 251, 13):
            a, b = data[i:i + 50], data[j:j + 50]
            assert (rank[i] < rank[j], rank[i] == rank[j]) == (a < b, a == b)


def shared_bytes(a, b, width):
    n = 0
    while n < width and a[n:n + 1] == b[n:n + 1] and a[n:n + 1]:
        n += 1
    return n


@pytest.mark.parametrize("seed, letters, size, documents", [(0, b"ab", 400, 6), (1, b"a", 150, 4), (2, b"abcdef", 600, 40),
                                                             (3, bytes(range(256)), 300, 300), (4, b"ab\0", 300, 1), (5, b"xy", 80, 80)])
def test_previous_factors_are_the_longest(seed, letters, size, documents):
    rng, width = random.Random(seed), 12
    data = bytearray(rng.choice(letters) for _ in range(size))
    data[size // 2:size // 2 + 40] = data[:40]
    data = bytes(data)
    starts = np.array(sorted(rng.sample(range(size - width + 1), size * 2 // 3)))
    docs = np.array([rng.randrange(documents) * 10**15 - 7 for _ in starts])
    got = passages.previous_factors(np.frombuffer(data, np.uint8), starts, docs, width)
    want = [max([shared_bytes(data[s:], data[t:], width) for t, e in zip(starts, docs) if e < d], default=0) for s, d in zip(starts, docs)]
    assert got.tolist() == want


def test_previous_factors_of_nothing_and_of_one():
    data = np.frombuffer(b"a" * 60, np.uint8)
    none = np.empty(0, np.int64)
    assert passages.previous_factors(data, none, none, 50).tolist() == []
    assert passages.previous_factors(data, np.array([3]), np.array([9]), 50).tolist() == [0]


def test_repeated_windows_of_many_equal_pieces():
    rng = random.Random(5)
    text = bytes(rng.randrange(97, 123) for _ in range(90))
    pieces = [text[i % 20:i % 20 + 60 + i % 10] + bytes([i % 7]) for i in range(300)]
    docs = np.array([rng.randrange(1000) for _ in pieces])
    owner, offset = passages.repeated_windows(pieces, docs)
    first = {}
    for p, d in zip(pieces, docs.tolist()):
        for o in range(len(p) - 49):
            first[p[o:o + 50]] = min(d, first.get(p[o:o + 50], d))
    want = {(i, o) for i, p in enumerate(pieces) for o in range(len(p) - 49) if first[p[o:o + 50]] < docs[i]}
    assert set(zip(owner.tolist(), offset.tolist())) == want and len(owner) == len(want)


def test_remove_repeats_keeps_the_largest_id_apart_from_null(spark):
    text = "a passage of more than fifty bytes that is written in all of these rows"
    rows = [((1 << 63) - 1, text), (None, text), (4, "short")]
    got = passages.remove_repeats(frame_of(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == sorted([(str((1 << 63) - 1), 0), ("None", 0), ("4", 0)])


def test_a_frame_whose_rows_move_is_noticed(spark):
    frame = frame_of(spark, odd_rows())
    moving = frame.select("doc_id", "text", F.rand().alias("r")).repartition(3).sortWithinPartitions("r").select("doc_id", "text")
    with pytest.raises(Exception, match="rows changed places"):
        for _ in range(5):
            passages.remove_repeats(moving).collect()


# ---- mixing
def test_targets_are_shared_under_the_caps():
    sizes = [1000, 10, 500, 0, 3000, 70]
    t = mixing.targets(sizes)
    assert all(x <= 2 * s for x, s in zip(t, sizes)) and abs(sum(t) - 1.5 * sum(sizes)) < 1e-6
    free = [i for i, s in enumerate(sizes) if t[i] < 2 * s]
    share = {t[i] / (5, 2, 1)[i % 3] for i in free}
    assert max(share) - min(share) < 1e-6
    assert np.allclose(t, brute.targets(sizes))
    assert mixing.targets([]) == [] and mixing.targets([0]) == [0.0]


def test_splitting_tree_keeps_the_quotas():
    q = [1000, 3, 0, 77]
    out = mixing.split_quotas(q, 13, 5)
    assert out.sum(axis=1).tolist() == q and (out >= 0).all() and np.ptp(out.sum(axis=0)) <= 2
    assert (out == mixing.split_quotas(q, 13, 5)).all()
    assert abs(out[0] / out.sum(axis=0) - 1000 / 1080).max() < 0.12


def test_mix_of_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.taken(*mixing.mix(docs)).collect()
    again = mixing.taken(*mixing.mix(docs.repartition(5).select("text", "source", "doc_id"))).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    texts = {r.doc_id: (r.source, len(brute.WORD.findall(r.text or ""))) for r in docs.collect()}
    by = {}
    for r in rows:
        source, size = texts[r.doc_id]
        assert r.size == size and r.taken in (0, size, 2 * size)
        b = by.setdefault(source, [0, 0, r.target, r.source_size])
        b[0] += size
        b[1] += r.taken
    order = sorted(by)
    want = brute.targets([by[s][0] for s in order])
    for s, t in zip(order, want):
        assert by[s][0] == by[s][3] and abs(by[s][2] - t) < 1e-6 and abs(by[s][1] - t) <= max(0.005 * t, 2), (s, by[s])


def test_mix_edges(spark):
    ddl = "doc_id long, text string, source string, place int, size int"
    rows = [(1, "a b c", "s", 1, 1), (1, "a b c", "s", 1, 1), (None, "d e", None, 1, 1), (None, None, None, 1, 1), (3, "", "empty", 1, 1)]
    sizes, plan = mixing.mix(spark.createDataFrame(rows, ddl))
    got = mixing.taken(sizes, plan).collect()
    assert len(got) == 5 and {r.target for r in got if r.size == 0 and r.doc_id == 3} == {0.0}
    assert all(r.taken <= 2 * r.size for r in got)
    assert mixing.mixed_documents(spark.createDataFrame(rows, ddl), plan, (1, 1)).columns == ["doc_id", "text", "source", "place", "size"]
    empty = mixing.mix(spark.createDataFrame([], ddl))
    assert mixing.taken(*empty).count() == 0 and mixing.parts_of(empty[1], empty[0]) == (1, 1)


def test_rows_of_one_id_spread_over_the_blocks(spark):
    docs = spark.createDataFrame([(7, "a b c", "s")] * 400, "doc_id long, text string, source string")
    sizes, plan = mixing.mix(docs)
    assert plan.groupBy("copy").count().orderBy("copy").collect() == [(0, 400), (1, 200)]
    assert plan.where("copy = 0").select("key").distinct().count() == 400


def test_long_words_are_not_remembered():
    counter = token_counts.PieceCounter(tokenizer("piece_bpe_32k.model"))
    text = "ab" * 400 + " cd " + "ab" * 400
    assert counter.count(text) == counter.count(text) and max(map(len, counter)) <= token_counts.LONGEST
    bpe = trie_bpe.WordBpe(tokenizer("word_bpe_49k.json"))
    assert bpe.encode(text) == bpe.encode(text) and max(map(len, bpe.cache)) <= trie_bpe.LONGEST
    parser = language.Parser(language.Sample(("x",), (("abc", "cd"),)))
    assert parser.predict(text) == parser.predict(text) and max(map(len, parser)) <= language.LONGEST


def test_mix_equals_its_words_in_any_number_of_shards(spark, monkeypatch):
    """Taken words against a plain count of the written copies; shards and slices only deal them out."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    size = {r.doc_id: r.size for r in mixing.document_sizes(docs).collect()}
    seen = []
    for words, draws in ((4_000_000, 4), (20_000, 4), (5_000, 40)):
        monkeypatch.setattr(mixing, "SHARD_WORDS", words)
        monkeypatch.setattr(mixing, "SHARD_DRAWS", draws)
        sizes, plan = mixing.mix(docs)
        parts = mixing.parts_of(plan, sizes)
        mixed = mixing.mixed_documents(docs, plan, parts).select("doc_id", F.spark_partition_id().alias("p")).collect()
        taken = {r.doc_id: r.taken for r in mixing.taken(sizes, plan).collect()}
        copies = {}
        for r in mixed:
            copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert {i: size[i] * copies.get(i, 0) for i in size} == taken and max(copies.values()) <= 2
        in_part = {}
        for r in mixed:
            in_part[r.p] = in_part.get(r.p, 0) + size[r.doc_id]
        total = sum(in_part.values())
        assert parts[0] * parts[1] >= min(total / words, 1) and len(in_part) <= parts[0] * parts[1]
        assert max(in_part.values()) <= 6 * max(total / (parts[0] * parts[1]), max(size.values()))
        seen.append((taken, parts))
    assert seen[0][0] == seen[1][0] == seen[2][0] and seen[0][1] == (1, 1) and seen[1][1][0] > 4 and seen[2][1][1] > 1


# ---- pipeline
def test_pipeline_against_plain_stages(spark, scratch):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_dedup", "source_mixing", "bpe_round_trip"] and corpus_pipeline.ORACLE_SQL is None
    src = table(spark, SF, "documents")
    extra = spark.createDataFrame([(900_001, "1234 !!", None, "src0", 7), (900_002, None, "en", None, 0)], src.schema)
    src.unionByName(extra).write.parquet(f"{scratch}/0")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{scratch}/0").collect()]
    docs = spark.read.parquet(f"{scratch}/0")
    plain = [r for r in rows if brute.has_letter(r[1])]
    steps = [plain, [r for r in plain if brute.exact(plain)[r[0]][2]]]
    near = brute.simhash_groups(steps[1])
    steps.append([r for r in steps[1] if near[r[0]][1] == r[0]])
    for k, want in enumerate(steps):
        out = corpus_pipeline.STAGES[k][1](spark, docs, SF)
        assert out.columns == src.columns
        out.write.parquet(f"{scratch}/{k + 1}")
        docs = spark.read.parquet(f"{scratch}/{k + 1}")
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(want)
    sizes, plan = mixing.mix(docs)
    copies = {r.doc_id: r.taken // r.size for r in mixing.taken(sizes, plan).collect() if r.size}
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == src.columns
    texts = dict(steps[-1])
    got = sorted((r.doc_id, r.text) for r in mixed.collect())
    assert [g for g in got if texts[g[0]].split()] == sorted((i, texts[i]) for i, n in copies.items() for _ in range(n))
    mixed.write.parquet(f"{scratch}/4")
    last = corpus_pipeline.STAGES[4][1](spark, spark.read.parquet(f"{scratch}/4"), SF).collect()
    digest = trie_bpe.word_bpe(tokenizer("word_bpe_49k.json")).digest
    assert sorted(map(tuple, last)) == sorted((i, *digest(t)) for i, t in got)


def test_pipeline_of_an_empty_table(spark, scratch):
    import corpus_pipeline

    spark.createDataFrame([], table(spark, SF, "documents").schema).write.parquet(f"{scratch}/documents.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0


def test_pipeline_query_runs_and_reruns_alike(spark):
    a, b = (sorted(map(tuple, QUERIES["pipeline"](spark, SF).collect())) for _ in range(2))
    assert a == b and len(a) > 100
