"""Centroids, vector codes and packing: against plain versions, with ties, odd rows and whole numbers of any size."""
import hashlib
import json
import random
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from usagelens.llm import centroids, packing, vector_codes
from usagelens.llm.queries import table, tokenizer

SF = "/root/testdata/sf0.001"
BYTES = "byte_bpe_50k.json"


def plain_nearest(x, centres):
    """All distances in Python's whole numbers; min() keeps the first of equals."""
    out = []
    for row in x:
        d = [sum((int(a) - int(b)) ** 2 for a, b in zip(row, c)) for c in centres]
        out.append((d.index(min(d)), min(d)))
    return out


def plain_floor(vec, scale):
    from fractions import Fraction
    from math import floor

    return [floor(Fraction(v) * scale) for v in vec]


# ---- centroids
def test_transform_keeps_distances_and_order():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (50, 64))
    y = centroids.walsh(x)
    assert y.dtype == np.int64 and ((y[:25] - y[25:]) ** 2).sum(1).tolist() == (64 * ((x[:25] - x[25:]) ** 2).sum(1)).tolist()
    assert sorted(centroids.coarse_to_fine(64)) == list(range(64)) and (y[:, 0] == x.sum(1)).all()
    changes = (np.diff(centroids.hadamard(np.eye(64)), axis=1) != 0).sum(1)[centroids.coarse_to_fine(64)]
    assert changes.tolist() == list(range(64))


@pytest.mark.parametrize("kind", [np.int64, object])
def test_progressive_search_is_exact(kind):
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3, 3, (300, 16)), rng.integers(-3, 3, (12, 16))  # small numbers: many ties
    c[7] = c[2]
    grow = 10 ** 14 if kind is object else 1
    x, c = x.astype(kind) * grow, c.astype(kind) * grow
    place, distance = centroids.nearest(centroids.walsh(x), centroids.walsh(c))
    assert list(zip(place.tolist(), [int(d) for d in distance])) == plain_nearest(x, c)


def vector_rows(seed=3, n=120, dim=64, big=0):
    rng = np.random.default_rng(seed)
    heart = rng.normal(size=(6, dim))
    rows = [(int(i), [float(v) for v in heart[i % 6] + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.5])], int(i % 3) if i % 7 else None)
            for i in range(n)]
    rows += [(5, rows[9][1], 1), (5, rows[5][1], 1), (None, rows[3][1], None), (None, rows[4][1], 2)]  # repeated and null ids
    if big:
        rows += [(900, [big * v for v in rows[0][1]], 1), (901, [-big / 2 * v for v in rows[1][1]], 0)]
    return rows


BAD = [(700, None, 1), (701, [1.0] * 63 + [None], 1), (702, [1.0] * 63 + [float("nan")], 2), (703, [float("inf")] + [1.0] * 63, 1)]
DDL = "vec_id long, embedding array<double>, label int, cluster string, codes int, vec string"


def frame_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL).repartition(parts)


def plain_means(members, old):
    return [[sum(m[i] for m in of) // len(of) for i in range(len(o))] if of else o for of, o in zip(members, old)]


@pytest.mark.parametrize("big", [0, 3e6])
def test_cluster_vectors(spark, big):
    rows = vector_rows(big=big)
    odd = BAD + [(704, [1.0] * 32, 1), (705, [], 0)]
    name = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "")
    ints = {k: plain_floor(r[1], 256) for k, r in enumerate(rows)}
    first = sorted(range(len(rows)), key=lambda k: (name(rows[k][0]), rows[k][1]))[:9]
    centres = [ints[k] for k in first]
    for _ in range(3):
        at = plain_nearest(ints.values(), centres)
        centres = plain_means([[ints[k] for k in ints if at[k][0] == c] for c in range(9)], centres)
    want = sorted((str(rows[k][0]), *p) for k, p in enumerate(plain_nearest(ints.values(), centres)))
    assigned, got = centroids.cluster_vectors(frame_of(spark, rows + odd), k=9, rounds=3)
    assert got == centres and sorted((str(r.vec_id), r.cluster, r.distance) for r in assigned.collect()) == want
    digest = centroids.digests(assigned, got).collect()
    assert len(digest) == len(rows) and {r.inertia for r in digest} == {sum(w[2] for w in want)}
    for r in digest:
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_cluster_vectors_few_and_none(spark):
    assigned, centres = centroids.cluster_vectors(frame_of(spark, BAD))
    assert centres == [] and assigned.count() == 0 and centroids.digests(assigned, centres).count() == 0
    same = [(i, [0.5] * 64, 1) for i in range(30)]  # every centroid alike: all ties go to the first
    assigned, centres = centroids.cluster_vectors(frame_of(spark, same), k=5)
    assert centres == [[128] * 64] * 5 and {(r.cluster, r.distance) for r in assigned.collect()} == {(0, 0)}


def test_cluster_vectors_takes_floats(spark):
    rows = [(r[0], [float(np.float32(v)) for v in r[1]]) for r in vector_rows()]
    got = [centroids.cluster_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"), k=4, rounds=2)[1]
           for kind in ("float", "double")]
    assert got[0] == got[1]


# ---- vector codes
@pytest.mark.parametrize("kind", [float, object])
def test_balls_find_what_all_entries_give(kind):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-4, 4, (400, 4)), rng.integers(-400, 400, (400, 4))]).astype(kind)
    books = np.concatenate([rng.integers(-4, 4, (30, 4)), rng.integers(-400, 400, (30, 4))]).astype(kind)
    books[20], books[3] = books[5], books[50]
    want = plain_nearest(x, books)
    assert [(int(p), int(d)) for p, d in zip(*vector_codes.nearest_of_all(x, books))] == want
    for own in (np.array([w[0] for w in want]), rng.integers(0, 60, len(x))):  # a good start and any start
        far = [max([int(((x[i] - books[j]) ** 2).sum()) for i in np.flatnonzero(own == j)], default=0) for j in range(60)]
        reach = [int(np.sqrt(f)) + 1 for f in far]
        assert [(int(p), int(d)) for p, d in zip(*vector_codes.Balls(books, reach).nearest(x, own))] == want


def test_balls_compare_little():
    rng = np.random.default_rng(5)
    books = rng.integers(-1000, 1000, (256, 16)).astype(float)
    own = rng.integers(0, 256, 5000)
    x = books[own] + rng.integers(-40, 40, (5000, 16))
    far = [max(((x[own == j] - books[j]) ** 2).sum(1), default=0) for j in range(256)]
    balls = vector_codes.Balls(books, [int(np.sqrt(f)) + 1 for f in far])
    assert sum(map(len, balls.near)) == 0  # balls far apart: every part lies in a stable core
    place, _ = balls.nearest(x, own)
    assert (place == own).all()


@pytest.mark.parametrize("big", [0, 1e5])
def test_compress(spark, big):
    rows = vector_rows(seed=6, big=big)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    cut = [[plain_floor(r[1], 1024)[p * 16:(p + 1) * 16] for r in rows] for p in range(4)]
    books, final = [], []
    for p in range(4):
        book = [cut[p][k] for k in order[:20]]
        for _ in range(3):
            at = plain_nearest(cut[p], book)
            book = plain_means([[cut[p][k] for k in range(len(rows)) if at[k][0] == j] for j in range(20)], book)
        books.append(book)
        final.append(plain_nearest(cut[p], book))
    want = sorted((str(r[0]), str(r[2]), "".join(f"{final[p][k][0]:02x}" for p in range(4)), sum(final[p][k][1] for p in range(4)))
                  for k, r in enumerate(rows))
    coded, got = vector_codes.compress(frame_of(spark, rows + BAD), entries=20, rounds=3)
    assert got == books
    digest = vector_codes.digests(coded, got).collect()
    label = {}
    for _, lab, _, error in want:
        label[lab] = label.get(lab, 0) + error
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in digest) == sorted((i, c, e, label[lab]) for i, lab, c, e in want)
    flat = ",".join(str(v) for b in books for e in b for v in e)
    assert {r.codebooks_sha256 for r in digest} == {hashlib.sha256(flat.encode()).hexdigest()}


def test_compress_odd_lengths(spark):
    assert vector_codes.digests(*vector_codes.compress(frame_of(spark, BAD))).count() == 0
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 0), (2, [1.0, 2.0], 0), (3, [], None), (4, [1.0, 2.0, 3.0, 5.0], None)]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in vector_codes.digests(*vector_codes.compress(frame_of(spark, rows))).collect()}
    assert got == {1: ("00000000", 0, 0), 2: (None, None, 0), 3: (None, None, 0), 4: ("00000001", 0, 0)}
    coded, books = vector_codes.compress(frame_of(spark, [(1, [1.0, 2.0, 3.0], 0)]))
    assert books == [[]] * 4 and [r.code for r in vector_codes.digests(coded, books).collect()] == [None]


# ---- packing
@pytest.fixture(scope="module")
def reference_ids():
    model = Tokenizer.from_file(tokenizer(BYTES))
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 1]


def texts_of(seed, n, long=2):
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "délta", "  ", "\n", "12", "x'll", "<|endoftext|>", "数", "🙂", "the", "of", "of"]
    rows = [None, "", " ", *(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(n))]
    return rows + [" ".join(rng.choice(words) for _ in range(900)) for _ in range(long)]


def check_pieces(rows, pieces, reference_ids, window):
    """Every id in one piece, ids right, sequences gapless and full but for one."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.rid, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    got = []
    for of in by_doc.values():
        of.sort(key=lambda p: p.start)
        ids = [int(i) for p in of for i in np.frombuffer(p.ids, "<u4")]
        assert [p.start for p in of] == [sum(q.length for q in of[:k]) for k in range(len(of))]
        assert {p.doc_tokens for p in of} == {len(ids)} and all(len(p.ids) == 4 * p.length and p.length > 0 for p in of)
        got.append((str(of[0].doc_id), ids))
    assert sorted(got) == sorted((str(i), reference_ids(t)) for i, t in rows)
    short = 0
    for of in by_sequence.values():
        of.sort(key=lambda p: p.offset)
        assert [p.offset for p in of] == [sum(q.length for q in of[:k]) for k in range(len(of))]
        size = sum(p.length for p in of)
        assert size <= window
        short += size < window
    assert short <= 1
    return by_sequence


def doc_frame(spark, rows, parts=4):
    path = tempfile.mkdtemp(prefix="usagelens-t-", dir="/tmp") + "/docs"
    spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, ids string, rid int, start int").repartition(
        parts).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("window, group", [(32, packing.GROUP), (64, 3)])
def test_pack(spark, reference_ids, window, group, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", group)  # hot lengths cut into many salted groups
    rows = list(enumerate(texts_of(7, 150))) + [(3, "same same"), (3, "same same"), (None, "of"), (None, None)]
    rows += [(500 + i, "one two three four five") for i in range(100)]  # a hot length that no combination takes
    frame = doc_frame(spark, rows)
    pieces = packing.pack(frame, tokenizer(BYTES), window=window)
    by_sequence = check_pieces(rows, pieces.collect(), reference_ids, window)
    made = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.windows(pieces, window, pad_id=9).collect()}
    assert made.keys() == by_sequence.keys()
    for k, of in by_sequence.items():
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in of])
        assert made[k].tolist() == [*ids.tolist(), *[9] * (window - len(ids))]


def test_pack_given_documents(spark, reference_ids):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack(docs, tokenizer(BYTES))
    check_pieces(rows, pieces.collect(), reference_ids, 2048)
    for r in packing.digests(pieces).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(reference_ids(dict(rows)[r.doc_id])[r.start:r.start + r.length], "<u4").tobytes())


def test_pack_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    pieces = packing.pack(none, tokenizer(BYTES))
    assert pieces.count() == 0 and packing.windows(pieces).count() == 0 and packing.digests(pieces).count() == 0


def test_ids_of_any_character(reference_ids):
    model = packing.encoding(tokenizer(BYTES))
    rng = random.Random(8)
    for _ in range(200):
        text = "".join(chr(c) for c in (rng.randrange(0x3000) if rng.random() < 0.7 else rng.choice([32, 10, 0x3042, 0x1F600 + rng.randrange(64)])
                                        for _ in range(rng.randrange(200))) if not 0xD800 <= c < 0xE000)
        assert packing.document_ids(model, text, 1).tolist() == reference_ids(text)


def test_long_texts_encode_in_pieces(reference_ids, monkeypatch):
    monkeypatch.setattr(packing, "PIECE", 50)
    model = packing.encoding(tokenizer(BYTES))
    for text in [*texts_of(9, 20), "a" * 500, " " * 300, "word " * 200, ("x" * 49 + "  y \n z ") * 9]:
        assert packing.document_ids(model, text or "", 1).tolist() == reference_ids(text)


def test_encoding_refuses_other_models(tmp_path):
    with pytest.raises(ValueError):
        packing.encoding(tokenizer("word_bpe_49k.json"))
    spec = json.load(open(tokenizer(BYTES), encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        packing.encoding(str(path))


def test_combinations_are_all_that_fill_the_window():
    held = np.zeros(31, bool)
    held[[1, 2, 5, 9, 10, 14, 15, 20, 21, 25, 28, 29]] = True
    lengths = np.flatnonzero(held)
    want = {(int(a), 0, 0) for a in lengths if a == 30} | {
        tuple(sorted((int(a), int(b)), reverse=True)) + (0,) for a in lengths for b in lengths if a + b == 30} | {
        tuple(sorted(map(int, (a, b, c)), reverse=True)) for a in lengths for b in lengths for c in lengths if a + b + c == 30}
    got = [tuple(sorted(c, reverse=True)) for c in packing.combinations(held, 30, 3).tolist()]
    assert len(got) == len(set(got)) and set(got) == want


def test_plan_meets_the_histogram_and_never_overdraws():
    rng = np.random.default_rng(10)
    histogram = np.zeros(65, np.int64)
    for combo in packing.combinations(np.ones(65, bool) & (np.arange(65) > 0), 64, 3)[rng.integers(0, 300, 40)]:
        for length in combo[combo > 0]:  # made from windows that combinations fill, so an exact solution exists
            histogram[length] += 1000
    combos, repeats, left = packing.plan(histogram, 64)
    used = np.zeros(65, np.int64)
    for c, n in zip(combos, repeats):
        np.add.at(used, c[c > 0], n)
    assert (used + left == histogram).all() and (left >= 0).all() and left.sum() < 0.02 * histogram.sum()
    combos, repeats, left = packing.plan(np.bincount([40] * 7, minlength=65), 64)  # nothing fills a window
    assert not len(combos) and left[40] == 7


def test_solver_against_plain_descent():
    rng = np.random.default_rng(11)
    histogram = np.r_[0, rng.integers(0, 50, 12)]
    combos = packing.combinations(histogram > 0, 12, 3)
    matrix = np.zeros((13, len(combos)))
    for s, c in enumerate(combos):
        np.add.at(matrix[:, s], c[c > 0], 1)
    x = np.zeros(len(combos))
    for _ in range(200_000):  # one coordinate after another, to its best non-negative value
        s = _ % len(x)
        x[s] = max(0.0, x[s] - matrix[:, s] @ (matrix @ x - histogram) / (matrix[:, s] @ matrix[:, s]))
    off = lambda v: float(((matrix @ v - histogram) ** 2).sum())
    assert off(packing.solve(combos, histogram, 3000)) <= off(x) + 1e-3


def test_queries_have_the_contract_columns(spark):
    from usagelens.llm.queries import QUERIES

    types = {name: {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SF).schema} for name in (
        "op11_centroid_clustering", "op12_vector_codes", "op13_packing")}
    assert types["op11_centroid_clustering"] == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
                                                "inertia": "bigint", "centroid_sha256": "string"}
    assert types["op12_vector_codes"] == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint",
                                         "codebooks_sha256": "string"}
    assert types["op13_packing"] == {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                                    "sequence_id": "bigint", "offset": "bigint"}
