"""Packing, the Merkle manifest and hard negatives against brute force, and their odd inputs."""

import hashlib
import itertools
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentionflow.llm import hard_negatives, merkle, packing, queries
from mentionflow.session import materialize

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977}" for i in range(9_000))
TEXTS = [(1, "One two three."), (2, None), (3, ""), (4, "  \n\t  x "), (5, "tie tie"), (5, "tie tie"), (None, "no id"), (7, LONG), (8, LONG + " end"),
         (9, "É é ß İ 漢字 😀 ­ ᠎  words"), (10, "a<|endoftext|>b  'll don't"), (11, "𞤀𞤢 ꭓ word")]


# --- 11 ---

def true_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_those_of_the_tokenizer(spark):
    docs = spark.createDataFrame([(*r, 1, 1) for r in TEXTS], "doc_id long, text string, ids int, salt int")
    found = packing.token_pieces(docs, TOKENIZER, keep_ids=True).collect()
    whole = {}
    for r in found:
        whole.setdefault((r.doc_id, r.salt), {})[r.piece] = r
    assert len(whole) == len(TEXTS)
    for (doc_id, _), pieces in whole.items():
        ids = [t for k in sorted(pieces) for t in pieces[k].ids]
        assert ids in [true_ids(t) for i, t in TEXTS if i == doc_id]
        for k, r in pieces.items():
            assert r.start == sum(pieces[j].length for j in range(k)) and r.length == len(r.ids) <= packing.CAPACITY
            assert k == 0 or r.length == packing.CAPACITY
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
    assert packing.token_pieces(docs.limit(0), TOKENIZER).isEmpty()


def test_cuts_cover_a_document():
    for length in (1, 2, 9, 10, 11, 19, 20, 21, 35):
        cut = packing.cuts(length, 10)
        assert [s for s, _ in cut] == list(itertools.accumulate([0, *[n for _, n in cut[:-1]]])) and sum(n for _, n in cut) == length
        assert all(n == 10 for _, n in cut[1:]) and 0 < cut[0][1] <= 10


def fewest(lengths, capacity):
    """Fewest bins by trying all places of each piece."""
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for b in {r: i for i, r in enumerate(rooms) if r >= lengths[k]}.values():
            rooms[b] -= lengths[k]
            place(k + 1, rooms)
            rooms[b] += lengths[k]
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_bound_optimum_and_best_fit_are_in_order():
    rng, tight = random.Random(1), 0
    for _ in range(60):
        capacity = rng.choice([10, 12, 17])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        bins, offsets, rooms = packing.best_fit(np.array(lengths), capacity)
        bound = packing.least_bins(np.bincount(lengths, minlength=capacity + 1), capacity)
        optimum = fewest(lengths, capacity)
        assert bound <= optimum <= len(rooms)
        tight += bound == optimum
        for b in range(len(rooms)):
            inside = sorted((offsets[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
            assert [o for o, _ in inside] == list(itertools.accumulate([0, *[n for _, n in inside[:-1]]]))
            assert sum(n for _, n in inside) + rooms[b] == capacity
    assert tight > 50
    assert packing.least_bins(np.zeros(11, "i8"), 10) == 0
    # pieces above half need a bin each, which their sum alone does not show
    assert packing.least_bins(np.bincount([6] * 10, minlength=11), 10) == 10


def pieces_of(spark, lengths):
    rows = [(k // 2, k % 2, 0, n, 7, 0) for k, n in enumerate(lengths)]
    return spark.createDataFrame(rows, packing.PIECES)


@pytest.mark.parametrize("part", [50, 10_000])
def test_packing_is_gapless_and_near_its_bound(spark, monkeypatch, part):
    monkeypatch.setattr(packing, "PART_PIECES", part)
    rng = random.Random(part)
    lengths = [min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(900)] + [2048] * 5
    packed = packing.pack(pieces_of(spark, lengths)).toPandas()
    assert sorted(packed["length"]) == sorted(lengths)
    ordered = packed.sort_values(["sequence_id", "offset"])
    groups = ordered.groupby("sequence_id")["length"]
    assert (groups.cumsum() - ordered["length"] == ordered["offset"]).all() and groups.sum().max() <= 2048
    bound = packing.least_bins(np.bincount(lengths, minlength=2049), 2048)
    assert bound <= packed["sequence_id"].nunique() <= bound + 2
    assert set(packed["certified"]) <= {True, False}


def test_exchange_saves_sequences(spark, monkeypatch):
    """Many partitions with a loose sequence each: their pieces meet and fill up."""
    monkeypatch.setattr(packing, "PART_PIECES", 32)
    packed = packing.pack(pieces_of(spark, [300] * 240)).toPandas()
    assert packed["sequence_id"].nunique() == 40
    assert (packed["sequence_id"] >= 1 << 50).any()


def test_sequences_hold_all_ids(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    pieces = materialize(packing.token_pieces(docs, TOKENIZER, keep_ids=True), "test-pieces")
    packed = packing.pack(pieces)
    whole = packing.sequences(pieces, packed).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(true_ids(t)) for _, t in TEXTS)
    assert max(len(r.ids) for r in whole) <= packing.CAPACITY and len({r.sequence_id for r in whole}) == len(whole)
    assert packing.pack(pieces.limit(0)).isEmpty()


# --- 12 ---

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    paths, at, now = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(now) > 1:
        above, of = [], []
        for k in range(0, len(now), 3):
            run = now[k:k + 3]
            for j in range(len(run)):
                for i in at[k + j]:
                    paths[i].append((run[:j], run[j + 1:]))
            above.append(h("".join(run)))
            of.append(sum(at[k:k + 3], []))
        now, at = above, of
    return now[0], paths


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, hash of the proof), as a sorted list."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h("".join(map(part, r))), r[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(groups[s]), *brute_tree([x[2] for x in sorted(groups[s])])) for s in order]
    root, tops = brute_tree([t[1] for t in trees]) if trees else (None, [])
    return sorted(((doc_id, leaf, sub, root, h("".join("".join(a + b) for a, b in path + top)))
                   for (leaves, sub, paths), top in zip(trees, tops) for (_, _, leaf, doc_id), path in zip(leaves, paths)), key=str)


ROWS = "doc_id long, source string, lang string, n_chars long, text string"


def manifested(spark, rows):
    made = merkle.manifest(spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS + ", key int, tree string"), queries.LEAF_FIELDS)
    return sorted((tuple(r) for r in made.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof"))).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [3], [1, 1], [2, 1, 4], [730, 1, 5, 28, 3], [9, 9, 9, 9, 9, 9, 9, 1]])
def test_manifest_is_that_of_brute_force(spark, sizes):
    rows = [(100 * s + k, None if s == 2 else f"s{s}", "en", k, f"text {k}" * (k % 4)) for s, n in enumerate(sizes) for k in range(n)]
    random.Random(0).shuffle(rows)
    assert manifested(spark, rows) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark, monkeypatch):
    rows = [(1, "a", None, None, None), (1, "a", None, None, None), (1, "a", "en", 1, "other"), (None, "a", "en", 2, "x"), (None, None, "en", 2, ""),
            (2, "", "en", 3, LONG), (3, "é", "en", 1, "é\n漢"), (4, "z", "en", 1, "z")]
    assert manifested(spark, rows) == brute_manifest(rows)
    assert manifested(spark, []) == []
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", -1)  # the joins that shuffle
    assert manifested(spark, rows) == brute_manifest(rows)


def test_tampering_shows(spark, sf_dir):
    found = queries.op12_merkle(spark, sf_dir).collect()
    changed = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if "\n" in (r.text or "") and zlib.crc32(str(r.doc_id).encode()) % 2 == 0}
    assert {r.doc_id for r in found if not r.verified} == changed and changed and len(changed) < len(found)
    assert all((r.folded_root == r.root) == r.verified for r in found)


# --- 13 ---

def brute_negatives(rows):
    """All hard negatives by a scan; rows are (id, label, vector)."""
    kept = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.setdefault(i, []).append((label, tuple(v)))
    rows = [(i, *min(options)) for i, options in kept.items()]
    whole = {i: [int(np.floor(256 * np.float64(x))) for x in v] for i, _, v in rows}
    out = set()
    for a, label, v in rows:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(whole[a], whole[i])), i, other) for i, other, w in rows if i != a and len(w) == len(v))
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            near = [(t, i) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out |= {(a, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(near, 1)}
    return out


VECTORS = "vec_id long, label int, embedding array<float>, score int, `group` int, block int"


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], VECTORS)
    return [tuple(r) for r in hard_negatives.hard_negatives(df).collect()]


def vectors(seed, n, dims, copies=0, lengths=False, clusters=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims))
    if clusters:
        v = rng.normal(size=(clusters, dims))[rng.integers(0, clusters, n)] + 0.15 * v
    v /= np.linalg.norm(v, axis=1)[:, None]
    if lengths:
        v *= np.exp(rng.normal(size=(n, 1)))
    if copies:
        v[-copies:] = v[0]
    return [(int(10 * k), int(rng.integers(0, 4)), [float(x) for x in v[k].astype(np.float32)]) for k in range(n)]


@pytest.mark.parametrize("seed, n, dims, copies, lengths, clusters, size", [
    (1, 300, 16, 0, False, 0, 1 << 14), (2, 300, 3, 100, True, 0, 40), (3, 400, 12, 30, False, 6, 64), (4, 250, 6, 0, True, 5, 30)])
def test_negatives_are_those_of_a_scan(spark, monkeypatch, seed, n, dims, copies, lengths, clusters, size):
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", size)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 7)
    rows = vectors(seed, n, dims, copies, lengths, clusters)
    found = mined(spark, rows)
    assert len(found) == len(set(found)) and set(found) == brute_negatives(rows)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(5, 60, 4)
    rows += [(100, 1, None), (200, None, [0.1] * 4), (None, 1, [0.5] * 4), (300, 1, [nan, 0.0, 0.0, 0.0]), (400, 2, [inf, 0.0, 0.0, 0.0]), (500, 1, [0.1, None, 0.1, 0.1]),
             (700, 0, [0.0] * 4), (800, 0, []), (801, 0, []), (802, 1, []), (900, 2, [0.3, 0.2, 0.1]), (901, 2, [0.3, 0.2, 0.1]), (902, 1, [0.3, 0.2, 0.0]),
             (950, 3, [0.2] * 4), (950, 2, [0.9] * 4), (950, 3, [0.2] * 4)]
    rows = [r for r in rows[:60] if r[0] not in (100, 200, 300, 400, 500)] + rows[60:]
    assert set(mined(spark, rows)) == brute_negatives(rows)
    assert mined(spark, []) == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([], "vec_id long, label int, embedding array<double>")).isEmpty()


def test_candidates_hold_every_row_that_reaches_the_cosine():
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(500, 8))
    rows[100:200] = rows[0] + 0.1 * rng.normal(size=(100, 8))
    bucket = next(hard_negatives.buckets(np.arange(500), np.zeros(500, int), rows / np.linalg.norm(rows, axis=1)[:, None]))
    anchors = np.vstack([rows[0], rows[300]])
    anchors /= np.linalg.norm(anchors, axis=1)[:, None]
    pruned = 0
    for cosine in (0.0, 0.5, 0.9, 0.99, 1.0):
        for anchor, found in zip(anchors, bucket.candidates(anchors, np.full(2, cosine))):
            unit = bucket.vectors / np.linalg.norm(bucket.vectors, axis=1)[:, None]
            reach = set(np.flatnonzero(unit @ anchor >= cosine - 1e-12))
            assert found is None or reach <= set(found)
            pruned += found is not None and len(found) < 250
    assert pruned >= 2
    assert [len(c) for c in bucket.candidates(anchors, np.full(2, 1.5))] == [0, 0]


def test_scores_beyond_doubles_are_exact():
    big = np.array([[2.0 ** 30, 1.0], [3.0, 5.0]])
    assert hard_negatives.exact_scores(big, np.array([[2.0 ** 30, 1.0]])).tolist() == [[2 ** 60 + 1], [3 * 2 ** 30 + 5]]
    assert hard_negatives.exact_scores(np.array([[2.0 ** 60]]), np.array([[2.0 ** 60]])).tolist() == [[hard_negatives.MOST]]
