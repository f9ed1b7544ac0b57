"""Centroid clustering and hard negatives against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import clustering, hard_negatives
from barlake.llm.common import written
from barlake.llm.queries import op11_centroid_clustering, op12_hard_negatives

SMOKE = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows, parts=3):
    return written(spark.createDataFrame(rows, SCHEMA).repartition(parts), "test-embeddings")


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def f32(v):
    return [float(np.float32(x)) for x in v]


# ------------------------------------------------------------------------ clustering
def lloyd(rows, size=64, k=16, rounds=3, scale=64):
    kept = [(i, [math.floor(scale * x) for x in f32(v)]) for i, v, _ in rows if usable(v) and len(v) == size]
    start = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v)
                   for i, v in kept)[:k]
    centres = [list(v) for *_, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o)] if o else c for c, o in zip(centres, own)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = {j: sum(d for _, d, c in found if c == j) for j in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, c, d, total[c], sum(total.values()), sha[c]) for i, d, c in found]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_clusters_of_the_test_table(scratch):
    rows = [tuple(r) for r in scratch.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    assert as_rows(op11_centroid_clustering(scratch, SMOKE)) == sorted(lloyd(rows), key=repr)


def odd_rows(n=150, size=64, seed=5):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, 1.0, rng.uniform(-1, 1)]) for _ in range(size)], rng.randrange(4))
            for i in range(n)]
    rows += rows[:5]                                            # repeated rows
    rows += [(1000 + i, rows[3][1], 2) for i in range(40)]      # a hot vector: ties
    rows += [(2000, None, 1), (2001, [], 1), (2002, [1.0] * (size - 1), 1), (2003, [NAN] + [0.0] * (size - 1), 1),
             (2004, [None] + [0.0] * (size - 1), 1), (2005, [INF] + [0.0] * (size - 1), 1),
             (None, [0.1] * size, 1), (2007, [0.0] * size, None), (2008, [0.0] * size, 0)]
    return rows


@pytest.mark.parametrize("rows, width", [(7, 2), (65_536, 3), (20, 64), (1, 1)])
def test_odd_vectors_in_chunks_and_blocks_of_any_size(scratch, rows, width, monkeypatch):
    monkeypatch.setattr(clustering.encoded_chunks, "__defaults__", (width, rows))
    data = odd_rows()
    assert as_rows(clustering.cluster_vectors(table(scratch, data))) == sorted(lloyd(data), key=repr)


def test_fewer_vectors_than_clusters_and_none(scratch):
    data = odd_rows()[:5]
    assert as_rows(clustering.cluster_vectors(table(scratch, data))) == sorted(lloyd(data), key=repr)
    none = clustering.cluster_vectors(table(scratch, [(1, [1.0], 1)]))
    assert none.count() == 0 and none.columns[0] == "vec_id"
    assert clustering.cluster_vectors(scratch.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns_with_clashing_names(scratch):
    data = odd_rows()[:60]
    df = table(scratch, data).withColumns({c: F.lit("x") for c in ("vector", "cell", "cluster", "distance", "key")})
    assert as_rows(clustering.cluster_vectors(df)) == sorted(lloyd(data), key=repr)


def test_a_component_without_exact_distance_is_an_error(scratch):
    data = [(1, [3e7] + [0.0] * 63, 1), (2, [0.0] * 64, 1)]
    with pytest.raises(Exception, match="no exact 64-bit"):
        clustering.cluster_vectors(table(scratch, data)).collect()


def test_dictionaries_are_lossless():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    v = rng.integers(-3, 3, (500, 11)) * rng.choice([1, 70_000], (500, 11))
    chunk = clustering.Chunk(clustering.encode(pa.array([None, *range(499)], pa.int64()), v, 3))
    assert (chunk.vectors() == v).all() and chunk.ids.to_pylist() == [None, *range(499)]
    assert all(len(book) == len({tuple(x) for x in v[:, at:at + 3]}) for at, book, _ in chunk.blocks)


# -------------------------------------------------------------------- hard negatives
def mined(rows, scale=256, npos=5, nneg=3, every=50):
    kept = [(i, n, label, [math.floor(scale * x) for x in f32(v)]) for n, (i, v, label) in enumerate(rows)
            if i is not None and label is not None and usable(v)]
    kept = [(i, n, (label + 1) % 10 if i % 7 == 0 else label, v) for i, n, label, v in kept]
    out = []
    for a, an, al, av in kept:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, n, label) for i, n, label, v in kept if n != an)
        for s, p, *_ in [x for x in scored if x[3] == al][:npos]:
            negative = [x for x in scored if x[3] != al and 50 * -s <= 100 * -x[0] <= 95 * -s][:nneg]
            out += [(a, p, r, x[1], -s, -x[0]) for r, x in enumerate(negative, 1)]
    return sorted(out)


def near_rows(n=400, size=24, seed=3):
    """Rows around a few directions, so that angles can tell something."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = []
    for i in range(n):
        c = i % 6
        v = centres[c] * rng.uniform(0.2, 1.5) + rng.normal(size=size) * rng.choice([0.05, 0.4])
        rows.append((i * 5, (v / 4).astype(np.float32).tolist(), int(rng.integers(0, 4))))
    return rows


def test_negatives_of_the_test_table(scratch):
    rows = [tuple(r) for r in scratch.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    want = mined(rows)
    assert len(want) > 50 and sorted(map(tuple, op12_hard_negatives(scratch, SMOKE).collect())) == want


def run(scratch, data, **options):
    df = hard_negatives.shifted_labels(table(scratch, data))
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 7, "block": 3}, {"chunk_rows": 1, "references": 1}])
def test_clustered_rows(scratch, options):
    data = near_rows()
    assert run(scratch, data, **options) == mined(data) != []


def test_odd_rows_for_mining(scratch):
    data = odd_rows(size=8)
    data += [(50, data[3][1], 2), (50, data[3][1], 2), (100, [], 2), (150, [2.0], 1), (200, [0.0] * 8, 1)]
    assert run(scratch, data, chunk_rows=16) == mined(data) != []


def test_hot_vector_and_hot_label(scratch):
    one = [0.5, 0.25, -0.125]
    data = [(i, one, 1) for i in range(120)] + [(200 + i, one, 2) for i in range(60)]
    data += [(400 + i, [0.3, 0.2, 0.01 * i], 2) for i in range(30)]
    assert run(scratch, data, chunk_rows=10) == mined(data) != []


def test_nothing_to_mine(scratch):
    assert run(scratch, []) == []
    assert run(scratch, [(50, [1.0], 1), (51, [1.0], 2)]) == []
    df = table(scratch, near_rows(80)).withColumns({c: F.lit("x") for c in ("uid", "vector", "angle", "rank", "score")})
    got = hard_negatives.hard_negatives(hard_negatives.shifted_labels(df), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == mined(near_rows(80))


def test_bounds_hold_and_tell_something():
    data = near_rows(300)
    vectors = np.floor(np.array([v for _, v, _ in data]) * 256).astype(np.int64)
    directions = vectors[:8]

    def rows(x):
        r = object.__new__(hard_negatives.Rows)
        r.n, r.vectors, r.norms = len(x), x, hard_negatives._norms(x)
        r.angles = hard_negatives.angles(x, directions).astype("<f4")
        return r

    a, v = rows(vectors[:40]), rows(vectors)
    exact = vectors[:40] @ vectors.T
    low, high = hard_negatives.score_bounds(a, np.arange(40), v)
    assert (low <= exact).all() and (exact <= high).all()
    assert ((high - low) < np.outer(a.norms, v.norms)).mean() > 0.5   # half the trivial interval and less
    for c in range(0, 300, 30):
        part = rows(vectors[c:c + 30])
        low, high = hard_negatives.chunk_bounds(a, np.arange(40), part)
        assert (low <= exact[:, c:c + 30].min(axis=1)).all() and (exact[:, c:c + 30].max(axis=1) <= high).all()


def test_large_components_are_scored_exactly(scratch):
    rng = random.Random(2)
    data = [(i * 10, [rng.choice([-1, 1]) * rng.uniform(1e5, 1e6) for _ in range(5)], i % 3) for i in range(60)]
    assert run(scratch, data) == mined(data)
    with pytest.raises(Exception, match="64"):
        run(scratch, [(50, [1e7], 1), (100, [1e7], 1)])
