"""Centroid clustering and part codes against plain loops, with awkward rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adresponse.llm import centroids, partcodes, registry
from tests.llm.test_operators import SF, empty

CLASHES = "v own at cluster distance rank length usual n code error label_error of part ids labels sizes entries places".split()


def vectors(spark, n=120, length=64, seed=3, spread=0.3):
    """Rows with repeats, ties, nulls, odd lengths and odd components, and columns whose names clash."""
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, spread, length)], int(i % 5) if i % 7 else None) for i in range(n)]
    rows += [rows[3], rows[3], (5, rows[9][1], 1), (900, rows[4][1], 2), (901, rows[4][1], None), (None, rows[6][1], 3)]
    rows += [(902, None, 1), (903, [], 1), (904, [0.5] * (length - 1), 1), (905, [0.5] * (length - 1) + [None], 1)]
    rows += [(906, [math.nan] + [0.5] * (length - 1), 1), (907, [math.inf] + [0.5] * (length - 1), 1), (908, [-math.inf] * length, 1), (909, [0.0] * length, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def usable(df, length, scale):
    rows = [r for r in df.collect() if r.embedding is not None and len(r.embedding) == length and all(x is not None and math.isfinite(x) for x in r.embedding)]
    return [(r.vec_id, r.label, [math.floor(scale * x) for x in r.embedding]) for r in rows]


def away(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def plain_codebook(parts, book, rounds):
    for _ in range(rounds):
        near = [min(range(len(book)), key=lambda e: (away(p, book[e]), e)) for p in parts]
        for e in set(near):
            mine = [p for p, k in zip(parts, near) if k == e]
            book[e] = [sum(c) // len(mine) for c in zip(*mine)]
    near = [min(range(len(book)), key=lambda e: (away(p, book[e]), e)) for p in parts]
    return near, [away(p, book[e]) for p, e in zip(parts, near)], book


def test_clusters_as_a_plain_loop(spark):
    df = vectors(spark)
    rows = usable(df, 64, 64)
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, _, v in rows if i is not None)[:16]
    near, error, book = plain_codebook([v for _, _, v in rows], [list(v) for _, v in seeds], 3)
    names = [hashlib.sha256(",".join(map(str, b)).encode()).hexdigest() for b in book]
    own = {c: sum(e for e, k in zip(error, near) if k == c) for c in set(near)}
    want = sorted((str(i), c, e, own[c], sum(error), names[c]) for (i, _, _), c, e in zip(rows, near, error))
    got = centroids.cluster(df).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == want


def test_few_vectors_and_huge_components(spark):
    df = vectors(spark)
    few = centroids.cluster(df.where("vec_id in (1, 2, 3)"))
    assert len({r.cluster for r in few.collect()}) == 3 and few.count() == 5 and few.where("distance > 0").count() == 0
    assert centroids.cluster(df.where("vec_id is null")).count() == 0
    assert centroids.cluster(empty(spark, "embeddings")).count() == 0
    big = spark.createDataFrame([(i, [1e30 * (-1) ** i] * 64) for i in range(40)], "vec_id long, embedding array<float>")
    assert centroids.cluster(big, clusters=2).count() == 40


@pytest.mark.parametrize("length, entries", [(16, 256), (16, 20), (10, 8), (3, 4)])
def test_codes_as_a_plain_loop(spark, length, entries):
    df = vectors(spark, length=length)
    rows = usable(df, length, 1024)
    first = sorted((i, v) for i, _, v in rows if i is not None)[:entries]
    codes, errors, books = [""] * len(rows), [0] * len(rows), []
    for a, b in partcodes.bounds(length):
        near, error, book = plain_codebook([v[a:b] for _, _, v in rows], [list(v[a:b]) for _, v in first], 4)
        codes, errors = [c + f"{e:02x}" for c, e in zip(codes, near)], [x + y for x, y in zip(errors, error)]
        books.append(book)
    got, own = partcodes.compress(df, entries=entries)
    assert sorted((str(r.vec_id), r.code, r.error) for r in got.collect()) == sorted((str(i), c, e) for (i, _, _), c, e in zip(rows, codes, errors))
    assert [b.tolist() for b in own] == books


def test_code_query(spark):
    got = registry.op13_vector_codes(spark, SF).collect()
    labels = {r.vec_id: r.label for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    sums = {}
    for r in got:
        sums[labels[r.vec_id]] = sums.get(labels[r.vec_id], 0) + r.error
    assert all(r.label_error == sums[labels[r.vec_id]] and len(r.code) == 8 for r in got) and len({r.codebooks_sha256 for r in got}) == 1
    rows = partcodes.codes(vectors(spark)).collect()
    null = sum(r.error for r in partcodes.compress(vectors(spark))[0].where("label is null").collect())
    assert null in {r.label_error for r in rows}


def test_code_edges(spark):
    assert partcodes.codes(empty(spark, "embeddings")).count() == 0
    assert partcodes.codes(vectors(spark).where("vec_id is null")).count() == 0
    big = spark.createDataFrame([(i, [1e30 * (-1) ** i] * 8, 1) for i in range(40)], "vec_id long, embedding array<float>, label int")
    assert partcodes.codes(big).where("error = 0").count() == 40
    with pytest.raises(ValueError):
        partcodes.compress(big, entries=257)
    # many small blocks give the same codes
    one = {(r.vec_id, r.code) for r in partcodes.codes(vectors(spark)).collect()}
    before, partcodes.BLOCK = partcodes.BLOCK, 64 * 7
    try:
        assert {(r.vec_id, r.code) for r in partcodes.codes(vectors(spark)).collect()} == one
    finally:
        partcodes.BLOCK = before
