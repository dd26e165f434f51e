"""Centroid clustering of integer vectors by native expressions.

Vectors are kept once as integers.  Each round is one scan: ``zip_with`` and
``aggregate`` give a row's squared distances to the centroids, which stand in
the plan as literal arrays, ``array_min`` over (distance, number) structs
chooses the cluster (ties: the smaller number), and one sum per column and
cluster, added up map-side first, moves the centroids.  Only these sums - as
many numbers as the centroids have - reach the driver, so a cluster that holds
most rows costs no more than any other.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components take no part; scaled components beyond ``LARGEST`` in
size are set to it; rows that repeat an id are vectors of their own (seeds are
then told apart by their components); a row without an id is clustered but
never a seed; with fewer vectors than centroids there are as many centroids as
vectors that can be seeds, and without one the result is empty, as for an
empty table; an inertia beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import drop, keep, own_columns

LARGEST = 1 << 27


def whole_vectors(embeddings: DataFrame, length: int, scale: int) -> DataFrame:
    """vec_id, ``v`` (bigints, ``floor(scale * x)``) and ``own`` (the sum of its squares) of the vectors that take part."""
    rows = own_columns(embeddings, "vec_id", "embedding").where(F.size("embedding") == length)
    # null, NaN and both infinities fail the comparison or are beyond it
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    bound = float(LARGEST)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(bound)), F.lit(-bound))).cast("bigint"))
    whole_rows = rows.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return whole_rows.withColumn("own", total(F.transform("v", lambda x: x * x), F.lit(0).cast("bigint")))


def literal(centroids: list[list[int]]) -> Column:
    """One literal: for each centroid the sum of its squares and its components times -2."""
    rows = ("struct({}L as squares, array({}) as c)".format(sum(x * x for x in c), ", ".join(f"{-2 * x}L" for x in c)) for c in centroids)
    return F.expr(f"array({', '.join(rows)})")


def total(numbers: Column, start: Column) -> Column:
    return F.aggregate(numbers, start, lambda so_far, x: so_far + x)


def nearest(vector: Column, own: Column, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid: the squares of the vector (``own``) and the centroid, less twice their products."""

    def each(k: Column, i: Column) -> Column:
        products = F.zip_with(vector, k["c"], lambda x, y: x * y)
        return F.struct(total(products, own + k["squares"]).alias("distance"), i.alias("cluster"))

    return F.array_min(F.transform(literal(centroids), each))


def seeds(vectors: DataFrame, clusters: int, salt: str) -> list[list[int]]:
    """The vectors with the smallest hashes of salt and id, in that order."""
    rank = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id is not null").select(rank.alias("rank"), "v").orderBy("rank", "v").limit(clusters)
    return [list(r.v) for r in first.collect()]  # as many vectors as centroids


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid at the floor of its vectors' mean; one without vectors stays."""
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    placed = vectors.select("v", nearest(F.col("v"), F.col("own"), centroids)["cluster"].alias("cluster"))
    out = list(centroids)
    for r in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # a row a cluster
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(centroids[0]))]
    return out


def cluster(embeddings: DataFrame, clusters: int = 16, rounds: int = 3, length: int = 64, scale: int = 64, salt: str = "1:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    vectors = keep(whole_vectors(embeddings, length, scale), "whole-vectors")
    centroids = seeds(vectors, clusters, salt)
    if not centroids:
        centroids = [[0] * length]
        vectors = vectors.limit(0)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    placed = keep(vectors.select("vec_id", nearest(F.col("v"), F.col("own"), centroids).alias("at")).select("vec_id", "at.cluster", "at.distance"), "clustered")
    drop(vectors)
    # a row a cluster: as many numbers as there are centroids
    sums = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total")).collect()}

    def fitting(n) -> Column:
        return F.lit(int(n) if n < 1 << 63 else None).cast("bigint")

    own = F.array(*[fitting(sums.get(i, 0)) for i in range(len(centroids))])
    names = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        own[F.col("cluster")].alias("cluster_inertia"),
        fitting(sum(sums.values())).alias("inertia"),
        names[F.col("cluster")].alias("centroid_sha256"),
    )
