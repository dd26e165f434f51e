"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of the unit vectors; every vector is
then sent down to its leaf.  A query puts the tree's nodes in a priority queue
by how near their centres are, and opens the nearest until it has so many
leaves; how many is widened, on queries from the sample against the whole
sample, until the wanted recall is reached there.  A leaf's vectors, and the
queries that visit it, are dealt into blocks of bounded size, so no leaf -
however many copies of one vector it holds - has to fit one task; each block
gives its nearest for every query and the best of all blocks win.

Scores are cosines in double precision on the original vectors, summed in one
fixed order, so equal vectors have equal scores and ties go to the smaller id.

Defined cases: vectors that are null, zero, hold null or non-finite
components, have no id, or another length than most, take no part; of rows
that share an id, as queries one counts, and none is a neighbour of that id;
fewer candidates than asked give fewer rows; an empty table an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import keep, own_columns

SAMPLE = 20_000  # vectors that the tree is fitted on
BRANCH, LEAF = 8, 48  # children of a node; sample vectors in a leaf, at most
TRIALS = 400  # sample queries for calibration
RECALL = 0.97
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096
QUERY_EVERY, NEAREST = 50, 5


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Nodes with centres; ``children`` is None for a leaf, whose number is ``leaf``."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, most: int = LEAF, seed: int = 7):
        self.centres: list[np.ndarray] = []  # of a node's children
        self.children: list[list[int] | None] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._rng, self._branch, self._most = np.random.default_rng(seed), branch, most
        self._grow(x)

    def _grow(self, x: np.ndarray) -> int:
        node = len(self.children)
        self.children.append(None)
        self.centres.append(np.zeros((0, x.shape[1])))
        self.leaf.append(-1)
        parts = self._split(x) if len(x) > self._most else []
        if len(parts) < 2:
            self.leaf[node], self.leaves = self.leaves, self.leaves + 1
            return node
        self.centres[node] = unit(np.stack([p.sum(axis=0) + 1e-12 for p in parts]))
        self.children[node] = [self._grow(p) for p in parts]
        return node

    def _split(self, x: np.ndarray) -> list[np.ndarray]:
        centres = x[self._rng.choice(len(x), min(self._branch, len(x)), replace=False)]
        for _ in range(8):
            near = (x @ centres.T).argmax(axis=1)
            parts = [x[near == k] for k in np.unique(near)]
            centres = unit(np.stack([p.sum(axis=0) + 1e-12 for p in parts]))
        near = (x @ centres.T).argmax(axis=1)
        return [x[near == k] for k in np.unique(near)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every vector."""
        out, todo = np.zeros(len(x), dtype=np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                out[rows] = self.leaf[node]
                continue
            near = (x[rows] @ self.centres[node].T).argmax(axis=1)
            todo += [(c, rows[near == k]) for k, c in enumerate(self.children[node]) if (near == k).any()]
        return out

    def search(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        queue, out = [(-1.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            if self.children[node] is None:
                out.append(self.leaf[node])
                continue
            for near, child in zip((self.centres[node] @ q).tolist(), self.children[node]):
                heapq.heappush(queue, (-near, child))
        return out

    def calibrate(self, x: np.ndarray, k: int, recall: float = RECALL, trials: int = TRIALS) -> int:
        """Fewest leaf visits, widening by half again, that reach the recall within the sample."""
        picks = self._rng.choice(len(x), min(trials, len(x)), replace=False)
        near = x[picks] @ x.T
        near[np.arange(len(picks)), picks] = -2
        k = min(k, len(x) - 1)
        if k < 1:
            return 1
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        at = self.assign(x)[best]
        ranks = [{leaf: i for i, leaf in enumerate(self.search(x[p], self.leaves))} for p in picks]
        needed = np.array([[r[leaf] for leaf in row] for r, row in zip(ranks, at.tolist())])
        visits = 1
        while visits < self.leaves and (needed < visits).mean() < recall:
            visits = min(self.leaves, visits + max(1, visits // 2))
        return visits


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that take part."""
    rows = own_columns(embeddings, "vec_id", "embedding")
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole & F.exists("embedding", lambda v: v != 0))
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == common.n) if common else rows


def _best(q_ids, q, c_ids, c, k) -> pd.DataFrame:
    """The k nearest ids of a block for each query: exact scores, an id by its best, ties by id."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], np.ascontiguousarray(c[order])
    raw = pd.Series([r.tobytes() for r in c])
    once = ~pd.DataFrame({"id": c_ids, "raw": raw}).duplicated().to_numpy()
    c_ids, c, raw = c_ids[once], c[once], raw[once]
    # of equal vectors the k + 1 smallest ids are enough, the query's own among them
    copy = raw.groupby(raw).cumcount().to_numpy()
    c_ids, c = c_ids[copy <= k], c[copy <= k]
    cn, qn = np.sqrt((c * c).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    near = (q / qn[:, None]) @ (c / cn[:, None]).T
    near[q_ids[:, None] == c_ids[None, :]] = -2
    ids = np.maximum.reduceat(near, np.flatnonzero(np.diff(c_ids, prepend=c_ids[0] - 1)), axis=1)  # the best of each id
    bar = np.partition(ids, -k, axis=1)[:, -k] if ids.shape[1] > k else np.full(len(q), -1.5)
    i, j = np.nonzero((near >= bar[:, None] - 1e-9) & (near > -1.5))
    score = (q[i] * c[j]).sum(axis=1) / (qn[i] * cn[j])
    out = pd.DataFrame({"query_id": q_ids[i], "vec_id": c_ids[j], "score": score})
    out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["query_id", "vec_id"])
    return out[out.groupby("query_id").cumcount() < k]


def nearest(embeddings: DataFrame, every: int = QUERY_EVERY, k: int = NEAREST, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of every vector whose id is divisible by ``every``."""
    rows = usable(embeddings)
    array = rows.schema["embedding"].dataType.simpleString()
    schema = "query_id long, rank int, vec_id long, score double"
    # rows in the order of a hash of their ids: the same sample wherever they lie
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toPandas()["embedding"]
    if not len(picked):
        return embeddings.sparkSession.createDataFrame([], schema)
    x = np.unique(unit(np.stack([np.asarray(v, dtype=float) for v in picked])), axis=0)
    tree = Tree(x)
    visits = tree.calibrate(x, k, recall)

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b["leaf"] = tree.assign(unit(np.stack([np.asarray(v, dtype=float) for v in b["embedding"]])))
                yield b

    def visited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                v = unit(np.stack([np.asarray(v, dtype=float) for v in b["embedding"]]))
                yield b.assign(leaves=[tree.search(q, visits) for q in v])

    # repeated rows would crowd blocks and push out other ids
    placed = keep(rows.dropDuplicates(["vec_id", "embedding"]).mapInPandas(assigned, f"vec_id long, embedding {array}, leaf long"), "ann-leaves")
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    asked = keep(asked.mapInPandas(visited, f"vec_id long, embedding {array}, leaves array<long>"), "ann-visits")
    asked = asked.select("vec_id", "embedding", F.explode("leaves").alias("leaf"))  # a query's vector is repeated in the JVM only
    # blocks of each leaf: a row for each leaf, and the tree has as many as its sample allows
    have = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    want = {r.leaf: r.n for r in asked.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    deal = pd.DataFrame({"leaf": sorted(have)})
    deal["c"] = [-(-have[leaf] // BLOCK_ROWS) for leaf in deal["leaf"]]
    deal["q"] = [-(-want.get(leaf, 0) // BLOCK_QUERIES) for leaf in deal["leaf"]]
    deal = embeddings.sparkSession.createDataFrame(deal.astype("int64"), "leaf long, c long, q long").where("q > 0")
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
    steps = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = asked.join(deal, "leaf").select("vec_id", "embedding", "leaf", part("q").alias("qb"), steps("c").alias("cb"))
    right = placed.join(deal, "leaf").select("vec_id", "embedding", "leaf", part("c").alias("cb"), steps("q").alias("qb"))

    def block(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        stack = lambda t: (t["vec_id"].to_numpy(), np.stack([np.asarray(v, dtype=float) for v in t["embedding"]]))
        return _best(*stack(queries), *stack(vectors), k)

    by = ["leaf", "qb", "cb"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(block, "query_id long, vec_id long, score double")
    # an id with several vectors is one neighbour, by its best
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    top = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("near"))
    return top.select("query_id", F.posexplode("near").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), (-F.col("n.s")).alias("score")
    )
