"""Near-duplicate groups by an LSH forest over MinHash signatures.

1. Documents with equal shingle sets form classes; one row of each goes on.
2. A signature of ``TREES`` times ``LEVELS`` minima gives every class a path in
   each tree.  Each tree's paths are sorted (a range-partitioned sort, so no
   group of alike paths has to fit one task); documents whose paths share a
   prefix lie side by side.  A run that shares ``SHALLOW`` levels and has at
   most ``REGION`` members is compared in full; a larger one is descended,
   region by region, to the depth at which regions are small, and neighbours
   in the order - those with the longest common prefix - are compared across.
3. Candidates whose signatures agree enough are verified on the full sets:
   first each one's best, then, as these join groups, the next ones that would
   still join two groups, to the last.
4. Runs that were too large to be compared in full, and runs that a partition
   ends in, get an exact pass: members outside their run's main group meet the
   others by a prefix filter over shingles, rarest first, which loses no pair.

Links are checked on whole sets of 64-bit shingle hashes; no pair list within
a group is made.  The result is one row per document.

Defined cases: null or empty texts have no shingles, are linked with nothing
and kept; a text of fewer words than a shingle is one shingle; repeated rows
are equal documents; an id used for several texts ties their groups; a row
without an id belongs to the group of the rows with the same shingles, or, if
none of those has an id, to a group of these rows with a null component; an
empty table gives an empty result.  ``keep_one`` keeps one row of each group,
whatever its ids, and every row without shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adresponse.llm import text
from adresponse.llm.store import drop, keep, own_columns

TREES, LEVELS, SHALLOW = 16, 6, 3
REGION, BESIDE = 32, 3
ROUNDS = ((2, 4), (5, 12))  # places among each one's candidates that are verified together
U = np.uint64


def _factors() -> tuple[np.ndarray, np.ndarray]:
    seeds = text.mix(np.arange(1, 2 * TREES * LEVELS + 1, dtype=U) * U(0x9E3779B97F4A7C15)).astype(np.uint32)
    return seeds[: TREES * LEVELS] | np.uint32(1), seeds[TREES * LEVELS :]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 16-bit minima of one set, tree by tree."""
    a, b = _factors()
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    x = (shingles >> U(32)).astype(np.uint32)
    for i in range(0, len(x), 4096):
        np.minimum(least, ((x[None, i : i + 4096] ^ b[:, None]) * a[:, None]).min(axis=1), out=least)
    return (text.mix(least.astype(U)) & U(0xFFFF)).astype(">u2")


def _sets(texts: list, k: int) -> Iterator[np.ndarray]:
    for s in text.groups(texts):
        words, counts = text.word_hashes(texts[s])
        at = 0
        for n in counts.tolist():
            yield text.shingles(words[at : at + n], k)
            at += n


def text_key() -> list:
    """Two hashes that tell apart the texts of one id."""
    return [F.xxhash64("text").alias("h1"), F.hash("text").alias("h2")]


def describe(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, text hashes, n (set size), set_id (equal for equal sets), signature and its low bytes of every document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, h1, h2, s in zip(b["doc_id"], b["h1"], b["h2"], _sets(b["text"].tolist(), k)):
                some = len(s) > 0
                sig = signature(s) if some else None
                out.append((i, h1, h2, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if some else None, sig.tobytes() if some else None, sig.astype("u1").tobytes() if some else None))
            yield pd.DataFrame(out, columns=["doc_id", "h1", "h2", "n", "set_id", "sig", "sketch"])

    known = own_columns(documents, "doc_id", "text").select("doc_id", "text", *text_key())
    return known.mapInPandas(rows, "doc_id long, h1 long, h2 int, n long, set_id binary, sig binary, sketch binary")


def _regions(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end, depth) of maximal runs of rows whose neighbours share ``depth`` levels: the runs of depth ``least``, and inside large ones deeper runs."""
    cut = np.flatnonzero(np.concatenate([[True], lcp < least, [True]]))
    todo = [(int(a), int(b), least) for a, b in zip(cut, cut[1:]) if b - a > 1]
    while todo:
        a, b, depth = todo.pop()
        yield a, b, depth
        if b - a > REGION and depth < LEVELS:
            inner = a + np.flatnonzero(np.concatenate([[True], lcp[a : b - 1] < depth + 1, [True]]))
            todo += [(int(x), int(y), depth + 1) for x, y in zip(inner, inner[1:]) if y - x > 1]


def _neighbours(part: pd.DataFrame, agree: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (a, b, agreeing minima) and rows (run, node) for the exact pass, of one sorted partition."""
    tree, node = part["tree"].to_numpy(), part["node"].to_numpy()
    sig = np.frombuffer(b"".join(part["sketch"]), dtype=np.uint8).reshape(len(part), -1)
    path = np.frombuffer(b"".join(part["path"]), dtype=">u2").reshape(len(part), LEVELS)
    same = (path[1:] == path[:-1]) & (tree[1:] == tree[:-1])[:, None]
    lcp = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    pairs, hot = [], []
    for gap in range(1, BESIDE + 1):  # neighbours in the order
        if len(lcp) >= gap:
            shared = np.minimum.reduce([lcp[i : len(lcp) - gap + 1 + i] for i in range(gap)])
            i = np.flatnonzero(shared >= SHALLOW)
            pairs.append(np.stack([i, i + gap], axis=1))
    for a, b, depth in _regions(lcp, SHALLOW):
        if b - a <= REGION:
            i, j = np.triu_indices(b - a, 1)
            pairs.append(np.stack([i + a, j + a], axis=1))
        if depth == SHALLOW and b - a > REGION or a == 0 or b == len(part):
            hot += range(a, b)
    hot += [0, len(part) - 1]  # their runs may go on in the next partition
    hot = np.unique(hot)
    out = []
    every = np.concatenate(pairs) if pairs else np.zeros((0, 2), dtype=np.int64)
    for s in range(0, len(every), 1 << 16):
        i, j = every[s : s + (1 << 16)].T
        n = (sig[i] == sig[j]).sum(axis=1)
        ok = (n >= agree) & (node[i] != node[j])
        i, j, n = i[ok], j[ok], n[ok]
        out.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), n], axis=1))
    found = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), dtype=np.int64)
    ids = np.array([int.from_bytes(hashlib.blake2b(bytes([tree[i]]) + path[i, :SHALLOW].tobytes(), digest_size=8).digest(), "little", signed=True) for i in hot], dtype=np.int64)
    return found, np.stack([ids, node[hot]], axis=1)


def components(links: DataFrame, steps: int | None = None) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node it is connected with.

    Alternates large-star and small-star steps until every link is (node,
    smallest).  After only so many ``steps``, nodes of one label are connected
    but a component may have several; a node's smallest label is given.
    """

    def labels(edges: DataFrame) -> DataFrame:
        tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
        every = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
        return every.groupBy("node").agg(F.min("component").alias("component"))

    def star(edges: DataFrame, least: DataFrame, both: bool) -> DataFrame:
        met = edges.join(least, "u")
        if both:
            return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))

    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    before = None
    while steps is None or steps > 0:
        steps = None if steps is None else steps - 1
        mark = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        two_way = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(two_way, two_way.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), True).where("u > v").distinct()
        large = keep(large, "large-star")
        small = star(large, large.groupBy("u").agg(F.min("v").alias("m")), False).where("u > v").distinct()
        old, edges = edges, keep(small, "small-star")
        drop(old)
        drop(large)
    return labels(edges)


class Forest:
    """One run over a table of documents; ``share`` is the least Jaccard similarity as a fraction (numerator, denominator)."""

    def __init__(self, documents: DataFrame, k: int, share: tuple[int, int]):
        self.documents, self.k, self.share = own_columns(documents, "doc_id", "text"), k, share
        self.described = keep(describe(documents, k), "described")
        some = self.described.where("set_id is not null")
        classes = some.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
        self.classes = keep(classes, "classes")

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """(a, b, agree) and (run, node)."""
        p = self.share[0] / self.share[1]
        size = TREES * LEVELS
        # five standard deviations below the share at which a pair is linked
        agree = math.floor(size * p - 5 * math.sqrt(size * p * (1 - p)))
        width = 2 * LEVELS
        paths = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.expr("sig").substr(t * width + 1, F.lit(width)).alias("path")))
        rows = self.classes.where("node is not null").select("node", "sketch", F.explode(paths).alias("t")).select("t.tree", "t.path", "node", "sketch")
        ordered = rows.repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = [b for b in batches if len(b)]
            if parts:
                found, hot = _neighbours(pd.concat(parts, ignore_index=True), agree)
                yield pd.DataFrame({"hot": False, "a": found[:, 0], "b": found[:, 1], "agree": found[:, 2]})
                yield pd.DataFrame({"hot": True, "a": hot[:, 0], "b": hot[:, 1], "agree": 0})

        found = keep(ordered.mapInPandas(search, "hot boolean, a long, b long, agree int"), "candidates")
        pairs = found.where("not hot").groupBy("a", "b").agg(F.max("agree").alias("agree"))
        runs = found.where("hot").select(F.col("a").alias("run"), F.col("b").alias("node")).distinct()
        return pairs, runs

    def sets(self, nodes: DataFrame) -> DataFrame:
        """node, set_id and shingles (bytes of sorted 64-bit hashes) of the given nodes: a row for each text of a node, however often it is repeated."""

        k = self.k
        def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                raw = [s.tobytes() for s in _sets(b["text"].tolist(), k)]
                out = pd.DataFrame({"node": b["node"], "set_id": [hashlib.blake2b(s, digest_size=16).digest() for s in raw], "shingles": raw})
                yield out[out["shingles"].str.len() > 0]

        wanted = nodes.select("node").distinct()
        # the list of nodes grows with the corpus: never broadcast
        met = self.documents.hint("merge").join(wanted, self.documents["doc_id"] == wanted["node"])
        texts = met.groupBy("node", F.xxhash64("text").alias("hash"), F.length("text").alias("length")).agg(F.first("text").alias("text"))
        return texts.select("node", "text").mapInPandas(made, "node long, set_id binary, shingles binary")

    def linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough."""
        up, down = self.share

        @F.pandas_udf("boolean")
        def alike(x: pd.Series, y: pd.Series) -> pd.Series:
            out = []
            for p, q in zip(x, y):
                s, t = np.frombuffer(p, dtype=U), np.frombuffer(q, dtype=U)
                if len(s) > len(t):
                    s, t = t, s
                both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
                out.append(down * both >= up * (len(s) + len(t) - both))
            return pd.Series(out, dtype=bool)

        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")).hint("merge")
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")).hint("merge")
        near = F.octet_length("x") * up <= F.octet_length("y") * down
        near = near & (F.octet_length("y") * up <= F.octet_length("x") * down)
        return pairs.select("a", "b").join(left, "a").join(right, "b").where(near).where(alike("x", "y")).select("a", "b")

    def _apart(self, pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """The pairs whose ends are in different groups."""
        one = groups.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        two = groups.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        met = pairs.join(one, "a", "left").join(two, "b", "left")
        return met.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)

    def _rest(self, runs: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs between groups within the runs that were not compared in full, by an exact prefix filter."""
        p = self.share[0] / self.share[1]
        placed = runs.join(groups, "node", "left").select("run", "node", F.coalesce("component", "node").alias("component"))
        placed = keep(placed, "runs")
        sizes = placed.groupBy("run", "component").agg(F.count("*").alias("n"))
        main = sizes.groupBy("run").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("groups")).where("groups > 1")
        members = placed.join(main, "run").select("node", "component", (F.col("component") != F.col("main.component")).alias("other"))
        members = keep(members.groupBy("node", "component").agg(F.max("other").alias("other")), "members")

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                sizes = (b["shingles"].str.len() // 8).to_numpy()
                # an id's several texts are told apart
                which = np.array([int.from_bytes(x[:8], "little", signed=True) for x in b["set_id"]], dtype=np.int64)
                for s in range(0, len(b), 64):
                    n = sizes[s : s + 64]
                    flat = np.frombuffer(b"".join(b["shingles"][s : s + 64]), dtype=np.int64)
                    yield pd.DataFrame({"node": np.repeat(b["node"].to_numpy()[s : s + 64], n), "which": np.repeat(which[s : s + 64], n), "n": np.repeat(n, n), "shingle": flat})

        rows = keep(sets.join(members.select("node"), "node").mapInPandas(each, "node long, which long, n long, shingle long"), "run-shingles")
        often = rows.groupBy("shingle").agg(F.count("*").alias("often"))

        # each set's rarest shingles: one more than it may lack
        order = F.array_sort(F.collect_list(F.struct("often", "shingle")))
        length = (F.col("n") - F.ceil(F.col("n") * p - 1e-9) + 1).cast("int")
        first = rows.join(often, "shingle").groupBy("node", "which", "n").agg(order.alias("s"))
        first = first.select("node", "n", F.posexplode(F.slice("s", F.lit(1), length)).alias("at", "s")).select("node", "n", "at", "s.shingle")
        first = keep(first.join(members, "node"), "run-prefixes")
        one = first.where("other").select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("at").alias("i"), F.col("component").alias("ca"), "shingle")
        two = first.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("at").alias("j"), F.col("component").alias("cb"), F.col("shingle").alias("also"))
        need = F.ceil((F.col("na") + F.col("nb")) * (p / (1 + p)) - 1e-9)  # shingles that a linked pair shares
        after = F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"))  # at most so many from this place on
        # the smaller set's place is among its first few: what both lack would be too much otherwise
        short = lambda n: F.col(n) - F.ceil(F.col(n) * (2 * p / (1 + p)) - 1e-9) + 1
        early = F.when(F.col("na") <= F.col("nb"), F.col("i") < short("na")).otherwise(F.col("j") < short("nb"))
        fits = (F.col("ca") != F.col("cb")) & (F.col("na") >= F.col("nb") * p - 1e-6) & (F.col("nb") >= F.col("na") * p - 1e-6)
        fits = fits & early & (F.least("i", "j") + after >= need)
        met = one.join(two, (F.col("shingle") == F.col("also")) & fits)
        # the first shingle that a pair shares has none before it
        pairs = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max(after - need).alias("spare"))
        return pairs.where("spare >= 0").select("a", "b")

    def groups(self) -> DataFrame:
        """(node, component) of every linked class."""
        pairs, runs = self.candidates()
        pairs, runs = keep(pairs, "pairs"), keep(runs, "hot-runs")
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(runs.select("node"))
        sets = keep(self.sets(ends), "sets")
        # each one's candidates, best first: a few at a time, and only between groups
        two_way = pairs.select("a", "b", "agree").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
        place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("agree"), "b"))
        ranked = two_way.withColumn("place", place).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("place").alias("place"))
        ranked = keep(ranked, "ranked")
        links = keep(self.linked(ranked.where("place = 1"), sets).unionByName(self.ties()), "links0")
        for k, (low, high) in enumerate(ROUNDS, 1):
            groups = keep(components(links, 2), "groups")
            more = self.linked(self._apart(ranked.where(F.col("place").between(low, high)), groups), sets)
            links = links.unionByName(keep(more, f"links{k}"))
        groups = keep(components(links, 3), "groups")
        apart = self._apart(ranked.where(F.col("place") > ROUNDS[-1][1]), groups).select("a", "b")
        more = keep(self.linked(apart.unionByName(self._rest(runs, groups, sets)).distinct(), sets), "links")
        return components(links.unionByName(more))

    def ties(self) -> DataFrame:
        """Links (a, b) between the classes of each id that is used for several texts."""
        rows = self.described.where("set_id is not null and doc_id is not null").select("doc_id", "set_id")
        several = rows.groupBy("doc_id").agg(F.min("set_id").alias("x"), F.max("set_id").alias("y")).where("x <> y").select("doc_id")
        several = keep(several, "several")
        if several.isEmpty():
            return several.sparkSession.createDataFrame([], "a long, b long")
        # such ids may be many: never broadcast
        met = rows.join(several.hint("merge"), "doc_id").distinct().join(self.classes.select("set_id", "node").hint("merge"), "set_id")
        least = met.groupBy("doc_id").agg(F.min("node").alias("b"))
        return met.select("doc_id", F.col("node").alias("a")).join(least.hint("merge"), "doc_id").select("a", "b").where("a <> b")

    def rows(self) -> DataFrame:
        """doc_id, text hashes, n and set_id of every document, and its class's component (null: no shingles, or no id among its rows)."""
        classes = self.classes.join(self.groups(), "node", "left").select("set_id", F.coalesce("component", "node").alias("c"))
        return self.described.select("doc_id", "h1", "h2", "n", "set_id").join(classes, "set_id", "left")

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id and kept of every document."""
        component = F.coalesce("c", "doc_id")
        return self.rows().select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def find_groups(documents: DataFrame, k: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id, itself included) and kept."""
    return Forest(documents, k, share).result()


def keep_one(documents: DataFrame, k: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """One document of each group, that of the smallest id, with all its columns; rows without shingles stay."""
    rows = Forest(documents, k, share).rows().where("set_id is not null")
    group = F.coalesce(F.col("c").cast("string"), F.hex("set_id"))
    # the row of a group that stays, and how often it is repeated
    first = rows.groupBy(group.alias("group"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2").agg(F.count("*").alias("times"))
    stays = first.groupBy("group").agg(F.min(F.struct("no_id", "doc_id", "h1", "h2", "times")).alias("s")).select("s.*")
    stays = keep(stays.select([F.col(c).alias(f"_kept_{c}") for c in ("doc_id", "h1", "h2", "times")]), "kept")
    texts, ids = documents["`text`"], documents["`doc_id`"]
    words = F.coalesce(F.regexp_like(texts, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))

    def met(some: DataFrame) -> DataFrame:
        same = ids.eqNullSafe(some["_kept_doc_id"]) & (F.xxhash64(texts) == some["_kept_h1"]) & (F.hash(texts) == some["_kept_h2"])
        return documents.where(words).join(some.hint("merge"), same, "left_semi")

    out = documents.where(~words).unionByName(met(stays.where("_kept_times = 1")))
    again = stays.where("_kept_times > 1")
    if again.isEmpty():
        return out
    key = ["_of_id", "_of_h1", "_of_h2"]
    repeated = met(again).select("*", ids.alias(key[0]), F.xxhash64(texts).alias(key[1]), F.hash(texts).alias(key[2]))
    return out.unionByName(repeated.dropDuplicates(key).drop(*key))
