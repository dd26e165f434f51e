"""Vectors as short codes, one codebook entry for each part of a vector.

Components become integers, and vectors are written once in blocks: for each
dimension the sorted distinct integers of the block (its dictionary) and every
row's places in them.  A round tabulates the squared difference of every
dictionary value to that dimension's part of all entries; the distances of a
row's part to all entries are then gathered rows of these tables, added up
over the part's dimensions.  Per part and entry a task sends the sum and the
count of its rows on, added up by Spark; only the codebooks reach the driver.

A block is bounded by its number of components, so its dictionaries and tables
are bounded too, however many values a dimension has in the whole table.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do those of another length than most (on a tie the longer)
and empty ones; with a length that ``PARTS`` doesn't divide, the first parts
are one component longer; scaled components beyond ``LARGEST`` in size are set
to it; rows that repeat an id are vectors of their own; rows without an id are
coded and never begin a codebook; with fewer vectors than entries the
codebooks are shorter, and a table without any gives an empty result, as an
empty table does; an error sum beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import drop, keep, own_columns

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 1 << 27
BLOCK = 1 << 18  # components
BLOCKS = "ids array<bigint>, labels array<string>, sizes array<int>, entries binary, places binary"


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label (as text) and ``v`` (ints, ``floor(scale * x)``) of the vectors that take part."""
    rows = own_columns(embeddings, "vec_id", "embedding", "label").where(F.size("embedding") > 0)
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where(finite)
    # one row: the length that most have
    usual = rows.groupBy(F.size("embedding").alias("length")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "length"))["length"].alias("usual"))
    bound = float(LARGEST)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(bound)), F.lit(-bound))).cast("int"))
    met = rows.join(F.broadcast(usual), F.size("embedding") == F.col("usual"))
    return met.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("v"))


def blocks(vectors: DataFrame) -> DataFrame:
    """The vectors in blocks of dictionary codes: ids, labels, dictionary sizes, dictionaries and places (dimension by dimension)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = np.stack(b["v"].to_numpy()).astype(np.int32)
            most = max(1, BLOCK // x.shape[1])
            for a in range(0, len(x), most):
                part = x[a : a + most]
                found = [np.unique(column, return_inverse=True) for column in part.T]
                yield pd.DataFrame(
                    {
                        "ids": [[None if pd.isna(i) else int(i) for i in b["vec_id"][a : a + most]]],
                        "labels": [list(b["label"][a : a + most])],
                        "sizes": [[len(values) for values, _ in found]],
                        "entries": [np.concatenate([values for values, _ in found]).astype("<i4").tobytes()],
                        "places": [np.stack([places for _, places in found]).astype("<i4").tobytes()],
                    }
                )

    return vectors.mapInPandas(run, BLOCKS)


def bounds(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Begin and end of each part."""
    ends = np.cumsum([length // parts + (i < length % parts) for i in range(parts)]).tolist()
    return list(zip([0, *ends], ends))


def nearest(values: list[np.ndarray], places: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry (the first of the nearest) and squared distance of each row's part: gathers of tabulated squares, added up."""
    if not len(values):  # a part without components
        return np.zeros(places.shape[1], dtype=np.int64), np.zeros(places.shape[1], dtype=np.int64)
    furthest = max(max(abs(int(v[0])), abs(int(v[-1]))) for v in values) + int(np.abs(book).max())
    kind = np.int32 if furthest * furthest * len(values) < 2**31 else np.int64
    total = np.zeros((places.shape[1], len(book)), dtype=kind)
    for d, v in enumerate(values):
        table = (v[:, None].astype(kind) - book[:, d].astype(kind)) ** 2
        total += table[places[d]]
    entry = total.argmin(axis=1)
    return entry, total[np.arange(len(entry)), entry].astype(np.int64)


def unpack(row) -> tuple[list[np.ndarray], np.ndarray]:
    """Dictionaries and places of a block's row."""
    sizes = np.asarray(row.sizes)
    values = np.split(np.frombuffer(row.entries, dtype="<i4").astype(np.int64), np.cumsum(sizes)[:-1])
    return values, np.frombuffer(row.places, dtype="<i4").reshape(len(sizes), -1)


def first_books(vectors: DataFrame, entries: int, parts: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids."""
    first = vectors.where("vec_id is not null").select("vec_id", "v").orderBy("vec_id", "v").limit(entries)
    rows = [r.v for r in first.collect()]  # as many vectors as entries
    if not rows:
        return []
    x = np.array(rows, dtype=np.int64)
    return [x[:, a:b] for a, b in bounds(x.shape[1], parts)]


def moved(coded: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry at the floor of the mean of the parts nearest to it; an unused one stays."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros((len(b), b.shape[1] + 1), dtype=np.int64) for b in books]
        for batch in batches:
            for row in batch.itertuples():
                values, places = unpack(row)
                for (a, b), book, sums in zip(bounds(len(values), len(books)), books, total):
                    entry, _ = nearest(values[a:b], places[a:b], book)
                    sums[:, 0] += np.bincount(entry, minlength=len(book))
                    for d in range(a, b):
                        # whole numbers below 2**53, so the doubles are exact
                        sums[:, d - a + 1] += np.bincount(entry, weights=values[d][places[d]], minlength=len(book)).astype(np.int64)
        for part, sums in enumerate(total):
            used = np.flatnonzero(sums[:, 0])
            yield pd.DataFrame({"part": part, "entry": used, "sums": list(sums[used])})

    parts = coded.mapInPandas(sums, "part int, entry int, sums array<bigint>")
    added = parts.select("part", "entry", F.posexplode("sums").alias("at", "v")).groupBy("part", "entry", "at").agg(F.sum("v").alias("v"))
    out = [b.copy() for b in books]
    rows = added.groupBy("part", "entry").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("sums")).collect()  # the codebooks' size
    for r in rows:
        n, *each = [s["v"] for s in r["sums"]]
        out[r["part"]][r["entry"]] = [s // n for s in each]
    return out


def code_rows(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    digits = np.array([f"{i:02x}" for i in range(max(map(len, books), default=0))], dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                values, places = unpack(row)
                code, error = "", 0
                for (a, b), book in zip(bounds(len(values), len(books)), books):
                    entry, away = nearest(values[a:b], places[a:b], book)
                    code, error = code + digits[entry], error + away
                yield pd.DataFrame({"vec_id": pd.array(list(row.ids), dtype="Int64"), "label": list(row.labels), "code": code, "error": error})

    return coded.mapInPandas(run, "vec_id long, label string, code string, error long")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """Code and error of every vector that takes part, and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    vectors = keep(whole_vectors(embeddings, scale), "part-vectors")
    books = first_books(vectors, entries, parts)
    if not books:
        spark = embeddings.sparkSession
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), []
    coded = keep(blocks(vectors), "part-blocks")
    drop(vectors)
    for _ in range(rounds):
        books = moved(coded, books)
    return keep(code_rows(coded, books), "part-codes"), books


def codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that takes part."""
    rows, books = compress(embeddings)
    flat = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    name = hashlib.sha256(flat.encode()).hexdigest()
    per_label = rows.groupBy(F.col("label").alias("of")).agg(F.expr("try_sum(error)").alias("label_error"))
    # a label may hold most rows: its row of sums is small, and the rows' side is split by AQE
    met = rows.join(per_label, rows["label"].eqNullSafe(per_label["of"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))
