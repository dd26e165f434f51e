"""Best-fit packing of token sequences by linear grouping.

A text longer than a sequence is cut into full pieces, the first taking the
remainder.  Lengths are whole numbers up to the capacity, so the plan needs
only how many pieces there are of each length - a table that no corpus makes
longer than the capacity:

1. linear grouping: pieces longer than a share of the capacity, in falling
   order, form groups of equal count, each rounded up to its longest;
2. few sizes: the covering linear program over configurations (which sizes
   share a sequence) is solved by column generation with a knapsack for each
   new configuration, and whole multiples of it are used;
3. substitution: real pieces take the places by rank within their group, but
   for the smallest place of each configuration, which leaves each sequence
   its true gap;
4. best fit: the pieces left over and the small ones, longest first, go into
   the smallest gap that holds them, or open a new sequence (so no place is
   lost to rounding).

A plan says for runs of equal pieces (a length, and a range of ranks among
that length's pieces) which sequences and offset they get.  Ranks are counted
in parallel - a rank within the partition that cut the piece, plus what
earlier partitions hold of that length - and every piece finds its place by
binary search.

Defined cases: a null or empty text is its end id alone; repeated rows are
packed each; ties among equal lengths go by partition and order; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adresponse.llm import text, tokens
from adresponse.llm.store import keep, own_columns

CAPACITY = 2048
#: (small pieces' share of the capacity, groups): each is tried, the plan with the fewest sequences is used.
SETTINGS = ((1 / 3, 96), (1 / 4, 96))
END = 0


def cut(n: int, capacity: int) -> list[int]:
    """Piece lengths of ``n`` ids; only the first may be shorter than the capacity."""
    k = -(-n // capacity)
    return [n - (k - 1) * capacity] + [capacity] * (k - 1)


def pieces(documents: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and (part, nth): the piece's rank among those of its length and partition."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, part, so_far = tokens.Encoder.of(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            ids, texts = b["doc_id"].tolist(), b["text"].tolist()
            for s in text.groups(texts):
                flat, counts = coder.encode(texts[s], end)
                flat, out, at = flat.astype("<u4"), [], 0
                for i, n in zip(ids[s], counts.tolist()):
                    start = 0
                    for k, m in enumerate(cut(n, capacity)):
                        out.append((i, k, start, m, zlib.crc32(flat[at + start : at + start + m]), part, so_far[m]))
                        so_far[m] += 1
                        start += m
                    at += n
                yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return own_columns(documents, "doc_id", "text").mapInPandas(rows, schema)


def _configurations(sizes: list[int], demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Basis of the covering program: configurations (columns) and how often each is used."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(60 * k):
        inverse = np.linalg.inv(basis)
        used, price = inverse @ demand, inverse.sum(axis=0)
        # the most valuable configuration at these prices: an unbounded knapsack
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for i in np.argsort(-price / sizes):
            for _ in range(capacity // sizes[i]):  # so often it fits
                more = value[: -sizes[i]] + price[i]
                better = more > value[sizes[i] :] + 1e-12
                if not better.any():
                    break
                value[sizes[i] :][better], last[sizes[i] :][better] = more[better], i
        if value[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while last[c] >= 0:
            column[last[c]] += 1
            c -= sizes[last[c]]
        step = inverse @ column
        if not (step > 1e-9).any():
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, used / step, np.inf)
        basis[:, int(ratio.argmin())] = column
    return basis, np.linalg.inv(basis) @ demand


class Plan:
    """Where runs of equal pieces go: rows of (length, first rank, count, first sequence, offset)."""

    def __init__(self, count: np.ndarray, capacity: int = CAPACITY, small: float = SETTINGS[0][0], groups: int = SETTINGS[0][1]):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences (first, count)
        rest = self._large(count.astype(np.int64), int(capacity * small), groups)
        for m, first, n in sorted(rest, key=lambda r: (-r[0], r[1])):
            self._best_fit(m, first, n)
        table = np.array(sorted(self.rows), dtype=np.int64).reshape(-1, 5)
        self.table, self.key = table, (table[:, 0] << 44) + table[:, 1]

    def _large(self, count: np.ndarray, small: int, groups: int) -> list[tuple[int, int, int]]:
        """Place most of the large pieces by configurations; the others come back as (length, first rank, count)."""
        capacity = self.capacity
        if count[capacity]:  # a full piece is a sequence
            self._new(capacity, 0, int(count[capacity]), 1)
        lengths = np.arange(capacity - 1, small, -1)
        upto = np.cumsum(count[lengths])
        total = int(upto[-1]) if len(upto) else 0
        rest = [(m, 0, int(count[m])) for m in range(1, min(small, capacity - 1) + 1) if count[m]]
        if not total:
            return rest

        def segment(a: int, b: int):
            """(length, first rank of that length, count) of the ranks a..b of the large pieces, longest first."""
            i = int(np.searchsorted(upto, a, side="right"))
            while a < b:
                n = min(b, int(upto[i])) - a
                if n > 0:
                    yield int(lengths[i]), a - int(upto[i] - count[lengths[i]]), n
                a, i = a + max(n, 0), i + 1

        each = -(-total // groups)
        bounds = sorted({*range(0, total, each), total})
        by_size: dict[int, list[int]] = {}  # groups that round up to one size are one
        for a, b in zip(bounds, bounds[1:]):
            size = next(segment(a, b))[0]
            by_size[size] = [by_size[size][0] if size in by_size else a, b]
        sizes = list(by_size)
        demand = np.array([by_size[s][1] - by_size[s][0] for s in sizes], dtype=float)
        basis, used = _configurations(sizes, demand, capacity)
        at = [by_size[s][0] for s in sizes]
        for column, x in zip(basis.T, used):
            n, slots = int(x + 1e-6), []
            for g in np.flatnonzero(column > 0.5):
                slots += [g] * int(round(column[g]))
            slots = slots[:-1] or slots  # the smallest place stays open for a best fit
            for g, times in {g: slots.count(g) for g in slots}.items():
                n = min(n, (by_size[sizes[g]][1] - at[g]) // times)
            if n <= 0:
                continue
            begins = []
            for g in slots:
                begins.append(at[g])
                at[g] += n
            # sequences i of this configuration hold ranks begin + i; cut where a length changes
            parts = [list(segment(b, b + n)) for b in begins]
            edges = sorted({0, n}.union(*(np.cumsum([x[2] for x in p]).tolist() for p in parts)))
            for i, j in zip(edges, edges[1:]):
                offset = 0
                for b in begins:
                    m, first, _ = next(segment(b + i, b + j))
                    self.rows.append((m, first, j - i, self.sequences, offset))
                    offset += m
                self.open[capacity - offset].append((self.sequences, j - i))
                self.sequences += j - i
        for s, a in zip(sizes, at):
            rest += segment(a, by_size[s][1])
        return rest

    def _new(self, m: int, first: int, n: int, each: int) -> None:
        """``n`` new sequences of ``each`` pieces of one length."""
        for j in range(each):
            self.rows.append((m, first + j * n, n, self.sequences, j * m))
        self.open[self.capacity - each * m].append((self.sequences, n))
        self.sequences += n

    def _best_fit(self, m: int, first: int, n: int) -> None:
        gaps = sorted(g for g, runs in self.open.items() if g >= m and runs)
        for gap in gaps:
            each = gap // m  # after one piece the same sequence is the tightest for the next
            runs = self.open[gap]
            while n and runs:
                begin, many = runs.pop()
                fill = min(many, n // each)
                self._fill(m, first, begin, fill, gap, each)
                first, n = first + fill * each, n - fill * each
                if fill < many and n < each and n:
                    self._fill(m, first, begin + fill, 1, gap, n)
                    first, n, fill = first + n, 0, fill + 1
                if fill < many:
                    runs.append((begin + fill, many - fill))
            if not n:
                return
        each = self.capacity // m
        if n // each:
            self._new(m, first, n // each, each)
            first, n = first + n // each * each, n % each
        if n:
            self._new(m, first, 1, n)

    def _fill(self, m: int, first: int, begin: int, many: int, gap: int, each: int) -> None:
        if many:
            for j in range(each):
                self.rows.append((m, first + j * many, many, begin, self.capacity - gap + j * m))
            self.open[gap - each * m].append((begin, many))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces given by length and rank among their length."""
        row = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        return self.table[row, 3] + rank - self.table[row, 1], self.table[row, 4]


def pack(documents: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY, settings=SETTINGS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut_up = keep(pieces(documents, tokenizer, end, capacity), "pieces")
    by_part = cut_up.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    by_part = keep(by_part.withColumn("before", F.coalesce(before, F.lit(0))), "piece-counts")
    count = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length
        count[r.length] = r.n
    plan = min((Plan(count, capacity, *s) for s in settings), key=lambda p: p.sequences)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = plan.place(b["length"].to_numpy(), b.pop("rank").to_numpy())
            yield b.assign(sequence_id=sequence, offset=offset)

    ranked = cut_up.join(by_part.select("length", "part", "before"), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))
    return ranked.mapInPandas(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
