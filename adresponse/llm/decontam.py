"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A document is contaminated by an item if a Smith-Waterman alignment over words
(``MATCH``, ``MISMATCH``, ``GAP``) keeps at least ``SHARE``, a half, of the
item's own score: copies with words changed, left out or put in.

Seeds are pairs of an item's words one or two places apart, looked up among
the text's pairs one or two places apart.  They lose nothing: of an alignment
with m matches whose penalties add up to c, 2m - c >= n for an item of n words,
so at most c/2 of the m - 1 steps between matches cost two or more, and at least
m - 1 - c/2 >= n/2 - 1 steps cost at most one, which is such a pair.  As those
begin at different places of the item, all but (n - 1) // 2 - 1 of its n - 1
beginnings are enough to meet one of them.  One scan of the documents counts
the seeds, each item keeps the beginnings whose seeds are rarest, and a second
scan joins these with the documents.

An alignment spans at most 2n words of the text, so a hit asks for two windows
of 4n words on a grid of steps of 2n.  A window goes on if it holds at least
half of the item's words in any order, without which no alignment can reach the
share, and is aligned with the item.

The benchmark is taken in blocks of at most ``BLOCK_SEEDS`` seeds, so what each
task holds of it is bounded whatever its size; hits are worked off ``HITS`` at
a time, so a seed of many items or a text of one word doesn't fill a task.

Defined cases: null or empty texts match nothing; an item of one or two words
needs all of them (two words at most two places apart); repeated items are each
reported; repeated rows are each reported; ties among passages go to the
earlier; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm import text
from adresponse.llm.store import keep, own_columns

MATCH, MISMATCH, GAP = 2, -1, -1
SHARE = 0.5  # what the seeds' bound is made for
BLOCK_SEEDS = 1 << 21
HITS = 1 << 20
TOGETHER = 256  # windows handed on at a time
AREA = 1 << 21  # words of the windows that are aligned side by side
APART = (1, 2)
U = np.uint64


def pairs(words: np.ndarray, apart: int) -> np.ndarray:
    """Hashes of the ordered pairs of words so many places apart, by the place of the first."""
    with np.errstate(over="ignore"):
        return text.mix(words[:-apart] * U(0x9E3779B97F4A7C15) + text.mix(words[apart:]))


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and where it ends in passage and item (words).

    All pairs go side by side, an item word at a time; gaps along the passage
    are settled by a running maximum.
    """
    n = len(items)
    rows, width = max(map(len, items)), max(map(len, passages))
    x = np.zeros((rows, n), dtype=np.uint64)
    y = np.ones((n, width), dtype=np.uint64)
    valid_x, valid_y = np.zeros((rows, n), dtype=bool), np.zeros((n, width), dtype=bool)
    for i, (a, b) in enumerate(zip(items, passages)):
        x[: len(a), i], y[i, : len(b)] = a, b
        valid_x[: len(a), i], valid_y[i, : len(b)] = True, True
    score = np.zeros((n, width + 1), dtype=np.int32)
    best, at, row = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    slope = GAP * np.arange(width + 1, dtype=np.int32)
    for r in range(rows):
        same = (y == x[r][:, None]) & valid_y & valid_x[r][:, None]
        new = np.zeros_like(score)
        new[:, 1:] = np.maximum(score[:, :-1] + np.where(same, MATCH, MISMATCH), score[:, 1:] + GAP)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - slope, axis=1) + slope  # gaps along the passage
        top = new.argmax(axis=1)
        value = new[np.arange(n), top]
        more = value > best
        best, at, row = np.where(more, value, best), np.where(more, top, at), np.where(more, r + 1, row)
        score = new
    return best, at, row


class Block:
    """Some items' words and seeds; a seed knows its item and the place there where it begins."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        words, counts = _words([t for _, t in items])
        self.words = np.split(words, np.cumsum(counts)[:-1]) if len(items) else []
        self.lengths = counts
        seeds, item, begin = [np.zeros(0, dtype=U)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for k, w in enumerate(self.words):
            own = [w[:1]] if len(w) == 1 else [pairs(w, d) for d in APART if len(w) > d]
            seeds += own
            item += [np.full(len(s), k) for s in own]
            begin += [np.arange(len(s)) for s in own]
        self._index(np.concatenate(seeds), np.concatenate(item), np.concatenate(begin))

    def _index(self, seed: np.ndarray, item: np.ndarray, begin: np.ndarray) -> None:
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.begin = seed[order], item[order], begin[order]
        self.known, self.first, self.times = np.unique(self.seed, return_index=True, return_counts=True)
        bits = max(16, int(16 * len(self.known)).bit_length())
        self.shift = U(64 - bits)
        self.maybe = np.zeros(1 << bits, dtype=bool)  # a quick no for most pairs
        self.maybe[(self.known >> self.shift).astype(np.int64)] = True
        self.single = bool((self.lengths == 1).any())

    def keep_rarest(self, counts: np.ndarray) -> None:
        """Drop the seeds that the bound lets go without: the most frequent beginnings of each item, by the count of each known seed."""
        often = np.repeat(counts, self.times)
        n = self.lengths[self.item]
        per_begin = np.zeros(int(self.lengths.sum()) + 1, dtype=np.int64)
        start = np.cumsum(self.lengths) - self.lengths
        np.add.at(per_begin, start[self.item] + self.begin, often)
        kept = np.ones(len(per_begin), dtype=bool)
        for k, length in enumerate(self.lengths.tolist()):
            spare = (length - 1) // 2 - 1
            if spare > 0:
                own = per_begin[start[k] : start[k] + length - 1]
                kept[start[k] + np.argsort(own, kind="stable")[len(own) - spare :]] = False
        stay = kept[start[self.item] + self.begin] | (n < 3)
        self._index(self.seed[stay], self.item[stay], self.begin[stay])

    def matches(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, number of the known seed) of every seed in a slice of texts; pairs don't cross from one text to the next."""
        for apart in (0, *APART) if self.single else APART:
            if len(words) <= apart:
                continue
            grams = pairs(words, apart) if apart else words
            some = np.flatnonzero(self.maybe[(grams >> self.shift).astype(np.int64)])
            at = np.searchsorted(self.known, grams[some])
            ok = at < len(self.known)
            some, at = some[ok], at[ok]
            ok = (self.known[at] == grams[some]) & (doc[some] == doc[some + apart])
            yield some[ok], at[ok]

    def hits(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, item) of every seed's occurrence, at most some ``HITS`` at a time."""
        for place, known in self.matches(words, doc):
            n = self.times[known]
            total = np.cumsum(n)
            a = 0
            while a < len(n):
                done = total[a] - n[a]
                b = max(a + 1, int(np.searchsorted(total, done + HITS, side="right")))
                each = n[a:b]
                rows = np.arange(int(each.sum())) + np.repeat(self.first[known[a:b]] - (total[a:b] - each - done), each)
                yield np.repeat(place[a:b], each), self.item[rows]
                a = b


def blocks(benchmark: DataFrame, most: int = BLOCK_SEEDS) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, one at a time."""
    rows = own_columns(benchmark, "item_id", "text").where("text is not null").orderBy("item_id", "text")
    part, seeds = [], 0
    for r in rows.toLocalIterator():
        n = len(r.text.split())
        if part and seeds + n > most:
            yield Block(part)
            part, seeds = [], 0
        part.append((r.item_id, r.text))
        seeds += n
    if part:
        yield Block(part)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words in any case and with any punctuation, so that a reset copy is still a copy."""
    return text.word_hashes([(t or "").lower() for t in texts], letters=True)


def _slices(texts: list) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of texts with all their words and each text's number of words."""
    for s in text.groups(texts):
        yield s, *_words(texts[s])


def _counted(documents: DataFrame, block: Block) -> np.ndarray:
    """How often each known seed of the block occurs in the documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(block.known), dtype=np.int64)
        for b in batches:
            for _, words, counts in _slices(b["text"].tolist()):
                for _, known in block.matches(words, np.repeat(np.arange(len(counts)), counts)):
                    total += np.bincount(known, minlength=len(total))
        used = np.flatnonzero(total)
        yield pd.DataFrame({"seed": used, "n": total[used]})

    out = np.zeros(len(block.known), dtype=np.int64)
    # as many numbers as the block has seeds
    for r in documents.mapInPandas(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["seed"]] = r["n"]
    return out


def windows(place: np.ndarray, doc: np.ndarray, item: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Distinct (doc, item, first word) of the windows that hits at these places of their texts ask for."""
    step = 2 * lengths[item]
    cell = place // step
    both = np.stack([np.tile(doc, 2), np.tile(item, 2), np.concatenate([cell, np.maximum(cell - 1, 0)]) * np.tile(step, 2)], axis=1)
    return np.unique(both, axis=0)


def _in_block(documents: DataFrame, block: Block) -> DataFrame:
    """doc_id, item_id, score and spans of contaminated documents, by the items of one block."""
    block.keep_rarest(_counted(documents, block))
    listed = [w.tolist() for w in block.words]

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Windows that hold a seed of an item and enough of its words to reach ``SHARE``."""
        for b in batches:
            ids, out = b["doc_id"].tolist(), []
            for s, words, counts in _slices(b["text"].tolist()):
                doc, start = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
                done: set = set()
                for place, item in block.hits(words, doc):
                    own = doc[place]
                    for d, k, first in map(tuple, windows(place - start[own], own, item, block.lengths).tolist()):
                        if (d, k, first) in done:
                            continue
                        done.add((d, k, first))
                        passage = words[start[d] + first : start[d] + min(counts[d], first + 4 * len(listed[k]))]
                        # each match needs a word of the item in the window, so fewer can't reach the share
                        there = set(passage.tolist())
                        if sum(w in there for w in listed[k]) >= SHARE * len(listed[k]):
                            out.append((ids[s.start + d], k, first, passage.astype("<u8").tobytes()))
                        if len(out) >= TOGETHER:
                            yield pd.DataFrame(out, columns=["doc_id", "item", "first", "passage"])
                            out = []
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "item", "first", "passage"])

    found = keep(documents.mapInPandas(occurrences, "doc_id long, item int, first long, passage binary"), "seed-hits")

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            items, passages = b["item"].tolist(), b["passage"].tolist()
            each = np.array([max(len(p) // 8, len(block.words[k])) for k, p in zip(items, passages)])
            order = np.argsort(each, kind="stable")  # alike lengths together
            at = 0
            while at < len(order):
                # the widest of the next ones bounds what they take side by side
                wide = each[order[at:]] * np.arange(1, len(order) - at + 1)
                end = at + max(1, int(np.searchsorted(wide, AREA, side="right")))
                part = b.iloc[order[at:end]]
                at = end
                # equal windows are aligned once
                distinct = list(dict.fromkeys(zip(part["item"], part["passage"])))
                score, last, _ = align([block.words[k] for k, _ in distinct], [np.frombuffer(p, dtype="<u8") for _, p in distinct])
                known = {p: i for i, p in enumerate(distinct)}
                where = np.array([known[p] for p in zip(part["item"], part["passage"])])
                own = np.array([MATCH * len(block.words[k]) for k in part["item"]])
                out = pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "item_id": pd.array([block.ids[k] for k in part["item"]], dtype="Int64"), "score": score[where] / own})
                out["end_word"], out["item_words"] = part["first"].to_numpy() + last[where], own // MATCH
                # an item of two words needs both
                yield out[(out["score"] >= SHARE) & ((out["item_words"] != 2) | (out["score"] > SHARE))]

    return found.mapInPandas(aligned, "doc_id long, item_id long, score double, end_word long, item_words long")


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score (share of the item's own score), end_word and item_words: the best passage of every contaminated document and item."""
    docs = own_columns(documents, "doc_id", "text")
    found = None
    for block in blocks(benchmark):
        part = _in_block(docs, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, end_word long, item_words long")
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("end_word")).alias("end"), "item_words")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b.end")).alias("end_word"), F.col("b.item_words").alias("item_words"))


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that no item contaminates, with all their columns (a null doc_id never counts as contaminated)."""
    bad = contaminated(documents, benchmark).select(F.col("doc_id").alias("_bad_id")).distinct()
    return documents.join(bad, documents["doc_id"] == bad["_bad_id"], "left_anti")
