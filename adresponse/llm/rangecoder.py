"""Token files: ids by an adaptive context-mixing range coder in independent blocks.

Each block of up to ``BLOCK`` ids starts from an empty model and has a CRC-32
of its ids, so any block can be read, or found damaged, alone.  Every id is
coded under one distribution, a weighted sum of three: all on the id that last
followed the two before it (order 2), all on the id that last followed the one
before it (order 1), and how often each id came in the block so far (order 0,
brought up to date every ``EPOCH`` ids; ids that did not come keep a share).
How far the first two have been right lately picks the set of weights, which
adapt by what comes.  An id's interval is its order-0 interval, scaled by that
weight, moved by the weights of the predicted ids below it and widened by
those that predicted it.  Ids are below ``LIMIT``; larger ones are a
ValueError before a chunk is made.

The coder keeps 64-bit bounds and writes 32-bit words, at most one for an id.
Blocks are coded side by side, one id of each at a time, as numpy columns.

A file part is one row (part, chunk, tokens, blob): parts in order of document
ids, chunks of whole documents in order within a part.  The blob holds the
header, the documents' ids and counts, the block table, the words, and a
CRC-32 over all before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adresponse.llm import text, tokens
from adresponse.llm.store import keep, own_columns

BLOCK, EPOCH, LANES = 2048, 256, 512
MAGIC = b"TKRC0002"
VOCAB = 1 << 16  # of blocks that name none; a chunk's is its largest id and one
LIMIT = 1 << 18  # no id may reach it
SLOTS = 1024  # contexts of each order that a block remembers
GAIN0 = 160  # what one occurrence adds to an id's frequency
WEIGHTS = (2, 1, 3)  # of orders 2, 1 and 0 before anything came; one more for each time that one held
WORD, LOW32 = np.uint64(32), np.uint64((1 << 32) - 1)
HIT = 1 << 20  # a context's entry: id + 1, and above this bit how often it has held (1 to 4)


class _Model:
    """Predictions for one id of every block at a time."""

    def __init__(self, lanes: int, vocab: int):
        self.lane, self.vocab = np.arange(lanes), vocab
        self.seen = [np.zeros(lanes * SLOTS, dtype=np.int32) for _ in range(2)]  # orders 1 and 2
        start = np.tile(np.array(WEIGHTS, dtype=np.int64), (64, 1))
        start[:8, 0] = start[::8, 1] = start[5, 1] = 0  # a context that remembers nothing predicts nothing
        self.weight = np.tile(start, (lanes, 1))
        self.rows, self.slots = self.lane * 64, self.lane * SLOTS
        self.last, self.before = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
        self.n, self.total = 0, vocab

    def predict(self, m: int) -> None:
        """Look up the contexts of the first ``m`` blocks."""
        self.m, last, base = m, self.last[:m], self.slots[:m]
        self.at = (base + ((last * 2654435761 >> 11) & (SLOTS - 1)), base + (((last * 2246822519 + self.before[:m] * 3266489917) >> 13) & (SLOTS - 1)))
        self.entry = [s.take(i) for s, i in zip(self.seen, self.at)]
        self.first, self.second = [(e & (HIT - 1)) - 1 for e in self.entry]
        one, two = [e >> 20 for e in self.entry]
        one[self.first == self.second] = 5
        self.state = self.rows[:m] + (two * 8 + one)
        self.w2, self.w1, self.w0 = self.weight.take(self.state, axis=0).T

    def learn(self, x: np.ndarray, held: np.ndarray) -> None:
        """Take in the ids that came and the highest order that gave them its all (0: order 2, 1: order 1, 2: neither)."""
        fresh = ((x + 1) | HIT).astype(np.int32)
        for s, i, e, p in zip(self.seen, self.at, self.entry, (self.first, self.second)):
            s[i] = np.where(p == x, e + HIT * (e < 4 * HIT), fresh)
        self.weight.ravel()[self.state * 3 + held] += 1
        self.before[: self.m] = self.last[: self.m]
        self.last[: self.m] = x

    def count(self, ids: np.ndarray) -> None:
        """Order 0 from the ids so far (a row for each block)."""
        lanes, n = ids.shape
        self.n, self.total = n, self.vocab + GAIN0 * n
        s = np.sort(ids, axis=1).astype(np.int64)
        new = np.ones((lanes, n), dtype=bool)
        new[:, 1:] = s[:, 1:] != s[:, :-1]
        place = np.arange(n)
        first = np.maximum.accumulate(np.where(new, place, 0), axis=1)
        end = np.ones((lanes, n), dtype=bool)
        end[:, :-1] = new[:, 1:]
        last = np.minimum.accumulate(np.where(end, place, n)[:, ::-1], axis=1)[:, ::-1]
        row = np.arange(lanes)[:, None]
        self.sorted = s.ravel()
        self.key = (s + row * self.vocab).ravel()  # one rising row for all blocks
        self.step = (s + GAIN0 * place + row * (2 * self.total)).ravel()
        self.begin, self.many = first.ravel(), (last - first + 1).ravel()

    def interval(self, lane: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order-0 start and width of ids."""
        if not self.n:
            return x, np.ones_like(x)
        at = np.searchsorted(self.key, x + lane * self.vocab)
        there = np.minimum(at, len(self.key) - 1)
        many = np.where(self.key[there] == x + lane * self.vocab, self.many[there], 0)
        return x + GAIN0 * (at - lane * self.n), 1 + GAIN0 * many

    def find(self, lane: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id whose order-0 interval holds ``v``, its start and width."""
        if not self.n:
            return v, v, np.ones_like(v)
        base = lane * self.n
        at = np.searchsorted(self.step, v + lane * (2 * self.total), side="right") - 1
        j = at - base  # below 0: less than every id so far
        some = j >= 0
        at = np.where(some, at, base)
        s, above = self.sorted[at], np.where(some, GAIN0 * (j + 1), 0)
        same = some & (v <= s + above)
        x = np.where(same, s, v - above)
        return x, np.where(same, s + GAIN0 * self.begin[at], v), np.where(same, 1 + GAIN0 * self.many[at], 1)


def _settle(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Blocks whose next word is settled; where bounds are close but not alike, the interval is cut at the word's end."""
    alike = (low ^ (low + (width - np.uint64(1)))) <= LOW32
    close = width <= LOW32
    cut = close & ~alike
    if cut.any():
        width[cut] = LOW32 + np.uint64(1) - (low[cut] & LOW32)
    return alike | close


def _shift(low: np.ndarray, width: np.ndarray, go: np.ndarray) -> None:
    np.copyto(low, low << WORD, where=go)
    np.copyto(width, np.minimum(width, LOW32) << WORD, where=go)


def encode_blocks(ids: np.ndarray, vocab: int = VOCAB) -> list[bytes]:
    """The words of each block of ``BLOCK`` ids (the last may be shorter)."""
    out: list[bytes] = []
    for a in range(0, len(ids), BLOCK * LANES):
        out += _encode(ids[a : a + BLOCK * LANES].astype(np.int64), vocab)
    return out


def _encode(ids: np.ndarray, vocab: int) -> list[bytes]:
    lanes = -(-len(ids) // BLOCK)
    full = len(ids) // BLOCK  # only the last block may end early
    table = np.zeros((lanes, BLOCK), dtype=np.int64)
    table.ravel()[: len(ids)] = ids
    by_time = np.ascontiguousarray(table.T)
    model = _Model(lanes, vocab)
    low, width = np.zeros(lanes, dtype=np.uint64), np.full(lanes, ~np.uint64(0))
    room = BLOCK + 4
    words = np.zeros(lanes * room, dtype="<u4")
    begin = np.arange(lanes) * room
    at = begin.copy()

    for t in range(BLOCK):
        m = lanes if t < len(ids) - (lanes - 1) * BLOCK else full
        if not m:
            break
        if t and t % EPOCH == 0:
            model.count(table[:, :t])
        if t % EPOCH == 0:
            ahead = table[:, t : t + EPOCH]  # block by block, so that a search stays within a block's rows
            start0, width0 = (np.ascontiguousarray(v.reshape(ahead.shape).T) for v in model.interval(np.repeat(model.lane, ahead.shape[1]), ahead.ravel()))
        x = by_time[t, :m]
        model.predict(m)
        first, second, total = model.first, model.second, model.total
        is1, is2 = x == first, x == second
        held = np.where(is2, 0, 2 - is1)
        w2, w1, w0 = model.w2, model.w1, model.w0
        lo, wi = low[:m], width[:m]
        wi //= ((w2 + w1 + w0) * total).view(np.uint64)
        lo += wi * (w0 * start0[t % EPOCH, :m] + total * (w1 * (first < x) + w2 * (second < x))).view(np.uint64)
        wi *= (w0 * width0[t % EPOCH, :m] + total * (w1 * is1 + w2 * is2)).view(np.uint64)
        go = _settle(lo, wi)
        words[at[:m]] = lo >> WORD  # kept where the place moves on
        at[:m] += go
        _shift(lo, wi, go)
        model.learn(x, held)
    for k in (32, 0):
        words[at] = (low >> np.uint64(k)) & LOW32
        at += 1
    return [words[b:e].tobytes() for b, e in zip(begin.tolist(), at.tolist())]


def decode_blocks(blocks: list[bytes], n: int, vocab: int = VOCAB) -> np.ndarray:
    """The ``n`` ids of consecutive blocks."""
    out = [_decode(blocks[a : a + LANES], min(n - a * BLOCK, BLOCK * LANES), vocab) for a in range(0, len(blocks), LANES)]
    return np.concatenate(out).astype(np.uint32) if out else np.zeros(0, dtype=np.uint32)


def _decode(blocks: list[bytes], n: int, vocab: int) -> np.ndarray:
    lanes, full = len(blocks), n // BLOCK
    room = max(map(len, blocks)) // 4 + 2  # past a block's end stand zeros
    words = np.zeros((lanes, room), dtype=np.uint64)
    for i, b in enumerate(blocks):
        words[i, : len(b) // 4] = np.frombuffer(b, dtype="<u4")
    words, at = words.ravel(), np.arange(lanes) * room
    model = _Model(lanes, vocab)
    table = np.zeros((lanes, BLOCK), dtype=np.int64)
    low, width = np.zeros(lanes, dtype=np.uint64), np.full(lanes, ~np.uint64(0))
    code = (words[at] << WORD) | words[at + 1]
    at += 2

    for t in range(BLOCK):
        m = lanes if t < n - (lanes - 1) * BLOCK else full
        if not m:
            break
        if t and t % EPOCH == 0:
            model.count(table[:, :t])
        model.predict(m)
        first, second, total = model.first, model.second, model.total
        w2, w1, w0 = model.w2, model.w1, model.w0
        lo, wi, co = low[:m], width[:m], code[:m]
        whole = (w2 + w1 + w0) * total
        wi //= whole.view(np.uint64)
        v = np.minimum((co - lo) // wi, (whole - 1).view(np.uint64)).view(np.int64)
        # the predicted ids in order, and where their intervals lie; one that is none has no weight
        a, b = np.maximum(np.minimum(first, second), 0), np.maximum(np.maximum(first, second), 0)
        turned, same = first > second, a == b
        more_a, more_b = total * np.where(turned, w2, w1), total * np.where(turned, w1, w2)
        more_a += more_b * same
        more_b[same] = 0
        start0, width0 = model.interval(np.concatenate((model.lane[:m], model.lane[:m])), np.concatenate((a, b)))
        start_a, start_b = w0 * start0[:m], w0 * start0[m:] + more_a
        size_a, size_b = w0 * width0[:m] + more_a, w0 * width0[m:] + more_b
        is_a, is_b = (v >= start_a) & (v < start_a + size_a), (v >= start_b) & (v < start_b + size_b)
        x, start, size = np.where(is_a, a, b), np.where(is_a, start_a, start_b), np.where(is_a, size_a, size_b)
        rest = np.flatnonzero(~(is_a | is_b))
        below = more_a[rest] * (v[rest] >= start_a[rest]) + more_b[rest] * (v[rest] >= start_b[rest])
        x[rest], s0, n0 = model.find(rest, (v[rest] - below) // w0[rest])
        start[rest], size[rest] = w0[rest] * s0 + below, w0[rest] * n0
        lo += wi * start.view(np.uint64)
        wi *= size.view(np.uint64)
        held = np.where(x == second, 0, 2 - (x == first))
        go = _settle(lo, wi)
        np.copyto(co, (co << WORD) | words[at[:m]], where=go)
        at[:m] += go
        _shift(lo, wi, go)
        model.learn(x, held)
        table[:m, t] = x
    return table.ravel()[:n]


def write_chunk(ids: np.ndarray, doc_ids: list, counts: np.ndarray) -> bytes:
    """One self-contained chunk: whole documents' ids."""
    vocab = int(ids.max(initial=0)) + 1
    if vocab > LIMIT:
        raise ValueError(f"id {vocab - 1} is not below {LIMIT}")
    blocks = encode_blocks(ids, vocab)
    raw = ids.astype("<u4")
    checks = [zlib.crc32(raw[i * BLOCK : (i + 1) * BLOCK]) for i in range(len(blocks))]
    parts = [
        MAGIC,
        struct.pack("<QQQQ", len(ids), len(blocks), len(doc_ids), vocab),
        np.array([d is not None for d in doc_ids], dtype=np.uint8).tobytes(),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.asarray(counts, dtype="<i8").tobytes(),
        np.array([[len(b), c] for b, c in zip(blocks, checks)], dtype="<u4").tobytes(),
        *blocks,
    ]
    whole = b"".join(parts)
    return whole + struct.pack("<I", zlib.crc32(whole))


def read_chunk(blob: bytes) -> tuple[np.ndarray, list, np.ndarray]:
    """Ids, document ids and counts of a chunk; ValueError if anything is damaged."""
    if len(blob) < 44 or blob[:8] != MAGIC or struct.unpack("<I", blob[-4:])[0] != zlib.crc32(blob[:-4]):
        raise ValueError("not a token chunk, or a damaged one")
    n, n_blocks, n_docs, vocab = struct.unpack_from("<QQQQ", blob, 8)
    at = 40
    known = np.frombuffer(blob, dtype=np.uint8, count=n_docs, offset=at)
    doc_ids = np.frombuffer(blob, dtype="<i8", count=n_docs, offset=(at := at + n_docs))
    counts = np.frombuffer(blob, dtype="<i8", count=n_docs, offset=(at := at + 8 * n_docs))
    table = np.frombuffer(blob, dtype="<u4", count=2 * n_blocks, offset=(at := at + 8 * n_docs)).reshape(-1, 2)
    at += 8 * n_blocks
    ends = at + np.cumsum(table[:, 0].astype(np.int64))
    ids = decode_blocks([blob[e - s : e] for s, e in zip(table[:, 0].tolist(), ends.tolist())], n, vocab)
    raw = ids.astype("<u4")
    for i, check in enumerate(table[:, 1].tolist()):
        if zlib.crc32(raw[i * BLOCK : (i + 1) * BLOCK]) != check:
            raise ValueError(f"block {i} is damaged")
    return ids, [int(d) if k else None for d, k in zip(doc_ids, known)], counts


def write_documents(documents: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """The token file of all documents, in ascending doc_id order, as rows (part, chunk, tokens, blob)."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, part, k = tokens.Encoder.of(tokenizer), TaskContext.get().partitionId(), 0
        ids, names, counts, size = [], [], [], 0
        for b in batches:
            texts, doc_ids = b["text"].tolist(), [None if pd.isna(d) else int(d) for d in b["doc_id"]]
            for s in text.groups(texts):
                flat, n = coder.encode(texts[s], end)
                ids.append(flat)
                names += doc_ids[s]
                counts.append(n)
                size += len(flat)
                if size >= BLOCK * LANES:
                    yield chunk(part, k, ids, names, counts)
                    k, ids, names, counts, size = k + 1, [], [], [], 0
        if names:
            yield chunk(part, k, ids, names, counts)

    def chunk(part: int, k: int, ids: list, names: list, counts: list) -> pd.DataFrame:
        flat = np.concatenate(ids)
        return pd.DataFrame({"part": [part], "chunk": [k], "tokens": [len(flat)], "blob": [write_chunk(flat, names, np.concatenate(counts))]})

    ordered = own_columns(documents, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return keep(ordered.mapInPandas(chunks, "part int, chunk int, tokens long, blob binary"), "token-file")


def read_documents(file: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from a token file."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, k, blob in zip(b["part"], b["chunk"], b["blob"]):
                ids, names, counts = read_chunk(bytes(blob))
                raw, ends = ids.astype("<u4"), np.cumsum(counts)
                checks = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist())]
                out = pd.DataFrame({"part": part, "chunk": k, "doc_id": pd.array(names, dtype="Int64"), "at": ends - counts, "n_tokens": counts, "ids_crc32": checks})
                yield out

    sizes = file.select("part", "chunk", "tokens")
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file part
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("ahead", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    begins = sizes.join(parts, "part").select("part", "chunk", (F.col("before") + F.col("ahead")).alias("begin"))
    docs = file.select("part", "chunk", "blob").mapInPandas(rows, "part int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long")
    docs = keep(docs, "token-file-documents")  # the file is decoded once, however the join is planned
    return docs.join(begins, ["part", "chunk"]).select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
