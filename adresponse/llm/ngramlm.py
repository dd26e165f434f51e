"""Language-model scores from a sharded Elias-Fano n-gram trie.

Training texts are counted where they are read: each slice of texts sends one
compact blob to every shard, with the words of that shard, their counts and
below them the distinct successors of each word, of each pair and so on up to
``order`` words.  A shard's task merges its blobs and writes one trie file: a
level of words (sorted hashes as an Elias-Fano sequence, exact counts, coded
back-off weights) and for each further word a level of successors (the
context's place in the level above and the word's key as one monotone
Elias-Fano sequence, so the pointers are part of it, coded shares and, where a
level follows, back-off weights).  Scoring tasks map the files into memory and
descend level by level, a context's successors being searched only in that
context's range.

``p(w|h) = max(c(h,w) - D, 0) / c(h) + D T(h) / c(h) * p(w|h')`` with ``T(h)``
the distinct successors of ``h`` and ``h'`` the context without its first
word; after an unseen context it is ``p(w|h')``, and without context the
add-0.1 share that the base score also uses.  A text's first context is a
begin mark.  Words are known by 64-bit hashes and successors within a context
by 32 of those bits.  Shares and weights are exact where a level of a shard has
at most 256 such values; else those whose logarithms lie in the same 255th of
the range share their mean logarithm.

The folder must be one that executors reach by path or through pyarrow; a
remote file is copied to an unlinked local one before it is mapped.

Defined cases: a null text is an empty one and has its end token alone;
repeated rows count and are scored each; a null doc_id trains; without
training rows every word has the same probability; an empty table gives an
empty result; a very long text is a slice of its own and needs memory for its
own words.
"""

from __future__ import annotations

import mmap
import struct
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm import text
from adresponse.llm.store import keep, own_columns
from adresponse.session import checkpoint_dir

HELD_OUT_FOLDS, HELD_OUT = 10, 0
ADD, DISCOUNT = 0.1, 0.75
ORDER = 3  # words of the longest n-gram
SHARD_BYTES = 64 << 20  # of text for each shard, at most
U = np.uint64
END, BEGIN = U(0x5A17C0DE0000E2D1), U(0x5A17C0DE0000BE61)


class EliasFano:
    """A rising sequence of distinct numbers below ``2**bits``: low bits packed, high bits in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, head: np.ndarray):
        self.low, self.high, self.zeros, self.head = low, high, zeros, head
        self.width, self.size = int(head[0]), int(head[1])

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> EliasFano:
        n = max(1, len(values))
        width = max(1, bits - int(n).bit_length())
        width = 32 if 28 < width < 32 else width  # read as a plain array
        low = pack_bits(values & U((1 << width) - 1), width)
        top = (values >> U(width)).astype(np.int64)
        buckets = (1 << (bits - width)) if bits - width < 60 else 0
        ones = top + np.arange(len(values))  # a one for each number after a zero for each bucket before it
        flags = np.zeros(-(-(buckets + len(values) + 1) // 64) * 64, dtype=bool)
        flags[ones] = True
        high = np.packbits(flags, bitorder="little").view("<u8").astype(np.uint64)
        zeros = np.cumsum(64 - np.bitwise_count(high).astype(np.int64)).astype(np.uint32)
        return cls(low, high, zeros, np.array([width, len(values)]))

    def _low(self, at: np.ndarray) -> np.ndarray:
        """Low bits of the numbers at some places."""
        if self.width == 32:
            return self.low.view(np.uint32)[at].astype(U)
        bit = at * self.width
        word, shift = bit >> 6, (bit & 63).astype(U)
        return ((self.low[word] >> shift) | ((self.low[word + 1] << U(1)) << (U(63) - shift))) & U((1 << self.width) - 1)

    def _start(self, bucket: np.ndarray) -> np.ndarray:
        """How many numbers lie in earlier buckets: the place of the bucket's zero, less the zeros before."""
        word = np.searchsorted(self.zeros, bucket, side="right")
        before = np.where(word > 0, self.zeros[np.maximum(word - 1, 0)], 0).astype(np.int64)
        need, free = bucket - before, ~self.high[np.minimum(word, len(self.high) - 1)]
        at = np.zeros(len(bucket), dtype=np.uint64)
        for half in (32, 16, 8, 4, 2, 1):  # the need-th free bit of the word
            part = np.bitwise_count((free >> at) & U((1 << half) - 1)).astype(np.int64)
            go = need >= part
            need, at = np.where(go, need - part, need), np.where(go, at + U(half), at)
        return word * 64 + at.astype(np.int64) - bucket

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, or -1."""
        out = np.full(len(values), -1, dtype=np.int64)
        if not self.size or not len(values):
            return out
        top = (values >> U(self.width)).astype(np.int64)
        low = values & U((1 << self.width) - 1)
        # numbers before bucket b: the one-bits before its first place, which follows the zero of b - 1
        at = np.where(top > 0, self._start(np.maximum(top - 1, 0)), 0)
        end = self._start(top)
        last = end - 1
        while (live := np.flatnonzero(at < last)).size:  # halve each range: a frequent word's successors crowd a bucket
            middle = (at[live] + last[live]) >> 1
            less = self._low(middle) < low[live]
            at[live[less]], last[live[~less]] = middle[less] + 1, middle[~less]
        there = np.flatnonzero(at < end)
        there = there[self._low(at[there]) == low[there]]
        out[there] = at[there]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.zeros, self.head]


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits one after another in 64-bit words, and a word to read beyond."""
    out = np.zeros(-(-len(values) * width // 64) + 1, dtype=U)
    if not len(values):
        return out
    bit = np.arange(len(values)) * width
    word, shift = bit >> 6, (bit & 63).astype(U)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(values << shift, first)
    over = np.flatnonzero((bit & 63) + width > 64)  # the last of its word goes on in the next
    out[word[over] + 1] |= values[over] >> (U(64) - shift[over])
    return out


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after another, each from a multiple of 8 bytes on."""
    out = [struct.pack("<Q", len(arrays))]
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        out += [a.dtype.str.encode().ljust(8), struct.pack("<Q", len(a)), raw, b"\0" * (-len(raw) % 8)]
    return b"".join(out)


def unpack(buffer) -> list[np.ndarray]:
    out, at = [], 8
    for _ in range(struct.unpack_from("<Q", buffer)[0]):
        kind, n = np.dtype(bytes(buffer[at : at + 8]).decode().strip()), struct.unpack_from("<Q", buffer, at + 8)[0]
        out.append(np.frombuffer(buffer, dtype=kind, count=n, offset=at + 16))
        at += 16 + n * kind.itemsize + (-(n * kind.itemsize) % 8)
    return out


def quantise(p: np.ndarray) -> list[np.ndarray]:
    """A byte for each probability and the at most 256 logarithms that they stand for."""
    with np.errstate(divide="ignore"):
        log = np.log10(p)
    values, code = np.unique(log, return_inverse=True)
    if len(values) > 256:
        some = np.isfinite(log)
        least, most = log[some].min(), log[some].max()
        code = np.where(some, np.minimum((np.where(some, log, least) - least) * 255 // (most - least), 254), 255).astype(np.int64)
        values = np.bincount(code, weights=np.where(some, log, 0), minlength=256) / np.maximum(np.bincount(code, minlength=256), 1)
        values[255] = -np.inf
    return [code.astype(np.uint8), values]


def restore(code: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (10.0**values)[code]


def smallest(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes each as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end token after each text, where each text begins, and each text's count."""
    words, counts = text.word_hashes(texts)
    here = np.insert(words, np.cumsum(counts), END) if len(texts) else words
    counts = counts + 1
    return here, np.cumsum(counts) - counts, counts


def _before(node: np.ndarray, begin: np.ndarray, first: int) -> np.ndarray:
    """Node of the token before each token; ``first`` for a text's first."""
    out = np.empty_like(node)
    out[1:] = node[:-1]
    out[begin] = first
    return out


def _shards(shard: np.ndarray, shards: int) -> list[np.ndarray]:
    """Rows of each shard."""
    order = np.argsort(shard, kind="stable")
    return np.split(order, np.searchsorted(shard[order], np.arange(1, shards)))


def _shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return (words % U(shards)).astype(np.int64)


def _count(texts: list, shards: int, order: int) -> Iterator[tuple[int, bytes]]:
    """A blob for each shard of the words in some training texts and of what follows them."""
    here, begin, _ = tokens_of(texts)
    names = np.unique(np.append(here, BEGIN))
    rank = np.searchsorted(names, here)
    shard = _shard_of(names, shards)
    rows = _shards(shard, shards)
    count = np.bincount(rank, minlength=len(names)).astype(np.uint32)
    blobs = [[names[r], count[r]] for r in rows]
    parent = _before(rank, begin, int(np.searchsorted(names, BEGIN)))
    for level in range(2, order + 1):
        live = np.flatnonzero(parent >= 0)
        key = (parent[live].astype(U) << U(32)) | (here[live] >> U(32))
        if level < order:
            key, back, times = np.unique(key, return_inverse=True, return_counts=True)
            node = np.full(len(here), -1)
            node[live] = back
            parent = _before(node, begin, -1)
        else:
            key, times = np.unique(key, return_counts=True)
        owner = (key >> U(32)).astype(np.int64)
        size = smallest(np.bincount(owner, minlength=len(shard)))
        shard = shard[owner]
        above, rows = rows, _shards(shard, shards)
        word = key.astype(np.uint32)
        for k in range(shards):
            many = np.flatnonzero(times[rows[k]] > 1)
            blobs[k] += [size[above[k]], word[rows[k]], many.astype(np.uint32), times[rows[k][many]].astype(np.uint32)]
    return ((k, pack(b)) for k, b in enumerate(blobs) if len(b[0]))


def _merge(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of each one's times, and each key's place."""
    order = np.argsort(key, kind="stable")
    new = np.diff(key[order], prepend=U(0)) > 0
    new[:1] = True
    place = np.empty(len(key), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return key[order[first]], np.add.reduceat(times[order], first) if len(first) else times, place


def build_shard(blobs: list[bytes], order: int) -> tuple[bytes, int, int]:
    """The trie file of one shard, its words and its training tokens."""
    parts = [unpack(b) for b in blobs]
    names, count, place = _merge(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64))
    arrays = [*EliasFano.build(names >> U(1), 63).arrays(), smallest(count)]
    above = len(names)
    for at in range(2, 2 + 4 * (order - 1), 4):
        parent = np.repeat(place, np.concatenate([p[at] for p in parts]).astype(np.int64))
        key = (parent.astype(U) << U(32)) | np.concatenate([p[at + 1] for p in parts]).astype(U)
        times, start = np.ones(len(key), dtype=np.int64), 0
        for p in parts:
            times[start + p[at + 2].astype(np.int64)] = p[at + 3]
            start += len(p[at + 1])
        key, times, place = _merge(key, times)
        owner = (key >> U(32)).astype(np.int64)
        total, kinds = np.bincount(owner, weights=times, minlength=above), np.bincount(owner, minlength=above)
        arrays += quantise(np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0))
        arrays += [*EliasFano.build(key, 32 + max(1, above.bit_length())).arrays(), *quantise((times - DISCOUNT) / total[owner])]
        above = len(key)
    return pack(arrays), int((count > 0).sum()), int(count.sum())


def _open(folder: str):
    return fs.FileSystem.from_uri(folder)


class Trie:
    """The trie files of a folder, mapped into memory shard by shard."""

    def __init__(self, folder: str, shards: int, tokens: int, kinds: int, order: int = ORDER):
        self.folder, self.shards, self.tokens, self.kinds, self.order = folder, shards, tokens, kinds, order
        self.maps: dict[int, list[np.ndarray] | None] = {}

    def _shard(self, k: int) -> list[np.ndarray] | None:
        if k not in self.maps:
            system, path = _open(self.folder)
            path = f"{path}/{k}.trie"
            if system.get_file_info(path).type == fs.FileType.NotFound:
                self.maps[k] = None
            else:
                if isinstance(system, fs.LocalFileSystem):
                    file = open(path, "rb")
                else:
                    file = tempfile.TemporaryFile()
                    with system.open_input_stream(path) as s:
                        while part := s.read(1 << 22):
                            file.write(part)
                    file.flush()
                with file:
                    self.maps[k] = unpack(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        return self.maps[k]

    # a file's arrays: 4 of the words' sequence, counts; for each level the weights above it (2), its sequence (4), its shares (2)
    def words(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Count, shard, place there (-1: unseen) and back-off weight of distinct words."""
        count, place, weight = np.zeros(len(names), dtype=np.int64), np.full(len(names), -1), np.ones(len(names))
        shard = _shard_of(names, self.shards)
        for k, rows in enumerate(_shards(shard, self.shards)):
            if len(rows) and (a := self._shard(k)):
                place[rows] = at = EliasFano(*a[:4]).find(names[rows] >> U(1))
                hit = at >= 0
                count[rows[hit]] = a[4][at[hit]]
                if self.order > 1:
                    weight[rows[hit]] = restore(a[5][at[hit]], a[6])
        return count, shard, place, weight

    def after(self, level: int, shard: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the level, share among what follows its context, and back-off weight; key: context's place and word key."""
        place, share, weight = np.full(len(key), -1), np.zeros(len(key)), np.ones(len(key))
        first = 7 + 8 * (level - 2)
        for k, rows in enumerate(_shards(shard, self.shards)):
            if len(rows) and (a := self._shard(k)):
                place[rows] = at = EliasFano(*a[first : first + 4]).find(key[rows])
                hit = at >= 0
                share[rows[hit]] = restore(a[first + 4][at[hit]], a[first + 5])
                if level < self.order:
                    weight[rows[hit]] = restore(a[first + 6][at[hit]], a[first + 7])
        return place, share, weight

    def score(self, texts: list) -> pd.DataFrame:
        """n_tokens, n_known, base_score and score of each text."""
        here, begin, counts = tokens_of(texts)
        names = np.unique(np.append(here, BEGIN))
        rank = np.searchsorted(names, here)
        count, shard, place, weight = self.words(names)
        p1 = ((count + ADD) / (self.tokens + ADD * (self.kinds + 1)))[rank]
        p, parent = p1.copy(), _before(rank, begin, int(np.searchsorted(names, BEGIN)))
        for level in range(2, self.order + 1):
            live = np.flatnonzero(parent >= 0)
            live = live[place[parent[live]] >= 0]
            back, key = np.arange(len(live)), (parent[live].astype(U) << U(32)) | (here[live] >> U(32))
            if level < self.order:
                key, back = np.unique(key, return_inverse=True)
            context = (key >> U(32)).astype(np.int64)
            p[live] *= weight[parent[live]]
            place, share, weight = self.after(level, shard := shard[context], (place[context].astype(U) << U(32)) | (key & U(0xFFFFFFFF)))
            p[live] += share[back]
            node = np.full(len(here), -1)
            node[live] = back
            parent = _before(node, begin, -1)
        add = lambda v: np.add.reduceat(v, begin)
        return pd.DataFrame({"n_tokens": counts, "n_known": add((count[rank] > 0).astype(np.int64)), "base_score": add(np.log10(p1)), "score": add(np.log10(p))})


def fit(documents: DataFrame, order: int = ORDER) -> tuple[str, int, int, int]:
    """Count the texts outside the held-out fold; folder, shards, training tokens and distinct words.

    There are as many shards as shuffle partitions, more where these would
    hold over 64 MB of text each.
    """
    spark = documents.sparkSession
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/trie-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else folder.replace("file:", "", 1)
    folder = folder if "://" in folder else "file://" + folder

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for s in text.groups(texts, 8 << 20):
                yield pd.DataFrame(_count(texts[s], shards, order), columns=["shard", "blob"])

    def build(blobs: pd.DataFrame) -> pd.DataFrame:
        data, kinds, tokens = build_shard([bytes(b) for b in blobs["blob"]], order)
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        final = f"{path}/{blobs['shard'].iloc[0]}.trie"
        with system.open_output_stream(part := f"{final}.{uuid.uuid4().hex}") as out:
            out.write(data)
        system.move(part, final)  # whole or not at all, also if a task runs twice
        return pd.DataFrame({"kinds": [kinds], "tokens": [tokens]})

    train = documents.where(~held_out(F.col("doc_id")))
    blobs = train.mapInPandas(count, "shard int, blob binary")
    sizes = keep(blobs.groupBy("shard").applyInPandas(build, "kinds long, tokens long"), "trie-sizes")
    total = sizes.agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    return folder, shards, total.tokens, total.kinds


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == HELD_OUT, F.lit(False))


def score_documents(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    rows = own_columns(documents, "doc_id", "text")
    folder, shards, tokens, kinds = fit(rows, order)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps = sys.modules.setdefault("_adresponse_worker", types.ModuleType("_adresponse_worker")).__dict__.setdefault("tries", {})
        if folder not in maps:
            maps.clear()  # an earlier model's maps
            maps[folder] = Trie(folder, shards, tokens, kinds, order)
        for b in batches:
            texts = b["text"].tolist()
            for s in text.groups(texts, 8 << 20):
                part = b.iloc[s]
                found = maps[folder].score(texts[s])
                yield found.assign(doc_id=part["doc_id"].to_numpy(), held_out=part["held_out"].to_numpy(), train_tokens=tokens)

    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInPandas(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
