"""SentencePiece encoding and decoding with the source bytes of every piece.

A text is normalised by longest prefixes through the model's compiled
character map (a double-array trie over UTF-8); every normalised character
keeps the source bytes it came from, so each piece is projected to a span of
the original text.  Pieces are merged best score first.  No piece of such a
model goes on after white space has begun anew, so a text falls into units -
white space with the word behind it - that are merged apart; a worker
remembers the units it met, up to a bound.  A model with an empty character
map, whose normalised text is the source with spaces marked, is cut into units
directly; others go through the map first.

Ids equal those of the sentencepiece library, spans those of its proto, and
decoding its ``decode`` (tests compare all three).  A byte piece that isn't the
last of its character has an empty span, as there.

Defined cases: a null or empty text has no pieces; a null doc_id is passed on;
repeated rows are encoded each; a text of any length is encoded whole; white
space and the space mark in a text are what the model makes of them; an empty
table gives an empty result.  Models other than byte-pair models, and those
with user-defined or unused pieces, are refused with a ``ValueError``.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
import types
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm import text as texts_of
from adresponse.llm.store import own_columns

CACHED = 400_000  # units a worker remembers
SLICE = 1 << 20  # characters encoded together
SHORT = 24  # characters of a unit that is merged side by side with others
NEVER = np.iinfo(np.int64).max
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>"


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, raw[at : at + size]
            at += size


class CharMap:
    """A compiled character map: trie units, then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist()
        self.replacements = blob[4 + size :]
        self._known: dict[str, tuple[str, int]] = {}
        keys = list(self._keys())
        self.longest = max(map(len, keys))
        # a key's match begins at such a character or at the one before it
        self.alone = {k[0] for k in keys if len(k) == 1}
        self.second = {k[1] for k in keys if len(k) > 1}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _keys(self) -> Iterator[str]:
        """Every key of the trie, by a walk over all labels of each node."""
        units, labels = np.array(self.units, dtype=np.int64), np.arange(256)
        todo = [(self._offset(self.units[0]), b"")]
        while todo:
            node, prefix = todo.pop()
            at = node ^ labels
            inside = at < len(units)
            found = labels[inside][(units[at[inside]] & 0x800000FF) == labels[inside]]
            for b in found.tolist():
                if not b:
                    continue
                unit = self.units[node ^ b]
                if unit >> 8 & 1:
                    yield (prefix + bytes([b])).decode("utf-8")
                todo.append((node ^ b ^ self._offset(unit), prefix + bytes([b])))

    def longest_prefix(self, ahead: str) -> tuple[str, int]:
        """Replacement and length (in characters) of the longest key that ``ahead`` begins with; length 0: none."""
        known = self._known.get(ahead)
        if known is not None:
            return known
        raw = ahead.encode("utf-8", "surrogatepass")
        node, value, length = self._offset(self.units[0]), -1, 0
        for i, b in enumerate(raw):
            node ^= b
            if node >= len(self.units) or self.units[node] & 0x800000FF != b:
                break
            unit = self.units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                value, length = self.units[node] & 0x7FFFFFFF, i + 1
        if value < 0:
            found = ("", 0)
        else:
            end = self.replacements.index(b"\0", value)
            found = (self.replacements[value:end].decode("utf-8"), len(raw[:length].decode("utf-8")))
        if len(self._known) < CACHED:
            self._known[ahead] = found
        return found

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """(normalised, source characters) of each step through the text; a step of unmapped characters is
        one of equally long strings."""
        special = np.fromiter((c in self.alone or c in self.second for c in text), dtype=bool, count=len(text))
        start = special.copy()  # where a key may begin
        start[:-1] |= np.fromiter((c in self.second for c in text[1:]), dtype=bool, count=max(0, len(text) - 1))
        at = 0
        for i in np.flatnonzero(start).tolist():
            if i < at:
                continue
            replacement, length = self.longest_prefix(text[i : i + self.longest])
            if not length:
                continue
            if i > at:
                yield text[at:i], 0
            yield replacement, length
            at = i + length
        if at < len(text):
            yield text[at:], 0


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._read(f.read())

    @classmethod
    def of(cls, path: str) -> Codec:
        """The worker's codec of this file; it outlives the task."""
        known = sys.modules.setdefault("_adresponse_worker", types.ModuleType("_adresponse_worker")).__dict__
        if ("codec", path) not in known:
            known["codec", path] = cls(path)
        return known["codec", path]

    def _read(self, raw: bytes) -> None:
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for number, value in fields(raw):
            if number == 1:
                p = dict(fields(value))
                self.pieces.append(p.get(1, b"").decode("utf-8"))
                self.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kinds.append(p.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if trainer.get(3, 1) != BPE or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.get(24, 0) or not normalizer.get(5, 1):
            raise ValueError("only byte-pair models with marked leading spaces and without user-defined or unused pieces")
        self.fallback = bool(trainer.get(35, 0))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode("utf-8")
        blob = normalizer.get(2, b"")
        self.map = CharMap(blob) if blob else None
        self.dummy, self.squeeze = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        ids = range(len(self.pieces))
        self.normal = {self.pieces[i]: i for i in ids if self.kinds[i] == NORMAL}
        self.unknown = next((i for i in ids if self.kinds[i] == UNKNOWN), 0)
        self.bytes_ = {int(self.pieces[i][3:5], 16): i for i in ids if self.kinds[i] == BYTE}
        # where a text may be cut without parting what could be merged
        marks = "".join(p[1:] for p in self.normal if SPACE in p.lstrip(SPACE))
        self.line = not any("\n" in p and len(p) > 1 for p in self.normal)
        end = "\n" if self.line else ""
        if marks:
            self.cut = re.compile(r"(?s).+")
        else:
            self.cut = re.compile(f"[ {SPACE}]*[^ {SPACE}{end}]+|[ {SPACE}]+" + ("|\n" if end else ""))
        self.simple = not marks and self.line
        self.slot: dict[str, int] = {}  # unit -> place in begin and n
        self.begin, self.n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat, self.source = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self._tabulate()
        # what each id says
        surface = [b"" if k == CONTROL else self.unknown_text.encode() if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode("utf-8") for p, k in zip(self.pieces, self.kinds)]
        self.says = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.says_n = np.fromiter(map(len, surface), dtype=np.int64, count=len(surface))
        self.says_begin = np.cumsum(self.says_n) - self.says_n

    # --- normalising ------------------------------------------------------
    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, spaces marked, and the source byte that each of its characters (and its end) goes back to."""
        steps = self.map.parts(text) if self.map else iter([(text, 0)] if text else [])
        out: list[str] = []
        align: list[int] = []
        at, done = 0, 0  # source characters, source bytes

        def singles() -> Iterator[tuple[str, int]]:
            nonlocal at
            for norm, length in steps:
                if length:
                    yield norm, len(text[at : at + length].encode("utf-8", "surrogatepass"))
                    at += length
                else:
                    for c in norm:
                        yield c, 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
                        at += 1

        before = self.squeeze  # white space came just before
        begun = False
        for norm, size in singles():
            if not begun:
                if self.squeeze and norm == " ":
                    done += size
                    continue
                begun = True
                if self.dummy:
                    out.append(SPACE)
                    align.append(done)
            if before:
                norm = norm.lstrip(" ")
            if norm:
                out.append(norm.replace(" ", SPACE))
                align += [done] * len(norm)
                before = self.squeeze and norm.endswith(" ")
            done += size
        whole = "".join(out)
        if self.squeeze:
            kept = whole.rstrip(SPACE)
            if len(kept) < len(whole):
                done = align[len(kept)]
                whole, align = kept, align[: len(kept)]
        return whole, [*align, done] if begun else [0]

    # --- merging ----------------------------------------------------------
    def merge(self, unit: str) -> list[str]:
        """Pieces of a unit: adjacent symbols are joined, best score first, leftmost on ties."""
        symbols: list[str] = list(unit)
        if len(symbols) < 2:
            return symbols
        after = [*range(1, len(symbols)), -1]
        ahead = [-1, *range(len(symbols) - 1)]
        normal, scores = self.normal, self.scores
        agenda: list[tuple[float, int, int, str]] = []
        for i in range(len(symbols) - 1):
            k = normal.get(both := symbols[i] + symbols[i + 1])
            if k is not None:
                agenda.append((-scores[k], i, i + 1, both))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(both):
                continue
            symbols[i], symbols[j] = both, ""
            after[i] = after[j]
            if after[j] >= 0:
                ahead[after[j]] = i
            for a, b in ((ahead[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    k = normal.get(joined := symbols[a] + symbols[b])
                    if k is not None:
                        heapq.heappush(agenda, (-scores[k], a, b, joined))
        return [s for s in symbols if s]

    def identify(self, pieces: list[str]) -> Iterator[tuple[int, str, bool]]:
        """(id, piece, whether it ends its source) of merged pieces; unknown ones by their bytes, or unknowns in a row as one."""
        unknown = ""
        for p in pieces:
            i = self.normal.get(p)
            if i is None and not self.fallback:
                unknown += p
                continue
            if unknown:
                yield self.unknown, unknown, True
                unknown = ""
            if i is not None:
                yield i, p, True
            else:
                raw = p.encode("utf-8", "surrogatepass")
                for k, b in enumerate(raw, 1):
                    yield self.bytes_[b], p, k == len(raw)
        if unknown:
            yield self.unknown, unknown, True

    def _tabulate(self) -> None:
        """Tables for merging many units at once: symbol of a character, and the rank and result of each pair of symbols."""
        symbol = dict(self.normal)
        for p in self.normal:
            for c in p:
                symbol.setdefault(c, len(self.pieces) + len(symbol))
        self.of_char = np.full(sys.maxunicode + 1, -1, dtype=np.int64)
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        ranks = dict(zip(self.normal.values(), np.unique([-self.scores[i] for i in self.normal.values()], return_inverse=True)[1].tolist()))
        self.width = max(symbol.values()) + 1
        pairs: dict[int, int] = {}
        for p, i in self.normal.items():
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        self.pair = pd.Index(np.fromiter(pairs, dtype=np.int64, count=len(pairs)))
        # the last entries answer for pairs that don't merge
        self.result = np.array([*pairs.values(), -1], dtype=np.int64)
        self.rank = np.array([*map(ranks.__getitem__, pairs.values()), NEVER], dtype=np.int64)
        # source bytes of a piece whose space marks were spaces
        self.takes = np.array([len(p.replace(SPACE, " ").encode("utf-8")) for p in self.pieces], dtype=np.int32)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place in ``rank`` and ``result`` of each pair; the last for pairs that don't merge."""
        return self.pair.get_indexer((left * self.width + right).ravel()).reshape(left.shape)

    def _merge_many(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` for equally long units (a row of symbols each): the symbols left in each row, and how many."""
        rows, length = symbols.shape
        n = np.full(rows, length)
        place = self._rank_of(symbols[:, :-1], symbols[:, 1:])
        out = symbols.copy()
        live = np.arange(rows)
        columns = np.arange(length)
        while length > 1 and len(live):
            ranks = self.rank[place]
            best = ranks.argmin(axis=1)
            go = ranks[np.arange(len(live)), best] < NEVER
            out[live[~go], : symbols.shape[1]] = symbols[~go]
            live, symbols, place, best = live[go], symbols[go], place[go], best[go]
            if not len(live):
                break
            each = np.arange(len(live))
            symbols[each, best] = self.result[place[each, best]]
            # what lies right of the joined pair moves up
            width = symbols.shape[1]
            symbols = np.take_along_axis(symbols, columns[: width - 1] + (columns[: width - 1] > best[:, None]), axis=1)
            n[live] -= 1
            if width == 2:
                out[live, :1] = symbols
                break
            place = np.take_along_axis(place, columns[: width - 2] + (columns[: width - 2] >= best[:, None]), axis=1)
            before, behind = np.flatnonzero(best > 0), np.flatnonzero(best < width - 2)
            k = best[before]
            place[before, k - 1] = self._rank_of(symbols[before, k - 1], symbols[before, k])
            k = best[behind]
            place[behind, k] = self._rank_of(symbols[behind, k], symbols[behind, k + 1])
        return out, n

    # --- texts without a character map, unit by unit ------------------------
    def _learn(self, new: list[str]) -> None:
        """Merge units and remember their ids and source bytes: short ones of known characters side by side, others one by one."""
        lengths = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        whole = np.frombuffer("".join(new).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.of_char[whole]
        starts = np.cumsum(lengths) - lengths
        known = np.minimum.reduceat(symbols, starts) >= 0
        many = known & (lengths <= SHORT) & np.fromiter((SPACE not in u for u in new), dtype=bool, count=len(new))
        ids, sources, counts, names = [self.flat], [self.source], [self.n], []
        for length in np.unique(lengths[many]).tolist():
            these = np.flatnonzero(many & (lengths == length))
            merged, n = self._merge_many(symbols[starts[these][:, None] + np.arange(length)])
            flat = merged[np.arange(length) < n[:, None]]
            ok = np.minimum.reduceat(flat < len(self.pieces), np.cumsum(n) - n)  # a character without a piece of its own
            many[these[~ok]] = False
            flat = flat[np.repeat(ok, n)]
            ids.append(flat.astype(np.int32))
            sources.append(self.takes[flat])
            counts.append(n[ok])
            names.append([new[i] for i in these[ok].tolist()])
        rest = [new[i] for i in np.flatnonzero(~many).tolist()]
        names.append(rest)
        for unit in rest:
            at, own = 0, []
            for i, piece, last in self.identify(self.merge(unit.replace(" ", SPACE))):
                size = len(unit[at : at + len(piece)].encode("utf-8", "surrogatepass")) if last else 0
                at += len(piece) * last
                own.append((i, size))
            pairs = np.array(own, dtype=np.int32).reshape(-1, 2)
            ids.append(pairs[:, 0])
            sources.append(pairs[:, 1])
            counts.append(np.array([len(pairs)]))
        self.slot.update(zip(chain.from_iterable(names), range(len(self.n), len(self.n) + len(new))))
        self.flat, self.source, self.n = np.concatenate(ids), np.concatenate(sources), np.concatenate(counts).astype(np.int64)
        self.begin = np.cumsum(self.n) - self.n

    def _trim(self) -> None:
        """Forget the newest units beyond the bound; the frequent ones came first."""
        if len(self.slot) > CACHED:
            for x in list(islice(reversed(self.slot), len(self.slot) - CACHED)):
                del self.slot[x]
            self.begin, self.n = self.begin[:CACHED], self.n[:CACHED]
            size = self.begin[-1] + self.n[-1]
            self.flat, self.source = self.flat[:size].copy(), self.source[:size].copy()

    def units(self, text: str) -> list[str]:
        """The text in parts that are merged apart, the model's own first space with the first."""
        if not text:
            return []
        if self.dummy:
            text = " " + text
        if self.simple and "  " not in text and "\0" not in text and SPACE not in text:
            return [u for u in text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if u]
        return self.cut.findall(text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, span begins and span ends (source bytes) of all texts in a row, and each text's count."""
        if self.map or self.squeeze or (not self.fallback):
            return self._encode_mapped(texts)
        units: list[str] = []
        per_text = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            u = self.units(t or "")
            units += u
            per_text[i] = len(u)
        if not units:
            return *(np.zeros(0, dtype=np.int32),) * 3, per_text
        if new := [x for x in dict.fromkeys(units) if x not in self.slot]:
            self._learn(new)
        slots = np.fromiter(map(self.slot.__getitem__, units), dtype=np.int64, count=len(units))
        begin, each = self.begin[slots], self.n[slots]
        total = np.cumsum(each)
        places = np.arange(int(total[-1])) + np.repeat(begin - (total - each), each)
        ids, sizes = self.flat[places], self.source[places]
        self._trim()
        upto = np.concatenate([[0], total])[np.cumsum(per_text)]
        counts = np.diff(upto, prepend=0)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = np.concatenate([[0], ends])[upto - counts]  # source bytes of the texts before
        ends -= np.repeat(first + self.dummy, counts)
        begins = np.maximum(ends - sizes, 0)
        return ids, begins.astype(np.int32), ends.astype(np.int32), counts

    # --- any text -----------------------------------------------------------
    def encode_one(self, text: str) -> list[tuple[int, int, int]]:
        """(id, begin, end) of every piece, through the character map."""
        whole, align = self.normalise(text)
        out, at = [], 0
        # texts without a byte fallback join unknowns across units: those are identified in a row
        merged = chain.from_iterable(map(self.merge, self.cut.findall(whole)))
        for i, piece, last in self.identify(list(merged)):
            begin = align[at]
            if last:
                at += len(piece)
                out.append((i, begin, align[at]))
            else:
                out.append((i, begin, begin))
        return out

    def _encode_mapped(self, texts: list[str | None]):
        each = [self.encode_one(t or "") for t in texts]
        counts = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        rows = np.array(list(chain.from_iterable(each)), dtype=np.int32).reshape(-1, 3)
        return rows[:, 0], rows[:, 1], rows[:, 2], counts

    # --- decoding -----------------------------------------------------------
    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids in a row, so many for each."""
        n = self.says_n[ids]
        total = np.cumsum(n)
        whole = self.says[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(self.says_begin[ids] - (total - n), n)].tobytes()
        upto = np.concatenate([[0], total])[np.cumsum(counts)]
        out, a, at = [], 0, 0
        for b, k in zip(upto.tolist(), counts.tolist()):
            raw, own = whole[a:b], ids[at : at + k]
            a, at = b, at + k
            try:
                if not self.squeeze:
                    text = raw.decode("utf-8")
                    out.append(text[1:] if self._first_space(own) else text)
                    continue
            except UnicodeDecodeError:
                pass
            out.append(self._decode_slowly(own.tolist()))
        return out

    def _first_space(self, ids: np.ndarray) -> bool:
        """Whether a space begins the text that the model put there."""
        if not self.dummy and not self.squeeze:
            return False
        for i in ids.tolist():
            if self.kinds[i] != CONTROL:
                return self.kinds[i] == NORMAL and self.pieces[i].startswith(SPACE)
        return False

    def _decode_slowly(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 give a replacement character each; leading white space goes where the model squeezes it."""
        out: list[str] = []
        held = bytearray()
        stripped = not (self.dummy or self.squeeze)

        def flush() -> None:
            at = 0
            while at < len(held):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(held[at : at + size]).decode("utf-8"))
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            held.clear()

        for i in ids:
            if self.kinds[i] == BYTE:
                held += bytes([int(self.pieces[i][3:5], 16)])
                continue
            flush()
            if self.kinds[i] == CONTROL:
                continue
            if self.kinds[i] == UNKNOWN:
                out.append(self.unknown_text)
                continue
            piece = self.pieces[i]
            if not stripped and not any(out):
                if piece.startswith(SPACE):
                    piece = piece[1:]
                    stripped = not self.squeeze
            out.append(piece.replace(SPACE, " "))
        flush()
        return "".join(out)


def encode(documents: DataFrame, model: str, decoded: bool = False) -> DataFrame:
    """doc_id, ids, and the begin and end (bytes of the source text, end exclusive) of every piece of each whole text.

    With ``decoded`` also ``text``, decoded from the ids, without a second way of all ids through Arrow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        for b in batches:
            texts = b.column("text").to_pylist()
            for s in texts_of.groups(texts, SLICE):
                ids, begins, ends, counts = codec.encode(texts[s])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, type=pa.int32())) for x in (ids, begins, ends)]
                columns, names = [b.column("doc_id")[s], *lists], ["doc_id", "ids", "begins", "ends"]
                if decoded:
                    columns.append(pa.array(codec.decode(ids, counts), type=pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return own_columns(documents, "doc_id", "text").mapInArrow(run, ENCODED + (", text string" if decoded else ""))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encode`` with the decoded ``text`` of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        for b in batches:
            lists = b.column("ids")
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            counts = np.diff(offsets)
            texts: list[str] = []
            upto = offsets - offsets[0]
            at = 0
            while at < len(counts):  # some million ids at a time
                end = max(at + 1, int(np.searchsorted(upto, upto[at] + (1 << 20), side="right")) - 1)
                texts += codec.decode(ids[upto[at] : upto[end]], counts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, type=pa.string())], names=[*b.schema.names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, text string")


def digests(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and source_bytes (the end of the last piece's span) of every document."""
    rows = encode(documents, model, decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("source_bytes"),
    )
