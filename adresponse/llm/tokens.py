"""Token ids of whole texts by the tokenizers library, word by word.

Both vocabularies split a text at white space before they merge pairs, so a
text's ids are those of its pieces in a row.  Texts repeat words: every
distinct piece of a batch is encoded once, and pieces met in earlier batches
come from a bounded cache of the Python worker.  The ids equal those of the
whole text (tests compare them); texts with unusual control characters or
runs of white space take the plain way.
"""

from __future__ import annotations

import os
import re
import sys
import types
from itertools import chain, islice

import numpy as np
import pandas as pd

CACHED = 400_000  # pieces a worker remembers
JOINED = 100  # words encoded in one string
TRAIL = ".,;:!?"


def _worker() -> dict:
    """A namespace that outlives the task in its Python worker."""
    return sys.modules.setdefault("_adresponse_worker", types.ModuleType("_adresponse_worker")).__dict__


class Encoder:
    """``kind`` is ``word`` (white space dropped, pieces end in a word-end id) or
    ``byte`` (a piece carries the space before it)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.kind = "word" if any(t.endswith("</w>") for t in vocab) else "byte"
        size = max(vocab.values()) + 1
        self.edge = np.zeros(size, dtype=bool)  # ids that end a word, or begin one
        for t, i in vocab.items():
            self.edge[i] = t.endswith("</w>") if self.kind == "word" else t.startswith("Ġ")
        self.slot: dict[str, int] = {"": 0}  # piece -> place in begin and n; the first is the end id
        self.begin, self.n = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.int64)
        self.flat = np.zeros(1, dtype=np.uint32)

    @classmethod
    def of(cls, path: str) -> Encoder:
        known = _worker()
        if ("encoder", path) not in known:
            known["encoder", path] = cls(path)
        return known["encoder", path]

    def _plain(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _joined(self, pieces: list[str], edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row, and each piece's count, of pieces that are letters with at most
        punctuation behind; many go in one string and are told apart by ``edges`` word
        edges in each."""
        joint = " " if self.kind == "word" else ""
        slices = [slice(i, i + JOINED) for i in range(0, len(pieces), JOINED)]
        flat, n = [], []
        for part, ids in zip(slices, self._plain([joint.join(pieces[s]) for s in slices])):
            ids = np.array(ids, dtype=np.uint32)
            at, upto = np.flatnonzero(self.edge[ids]), np.cumsum(edges[part])
            if len(at) != upto[-1]:  # a letter that the tokenizer sees as something else
                each = self._plain(pieces[part])
                flat += each
                n += map(len, each)
                continue
            ends = at[upto - 1] + 1 if self.kind == "word" else np.append(at[1:], len(ids))
            flat.append(ids)
            n.append(np.diff(ends, prepend=0))
        if not flat:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        return np.concatenate(flat).astype(np.uint32), np.hstack(n).astype(np.int64)

    def _learn(self, new: list[str]) -> None:
        """Encode pieces and remember where their ids are."""
        regular, edges, other = [], [], []
        for x in new:
            stem = x.rstrip(TRAIL)
            if (stem if self.kind == "word" else stem[1:] if stem[:1] == " " else "").isalpha():
                regular.append(x)
                edges.append(1 + (self.kind == "word" and len(stem) < len(x)))
            else:
                other.append(x)
        flat, n = self._joined(regular, np.array(edges, dtype=np.int64))
        rest = self._plain(other)
        flat = np.concatenate([self.flat, flat, np.fromiter(chain.from_iterable(rest), dtype=np.uint32)])
        self.slot.update(zip(chain(regular, other), range(len(self.n), len(self.n) + len(new))))
        self.n = np.concatenate([self.n, n, np.fromiter(map(len, rest), dtype=np.int64, count=len(rest))])
        self.begin, self.flat = np.cumsum(self.n) - self.n, flat

    def _slots(self, distinct: list[str]) -> np.ndarray:
        if new := [x for x in distinct if x not in self.slot]:
            self._learn(new)
        return np.fromiter(map(self.slot.__getitem__, distinct), dtype=np.int64, count=len(distinct))

    def _trim(self) -> None:
        """Forget the newest pieces beyond the bound; the frequent ones came first."""
        if len(self.slot) > CACHED:
            for x in list(islice(reversed(self.slot), len(self.slot) - CACHED)):
                del self.slot[x]
            self.begin, self.n = self.begin[:CACHED], self.n[:CACHED]
            self.flat = self.flat[: self.begin[-1] + self.n[-1]].copy()

    def _split(self, text: str) -> list[str] | None:
        """Pieces that the tokenizer treats apart; None: not sure."""
        if self.kind == "word":
            if ODD_WORD.search(text):
                return None
            return text.split()
        if "\0" in text or ODD_BYTE.search(text):
            return None
        pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return pieces[not pieces[0] : len(pieces) - (not pieces[-1])] if text else []

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), ``end`` after each text, and each text's count with it."""
        pieces: list[str] = []
        per_text = np.zeros(len(texts), dtype=np.int64)
        plain: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            cut = self._split(t or "")
            if cut is None:
                plain[i] = self._plain([t])[0]
                cut = []
            pieces += cut
            pieces.append("")  # the end id
            per_text[i] = len(cut) + 1
        code, distinct = pd.factorize(np.array(pieces, dtype=object))
        slots = self._slots(list(distinct))[code]
        self.flat[0] = end
        begin, each = self.begin[slots], self.n[slots]
        total = np.cumsum(each)
        out = self.flat[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(begin - (total - each), each)]
        self._trim()
        counts = np.add.reduceat(each, np.cumsum(per_text) - per_text) if len(texts) else per_text
        if plain:
            parts = np.split(out, np.cumsum(counts)[:-1])
            for i, x in plain.items():
                parts[i] = np.array([*x, end], dtype=np.uint32)
            out, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return out, counts


# control characters that Python alone takes for white space, and the end of a C string
ODD_WORD = re.compile("[\0\x1c-\x1f]")
# white space beside white space, where a piece's end depends on what follows
ODD_BYTE = re.compile(r"\s\s")
