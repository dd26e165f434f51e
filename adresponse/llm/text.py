"""Words of whole texts as 64-bit hashes, whole batches at a time.

Texts are cut at ASCII white space after A-Z is lower-cased.  Work goes in
slices of bounded size, so a very long text costs time but not memory beyond
its own words.
"""

from __future__ import annotations

import hashlib
import sys
import types

import numpy as np

U = np.uint64
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables():
    with np.errstate(over="ignore"):
        per_byte = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
        base = U(0xD6E8FEB86659FD93)
        inverse = U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
        up = np.full(2 * SLICE + 1, base, dtype=U)
        down = np.full(2 * SLICE + 1, inverse, dtype=U)
        up[0] = down[0] = U(1)
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        space = np.zeros(256, dtype=bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        return per_byte, np.multiply.accumulate(up), np.multiply.accumulate(down), lower, space


def tables():
    """Made once in each process, and kept outside this module: its globals travel with every task function."""
    held = sys.modules.setdefault("_adresponse_tables", types.ModuleType("_adresponse_tables")).__dict__
    if "tables" not in held:
        held["tables"] = _tables()
    return held["tables"]


def spans(texts: list[str | None], letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, word starts and ends, and word count of each text.

    With ``letters``, ASCII punctuation parts words as white space does.
    """
    _, _, _, lower, space = tables()
    if letters:
        space = space.copy()
        space[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = lower[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    gap = space[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(buf) and not gap[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    text_ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, dtype=np.int64)
    upto = np.searchsorted(starts, text_ends)
    return buf, starts, ends, np.diff(upto, prepend=0)


def word_hashes(texts: list[str | None], letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and the word count of each text."""
    per_byte, up, down, _, _ = tables()
    buf, starts, ends, counts = spans(texts, letters)
    out = np.empty(len(starts), dtype=U)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            a = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, a + SLICE, side="right")))
            b = ends[j - 1]
            if b - a > 2 * SLICE:  # one word longer than the tables
                out[i] = U(int.from_bytes(hashlib.blake2b(buf[a:b].tobytes(), digest_size=8).digest(), "little"))
                i += 1
                continue
            total = np.zeros(b - a + 1, dtype=U)
            np.cumsum(per_byte[buf[a:b]] * up[: b - a], out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
            i = j
    return out, counts


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one text; a shorter text is one shingle."""
    n = len(words)
    if not n:
        return words
    with np.errstate(over="ignore"):
        w = min(k, n)
        h = np.full(n - w + 1, U(w), dtype=U)
        for j in range(w):
            h = mix(h * U(0x9E3779B97F4A7C15) + words[j : n - w + 1 + j])
        return np.unique(h)


def ngrams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return words[:0]
    with np.errstate(over="ignore"):
        h = np.full(n, U(k), dtype=U)
        for j in range(k):
            h = mix(h * U(0x9E3779B97F4A7C15) + words[j : n + j])
        return h


def groups(texts: list, most: int = 4 << 20):
    """Slices of a list of texts, each of about ``most`` characters (a longer text stands alone)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and size + n > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))
