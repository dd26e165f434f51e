"""Personal data: e-mail, IP address, card and phone spans, plain and disguised.

The plain detectors read the source text.  For disguises a chain of small
transducers normalises a copy of the text - look-alike letters and digits of
other scripts, invisible characters, ``[at]`` / ``name at host dot tld``,
digits spelled as words, forms mixed or not - and each keeps, for every character it writes, the
source characters it came from.  The same detectors read the normalised text,
and what they find is mapped back to source spans.  A mapped span is added if
its source was really disguised and no plain span overlaps it.

Offsets are code points, ends exclusive.  Defined cases: a null text is an
empty one (no spans); repeated rows give repeated results; an empty table
gives an empty result; every detector is linear in the text's length.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import own_columns

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails from its first digit fails from the others too
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    " ": " ", " ": " ", " ": " ", "﹫": "@",
}
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}


def _one_to_one() -> dict[int, str]:
    table = {ord(k): v for k, v in LOOKALIKES.items()}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
    for c in range(0x80, 0x20000):
        if unicodedata.category(chr(c)) == "Nd":
            table[c] = str(unicodedata.digit(chr(c)))
    return table


WORD = r"[A-Za-z0-9%+-]+"
HOST = r"[A-Za-z0-9-]+"
AT, DOT = r"\s+(?:at|@)\s+", r"\s+(?:dot|\.)\s+"
INVISIBLE = re.compile("[\u200b-\u200d\u2060\ufeff\u00ad]+")
# blanks are taken from the first of a run on, so that a long run is read once
_BLANKS = r"(?:(?<!\s)\s++)?"
BRACKET_AT = re.compile(_BLANKS + r"[\[({<]\s*+(?:at|@)\s*+[\])}>]\s*+", re.I)
BRACKET_DOT = re.compile(_BLANKS + r"[\[({<]\s*+(?:dot|\.)\s*+[\])}>]\s*+", re.I)
MIXED_AT, MIXED_DOT = re.compile(r"\s+at\s+|\s*@\s*", re.I), re.compile(r"\s+dot\s+", re.I)


class Found:
    """What a ``Form`` found, like a match of a pattern."""

    def __init__(self, string: str, start: int, end: int):
        self.string, self._start, self._end = string, start, end

    def __getitem__(self, _) -> str:
        return self.string[self._start : self._end]

    def start(self) -> int:
        return self._start

    def end(self) -> int:
        return self._end


class Form:
    """A written-out address: words joined by dots, an at, a host of at least two parts.

    Each at is an anchor.  The words before it are read backwards, to the
    anchor before it at most, and the host forwards, so every character is
    read a bounded number of times.
    """

    def __init__(self, at: str, before: str, after: str, begins: str):
        self.at = re.compile(at, re.I)
        self.before = re.compile(rf"{WORD}(?:(?:{before}){WORD})*+", re.I)  # of the reversed text
        self.words = re.compile(WORD)
        self.after = re.compile(after, re.I)
        self.begins = re.compile(begins, re.I)

    def finditer(self, text: str) -> Iterator[Found]:
        back, n, done = None, len(text), 0
        for anchor in self.at.finditer(text):
            if anchor.start() <= done and done:
                continue
            host = self.after.match(text, anchor.end())
            if not host:
                continue
            back = text[::-1] if back is None else back
            words = self.before.match(back, n - anchor.start(), n - done)
            if not words:
                continue
            start = n - words.end()
            if not self.begins.match(text, start):
                # the first later word that may begin an address
                start = next((w.start() for w in self.words.finditer(text, start, anchor.start()) if self.begins.match(text, w.start())), None)
            if start is not None:
                done = host.end()
                yield Found(text, start, done)


# the dots of the reversed text are spelled backwards
BARE = Form(r"(?<!\s)\s++(?:at|@)(?=\s)", r"\s+(?:tod|\.)\s+|\.", rf"\s+{HOST}(?:(?:{DOT}|\.){HOST})*{DOT}{HOST}", r"(?<![A-Za-z0-9%+.-])")
# an at and dots of any kind; a match counts if one of them was disguised
MIXED = Form(_BLANKS + r"@|(?<!\s)\s++at(?=\s)", r"\s+tod\s+|\.", rf"\s*{HOST}(?:(?:\s+dot\s+|\.){HOST})+", r"(?<![A-Za-z0-9%+.-])(?<![A-Za-z0-9%+-]\sdot\s)")
_DIGIT = rf"(?:{'|'.join(DIGIT_WORDS)}|[0-9]+)"
SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[ \t]+|\+[ \t]*)?{_DIGIT}(?:(?:[ \t,-]+|\.|[ \t]+(?:dot|point)[ \t]+){_DIGIT}(?![A-Za-z])){{6,}}(?![A-Za-z0-9])", re.I)
# up to three digits, as figures or words
_GROUP = rf"(?:[0-9]++(?![A-Za-z])|(?:{'|'.join(DIGIT_WORDS)})(?:[ \t-]+(?:{'|'.join(DIGIT_WORDS)})){{0,2}}+(?![A-Za-z0-9])(?![ \t-]+(?:{'|'.join(DIGIT_WORDS)})(?![A-Za-z])))"
SPELLED_DOT = re.compile(r"[ \t]+(?:dot|point)[ \t]+|\.", re.I)
SPELLED_IP = re.compile(rf"(?<![A-Za-z0-9]){_GROUP}(?:(?:{SPELLED_DOT.pattern}){_GROUP}){{3,}}+", re.I)
SPELLED_PART = re.compile(r"[A-Za-z]+|[0-9]+|[ \t,-]+|[.+]")
SOME_DIGIT_WORD = re.compile("|".join(DIGIT_WORDS), re.I)
SOME_IP = re.compile(r"[0-9]\.[0-9]")
#: One of these is in every text with an at/dot disguise (lower case).
HINTS = ("dot", *(f"{a}{gap}{b}" for a in ("at", "@") for gap in ("", " ") for b in "])}>"), *(f"{a}{gap}." for a in "[({<" for gap in ("", " ")))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of every identifier, in order."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)
    for m in IP.finditer(text) if SOME_IP.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


class Traced:
    """A text with, for each character, where its source begins and ends (None: itself)."""

    def __init__(self, text: str, begin: list[int] | None = None, end: list[int] | None = None):
        self.text, self.begin, self.end = text, begin, end

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.begin is None else (self.begin[a], self.end[b - 1])

    def rewrite(self, pattern: re.Pattern | Form, parts: Callable[[re.Match | Found], list[tuple[int, int, str]]]) -> Traced:
        """Replace what ``parts`` lists of each match: (start, end, new text)."""
        text, begin, end, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            for a, b, new in parts(m):
                text += [self.text[done:a], new]
                begin += self._cut(self.begin, done, a, 0)
                end += self._cut(self.end, done, a, 1)
                s, e = self.source(a, b)
                begin += [s] * len(new)
                end += [e] * len(new)
                done = b
        if not done:
            return self
        n = len(self.text)
        text.append(self.text[done:])
        return Traced("".join(text), begin + self._cut(self.begin, done, n, 0), end + self._cut(self.end, done, n, 1))

    @staticmethod
    def _cut(kept: list[int] | None, a: int, b: int, more: int) -> list[int]:
        return list(range(a + more, b + more)) if kept is None else kept[a:b]


def _whole(new: str):
    return lambda m: [(m.start(), m.end(), new)]


def _separators(m: re.Match) -> list[tuple[int, int, str]]:
    s = m.start()
    found = [(s + x.start(), s + x.end(), "@") for x in re.finditer(AT, m[0], re.I)] + [(s + x.start(), s + x.end(), ".") for x in re.finditer(DOT, m[0], re.I)]
    return sorted(found)


def _mixed(t: Traced):
    """Separators of a mixed form; none if no separator of it was disguised."""

    def parts(m: re.Match) -> list[tuple[int, int, str]]:
        s = m.start()
        # the at before the host: the last of them, as a host holds none
        at = list(MIXED_AT.finditer(m[0]))[-1]
        found = [(s + x.start(), s + x.end(), ".") for x in MIXED_DOT.finditer(m[0])]
        ends = [t.source(i, i + 1) for i in range(s, m.end()) if t.text[i] in "@."]
        if not found and all(b - a == 1 for a, b in ends) or m[0].rpartition(".")[2].isdigit():
            return []
        return sorted([*found, (s + at.start(), s + at.end(), "@")])

    return parts


def _ip(m: re.Match) -> list[tuple[int, int, str]]:
    dots = list(SPELLED_DOT.finditer(m[0]))
    if len(dots) != 3 or all(x[0] == "." for x in dots):
        return []
    found = [(m.start() + x.start(), m.start() + x.end(), ".") for x in dots]
    begin = m.start()
    for end in [a for a, _, _ in found] + [m.end()]:
        group = m.string[begin:end]
        if not group.isdigit():
            found.append((begin, end, "".join(DIGIT_WORDS[w] for w in re.split(r"[ \t-]+", group.lower()))))
        begin = next((b for a, b, _ in found[:3] if a == end), end)
    return sorted(found)


def _digits(m: re.Match) -> list[tuple[int, int, str]]:
    if not SOME_DIGIT_WORD.search(m[0]):
        return []
    out = []
    for x in SPELLED_PART.finditer(m[0]):
        w = x[0].lower()
        new = DIGIT_WORDS.get(w) or ({"plus": "+", "dot": ".", "point": "."}.get(w) if w.isalpha() else "" if not w.strip(" \t,-") else None)
        if new is not None:
            out.append((m.start() + x.start(), m.start() + x.end(), new))
    return out


SPACED = re.compile(r"\s@\s")
_TABLE: dict[int, str] = {}
_FOREIGN: set[str] = set()


def disguised(text: str) -> list[tuple[int, int, int]]:
    """Spans that only the normalised text shows, as source offsets."""
    if not _TABLE:
        _TABLE.update(_one_to_one())
        _FOREIGN.update(map(chr, _TABLE), "\u200b\u200c\u200d\u2060\ufeff\u00ad")
    t = Traced(text)
    if not text.isascii() and not _FOREIGN.isdisjoint(text):
        t = Traced(text.translate(_TABLE)).rewrite(INVISIBLE, _whole(""))
    low = t.text.lower()
    hinted = any(x in low for x in HINTS) or "@" in low and SPACED.search(low)
    if hinted:
        t = t.rewrite(BRACKET_AT, _whole("@")).rewrite(BRACKET_DOT, _whole("."))
    if "dot" in low or "point" in low:
        t = t.rewrite(SPELLED_IP, _ip)
    if hinted:
        t = t.rewrite(BARE, _separators)
        t = t.rewrite(MIXED, _mixed(t))
    if not DIGIT_WORDS.keys().isdisjoint(low.replace("-", " ").replace(",", " ").replace(".", " ").split()):
        t = t.rewrite(SPELLED, _digits)
    if t.text == text:
        return []
    out = []
    for a, kind, b in detect(t.text):
        s, e = t.source(a, b)
        if text[s:e] != t.text[a:b]:
            out.append((s, kind, e))
    return out


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain spans, and all spans, of a whole text: (start, kind, end), in order."""
    plain = detect(text or "")
    more = disguised(text or "")
    if not more:
        return plain, plain
    # the furthest end of the plain spans up to each start
    starts, ends = [s for s, _, _ in plain], list(accumulate((e for _, _, e in plain), max))
    added = [x for x in more if not (i := bisect_left(starts, x[2])) or ends[i - 1] <= x[0]]
    return plain, sorted({*plain, *added})


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_all(documents: DataFrame) -> DataFrame:
    """doc_id, plain counts by kind, base_sha256, spans and n_disguised of every document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, text in zip(b["doc_id"], b["text"]):
                plain, every = find(text)
                n = [sum(k == j for _, k, _ in plain) for j in range(len(KINDS))]
                out.append((i, *n, hashlib.sha256(digest(plain).encode()).hexdigest(), digest(every), len(every) - len(plain)))
            yield pd.DataFrame(out, columns=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_disguised"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"
    return own_columns(documents, "doc_id", "text").mapInPandas(rows, schema)


def mask(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for a, k, b in find(text)[1]:
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:] if out else text


def mask_all(documents: DataFrame) -> DataFrame:
    """All rows and columns, with personal data masked in ``text`` (and ``n_chars`` brought up to date)."""

    @F.pandas_udf("string")
    def masked(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else mask(t))

    out = documents.withColumn("text", masked("text"))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*documents.columns)
