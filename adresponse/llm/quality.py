"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text gives 20 numbers, log-transformed; the labelled documents'
sums and cross products, added up over partitions, give each class a mean and
a covariance, shrunk toward the pooled covariance and toward a multiple of the
identity.  A score is the difference of the two log densities (Mahalanobis
distances by Cholesky factors computed once) plus the log prior ratio, pressed
into 0..1 by a logistic curve whose width is the number of statistics.

Defined cases: a null text is an empty one and gets the statistics of no
words; without labels of one class every score says the other (0 or 1),
without any it is 0.5; repeated rows are scored alike; a document labelled
twice counts twice; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import keep, own_columns

HELD_OUT_FOLDS, HELD_OUT = 3, 1
TO_POOLED, TO_IDENTITY = 0.15, 0.02
EPS = 1e-3
STATISTICS = 20


def _kinds() -> np.ndarray:
    kind = np.zeros(256, dtype=np.int64)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?", b"'\"()-"), 1):
        kind[list(chars)] = k
    kind[128:] = 9
    return kind


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    bytes_ = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = max(1, len(raw))
    by_kind = np.bincount(_kinds(), weights=bytes_, minlength=10) / n
    share = bytes_[bytes_ > 0] / n
    entropy = float(-(share * np.log(share)).sum())
    words = raw.split()
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    again = sum(map(bytes.__eq__, words, words[1:])) / m
    log = lambda x: math.log(x + EPS)
    return [
        *[log(by_kind[k]) for k in (0, 2, 3, 4, 5, 6, 7, 8, 9)],
        entropy,
        math.log1p(len(raw)),
        math.log1p(len(words)),
        math.log1p(float(lengths.mean()) if len(words) else 0.0),
        math.log1p(float(lengths.std()) if len(words) else 0.0),
        math.log1p(int(lengths.max()) if len(words) else 0),
        (math.log1p(len(seen)) / math.log1p(m)) if words else 0.0,
        log(max(seen.values()) / m if words else 0.0),
        log(again),
        log(1 - len(set(lines)) / len(lines) if lines else 0.0),
        log(float((lengths <= 3).mean()) if words else 0.0),
    ]


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"doc_id": b["doc_id"], "f": [statistics(t) for t in b["text"]]})


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class: count, sums and cross products of this partition's rows."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for y, g in b.groupby("quality"):
            x = np.stack(g["f"].to_numpy())
            x = np.hstack([np.ones((len(x), 1)), x])
            total[int(y)] = total.get(int(y), 0) + x.T @ x
    if total:  # a partition may hold no labelled row
        yield pd.DataFrame({"quality": list(total), "m": [v.ravel() for v in total.values()]})


class Discriminant:
    """Class means and Cholesky factors of the shrunk covariances."""

    def __init__(self, moments: dict[int, np.ndarray]):
        self.seen = {y: float(m[0, 0]) for y, m in moments.items() if m[0, 0] > 0}
        if len(self.seen) < 2:
            return
        mean = {y: moments[y][0, 1:] / n for y, n in self.seen.items()}
        cov = {y: moments[y][1:, 1:] / n - np.outer(mean[y], mean[y]) for y, n in self.seen.items()}
        total = sum(self.seen.values())
        pooled = sum(self.seen[y] / total * c for y, c in cov.items())
        self.scale = np.sqrt(np.diag(pooled)) + 1e-6  # statistics get equal weight in the identity part
        self.mean = {y: m / self.scale for y, m in mean.items()}
        self.inverse, self.logdet = {}, {}
        for y, c in cov.items():
            s = ((1 - TO_POOLED) * c + TO_POOLED * pooled) / np.outer(self.scale, self.scale)
            s = (1 - TO_IDENTITY) * s + TO_IDENTITY * max(1e-3, np.trace(s) / len(s)) * np.eye(len(s))
            lower = np.linalg.cholesky(s)
            self.inverse[y] = np.linalg.inv(lower)
            self.logdet[y] = 2 * np.log(np.diag(lower)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.seen) < 2:
            return np.full(len(x), 1.0 if 1 in self.seen else 0.0 if 0 in self.seen else 0.5)
        x = x / self.scale
        density = {}
        for y, n in self.seen.items():
            z = (x - self.mean[y]) @ self.inverse[y].T
            density[y] = math.log(n) - 0.5 * ((z * z).sum(axis=1) + self.logdet[y])
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / STATISTICS, -500, 500)))


def fit(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from the labelled documents outside the held-out fold."""
    marked = own_columns(labels, "doc_id", "quality").where("quality in (0, 1)")
    rows = measured.where("not held_out").join(marked, "doc_id").select("quality", "f")
    parts = rows.mapInPandas(_moments, "quality int, m array<double>")
    sums = parts.select("quality", F.posexplode("m").alias("at", "v")).groupBy("quality", "at").agg(F.sum("v").alias("v"))
    moments: dict[int, np.ndarray] = {}
    side = STATISTICS + 1
    for r in sums.collect():  # 2 classes x 21 x 21 numbers
        moments.setdefault(r.quality, np.zeros(side * side))[r["at"]] = r.v
    return Discriminant({y: m.reshape(side, side) for y, m in moments.items()})


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, held_out and statistics of every document, written once."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_FOLDS == HELD_OUT, F.lit(False))
    rows = own_columns(documents, "doc_id", "text").mapInPandas(_measure, "doc_id long, f array<double>")
    return keep(rows.withColumn("held_out", held), "quality")


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    measured = measure(documents)
    model = fit(measured, labels)

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                s = model.score(np.stack(b["f"].to_numpy()))
                yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    return measured.mapInPandas(scores, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier doesn't reject, with all their columns.

    The verdict goes by doc_id; rows that share one are kept if all are good.
    """
    bad = score_documents(documents, labels).where("predicted = 0").select(F.col("doc_id").alias("_bad_id")).distinct()
    return documents.join(bad, documents["doc_id"] == bad["_bad_id"], "left_anti")


