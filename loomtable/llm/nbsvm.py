"""Quality classifier: naive Bayes support vectors.

A text is a set of n-gram indicators of two kinds: its words, and runs of one to three word shapes. A shape tells how
a word is written (capitals, small letters, digits, marks; a mark twice or more as two), and whether the word before
was the same. Indicators are scaled by the log-count ratio of the two classes; a linear hinge-loss model over the
scaled indicators is fitted by dual coordinate descent, and its margin is turned into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import crc_mod, written
from loomtable.llm.toxicity import training_rows

#: Labelled rows that the classifier is fitted on, the first by a hash of their id: its only sample.
FIT_ROWS = 10_000
#: Rows of the sample that an indicator must be found in, and the most indicators (those in most rows) that the model may have.
LEAST_ROWS, FEATURES = 5, 1_000_000
C, EPOCHS, SMOOTH = 0.1, 20, 1.0

_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 else 48 if 48 <= c <= 57 else c for c in range(256))
_BEYOND = bytes(range(128, 256))
_RUN = re.compile(rb"([Aa0])\1+")
_MARKS = re.compile(rb"([^Aa0])\1+")
_EDGES = bytes(c for c in range(128) if not chr(c).isalnum())


class _Shapes(dict):
    """Shape of a whole word from its characters' kinds, kept for a bounded number of spellings."""

    def __missing__(self, kinds: bytes) -> bytes:
        if len(self) > 200_000:
            self.clear()
        found = self[kinds] = _MARKS.sub(rb"\1\1", _RUN.sub(rb"\1", kinds))
        return found


def grams(text: str | None, shapes: _Shapes) -> set[bytes | tuple[bytes, ...]]:
    """The indicators of a whole text: words as bytes, shape runs as tuples. No words: one indicator, the empty run."""
    raw = text.encode() if text else b""
    w = raw.split()
    if not w:
        return {()}
    if raw.isascii():
        kinds = raw.translate(_SHAPE).split()
    else:
        kinds = [x.translate(_SHAPE, _BEYOND) for x in w]
    s = [shapes[k] for k in kinds]
    for i in [i for i in range(1, len(w)) if w[i] == w[i - 1]]:
        s[i] = b"="
    found: set = {x.strip(_EDGES) for x in raw.lower().split()}
    found.discard(b"")
    found.update(zip(s))
    found.update(zip(s, s[1:]))
    found.update(zip(s, s[1:], s[2:]))
    return found


def log_count_ratio(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Of indicators, from the rows of each class that have them; each class's counts are smoothed and made to sum to 1."""
    p, q = pos + SMOOTH, neg + SMOOTH
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the linear SVM with hinge loss; the last weight is the bias (a column of ones).

    ``rows`` holds each row's columns, ``values`` each column's value, ``y`` is 1 or -1, ``cost`` bounds each dual
    variable. Rows go in a seeded order; it ends early when no projected gradient is left above 0.01.
    """
    w, bias, alpha = np.zeros(len(values)), 0.0, np.zeros(len(rows))
    norm = np.array([float((values[r] ** 2).sum()) + 1.0 for r in rows])
    order = np.random.default_rng(1)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)).tolist():
            r = rows[i]
            v = values[r]
            grad = y[i] * (float(w[r] @ v) + bias) - 1.0
            if (alpha[i] <= 0 and grad >= 0) or (alpha[i] >= cost[i] and grad <= 0):
                continue
            most = max(most, abs(grad))
            new = min(max(alpha[i] - grad / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            alpha[i] = new
            w[r] += step * v
            bias += step
        if most < 0.01:
            break
    return np.append(w, bias)


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), by Newton's method on smoothed targets."""
    t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        d, h = p - t, p * (1 - p)
        g = np.array([(d * margin).sum() + 1e-6 * a, d.sum()])
        m = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(m, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray, width: int) -> tuple[np.ndarray, float, float, float]:
    """Weight of each indicator (ratio times SVM weight), bias, and the two calibration terms.

    ``rows`` holds each row's indicators by number, ``y`` is 1 or -1. The calibration sees margins of rows that the
    model which made them has not: two halves are fitted crosswise.
    """

    def train(which: np.ndarray) -> tuple[np.ndarray, float]:
        rs, ys = [rows[i] for i in which], y[which]
        count = lambda s: np.bincount(np.concatenate([np.empty(0, np.int64), *[r for r, v in zip(rs, ys, strict=True) if v == s]]), minlength=width).astype(float)
        ratio = log_count_ratio(count(1), count(-1))
        weight = len(ys) / 2 / np.maximum(1, np.where(ys > 0, (ys > 0).sum(), (ys < 0).sum()))  # both classes weigh the same
        w = dual_coordinate_descent(rs, ratio, ys, C * weight)
        return w[:-1] * ratio, float(w[-1])

    every = np.arange(len(rows))
    margins = np.zeros(len(rows))
    for part in (0, 1):
        w, b = train(every[every % 2 != part])
        for i in every[every % 2 == part]:
            margins[i] = w[rows[i]].sum() + b
    a, c = calibrate(margins, y)
    w, b = train(every)
    return w, b, a, c


def _named(found: set) -> list[bytes]:
    """Indicators as bytes that tell both kinds apart."""
    return sorted(b"w" + x if isinstance(x, bytes) else b"s" + b" ".join(x) for x in found)


def _unnamed(name: bytes) -> bytes | tuple[bytes, ...]:
    return name[1:] if name[:1] == b"w" else tuple(name[1:].split(b" ")) if len(name) > 1 else ()


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    A text of any length is read whole. Null and empty texts have one indicator, that there is no word. Without both kinds of label all rows score the
    share of good labels (0.5 without any). Labels with a null id or value are left out; of several for an id the
    largest counts. Rows that repeat an id are scored each; a null id is not held out. An empty table gives no rows;
    other columns are ignored.
    """
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = _Shapes()
        for b in batches:
            names = pa.array([_named(grams(t, shapes)) for t in b.column(0).to_pylist()], pa.list_(pa.binary()))
            yield pa.record_batch([names, b.column(1).cast(pa.int32())], names=["names", "y"])

    seen = written(training_rows(docs, labels, "quality", 5, 0, rows).mapInArrow(gather, "names array<binary>, y int"))
    known = seen.select(F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ROWS)
    index = {bytes(r.name): k for k, r in enumerate(known.orderBy(F.desc("n"), "name").limit(FEATURES).collect())}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks = [[index[x] for x in names if x in index] for names in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(ks, pa.list_(pa.int32())), b.column(1)], names=["ks", "y"])

    sample = seen.mapInArrow(number, "ks array<int>, y int").orderBy("ks", "y").toArrow()  # ``rows`` rows at most
    y = np.where(sample.column("y").to_numpy() > 0, 1.0, -1.0)
    good = int((y > 0).sum())
    if 0 < good < len(y):
        w, bias, a, c = fit([np.asarray(r.as_py(), np.int64) for r in sample.column("ks")], y, len(index))
        weights = {_unnamed(f): float(w[k]) for f, k in index.items() if abs(w[k]) > 1e-9}
    else:
        weights, bias, a, c = {}, 0.0, 1.0, math.log((good + 0.5) / (len(y) - good + 0.5))
    del index, sample
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, get = _Shapes(), weights.get
        for b in batches:
            z = [math.fsum(x for f in grams(t, shapes) if (x := get(f))) + bias for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(a * np.array(z, float) + c, -500, 500))))], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    held = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
