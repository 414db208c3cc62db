"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance, shrunk towards its diagonal and towards the pooled covariance.  The score of a
text is the logistic of the scaled difference of the two log densities and priors; densities come from Mahalanobis
distances to cached Cholesky factors.  Class sums (count, sum, sum of products) are accumulated by the tasks over all
labelled rows given; only these few numbers per task reach the driver.  A scale and an offset are then fitted to a
histogram of differences on the same rows, also summed over tasks.

Statistics of a text: word count, shares of capitals, digits, symbol and mark characters, adjacent and overall repeated
words and word pairs, word lengths, sentence ends and line ends; each is transformed to be closer to normal.

Defined cases: a null or empty text has the statistics of zero words and gets a score; rows without label do not train;
with one class only, or none, every score is that class (1 where there is none); repeated rows count each time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitmaps, words

NAMES = (
    "words", "capitals", "digits", "symbols", "bars", "exclamations", "adjacent", "distinct", "pairs", "word_length", "word_spread", "stops", "commas", "lines", "marked_words",
)
THRESHOLD = 0.3
#: Shares of the diagonal and of the pooled covariance in each class's covariance.
SHRINK_DIAGONAL, SHRINK_POOLED = 0.15, 0.05
_classes = words.Local()


def _class_table() -> np.ndarray:
    if "table" not in _classes:
        table = np.zeros(256, np.uint8)
        groups = {1: range(65, 91), 2: range(97, 123), 3: range(48, 58), 4: b"#$%&*+<=>@\\^_`{}~[]/", 5: b"|", 6: b"!", 7: b".?;:", 8: b",", 9: b"\n"}
        for number, group in groups.items():
            table[list(group)] = number
        table[128:] = 2
        _classes["table"] = table
    return _classes["table"]


def _row_sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    offsets, data = words._buffers(texts)
    out = []
    for block in words.word_blocks(texts):
        rows = len(block.bounds) - 1
        at = offsets[block.first : block.first + rows + 1] - offsets[block.first]
        kind = _class_table()[block.data]
        # capitals beyond ASCII: two-byte Latin letters C3 80 to C3 9E
        upper = kind == 1
        if len(block.data) > 1:
            upper[1:] |= (block.data[:-1] == 0xC3) & (block.data[1:] >= 0x80) & (block.data[1:] <= 0x9E)
        counts = {n: _row_sums(kind == c, at).astype(float) for n, c in (("lower", 2), ("digits", 3), ("symbols", 4), ("bars", 5), ("marks", 6), ("stops", 7), ("commas", 8), ("lines", 9))}
        capitals = _row_sums(upper, at).astype(float)
        letters = counts["lower"] + _row_sums(kind == 1, at)
        n = np.diff(block.bounds).astype(float)
        size = (block.ends - block.starts).astype(float)
        row = np.repeat(np.arange(rows), np.diff(block.bounds))
        total = np.bincount(row, size, rows)
        # a few typical words are added, so that short texts stay near the middle
        mean = (total + 10 * 5.5) / (n + 10)
        spread = np.sqrt(np.maximum((np.bincount(row, size * size, rows) + 10 * (5.5**2 + 9)) / (n + 10) - mean * mean, 0))
        same = np.zeros(len(row))
        pair = np.zeros(0, np.uint64)
        if len(row) > 1:
            inside = row[1:] == row[:-1]
            same[1:] = inside & (block.words[1:] == block.words[:-1])
            pair = words.mix(block.words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + block.words[1:])[inside]
        tag = row.astype(np.uint64) << np.uint64(40)
        distinct = np.bincount((np.unique(tag | (block.words >> np.uint64(24))) >> np.uint64(40)).astype(np.int64), minlength=rows)
        pair_row = row[1:][inside] if len(row) > 1 else np.zeros(0, np.int64)
        pairs = np.bincount((np.unique((pair_row.astype(np.uint64) << np.uint64(40)) | (pair >> np.uint64(24))) >> np.uint64(40)).astype(np.int64), minlength=rows)
        ended = np.bincount(row, np.isin(kind[block.ends - 1], (4, 6)), rows) if len(row) else np.zeros(rows)
        share = lambda x, y, usual=0.04: np.log((x + 5 * usual) / (y + 5.0))
        out.append(
            np.column_stack(
                [
                    np.log1p(n), share(capitals, letters), share(counts["digits"], letters), share(counts["symbols"], n), share(counts["bars"], n), share(counts["marks"], n),
                    share(np.bincount(row, same, rows), n), np.log((distinct + 12.0) / (n + 12.0)), np.log((pairs + 12.0) / (np.maximum(n - 1, 0) + 12.0)), np.log(mean), np.log(spread),
                    share(counts["stops"], n, 0.1), share(counts["commas"], n), share(counts["lines"], n), share(ended, n),
                ]
            )
        )
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


def add_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    @F.pandas_udf("array<double>")
    def work(column: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(pa.array(column, pa.string(), from_pandas=True))), dtype=object)

    return docs.withColumn(name, work(F.col(text)))


@dataclass
class Model:
    """Means, Cholesky factors, log determinants and priors of classes 0 and 1, and the final scale and offset."""

    means: list
    factors: list
    offsets: list
    scale: float = 1.0
    shift: float = 0.0
    only: int | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density and prior of class 1 less those of class 0."""
        if self.only is not None or not len(x):
            return np.zeros(len(x))
        parts = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            z = (x - mean) @ factor
            parts.append(offset - 0.5 * (z * z).sum(1))
        return parts[1] - parts[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), float(self.only))
        return 1 / (1 + np.exp(-np.clip(self.scale * squash(self.difference(x)) + self.shift, -30, 30)))


def squash(d: np.ndarray) -> np.ndarray:
    """Differences far from 0 grow with their logarithm only, so that scores keep apart."""
    return np.sign(d) * np.log1p(np.abs(d))


def _sums(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of the statistics, by label."""
    size = len(NAMES)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {}
        for batch in batches:
            for label, part in batch.groupby("label"):
                x = np.stack(part["statistics"].tolist())
                n, s, p = held.get(label, (0, np.zeros(size), np.zeros((size, size))))
                held[label] = (n + len(x), s + x.sum(0), p + x.T @ x)
        for label, (n, s, p) in held.items():
            yield pd.DataFrame({"label": [label], "sums": [np.concatenate([[n], s, p.ravel()])]})

    parts = rows.mapInPandas(work, "label int, sums array<double>")
    added = parts.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("value")).collect()
    out = {}
    for label in {r["label"] for r in added}:
        v = np.zeros(1 + size + size * size)
        for r in added:
            if r["label"] == label:
                v[r["pos"]] = r["value"]
        out[label] = (int(v[0]), v[1 : size + 1], v[size + 1 :].reshape(size, size))
    return out


def fit(rows: DataFrame) -> Model:
    """Fit on rows of ``statistics`` and ``label`` (0, 1, or null, which is left out)."""
    rows = rows.where("label in (0, 1) and statistics is not null").select(F.col("label").cast("int"), "statistics")
    sums = _sums(rows)
    if len(sums) < 2:
        return Model([], [], [], only=next(iter(sums), 1))
    n = {c: sums[c][0] for c in (0, 1)}
    means = [sums[c][1] / n[c] for c in (0, 1)]
    spread = [sums[c][2] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / (n[0] + n[1])
    floor = np.diag(1e-4 + 1e-3 * np.maximum(np.diag(pooled), 0))
    factors, offsets = [], []
    for c in (0, 1):
        cov = (1 - SHRINK_DIAGONAL - SHRINK_POOLED) * spread[c] + SHRINK_DIAGONAL * np.diag(np.diag(spread[c])) + SHRINK_POOLED * pooled + floor
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.solve(lower, np.eye(len(lower))).T)  # x times this has unit covariance
        offsets.append(float(np.log(n[c] / (n[0] + n[1])) - np.log(np.diag(lower)).sum()))
    model = Model(means, factors, offsets)
    model.scale, model.shift = _calibrate(rows, model)
    return model


def _calibrate(rows: DataFrame, model: Model) -> tuple[float, float]:
    """Logistic fit of label on the squashed difference, from counts in fixed bins."""

    @F.pandas_udf("int")
    def binned(column: pd.Series) -> pd.Series:
        d = squash(model.difference(np.stack(column.tolist()))) if len(column) else np.zeros(0)
        return pd.Series(np.clip(np.floor(d * 20), -400, 400).astype("int32"))

    counts = rows.groupBy(binned("statistics").alias("bin"), "label").count().collect()
    x = np.array([(r["bin"] + 0.5) / 20 for r in counts])
    y = np.array([r["label"] for r in counts], float)
    w = np.array([r["count"] for r in counts], float)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (y - p) * x).sum() - 1e-3 * a, (w * (y - p)).sum()])
        h = w * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, g), -1, 1)
        a, b = a + step[0], b + step[1]
    return (float(a), float(b)) if np.isfinite([a, b]).all() and a > 0 else (1.0, 0.0)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", decision: str = "predicted") -> DataFrame:
    """Append the probability of label 1 and the decision; columns of those names are replaced, all others kept."""

    @F.pandas_udf("double")
    def work(column: pd.Series) -> pd.Series:
        return pd.Series(model.probability(statistics(pa.array(column, pa.string(), from_pandas=True))))

    return docs.withColumn(name, work(F.col(text))).withColumn(decision, (F.col(name) >= THRESHOLD).cast("int"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the rows of ``docs`` that ``labels`` covers; only statistics are joined, never texts.

    A bitmap of the labelled keys keeps the statistics of all other texts from being worked out.
    """
    marked = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("label"))
    texts = bitmaps.concerned(docs.select(F.col(key).alias("k"), F.col(text).alias("text")), marked, ["k"])
    stats = add_statistics(texts).drop("text")
    rows = marked.join(stats, "k").select("label", "statistics").persist()
    model = fit(rows)
    rows.unpersist()
    return model
