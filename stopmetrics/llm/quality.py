"""Text quality by ordinal regression: one weight vector over hashed text, ordered thresholds between grades."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopmetrics.llm.samples import labelled_sample, slices

_SIGNS = re.compile(r"[^\w\s]+")
_SHARES = (0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade > j) = 1 / (1 + exp(thresholds[j] - weights . features)); thresholds ascend."""

    weights: bytes  # 32-bit floats
    thresholds: tuple[float, ...]

    @property
    def vector(self) -> np.ndarray:
        return np.frombuffer(self.weights, dtype="<f4")


def _shape(text: str, words: list[str]) -> list[str]:
    """Coarse measures of a text, as words of their own."""
    distinct = len(set(words)) / len(words)
    longest = same = 1
    for a, b in zip(words, words[1:]):
        same = same + 1 if a == b else 1
        longest = max(longest, same)
    share = {
        "signs": sum(map(len, _SIGNS.findall(text))) / len(text),
        "upper": sum(map(str.isupper, words)) / len(words),
        "digits": sum(map(str.isdigit, words)) / len(words),
        "same": 1 - distinct,
    }
    measures = [f"\0{name}>{step}" for name, value in share.items() for step in _SHARES if value > step]
    return measures + [f"\0run>{step}" for step in (1, 2, 4, 8) if longest > step]


def features(text: str | None, dimensions: int, memo: dict[str, int]) -> np.ndarray:
    """Distinct buckets of the hashed words, sign runs and measures of `text`."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    named = {*words, *_SIGNS.findall(text), *_shape(text, words)}
    if len(memo) > 200_000:
        memo.clear()
    for word in named:
        if word not in memo:
            memo[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % dimensions
    return np.unique(np.fromiter((memo[word] for word in named), np.int64, len(named)))


_MEMO: dict[str, int] = {}


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, classes: int, dimensions: int, steps: int = 200, ridge: float = 3e-4) -> OrdinalModel:
    """Maximum likelihood with a ridge, by gradient steps of adaptive size; features of a row share unit length."""
    if not len(rows):
        return OrdinalModel(np.zeros(dimensions, "<f4").tobytes(), tuple(float(j) for j in range(classes - 1)))
    size = np.array([max(1, len(row)) for row in rows])
    column = np.concatenate([row if len(row) else np.zeros(1, np.int64) for row in rows])
    value = np.repeat(np.array([1 / np.sqrt(n) if len(row) else 0.0 for n, row in zip(size, rows)]), size)
    starts = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(rows)), size)
    above = np.array([[grade > j for j in range(classes - 1)] for grade in grades], dtype=float)
    share = np.clip(above.mean(axis=0), 0.01, 0.99)
    # Thresholds are a first one and positive gaps, so that they stay in order.
    first = np.log((1 - share) / share)
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    w = np.zeros(dimensions)
    state = [np.zeros(dimensions), np.zeros(dimensions), np.zeros(len(free)), np.zeros(len(free))]

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    n = len(rows)
    for step in range(1, steps + 1):
        gaps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.add.reduceat(w[column] * value, starts)
        tail = np.column_stack([np.ones(n), sigmoid(z[:, None] - thresholds), np.zeros(n)])
        slope = tail * (1 - tail)
        p = np.maximum(tail[np.arange(n), grades] - tail[np.arange(n), grades + 1], 1e-9)
        up, down = slope[np.arange(n), grades] / p, slope[np.arange(n), grades + 1] / p
        by_z = -(up - down) / n
        by_w = np.bincount(column, weights=by_z[owner] * value, minlength=dimensions) + ridge * w
        by_threshold = np.array([(up[grades == j + 1].sum() - down[grades == j].sum()) / n for j in range(classes - 1)])
        later = np.cumsum(by_threshold[::-1])[::-1]
        by_free = np.concatenate([later[:1], later[1:] * gaps])
        for at, (target, gradient) in enumerate(((w, by_w), (free, by_free))):
            mean, square = state[2 * at], state[2 * at + 1]
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            target -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    return OrdinalModel(w.astype("<f4").tobytes(), tuple(float(t) for t in thresholds))


def fit_quality(docs: DataFrame, labels: DataFrame, rating: str = "quality", grades: int = 2, rows_per_grade: int = 4000, dimensions: int = 1 << 16) -> OrdinalModel:
    """Fit on at most `rows_per_grade` documents of each grade 0 .. grades - 1 that are not held out.

    Their hashed features, not their texts, reach the driver; the bound is the parameter. Grades that no label has
    leave their thresholds a little above their neighbours'.
    """
    sample = labelled_sample(docs, labels, rating, rows_per_grade, grades)

    def of_batch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [features(text, dimensions, _MEMO).astype("<i4").tobytes() for part in slices(batch) for text in part]
            yield pa.array(found, pa.binary())

    found = sample.select("label", F.arrow_udf(of_batch, "binary")("text").alias("x")).orderBy("label", "x").toPandas()
    rows = [np.frombuffer(x, dtype="<i4").astype(np.int64) for x in found["x"]]
    return fit_ordinal(rows, found["label"].to_numpy(np.int64), grades, dimensions)


def score_quality(docs: DataFrame, model: OrdinalModel, tail_from: int = 1) -> DataFrame:
    """`docs` (text, ...) with latent, expected_grade, tail_probabilities, P(grade >= 1), P(grade >= 2) and so on, and
    tail_probability, P(grade >= tail_from); such columns are replaced, all rows stay. A NULL or empty text has latent 0,
    the score of a text without evidence. A repeated doc_id is scored row by row."""
    dimensions = len(model.weights) // 4

    def of_batch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = model.vector
        for batch in texts:
            rows = (features(text, dimensions, _MEMO) for part in slices(batch) for text in part)
            yield pa.array([float(weights[row].sum() / np.sqrt(max(1, len(row)))) for row in rows], pa.float64())

    marked = docs.withColumn("latent", F.arrow_udf(of_batch, "double")(F.col("text").cast("string")))
    tails = [1 / (1 + F.exp(F.lit(threshold) - F.col("latent"))) for threshold in model.thresholds]
    expected = F.lit(0.0)
    for tail in tails:
        expected = expected + tail
    columns = {"expected_grade": expected, "tail_probabilities": F.array(*tails), "tail_probability": tails[tail_from - 1]}
    return marked.withColumns(columns)
