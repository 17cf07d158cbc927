"""Text quality by regularised quadratic discriminant analysis.

Every document becomes a vector of transformed statistics of its whole text.
The class moments (count, sums, cross products) are summed over the labelled
rows in Spark; from them come class means, shrunk class covariances and their
Cholesky factors, which are computed once and travel with the scoring tasks. A score is the posterior of
class 1 from the difference of the two Mahalanobis log densities.

Edge cases: a null or empty text has statistics like any other (all zero) and
gets a score. Rows without a label, or with a null one, do not train; a
document labelled twice counts twice. With a class missing from the labelled
rows the prior decides (no labels: 0.5). Statistics are clipped at ``CLIP``
standard deviations, so a very odd text cannot overflow.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import slices, store, text_bytes, values

SHRINKAGE = 0.05  # share of the pooled covariance, and again of the unit matrix, in a class covariance
CLIP = 8.0
CONSTANT = 1e-12  # a statistic whose variance is below this share of its square is constant

_LOWER = b"abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_PROSE = b".,;:!?'\"()-"
_HIGH = bytes(range(128, 256))

STATISTICS = ("words", "word_length", "upper", "digits", "high", "space", "prose_marks", "other_marks",
              "distinct_words", "top_word", "repeats", "lines", "distinct_lines", "line_length", "stops",
              "marked_words", "longest_word", "long_words")


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of one text, in the order of ``STATISTICS``."""
    size = len(text)
    tokens = text.split()
    n = len(tokens)
    if not n:
        return [0.0] * len(STATISTICS)

    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / size

    lower, upper, digits, high = share(_LOWER), share(_UPPER), share(_DIGITS), share(_HIGH)
    space, prose = share(_SPACE), share(_PROSE)
    other = max(0.0, 1 - lower - upper - digits - high - space - prose)
    counts = Counter(tokens)
    lines = text.split(b"\n")
    lengths = list(map(len, tokens))
    stops = text.count(b". ") + text.count(b".\n")
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in _PROSE for w in counts)
    return [
        math.log1p(n),
        math.log(sum(lengths) / n),
        math.sqrt(upper), math.sqrt(digits), math.sqrt(high), math.sqrt(space), math.sqrt(prose),
        math.sqrt(other),
        math.log1p(len(counts)) / math.log1p(n),
        math.sqrt(max(counts.values()) / n),
        math.sqrt(sum(map(bytes.__eq__, tokens, tokens[1:])) / n),
        math.log1p(len(lines)),
        len(set(lines)) / len(lines),
        math.log1p(size / len(lines)),
        math.sqrt(stops / n),
        math.sqrt(marked / len(counts)),
        math.log1p(max(lengths)),
        math.sqrt(sum(x > 12 for x in lengths) / n),
    ]


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x array<double>`` for every row."""
    ship.ensure(df.sparkSession)
    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for part in slices(batches, "text"):
            x = [statistics(t) for t in text_bytes(part, "text")]
            yield pa.record_batch([part.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return slim.mapInArrow(run, f"id {dict(slim.dtypes)['id']}, x array<double>")


@dataclass
class Model:
    """Fitted discriminant: prior log odds, scaling, and per class the mean,
    the inverse Cholesky factor of the covariance and its log determinant."""

    odds: float
    centre: np.ndarray
    scale: np.ndarray
    classes: list[tuple[np.ndarray, np.ndarray, float]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 for the rows of ``x``."""
        if not self.classes:
            return np.full(len(x), 1 / (1 + math.exp(-self.odds)))
        z = np.clip((x - self.centre) / self.scale, -CLIP, CLIP)
        logs = []
        for mean, factor, logdet in self.classes:
            d = (z - mean) @ factor.T
            logs.append(-0.5 * ((d * d).sum(axis=1) + logdet))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.odds, -500, 500)))


def moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class the count, sum and cross products of ``x`` over ``rows(x,
    label)``; each task sends one row per class, Spark adds them."""
    d = len(STATISTICS)

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            label = np.array(values(batch, "label"))
            x = np.array(values(batch, "x"), dtype=np.float64).reshape(len(label), d)
            x = np.hstack([np.ones((len(x), 1)), x])
            for k in np.unique(label):
                part = x[label == k]
                held[int(k)] = held.get(int(k), 0) + part.T @ part
        for k, m in held.items():
            size = len(m) ** 2
            yield pa.record_batch([pa.array([k] * size, pa.int32()), pa.array(range(size), pa.int32()),
                                   pa.array(m.ravel())], names=["label", "cell", "v"])

    cells = rows.mapInArrow(run, "label int, cell int, v double").groupBy("label", "cell").agg(
        F.sum("v").alias("v"))
    out = {}
    for label, cell, v in cells.collect():  # (statistics + 1)^2 numbers per class
        out.setdefault(label, np.zeros((d + 1, d + 1)))[divmod(cell, d + 1)] = v
    return {k: (int(m[0, 0]), m[0, 1:], m[1:, 1:]) for k, m in out.items()}


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Model:
    """Fit on ``rows(x array<double>, label int 0/1)``, all of them."""
    found = moments(rows)
    d = len(STATISTICS)
    n = {k: found[k][0] if k in found else 0 for k in (0, 1)}
    odds = math.log((n[1] + 1) / (n[0] + 1))
    if min(n.values()) == 0:
        return Model(odds, np.zeros(d), np.ones(d), [])
    total = n[0] + n[1]
    centre = (found[0][1] + found[1][1]) / total
    square = np.diag(found[0][2] + found[1][2]) / total
    spread = square - centre ** 2
    varies = spread > CONSTANT * square  # the rest is rounding of sums, which their order changes
    scale = np.where(varies, np.sqrt(np.where(varies, spread, 1.0)), 1.0)
    means, covs = [], []
    for k in (0, 1):
        count, s, q = found[k]
        mean = s / count
        means.append((mean - centre) / scale)
        covs.append((q / count - np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / total
    classes = []
    for mean, cov in zip(means, covs):
        shrunk = (1 - 2 * shrinkage) * cov + shrinkage * pooled + shrinkage * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        classes.append((mean, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum())))
    return Model(odds, centre, scale, classes)


def apply(stats: DataFrame, model: Model) -> DataFrame:
    """``id, score`` for every row of ``document_statistics``."""
    kind = dict(stats.dtypes)["id"]

    def run(batches):
        for batch in batches:
            x = np.array(values(batch, "x"), dtype=np.float64).reshape(batch.num_rows, len(STATISTICS))
            yield pa.record_batch([batch.column(batch.schema.get_field_index("id")),
                                   pa.array(model.score(x))], names=["id", "score"])

    return stats.mapInArrow(run, f"id {kind}, score double")


def held_out(id_col) -> F.Column:
    """Fold kept out of training: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """``id, score`` for every row of ``docs(doc_id, text)``, trained on
    ``labels(doc_id, quality)`` outside the held-out fold. The statistics are
    written once and used for training and scoring."""
    stats, _ = store(document_statistics(docs), "statistics")
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("id"),
                                                     F.col("quality").cast("int").alias("label"))
    train = stats.join(known.where(~held_out(F.col("id"))), "id").select("x", "label")
    return apply(stats, fit(train, shrinkage))


def keep(docs: DataFrame, labels: DataFrame, least: float, shrinkage: float = SHRINKAGE) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that score ``least`` or more, by
    a model trained on all of ``labels(doc_id, quality)``. Rows are judged by
    their own text where they lie, without a shuffle."""
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("id"),
                                                     F.col("quality").cast("int").alias("label"))
    model = fit(document_statistics(docs).join(known, "id").select("x", "label"), shrinkage)

    def run(batches):
        for part in slices(batches, "text"):
            x = np.array([statistics(t) for t in text_bytes(part, "text")], dtype=np.float64)
            yield part.filter(pa.array(model.score(x) >= least))

    return docs.mapInArrow(run, docs.schema)
