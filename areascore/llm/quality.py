"""Quality classifier: regularised quadratic discriminant over statistics of the text.

Each text becomes a dozen transformed statistics (logarithms of sizes, arcsine roots of shares). Each
class has a mean and a covariance shrunk towards a multiple of the identity. The margin of a text is
the difference of its two Gaussian log-densities, whose Mahalanobis terms use Cholesky factors
worked out once; a logistic curve over the margins of the labelled rows makes it a probability, as
the densities alone are far too sure of themselves.

Scale: one pass reads the texts and writes the statistics, about a hundred bytes a document. The
fit is one aggregate of sums and products with two rows as its result, and one of a histogram, both
over all labelled rows; scoring is a narrow map.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, held_out, map_batches, slices, texts
from areascore.llm.calibration import fit_logistic, logistic
from areascore.llm.words import Words, distinct_pairs, windows

FEATURES = (
    "size", "words", "upper", "symbols", "digits", "beyond_ascii", "breaks",
    "word_length", "distinct_words", "symbol_ends", "bare_symbols", "distinct_runs",
)
SHRINKAGE = 0.1
THRESHOLD = 0.3

_UPPER, _SYMBOL, _DIGIT = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[33:127] = True
_SYMBOL[48:58] = _SYMBOL[65:91] = _SYMBOL[97:123] = False


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Number of distinct values of each row."""
    return np.bincount(distinct_pairs(values, rows)[1], minlength=n_rows)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of :data:`FEATURES`; an empty text has zeros where a share or mean is undefined."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    words = Words(data, offsets)
    counts, hashes, rows = words.counts(), words.hashes(), words.rows()
    ends = _SYMBOL[data[words.ends - 1]] if len(words) else np.zeros(0, dtype=bool)
    bare = ends & (words.ends - words.starts == 1)
    runs = windows(hashes, 3)
    inside = rows[: len(runs)] == rows[2:] if len(runs) else np.zeros(0, dtype=bool)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))

    columns = [
        np.log1p(size),
        np.log1p(counts),
        share(_per_row(_UPPER[data], offsets), size),
        share(_per_row(_SYMBOL[data], offsets), size),
        share(_per_row(_DIGIT[data], offsets), size),
        share(_per_row(data >= 128, offsets), size),
        share(_per_row(data == 10, offsets), size),
        np.log1p(_per_row(data > 32, offsets) / np.maximum(counts, 1)),
        share(_distinct(hashes, rows, n), counts),
        share(np.bincount(rows[ends], minlength=n), counts),
        share(np.bincount(rows[bare], minlength=n), counts),
        share(
            _distinct(runs[inside], rows[: len(runs)][inside], n), np.bincount(rows[: len(runs)][inside], minlength=n)
        ),
    ]
    return np.column_stack(columns)


@dataclass
class Gaussian:
    """A class: its mean, the inverse of its covariance's Cholesky factor, its constant."""

    mean: np.ndarray
    inverse: np.ndarray
    constant: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.inverse.T
        return self.constant - 0.5 * np.einsum("ij,ij->i", z, z)


@dataclass
class Discriminant:
    """Two Gaussians over standardised statistics; without both of them, the share of label 1."""

    centre: np.ndarray
    scale: np.ndarray
    classes: tuple[Gaussian, Gaussian] | None
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Signed root of the difference of the log-densities; above zero: label 1 likelier."""
        if self.classes is None:
            return np.zeros(len(x))
        z = (x - self.centre) / self.scale
        difference = self.classes[1].log_density(z) - self.classes[0].log_density(z)
        return np.sign(difference) * np.sqrt(np.abs(difference))


def _discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float) -> Discriminant:
    """From count, sums and sums of products of each class."""
    d = len(FEATURES)
    total = sum(m[0] for m in moments.values())
    if total == 0:
        return Discriminant(np.zeros(d), np.ones(d), None, 0.5)
    centre = sum(m[1] for m in moments.values()) / total
    spread = np.diag(sum(m[2] for m in moments.values())) / total - centre**2
    scale = np.sqrt(np.where(spread > 1e-9, spread, 1.0))
    prior = moments[1][0] / total if 1 in moments else 0.0
    if not all(moments.get(k, (0,))[0] >= 2 for k in (0, 1)):
        return Discriminant(centre, scale, None, prior)
    classes = []
    for k in (0, 1):
        n, sums, products = moments[k]
        mean = sums / n
        covariance = (products / n - np.outer(mean, mean)) / np.outer(scale, scale)
        target = max(np.trace(covariance) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky((1 - shrinkage) * covariance + shrinkage * target)
        constant = -np.log(np.diag(factor)).sum() - 0.5 * d * np.log(2 * np.pi)
        classes.append(Gaussian((mean - centre) / scale, np.linalg.inv(factor), constant))
    return Discriminant(centre, scale, (classes[0], classes[1]), prior)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of the whole text, of every row."""

    def work(batch: pa.RecordBatch):
        for part, data, offsets in slices(batch):
            x = statistics(data, offsets)
            yield {
                "doc_id": part.column("doc_id"),
                "x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(
                    pa.list_(pa.float64())
                ),
            }

    return map_batches(texts(docs), "doc_id long, x array<double>", work)


def fit(measured: DataFrame, labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """From all rows of ``labelled``: doc_id, label 0 or 1."""
    rows = measured.join(labelled, "doc_id")
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("sums"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in upper]).alias("products"),
    )
    moments = {}
    for row in sums.collect():  # one row a class
        products = np.zeros((d, d))
        for (i, j), v in zip(upper, row.products, strict=True):
            products[i, j] = products[j, i] = v
        moments[int(row.label)] = (row.n, np.array(row.sums), products)
    return _discriminant(moments, shrinkage)


def margins(measured: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and margin of every row."""

    def work(batch: pa.RecordBatch):
        flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
        yield {"doc_id": batch.column("doc_id"), "margin": model.margin(flat.reshape(batch.num_rows, -1))}

    return map_batches(measured, "doc_id long, margin double", work)


def quality_scores(docs: DataFrame, label_rows: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Learns from ``quality`` of the labels whose crc32(doc_id) mod 5 is not 0. Null and empty texts are
    scored as texts of size zero. Without labels of both classes every score is the share of label 1 (0.5
    without any). Repeated rows are scored each; a label row given twice counts twice.
    """
    keep = Kept(docs.sparkSession)
    measured = keep(measure(docs), "statistics")
    known = label_rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    known = known.filter("label in (0, 1) and doc_id is not null").filter(~held_out())
    model = fit(measured, known, shrinkage)
    found = margins(measured, model)
    curve = fit_logistic(found.join(known, "doc_id"), "margin", "label")
    score = logistic(curve, "margin") if curve else F.lit(model.prior)
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )
