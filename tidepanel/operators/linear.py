"""Linear regressions on any choice of columns from one table of cross-products.

One pass over the training rows gives counts, means and centred cross-products of all numeric
columns with the target, and counts and means per level of the category. Every feature set and
every penalty is then a small system of equations on the driver, whatever the number of rows.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDINARY, RIDGE, LASSO = "Linear Regression", "Ridge Regression", "Lasso Regression"
LINEAR = (ORDINARY, RIDGE, LASSO)
ROUNDING = 8 * np.finfo(float).eps


@dataclass
class Moments:
    """Rows, means and centred cross-products of some columns; parts merge without subtraction of sums.

    A mean is kept as one of the rows and what has to be added to it. So a column of one value has
    that mean to the last digit and cross-products of 0, and small differences of large means
    keep their digits. Rounded means would leave a constant a spread and levels apart from it.
    """

    n: float
    shift: np.ndarray
    rest: np.ndarray
    cross: np.ndarray | None

    @staticmethod
    def of(x: np.ndarray, with_cross: bool = True) -> Moments:
        shift = x[0].copy()
        x = x - shift
        rest = x.mean(axis=0)
        c = x - rest
        return Moments(float(len(x)), shift, rest, c.T @ c if with_cross else None)

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.rest

    def gap(self, other: Moments) -> np.ndarray:
        """The other's means less these."""
        return (other.shift - self.shift) + (other.rest - self.rest)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = self.gap(other)
        cross = None if self.cross is None else self.cross + other.cross + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.shift, self.rest + gap * (other.n / n), cross)


_PART = "level string, whole boolean, n double, shift array<double>, rest array<double>, cross array<double>"


def _emit(parts: Mapping[tuple[str | None, bool], Moments]) -> pa.RecordBatch:
    rows = [
        (level, whole, m.n, m.shift.tolist(), m.rest.tolist(), None if m.cross is None else m.cross.ravel().tolist())
        for (level, whole), m in parts.items()
    ]
    types = [pa.string(), pa.bool_(), pa.float64(), *[pa.list_(pa.float64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in _PART.split(", ")])


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (numbers, category) to one part for all of them and one per level."""
    parts: dict = {}
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]).astype(float)
        codes = batch.columns[-1].dictionary_encode()
        seen = ~np.isnan(x).any(axis=1)
        levels = codes.indices.fill_null(-1).to_numpy()
        groups = {(None, True): seen} | {(v, False): seen & (levels == i) for i, v in enumerate(codes.dictionary.to_pylist())}
        for key, rows in groups.items():
            if rows.any():
                own = Moments.of(x[rows], key[1])
                parts[key] = parts[key].merged(own) if key in parts else own
    if parts:
        yield _emit(parts)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict = {}
    for batch in batches:
        for level, whole, n, shift, rest, cross in zip(*[c.to_pylist() for c in batch.columns]):
            own = Moments(n, np.array(shift), np.array(rest), None if cross is None else np.array(cross).reshape(len(rest), -1))
            parts[level, whole] = parts[level, whole].merged(own) if (level, whole) in parts else own
    if parts:
        yield _emit(parts)


@dataclass
class Gram:
    """What the training rows say about ``names`` (the last one is the target) and the levels."""

    names: list[str]
    total: Moments
    levels: dict[str, Moments]
    seconds: float


def gram(train: DataFrame, numeric: Sequence[str], target: str, category: str) -> Gram:
    """Rows with a null or NaN among the numbers are left out; a null level is none of the levels.

    A task hands on a row for itself and one per level; they meet level by level, so that the
    driver gets one row per level and one for the whole, of a size given by the columns.
    """
    start = time.perf_counter()
    names = [*numeric, target]
    numbers = train.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(category).cast("string").alias("_level"))
    merged = numbers.mapInArrow(_reduce, _PART).repartition("whole", "level").mapInArrow(_merge, _PART).collect()
    total, levels = None, {}
    for r in merged:
        cross = None if r["cross"] is None else np.array(r["cross"]).reshape(len(names), -1)
        own = Moments(r["n"], np.array(r["shift"]), np.array(r["rest"]), cross)
        if r["whole"]:
            total = own
        else:
            levels[r["level"]] = own
    if total is None:
        raise ValueError("there are no training rows")
    return Gram(names, total, dict(sorted(levels.items())), time.perf_counter() - start)


@dataclass
class Line:
    """A fitted regression: ``intercept + sum(weight * (column - mean)) + the level's weight``."""

    intercept: float
    weights: dict[str, tuple[float, float]]  # column: (weight, mean)
    levels: dict[str, float]
    standard: np.ndarray  # coefficients of the standardised numbers, then of the levels but the first

    def expression(self, category: str) -> str:
        """As SQL text over the original columns; unknown levels add nothing."""
        number = lambda v: f"({float(v)!r}D)"
        terms = [number(self.intercept)]
        terms += [f"{number(w)} * (CAST(`{c}` AS DOUBLE) - {number(m)})" for c, (w, m) in self.weights.items()]
        if self.levels:
            text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
            pairs = ", ".join(f"{text(v)}, {number(w)}" for v, w in self.levels.items())
            terms.append(f"coalesce(try_element_at(map({pairs}), CAST(`{category}` AS STRING)), 0D)")
        return " + ".join(terms)

    def pipeline(self, category: str) -> PipelineModel:
        """A one-stage pipeline that adds ``prediction``; it is saved and loaded like any other."""
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {self.expression(category)} AS prediction FROM __THIS__")])


def _lasso(a: np.ndarray, b: np.ndarray, penalty: float, rounds: int = 10_000, tolerance: float = 1e-12) -> np.ndarray:
    """Coordinate descent on cross-products per row: minimises ``x a x / 2 - b x + penalty |x|``."""
    x, size = np.zeros(len(b)), np.diag(a)
    for _ in range(rounds):
        largest = 0.0
        for j in np.flatnonzero(size > 0):
            free = b[j] - a[j] @ x + size[j] * x[j]
            new = np.sign(free) * max(abs(free) - penalty, 0.0) / size[j]
            largest, x[j] = max(largest, abs(new - x[j]) * np.sqrt(size[j])), new
        if largest < tolerance * max(1.0, float(np.abs(x).max(initial=0.0))):
            break
    return x


def solve(g: Gram, numeric: Sequence[str], model: str, penalty: float = 1.0) -> Line:
    """Ordinary least squares, ridge (``penalty`` on the sum of squares) or lasso (on half the mean square).

    Numbers are standardised by their population deviation, levels are 0 or 1 without the first one;
    the intercept is not penalised. A constant column has weight 0, as has one whose deviation is only
    rounding of its mean. Columns that depend on each other share the weight of least size.
    """
    at, y, n = [g.names.index(c) for c in numeric], len(g.names) - 1, g.total.n
    deviation = np.sqrt(np.diag(g.total.cross)[at] / n)
    varies = deviation > ROUNDING * np.abs(g.total.mean[at])
    scale = np.where(varies, deviation, np.inf)  # the products of a constant become 0
    own = list(g.levels.items())[1:]
    sizes = np.array([m.n for _, m in own])
    gaps = np.array([g.total.gap(m) for _, m in own]).reshape(len(own), len(g.names))
    corner = sizes[:, None] * gaps[:, at] / scale
    a = np.block([
        [g.total.cross[np.ix_(at, at)] / np.outer(scale, scale), corner.T],
        [corner, np.diag(sizes) - np.outer(sizes, sizes) / n],
    ])
    b = np.concatenate([g.total.cross[at, y] / scale, sizes * gaps[:, y]])
    if model == LASSO:
        found = _lasso(a / n, b / n, penalty)
    elif model == RIDGE:
        found = np.linalg.solve(a + penalty * np.eye(len(b)), b)
    else:
        found = np.linalg.lstsq(a, b, rcond=1e-13)[0]
    k = len(at)
    found[:k][~varies] = 0.0
    weights = {c: (float(w / s), float(g.total.mean[i])) for c, w, s, i in zip(numeric, found, scale, at)}
    levels = {v: float(w) for (v, _), w in zip(own, found[k:])}
    intercept = g.total.mean[y] - float(found[k:] @ (sizes / n)) if own else g.total.mean[y]
    return Line(float(intercept), weights, levels, found)
