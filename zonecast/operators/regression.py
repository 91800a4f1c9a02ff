"""Regressions fitted by sums over the training rows: least squares, Huber, quantile and ordinal.

Every step of a fit is one pass: each task reduces its rows to a gradient and a Gram matrix, Spark adds these up entry by entry, and the
driver solves a system as large as the number of features. No row leaves its task. Steps read the few columns of the fit, written once.

Features are shifted and divided by their mean and deviation for the arithmetic alone; coefficients are those of the features as they
are. A feature without spread has coefficient 0, and of features that depend on each other the shortest solution is taken. Rows with a null
or NaN in a feature, the target or the weight are left out; without any rows all coefficients are 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from zonecast.functions.scalar import floor_zero
from zonecast.operators.prep import log_minmax, log_minmax_inverse, target_scaler
from zonecast.session import materialize

#: Huber's threshold on the scaled log target.
HUBER_DELTA = 0.85
#: The log link stays below exp(20) whatever the features.
LOG_LIMIT = 20.0


@dataclass(frozen=True)
class Linear:
    """A linear predictor; ``link`` is "identity" or "log"."""

    coefficients: Mapping[str, float]
    intercept: float = 0.0
    link: str = "identity"

    def column(self, value: Callable[[str], Column] = F.col) -> Column:
        """The prediction from ``value(feature)``, by default the columns of that name: one expression, no Python."""
        total = F.lit(float(self.intercept))
        for name, c in self.coefficients.items():
            total = total + F.lit(float(c)) * value(name).cast("double")
        return F.exp(F.least(total, F.lit(LOG_LIMIT))) if self.link == "log" else total

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        return df.withColumn(out, self.column())


Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _totals(rows: DataFrame, kernel: Kernel) -> np.ndarray:
    """The sum over all rows of ``kernel(x, y, w)``, which reduces a batch to a vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            data = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(batch.num_columns)])
            data = data[~np.isnan(data).any(axis=1)]
            if len(data):
                part = kernel(data[:, :-2], data[:, -2], data[:, -1])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    sums = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(sums))
    for r in sums:
        out[r["i"]] = r["v"]
    return out


def _upper(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return ((x * weight[:, None]).T @ x).ravel()


def _solved(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(gram, right, rcond=1e-11)[0]


class _Fit:
    """Training rows with a first column of ones, and the scales of the features."""

    def __init__(self, train: DataFrame, features: Sequence[str], target: Column, weight: Column | None):
        self.features = list(features)
        columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)]
        one = F.lit(1.0) if weight is None else weight.cast("double")
        self.rows = materialize(train.select(*columns, target.cast("double").alias("y"), one.alias("w")), "training")
        p = len(self.features)

        def moments(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
            return np.concatenate([[len(y)], x.sum(axis=0), (x * x).sum(axis=0)])

        sums = _totals(self.rows, moments)
        self.n = int(sums[0]) if len(sums) else 0
        mean = sums[1 : 1 + p] / self.n if self.n else np.zeros(p)
        spread = np.sqrt(np.maximum(sums[1 + p :] / self.n - mean**2, 0.0)) if self.n else np.zeros(p)
        flat = spread <= 1e-9 * np.maximum(np.abs(mean), 1.0)
        self.mean, self.scale = mean, np.where(flat, np.inf, spread)

    def totals(self, kernel: Kernel, ones: bool = True) -> np.ndarray:
        """``kernel`` over scaled features, with ones before them if asked for."""
        mean, scale = self.mean, self.scale

        def scaled(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
            z = (x - mean) / scale
            return kernel(np.column_stack([np.ones(len(z)), z]) if ones else z, y, w)

        return _totals(self.rows, scaled)

    def weighted(self, working: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], start: np.ndarray | None) -> np.ndarray:
        """The solution of X'AX b = X'u; ``working`` gives the diagonal A and u / w of rows from their targets and residuals."""
        k = len(self.features) + 1

        def kernel(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
            a, u = working(y, y - x @ start if start is not None else y)
            return np.concatenate([_upper(x, w * a), x.T @ (w * u)])

        sums = self.totals(kernel)
        return _solved(sums[: k * k].reshape(k, k), sums[k * k :]) if len(sums) else np.zeros(k)

    def linear(self, b: np.ndarray, link: str = "identity") -> Linear:
        slopes = b[1:] / self.scale
        return Linear(dict(zip(self.features, slopes.tolist())), float(b[0] - slopes @ self.mean), link)

    def iterated(self, working, steps: int, tolerance: float) -> Linear:
        """Least squares, then reweighted least squares until no coefficient moves by more than ``tolerance``."""
        b = self.weighted(lambda y, r: (np.ones(len(y)), y), None)
        for _ in range(steps):
            now = self.weighted(working, b)
            moved = float(np.max(np.abs(now - b), initial=0.0))
            b = now
            if moved <= tolerance:
                break
        return self.linear(b)


def least_squares(train: DataFrame, features: Sequence[str], target: str | Column, weight: Column | None = None) -> Linear:
    """Weighted least squares: one pass for the scales, one for the normal equations."""
    fit = _Fit(train, features, F.col(target) if isinstance(target, str) else target, weight)
    return fit.linear(fit.weighted(lambda y, r: (np.ones(len(y)), y), None))


def huber(
    train: DataFrame, features: Sequence[str], target: str | Column, weight: Column | None = None, delta: float = HUBER_DELTA, steps: int = 50, tolerance: float = 1e-10
) -> Linear:
    """Least Huber loss: quadratic up to a residual of ``delta``, linear beyond it.

    Reweighted least squares with weights min(1, delta / |residual|). The loss is convex and falls with every step.
    """

    def working(y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.minimum(1.0, delta / np.maximum(np.abs(r), 1e-300))
        return a, a * y

    return _Fit(train, features, F.col(target) if isinstance(target, str) else target, weight).iterated(working, steps, tolerance)


def quantile(
    train: DataFrame, features: Sequence[str], target: str | Column, alpha: float, weight: Column | None = None, smooth: float = 2e-4, steps: int = 8
) -> Linear:
    """Least pinball loss at ``alpha``.

    The loss is smoothed, alpha * r + h * log(1 + exp(-r / h)), first with the mean residual of least squares as ``h``. At each ``h`` a few
    steps follow the minimum; then ``h`` falls to a third, down to ``smooth`` of its start, so that many equal targets do no harm. A step
    is Newton's with as much of the curve of a quadratic that lies above the loss added as it takes for the loss not to rise.
    """
    fit = _Fit(train, features, F.col(target) if isinstance(target, str) else target, weight)
    k = len(fit.features) + 1
    b = fit.weighted(lambda y, r: (np.ones(len(y)), y), None)
    size = fit.totals(lambda x, y, w: np.array([np.abs(y - x @ b).sum()]))
    width = float(size[0]) / fit.n if fit.n else 0.0
    last = width * smooth

    def at(point: np.ndarray, h: float) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        def kernel(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
            r = y - x @ point
            below = 1.0 / (1.0 + np.exp(np.clip(r / h, -700, 700)))
            loss = w * (alpha * r + h * np.logaddexp(0.0, -r / h))
            size = np.maximum(np.abs(r), 1e-9 * h)
            above = np.tanh(size / (2.0 * h)) / (2.0 * size)
            return np.concatenate([[loss.sum()], x.T @ (w * (alpha - below)), _upper(x, w * below * (1.0 - below) / h), _upper(x, w * above)])

        sums = fit.totals(kernel)
        square = sums[1 + k :].reshape(2, k, k)
        return float(sums[0]), sums[1 : 1 + k], square[0], square[1]

    damping = 0.0
    while width > 0.0:
        now = at(b, width)
        for _ in range(steps):
            while True:
                move = _solved(now[2] + damping * now[3], now[1])
                found = at(b + move, width)
                if found[0] <= now[0] or damping >= 1.0:
                    break
                damping = max(4.0 * damping, 0.02)
            if found[0] > now[0]:
                break
            b, now = b + move, found
            damping = damping / 4 if damping > 0.01 else 0.0
            if float(np.max(np.abs(now[1]))) <= 1e-3 * np.sqrt(fit.n):
                break
        if width <= last:
            break
        width = max(width / 3, last)
    return fit.linear(b)


def pinball(actual: Column, predicted: Column, alpha: float) -> Column:
    r = actual - predicted
    return F.greatest(F.lit(alpha) * r, F.lit(alpha - 1.0) * r)


@dataclass(frozen=True)
class RobustMain:
    """Huber regression on the scaled log target; predictions are demand."""

    model: Linear
    scaler: DataFrame

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        rows = df.withColumn("_s", self.scaler.scalar())
        return rows.withColumn(out, floor_zero(log_minmax_inverse(self.model.column(), F.col("_s")))).drop("_s")


def fit_robust_main(train: DataFrame, features: Sequence[str], weight: str | None = "weight", delta: float = HUBER_DELTA, steps: int = 50) -> RobustMain:
    """Main regressor with the Huber loss on the log target scaled to [0, 1]."""
    scaler = target_scaler(train)
    rows = train.withColumn("_s", scaler.scalar())
    target = log_minmax(F.col("target_demand").cast("double"), F.col("_s"))
    return RobustMain(huber(rows, features, target, F.col(weight) if weight else None, delta, steps), scaler)


@dataclass(frozen=True)
class Ordinal:
    """Cumulative logits: P(bucket <= j) = 1 / (1 + exp(predictor - threshold[j])), thresholds ascending."""

    thresholds: tuple[float, ...]
    coefficients: Mapping[str, float]

    def probabilities(self) -> Column:
        """Array of the probabilities of all buckets: not negative, with sum 1."""
        eta = F.lit(0.0)
        for name, c in self.coefficients.items():
            eta = eta + F.lit(float(c)) * F.col(name).cast("double")
        below = [F.lit(1.0) / (F.lit(1.0) + F.exp(eta - F.lit(t))) for t in self.thresholds]
        return F.array(*[b - a for a, b in zip([F.lit(0.0), *below], [*below, F.lit(1.0)])])

    def predict(self, df: DataFrame, out: str = "probs") -> DataFrame:
        return df.withColumn(out, self.probabilities())


def bucket_of(value: Column, bounds: Sequence[float]) -> Column:
    """Number of the bucket of a value: 0 up to the first bound, 1 up to the second, and so on."""
    return sum((value > F.lit(float(b))).cast("int") for b in bounds)


def bucket_means(train: DataFrame, target: str, bounds: Sequence[float]) -> list[float]:
    """Mean target of each bucket; an empty one has the mean of its bounds."""
    sums = {r["b"]: r["m"] for r in train.groupBy(bucket_of(F.col(target), bounds).alias("b")).agg(F.avg(target).alias("m")).collect()}
    edges = [bounds[0], *bounds, bounds[-1]]
    return [float(sums.get(j, (edges[j] + edges[j + 1]) / 2)) for j in range(len(bounds) + 1)]


def ordinal(train: DataFrame, features: Sequence[str], bucket: str | Column, buckets: int, weight: Column | None = None, steps: int = 30, tolerance: float = 1e-9) -> Ordinal:
    """Greatest likelihood of the cumulative logits, by Newton steps that are halved until the likelihood does not fall.

    Starts at the shares of the buckets. A bucket without rows counts as a millionth of the rows, so that thresholds stay finite and in order.
    """
    fit = _Fit(train, features, F.col(bucket) if isinstance(bucket, str) else bucket, weight)
    j, p = buckets - 1, len(fit.features)
    found = fit.totals(lambda x, y, w: np.bincount(y.astype(np.int64), weights=w, minlength=buckets), ones=False)
    share = np.maximum(found, max(found.sum(), 1.0) * 1e-6) if len(found) else np.ones(buckets)
    cut = np.cumsum(share / share.sum())[:-1]
    at = np.concatenate([np.log(cut / (1 - cut)), np.zeros(p)])

    def parts(x: np.ndarray, y: np.ndarray, theta: np.ndarray, beta: np.ndarray):
        k = y.astype(np.int64)
        eta = x @ beta
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = (1 / (1 + np.exp(np.clip(eta - edge[k + s], -700, 700))) for s in (1, 0))
        return k, hi, lo, np.maximum(hi - lo, 1e-300)

    def likelihood(point: np.ndarray) -> float:
        theta, beta = point[:j], point[j:]
        if np.any(np.diff(theta) <= 0):
            return -np.inf
        sums = fit.totals(lambda x, y, w: np.array([(w * np.log(parts(x, y, theta, beta)[3])).sum()]), ones=False)
        return float(sums[0]) if len(sums) else 0.0

    def step(x: np.ndarray, y: np.ndarray, w: np.ndarray, theta: np.ndarray, beta: np.ndarray) -> np.ndarray:
        k, hi, lo, prob = parts(x, y, theta, beta)
        rows = np.arange(len(k))
        f_hi, f_lo = hi * (1 - hi), lo * (1 - lo)
        g_hi, g_lo = f_hi * (1 - 2 * hi), f_lo * (1 - 2 * lo)
        # Derivatives of the probability by its two edges; the predictor moves both edges down.
        up, down = np.zeros((len(k), j + 1)), np.zeros((len(k), j + 1))
        up[rows, np.minimum(k, j)], down[rows, np.maximum(k - 1, 0)] = 1.0, 1.0
        up, down = np.where((k < j)[:, None], up, 0.0)[:, :j], np.where((k > 0)[:, None], down, 0.0)[:, :j]
        a, b = np.hstack([up, -x]), np.hstack([down, -x])
        grad = (a * f_hi[:, None] - b * f_lo[:, None]) / prob[:, None]
        second = (a * (w * g_hi / prob)[:, None]).T @ a - (b * (w * g_lo / prob)[:, None]).T @ b
        hess = second - (grad * w[:, None]).T @ grad
        return np.concatenate([(w[:, None] * grad).sum(axis=0), hess.ravel()])

    size, now = j + p, likelihood(at)
    for _ in range(steps if fit.n else 0):
        theta, beta = at[:j], at[j:]
        sums = fit.totals(lambda x, y, w: step(x, y, w, theta, beta), ones=False)
        move = _solved(-sums[size:].reshape(size, size), sums[:size])
        rate = 1.0
        while (then := likelihood(at + rate * move)) < now - 1e-12 * abs(now) and rate > 1e-6:
            rate /= 2
        at, now = at + rate * move, max(now, then)
        if float(np.max(np.abs(rate * move))) <= tolerance:
            break
    slopes = at[j:] / fit.scale
    return Ordinal(tuple((at[:j] + slopes @ fit.mean).tolist()), dict(zip(fit.features, slopes.tolist())))
