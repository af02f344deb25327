"""Multilayer perceptron fitted on rows as they are stored; no table of dense blocks is kept."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import pin, unpin

# Bytes of dense rows up to which MLlib fits, which is faster as long as it can hold them.
HELD_BYTES = 1 << 30
# Gradients that the driver adds up by itself; more are added in tasks first.
DIRECT = 16
# Steps that the search keeps, and tries along a direction.
_MEMORY, _TRIES = 10, 10


class Perceptron(MultilayerPerceptronClassifier):
    """MLlib's estimator and model, with the loss and gradient of its blocks of ``blockSize`` rows.

    MLlib keeps all rows as dense blocks, 8 bytes a feature, whole partitions of which are held, sent
    and read back. Above ``HELD_BYTES`` of them every evaluation streams the written rows here; a task holds a batch of
    them and one block. Rows have a class from 0 and a vector of finite values. The steps are MLlib's; sums may differ
    in their last digits, which a long search makes larger as it does for MLlib itself.
    """

    def _fit(self, dataset: DataFrame):
        layers = self.getLayers()
        if self.getSolver() != "l-bfgs" or dataset.count() * layers[0] * 8 <= HELD_BYTES:
            return super()._fit(dataset)
        first = self.getInitialWeights().toArray() if self.isDefined(self.initialWeights) else self._plain().weights.toArray()
        rows = dataset if getattr(dataset, "_pinned_path", None) else pin(dataset.select(self.getLabelCol(), self.getFeaturesCol()))
        listed = rows.select(F.col(self.getLabelCol()).cast("double").alias("label"), F.col(self.getFeaturesCol()).alias("features"))
        parts = listed.rdd.getNumPartitions()
        weights = minimise(
            lambda w: _objective(listed, w, layers, self.getBlockSize(), parts), first, self.getMaxIter(), self.getTol()
        )
        if rows is not dataset:
            unpin(rows)
        return self._plain(weights)

    def _plain(self, weights: np.ndarray | None = None):
        """MLlib's model with given weights, or with those its seed draws."""
        row = [(0.0, Vectors.sparse(self.getLayers()[0], {}))]
        spark = SparkSession.getActiveSession()
        still = self.copy({self.maxIter: 0} | ({self.initialWeights: Vectors.dense(weights)} if weights is not None else {}))
        model = super(Perceptron, still)._fit(spark.createDataFrame(row, [self.getLabelCol(), self.getFeaturesCol()]))
        if not self.isDefined(self.initialWeights):
            model.clear(model.initialWeights)
        model._java_obj.setSummary(spark._jvm.scala.Option.empty())
        return self._copyValues(model)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, classes: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and classes of ``size`` rows at a time; the array of features is used again."""
    held, kinds, n = np.zeros((size, width)), np.zeros(size, np.int64), 0
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        if not (np.isin(label, np.arange(classes))).all():
            raise ValueError(f"labels are the classes 0 to {classes - 1}")
        vectors = batch.column("features")
        if vectors.null_count:
            raise ValueError("a vector is missing")
        sparse = vectors.field("type").to_numpy() == 0
        values, indices = vectors.field("values"), vectors.field("indices")
        ends, starts = values.offsets.to_numpy()[1:], values.offsets.to_numpy()[:-1]
        at = indices.offsets.to_numpy()[:-1]
        value, index = values.values.to_numpy(), indices.values.to_numpy()
        if not np.isfinite(value).all():
            raise ValueError("a vector has a value that is not finite")
        for i in range(len(label)):
            n_values = ends[i] - starts[i]
            own = value[starts[i] : ends[i]]
            if sparse[i]:
                held[n, index[at[i] : at[i] + n_values]] = own
            else:
                held[n] = own
            kinds[n] = label[i]
            n += 1
            if n == size:
                yield held, kinds
                held[:] = 0
                n = 0
    if n:
        yield held[:n], kinds[:n]


def _layers(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights (in, out) and offsets of each layer: views of the one vector that MLlib keeps."""
    out, at = [], 0
    for before, after in zip(layers, layers[1:]):
        out.append((weights[at : at + before * after].reshape(before, after), weights[at + before * after : at + (before + 1) * after]))
        at += (before + 1) * after
    return out


def _add_block(rows: np.ndarray, kinds: np.ndarray, weights: list, gradient: list) -> float:
    """The block's mean loss; its mean gradient is added."""
    made = [rows]
    with np.errstate(all="ignore"):
        for i, (w, b) in enumerate(weights):
            x = made[-1] @ w + b
            if i < len(weights) - 1:
                made.append(1.0 / (1.0 + np.exp(-x)))
            else:
                x = np.exp(x - x.max(axis=1, keepdims=True))
                made.append(x / x.sum(axis=1, keepdims=True))
        target = np.zeros_like(made[-1])
        target[np.arange(len(kinds)), kinds] = 1.0
        loss = -float((target * np.log(made[-1])).sum()) / len(kinds)
        delta = made[-1] - target
        for i in range(len(weights) - 1, -1, -1):
            gradient[i][0][...] += made[i].T @ delta / len(kinds)
            gradient[i][1][...] += delta.sum(axis=0) / len(kinds)
            if i:
                delta = (delta @ weights[i][0].T) * made[i] * (1.0 - made[i])
    return loss


_SUMS = "part int, blocks bigint, loss double, gradient binary"


def _sum_row(part: int, blocks: int, loss: float, gradient: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([part], pa.int32()), pa.array([blocks]), pa.array([loss]), pa.array([gradient.tobytes()])]
    return pa.RecordBatch.from_arrays(arrays, ["part", "blocks", "loss", "gradient"])


def _objective(df: DataFrame, weights: np.ndarray, layers: Sequence[int], size: int, parts: int) -> tuple[float, np.ndarray]:
    """Mean over all blocks of their loss and gradient; sums go by partition, so equal rows give equal digits."""
    width, classes, length = layers[0], layers[-1], len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, loss, blocks = np.zeros(length), 0.0, 0
        own, into = _layers(weights, layers), _layers(gradient, layers)
        for rows, kinds in _blocks(batches, width, classes, size):
            loss += _add_block(rows, kinds, own, into)
            blocks += 1
        if blocks:
            yield _sum_row(TaskContext.get().partitionId(), blocks, loss, gradient)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            yield _sum_row(*_added(rows, length))

    sums = df.mapInArrow(run, _SUMS)
    if parts > DIRECT:
        some = math.isqrt(parts)
        sums = sums.repartition(some, F.col("part") % some).mapInArrow(add, _SUMS)
    _, blocks, loss, gradient = _added([r.asDict() for r in sums.collect()], length)
    if not blocks:
        raise ValueError("there are no rows to fit on")
    return loss / blocks, gradient / blocks


def _added(rows: list[dict], length: int) -> tuple[int, int, float, np.ndarray]:
    rows = sorted(rows, key=lambda r: r["part"])
    gradient = np.zeros(length)
    for r in rows:
        gradient += np.frombuffer(r["gradient"])
    return min((r["part"] for r in rows), default=0), sum(r["blocks"] for r in rows), sum(r["loss"] for r in rows), gradient


# --- limited-memory BFGS, in the steps that MLlib's optimizer takes ------------------------


class _NoStep(Exception):
    pass


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """The place reached from ``x`` in at most ``rounds`` steps; ``f`` gives value and gradient."""
    value, gradient = f(x)
    start, n, past, values, failed = abs(value), 0, [], [math.inf], False
    while True:
        if n >= rounds or len(values) >= 2 and abs(value - max(values)) <= tolerance * start:
            return x
        if np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            return x
        try:
            along = _direction(past, gradient)
            step, new, new_value, new_gradient = _line_search(f, x, value, gradient, along, 1.0 if n else 1.0 / np.linalg.norm(along))
            if step * np.linalg.norm(gradient) < 1e-10:
                raise _NoStep("the step is too small")
        except _NoStep:
            if failed:
                return x
            past, failed = [], True
            continue
        past = [(new - x, new_gradient - gradient), *past][:_MEMORY]
        values = [*values, new_value][-20:]
        x, value, gradient, n, failed = new, new_value, new_gradient, n + 1, False


def _direction(past: list[tuple[np.ndarray, np.ndarray]], gradient: np.ndarray) -> np.ndarray:
    scale = 1.0
    if past:
        sy = past[0][0] @ past[0][1]
        if sy < 0 or math.isnan(sy):
            raise _NoStep("no curvature")
        scale = sy / (past[0][1] @ past[0][1])
    out, shares = gradient.copy(), []
    for step, change in past:
        rho = step @ change
        share = (step @ out) / rho
        if math.isnan(share):
            raise _NoStep("no curvature")
        shares.append((share, rho))
        out -= share * change
    out *= scale
    for (step, change), (share, rho) in reversed(list(zip(past, shares))):
        out += (share - (change @ out) / rho) * step
    return -out


def _line_search(f, x: np.ndarray, value: float, gradient: np.ndarray, along: np.ndarray, t: float):
    """A step by the strong Wolfe conditions: (step, place, value, gradient)."""
    slope = float(gradient @ along)
    if slope > 0:
        raise _NoStep("not a descent")

    def at(t: float):
        place = x + along * t
        v, g = f(place)
        return t, float(v), float(g @ along), place, g

    def found(c):
        return c[0], c[3], c[1], c[4]

    def zoom(low, high):
        for _ in range(_TRIES):
            c = at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return found(c)
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _NoStep("no step between")

    low = (0.0, value, slope, x, gradient)
    for i in range(_TRIES):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + 1e-4 * t * slope or c[1] >= low[1] and i > 0:
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return found(c)
        if c[2] >= 0:
            return zoom(c, low)
        low = c
        t *= 1.5
    raise _NoStep("no step found")


def _between(left, right) -> float:
    """Where the cubic through both ends is least, away from them."""
    (a, fa, da, *_), (b, fb, db, *_) = left, right
    with np.errstate(all="ignore"):
        d1 = np.float64(da + db - 3 * (fa - fb) / (a - b))
        d2 = np.sqrt(d1 * d1 - da * db)
        t = float(b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2))
    lowest, highest = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return lowest if t < lowest else highest if t > highest else t
