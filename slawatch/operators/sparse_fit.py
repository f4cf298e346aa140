"""Fits of MLlib's boosted trees and neural net over sparse rows.

MLlib trains both on dense copies of the rows, read again in every pass: of
1,300 features five to ten kilobytes a row, a hundred times. Here the rows'
entries other than zero are packed once, a block of rows in one record, and
every pass reads those. The methods are MLlib's: the same losses, bins, steps
and stopping rules, over all rows in each pass; and the fitted models are
MLlib's own, so they are stored, loaded and scored as before.

In a pass a task adds up its blocks, and its sums (at most features x bins x
nodes of a level, or features x hidden units) are shuffled by their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workers_import

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a block, and blocks that reach a worker at a time, at most.
BLOCK_ROWS, BATCH_BLOCKS = 10_000, 4
#: Numbers of the dense copy of some rows of a block, at most.
DENSE = 1 << 21


def _arrow_rows(spark, rows: int):
    """Sets how many rows reach a worker at a time; returns the setting."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(rows))
    return before


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the entries other than zero."""
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    values = vectors.field("values")
    length = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    x = values.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(length), dtype=np.int32), length)
    at = np.arange(len(x)) - np.repeat(np.cumsum(length) - length, length)
    at[np.repeat(sparse, length)] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    held = x != 0
    return row[held], at[held].astype(np.int32), x[held]


def _pack(rows: DataFrame, features: str, label: str) -> DataFrame:
    """The rows in blocks: ``y`` (labels), ``row``, ``at`` and ``x`` (entries)."""
    def run(batches):
        for b in batches:
            for first in range(0, len(b), BLOCK_ROWS):
                some = b.slice(first, BLOCK_ROWS)
                row, at, x = _entries(pa.concat_arrays([some.column(0)]))
                y = some.column(1).to_numpy().astype(np.int8)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (y, row, at, x)], names=["y", "row", "at", "x"])

    return rows.select(features, F.col(label).cast("double")).mapInArrow(run, "y binary, row binary, at binary, x binary")


def _sums(blocks: DataFrame, part: Callable[[Iterator[tuple]], tuple[np.ndarray, np.ndarray]], columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and summed rows: ``part`` gives both for the blocks of a task."""
    spark = blocks.sparkSession
    names = [f"c{i}" for i in range(columns)]

    def records(batches):
        for b in batches:
            yield from zip(*[(v.as_buffer() for v in c) for c in b.columns])

    def run(batches):
        number, rows = part(records(batches))
        for first in range(0, len(number), 1 << 16):
            some = slice(first, first + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(number[some].astype(np.int64)), *[pa.array(c) for c in np.ascontiguousarray(rows[some].T)]], names=["number", *names])

    before = _arrow_rows(spark, BATCH_BLOCKS)
    try:
        parts = blocks.mapInArrow(run, "number long, " + ", ".join(f"{n} double" for n in names))
        total = parts.groupBy("number").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    finally:
        spark.conf.set(BATCH_CONF, before)
    return total.column("number").to_numpy(), np.column_stack([total.column(n).to_numpy() for n in names])


def _packed(rows: DataFrame, features: str, label: str) -> DataFrame:
    spark = rows.sparkSession
    workers_import(spark)
    tasks = 2 * spark.sparkContext.defaultParallelism
    # Few tasks a pass, and of at most some 250,000 rows each.
    tasks = max(tasks, -(-rows.count() // 250_000))
    before = _arrow_rows(spark, BLOCK_ROWS)
    try:
        packed = _pack(rows, features, label).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        packed.count()
    finally:
        spark.conf.set(BATCH_CONF, before)
    return packed


# ------------------------------------------------------------ boosted trees


def value_counts(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Feature, value and rows of every value other than zero, in order, and
    the number of rows."""
    def run(batches):
        n, held = 0, []
        for b in batches:
            for y, _, at, x in zip(*[(v.as_buffer() for v in c) for c in b.columns]):
                n += len(y)
                held.append((np.frombuffer(at, np.int32), np.frombuffer(x, np.float64), None))
                if len(held) >= 8:
                    held = [_counted(held)]
        at, x, c = _counted(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(x, 0.0)), pa.array(np.append(c, n).astype(np.int64))], names=["at", "x", "n"])

    before = _arrow_rows(blocks.sparkSession, BATCH_BLOCKS)
    try:
        total = blocks.mapInArrow(run, "at int, x double, n long").groupBy("at", "x").agg(F.sum("n").alias("n")).toArrow().sort_by([("at", "ascending"), ("x", "ascending")])
    finally:
        blocks.sparkSession.conf.set(BATCH_CONF, before)
    at, x, c = (total.column(k).to_numpy() for k in ("at", "x", "n"))
    return at[at >= 0], x[at >= 0], c[at >= 0], int(c[at < 0].sum())


def _counted(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of feature and value, and how often each is there."""
    if not held:
        return np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64)
    at, x = (np.concatenate([h[i] for h in held]) for i in (0, 1))
    c = np.concatenate([np.ones(len(h[0]), np.int64) if h[2] is None else h[2] for h in held])
    order = np.lexsort((x, at))
    at, x, c = at[order], x[order], c[order]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (x[1:] != x[:-1]))[:len(at)])
    return at[first], x[first], np.add.reduceat(c, first) if len(first) else c


def thresholds(values: np.ndarray, counts: np.ndarray, splits: int) -> np.ndarray:
    """MLlib's candidate thresholds of a feature: between all of its values,
    or at most ``splits`` of equal stride."""
    between = (values[1:] + values[:-1]) / 2
    if len(between) <= splits:
        return between
    stride = target = counts.sum() / (splits + 1)
    upto, out = np.cumsum(counts), []
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


class _Bins:
    """Bins of all features that have a threshold, numbered in one row."""

    def __init__(self, at, x, counts, n: int, max_bins: int):
        edges = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)]).tolist() + [len(at)]
        self.features, self.cuts = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            v, c = x[a:b], counts[a:b]
            zeros, i = n - c.sum(), int(np.searchsorted(v, 0.0))
            if zeros:
                v, c = np.insert(v, i, 0.0), np.insert(c, i, zeros)
            cut = thresholds(v, c, min(max_bins, n) - 1)
            if len(cut):
                self.features.append(int(at[a]))
                self.cuts.append(cut)
        size = np.array([len(c) + 1 for c in self.cuts], dtype=np.int64)
        self.first = np.cumsum(size) - size
        self.size, self.n = size, int(size.sum())
        self.zero = self.first + np.array([np.searchsorted(c, 0.0) for c in self.cuts], dtype=np.int64)

    def pack(self, blocks: DataFrame) -> DataFrame:
        """Blocks of ``y`` and the rows of each bin, without the bins of zero:
        ``bin``, where its rows ``start``, and the ``row``s."""
        slot = np.full(max(self.features, default=0) + 1, -1, dtype=np.int64)
        slot[self.features] = np.arange(len(self.features))
        first, zero, cuts = self.first, self.zero, self.cuts

        def run(batches):
            for b in batches:
                for y, row, at, x in zip(*[(v.as_buffer() for v in c) for c in b.columns]):
                    row, at, x = np.frombuffer(row, np.int32), np.frombuffer(at, np.int32), np.frombuffer(x, np.float64)
                    some = at < len(slot)
                    some[some] = slot[at[some]] >= 0
                    row, of, x = row[some], slot[at[some]], x[some]
                    order = np.argsort(of, kind="stable")
                    row, of, x = row[order], of[order], x[order]
                    ends = np.searchsorted(of, np.arange(len(cuts) + 1))
                    bins = np.empty(len(of), dtype=np.int64)
                    for f in np.unique(of).tolist():
                        bins[ends[f]:ends[f + 1]] = first[f] + np.searchsorted(cuts[f], x[ends[f]:ends[f + 1]])
                    moved = bins != zero[of] if len(of) else np.zeros(0, bool)
                    row, bins = row[moved], bins[moved]
                    order = np.argsort(bins, kind="stable")
                    row, bins = row[order], bins[order]
                    name, start = np.unique(bins, return_index=True)
                    cols = (np.frombuffer(y, np.int8), name.astype(np.int32), np.append(start, len(row)).astype(np.int32), row.astype(np.uint16))
                    yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in cols], names=["y", "bin", "start", "row"])

        return blocks.mapInArrow(run, "y binary, bin binary, start binary, row binary")


class _Tree:
    """A tree that grows: nodes by number, the children of i are 2i and 2i+1."""

    def __init__(self, depth: int):
        n = 1 << depth + 1
        self.depth, self.inner = depth, np.zeros(n, dtype=bool)
        # Rows of the bins [low, high) go to the child that the others do not.
        self.low, self.high, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.feature, self.cut, self.gain = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        self.stats = np.zeros((n, 3))  # rows, sum, sum of squares

    def mean(self) -> np.ndarray:
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1.0)

    def place(self, rows: int, name, start, row, depth: int) -> np.ndarray:
        """The node of each row of a block, ``depth`` levels down."""
        node = np.ones(rows, dtype=np.int64)
        for level in range(depth):
            ids = np.flatnonzero(self.inner[1 << level:2 << level]) + (1 << level)
            if not len(ids):
                break
            new = np.where(self.inner[node], 2 * node + self.right[node], node)
            a, b = start[np.searchsorted(name, self.low[ids])], start[np.searchsorted(name, self.high[ids])]
            for i, x, y in zip(ids.tolist(), a.tolist(), b.tolist()):
                r = row[x:y]
                new[r[node[r] == i]] ^= 1
            node = new
        return node


def _grow(blocks: DataFrame, bins: _Bins, before: list[tuple[float, _Tree]], depth: int) -> _Tree:
    """The next tree, level after level."""
    tree, level = _Tree(depth), 0
    while level < depth:
        active = [1] if level == 0 else [i for i in range(1 << level, 2 << level) if tree.inner[i >> 1] and _splits(tree.stats[i])]
        if not active:
            break
        slot = np.full(len(tree.inner), -1, dtype=np.int64)
        slot[active] = np.arange(len(active))
        at, width, last = level, bins.n, level == depth - 1

        def part(records):
            # Rows, targets and their squares by node and bin, all bins last;
            # leaves' squares are needed, inner nodes are added up below.
            sums = np.zeros((3, len(active), width + 1))
            for y, name, start, row in records:
                sign = 2.0 * np.frombuffer(y, np.int8) - 1.0
                name, start, row = np.frombuffer(name, np.int32), np.frombuffer(start, np.int32), np.frombuffer(row, np.uint16)
                target = sign
                if before:
                    score = np.zeros(len(sign))
                    for weight, old in before:
                        score += weight * old.mean()[old.place(len(sign), name, start, row, old.depth)]
                    target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))
                where = slot[tree.place(len(sign), name, start, row, at)]
                of, held = where[row], np.repeat(np.arange(len(name)), np.diff(start))
                if at:
                    kept = of >= 0
                    of, held, row = of[kept], held[kept], row[kept]
                cell, cells = of * len(name) + held, len(active) * len(name)
                sums[0][:, name] += np.bincount(cell, minlength=cells).reshape(len(active), -1)
                sums[1][:, name] += np.bincount(cell, target[row], cells).reshape(len(active), -1)
                if last:
                    sums[2][:, name] += np.bincount(cell, (target * target)[row], cells).reshape(len(active), -1)
                inside = where >= 0
                w, t = where[inside], target[inside]
                sums[0][:, -1] += np.bincount(w, minlength=len(active))
                sums[1][:, -1] += np.bincount(w, t, len(active))
                sums[2][:, -1] += np.bincount(w, t * t, len(active))
            number = np.flatnonzero(sums[0])
            return number, sums.reshape(3, -1)[:, number].T

        number, rows = _sums(blocks, part, 3)
        every = np.zeros((3, len(active) * (bins.n + 1)))
        every[:, number] = rows.T
        every = every.reshape(3, len(active), bins.n + 1)
        for s, i in enumerate(active):
            tree.stats[i] = every[:, s, -1]
            if _splits(tree.stats[i]) and len(bins.first):
                _split(tree, i, bins, *every[:2, s, :-1], every[2, s, :-1] if last else None)
        level += 1
    return tree


def _variance(stats: np.ndarray) -> float:
    n, total, squares = stats
    return (squares - total * total / n) / n if n else 0.0


def _splits(stats: np.ndarray) -> bool:
    """If a node of these rows may be split: as MLlib has it, not if all have
    one target."""
    return stats[0] >= 2 and abs(_variance(stats)) > 2.2e-16


def _split(tree: _Tree, i: int, bins: _Bins, n: np.ndarray, s: np.ndarray, q: np.ndarray | None) -> None:
    """Splits node ``i`` at the threshold of the greatest gain, if that gains.
    ``n``, ``s`` and ``q`` are the rows, targets and squares of its bins."""
    rows, total, squares = tree.stats[i]

    def below(values: np.ndarray, every: float) -> np.ndarray:
        """Sums up to each bin of its feature."""
        full = values.copy()
        full[bins.zero] += every - np.add.reduceat(values, bins.first)
        upto = np.cumsum(full)
        return upto - np.repeat(upto[bins.first] - full[bins.first], bins.size)

    left_n, left_s = below(n, rows), below(s, total)
    right_n, right_s = rows - left_n, total - left_s
    ok = (left_n > 0.5) & (right_n > 0.5)
    ok[bins.first + bins.size - 1] = False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, (left_s ** 2 / left_n + right_s ** 2 / right_n - total ** 2 / rows) / rows, -1.0)
    best = int(np.argmax(gain))
    if gain[best] <= 1e-15 * max(1.0, _variance(tree.stats[i])):
        return
    f = int(np.searchsorted(bins.first, best, "right")) - 1
    first, end = int(bins.first[f]), int(bins.first[f] + bins.size[f])
    left = bins.zero[f] <= best  # where rows go that have zero here
    tree.inner[i], tree.gain[i], tree.feature[i], tree.cut[i] = True, gain[best], bins.features[f], bins.cuts[f][best - first]
    tree.low[i], tree.high[i], tree.right[i] = (best + 1, end, 0) if left else (first, best + 1, 1)
    # Above the last level the children's squares are counted with their own
    # bins; until then the parent's stand for them, or a single row's own.
    for child, (m, t) in ((2 * i, (left_n[best], left_s[best])), (2 * i + 1, (right_n[best], right_s[best]))):
        tree.stats[child] = m, t, t * t if round(m) == 1 else squares
    if q is not None:
        left_q = below(q, squares)[best]
        tree.stats[2 * i, 2], tree.stats[2 * i + 1, 2] = left_q, squares - left_q


def boosted(rows: DataFrame, features: str, label: str, iterations: int, depth: int, max_bins: int, step: float) -> list[tuple[float, _Tree]]:
    """Gradient boosting of logistic loss: the first tree fits the labels (as
    -1 and 1), each later one the loss's slopes."""
    packed = _packed(rows, features, label)
    try:
        bins = _Bins(*value_counts(packed), max_bins)
        before = _arrow_rows(rows.sparkSession, BATCH_BLOCKS)
        try:
            blocks = bins.pack(packed).persist(StorageLevel.MEMORY_AND_DISK)
            blocks.count()
        finally:
            rows.sparkSession.conf.set(BATCH_CONF, before)
    finally:
        packed.unpersist()
    trees: list[tuple[float, _Tree]] = []
    try:
        for i in range(iterations):
            trees.append((step if i else 1.0, _grow(blocks, bins, trees, depth)))
    finally:
        blocks.unpersist()
    return trees


class BoostedTrees(GBTClassifier):
    """MLlib's boosted trees (logistic loss, variance, all rows and features),
    grown over sparse rows."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        features, width = self.getFeaturesCol(), _width(dataset, self.getFeaturesCol())
        trees = boosted(dataset, features, self.getLabelCol(), self.getMaxIter(), self.getMaxDepth(), self.getMaxBins(), self.getStepSize())
        sc = dataset.sparkSession.sparkContext
        jvm, gateway = sc._jvm, sc._gateway
        ml = jvm.org.apache.spark.ml

        def array(kind, values):
            out = gateway.new_array(kind, len(values))
            for i, v in enumerate(values):
                out[i] = v
            return out

        def node(tree: _Tree, i: int):
            n, s, q = map(float, tree.stats[i])
            calc = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(array(jvm.double, [n, s, q]), int(n))
            mean, impurity = s / max(n, 1.0), float(max(_variance(tree.stats[i]), 0.0))
            if not tree.inner[i]:
                return ml.tree.LeafNode(mean, impurity, calc)
            cut = ml.tree.ContinuousSplit(int(tree.feature[i]), float(tree.cut[i]))
            return ml.tree.InternalNode(mean, impurity, float(tree.gain[i]), node(tree, 2 * i), node(tree, 2 * i + 1), cut, calc)

        grown = [ml.regression.DecisionTreeRegressionModel(f"dtr_{self.uid}_{i}", node(t, 1), width) for i, (_, t) in enumerate(trees)]
        java = ml.classification.GBTClassificationModel(
            self.uid, array(ml.regression.DecisionTreeRegressionModel, grown), array(jvm.double, [float(w) for w, _ in trees]), width, 2)
        return self._copyValues(GBTClassificationModel(java))


def _width(rows: DataFrame, features: str) -> int:
    attrs = rows.schema[features].metadata.get("ml_attr", {})
    return int(attrs["num_attrs"]) if "num_attrs" in attrs else int(rows.select(features).first()[0].size)


# --------------------------------------------------------------- neural net


def _loss(blocks: DataFrame, layers: tuple[int, int, int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean cross entropy and its slope: a hidden layer of sigmoids, softmax
    over the classes, weights laid out as MLlib has them."""
    wide, hidden, classes = layers
    w1, b1, w2, b2 = _parts(layers, weights)
    w1, columns = w1.astype(np.float32), max(hidden, classes, 2)

    def part(records):
        slope, slope2 = np.zeros((wide, hidden)), np.zeros((hidden, classes))
        bias, bias2, loss, n = np.zeros(hidden), np.zeros(classes), 0.0, 0
        for y, row, at, x in records:
            y, row, at, x = np.frombuffer(y, np.int8), np.frombuffer(row, np.int32), np.frombuffer(at, np.int32), np.frombuffer(x, np.float64)
            used = np.zeros(wide, dtype=bool)
            used[at] = True
            used = np.flatnonzero(used)
            to = np.zeros(wide, dtype=np.int32)
            to[used] = np.arange(len(used))
            at, mine = to[at], w1[used]
            step = max(1, DENSE // max(1, len(used)))
            edges = np.searchsorted(row, np.arange(0, len(y) + step, step))
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                label = y[i * step:(i + 1) * step]
                if not len(label):
                    break
                dense = np.zeros((len(label), len(used)), dtype=np.float32)
                dense[row[a:b] - i * step, at[a:b]] = x[a:b]
                h = 1.0 / (1.0 + np.exp(-(dense @ mine + b1)))
                out = h @ w2 + b2
                out -= out.max(axis=1, keepdims=True)
                e = np.exp(out)
                total = e.sum(axis=1)
                rows = np.arange(len(label))
                loss += float((np.log(total) - out[rows, label]).sum())
                delta = e / total[:, None]
                delta[rows, label] -= 1.0
                slope2 += h.T @ delta
                bias2 += delta.sum(axis=0)
                back = (delta @ w2.T) * h * (1.0 - h)
                slope[used] += dense.T @ back.astype(np.float32)
                bias += back.sum(axis=0)
                n += len(label)
        held = np.flatnonzero(slope.any(axis=1))
        table = np.zeros((len(held) + hidden + 3, columns))
        table[:len(held), :hidden] = slope[held]
        table[len(held):len(held) + hidden, :classes] = slope2
        table[-3, :hidden], table[-2, :classes], table[-1, :2] = bias, bias2, (loss, n)
        return np.concatenate([held, wide + np.arange(hidden + 3)]), table

    number, rows = _sums(blocks, part, columns)
    every = np.zeros((wide + hidden + 3, columns))
    every[number] = rows
    loss, n = every[-1, :2]
    slope = np.concatenate([every[:wide, :hidden].ravel(), every[-3, :hidden], every[wide:wide + hidden, :classes].ravel(), every[-2, :classes]])
    return loss / n, slope / n


def _parts(layers: tuple[int, int, int], weights: np.ndarray):
    wide, hidden, classes = layers
    ends = np.cumsum([wide * hidden, hidden, hidden * classes])
    a, b, c, d = np.split(weights, ends)
    return a.reshape(wide, hidden), b, c.reshape(hidden, classes), d


def lbfgs(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, iterations: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """Minimum by L-BFGS with a strong Wolfe line search, and Breeze's rules
    for when to stop: loss or slope hardly move."""
    f, g = loss(x)
    start, seen, pairs = abs(f), [f], []
    for _ in range(iterations):
        if np.linalg.norm(g) <= max(tolerance * abs(f), 1e-8):
            break
        d, a = -g, []
        for s, t in reversed(pairs):
            a.append((s @ d) / (s @ t))
            d = d - a[-1] * t
        if pairs:
            s, t = pairs[-1]
            d = d * (s @ t) / (t @ t)
        for (s, t), c in zip(pairs, reversed(a)):
            d = d + s * (c - (t @ d) / (s @ t))
        if d @ g >= 0:
            d, pairs = -g, []
        new = _wolfe(loss, x, f, g, d, 1.0 if pairs else 1.0 / np.linalg.norm(g))
        if new is None:
            break
        x_new, f, g_new = new
        s, t = x_new - x, g_new - g
        if s @ t > 1e-12 * np.linalg.norm(s) * np.linalg.norm(t):
            pairs = [*pairs, (s, t)][-memory:]
        x, g = x_new, g_new
        if abs(max(seen) - f) <= tolerance * start:
            break
        seen = [*seen, f][-memory:]
    return x


def _wolfe(loss, x, f, g, d, step: float, tries: int = 20):
    """A step along ``d`` that lowers the loss enough and flattens the slope."""
    slope, low, high, best = g @ d, 0.0, np.inf, None
    for _ in range(tries):
        at = x + step * d
        fa, ga = loss(at)
        if not np.isfinite(fa) or fa > f + 1e-4 * step * slope:
            high = step
        else:
            if best is None or fa < best[1]:
                best = (at, fa, ga)
            if ga @ d < 0.9 * slope:
                low = step
            elif ga @ d > -0.9 * slope:
                high = step
            else:
                return at, fa, ga
        step = (low + high) / 2 if high < np.inf else 2 * low
    return best


class NeuralNet(MultilayerPerceptronClassifier):
    """MLlib's net of one hidden layer, fitted over sparse rows from MLlib's
    seeded start."""

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        spark, layers = dataset.sparkSession, tuple(self.getLayers())
        one = spark.createDataFrame([(Vectors.sparse(layers[0], [], []), float(c)) for c in range(layers[-1])], ["f", "l"])
        start = MultilayerPerceptronClassifier(layers=list(layers), maxIter=0, seed=self.getSeed(), featuresCol="f", labelCol="l").fit(one)
        packed = _packed(dataset, self.getFeaturesCol(), self.getLabelCol())
        try:
            weights = lbfgs(lambda w: _loss(packed, layers, w), start.weights.toArray().copy(), self.getMaxIter(), self.getTol())
        finally:
            packed.unpersist()
        sc = spark.sparkContext
        java = sc._jvm.org.apache.spark.ml.classification.MultilayerPerceptronClassificationModel(self.uid, _py2java(sc, Vectors.dense(weights)))
        return self._copyValues(MultilayerPerceptronClassificationModel(java))
