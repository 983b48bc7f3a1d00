"""Boosted trees grown leaf by leaf, with L1 and L2 penalties, missing values by a learnt direction, and features drawn per tree.

Rows are cut into bins once and written: a byte per feature.  A pass sums gradients, weights and rows per open leaf, feature and bin,
in partitions first; the best split of a leaf by a feature is found in a task, and the driver gets one row per leaf and feature.  Growth is strictly best first: the leaf with the largest gain is split next.  A pass looks
at the children of all leaves that may still be split, so that a tree takes as many passes as it is deep, not one per leaf.

The rows' predictions are written every ``write_every`` trees; in between, tasks apply the newest trees to the bins they read.
Gradients and weights are summed as whole numbers (multiples of a fixed unit), so the same rows give the same trees however they are
partitioned, and after a lost executor too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.operators.ml import FOLD, FOLDS, Features
from trackmill.operators.target_means import CrossFittedMeans, CrossFittedMeansModel, fold_of
from trackmill.session import drop_stage, fresh_path, shared_dir


@dataclass(frozen=True)
class LeafBoosting:
    """Parameters of the trees.  Fixed values: the defaults are the published settings, but for ``bins`` and ``write_every``.

    ``bins`` (255 at most) counts the bins of known values; missing ones have a bin of their own.
    """

    iterations: int = 680
    step: float = 0.0511
    leaves: int = 499
    depth: int = 45
    min_rows: int = 36
    min_gain: float = 0.8109
    l1: float = 0.1020
    l2: float = 2.59
    feature_fraction: float = 0.5022
    bins: int = 255
    write_every: int = 10
    seed: int = 42


@dataclass
class Tree:
    """Nodes as columns; node 0 is the root, a leaf has feature -1.  A value up to the bin, or its upper bound, goes left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, missing_left: bool, gain: float) -> tuple[int, int]:
        left = len(self.feature)
        for column, empty in ((self.feature, -1), (self.bin, 0), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
            column += [empty, empty]
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, at, missing_left, gain
        self.left[node], self.right[node] = left, left + 1
        return left, left + 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row of a matrix of bins."""
        feature, at, missing = np.array(self.feature), np.array(self.bin), np.array(self.missing_left)
        left, right = np.array(self.left), np.array(self.right)
        here = np.zeros(len(bins), dtype=np.int64)
        moving = np.flatnonzero(feature[here] >= 0)
        while len(moving):
            node = here[moving]
            value = bins[moving, feature[node]]
            goes_left = np.where(value == 0, missing[node], value <= at[node])
            here[moving] = np.where(goes_left, left[node], right[node])
            moving = moving[feature[here[moving]] >= 0]
        return here

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool


def leaf_value(g: float, h: float, p: LeafBoosting) -> float:
    """Best constant of a leaf under the penalties, times the step."""
    return -math.copysign(max(abs(g) - p.l1, 0.0), g) / (h + p.l2) * p.step if h + p.l2 > 0 else 0.0


def best_split(sums: np.ndarray, p: LeafBoosting) -> tuple[float, int, bool] | None:
    """Gain, bin and missing direction of a leaf's best split by one feature, from its histogram (bins, [gradient, weight, rows]); ties go to the first."""

    def worth(g, h):
        return np.where(h + p.l2 > 0, np.maximum(np.abs(g) - p.l1, 0.0) ** 2 / np.maximum(h + p.l2, 1e-300), 0.0)

    total, missing, below = sums.sum(axis=0), sums[0], np.cumsum(sums[1:], axis=0)[:-1]
    best = None
    # Without missing values both directions are one split.
    for missing_left in (False, True) if missing[2] else (False,):
        left = below + missing if missing_left else below
        right = total - left
        gain = worth(left[:, 0], left[:, 1]) + worth(right[:, 0], right[:, 1]) - worth(total[0], total[1])
        gain = np.where((left[:, 2] >= max(1, p.min_rows)) & (right[:, 2] >= max(1, p.min_rows)), gain, -np.inf)
        if len(gain):
            at = int(np.argmax(gain))
            if gain[at] > max(p.min_gain, 1e-12) and (best is None or gain[at] > best[0]):
                # Where a leaf has no missing values, later ones go with the larger side.
                best = float(gain[at]), at + 1, missing_left if missing[2] else bool(left[at, 2] >= right[at, 2])
    return best


def matrix(packed: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), width)


def binned(frame: pd.DataFrame, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of raw columns: 0 is missing, bin b holds values above cut b - 2 and up to cut b - 1."""
    out = np.zeros((len(frame), len(cuts)), dtype=np.uint8)
    for k, edges in enumerate(cuts):
        values = frame.iloc[:, k].to_numpy(dtype=np.float64)
        out[:, k] = np.where(np.isnan(values), 0, np.searchsorted(np.asarray(edges), values, side="left") + 1)
    return out


def cut_points(df: DataFrame, names: Sequence[str], bins: int, given: Mapping[str, Sequence[float]]) -> list[list[float]]:
    """Upper bounds of the bins, but the last: those that are given, else quantiles of the known values, in one pass."""
    free = [n for n in names if n not in given]
    found: list[list[float]] = []
    if free:
        casts = df.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in free])
        found = casts.approxQuantile(free, [k / bins for k in range(1, bins)], 0.25 / bins)
    quantiles = dict(zip(free, found))
    return [sorted({float(x) for x in (given[n] if n in given else quantiles[n] or ())})[:bins - 1] for n in names]


class _Rows:
    """The binned rows in the shared folder, with the predictions of all trees but the newest."""

    def __init__(self, spark: SparkSession, width: int):
        self.spark, self.width, self.path, self.newest = spark, width, "", []

    def write(self, df: DataFrame) -> None:
        before, self.path = self.path, fresh_path(self.spark, "boosted-rows")
        df.write.parquet(self.path)
        self.table, self.newest = self.spark.read.schema(df.schema).parquet(self.path), []
        if before:
            drop_stage(self.spark, before)

    def advance(self) -> None:
        """Write the rows with the predictions of the newest trees."""
        newest, width = list(self.newest), self.width

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                bins = matrix(batch["bins"], width)
                yield batch.assign(pred=sum((t.values(bins) for t in newest), batch["pred"].to_numpy()))

        self.write(self.table.mapInPandas(add, self.table.schema))

    def splits(self, tree: Tree, wanted: Sequence[int], p: LeafBoosting, allowed: Sequence[int], g_unit: float, h_unit: float) -> dict[int, tuple[float, float, Split | None]]:
        """Sum of gradients, of weights, and best split of each wanted leaf of ``tree``; the split of a leaf by one feature is found in a task."""
        newest, width, order, bins = list(self.newest), self.width, sorted(wanted), p.bins + 1
        used, n_used = np.asarray(allowed), len(allowed)

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            slot = np.full(len(tree.feature), -1)
            slot[order] = np.arange(len(order))
            size = len(order) * n_used * bins
            total = np.zeros((3, size), dtype=np.int64)
            for batch in batches:
                cells = matrix(batch["bins"], width)
                at = slot[tree.nodes(cells)]
                rows = np.flatnonzero(at >= 0)
                if not len(rows):
                    continue
                pred = sum((t.values(cells) for t in newest), batch["pred"].to_numpy())
                weight = batch["w"].to_numpy()
                g = np.rint((pred - batch["y"].to_numpy()) * weight / g_unit)[rows]
                h = np.rint(weight / h_unit)[rows]
                flat = ((at[rows, None] * n_used + np.arange(n_used)) * bins + cells[rows][:, used]).ravel()
                for k, x in enumerate((g, h, None)):
                    total[k] += np.bincount(flat, None if x is None else np.repeat(x, n_used), size).astype(np.int64)
            cell = np.flatnonzero(total[2])
            yield pd.DataFrame({"leaf": cell // (n_used * bins), "f": cell // bins % n_used, "b": cell % bins, "g": total[0][cell], "h": total[1][cell], "n": total[2][cell]})

        def best(part: pd.DataFrame) -> pd.DataFrame:
            cells = np.zeros((bins, 3))
            cells[part["b"]] = np.column_stack([part["g"] * g_unit, part["h"] * h_unit, part["n"]])
            # Whole numbers are summed before they are scaled: the same sums for every feature.
            whole = [int(part["g"].sum()) * g_unit, int(part["h"].sum()) * h_unit]
            got = best_split(cells, p)
            return pd.DataFrame([(part["leaf"].iloc[0], part["f"].iloc[0], *whole, *(got or (None, None, None)))], columns=["leaf", "f", "g", "h", "gain", "bin", "missing_left"])

        parts = self.table.select("bins", "y", "w", "pred").mapInPandas(sums, "leaf bigint, f bigint, b bigint, g bigint, h bigint, n bigint")
        # One exchange for both steps; partitions have summed their rows already.
        each = parts.repartition("leaf", "f").groupBy("leaf", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
        found = each.groupBy("leaf", "f").applyInPandas(best, "leaf bigint, f bigint, g double, h double, gain double, bin int, missing_left boolean")
        out: dict[int, tuple[float, float, Split | None]] = {}
        for r in sorted(found.collect(), key=lambda r: (r.leaf, r.f)):
            node = order[r.leaf]
            old = out.get(node, (r.g, r.h, None))[2]
            if r.gain is not None and (old is None or r.gain > old.gain):
                old = Split(r.gain, int(used[r.f]), r.bin, r.missing_left)
            out[node] = (r.g, r.h, old)
        return out


def grow(rows: _Rows, p: LeafBoosting, allowed: Sequence[int], units: tuple[float, float]) -> Tree:
    """One tree, best leaf first.

    Splits are tried out in a sketch of the tree: a pass splits every leaf of the sketch that the tree may still come to, best gains first.
    The tree itself takes splits from the sketch in the order of their gain, as long as the next best leaf is one whose children are known.
    """
    sketch = Tree()
    depth, known = {0: 0}, {}

    def look(nodes: Sequence[int]) -> None:
        for node, (g, h, split) in rows.splits(sketch, nodes, p, allowed, *units).items():
            known[node] = (g, h, split if depth[node] < p.depth else None)

    look([0])
    opened, taken = {0}, []  # leaves of the tree, and its splits
    while len(taken) < p.leaves - 1:
        ready = [n for n in opened if known[n][2] is not None]
        if not ready:
            break
        best = min(ready, key=lambda n: (-known[n][2].gain, n))
        if sketch.left[best] < 0:
            # Any end of the sketch may be split before the tree is full; of them, no more than the tree has room for.
            ends = [n for n, (_, _, split) in known.items() if sketch.left[n] < 0 and split is not None and n != best]
            fresh = []
            for node in [best, *sorted(ends, key=lambda n: (-known[n][2].gain, n))[:p.leaves - 2 - len(taken)]]:
                s = known[node][2]
                for child in sketch.split(node, s.feature, s.bin, s.missing_left, s.gain):
                    depth[child] = depth[node] + 1
                    fresh.append(child)
            look(fresh)
        opened.remove(best)
        opened |= {sketch.left[best], sketch.right[best]}
        taken.append(best)
    out, place = Tree(), {0: 0}
    for node in taken:  # a node is taken after its parent
        s = known[node][2]
        place[sketch.left[node]], place[sketch.right[node]] = out.split(place[node], s.feature, s.bin, s.missing_left, s.gain)
    for node in opened:
        out.value[place[node]] = leaf_value(*known[node][:2], p)
    return out


TREE_SCHEMA = ("tree int, node int, feature int, threshold_bin int, missing_left boolean, left_node int, right_node int, value double, gain double")


class LeafwiseModel(Model):
    """Fitted trees; ``transform`` adds ``tow_pred``.  As large as its trees: ``iterations`` x ``leaves`` nodes, whatever the rows."""

    def __init__(self, names: Sequence[str], cuts: list[list[float]], base: float, trees: list[Tree], encoder: CrossFittedMeansModel | None = None):
        super().__init__()
        self.names, self.cuts, self.base, self.trees, self.encoder = list(names), cuts, base, trees, encoder

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, base, trees = self.cuts, self.base, self.trees
        known = dataset if self.encoder is None else self.encoder.transform(dataset)

        @F.pandas_udf("double")
        def predicted(frame: pd.DataFrame) -> pd.Series:
            bins = binned(frame, cuts)
            return pd.Series(sum((t.values(bins) for t in trees), np.full(len(frame), base)))

        inputs = F.struct(*[F.col(f"`{n}`").cast("double").alias(f"c{k}") for k, n in enumerate(self.names)])
        return known.select(*dataset.columns, predicted(inputs).alias("tow_pred"))

    def importance(self, spark: SparkSession) -> DataFrame:
        """``(feature, importance, splits)``: share of the gain of all splits, and their number, best first."""
        gain, count = np.zeros(len(self.names)), np.zeros(len(self.names), dtype=int)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    gain[f], count[f] = gain[f] + g, count[f] + 1
        whole = gain.sum() or 1.0
        rows = [(n, float(g / whole), int(c)) for n, g, c in zip(self.names, gain, count)]
        return spark.createDataFrame(rows, "feature string, importance double, splits int").orderBy(F.desc("importance"), "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        nodes = [(k, n, t.feature[n], t.bin[n], t.missing_left[n], t.left[n], t.right[n], t.value[n], t.gain[n]) for k, t in enumerate(self.trees) for n in range(len(t.feature))]
        spark.createDataFrame(nodes, TREE_SCHEMA).coalesce(1).write.parquet(f"{path}/trees")
        about = [(k, n, c, self.base, self.encoder is not None) for k, (n, c) in enumerate(zip(self.names, self.cuts))]
        spark.createDataFrame(about, "place int, feature string, cuts array<double>, base double, encoded boolean").coalesce(1).write.parquet(f"{path}/features")
        if self.encoder is not None:
            self.encoder.write().save(f"{path}/encoder")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LeafwiseModel:
        about = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        trees: dict[int, Tree] = {}
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():
            t = trees.setdefault(r.tree, Tree([], [], [], [], [], [], []))
            for column, x in zip((t.feature, t.bin, t.missing_left, t.left, t.right, t.value, t.gain), tuple(r)[2:]):
                column.append(x)
        encoder = CrossFittedMeansModel.load(f"{path}/encoder") if about[0].encoded else None
        return LeafwiseModel([r.feature for r in about], [list(r.cuts) for r in about], about[0].base, [trees[k] for k in sorted(trees)], encoder)


def fit(df: DataFrame, features: Features, params: LeafBoosting = LeafBoosting(), cuts: Mapping[str, Sequence[float]] | None = None) -> LeafwiseModel:
    """Fit on the rows of ``df`` with a label and a weight above zero.

    Numeric columns are read as they are: a missing value has no substitute, but a direction in every split.  ``categorical`` and ``wide``
    columns are both encoded by exact means, out of fold.  ``cuts`` states bounds of bins for columns that need other ones than quantiles.
    Without usable rows the model predicts 0.
    """
    spark = df.sparkSession
    shared_dir(spark)
    if not 2 <= params.bins <= 255:
        raise ValueError("bins must lie between 2 and 255")
    label = F.col(f"`{features.label}`").cast("double")
    weight = F.col(f"`{features.weight}`").cast("double") if features.weight else F.lit(1.0)
    known = df.filter(label.isNotNull() & ~F.isnan(label) & (weight > 0))
    coded = [*features.categorical, *features.wide]
    encoder = None
    if coded:
        known = known.withColumn(FOLD, fold_of(F.col(features.key), FOLDS, params.seed))
        encoder = CrossFittedMeans(inputCols=coded, outputCols=[f"{c}_level" for c in coded], labelCol=features.label, foldCol=FOLD, folds=FOLDS).fit(known)
        known = encoder.transform(known)
    names = [*features.numeric, *(f"{c}_level" for c in coded)]
    about = known.agg(F.count(F.lit(1)).alias("n"), (F.sum(label * weight) / F.sum(weight)).alias("mean"), F.min(label).alias("low"),
                      F.max(label).alias("high"), F.max(weight).alias("heaviest")).first()
    if not about["n"] or not names:
        return LeafwiseModel(names, [[] for _ in names], about["mean"] or 0.0, [], encoder)
    edges = cut_points(known, names, params.bins, cuts or {})
    # The mean is rounded, so that the order of its sum does not matter.
    base = float(f"{about['mean']:.9g}")
    inputs = [F.col(f"`{n}`").cast("double").alias(f"c{k}") for k, n in enumerate(names)]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = binned(batch.iloc[:, 2:], edges)
            yield pd.DataFrame({"bins": [r.tobytes() for r in cells], "y": batch["y"], "w": batch["w"], "pred": base})

    rows = _Rows(spark, len(names))
    rows.write(known.select(label.alias("y"), weight.alias("w"), *inputs).mapInPandas(pack, "bins binary, y double, w double, pred double"))
    # Sums of whole numbers below 2^62 for all rows, and below 2^53 for the rows of one batch.
    bits = min(38, 60 - about["n"].bit_length())
    g_unit = max(about["high"] - about["low"], 1e-9) * about["heaviest"] * 2.0 ** -bits
    h_unit = about["heaviest"] * 2.0 ** -bits
    rng = np.random.default_rng(params.seed)
    trees: list[Tree] = []
    each = max(1, round(params.feature_fraction * len(names)))
    for k in range(params.iterations):
        allowed = sorted(rng.choice(len(names), each, replace=False).tolist())
        tree = grow(rows, params, allowed, (g_unit, h_unit))
        trees.append(tree)
        rows.newest.append(tree)
        if len(rows.newest) >= params.write_every and k + 1 < params.iterations:
            rows.advance()
    drop_stage(spark, rows.path)
    return LeafwiseModel(names, edges, base, trees, encoder)
