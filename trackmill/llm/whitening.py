"""Whitened vectors by incremental eigendecomposition.

Each part of the input holds the spectrum of its scatter matrix (count, mean, eigenvalues, eigenvectors) and takes its vectors one by one: a
vector's distance from the mean is a rank-one update, whose eigenvalues are the roots of a secular equation.  Components of the update that
are nothing, and equal eigenvalues, are deflated first; the weights are then found anew from the roots, which keeps the new
vectors orthogonal.  Two spectra are combined by updating one with every scaled eigenvector of the other and with the distance of their
means, in a tree over the parts.  What comes out is a basis only; the results rest on a Rayleigh-Ritz step over all rows: the
covariance within that basis is summed over the parts, its eigenvectors turn the basis, and the step is done twice.

Entries are integers (``x = floor(64 c) + 1000000``), so the mean is an exact quotient, ``n x - S`` is an exact integer, and only
its division by n is rounded before anything is multiplied.

Scale: a part hands on one spectrum, (d + 2) x d numbers; a combining task gets ``FAN`` of them, so neither the driver nor a task ever holds
more.  Rows are dealt out as they are read, never by key.  Matrices are added up by position, d x d numbers for the driver.

Defined cases: rows with a null vector, a null, infinite or not-a-number entry, or one of 2 ** 40 or more are dropped, and so are those whose length is
not the most frequent one (the greater of equally frequent ones); null and repeated ids stay as they are; a component without variance
has the whitened value null and no part in ``identity_error``; where nothing varies ``explained`` is null; a deviation beyond a
long is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.session import materialise

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Spectra that one task combines.
FAN = 8
ROUNDS = 2
_EPS = np.finfo(float).eps
#: An eigenvalue below this share of the largest counts as none.
NOTHING = 1e-12
SPECTRUM = "part long, n long, mean binary, values binary, vectors binary"


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(weights / (poles - root))`` for ascending poles and positive weights, one above each pole.

    Returned as the index of the pole next to each root and the distance from it, which keeps the digits of close roots.
    Steps come from the rational function with both neighbouring poles, kept inside a shrinking bracket.
    """
    k = len(poles)
    ends = np.append(poles[1:], poles[-1] + weights.sum())
    at = np.arange(k)
    below = np.tri(k, dtype=bool)
    half = (ends - poles) / 2
    middle = 1 + (weights / ((poles - poles[:, None]) - half[:, None])).sum(1)
    upper = (middle < 0) & (at < k - 1)  # the root is nearer to the next pole
    origin = np.where(upper, np.minimum(at + 1, k - 1), at)
    far = middle < 0
    start = poles - poles[origin]
    end = ends - poles[origin]
    low, high = np.where(far, start + half, start), np.where(far, end, start + half)
    distance = poles - poles[origin][:, None]
    x = (low + high) / 2
    for _ in range(100):
        gap = distance - x[:, None]
        terms = weights / gap
        f = 1 + terms.sum(1)
        size = 1 + np.abs(terms).sum(1)
        open_ = (np.abs(f) > 4 * _EPS * k * size) & (high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if not open_.any():
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        slopes = terms / gap
        left = np.where(below, slopes, 0).sum(1)
        right = slopes.sum(1) - left
        a_gap, b_gap = start - x, end - x
        a = (a_gap + b_gap) * f - a_gap * b_gap * (left + right)
        b = a_gap * b_gap * f
        c = f - a_gap * left - b_gap * right
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(open_, np.where(inside, new, (low + high) / 2), x)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, update: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors (columns) of ``vectors diag(values) vectors' + rho update update'``, rho > 0."""
    w = np.sqrt(rho) * (vectors.T @ update)
    values, vectors = values.copy(), vectors.copy()
    scale = max(np.abs(values).max(initial=0), w @ w)
    if scale == 0:
        return values, vectors
    small = 8 * _EPS * scale
    # Deflation: of two equal eigenvalues, turn their plane so that the update touches one of them only.
    for i in range(len(values) - 1):
        r = np.hypot(w[i], w[i + 1])
        if r > 0 and values[i + 1] - values[i] <= small:
            c, s = w[i + 1] / r, w[i] / r
            vectors[:, [i, i + 1]] = np.column_stack((c * vectors[:, i] - s * vectors[:, i + 1], s * vectors[:, i] + c * vectors[:, i + 1]))
            w[i], w[i + 1] = 0.0, r
    live = np.flatnonzero(np.abs(w) * np.sqrt(scale) > small)
    if len(live) == 0:
        return values, vectors
    poles, z = values[live], w[live]
    origin, x = secular_roots(poles, z * z)
    roots = poles[origin] + x
    # gap[i, j]: pole j less root i, from the pole that root i was measured from.
    gap = (poles - poles[origin][:, None]) - x[:, None]
    # Weights for which these roots are exact.
    apart = poles[:, None] - poles
    np.fill_diagonal(apart, 1.0)
    z = np.copysign(np.sqrt(np.abs(np.prod(gap / -np.where(np.eye(len(poles), dtype=bool), 1.0, apart), axis=0))), z)
    turn = z / gap
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    values[live], vectors[:, live] = roots, vectors[:, live] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean, and the eigenvalues and vectors of the scatter (sum of squares about the mean) of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        away, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * other.n / n)
        self.mean, self.n = self.mean + away * (other.n / n), n

    def row(self, part: int) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "n": [self.n], "mean": [self.mean.tobytes()], "values": [self.values.tobytes()],
                             "vectors": [np.ascontiguousarray(self.vectors).tobytes()]})

    @classmethod
    def of(cls, row) -> Spectrum:
        mean, values = np.frombuffer(row.mean), np.frombuffer(row.values)
        return cls(int(row.n), mean, values, np.frombuffer(row.vectors).reshape(len(mean), len(mean)))


def entries(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Written table of the id as ``_llm_id`` and the integers ``_llm_x`` of each row that stays."""
    c = F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double"))
    fine = F.forall("_llm_c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(1 << 40)))
    rows = df.select(F.col(f"`{id_col}`").alias("_llm_id"), c.alias("_llm_c")).where(F.col("_llm_c").isNotNull() & (F.size("_llm_c") > 0))
    x = F.transform("_llm_c", lambda v: F.floor(v * SCALE) + F.lit(SHIFT).cast("bigint"))
    rows = materialise(rows.where(F.coalesce(fine, F.lit(False))).select("_llm_id", x.alias("_llm_x")), "entries")
    most = rows.groupBy(F.size("_llm_x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("_llm_x") == (most["size"] if most else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64, copy=False)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for batch in batches:
            if len(batch):
                part = [int(s) for s in _matrix(batch["_llm_x"]).sum(axis=0)]
                n, total = n + len(batch), part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pd.DataFrame({"dimension": range(-1, len(total)), "total": [str(t) for t in (n, *total)]})

    found = (rows.select("_llm_x").mapInPandas(add, "dimension int, total string")
             .groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dimension").collect())
    return (int(found[0]["total"]), [int(r["total"]) for r in found[1:]]) if found else (0, [])


def spectrum(rows: DataFrame, size: int) -> Spectrum:
    """Spectrum of all rows: by single vectors inside parts, then by whole spectra in a tree."""

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Spectrum.empty(size)
        for batch in batches:
            if len(batch):
                for x in (_matrix(batch["_llm_x"]) - SHIFT).astype(float):
                    own.add(x)
        if own.n:
            yield own.row(TaskContext.get().partitionId())

    def join(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("part")
        first, *others = map(Spectrum.of, batch.itertuples())
        for other in others:
            first.merge(other)
        return first.row(int(batch["part"].iloc[0]) // FAN)

    grown = materialise(rows.select("_llm_x").mapInPandas(grow, SPECTRUM), "spectra")
    parts = grown.agg(F.max("part")).first()[0]
    while parts:
        grown = grown.groupBy((F.col("part") / FAN).cast("long")).applyInPandas(join, SPECTRUM)
        parts //= FAN
    return Spectrum.of(next(grown.toPandas().itertuples()))


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``n x - S``, exact: 64-bit integers where they hold it, else Python's."""
    if n * int(np.abs(x).max(initial=0)) >= 1 << 62:
        x = x.astype(object)
    return x * n - np.array(total, dtype=x.dtype)


def cross_sums(rows: DataFrame, size: int, coordinates: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``y y'`` and of ``y`` over all rows, for the coordinates y of a row."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cross, plain, any_ = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            if len(batch):
                y = coordinates(_matrix(batch["_llm_x"]))
                cross, plain, any_ = cross + y.T @ y, plain + y.sum(axis=0), True
        if any_:
            yield pd.DataFrame({"sums": [[*cross.ravel(), *plain]]})

    added = (rows.select("_llm_x").mapInPandas(add, "sums array<double>")
             .select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("total")).toPandas().sort_values("pos")["total"].to_numpy())
    return added[:size * size].reshape(size, size), added[size * size:]


def eigen(rows: DataFrame, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and vectors (columns) of the covariance."""
    basis = np.linalg.qr(spectrum(rows, len(total)).vectors)[0]
    for _ in range(ROUNDS):
        cross, _ = cross_sums(rows, len(total), lambda x, b=basis: (centred(x, n, total).astype(float) / n) @ b)
        values, turn = np.linalg.eigh(cross / n)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        values = values[::-1]
    return np.maximum(values, 0.0), basis


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: the id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows = entries(df, id_col, vector_col)
    n, total = sums(rows)
    kind = df.schema[id_col].dataType.simpleString()
    if not n:
        return df.sparkSession.createDataFrame(
            [], f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    values, basis = eigen(rows, n, total)
    shown = min(components, len(total))
    live = int((values[:shown] > NOTHING * values[0]).sum()) if values[0] > 0 else 0
    explained = [float(v / values.sum()) for v in values[:shown]] if live else [None] * shown
    turn = basis[:, :live] / np.sqrt(values[:live])
    error = None
    if live:
        cross, plain = cross_sums(rows, live, lambda x: (centred(x, n, total).astype(float) / n) @ turn)
        error = float(np.abs(cross / n - np.outer(plain / n, plain / n) - np.eye(live)).max())

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = centred(_matrix(batch["_llm_x"]), n, total)
                if away.dtype == object or float(np.abs(away).max()) ** 2 * away.shape[1] >= 2**62:
                    deviation = [d if d < 1 << 63 else None for d in (sum(int(a) ** 2 for a in row) for row in away)]
                else:
                    deviation = (away * away).sum(axis=1)
                white = (away.astype(float) / n) @ turn
                yield pd.DataFrame({"_llm_id": batch["_llm_id"], "deviation": pd.array(deviation, dtype="Int64"),
                                    "whitened": [[*w, *[None] * (shown - live)] for w in white]})

    done = rows.mapInPandas(project, f"_llm_id {kind}, deviation bigint, whitened array<double>")
    return (done.select("_llm_id", "deviation", F.posexplode("whitened").alias("_llm_at", "whitened"))
            .select(F.col("_llm_id").alias(id_col), (F.col("_llm_at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                    F.array(*[F.lit(e).cast("double") for e in explained])[F.col("_llm_at")].alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))
