"""Quality classifier: regularised quadratic discriminant analysis over transformed text statistics.

Each text becomes a short vector of statistics (shares of byte classes, repetition, line shape, compressibility), each put on a
log scale.  Per class the mean and a shrunken covariance are estimated from sums and cross products that partitions add
up; a score is the logistic of the difference of the two Gaussian log densities, whose Mahalanobis terms are solved with
Cholesky factors computed once at the fit.

Scale: one pass over the texts (and one over those to learn from, if they are others) writes the vectors (some 150 bytes a text); learning is one aggregation of those of labelled rows,
all of them, and sends 2 * (1 + d + d * d) sums to the driver; scoring is a map.  Nothing depends on a key's frequency.

Defined cases: a null text counts as empty and is scored like any other; ids that are null or have no label teach
nothing; an id with several labels has the highest; without labelled rows of both classes every score is 0.5 (an unfit
class has no density); repeated rows are scored alike; other columns are neither read nor touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import any_value_of, held_out, written

#: Byte classes whose share of a text is a statistic.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!?", b".,;:", b"'\"()[]{}-_/\\@=+~^`", bytes(range(128, 256)))
_MEMBER = np.array([[b in c for c in _CLASSES] for b in range(256)], dtype=np.float64)

STATISTICS = ("upper", "digits", "symbols", "bars", "calls", "stops", "marks", "beyond_ascii", "log_words", "word_length", "distinct_words",
              "echoed_words", "distinct_lines", "line_length", "packed_size")


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of ``STATISTICS``."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(1, len(raw))
    shares = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ _MEMBER / size
    words = raw.split()
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    echoed = sum(map(eq, words, islice(words, 1, None))) / n
    rest = (
        np.log1p(len(words)), np.log1p(size / n), np.log(len(set(words)) / n + 0.02), np.log(echoed + 0.01),
        np.log(len(set(lines)) / max(1, len(lines)) + 0.02), np.log1p(size / max(1, len(lines))),
        np.log(len(zlib.compress(raw, 1)) / (size + 20)),
    )
    return [*np.log(shares + 0.005), *rest]


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch.pop("_llm_text")
        batch["_llm_x"] = [statistics(t or "") for t in texts]
        yield batch


def text_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the vector ``_llm_x`` of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_text"))
    return picked.mapInPandas(_vectors, f"_llm_id {kind}, _llm_x array<double>").withColumnRenamed("_llm_id", id_col)


@dataclass(frozen=True)
class Discriminant:
    """Per class: log prior, mean, Cholesky factor of the covariance and half its log determinant.  Empty: not fit."""

    classes: tuple[tuple[float, np.ndarray, np.ndarray, float], ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        if not self.classes:
            return np.full(len(x), 0.5)
        density = []
        for prior, mean, factor, half_log_det in self.classes:
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(prior - half_log_det - 0.5 * np.einsum("ij,ij->j", z, z))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def _moments(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for label, part in batch.groupby("_llm_label"):
            x = np.column_stack([np.ones(len(part)), np.array(part["_llm_x"].tolist())])
            total[int(label)] = total.get(int(label), 0) + x.T @ x
    for label, m in total.items():
        yield pd.DataFrame({"_llm_label": label, "_llm_at": np.arange(m.size), "_llm_sum": m.ravel()})


def fit(labelled: DataFrame, shrinkage: float = 0.1) -> Discriminant:
    """Fit on rows with ``_llm_x`` and ``_llm_label`` (0 or 1).

    A class covariance is drawn to the mean of both classes' within-class variances (its diagonal) by ``shrinkage``, which
    keeps it positive definite where a statistic hardly varies inside a class.
    """
    sums = (labelled.select("_llm_x", F.col("_llm_label").cast("int").alias("_llm_label"))
            .mapInPandas(_moments, "_llm_label int, _llm_at int, _llm_sum double")
            .groupBy("_llm_label", "_llm_at").agg(F.sum("_llm_sum").alias("_llm_sum")).collect())
    d = len(STATISTICS)
    tables = {label: np.zeros((d + 1) ** 2) for label in (0, 1)}
    for r in sums:
        tables[r["_llm_label"]][r["_llm_at"]] = r["_llm_sum"]
    raw = [tables[c].reshape(d + 1, d + 1) for c in (0, 1)]
    if any(m[0, 0] < 1 for m in raw):
        return Discriminant(())
    n = [m[0, 0] for m in raw]
    means = [m[0, 1:] / m[0, 0] for m in raw]
    spread = [m[1:, 1:] / m[0, 0] - np.outer(mu, mu) for m, mu in zip(raw, means)]
    target = np.diag(np.maximum(0.5 * (np.diag(spread[0]) + np.diag(spread[1])), 1e-4))
    classes = []
    for k in (0, 1):
        factor = np.linalg.cholesky((1 - shrinkage) * spread[k] + shrinkage * target)
        classes.append((float(np.log(n[k] / sum(n))), means[k], factor, float(np.log(np.diag(factor)).sum())))
    return Discriminant(tuple(classes))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3,
          may_learn: Column | None = None, lessons: DataFrame | None = None) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on).

    Only labelled rows of ``lessons`` (default: of ``docs``) for which ``may_learn`` holds are learnt from (default: those that
    ``held_out`` does not keep back).  Where ``docs`` has been filtered, ``lessons`` should be the table before that.
    """
    vectors = written(text_vectors(docs, id_col, text_col), "text-vectors")
    learn = ~held_out(F.col(f"`{id_col}`")) if may_learn is None else may_learn
    known = any_value_of(labels, id_col, label_col).withColumnRenamed(label_col, "_llm_label")
    taught = vectors.where(learn) if lessons is None else written(text_vectors(lessons.where(learn), id_col, text_col), "lesson-vectors")
    model = fit(taught.join(known, id_col))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch.pop("_llm_x").tolist()).reshape(len(batch), len(STATISTICS))
            batch["score"] = model.scores(x)
            yield batch

    kind = docs.schema[id_col].dataType.simpleString()
    scored = vectors.select(F.col(f"`{id_col}`").alias("_llm_id"), "_llm_x").mapInPandas(apply, f"_llm_id {kind}, score double")
    return scored.select(F.col("_llm_id").alias(id_col), held_out(F.col("_llm_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lessons: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with their columns (rows that share an id stay if any of them is).

    The model learns from ``lessons``, as in ``score``.
    """
    good = score(docs, labels, id_col, text_col, lessons=lessons).where("predicted = 1").select(F.col(f"`{id_col}`").alias("_llm_id"))
    return docs.join(good, F.col(f"`{id_col}`").eqNullSafe(F.col("_llm_id")), "left_semi")
