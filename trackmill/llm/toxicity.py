"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each model sees the hashed words of a text and the probabilities of the categories
before it.  For learning, these probabilities come from models that did not see the row (out-of-fold); for scoring, from the models
learnt on all rows.  So a later model meets at scoring what it met at learning.

Features are the presence of a word or of a word's beginning (five to seven letters), hashed to ``HASHED`` numbers.  Which of them matter is decided by
counts per feature and category, added up in Spark: those with the largest standardised difference of frequencies are selected.
A text is then the short list of its selected features, so long texts and short ones are treated alike.

Scale: learning takes at most ``sample`` labelled ids, those with the smallest hash, so their list is safe to broadcast and no text of another
row moves; their texts give the counts, and the models are fit on the driver.  One pass over all texts writes their selected features, and
scoring is a map over those.

Defined cases: a null or empty text has no features and gets the base rate; null ids and unlabelled rows teach nothing; an id with several
labels has the highest; with no labelled row of a category, or no other, its probability is the share among labelled rows (0 without any);
repeated rows are scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import any_value_of, held_out, written
from trackmill.session import materialise

HASHED = 1 << 18
_WORD = re.compile(r"[^\W\d_]+")
#: Words remembered by a task.
REMEMBERED = 200_000

#: English abuse by kind: a toxic document with a word of a kind counts as an example of that category.
SEEDS = {
    "insult": ("idiot", "moron", "stupid", "dumb", "fool", "clown", "loser", "imbecile", "jerk"),
    "contempt": ("scum", "trash", "garbage", "worthless", "pathetic", "disgusting", "filth", "vermin", "useless"),
}


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a lower-case word and of its beginnings."""
    raw = word.encode("utf-8", "surrogatepass")
    out = {zlib.crc32(raw) % HASHED}
    for k in (5, 6, 7):
        if len(word) > k:
            out.add(zlib.crc32(b"^" + word[:k].encode("utf-8", "surrogatepass")) % HASHED)
    return tuple(out)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _counts(names: list[str]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((HASHED, len(names) + 1), dtype=np.int64)
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            labels = batch[names].to_numpy(dtype=np.int64)
            for text, label in zip(batch["_llm_text"], labels):
                found: set[int] = set()
                for w in words_of(text):
                    got = known.get(w)
                    if got is None:
                        got = word_features(w)
                        if len(known) < REMEMBERED:
                            known[w] = got
                    found.update(got)
                at = np.fromiter(found, dtype=np.int64, count=len(found))
                total[at, 0] += 1
                for k in np.flatnonzero(label):
                    total[at, k + 1] += 1
        some = np.flatnonzero(total[:, 0])
        yield pd.DataFrame({"_llm_f": some, "_llm_n": total[some, 0], **{n: total[some, k + 1] for k, n in enumerate(names)}})

    return count


def _hits(selected: np.ndarray):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.full(HASHED, -1, dtype=np.int32)
        place[selected] = np.arange(len(selected), dtype=np.int32)
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            rows = []
            for text in batch.pop("_llm_text"):
                found: set[int] = set()
                for w in words_of(text):
                    got = known.get(w)
                    if got is None:
                        got = tuple(int(place[f]) for f in word_features(w) if place[f] >= 0)
                        if len(known) < REMEMBERED:
                            known[w] = got
                    if got:
                        found.update(got)
                rows.append(sorted(found))
            batch["_llm_hits"] = rows
            yield batch

    return find


@dataclass(frozen=True)
class Linear:
    """A logistic model over sparse presences and the dense probabilities of earlier categories (as log odds)."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def probabilities(self, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        lengths = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        flat = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if lengths.sum() else np.empty(0, dtype=np.int64)
        z = np.bincount(np.repeat(np.arange(len(rows)), lengths), weights=self.weights[flat], minlength=len(rows)) + self.bias
        return _sigmoid(z + earlier @ self.dense)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit_linear(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, width: int, penalty: float = 2.0, steps: int = 100) -> Linear:
    """Penalised logistic regression by full-batch Adam steps: the rows are few and short, so a step takes milliseconds."""
    share = y.mean() if len(y) else 0.0
    start = float(_log_odds(np.array([share]))[0]) if 0 < share < 1 else (-30.0 if share == 0 else 30.0)
    model = Linear(np.zeros(width), np.zeros(earlier.shape[1]), start)
    if not 0 < share < 1:
        return model
    lengths = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    flat = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if lengths.sum() else np.empty(0, dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    k = width + earlier.shape[1]
    theta = np.concatenate([np.zeros(k), [start]])
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=theta[flat], minlength=len(rows)) + earlier @ theta[width:k] + theta[k]
        error = _sigmoid(z) - y
        grad = np.concatenate([np.bincount(flat, weights=error[row], minlength=width)[:width], earlier.T @ error, [error.sum()]])
        grad[:k] += penalty * theta[:k]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Linear(theta[:width], theta[width:k], float(theta[k]))


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, width: int, folds: int = 4) -> list[Linear]:
    """One model per label column; probabilities handed on while learning are out-of-fold."""
    earlier = np.empty((len(rows), 0))
    chain = []
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(np.float64)
        handed = np.zeros(len(rows))
        for f in range(folds):
            here = np.flatnonzero(fold == f)
            there = np.flatnonzero(fold != f)
            part = fit_linear([rows[i] for i in there], earlier[there], y[there], width)
            if len(here):
                handed[here] = part.probabilities([rows[i] for i in here], earlier[here])
        chain.append(fit_linear(rows, earlier, y, width))
        earlier = np.column_stack([earlier, _log_odds(handed)])
    return chain


def chain_probabilities(chain: list[Linear], rows: list[np.ndarray]) -> np.ndarray:
    """Probabilities per row and category, each category seeing those before it."""
    earlier, out = np.empty((len(rows), 0)), []
    for model in chain:
        p = model.probabilities(rows, earlier)
        out.append(p)
        earlier = np.column_stack([earlier, _log_odds(p)])
    return np.column_stack(out)


def select_features(counts: DataFrame, names: list[str], each: int) -> np.ndarray:
    """The ``each`` features per category whose frequency differs most, in standard deviations, between the category and the rest."""
    base = counts.where("_llm_f = -1").first()
    if base is None:
        return np.empty(0, dtype=np.int64)
    chosen: set[int] = set()
    for n in names:
        yes, no = float(base[n]), float(base["_llm_n"] - base[n])
        if yes < 1 or no < 1:
            continue
        p, q = F.col(n) / yes, (F.col("_llm_n") - F.col(n)) / no
        mean = F.col("_llm_n") / (yes + no)
        z = F.abs(p - q) / F.sqrt(mean * (1 - mean) * (1 / yes + 1 / no) + 1e-12)
        top = counts.where("_llm_f >= 0 AND _llm_n >= 3").orderBy(z.desc(), "_llm_f").limit(each).select("_llm_f")
        chosen.update(r[0] for r in top.collect())
    return np.array(sorted(chosen), dtype=np.int64)


def labelled(docs: DataFrame, labels: DataFrame, seeds: dict[str, tuple[str, ...]], id_col: str, text_col: str, label_col: str,
             may_learn: Column, sample: int) -> DataFrame:
    """At most ``sample`` labelled documents with a 0/1 column per seeded category and one for the label itself, last in the chain."""
    known = any_value_of(labels, id_col, label_col).select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{label_col}`").cast("int").alias("_llm_label"))
    known = written(known.where(may_learn).orderBy(F.xxhash64("_llm_id"), "_llm_id").limit(sample), "sampled-labels")
    rows = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_text")).join(F.broadcast(known), "_llm_id")
    rows = rows.dropDuplicates(["_llm_id"])
    lower = F.lower(F.coalesce("_llm_text", F.lit("")))
    kinds = {f"p_{k}": (F.col("_llm_label") == 1) & lower.rlike(rf"(?<![\p{{L}}])({'|'.join(terms)})(?![\p{{L}}])") for k, terms in seeds.items()}
    return rows.select("_llm_id", "_llm_text", *[c.cast("int").alias(n) for n, c in kinds.items()], F.col("_llm_label").alias(f"p_{label_col}"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          seeds: dict[str, tuple[str, ...]] | None = None, each: int = 400, sample: int = 25_000, folds: int = 4, threshold: float = 0.5) -> DataFrame:
    """One row per document: id, ``held_out``, a probability per category (``p_<category>``, the label's own last) and ``predicted``.

    Rows that ``held_out`` keeps back are not learnt from.  ``sample`` bounds the labelled rows that features are chosen and models are fit on.
    """
    seeds = SEEDS if seeds is None else seeds
    names = [*(f"p_{k}" for k in seeds), f"p_{label_col}"]
    learn = materialise(labelled(docs, labels, seeds, id_col, text_col, label_col, ~held_out(F.col("_llm_id")), sample), "labelled")
    schema = "_llm_f bigint, _llm_n bigint, " + ", ".join(f"{n} bigint" for n in names)
    parts = learn.select("_llm_text", *names).mapInPandas(_counts(names), schema)
    counts = parts.groupBy("_llm_f").agg(F.sum("_llm_n").alias("_llm_n"), *[F.sum(n).alias(n) for n in names])
    whole = learn.agg(F.lit(-1).cast("bigint").alias("_llm_f"), F.count("*").alias("_llm_n"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    counts = written(counts.union(whole), "feature-counts")
    selected = select_features(counts, names, each)
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_text"))
    hits = written(picked.mapInPandas(_hits(selected), f"_llm_id {kind}, _llm_hits array<int>"), "hits")
    few = (hits.join(F.broadcast(learn.select("_llm_id", *names)), "_llm_id").dropDuplicates(["_llm_id"])
           .withColumn("_llm_order", F.xxhash64("_llm_id")).toPandas().sort_values(["_llm_order", "_llm_id"]))
    rows = [np.asarray(h, dtype=np.int64) for h in few["_llm_hits"]]
    chain = fit_chain(rows, few[names].to_numpy(dtype=np.int64).reshape(len(rows), len(names)), (few["_llm_order"].to_numpy(dtype=np.int64) // 7 % folds), max(1, len(selected)), folds)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = chain_probabilities(chain, [np.asarray(h, dtype=np.int64) for h in batch.pop("_llm_hits")])
            for k, n in enumerate(names):
                batch[n] = got[:, k]
            yield batch

    scored = hits.mapInPandas(apply, f"_llm_id {kind}, " + ", ".join(f"{n} double" for n in names))
    return scored.select(F.col("_llm_id").alias(id_col), held_out(F.col("_llm_id")).alias("held_out"), *names,
                         (F.col(names[-1]) >= threshold).cast("int").alias("predicted"))
