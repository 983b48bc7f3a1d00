"""Reproducible splits, caps per class and sample weights."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.encodings import hash_hex, hash_number
from trackmill.session import materialise


def split_train_test(df: DataFrame, key: str = "flight_id", test_percent: int = 20, seed: int = 42,
                     name: str = "test") -> DataFrame:
    """Tag rows 0 (train) or 1 (test) by a hash of the key: stable under any partitioning."""
    return df.withColumn(name, F.when(hash_number(key, seed) % 100 < test_percent, 1).otherwise(0))


#: Hex digits of the hash used to locate a class's cut: 4,096 equal parts, of which one is ranked.
_CUT_DIGITS = 3


def _in_parts(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("_hash", hash_hex(key, seed)).withColumn("_part", F.substring("_hash", 1, _CUT_DIGITS))


def part_counts(df: DataFrame, by: str, key: str = "flight_id", seed: int = 42) -> DataFrame:
    """Rows per class and hash part, written: what :func:`undersample` needs to know of a table, whatever the class of interest."""
    return materialise(_in_parts(df, key, seed).groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_c")), "part_counts")


def undersample(df: DataFrame, by: str, interest, share: float = 0.85, key: str = "flight_id",
                seed: int = 42, counts: DataFrame | None = None) -> DataFrame:
    """All rows of class ``interest``, at most ``int(share * its size)`` random rows of each other class.

    Exact and the same for a seed.  A class keeps its rows with the smallest hashes: counting rows per
    hash part tells which parts are kept whole and which one is cut, and only that part is ranked, so
    a class of any size is never sorted in one task.  Rows with a NULL class form a class as well.  One row per class, written, says
    where it is cut, so that its real size decides how it is joined; ``counts`` may hand in the ``part_counts`` of ``df``.
    """
    counts = part_counts(df, by, key, seed) if counts is None else counts
    cap = counts.agg(F.floor(F.coalesce(F.sum(F.when(F.col(by) == interest, F.col("_c"))), F.lit(0)) * F.lit(share))).scalar()
    upto = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = counts.withColumns({"_end": F.sum("_c").over(upto), "_cap": cap})
    chosen = F.col(by).eqNullSafe(F.lit(interest))
    cuts = materialise(ends.groupBy(F.col(by).alias("_by")).agg(
        # Every hash part is below "g".
        F.max(F.when(chosen, F.lit("g")).when(F.col("_end") <= F.col("_cap"), F.col("_part"))).alias("_whole"),
        F.min(F.when(~chosen & (F.col("_end") > F.col("_cap")), F.struct("_part", (F.col("_cap") - F.col("_end") + F.col("_c")).alias("quota")))).alias("_cut"),
    ).select("_by", "_whole", F.col("_cut._part").alias("_at"), F.col("_cut.quota").alias("_quota")), "cuts")
    placed = _in_parts(df, key, seed).join(cuts, F.col(by).eqNullSafe(F.col("_by")))
    whole = placed.filter(F.col("_part") <= F.col("_whole"))
    rank = F.row_number().over(Window.partitionBy(by, "_part").orderBy("_hash", key))
    cut = placed.filter((F.col("_part") == F.col("_at")) & (F.col("_quota") > 0)).withColumn("_rank", rank).filter("_rank <= _quota").drop("_rank")
    return whole.unionByName(cut).select(*df.columns)


def weights_inverse_freq(df: DataFrame, by: str, interest, boosted: Column | None = None,
                         class_factor: float = 5.0, boost_factor: float = 1.5, name: str = "weight") -> DataFrame:
    """1 / class share; the class of interest gets 5 x the largest weight; ``boosted`` rows 1.5 x the new largest.

    Classes are counted once and written, one row each, so that weights are cheap whenever the rows are read.
    """
    sizes = materialise(df.filter(F.col(by).isNotNull()).groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n")), "class_sizes")
    shares = sizes.select("_by", (1.0 / (F.col("_n") / sizes.agg(F.sum("_n")).scalar())).alias("_w"))
    top = shares.agg(F.max("_w"), ).scalar()
    present = sizes.agg(F.coalesce(F.sum(F.when(F.col("_by") == interest, F.col("_n"))), F.lit(0))).scalar()
    highest = F.when(present > 0, top * class_factor).otherwise(top)
    weight = F.when(F.col(by) == interest, top * class_factor).otherwise(F.col("_w"))
    if boosted is not None:
        weight = F.when(boosted, highest * boost_factor).otherwise(weight)
    return df.join(shares, F.col(by) == F.col("_by"), "left").withColumn(name, weight).drop("_by", "_w")


def manual_rules(type_col: str = "aircraft_type", airline_col: str = "airline") -> list[tuple[Column, float]]:
    """Weights by type and airline code, in the order they apply."""
    kind, airline = F.col(type_col), F.col(airline_col)
    return [
        (kind.isin(0, 7), 4.0),
        (kind.isin(6, 15), 6.0),
        (kind.isin(2, 4, 5), 2.0),
        (airline == 3, 9.0),
        (kind == 16, 9.0),
    ]


def weights_manual(df: DataFrame, rules: Sequence[tuple[Column, float]], name: str = "weight") -> DataFrame:
    """1.0, overridden by each matching rule in turn: the last match wins."""
    weight = F.lit(1.0)
    for test, value in rules:
        weight = F.when(test, F.lit(value)).otherwise(weight)
    return df.withColumn(name, weight)


def feature_subsets(bases: Sequence[Sequence[str]], pool: Sequence[str], draws: int = 75, extra: int = 25,
                    limit: int = 85, seed: int = 42) -> list[tuple[int, list[str]]]:
    """Plan of an ensemble: for each base list ``draws`` copies, each with 0..``extra`` random others.

    The total is capped at ``limit`` features but never cuts into the base list.
    """
    rng = random.Random(seed)
    plan: list[tuple[int, list[str]]] = []
    for base in bases:
        others = sorted(set(pool) - set(base))
        for _ in range(draws):
            wanted = max(min(len(base) + rng.randint(0, extra), limit), len(base))
            added = rng.sample(others, min(wanted - len(base), len(others)))
            plan.append((len(plan), [*base, *added]))
    return plan
