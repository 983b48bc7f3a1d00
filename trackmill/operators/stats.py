"""Correlation, shares, per-type statistics and errors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackmill.operators.cleaning import numeric_columns
from trackmill.operators.percentiles import exact_percentiles


def _cross_sums(cols: Sequence[str], shift: Sequence[float]):
    """Partition function: masked cross sums of all column pairs, one row per pair."""
    width = len(cols)
    centre = np.array(shift, dtype=float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, width, width))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - centre
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            mask = known.astype(float)
            # rows where both are known; a and a^2 where b is known; a * b
            total += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        n, first, second, cross = total
        i, j = np.triu_indices(width, 1)
        out = pd.DataFrame({
            "i": i, "j": j, "n": n[i, j].astype("int64"), "sa": first[i, j], "sb": first[j, i],
            "saa": second[i, j], "sbb": second[j, i], "sab": cross[i, j],
        })
        yield out[out["n"] > 0]

    return run


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation, long and symmetric: ``(a, b, r, n)``.

    A first pass finds the column means; the second reduces the Arrow batches of each partition,
    centred on them, to one row of sums per pair, and those rows simply add up.
    A pair with a constant side, or fewer than two common rows, has NULL ``r``.
    """
    cols = list(cols or numeric_columns(df))
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    means = numbers.agg(*[F.avg(c).alias(c) for c in cols]).first()
    sums = numbers.mapInPandas(
        _cross_sums(cols, [means[c] or 0.0 for c in cols]),
        "i int, j int, n long, sa double, sb double, saa double, sbb double, sab double",
    ).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    var_a, var_b = n * F.col("saa") - F.pow("sa", F.lit(2.0)), n * F.col("sbb") - F.pow("sb", F.lit(2.0))
    # What rounding leaves of a constant column is no spread.
    flat = (n < 2) | (var_a <= 1e-13 * n * F.col("saa")) | (var_b <= 1e-13 * n * F.col("sbb"))
    r = F.when(~flat, (n * F.col("sab") - F.col("sa") * F.col("sb")) / F.sqrt(var_a) / F.sqrt(var_b))
    names = F.array(*[F.lit(c) for c in cols])
    pairs = F.explode(F.array(
        F.struct(names[F.col("i")].alias("a"), names[F.col("j")].alias("b")),
        F.struct(names[F.col("j")].alias("a"), names[F.col("i")].alias("b")),
    ))
    return sums.select(pairs.alias("p"), r.alias("r"), "n").select("p.a", "p.b", "r", "n")


def topk_per_group(corr: DataFrame, k: int = 50) -> DataFrame:
    """For each column the ``k`` others with the largest absolute correlation."""
    order = Window.partitionBy("a").orderBy(F.abs("r").desc_nulls_last(), "b")
    ranked = corr.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("bigint"))


def value_share(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Relative frequency of each value, NULLs excluded: ``(col, n, share)``."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(col)).scalar()
    return counts.withColumn(name, F.col("n") / total)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(F.col(c)).alias(f"n_{c}") for c in cols])


def type_stats(df: DataFrame, by: str = "aircraft_type", flown: str = "flown_distance",
               climb: str = "climb_range") -> DataFrame:
    """Median, largest and smallest flown distance and climb range per type."""
    extremes = df.groupBy(by).agg(
        F.max(flown).alias("max_flown_dist"), F.min(flown).alias("min_flown_dist"),
        F.max(climb).alias("max_climb_range"), F.min(climb).alias("min_climb_range"),
    )
    medians = exact_percentiles(df, [by], {
        "median_flown_distance": (F.col(flown), 0.5), "median_climb_range": (F.col(climb), 0.5),
    }).withColumnRenamed(by, "_by")
    return extremes.join(medians, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def normalise_by_reference(df: DataFrame, by: str = "aircraft_type", max_nulls: int = 1000) -> DataFrame:
    """Climb range and remaining distance relative to the type's reference ranges.

    Expects ``climb_range_ref`` and ``cruise_range_ref`` (see ``join_dim``).  A type with more than
    ``max_nulls`` NULL results uses ``x / median(x)`` for all of its rows instead.
    """
    climb, flown = F.col("climb_range"), F.col("flown_distance")
    out = df.withColumns({
        "_climb": F.try_divide(climb, F.col("climb_range_ref")),
        "_flown": F.try_divide(flown - climb, F.col("cruise_range_ref")),
    })
    gaps = out.groupBy(by).agg(
        F.count_if(F.col("_climb").isNull()).alias("_climb_nulls"),
        F.count_if(F.col("_flown").isNull()).alias("_flown_nulls"),
    )
    medians = exact_percentiles(df, [by], {"_climb_median": (climb, 0.5), "_flown_median": (flown, 0.5)})
    per_type = gaps.join(medians, by, "left").withColumnRenamed(by, "_by")
    return out.join(per_type, F.col(by) == F.col("_by"), "left").withColumns({
        "climb_range_normalized": F.when(
            F.col("_climb_nulls") > max_nulls, F.try_divide(climb, F.col("_climb_median"))
        ).otherwise(F.col("_climb")),
        "flown_distance_normalized": F.when(
            F.col("_flown_nulls") > max_nulls, F.try_divide(flown, F.col("_flown_median"))
        ).otherwise(F.col("_flown")),
    }).drop("_by", "_climb", "_flown", "_climb_nulls", "_flown_nulls", "_climb_median", "_flown_median")


def fill_group_median(df: DataFrame, col: str, by: str) -> DataFrame:
    """Fill NULLs of ``col`` with the median of the row's group."""
    medians = exact_percentiles(df, [by], {"_median": (F.col(col), 0.5)}).withColumnRenamed(by, "_by")
    out = df.join(medians, F.col(by) == F.col("_by"), "left")
    return out.withColumn(col, F.coalesce(F.col(col), F.col("_median"))).drop("_by", "_median")


def rmse_expr(actual: str = "tow", predicted: str = "tow_pred"):
    return F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2.0)))


def rmse(df: DataFrame, actual: str = "tow", predicted: str = "tow_pred") -> DataFrame:
    value = rmse_expr(actual, predicted)
    return df.agg(value.alias("rmse"), value.cast("bigint").alias("rmse_int"))
