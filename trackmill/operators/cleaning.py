"""Cleaning, null handling and column choice."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.operators.slices import Series, sliced, with_carry

FLOATING = (T.DoubleType, T.FloatType)
NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes NULL in every floating column."""
    return df.withColumns({
        f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema if isinstance(f.dataType, FLOATING)
    })


def clean_names(df: DataFrame) -> DataFrame:
    """Keep only letters, digits and underscores in column names."""
    return df.toDF(*[re.sub(r"[^A-Za-z0-9_]+", "", c) for c in df.columns])


def cast_float32(df: DataFrame, keep: Iterable[str] = ("flight_id",)) -> DataFrame:
    spared = set(keep)
    return df.withColumns({
        f.name: F.col(f.name).cast("float")
        for f in df.schema if isinstance(f.dataType, T.DoubleType) and f.name not in spared
    })


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key by ``order``, further ties settled by the remaining columns.

    An aggregate rather than a window: copies collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*[c for c in order if c in rest], *[c for c in rest if c not in order]]
    if not rest:
        return df.select(*keys).distinct()
    first = F.min(F.struct(*ranked)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def percentile_at_least(value: str, p: float, floor: float, s: Series) -> tuple[dict, dict, Column]:
    """Parts of a test whether an entity's exact percentile reaches ``floor``.

    Only the two values around ``floor`` matter, so no percentile buffer is needed: the wanted
    rank lies above them, below them, or between them.
    """
    below = F.col(value) < floor
    aggs = {
        "_known": F.count(value),
        "_below": F.count_if(below),
        "_under": F.max(F.when(below, F.col(value))),
        "_over": F.min(F.when(~below, F.col(value))),
    }
    carries = {
        "_known": F.sum("_known").over(s.entity()),
        "_below": F.sum("_below").over(s.entity()),
        "_under": F.max("_under").over(s.entity()),
        "_over": F.min("_over").over(s.entity()),
    }
    rank = (F.col("_known") - 1) * F.lit(p)
    share = rank - F.floor(rank)
    blended = F.col("_under") * (1.0 - share) + F.col("_over") * share
    test = (
        F.when(F.col("_known") == 0, False)
        .when(F.col("_below") <= F.floor(rank), True)
        .when(F.col("_below") > F.ceil(rank), False)
        .otherwise(blended >= floor)
    )
    return aggs, carries, test


def drop_short_entities(df: DataFrame, s: Series, min_rows: int = 10, value: str = "altitude",
                        p: float = 0.8, floor: float = 10_000.0) -> DataFrame:
    """Drop whole entities with too few rows or whose percentile ``p`` of ``value`` is below ``floor``."""
    aggs, carries, reaches = percentile_at_least(value, p, floor, s)
    aggs["_cnt"] = F.count(F.lit(1))
    carries["_cnt"] = F.sum("_cnt").over(s.entity())
    out = with_carry(sliced(df, s), s, aggs, carries)
    return out.filter((F.col("_cnt") >= min_rows) & reaches).drop("_known", "_below", "_under", "_over", "_cnt")


def drop_unknown_entities(df: DataFrame, s: Series, cols: Sequence[str], min_rows: int = 1) -> DataFrame:
    """Drop entities where one of ``cols`` is never known, or with fewer than ``min_rows`` rows."""
    aggs = {f"_n_{c}": F.count(c) for c in cols} | {"_cnt": F.count(F.lit(1))}
    carries = {n: F.sum(n).over(s.entity()) for n in aggs}
    out = with_carry(sliced(df, s), s, aggs, carries)
    test = F.col("_cnt") >= min_rows
    for c in cols:
        test = test & (F.col(f"_n_{c}") > 0)
    return out.filter(test).drop(*aggs)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """NULL and row count per column (and group), long: ``(*by, column, nulls, rows)``.  One pass."""
    cols = list(cols or [c for c in df.columns if c not in by])
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)
    ])
    return counted.select(*by, "rows", F.explode(pairs).alias("p")).select(*by, "p.column", "p.nulls", "rows")


#: Columns dropped by name: everything on thrust, fuel flow outside the cruise.  Fixed values.
DROP_PATTERNS = (r"thrust", r"^(?!.*cruise).*fuelflow")


def sparse_columns(df: DataFrame, max_nulls: int = 400_000, protect: Sequence[str] = ("tow",),
                   drop_patterns: Sequence[str] = DROP_PATTERNS) -> list[str]:
    """Columns with more than ``max_nulls`` NULLs or a name matching a pattern, never a protected one."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return [
        c for c in df.columns
        if c not in protect and (wide[c] > max_nulls or any(re.search(p, c) for p in drop_patterns))
    ]


def select_columns_by_profile(df: DataFrame, max_nulls: int = 400_000, protect: Sequence[str] = ("tow",),
                              drop_patterns: Sequence[str] = DROP_PATTERNS) -> DataFrame:
    return df.drop(*sparse_columns(df, max_nulls, protect, drop_patterns))


def top_features(importance: DataFrame, n: int, protect: Sequence[str]) -> list[str]:
    """The first ``n`` features by importance, then the protected ones not among them."""
    rows = importance.orderBy(F.desc_nulls_last("importance"), "feature").limit(n).collect()
    ranked = [r["feature"] for r in rows]
    return list(dict.fromkeys([*ranked, *protect]))


def select_top_features(df: DataFrame, importance: DataFrame, n: int, protect: Sequence[str]) -> DataFrame:
    return df.select(*top_features(importance, n, protect))
