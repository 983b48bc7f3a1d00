"""Quantiles that can be stored per part and merged later, with a bounded error in rank."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a state; the error in rank is about 2.3 / K ** 0.9 of the values.
K = 800


def rank_error(k: int = K) -> float:
    """Share of the values by which a quantile's rank may be off, with a probability of 99%."""
    return 2.296 / k ** 0.9021


def quantile_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """One row per group with a KLL state (binary) for each column; rows with a NULL are skipped.

    A state has some ten kB however many values it saw.  Groups without a value have none (NULL).
    """
    some = {c: F.count(c).alias(f"_n_{c}") for c in columns}
    made = df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns], *some.values())
    return made.select(*keys, *[F.when(F.col(f"_n_{c}") > 0, F.col(c)).alias(c) for c in columns])


def merged_states(states: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """States of coarser groups from stored ones: days to months, slices to flights."""
    some = [F.count(c).alias(f"_n_{c}") for c in columns]
    made = states.groupBy(*keys).agg(*[F.kll_merge_agg_double(c, k).alias(c) for c in columns], *some)
    return made.select(*keys, *[F.when(F.col(f"_n_{c}") > 0, F.col(c)).alias(c) for c in columns])


def quantiles(states: DataFrame, keys: Sequence[str], specs: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Quantiles read from states: ``specs`` maps an output name to (column, p)."""
    def read(column: str, p: float) -> Column:
        return F.when(F.col(column).isNotNull(), F.kll_sketch_get_quantile_double(F.col(column), F.lit(p)))

    return states.select(*keys, *[read(c, p).alias(n) for n, (c, p) in specs.items()])
