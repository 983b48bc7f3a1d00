"""Mixing of sources to target weights by Poisson replication, in DataFrame functions only.

A source whose rows should make up a share of the mixture repeats each row at a mean rate (target rows / own rows).  How often
a row really appears is a Poisson variate of that mean, found by inverting the distribution function at a number in
(0, 1) that is a hash of seed and id: the same in every run and on every machine.  The row is exploded by its
count, and the copies are shuffled globally by a second hash.

Scale: the only statistic is the row count per named source, a partial count with one row per entry of ``weights``, all other
sources counted together; rates enter the plan as literals, so no join and no shuffle by the skewed source column.
A rate above ``TABLE_RATE`` is drawn as the sum of Poisson variates of equal parts of it, each with a hash of its own, so that the plan stays
as small whatever the rate.  The global shuffle is a range partitioning by hash and input row, which spreads any hot source, repeated row or
shared id evenly; where a row may have more than ``BLOCK`` copies, blocks of copies are dealt out before they are expanded.

Defined cases: null and unnamed sources share ``rest_weight`` in proportion to their rows; a named source without rows gives nothing;
rows without an id draw by their text; rows that share an id share their draw; an empty table gives an empty
result; columns named like the added ones are replaced, so a caller with such columns names the added ones otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Largest rate with a table of its own, and copies of a row that are expanded together.
TABLE_RATE = 256.0
BLOCK = 65_536


def unit_hash(seed: str, key: Column) -> Column:
    """A number in (0, 1) from the first 12 hex digits of an md5: 48 bits, at the middle of its cell."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def poisson_cdf(rate: float) -> list[float]:
    """Distribution function of Poisson(rate) at 0, 1, ... up to where it exceeds every value of ``unit_hash``."""
    top = 1 - 2.0 ** -50
    out, total, k = [], 0.0, 0
    while True:
        total = total + math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) if rate > 0 else 1.0
        out.append(min(total, 1.0))
        if total >= top or (k > rate and k > rate + 12 * math.sqrt(rate) + 60):
            return out
        k += 1


def poisson_draw(u: Column, rate: float) -> Column:
    """The smallest k whose distribution function reaches ``u``: how many values of it lie below ``u``."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in poisson_cdf(rate)]), lambda c: c < u))


def draws(seed: str, key: Column, u: Column, rate: float) -> Column:
    """A Poisson variate of any rate: the inverse at ``u``, or beyond ``TABLE_RATE`` the sum of inverses of equal parts of the rate."""
    if rate <= TABLE_RATE:
        return poisson_draw(u, rate)
    parts = math.ceil(rate / TABLE_RATE)
    if rate > 1e9:
        raise ValueError(f"a row would be repeated {rate:g} times; at most 1e9 are supported")
    return F.aggregate(F.sequence(F.lit(1), F.lit(parts)), F.lit(0),
                       lambda total, i: total + poisson_draw(unit_hash(f"{seed}/part", F.concat(i.cast("string"), F.lit(":"), key)), rate / parts))


def target_rates(counts: dict[str | None, int], weights: dict[str, float], rest_weight: float, size: float | None = None) -> dict[str | None, float]:
    """Mean repetitions of a row per source (key None: all unnamed ones), for a mixture of ``size`` rows (default: as many as there are)."""
    whole = sum(counts.values()) if size is None else size
    share = {k: w for k, w in [*weights.items(), (None, rest_weight)] if counts.get(k, 0) > 0 and w > 0}
    total = sum(share.values())
    return {k: whole * w / total / counts[k] for k, w in share.items()}


def mix(docs: DataFrame, weights: dict[str, float], rest_weight: float = 1.0, size: float | None = None, seed: str = "mix",
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", shuffle: bool = True,
        copy_col: str = "copy", key_col: str = "shuffle_key") -> DataFrame:
    """The columns of ``docs`` plus ``copy_col`` (0, 1, ...) and ``key_col``; one row per drawn copy, in order of ``key_col``.

    ``weights`` are relative shares of the mixture in rows.
    """
    source = F.col(f"`{source_col}`")
    named = F.when(source.isin(*weights), source) if weights else F.lit(None).cast("string")
    counts = {r[0]: r[1] for r in docs.groupBy(named.alias("_llm_source")).count().collect()}
    rates = target_rates(counts, weights, rest_weight, size)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit("text:"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    draw = F.lit(0)
    u = F.col("_llm_u")
    for name, rate in rates.items():
        hit = source == name if name is not None else (~source.isin(*weights) | source.isNull() if weights else F.lit(True))
        draw = F.when(hit, draws(seed, key, u, rate)).otherwise(draw)
    out = docs.drop(copy_col, key_col).withColumn("_llm_u", unit_hash(seed, key)).withColumn("_llm_n", draw).where("_llm_n > 0")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n, first = F.col("_llm_n"), F.lit(0)
    if max(rates.values(), default=0.0) > BLOCK / 4:
        out = out.withColumn("_llm_first", F.explode(F.sequence(F.lit(0), F.col("_llm_n") - 1, F.lit(BLOCK))))
        out = out.repartition(parts, key, F.col("_llm_first"))
        n, first = F.least(n, F.col("_llm_first") + BLOCK), F.col("_llm_first")
    out = out.withColumn(copy_col, F.explode(F.sequence(first, n - 1)))
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/order:"), F.col(f"`{copy_col}`").cast("string"), F.lit(":"), key).cast("binary")), 1, 15), 16, 10)
    out = out.withColumn(key_col, place.cast("bigint")).drop("_llm_u", "_llm_n", "_llm_first")
    if not shuffle:
        return out
    # Rows that share an id share their keys; their place in the input tells them apart.
    out = out.withColumn("_llm_row", F.monotonically_increasing_id()).repartitionByRange(parts, key_col, "_llm_row")
    return out.sortWithinPartitions(key_col, "_llm_row").drop("_llm_row")


def oracle(weights: dict[str, float], rest_weight: float, seed: str = "mix", steps: int = 400) -> str:
    """SQL for ``mix`` over ``documents`` with known ids and rates up to ``TABLE_RATE``, well below ``steps``."""
    named = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in weights.items())
    return f"""
    WITH w(s, weight) AS (VALUES {named}),
    d AS (SELECT documents.*, w.s, CAST('0x' || substr(md5('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS h FROM documents LEFT JOIN w ON source = w.s),
    c AS (SELECT s, count(*) AS n FROM d GROUP BY s),
    r AS (SELECT c.s, n, coalesce(weight, {rest_weight!r}::DOUBLE) AS weight FROM c LEFT JOIN w ON c.s = w.s),
    t AS (SELECT s, (SELECT sum(n) FROM r) * weight / (SELECT sum(weight) FROM r) / n AS rate FROM r),
    f AS (SELECT s, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS below
          FROM t, (SELECT CAST(range AS INTEGER) AS k FROM range({steps})) AS g)
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, f.k AS copy,
           CAST('0x' || substr(md5('{seed}/order:' || CAST(f.k AS VARCHAR) || ':' || CAST(d.doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS shuffle_key
    FROM d JOIN f ON d.s IS NOT DISTINCT FROM f.s AND f.below < (d.h + 0.5::DOUBLE) / 281474976710656::DOUBLE"""
