"""Text clean-up and reproducible pseudo-random keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Families of types, matched at the start of the cleaned type code.
TYPE_FAMILIES = (
    ("^B73[0-9]", "B73x"),
    ("^B78[0-9]", "B78x"),
    ("^B77[0-9]", "B77x"),
    ("^A31[0-9]", "A31x"),
)


def type_family(col: str | Column, families: Sequence[tuple[str, str]] = TYPE_FAMILIES) -> Column:
    """Trimmed upper-case type, folded into its family; 'Unknown' if NULL or blank."""
    c = F.col(col) if isinstance(col, str) else col
    cleaned = F.upper(F.trim(c))
    out = F.when(cleaned.isNull() | (cleaned == ""), F.lit("Unknown"))
    for pattern, family in families:
        out = out.when(cleaned.rlike(pattern), F.lit(family))
    return out.otherwise(cleaned)


def pair_key(left: str, right: str) -> Column:
    """Concatenation that is NULL as soon as one side is."""
    return F.concat(F.col(left), F.col(right))


def hash_hex(key: str | Column, seed: int | str) -> Column:
    """md5 of ``seed|key``: the same for a row wherever and however often it is computed."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.lit(str(seed)), c.cast("string")))


def hash_number(key: str | Column, seed: int | str, digits: int = 8) -> Column:
    """The first hex digits of :func:`hash_hex` as a number."""
    return F.conv(F.substring(hash_hex(key, seed), 1, digits), 16, 10).cast("bigint")
