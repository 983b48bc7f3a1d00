"""Table functions over the slices of flights, callable from SQL, with a decision over whole flights.

``register`` makes a Python function a table function of the session.  It is called with a table, partitioned by entity and slice and in order
of the samples::

    SELECT * FROM per_slice(TABLE(samples) PARTITION BY (flight_id, slice) ORDER BY (event_time, seq))

The function gets the rows of one slice as an Arrow table and returns rows and a vote.  Rows come out as they are; the vote comes out as one row
more, with ``vote`` set and the function's own columns NULL.  ``decided`` adds up the votes of each entity's slices and keeps the rows of the
entities whose votes meet a condition, so a function may drop a whole flight although no call ever sees more than a slice of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trackmill.operators.slices import Series, sliced
from trackmill.session import materialise

#: Columns that a table function adds: whose slice it was, and its vote.
ENTITY, VOTE = "entity", "vote"

SliceFunction = Callable[[pa.Table], "tuple[pa.Table | None, float | None]"]


def register(spark: SparkSession, name: str, function: SliceFunction, schema: str | T.StructType, s: Series, key_type: str = "bigint") -> None:
    """Make ``function`` a table function: ``(rows of a slice) -> (rows of schema or None, vote or None)``.

    Its result has the columns of ``schema`` (looked up by name and cast), the entity and the vote.  No vote counts as 0.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    result = T.StructType([*fields, *T.StructType.fromDDL(f"{ENTITY} {key_type}, {VOTE} double")])
    if len(set(result.names)) < len(result.names):
        raise ValueError(f"{ENTITY} and {VOTE} are columns that a table function adds")
    arrow, names, key = to_arrow_schema(result), fields.names, s.key

    @F.arrow_udtf(returnType=result)
    class PerSlice:
        def __init__(self) -> None:
            self.batches: list[pa.RecordBatch] = []  # of one slice

        def eval(self, batch: Any) -> Iterator[pa.Table]:
            self.batches.append(batch)
            return iter(())

        def terminate(self) -> Iterator[pa.Table]:
            if not self.batches:
                return
            rows = pa.Table.from_batches(self.batches)
            entity = rows.column(key)[0].as_py()
            out, vote = function(rows)
            if out is not None and out.num_rows:
                added = {ENTITY: pa.array([entity] * out.num_rows), VOTE: pa.nulls(out.num_rows)}
                yield pa.Table.from_arrays([out.column(n) if n in names else added[n] for n in arrow.names], arrow.names).cast(arrow)
            last = [*([None] for _ in names), [entity], [0.0 if vote is None else float(vote)]]
            yield pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(last, arrow)], arrow.names)

    spark.udtf.register(name, PerSlice)


def call(df: DataFrame, s: Series, name: str) -> DataFrame:
    """Rows and votes of a registered function on each (entity, slice)."""
    cut = sliced(df, s)
    by = ", ".join(f"`{c}`" for c in s.group)
    return df.sparkSession.sql(f"SELECT * FROM {name}(TABLE({{samples}}) PARTITION BY ({by}) ORDER BY ({', '.join(f'`{c}`' for c in s.order)}))", samples=cut)


def decided(results: DataFrame, keep: Column | None = None) -> DataFrame:
    """Rows of the entities that ``keep`` holds for; it sees ``votes`` (their sum), ``slices`` and ``least``, ``most`` (of one slice).

    The default keeps entities without a negative vote.  Results are written once, and read for the votes and for the rows; votes are one row a
    slice, summed before they are shuffled.  Entities without a key vote together.
    """
    keep = F.col("least") >= 0 if keep is None else keep
    done = materialise(results, "called")
    votes = done.filter(F.col(VOTE).isNotNull()).groupBy(F.col(ENTITY).alias("_of")).agg(
        F.sum(VOTE).alias("votes"), F.count(F.lit(1)).alias("slices"), F.min(VOTE).alias("least"), F.max(VOTE).alias("most"))
    # The few that are dropped, or are not, are found by an anti join, so that a flight's rows are never brought together.
    gone = votes.filter(~F.coalesce(keep, F.lit(False))).select("_of")
    return done.filter(F.col(VOTE).isNull()).join(gone, F.col(ENTITY).eqNullSafe(F.col("_of")), "left_anti").drop(ENTITY, VOTE)
