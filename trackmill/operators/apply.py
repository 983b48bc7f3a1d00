"""Escape hatch: user functions on the ordered rows of an entity, slice by slice, with a say over the whole entity."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.operators.slices import Series, join_entity
from trackmill.session import materialise


def apply_per_entity(df: DataFrame, s: Series, functions: Sequence[Callable[[pd.DataFrame], pd.DataFrame | None]],
                     schema: str | T.StructType, about: Mapping[str, Column] | None = None) -> DataFrame:
    """Run a chain of functions on each (entity, slice); one ``None`` from any slice drops the whole entity, an empty frame nothing but itself.

    Only for what the built-in operators cannot express.  A function sees the ordered rows of one slice as a pandas frame, never a whole
    entity, so an entity of any size is spread over tasks: what looks over a slice's edge belongs into ``about``, aggregates
    over the entity's rows that become columns of every frame.  The results are written once, with a mark for each slice that
    drops its entity, and marked entities are left out when they are read.
    """
    order, group, key = list(s.order), list(s.group), s.key
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = fields.names
    whole = df.groupBy(s.key).agg(*[c.alias(n) for n, c in about.items()]) if about else df.select(s.key).distinct()
    drop, entity = "_drops", "_entity"
    marked = T.StructType([*fields, T.StructField(entity, df.schema[s.key].dataType), T.StructField(drop, T.BooleanType())])

    rows = join_entity(df, s, whole)
    columns = rows.columns
    # A gap in a batch must not change the type of a slice without one, so these come as a value and a mark.
    gappy = {f.name: "float64" if isinstance(f.dataType, T.IntegralType) else "object" for f in rows.schema
             if f.name not in s.group and isinstance(f.dataType, (T.IntegralType, T.BooleanType))}
    marks = {c: F.col(c).isNull().alias(f"_gap_{c}") for c in gappy}
    sent = [F.coalesce(c, F.lit(0).cast(rows.schema[c].dataType)).alias(c) if c in gappy else F.col(c) for c in columns]

    def chain(part: pd.DataFrame) -> pd.DataFrame | None:
        for function in functions:
            part = function(part)
            if part is None or part.empty:
                break
        return part

    def applied(rows: pd.DataFrame, cuts: Sequence[int]) -> Iterator[pd.DataFrame]:
        """The results of the slices between ``cuts``, those of equal types together, and the marks of those that drop their entity."""
        plain, of = rows[columns], rows[key].array
        gaps = {c: g for c in gappy if (g := rows[f"_gap_{c}"].to_numpy()).any()}
        dropped, frames, owners = [], [], []

        def together() -> pd.DataFrame:
            owner = of.take(np.repeat(owners, [len(f) for f in frames]))
            out = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0].reset_index(drop=True)
            return out.assign(**{entity: owner, drop: False})

        for i, j in zip(cuts[:-1], cuts[1:]):
            part = plain.iloc[i:j].reset_index(drop=True)
            for c, gap in gaps.items():
                if gap[i:j].any():
                    part[c] = part[c].astype(gappy[c]).mask(gap[i:j], np.nan if gappy[c] == "float64" else None)
            out = chain(part)
            if out is None:
                dropped.append(i)
            elif not out.empty:
                out = out[names]
                if frames and not out.dtypes.equals(frames[-1].dtypes):
                    yield together()
                    frames, owners = [], []
                frames.append(out)
                owners.append(i)
        if frames:
            yield together()
        if dropped:
            yield pd.DataFrame({**{n: [None] * len(dropped) for n in names}, entity: of.take(dropped), drop: True})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the rows so far of a slice that the next batch may go on with
        for batch in batches:
            if batch.empty:
                continue
            keys = batch[group]
            before = pd.concat([held[-1][group].iloc[-1:] if held else keys.iloc[:0], keys.iloc[:-1]])
            if not held:
                before = pd.concat([keys.iloc[:1], before])
            starts = np.zeros(len(batch), dtype=bool)
            for c in group:
                here, there = keys[c].reset_index(drop=True), before[c].reset_index(drop=True)
                starts |= ((here != there) & ~(here.isna() & there.isna())).to_numpy(dtype=bool)
            cuts = np.flatnonzero(starts)
            if not len(cuts):
                held.append(batch)
                continue
            whole = pd.concat([*held, batch.iloc[:cuts[-1]]], ignore_index=True) if held else batch.iloc[:cuts[-1]].reset_index(drop=True)
            ahead = sum(map(len, held))
            yield from applied(whole, [0, *(ahead + c for c in cuts if ahead + c)])
            held = [batch.iloc[cuts[-1]:]]
        if held:
            whole = pd.concat(held, ignore_index=True)
            yield from applied(whole, [0, len(whole)])

    # Slices lie in a row in their partition, so a batch of rows hands over many of them.
    dealt = rows.select(*sent, *marks.values()).repartition(*s.group).sortWithinPartitions(*s.group, *[F.asc_nulls_last(c) for c in order])
    done = materialise(dealt.mapInPandas(run, marked), "applied")
    dropped = done.filter(drop).select(entity).distinct()
    return done.filter(~F.col(drop)).join(dropped, done[entity].eqNullSafe(dropped[entity]), "left_anti").select(*names)
