"""Packing along a space-filling curve.

Each document becomes ids with an end id, and a vector: its ids hashed to ``BUCKETS`` shares and those projected to three
normal directions.  Shares do not grow with a text, so long and short ones are compared alike.  Each direction is
centred and scaled by its mean and deviation over all documents and cut into 1024 steps, which gives a Hilbert key; documents are
range-sorted by it and laid end to end, and the line of ids is cut every ``size``.  A sequence thus holds whole documents and pieces of
documents that lie close together on the curve.  Only what is left at the very end falls short, and that rest is cut into powers
of two, so no id of padding is ever needed.

Scale: texts are encoded once into a written table.  One aggregation of it gives the number of ids, the means and the
deviations (7 numbers).  Only (row, key, length) is range-sorted, to get each document's place on the
line: a running sum inside range partitions plus the sum of earlier partitions, one row per partition.  Each shuffle
goes by row number or key with ties spread by row number, so no source or group of copies meets in one task.

Defined cases: a null text is empty and holds just the end id; rows are told apart by a number of their own, so null and
repeated ids, and repeated rows, are packed each on their own; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackmill.llm.common import written
from trackmill.llm.tokens import encoder
from trackmill.session import materialise

BUCKETS = 256
DIMENSIONS = 3
BITS = 10
#: Columns of a document's projections.
PLACES = [f"_llm_place_{k}" for k in range(DIMENSIONS)]
#: Rows whose ids a task holds before it passes them on.
SLICE = 1000


def hash_buckets(vocabulary: int, seed: int = 7) -> np.ndarray:
    """For each id, its hash bucket."""
    mixed = (np.arange(vocabulary, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def directions(seed: int = 7) -> np.ndarray:
    """For each hash bucket, its projection: (BUCKETS, DIMENSIONS)."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (rows of coordinates below 2 ** bits).

    By the known transposed form: undo the excess turns from the highest bit down, Gray-encode, interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        gray ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def places(packed: list[np.ndarray], bucket: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Mean direction of each document's ids: their shares of the hash buckets, projected (no ids: zeros)."""
    sizes = np.array([len(ids) for ids in packed])
    cells = np.repeat(np.arange(len(packed)) * BUCKETS, sizes) + bucket[np.concatenate(packed)]
    counts = np.bincount(cells, minlength=len(packed) * BUCKETS).reshape(-1, BUCKETS)
    return counts @ projection / np.maximum(sizes, 1)[:, None]


def curve_cells(places: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    """Cells of rows of projections, cut at +-4 deviations from the mean (a deviation of 0 counts as 1)."""
    z = (places - mean) / np.where(deviation > 0, deviation, 1.0)
    return np.clip((z + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of ``_llm_row``, the id, ``_llm_ids`` (packed ids with the end id), ``_llm_n`` and the projections ``PLACES``."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        bucket, projection = hash_buckets(1 << 16 if enc.dtype.itemsize == 2 else enc.tokenizer.get_vocab_size() + 1), directions()
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.iloc[at:at + SLICE].copy()
                packed = [enc.encode(t or "") for t in batch.pop("_llm_text")]
                batch["_llm_n"] = [len(p) // enc.dtype.itemsize + 1 for p in packed]
                batch[PLACES] = places([enc.ids(p) for p in packed], bucket, projection)
                batch["_llm_ids"] = [p + end for p in packed]
                yield batch

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_text"))
    doubles = ", ".join(f"{c} double" for c in PLACES)
    done = picked.mapInPandas(encode, f"_llm_id {kind}, _llm_n bigint, {doubles}, _llm_ids binary")
    return written(done.withColumn("_llm_row", F.monotonically_increasing_id()), "encoded")


def keyed(rows: DataFrame, mean: np.ndarray, deviation: np.ndarray) -> DataFrame:
    """``_llm_row``, ``_llm_n`` and the Hilbert key ``_llm_key`` of each row of ``encoded``."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["_llm_key"] = hilbert_key(curve_cells(batch[PLACES].to_numpy(), mean, deviation))
            yield batch[["_llm_row", "_llm_n", "_llm_key"]]

    return rows.select("_llm_row", "_llm_n", *PLACES).mapInPandas(keys, "_llm_row bigint, _llm_n bigint, _llm_key bigint")


def line_starts(rows: DataFrame, *order: str) -> DataFrame:
    """``_llm_row`` and ``_llm_start``: the sum of ``_llm_n`` of all rows before it in the order of ``order`` and the row number.

    Range partitions sum up inside, and are shifted by the sums of the partitions before them.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = [*order, "_llm_row"]
    placed = rows.select("_llm_row", "_llm_n", *order).repartitionByRange(parts, *by).withColumn("_llm_part", F.spark_partition_id())
    placed = materialise(placed, "places")
    sums = placed.groupBy("_llm_part").agg(F.sum("_llm_n").alias("_llm_sum"))
    before = Window.orderBy("_llm_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: their number is a setting, not the data.
    shift = sums.select("_llm_part", F.coalesce(F.sum("_llm_sum").over(before), F.lit(0)).alias("_llm_shift"))
    inside = Window.partitionBy("_llm_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_llm_inside", F.coalesce(F.sum("_llm_n").over(inside), F.lit(0)))
            .join(F.broadcast(shift), "_llm_part")
            .select("_llm_row", (F.col("_llm_inside") + F.col("_llm_shift")).alias("_llm_start")))


def cut(start: int, n: int, total: int, size: int) -> list[tuple[int, int, int, int]]:
    """Pieces (start in document, length, sequence, offset) of a document at ``start`` on a line of ``total`` ids.

    Sequences are ``size`` long; the rest of the line is cut into the powers of two it is made of, longest first.
    """
    full = total // size
    ends = [full * size]
    for b in range((total % size).bit_length() - 1, -1, -1):
        if (total % size) >> b & 1:
            ends.append(ends[-1] + (1 << b))
    out, at = [], start
    while at < start + n:
        if at < full * size:
            sequence, begin = divmod(at, size)
            begin, end = at - begin, at - begin + size
        else:
            k = next(i for i, e in enumerate(ends) if at < e)
            sequence, begin, end = full + k - 1, ends[k - 1], ends[k]
        length = min(end, start + n) - at
        out.append((at - start, length, sequence, at - begin))
        at += length
    return out


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         digest: bool = False) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` (packed, little-endian).

    A sequence is its pieces in the order of ``offset``.  Documents of one sequence are neighbours on the curve.  With ``digest`` there is
    ``ids_crc32`` in place of the ids, so that they need not leave the task that cuts them.
    """
    rows = encoded(docs, tokenizer, end_id, id_col, text_col)
    total, *spread = rows.agg(F.sum("_llm_n"), *map(F.avg, PLACES), *map(F.stddev_pop, PLACES)).first()
    total = total or 0
    mean, deviation = np.array([x or 0.0 for x in spread]).reshape(2, DIMENSIONS)
    starts = line_starts(keyed(rows, mean, deviation), "_llm_key")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, n, ids, start in zip(batch["_llm_id"], batch["_llm_n"], batch["_llm_ids"], batch["_llm_start"]):
                wide = len(ids) // n
                for s, length, sequence, offset in cut(int(start), int(n), total, size):
                    piece = ids[s * wide:(s + length) * wide]
                    out.append((doc, s, length, int(n), sequence, offset, wide_crc32(piece, wide) if digest else piece))
            yield pd.DataFrame(out, columns=["_llm_id", "start", "length", "doc_tokens", "sequence_id", "offset", result.split()[0]])

    result = "ids_crc32 bigint" if digest else "ids binary"
    kind = docs.schema[id_col].dataType.simpleString()
    joined = rows.select("_llm_row", "_llm_id", "_llm_n", "_llm_ids").join(starts, "_llm_row").drop("_llm_row")
    return joined.mapInPandas(
        pieces, f"_llm_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, {result}",
    ).withColumnRenamed("_llm_id", id_col)


def wide_crc32(packed: bytes, wide: int) -> int:
    """Unsigned crc32 of packed ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(packed, dtype=f"<u{wide}").astype("<u4").tobytes())

