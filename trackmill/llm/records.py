"""Token ids as length-delimited binary records, with an offset index beside each file.

A shard file is a run of records and nothing else:

    length   u64 little-endian, bytes of the payload
    check    u32 little-endian, masked crc32 of the eight length bytes
    payload  id of the document i64 little-endian, flag u8 (1: the id is null), then the token ids, 2 or 4 bytes each
    check    u32 little-endian, masked crc32 of the payload

The mask turns a crc right by 15 bits and adds a constant, so that a checksum stored among checksummed bytes stays a check.
The index file beside it (``.idx``) has one record of four u64 per record, in file order: offset, length of the payload, id (as i64)
and count of token ids.  With it a reader seeks to any record, so shuffled reads need no scan.

Documents are range-partitioned by id, so shards follow each other in ascending id order and each task writes one shard.  Files
are written under a name of their attempt and then renamed, and a file name depends only on the partition: a task that runs again after an
executor is lost replaces its own file.  Paths may be any that pyarrow's file systems know.

Defined cases: a null text is empty and holds just the end id; a null id comes first; rows that share an id each have a record, in the order of
their texts; an empty table writes no shard and reads back empty; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmill.llm.common import written
from trackmill.llm.packing import wide_crc32
from trackmill.llm.tokens import encoder
from trackmill.session import fresh_path

_MASK_DELTA = 0xA282EAD8
_HEAD = "<qB"
_HEAD_SIZE = 9
_INDEX = np.dtype([("offset", "<u8"), ("length", "<u8"), ("doc_id", "<i8"), ("n_tokens", "<u8")])
SHARDS = "shard int, path string, records bigint, tokens bigint, wide int"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A payload with its lengths and checks."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def frames(stream) -> Iterator[bytes]:
    """The payloads of a stream of records; any damage raises."""
    while head := stream.read(12):
        length, check = struct.unpack("<QI", head)
        if masked(head[:8]) != check:
            raise ValueError("damaged record length")
        body = stream.read(length + 4)
        if len(body) < length + 4 or masked(body[:length]) != struct.unpack("<I", body[length:])[0]:
            raise ValueError("damaged record")
        yield body[:length]


def read_at(path: str, position: int) -> tuple[int | None, bytes]:
    """Id and packed token ids of the record at a place of a shard, by its index."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{name}.idx") as f:
        entry = np.frombuffer(f.read_at(_INDEX.itemsize, position * _INDEX.itemsize), dtype=_INDEX)[0]
    with store.open_input_file(name) as f:
        payload = next(frames(_Bytes(f.read_at(int(entry["length"]) + 16, int(entry["offset"])))))
    doc, null = struct.unpack_from(_HEAD, payload)
    return None if null else doc, payload[_HEAD_SIZE:]


class _Bytes:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def read(self, n: int) -> bytes:
        out = self.data[self.at:self.at + n]
        self.at += n
        return out


def _uri(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, which is Spark's default one where none is named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    named = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    # pyarrow wants an authority, if only an empty one.
    return named if "://" in named else named.replace(":", "://", 1)


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards of ``docs`` under ``folder``; a small written table with a row per shard: number, path, records, tokens, bytes per id."""
    target = _uri(docs.sparkSession, folder)

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        path = f"{target.rstrip('/')}/shard-{shard:06d}.rec"
        out = index = None
        offset = tokens = records = 0
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for batch in batches:
            if out is None:
                store, name = fs.FileSystem.from_uri(path)
                store.create_dir(name.rpartition("/")[0], recursive=True)
                out, index = store.open_output_stream(f"{name}.{attempt}"), store.open_output_stream(f"{name}.idx.{attempt}")
            for doc, text in zip(batch["_llm_id"], batch["_llm_text"]):
                null = doc is None or doc != doc
                ids = enc.encode(text or "") + end
                record = frame(struct.pack(_HEAD, 0 if null else int(doc), null) + ids)
                n = len(ids) // enc.dtype.itemsize
                out.write(record)
                index.write(np.array([(offset, len(record) - 16, 0 if null else int(doc), n)], dtype=_INDEX).tobytes())
                offset, tokens, records = offset + len(record), tokens + n, records + 1
        if out is not None:
            out.close()
            index.close()
            store.move(f"{name}.{attempt}", name)
            store.move(f"{name}.idx.{attempt}", f"{name}.idx")
            yield pd.DataFrame([(shard, path, records, tokens, enc.dtype.itemsize)], columns=["shard", "path", "records", "tokens", "wide"])

    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    picked = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_text"))
    by = [F.col("_llm_id").asc_nulls_first(), F.col("_llm_text").asc_nulls_first()]
    ordered = picked.repartitionByRange(parts, by[0]).sortWithinPartitions(*by)
    return written(ordered.mapInPandas(save, SHARDS), "shards")


def read(spark: SparkSession, shards: DataFrame, id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """One row per record of the shards: id, ``start`` (token ids in all records before it), ``n_tokens``, ``ids`` (packed) and ``wide``.

    With ``digest`` there is ``ids_crc32`` in place of ``ids`` and ``wide``, so that the ids need not leave the task that reads them.
    """
    # One row per shard: their number is a setting, not the data.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("_llm_start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start, wide in zip(batch["path"], batch["_llm_start"], batch["wide"]):
                store, name = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_stream(name, buffer_size=1 << 20) as f:
                    for payload in frames(f):
                        doc, null = struct.unpack_from(_HEAD, payload)
                        ids = payload[_HEAD_SIZE:]
                        what = (wide_crc32(ids, wide),) if digest else (ids, wide)
                        rows.append((None if null else doc, start, len(ids) // wide, *what))
                        start, held = start + len(ids) // wide, held + (50 if digest else len(ids))
                        if held > 8_000_000:
                            yield _records(rows, columns)
                            rows, held = [], 0
                if rows:
                    yield _records(rows, columns)

    columns = ["_llm_id bigint", "start bigint", "n_tokens bigint", *(["ids_crc32 bigint"] if digest else ["ids binary", "wide int"])]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = placed.select("shard", "path", "_llm_start", "wide").repartition(parts, "shard")
    return spread.mapInPandas(load, ", ".join(columns)).withColumnRenamed("_llm_id", id_col)


def _records(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in columns])
    out["_llm_id"] = out["_llm_id"].astype("Int64")
    return out


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Write ``docs`` to fresh shards in the shared folder and read them back."""
    spark = docs.sparkSession
    return read(spark, write(docs, tokenizer, fresh_path(spark, "records"), end_id, id_col, text_col), id_col, digest)
