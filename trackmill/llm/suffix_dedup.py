"""Repeated passages cut out of documents: suffixes sorted block by block, with ranks of a difference cover.

Wanted are all positions whose next ``min_length`` bytes (L) also start somewhere else.  A difference cover modulo v is a set of
residues such that any two positions, moved on by the same number k < v of bytes, both come to lie on it.  So of two equal passages of L bytes, at any
two positions, some two cover samples inside them, at the same distance from the starts, begin equal blocks of w = L - v + 1 bytes.

1. *Cover samples.*  The suffixes at the cover's positions (12 of 133 bytes) are dealt to buckets by their leading bytes, and one bucket after the other
   is sorted: by the block of w bytes, then by the whole surroundings in which a window with this sample can lie (v - 1 bytes
   before it up to L bytes after its start).  A bucket's order gives each sample its rank, and with it one of four fates: its block is no other's, and no
   passage holds it; its surroundings occur elsewhere too, and every window in them is *repeated*; its block is shared but its surroundings are its
   own, and the windows around it are *open*; or it is repeated and some equal block is open, and one such sample is the *partner*
   which the open ones are compared with.
2. *Open suffixes.*  Ties between suffixes are thus settled by ranks of samples, except at the edges of passages.  Only the suffixes of open samples and
   of partners, a few in a hundred of all, are dealt to buckets by their leading bytes and sorted to their full L bytes.
3. Covered bytes are cut out, document by document.

Blocks, surroundings and windows are told apart by their bucket and fingerprints of 32, 64 and 96 bits.  Different blocks that pass for equal are
held open, which decides nothing; different surroundings of seemingly equal blocks, and different windows, pass for equal with a chance of 2 ** -96 a pair in a bucket.

Scale: documents are laid into chunks of about ``CHUNK`` bytes, each one row of a written table, and samples travel as packed arrays, one row a chunk
and bucket.  Equal samples of a chunk are sent twice at most, so a text that is copied everywhere costs a bucket two samples a chunk.  Buckets are
cut by block and surroundings as well as by leading bytes; where a cut goes through the samples of one block, those at the cut
count as open, which costs time but decides nothing.  Cuts come from a bounded draw of samples (``DRAW``) and bear on balance alone.  A bucket is
meant to hold ``BUCKET`` samples, whatever the size of the input, and is what a task holds at a time.

Defined cases: a null text is empty; null and repeated ids stay as they are, as rows are told apart by their place; repeated rows are repeats of each
other and lose all but texts shorter than L; an empty table gives no rows; other columns are ignored.  A text is cut at bytes, so what is kept
may begin or end inside a character.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.session import materialise


@dataclass(frozen=True)
class Cover:
    """Residues modulo ``modulus`` among whose differences every residue is found."""

    modulus: int
    residues: tuple[int, ...]

    def places(self, end: int) -> np.ndarray:
        """The cover's positions below ``end``, ascending."""
        if end <= 0:
            return np.zeros(0, dtype=np.int64)
        rounds = np.arange(-(-end // self.modulus), dtype=np.int64)[:, None] * self.modulus
        found = (rounds + np.array(self.residues)).ravel()
        return found[:np.searchsorted(found, end)]


#: The perfect difference set of order 11.
COVER = Cover(133, (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121))
MIN_LENGTH = 400
#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK = 1 << 20
#: Samples, or open suffixes, that a bucket is meant to hold.
BUCKET = 500_000
#: Samples that the cuts between buckets are taken from, and those that a chunk offers.
DRAW, OFFERED = 50_000, 32
REPEATED, OPEN, PARTNER = 1, 2, 3

_LEAD = 8
_CHUNKS = "chunk bigint, ids array<{kind}>, ends binary, n_bytes bigint, text binary, offered binary"
_SENT = "bucket bigint, chunk bigint, kind int, keys binary, spans binary"
_BACK = "chunk bigint, kind int, keys binary, spans binary"
TEXT_KIND, KEYS_KIND, SPANS_KIND = 9, 0, 1


def _schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string without arrays."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _schema(ddl)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class Samples:
    """Cover samples of a chunk: where they are, where their surroundings begin and end, and their keys."""

    at: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    lead: np.ndarray | None
    block: np.ndarray | None
    around: np.ndarray


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first eight bytes at each place as a number that sorts like them."""
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(_LEAD):
        out = (out << np.uint64(8)) | data[at + j]
    return out


def samples(text: bytes, ends: np.ndarray, cover: Cover, length: int, blocks: bool = True) -> Samples:
    """Cover samples, in the order of their places, of all documents of a chunk that can hold a passage of ``length`` bytes.

    Without ``blocks`` they have no ``lead`` and ``block``.
    """
    width = length - cover.modulus + 1
    at, begin, end = [], [], []
    start = 0
    for stop in ends.tolist():
        if stop - start >= length:
            places = cover.places(stop - start - width + 1) + start
            at.append(places)
            begin.append(np.maximum(places - (cover.modulus - 1), start))
            end.append(np.minimum(places + length, stop))
        start = stop
    if not at:
        none = np.zeros(0, dtype=np.int64)
        return Samples(none, none, none, *[none.astype(np.uint64)] * 3)
    at, begin, end = map(np.concatenate, (at, begin, end))
    digest = xxhash.xxh3_64_intdigest
    places = at.tolist()
    # Blocks need to differ within a bucket only: what passes for equal there is held open, not decided.
    block = np.fromiter((digest(text[p:p + width]) & 0xFFFFFFFF for p in places), np.uint64, len(places)) if blocks else None
    # What lies before the sample is part of the key, so that one stretch of text around two samples gives two keys.
    around = np.fromiter((digest(text[b:e], p - b) for p, b, e in zip(places, begin.tolist(), end.tolist())), np.uint64, len(places))
    lead = leading(np.frombuffer(text, np.uint8), at) if blocks else None
    return Samples(at, begin, end, lead, block, around)


def twice_at_most(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """``order`` (which sorts the keys) without what follows the second of equal keys."""
    if len(order) < 3:
        return order
    same = np.ones(len(order) - 2, dtype=bool)
    for k in keys:
        k = k[order]
        same &= k[2:] == k[:-2]
    return order[np.append([True, True], ~same)]


def cut_points(cuts: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Where sorted keys (most significant first) reach each cut; a cut is a row with as many numbers."""
    low, high = np.zeros(len(cuts), dtype=np.int64), np.full(len(cuts), len(keys[0]), dtype=np.int64)
    for column, key in zip(cuts.T, keys):
        if key is keys[0]:
            low, high = np.searchsorted(key, column, "left"), np.searchsorted(key, column, "right")
        else:
            for i in np.flatnonzero(low < high):
                part = key[low[i]:high[i]]
                low[i], high[i] = low[i] + np.searchsorted(part, column[i], "left"), low[i] + np.searchsorted(part, column[i], "right")
    return low


def chunks(docs: DataFrame, cover: Cover, length: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """Written table of chunks: ids, ends of documents (64-bit), joined texts (packed), and a few sample keys for the cuts."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, number = [], [], 0, TaskContext.get().partitionId() << 32
        id_type = None

        def chunk() -> pa.RecordBatch:
            text = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            # The first documents only are asked for samples: these keys serve balance.
            probe = 0
            while probe < len(texts) and len(texts[probe]) < length:
                probe += 1
            offered = b""
            if probe < len(texts):
                found = samples(texts[probe][:64 * length], np.array([min(len(texts[probe]), 64 * length)]), cover, length)
                pick = np.linspace(0, len(found.at) - 1, min(OFFERED, len(found.at))).astype(int)
                offered = np.column_stack((found.lead, found.block, found.around))[pick].tobytes()
            columns = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([ends.tobytes()], pa.binary()),
                       pa.array([len(text)], pa.int64()), pa.array([zstandard.compress(text, 1)], pa.binary()), pa.array([offered], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "ends", "n_bytes", "text", "offered"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and held + len(text) > size:
                    yield chunk()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(doc)
                texts.append(text)
                held += len(text)
        if texts:
            yield chunk()

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("_llm_text"))
    return materialise(picked.mapInArrow(lay, _CHUNKS.format(kind=kind)), "chunks")


def bucket_cuts(laid: DataFrame, count: int) -> np.ndarray:
    """Rows (leading bytes, block, surroundings) that part the samples into ``count`` buckets."""
    n = laid.count()
    drawn = laid.select("offered").sample(min(1.0, DRAW / OFFERED / max(n, 1)), seed=11).limit(DRAW // OFFERED).collect()
    keys = np.frombuffer(b"".join(bytes(r["offered"]) for r in drawn), dtype=np.uint64).reshape(-1, 3)
    keys = keys[np.lexsort(keys.T[::-1])]
    return keys[np.arange(1, count) * len(keys) // count] if len(keys) else keys


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, list[tuple[int, np.ndarray, bytes]]]]:
    """For rows sorted by chunk and kind: each chunk's text row, with the rows sent back to it."""
    sent: list[tuple[int, np.ndarray, bytes]] = []
    at = None
    for batch in batches:
        chunk, kind = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
        keys, spans = batch.column("keys"), batch.column("spans")
        for i in range(len(batch)):
            if chunk[i] != at:
                sent, at = [], int(chunk[i])
            if kind[i] == TEXT_KIND:
                yield at, {c: batch.column(c)[i] for c in ("ids", "keys", "spans") if c in batch.schema.names}, sent
                sent = []
            else:
                sent.append((int(kind[i]), keys[i].as_py(), spans[i].as_py()))


def _with_texts(laid: DataFrame, back: DataFrame, with_ids: bool = False) -> DataFrame:
    """Chunks (text as ``keys``, ends as ``spans``) after the rows sent back to them, one chunk after the other."""
    parts = max(1, int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = ["ids"] if with_ids else []
    texts = laid.select("chunk", F.lit(TEXT_KIND).alias("kind"), F.col("text").alias("keys"), F.col("ends").alias("spans"), *ids)
    rows = texts.unionByName(back.select("chunk", "kind", "keys", "spans"), allowMissingColumns=True)
    return rows.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind")


def send_samples(laid: DataFrame, cuts: np.ndarray, cover: Cover, length: int) -> DataFrame:
    """Sorted sample keys, one row per chunk and bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ends, text in zip(*[batch.column(c) for c in ("chunk", "ends", "text")]):
                found = samples(zstandard.decompress(text.as_buffer()), np.frombuffer(ends.as_buffer(), np.int64), cover, length)
                order = twice_at_most(np.lexsort((found.around, found.block, found.lead)), found.block, found.around)
                lead, block, around = found.lead[order], found.block[order], found.around[order]
                edges = [0, *cut_points(cuts, lead, block, around).tolist(), len(order)]
                rows = [(b, chunk.as_py(), KEYS_KIND, around[i:j].tobytes() + block[i:j].astype(np.uint32).tobytes(), None)
                        for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
                if rows:
                    yield _batch(rows, _SENT)

    return laid.select("chunk", "ends", "text").mapInArrow(send, _SENT)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the number of each place's run of equal keys, and the lengths of the runs."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    run = np.cumsum(new) - 1
    return run, np.bincount(run)


def fates(block: np.ndarray, around: np.ndarray, at_cut: np.ndarray) -> np.ndarray:
    """What sorted samples of a bucket come to (0: nothing); ``at_cut``: blocks whose samples may lie in two buckets."""
    block_run, block_size = _runs(block)
    around_run, around_size = _runs(block, around)
    cut = np.isin(block, at_cut)
    shared = (block_size[block_run] > 1) | cut
    alone = around_size[around_run] == 1
    has_open = np.bincount(block_run, alone | cut) > 0
    first = np.append(True, around_run[1:] != around_run[:-1])
    fate = np.where(alone, OPEN, np.where(has_open[block_run] & first, PARTNER, REPEATED))
    return np.where(shared, fate, 0).astype(np.uint8)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """For rows sorted by bucket: each bucket's chunks and keys."""
    at, who, keys = None, [], []
    for batch in batches:
        column = batch.column("keys")
        for i, (bucket, chunk) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("chunk").to_pylist())):
            if bucket != at:
                if who:
                    yield at, who, keys
                at, who, keys = bucket, [], []
            who.append(chunk)
            keys.append(column[i].as_py())
    if who:
        yield at, who, keys


def _dealt(sent: DataFrame) -> DataFrame:
    """Rows by bucket, the buckets dealt out evenly in turn."""
    parts = max(1, int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return sent.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")


def _release(df: DataFrame) -> None:
    """Have the driver's JVM collect what is out of use, so that Spark deletes the shuffle files of stages that are written.

    What the first collection finds is let go of by Spark's cleaner, which frees the rest for the second.
    """
    for _ in range(2):
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def rank_samples(sent: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Sort one bucket at a time and send each chunk the fates of its samples that share their block, by their surroundings."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, who, keys in _buckets(batches):
            sizes = np.array([len(k) // 12 for k in keys])
            around = np.concatenate([np.frombuffer(k, np.uint64, n) for k, n in zip(keys, sizes)])
            block = np.concatenate([np.frombuffer(k, np.uint32, n, 8 * n) for k, n in zip(keys, sizes)])
            owner = np.repeat(np.arange(len(who)), sizes)
            order = np.lexsort((around, block))
            fate = fates(block[order], around[order], cuts[max(bucket - 1, 0):bucket + 1, 1].astype(np.uint32))
            hit = np.flatnonzero(fate)
            hit = hit[np.argsort(owner[order[hit]], kind="stable")]
            around, fate, owner = around[order[hit]], fate[hit], owner[order[hit]]
            edges = np.searchsorted(owner, np.arange(len(who) + 1))
            rows = [(who[k], KEYS_KIND, around[i:j].tobytes(), fate[i:j].tobytes()) for k, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
            if rows:
                yield _batch(rows, _BACK)

    return _dealt(sent).mapInArrow(sort, _BACK)


def _marked(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True for the places that one of the spans covers."""
    steps = np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def spans_of(marked: np.ndarray) -> np.ndarray:
    """Rows (begin, end) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return edges.reshape(-1, 2)


def send_open(laid: DataFrame, ranked: DataFrame, cuts: np.ndarray, cover: Cover, length: int) -> DataFrame:
    """Keys of open suffixes, one row per chunk and bucket, and the spans that are sure, one row per chunk."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row, back in _by_chunk(batches):
            if not back:
                continue
            text, ends = zstandard.decompress(row["keys"].as_buffer()), np.frombuffer(row["spans"].as_buffer(), np.int64)
            around = np.concatenate([np.frombuffer(k, np.uint64) for _, k, _ in back])
            fate = np.concatenate([np.frombuffer(s, np.uint8) for _, _, s in back])
            order = np.lexsort((fate, around))
            around, fate = around[order], fate[order]
            found = samples(text, ends, cover, length, blocks=False)
            # Of the two fates that a doubled key may have, the greater one.
            at = np.searchsorted(around, found.around, "right") - 1
            own = np.where((at >= 0) & (around[at] == found.around), fate[at], 0)
            sure = ((own == REPEATED) | (own == PARTNER)) & (found.end - found.begin >= length)
            covered = _marked(len(text), found.begin[sure], found.end[sure])
            asked = (own >= OPEN) & (found.end - found.begin >= length)
            starts = np.flatnonzero(_marked(len(text), found.begin[asked], np.minimum(found.at[asked], found.end[asked] - length) + 1))
            rows = []
            if len(starts):
                lead = leading(np.frombuffer(text, np.uint8), starts)
                digest = xxhash.xxh3_128_digest
                wide = np.frombuffer(b"".join([digest(text[p:p + length]) for p in starts.tolist()]), np.uint64).reshape(-1, 2)
                high, low = wide[:, 0], wide[:, 1].astype(np.uint32)
                order = np.lexsort((low, high, lead))
                run, size = _runs(high[order], low[order])
                several = starts[order[size[run] > 1]]
                covered |= _marked(len(text), several, several + length)
                order = twice_at_most(order, high, low)
                edges = [0, *cut_points(cuts[:, :2], lead[order], high[order]).tolist(), len(order)]
                high, low, starts = high[order], low[order], starts[order].astype(np.uint32)
                rows = [(b, chunk, KEYS_KIND, high[i:j].tobytes() + low[i:j].tobytes() + starts[i:j].tobytes(), None)
                        for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
            rows.append((len(cuts) + 1 + chunk, chunk, SPANS_KIND, None, spans_of(covered).tobytes()))
            yield _batch(rows, _SENT)

    return _with_texts(laid, ranked).mapInArrow(send, _SENT)


def match_open(sent: DataFrame, buckets: int) -> DataFrame:
    """Sort one bucket at a time and send each chunk the places of its suffixes that have an equal; rows of spans pass through."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys_only() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind = batch.column("kind").to_numpy()
                through = batch.filter(pa.array(kind == SPANS_KIND))
                if len(through):
                    passed.append(through.select(["chunk", "kind", "keys", "spans"]))
                yield batch.filter(pa.array(kind == KEYS_KIND))

        passed: list[pa.RecordBatch] = []
        for _, who, keys in _buckets(keys_only()):
            sizes = np.array([len(k) // 16 for k in keys])
            high = np.concatenate([np.frombuffer(k, np.uint64, n) for k, n in zip(keys, sizes)])
            low, at = (np.concatenate([np.frombuffer(k, np.uint32, n, o * n) for k, n in zip(keys, sizes)]) for o in (8, 12))
            owner = np.repeat(np.arange(len(who)), sizes)
            order = np.lexsort((low, high))
            run, size = _runs(high[order], low[order])
            hit = order[size[run] > 1]
            hit = hit[np.argsort(owner[hit], kind="stable")]
            at, owner = at[hit], owner[hit]
            edges = np.searchsorted(owner, np.arange(len(who) + 1))
            rows = [(who[k], KEYS_KIND, at[i:j].tobytes(), None) for k, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
            if rows:
                yield _batch(rows, _BACK)
            yield from passed
            passed.clear()
        yield from passed

    return _dealt(sent).mapInArrow(sort, _BACK)


def cut_out(docs: DataFrame, min_length: int = MIN_LENGTH, cover: Cover = COVER, chunk: int = CHUNK,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``n_bytes``, ``spans`` (begin and end of each run of removed bytes) and ``kept`` (the other bytes, joined)."""
    if min_length < cover.modulus + _LEAD:
        raise ValueError("min_length must exceed the cover's modulus by 8 at least")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    laid = chunks(docs, cover, min_length, chunk, id_col, text_col)
    size = laid.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # At least three buckets a task, so that tasks even out.
    cuts = bucket_cuts(laid, max(3 * parts, size * len(cover.residues) // cover.modulus // BUCKET))
    ranked = materialise(rank_samples(send_samples(laid, cuts, cover, min_length), cuts), "ranks")
    _release(docs)
    matched = materialise(match_open(send_open(laid, ranked, cuts, cover, min_length), len(cuts) + 1), "matches")
    _release(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row, back in _by_chunk(batches):
            text, ends = zstandard.decompress(row["keys"].as_buffer()), np.frombuffer(row["spans"].as_buffer(), np.int64).tolist()
            begin, end = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for kind_, keys, spans in back:
                if kind_ == SPANS_KIND:
                    both = np.frombuffer(spans, np.int64).reshape(-1, 2)
                    begin.append(both[:, 0])
                    end.append(both[:, 1])
                else:
                    at = np.frombuffer(keys, np.uint32).astype(np.int64)
                    begin.append(at)
                    end.append(at + min_length)
            gone = _marked(len(text), np.concatenate(begin), np.concatenate(end))
            sizes, spans_, kept = [], [], []
            start = 0
            for stop in ends:
                runs = spans_of(gone[start:stop]).tolist()
                cuts_ = [0, *[x for r in runs for x in r], stop - start]
                kept.append(b"".join([text[start + i:start + j] for i, j in zip(cuts_[::2], cuts_[1::2])]))
                spans_.append([{"begin": i, "end": j} for i, j in runs])
                sizes.append(stop - start)
                start = stop
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            ids = row["ids"].values
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(spans_, span), pa.array(kept, pa.binary())],
                                             names=["_llm_id", "n_bytes", "spans", "kept"])

    done = _with_texts(laid, matched, with_ids=True)
    out = done.mapInArrow(cut, f"_llm_id {kind}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
    return out.withColumnRenamed("_llm_id", id_col)


def digests(cut: DataFrame) -> DataFrame:
    """``n_removed``, ``n_spans`` and ``kept_sha256`` in place of the spans and texts of ``cut_out``."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["begin"])
    return cut.withColumns({"n_removed": removed, "n_spans": F.size("spans").cast("bigint"), "kept_sha256": F.sha2("kept", 256)}).drop("spans", "kept")
