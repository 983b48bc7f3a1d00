"""Near-duplicate detection with HyperMinHash sketches, confirmed on full shingle sets.

A text's set is its distinct word 5-grams.  Its sketch has 256 buckets; each keeps the smallest hash that falls into it, compressed to
the count of leading zeros and eight mantissa bits.  Buckets that stay empty are filled by a second hash of all shingles, and
what is still empty then by a hash of its own, so that small sets have full sketches too and two registers agree with
just the Jaccard similarity (plus chance hits of the compression, which the estimate subtracts).  Bands of five registers
give candidates; their similarity is estimated from the registers, and what may reach the threshold is confirmed on the full sets.

No bucket of a band is expanded into all of its pairs.  Texts with equal sets are first one node.  Then a band bucket links each
member to one leader; after confirmed links have been joined to components, only buckets that still hold several components are gone
through again: members outside a bucket's largest component are compared by registers with all others, in blocks of bounded size, and
only confirmed links that join components leave a task.  Each pair of a bucket is so either inside one component or compared.

Scale: the written sketch table has some 0.6 kB a text; bands shuffle 16 bytes each; full texts move once, and only those in a
bucket of two or more.  Joins on a hot bucket, leader or copy are plain sort-merge joins, which run-time skew handling may
split, below aggregates that partitions begin.  Components are found by alternating star steps over links in
written tables; nothing but counts comes to the driver.

Defined cases: a null text, or one without words, has no set (``n_shingles`` 0) and is linked with nothing; rows that share an id are one
document (linked, each with its own set size); rows without an id are never linked: their component is null and they are kept; repeated
rows come out repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import spread_join, written
from trackmill.session import materialise

BUCKETS = 256
MANTISSA = 8
ROWS = 5
BANDS = 40
#: Members of a band bucket, and strays, that one block compares, and shingles that they may have together.
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
#: Hashes that a confirming task remembers of texts it may meet again: 32 MB.
REMEMBERED = 4_000_000
_U = np.uint64
_VALUE_BITS = 56
_BASES = np.arange(BUCKETS, dtype=_U) << _U(_VALUE_BITS)
_LOW = (_U(1) << _U(_VALUE_BITS)) - _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEEDS = _mix((np.arange(BUCKETS, dtype=_U) + _U(1)) * _U(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text, A-Z lower-cased; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=_U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=_U, count=n)
    short = n < width
    span = n if short else width
    total = np.full(n - span + 1, span, dtype=_U)
    for k in range(span):
        total = _mix(total * _U(0x9E3779B97F4A7C15) + h[k:n - span + 1 + k])
    return np.unique(total)


def _first(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: which buckets (top 8 bits) are filled, and the smallest rest in each."""
    at = np.searchsorted(values, _BASES)
    got = values[np.minimum(at, len(values) - 1)]
    return (at < len(values)) & (got >> _U(_VALUE_BITS) == np.arange(BUCKETS, dtype=_U)), got & _LOW


def _compressed(value: np.ndarray, stage: int) -> np.ndarray:
    """Stage (two bits), leading zeros (six) and mantissa (eight) of 56-bit values."""
    length = np.frexp((value >> _U(4)).astype(np.float64))[1].astype(np.int64) + 4
    length = np.where(length == 4, 4, length)
    zeros = (_VALUE_BITS - length).astype(_U)
    mantissa = ((value << (zeros + _U(1))) & _LOW) >> _U(_VALUE_BITS - MANTISSA)
    return ((_U(stage) << _U(6 + MANTISSA)) | (zeros << _U(MANTISSA)) | mantissa).astype("<u2")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """256 registers of a non-empty set, of two bytes each."""
    filled, value = _first(shingles)
    out = _compressed(value, 0)
    if not filled.all():
        again, value = _first(np.sort(_mix(shingles + _U(0x632BE59BD9B4E019))))
        out = np.where(filled, out, _compressed(value, 1))
        empty = np.flatnonzero(~(filled | again))
        if len(empty):
            best = np.full(len(empty), _LOW, dtype=_U)
            for part in np.array_split(shingles, len(shingles) // 4096 + 1):
                best = np.minimum(best, (_mix(part[:, None] ^ _SEEDS[empty]) & _LOW).min(axis=0))
            out[empty] = _compressed(best, 2)
    return out


def chance_hits(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Expected share of registers of disjoint sets that agree by chance, from the sizes of the sets.

    Inside one count of leading zeros, mantissas are close to even: registers of sets of sizes a and b agree with the sum over counts of
    P(count | a) * P(count | b), divided by the number of mantissas.
    """
    edge = 2.0 ** -np.arange(_VALUE_BITS + 1)
    share = []
    for n in (n_a, n_b):
        load = np.maximum(np.asarray(n, dtype=np.float64) / BUCKETS, 1.0)[:, None]
        above = (1 - edge[None, :]) ** load
        share.append(np.diff(above, axis=1))
    return (share[0] * share[1]).sum(axis=1) / (1 << MANTISSA)


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers (rows), corrected for chance hits."""
    hits = (regs_a == regs_b).mean(axis=1)
    c = chance_hits(n_a, n_b)
    return np.maximum(0.0, (hits - c) / (1 - c))


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.pop("_llm_text")]
        batch["n_shingles"] = [len(s) for s in sets]
        batch["_llm_set"] = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]
        batch["_llm_regs"] = [sketch(s).tobytes() if len(s) else None for s in sets]
        yield batch


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place = np.arange(1, BANDS + 1, dtype=_U) * _U(0xD1B54A32D192ED03)
    for batch in batches:
        if not len(batch):
            continue
        regs = np.frombuffer(b"".join(batch["_llm_regs"]), dtype="<u2").reshape(len(batch), BUCKETS)
        key = np.broadcast_to(place, (len(batch), BANDS)).copy()
        number = np.tile(np.arange(BANDS, dtype=np.int32), len(batch))
        for k in range(ROWS):
            key = _mix(key * _U(0x9E3779B97F4A7C15) + regs[:, k * BANDS:(k + 1) * BANDS].astype(_U))
        yield pd.DataFrame({"_llm_band": key.ravel().view(np.int64), "_llm_k": number, "_llm_node": np.repeat(batch["_llm_node"].to_numpy(), BANDS)})


def _probable(threshold: float, slack: float):
    """Keep pairs whose estimate, ``slack`` deviations up, reaches the threshold, and whose sizes allow it."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n_a, n_b = batch["_llm_na"].to_numpy(), batch["_llm_nb"].to_numpy()
            batch = batch[np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9]
            if not len(batch):
                continue
            regs = [np.frombuffer(b"".join(batch[c]), dtype="<u2").reshape(len(batch), -1) for c in ("_llm_ra", "_llm_rb")]
            got = estimate(*regs, batch["_llm_na"].to_numpy(), batch["_llm_nb"].to_numpy())
            least = threshold - slack * np.sqrt(threshold * (1 - threshold) / regs[0].shape[1])
            yield batch.loc[got >= least, ["_llm_a", "_llm_b"]]

    return keep


def _across(percent: int, slack: float):
    """Of rows in order of (band, i, j): links between a stray and another member that join different components.

    A pair that shares several bands is looked at in the first of them only, and not at all where links of the same block have already joined its
    components.  What the registers leave possible is confirmed on the full sets.
    """
    threshold = percent / 100
    least = threshold - slack * np.sqrt(threshold * (1 - threshold) / BUCKETS)

    def links(block: pd.DataFrame) -> list[tuple[int, int]]:
        node, n = block["_llm_node"].to_numpy(), block["n_shingles"].to_numpy()
        names, root = np.unique(block["_llm_root"].to_numpy(), return_inverse=True)
        joined = np.arange(len(names))  # of each component, the one it has been joined to
        odd, is_member = block["_llm_stray"].to_numpy(), block["_llm_member"].to_numpy()
        regs = np.frombuffer(b"".join(block["_llm_regs"]), dtype="<u2").reshape(len(block), BUCKETS)
        texts, sets = block["_llm_text"].to_numpy(), {}
        members, k = np.flatnonzero(is_member), int(block["_llm_k"].iloc[0])
        found = []
        for x in np.flatnonzero(~is_member):
            m = members[(joined[root[members]] != joined[root[x]]) & (~odd[members] | (node[members] > node[x]))]
            m = m[np.minimum(n[m], n[x]) >= threshold * np.maximum(n[m], n[x]) - 1e-9]
            if not len(m):
                continue
            same = regs[m] == regs[x]
            first = same[:, :ROWS * BANDS].reshape(len(m), ROWS, BANDS).all(axis=1).argmax(axis=1) == k
            hits, c = same.mean(axis=1), chance_hits(n[m], np.full(len(m), n[x]))
            near = (hits - c) / (1 - c)
            able = first & (near >= least)
            for y in m[able][np.argsort(-near[able], kind="stable")]:
                if joined[root[x]] == joined[root[y]]:
                    continue
                for i in (x, y):
                    if i not in sets:
                        sets[i] = shingle_set(texts[i])
                if linked(sets[x], sets[y], percent):
                    found.append((min(node[x], node[y]), max(node[x], node[y])))
                    joined[joined == joined[root[x]]] = joined[root[y]]
        return found

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            keys = rows[["_llm_band", "_llm_i", "_llm_j"]].to_numpy()
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)]
            held = rows.iloc[starts[-1]:]
            yield collected(rows, starts)
        if held is not None:
            yield collected(held, [0, len(held)])

    def collected(rows: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        found = [pair for a, b in zip(starts, starts[1:]) for pair in links(rows.iloc[a:b])]
        return pd.DataFrame(found, columns=["_llm_a", "_llm_b"], dtype="int64")

    return keep


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of two sorted sets with something in common."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    if not len(small):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(percent: int):
    """Pairs of texts with 100 * intersection >= percent * union."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, np.ndarray] = {}
        held = 0

        def of(text: str) -> np.ndarray:
            nonlocal held
            if text not in known:
                if held > REMEMBERED:
                    known.clear()
                    held = 0
                known[text] = shingle_set(text)
                held += len(known[text]) + 100
            return known[text]

        for batch in batches:
            good = [linked(of(a), of(b), percent) for a, b in zip(batch["_llm_ta"], batch["_llm_tb"])]
            yield batch.loc[good, ["_llm_a", "_llm_b"]]

    return keep


def components(links: DataFrame, a: str, b: str, rounds: int = 50) -> DataFrame:
    """``_llm_node`` and ``_llm_root``: the smallest node reachable, for each node of ``links``.

    Alternating star steps: every node hands its larger neighbours, then its smaller ones, to the smallest node it knows.  It ends when
    a round changes nothing; the number of rounds grows with the logarithm of the longest path, ``rounds`` only guards against a
    lost invariant and raises.
    """
    link = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    link = materialise(link, "links")
    before = None
    for _ in range(rounds):
        both = link.select("u", "v").union(link.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # The centre of a star is the smaller end of very many links.
        large = spread_join(both.where("v > u"), least, "u", "v", link.select(F.col("v").alias("u"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.where("u <> v").groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        link = materialise(step.where("u <> v").distinct(), "links")
        state = link.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return link.select(F.col("u").alias("_llm_node"), F.col("v").alias("_llm_root")).union(
                link.select(F.col("v").alias("_llm_node"), F.col("v").alias("_llm_root")).distinct())
        before = state
    raise RuntimeError("links did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, slack: float = 4.0) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (smallest linked id) and ``kept`` (the row's id is that)."""
    picked = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_text"))
    rows = written(
        picked.mapInPandas(_sketches, "_llm_id bigint, n_shingles bigint, _llm_set string, _llm_regs binary"), "sketches")
    known = rows.where("_llm_id IS NOT NULL AND _llm_set IS NOT NULL")
    # Texts with equal sets are one node, named by their smallest id.
    node_of = known.groupBy("_llm_set").agg(F.min("_llm_id").alias("_llm_node"))
    nodes = materialise(
        known.select("_llm_id", "_llm_set", "n_shingles", "_llm_regs").join(
            node_of.withColumnRenamed("_llm_set", "_llm_node_set"),
            (F.col("_llm_set") == F.col("_llm_node_set")) & (F.col("_llm_id") == F.col("_llm_node")))
        .select("_llm_node", "n_shingles", "_llm_regs").dropDuplicates(["_llm_node", "n_shingles", "_llm_regs"]), "nodes")
    band = nodes.select("_llm_node", "_llm_regs").mapInPandas(_bands, "_llm_band bigint, _llm_k int, _llm_node bigint")
    # The leader of a bucket is its member nearest to the band key, bit for bit: another one in each band.
    mask = F.col("_llm_band").bitwiseAND(F.lit((1 << 62) - 1))
    lead = (band.groupBy("_llm_band").agg(F.min(F.col("_llm_node").bitwiseXOR(mask)).alias("_llm_m"), F.count("*").alias("_llm_c"))
            .where("_llm_c > 1").select("_llm_band", F.col("_llm_m").bitwiseXOR(mask).alias("_llm_leader")))
    shared = materialise(band.join(lead, "_llm_band"), "bands")
    pairs = materialise(
        shared.where("_llm_node <> _llm_leader")
        .select(F.least("_llm_node", "_llm_leader").alias("_llm_a"), F.greatest("_llm_node", "_llm_leader").alias("_llm_b")).distinct(), "pairs")
    # Only texts in a shared bucket are ever compared; they are written once.
    wanted = shared.select(F.col("_llm_node").alias("_llm_id")).distinct()
    texts = materialise(picked.where("_llm_text IS NOT NULL").join(wanted, "_llm_id", "left_semi"), "texts")

    def side(x: str, name: str) -> DataFrame:
        return nodes.select(F.col("_llm_node").alias(f"_llm_{x}"), F.col("n_shingles").alias(f"_llm_n{x}"),
                            F.col("_llm_regs").alias(name))

    def probable(candidates: DataFrame) -> DataFrame:
        # The leader of a large bucket is in very many pairs.
        both = spread_join(candidates, side("a", "_llm_ra"), "_llm_a", "_llm_b")
        both = spread_join(both, side("b", "_llm_rb"), "_llm_b", "_llm_a", candidates)
        return both.mapInPandas(_probable(percent / 100, slack), "_llm_a bigint, _llm_b bigint").distinct()

    def confirmed(candidates: DataFrame) -> DataFrame:
        ta = texts.select(F.col("_llm_id").alias("_llm_a"), F.col("_llm_text").alias("_llm_ta"))
        tb = texts.select(F.col("_llm_id").alias("_llm_b"), F.col("_llm_text").alias("_llm_tb"))
        both = spread_join(spread_join(candidates, tb, "_llm_b", "_llm_a"), ta, "_llm_a", "_llm_b", candidates).select("_llm_a", "_llm_b", "_llm_ta", "_llm_tb")
        return both.mapInPandas(_confirmed(percent), "_llm_a bigint, _llm_b bigint")

    # Rows that share an id are linked through it, whatever their sets.
    sets_of = spread_join(known.select("_llm_id", "_llm_set"), node_of, "_llm_set", "_llm_id").select("_llm_id", "_llm_node")
    by_id = sets_of.where("_llm_id <> _llm_node").select(F.col("_llm_id").alias("_llm_a"), F.col("_llm_node").alias("_llm_b"))
    tried = materialise(probable(pairs), "tried")
    links = written(confirmed(tried).union(by_id), "confirmed")
    root = components(links, "_llm_a", "_llm_b")
    # Buckets that still hold several components: pairs across them.
    size_of = nodes.groupBy("_llm_node").agg(F.max("n_shingles").alias("_llm_size"))
    tagged = shared.join(root, "_llm_node", "left").select("_llm_band", "_llm_k", "_llm_node", F.coalesce("_llm_root", "_llm_node").alias("_llm_root"))
    per_root = tagged.join(size_of, "_llm_node").groupBy("_llm_band", "_llm_root").agg(F.count("*").alias("count"), F.sum("_llm_size").alias("_llm_size"))
    split = (per_root.groupBy("_llm_band")
             .agg(F.sum("count").alias("_llm_g"), F.max(F.struct("count", "_llm_root")).alias("_llm_m"), F.count("*").alias("_llm_c"), F.sum("_llm_size").alias("_llm_size"))
             .where("_llm_c > 1"))
    many = F.col("_llm_size") / BLOCK_SHINGLES
    split = split.select("_llm_band", F.col("_llm_m._llm_root").alias("_llm_main"),
                         F.ceil(F.greatest(F.col("_llm_g") / BLOCK, many)).cast("int").alias("_llm_nm"),
                         F.ceil(F.greatest((F.col("_llm_g") - F.col("_llm_m.count")) / BLOCK, many)).cast("int").alias("_llm_ns"))
    left = materialise(tagged.join(split, "_llm_band").withColumn("_llm_stray", F.col("_llm_root") != F.col("_llm_main")), "split-buckets")
    place = F.xxhash64("_llm_node")
    told = ["_llm_band", "_llm_k", "_llm_node", "_llm_root", "_llm_stray"]
    member = left.select(*told, F.lit(True).alias("_llm_member"), F.pmod(place, "_llm_nm").cast("int").alias("_llm_i"),
                         F.explode(F.sequence(F.lit(0), F.col("_llm_ns") - 1)).alias("_llm_j"))
    stray = left.where("_llm_stray").select(*told, F.lit(False).alias("_llm_member"), F.explode(F.sequence(F.lit(0), F.col("_llm_nm") - 1)).alias("_llm_i"),
                                            F.pmod(place, "_llm_ns").cast("int").alias("_llm_j"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    full = texts.select(F.col("_llm_id").alias("_llm_node"), "_llm_text")
    blocks = (member.union(stray).join(nodes, "_llm_node").join(full, "_llm_node").repartition(parts, "_llm_band", "_llm_i", "_llm_j")
              .sortWithinPartitions("_llm_band", "_llm_i", "_llm_j"))
    more = written(blocks.mapInPandas(_across(percent, slack), "_llm_a bigint, _llm_b bigint").distinct(), "confirmed")
    if not more.isEmpty():
        root = components(links.union(more), "_llm_a", "_llm_b")
    root = root.select(F.col("_llm_node").alias("_llm_id"), "_llm_root")
    out = rows.join(root, "_llm_id", "left")
    component = F.coalesce("_llm_root", "_llm_id")
    return out.select(F.col("_llm_id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("_llm_id") == component, F.lit(True)).alias("kept"))


def _unordered(kind: T.DataType) -> bool:
    """Whether values of a type cannot be compared."""
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with the columns of ``docs``; of rows of the kept id the one with the smallest text stays, rows without an id all stay.

    Rows of one id and text that differ elsewhere are told apart by their other columns, as far as these can be ordered.
    """
    kept = near_duplicates(docs, id_col, text_col).where("kept").select(F.col(f"`{id_col}`").alias("_llm_kept_id")).where("_llm_kept_id IS NOT NULL")
    known = docs.where(F.col(f"`{id_col}`").isNotNull()).join(kept, F.col(f"`{id_col}`") == F.col("_llm_kept_id"), "left_semi")
    ordered = [f.name for f in docs.schema if f.name not in (id_col, text_col) and not _unordered(f.dataType)]
    rank = F.struct(*[F.col(f"`{c}`") for c in (text_col, *ordered)])
    first = known.groupBy(F.col(f"`{id_col}`").alias("_llm_id")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), rank).alias("_llm_first"))
    return first.select("_llm_first.*").unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
