"""How far each source's use of words lies from its language's and from other sources', by iceberg prefix refinement.

A language keeps the terms that at least ``threshold`` of its documents hold.  They are found level by level: the documents that
hold a term with a given prefix are counted for prefixes of 4 bytes, prefixes below the threshold go with all their terms, and those that stay
are extended to 8, 16, 32 bytes and so on, until every term left is complete.  A prefix is cut at bytes; a term shorter than the level
ends in a zero byte, which no term holds, and is complete there.

A pass over the texts writes, for each part of the input, its distinct (language, term, level) with the number of documents, where the level is the
first at which no other term seen in the same document has the term's prefix.  A document thus counts once for every prefix, by one of
its terms, and counts can be added up at any level.  A second pass counts the uses of the terms kept, by language and source.

Scale: both passes add up before anything is shuffled, so a word that all documents hold is one row per part.  Each level groups by
prefix with partial sums.  What a level keeps reaches the next one as a bit table of fixed size (``BITS`` bits, broadcast), and so do the kept
terms the second pass; what passes by chance is counted as exactly as the rest, and an exact join follows, so the table's size bears on cost alone.
Pairs of sources are summed in matrices per part of the terms, as the result has a row for each pair of sources in any case.

Defined cases: null text, language and source are ''; every row is a document, also a repeated one; a language without kept terms has
its pairs with value 0 and no terms; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.llm.common import written
from trackmill.session import materialise

#: What each byte of a text stands for: itself within a term (A-Z as a-z), and a blank between terms.
_BYTES = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
FIRST_LEVEL = 4
#: Size of the table that tells which prefixes a level has kept.
BITS = 1 << 24
#: Distinct rows that a task holds before it passes them on.
HELD = 600_000
#: Copies of the list of a language's sources, so that the terms of one language are joined in several tasks.
SALTS = 32
#: Cells of source pairs that a task holds before it passes them on.
CELLS = 2_000_000
SCALE = 1_000_000_000
PRIOR = 5

_HASH_SEED = 42  # of Spark's xxhash64
_SEEN = "lang string, term binary, level int, docs bigint"
_USES = "lang string, source string, term binary, uses bigint"


def level_length(level: int) -> int:
    return FIRST_LEVEL << level


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text in UTF-8: runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``, A-Z lower-cased."""
    return text.translate(_BYTES).split()


def _columns(docs: DataFrame, **columns: str) -> DataFrame:
    """The named columns as strings, null as ''; ``text`` as bytes."""
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).cast("binary" if n == "text" else "string").alias(n)
                         for n, c in columns.items()])


def seen_terms(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Written table of ``lang``, ``term`` (bytes), ``level`` and ``docs``, added up within parts of the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[dict[bytes, int]]] = {}

        def deeper(term: bytes, prefixes: set[bytes], levels: list[dict[bytes, int]]) -> dict[bytes, int]:
            """The counts of the term's level; its longer prefixes join the document's."""
            level, length = 0, FIRST_LEVEL
            while len(term) >= length and term[:length] in prefixes:
                level, length = level + 1, 2 * length
            while len(term) >= length:
                prefixes.add(term[:length])
                length *= 2
            while len(levels) <= level:
                levels.append(defaultdict(int))
            return levels[level]

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, levels in held.items():
                for level, group in enumerate(levels):
                    n = len(group)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array(list(group), pa.binary()), pa.array(np.full(n, level, np.int32)),
                         pa.array(list(group.values()), pa.int64())], names=["lang", "term", "level", "docs"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                levels = held.setdefault(lang, [defaultdict(int)])
                first = levels[0]
                prefixes: set[bytes] = set()
                for term in set(terms_of(text.as_py())):
                    start = term[:FIRST_LEVEL]
                    # Most terms are the first of their prefix and shorter than the third level.
                    if start in prefixes or len(term) >= 4 * FIRST_LEVEL:
                        deeper(term, prefixes, levels)[term] += 1
                        continue
                    prefixes.add(start)
                    if len(term) >= 2 * FIRST_LEVEL:
                        prefixes.add(term[:2 * FIRST_LEVEL])
                    first[term] += 1
                if sum(sum(map(len, x)) for x in held.values()) > HELD:
                    yield from flush()
        yield from flush()

    return written(_columns(docs, lang=lang_col, text=text_col).mapInArrow(count, _SEEN), "seen-terms")


def prefix(term: Column, length: int) -> Column:
    """The first ``length`` bytes of a term; a shorter term whole, with the zero byte that ends it."""
    return F.when(F.octet_length(term) < length, F.concat(term, F.lit(b"\0"))).otherwise(F.substring(term, 1, length))


def _place(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(BITS))


def bit_table(keys: DataFrame, *cols: str) -> DataFrame:
    """``_llm_word``, ``_llm_bits``: which of ``BITS`` places the keys hash to, 64 a row."""
    placed = keys.select(_place(*map(F.col, cols)).alias("_llm_place"))
    bit = F.expr("shiftleft(1L, cast(_llm_place % 64 as int))")
    return placed.groupBy(F.shiftright("_llm_place", 6).alias("_llm_word")).agg(F.bit_or(bit).alias("_llm_bits"))


def passing(rows: DataFrame, table: DataFrame, *cols: Column) -> DataFrame:
    """Rows whose key's place is set in a bit table; the table has ``BITS`` / 64 rows at most."""
    place = _place(*cols)
    hit = (F.expr("shiftright(_llm_bits, cast(_llm_at as int))").bitwiseAND(F.lit(1))) == 1
    return (rows.withColumns({"_llm_word": F.shiftright(place, 6), "_llm_at": place % 64})
            .join(F.broadcast(table), "_llm_word").where(hit).drop("_llm_word", "_llm_at", "_llm_bits"))


def term_uses(docs: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang``, ``source``, ``term`` and ``uses`` of kept terms and a few others that hash like them, added up within parts of the input."""
    bits = np.zeros(BITS // 64, dtype=np.int64)
    for word, value in bit_table(kept, "lang", "term").toPandas().itertuples(index=False):
        bits[word] = value
    likely = bits.astype("<i8").tobytes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), group in held.items():
                seed = xxhash.xxh64_intdigest(lang.encode(), _HASH_SEED)
                places = [xxhash.xxh64_intdigest(term, seed) % BITS for term in group]
                hits = [(term, n) for (term, n), place in zip(group.items(), places) if likely[place >> 3] >> (place & 7) & 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(hits), pa.string()), pa.array([source] * len(hits), pa.string()), pa.array([t for t, _ in hits], pa.binary()),
                     pa.array([n for _, n in hits], pa.int64())], names=["lang", "source", "term", "uses"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                held[lang, source].update(terms_of(text.as_py()))
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return _columns(docs, lang=lang_col, source=source_col, text=text_col).mapInArrow(count, _USES)


def kept_terms(seen: DataFrame, threshold: int = 30) -> DataFrame:
    """Written table of ``lang`` and ``term``: the terms in at least ``threshold`` documents of a language."""
    kept, level, rows = None, 0, seen
    while True:
        length = level_length(level)
        counted = (rows.where(F.col("level") <= level).groupBy("lang", prefix(F.col("term"), length).alias("prefix"))
                   .agg(F.sum("docs").alias("docs")).where(F.col("docs") >= threshold))
        counted = materialise(counted.select("lang", "prefix"), "prefixes")
        ended = F.substring(F.col("prefix"), -1, 1) == F.lit(b"\0")
        complete = counted.where(ended).select("lang", F.expr("substring(prefix, 1, octet_length(prefix) - 1)").alias("term"))
        kept = complete if kept is None else kept.unionByName(complete)
        still = counted.where(~ended)
        if still.isEmpty():
            return kept
        rows = passing(seen.where(F.octet_length("term") >= length), materialise(bit_table(still, "lang", "prefix"), "prefix-bits"),
                       F.col("lang"), prefix(F.col("term"), length))
        level += 1


def probability(count: Column, total: Column, terms: Column) -> Column:
    """p of the contract, exact at any size."""
    wide = "decimal(38,0)"
    over = (F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(27,0)")).cast(wide)
    return F.lit(1) + F.call_function("div", over, (total + PRIOR * terms).cast(wide))


def _distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of absolute differences between the probabilities of each two sources, over the terms of a part of the input."""
    held: dict[str, tuple[list[str], np.ndarray]] = {}

    def flush() -> pd.DataFrame:
        out = []
        for lang, (names, sums) in held.items():
            a, b = np.nonzero(~np.eye(len(names), dtype=bool))
            names = np.array(names, dtype=object)
            out.append(pd.DataFrame({"lang": lang, "source": names[a], "item": names[b], "value": sums[a, b]}))
        return pd.concat(out)

    for batch in batches:
        for lang, part in batch.groupby("lang"):
            names = list(part["sources"].iloc[0])
            place = {s: k for k, s in enumerate(names)}
            wide = any(max(n) > 2**33 for n in part["uses"])  # SCALE times it would not fit
            counts = np.zeros((len(part), len(names)), dtype=object if wide else np.int64)
            for row, used_by, uses in zip(counts, part["used_by"], part["uses"]):
                row[[place[s] for s in used_by]] = uses
            over = np.array(part["totals"].iloc[0], dtype=counts.dtype) + PRIOR * int(part["terms"].iloc[0])
            p = (1 + SCALE * (counts + PRIOR) // over).astype(np.int64)
            if lang not in held:
                held[lang] = names, np.zeros((len(names), len(names)), dtype=np.int64)
            sums = held[lang][1]
            for k in range(len(names)):
                sums[k] += np.abs(p - p[:, k:k + 1]).sum(axis=0)
            if sum(s.size for _, s in held.values()) > CELLS:
                yield flush()
                held.clear()
    if held:
        yield flush()


def audit(docs: DataFrame, threshold: int = 30, top: int = 50,
          lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: the ``top`` terms that a source uses more than its language, and its distance from each other source."""
    kept = kept_terms(seen_terms(docs, lang_col, text_col), threshold)
    groups = _columns(docs, lang=lang_col, source=source_col).distinct()
    uses = term_uses(docs, kept, lang_col, source_col, text_col)
    used = written(uses.groupBy("lang", "source", "term").agg(F.sum("uses").alias("uses")).join(kept, ["lang", "term"]), "kept-uses")

    totals = materialise(
        groups.join(used.groupBy("lang", "source").agg(F.sum("uses").alias("total")), ["lang", "source"], "left")
        .join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")), "totals")

    whole = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    lang_uses = used.groupBy("lang", "term").agg(F.sum("uses").alias("lang_uses"))
    own = probability(F.col("uses"), F.col("total"), F.col("terms"))
    common = probability(F.col("lang_uses"), F.col("lang_total"), F.col("terms"))
    in_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (used.join(lang_uses, ["lang", "term"]).join(totals.join(whole, "lang"), ["lang", "source"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (own - common).alias("value"))
             .where(F.col("value") > 0)
             .withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= top))

    listed = (totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"), F.max("terms").alias("terms"))
              .select("lang", "terms", F.col("groups.source").alias("sources"), F.col("groups.total").alias("totals"),
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_llm_salt")))
    by_term = used.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "uses")).alias("found"))
    dense = by_term.withColumn("_llm_salt", F.pmod(F.hash("term"), F.lit(SALTS))).join(listed, ["lang", "_llm_salt"])
    columns = dense.select("lang", "sources", "totals", "terms", F.col("found.source").alias("used_by"), F.col("found.uses").alias("uses"))
    summed = columns.mapInPandas(_distances, "lang string, source string, item string, value bigint")
    bare = totals.where(F.col("terms") == 0).select("lang", "source")
    nothing = (bare.join(bare.withColumnRenamed("source", "item"), "lang").where(F.col("source") != F.col("item"))
               .withColumn("value", F.lit(0).cast("bigint")))
    pairs = (summed.unionByName(nothing).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(in_group)))
    return terms.unionByName(pairs)


def oracle(threshold: int = 30, top: int = 50) -> str:
    """The same in SQL, by counting every term's documents."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    p = f"1 + ({SCALE}::HUGEINT * ({{}} + {PRIOR})) // ({{}} + {PRIOR} * v)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{pattern}') AS terms FROM documents),
u AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM u GROUP BY lang, term HAVING count(DISTINCT row) >= {threshold}),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM g) LEFT JOIN k USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM u JOIN k USING (lang, term) GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v.v,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term) AS lang_n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS lang_total
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, {p.format('n', 'total')} AS p, {p.format('lang_n', 'lang_total')} AS q FROM grid),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
parts AS (SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
