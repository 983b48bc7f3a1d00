"""Order-independent document fingerprints: a homomorphic multiset hash, in DataFrame functions only.

A text is the multiset of its paragraphs (lines, empty ones too).  Each paragraph is hashed to a wide vector of ``LANES`` 16-bit numbers
(sha-256 under four prefixes), and a fingerprint is the sum of these vectors modulo 2 ** 32 with the number of paragraphs.  The order of paragraphs
does not matter, and a paragraph is put in or taken out by adding or subtracting its vector.  As lanes are far wider than
what is added, a sum less its mean keeps its direction, and the cosine of two such directions estimates what share of their
paragraphs two texts have in common.

Scale: fingerprints are computed inside rows.  The neighbour of each document in id order takes one shuffle of the texts: rows are dealt to ranges
of ids (bounds from quantiles, one per range), and the first row of each range is dealt to the range before it as well, so no
join and no global sort is needed.  The driver sees bounds and first ids only, as many as there are ranges.

Defined cases: a null text counts as empty (one empty paragraph); rows that share an id follow each other in the order of their texts, so the
next of one may be its twin; rows without an id stand outside the order: they have no next document, their edited text
keeps the first half alone and ``near_next`` is null; the one row of a table is its own next; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 60
_PER_DIGEST = 15
_DIGESTS = LANES // _PER_DIGEST
_MODULUS = 1 << 32
_MEAN_2 = 65_535  # twice the mean of a lane's 16-bit number


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def with_vector(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the sum of its text's paragraph vectors modulo 2 ** 32 as array ``name``; the last element is their number.

    Each digest is read as five 48-bit numbers, and each of these as three lanes.  Every step is a projection of its own, so that an
    array is computed once and not wherever it is named.
    """
    def digest(k: int):
        return lambda p: F.sha2(F.concat(F.lit(f"{k}:"), p).cast("binary"), 256)

    def word(j: int):
        return lambda d: F.conv(F.substring(d, 12 * j + 1, 12), 16, 10).cast("bigint")

    def lane(shift: int):
        return lambda total, x: total + F.shiftright(x, shift).bitwiseAND(F.lit(65535))

    own = df.columns
    step = df.withColumn("_llm_parts", paragraphs(F.col(text)))
    step = step.select(*own, F.size("_llm_parts").cast("bigint").alias("_llm_count"),
                       *[F.transform("_llm_parts", digest(k)).alias(f"_llm_digest{k}") for k in range(_DIGESTS)])
    words = [(k, j) for k in range(_DIGESTS) for j in range(_PER_DIGEST // 3)]
    step = step.select(*own, "_llm_count", *[F.transform(f"_llm_digest{k}", word(j)).alias(f"_llm_word{k}_{j}") for k, j in words])
    lanes = [F.aggregate(f"_llm_word{k}_{j}", F.lit(0).cast("bigint"), lane(shift)) % _MODULUS for k, j in words for shift in (32, 16, 0)]
    return step.select(*own, F.array(*lanes, F.col("_llm_count")).alias(name))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint vector of the union of two multisets, or (``sign`` -1) of the first without the second."""
    last = F.size(a) - 1
    return F.transform(F.arrays_zip(a.alias("x"), b.alias("y")),
                       lambda e, i: F.when(i == last, e.x + sign * e.y).otherwise(F.pmod(e.x + sign * e.y, F.lit(_MODULUS))))


def written(v: Column) -> Column:
    """A vector as text."""
    return F.array_join(F.transform(v, lambda x: x.cast("string")), ".")


def centred(v: Column) -> Column:
    """Lanes less their mean, as signed numbers: twice the sum, less the number of paragraphs times twice the mean."""
    n = F.element_at(v, -1)
    return F.transform(F.slice(v, 1, LANES),
                       lambda x: (F.pmod(2 * x - n * _MEAN_2 + (_MODULUS >> 1), F.lit(_MODULUS)) - (_MODULUS >> 1)).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated likeness of two multisets from their centred vectors, 0 to 1; equal vectors give 1."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, e: s + e)

    cosine = dot(a, b) / F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(cosine, F.lit(0.0)))), 6))


def id_ranges(docs: DataFrame, id_col: str, ranges: int) -> tuple[Column, list[int], dict[int, int]]:
    """Range number of an id (0: the largest ids), and per range that is not empty the largest id, first range first."""
    known = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("_llm_id"))
    bounds = sorted({int(b) for b in known.approxQuantile("_llm_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges)}, reverse=True) if ranges > 1 else []
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    at = F.lit(0)
    if groups:
        # Whole groups of bounds above the id, then single ones in the group where it lies.
        coarse = F.size(F.filter(F.array(*[F.lit(g[-1]) for g in groups]), lambda b: b > F.col("_llm_id")))
        group = F.get(F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups]), coarse)
        at = coarse * step + F.coalesce(F.size(F.filter(group, lambda b: b > F.col("_llm_id"))), F.lit(0))
    heads = {r[0]: r[1] for r in known.groupBy(at.alias("_llm_range")).agg(F.max("_llm_id")).collect()}
    return at, sorted(heads), heads


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (``_llm_id``, others) with ``next_<c>`` of the next row in descending id order for each of ``columns``; the last is followed by the first."""
    spark = docs.sparkSession
    ranges = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at, order, heads = id_ranges(docs, "_llm_id", ranges)
    nothing = [F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns]
    without = docs.where("_llm_id IS NULL").select("*", *nothing)
    if not order:
        return without
    known = docs.where("_llm_id IS NOT NULL").withColumn("_llm_range", at.cast("int"))
    # The first row of a range is also the last of the range before it; that of the first range, of the last one.
    before = {r: order[i - 1] for i, r in enumerate(order)}
    ranges = range(order[-1] + 1)
    # A row looks at its own range's place in two arrays only, however many ranges there are.
    head = F.get(F.array(*[F.lit(heads.get(r)) for r in ranges]), F.col("_llm_range"))
    ahead = F.get(F.array(*[F.lit(before.get(r)) for r in ranges]), F.col("_llm_range"))
    placed = known.withColumn("_llm_before", F.when(F.col("_llm_id") == head, ahead))
    twice = F.when(F.col("_llm_before").isNotNull(), F.array(F.struct(F.col("_llm_range").alias("r"), F.lit(False).alias("g")),
                                                          F.struct(F.col("_llm_before").cast("int").alias("r"), F.lit(True).alias("g")))
                   ).otherwise(F.array(F.struct(F.col("_llm_range").alias("r"), F.lit(False).alias("g"))))
    placed = placed.withColumn("_llm_at", F.explode(twice)).select("*", F.col("_llm_at.r").alias("_llm_r"), F.col("_llm_at.g").alias("_llm_g"))
    along = Window.partitionBy("_llm_r").orderBy("_llm_g", F.col("_llm_id").desc(), "_llm_text")
    led = placed.select(*docs.columns, "_llm_g", *[F.lead(c).over(along).alias(f"next_{c}") for c in columns])
    return led.where("NOT _llm_g").drop("_llm_g").unionByName(without)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``."""
    picked = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_llm_text"))
    picked = with_vector(picked, "_llm_text", "_llm_v")
    led = with_next(picked, ["_llm_text", "_llm_v"])
    n = F.length("_llm_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("_llm_text", F.lit(1), n - half), F.substring(F.coalesce("next__llm_text", F.lit("")), F.lit(1), half))
    step = led.select("_llm_id", "_llm_v", F.col("next__llm_v").alias("_llm_w"), n.cast("bigint").alias("n_chars"), edited.alias("_llm_edited"))
    step = with_vector(step.withColumn("edited_sha256", F.sha2(F.col("_llm_edited").cast("binary"), 256)), "_llm_edited", "_llm_e")
    step = step.select("_llm_id", "n_chars", "edited_sha256", written(F.col("_llm_v")).alias("fingerprint"), written(F.col("_llm_e")).alias("edited_fingerprint"),
                       *[centred(F.col(c)).alias(f"{c}c") for c in ("_llm_v", "_llm_w", "_llm_e")])
    return step.select(F.col("_llm_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("_llm_vc"), F.col("_llm_ec")).alias("near_edited"),
                       F.when(F.col("_llm_wc").isNotNull(), likeness(F.col("_llm_vc"), F.col("_llm_wc"))).alias("near_next"))


def _vector_sql(text: str) -> str:
    return (f"list_transform(range({LANES}), lambda l: CAST(list_sum(list_transform(string_split({text}, chr(10)), "
            f"lambda p: CAST('0x' || substr(sha256(CAST(l // {_PER_DIGEST} AS VARCHAR) || ':' || p), CAST(l % {_PER_DIGEST} AS BIGINT) * 4 + 1, 4) AS BIGINT))) AS BIGINT) % {_MODULUS})")


def oracle() -> str:
    """SQL for ``fingerprints`` over ``documents`` with unique, known ids."""
    c = "list_transform({v}, lambda x: CAST(2 * x - {n} * 65535 AS DOUBLE))"
    near = ("CASE WHEN {a} = {b} THEN 1e0 ELSE round(least(1e0, greatest(0e0, coalesce(list_dot_product({a}, {b}) / "
            "nullif(sqrt(list_dot_product({a}, {a}) * list_dot_product({b}, {b})), 0), 0))), 6) END")
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    o AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS nt FROM d),
    e AS (SELECT doc_id, t, nt, length(t) AS n_chars, substr(t, 1, length(t) - length(t) // 2) || substr(nt, 1, length(t) // 2) AS ed FROM o),
    v AS (SELECT doc_id, n_chars, sha256(ed) AS edited_sha256, {_vector_sql('t')} AS vt, len(string_split(t, chr(10))) AS kt,
          {_vector_sql('ed')} AS ve, len(string_split(ed, chr(10))) AS ke, {_vector_sql('nt')} AS vn, len(string_split(nt, chr(10))) AS kn FROM e),
    c AS (SELECT *, {c.format(v='vt', n='kt')} AS ct, {c.format(v='ve', n='ke')} AS ce, {c.format(v='vn', n='kn')} AS cn FROM v)
    SELECT doc_id, n_chars, edited_sha256, array_to_string(vt, '.') || '.' || kt AS fingerprint, array_to_string(ve, '.') || '.' || ke AS edited_fingerprint,
           {near.format(a='ct', b='ce')} AS near_edited, {near.format(a='ct', b='cn')} AS near_next
    FROM c"""
