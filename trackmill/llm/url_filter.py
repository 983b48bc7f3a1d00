"""URL filter: host rules, and a weighted vocabulary found by an Aho-Corasick automaton.

Host rules come first: a rule names a host (and all its subdomains) and the path it starts with, and the longest that fits decides.  Where
none fits, the vocabulary does: one automaton over all terms runs through the lower-cased host and path once (a query string such as ``ref=x`` says
nothing of the page), a term counts where neither neighbour is a letter or digit, and a url is blocked for one strict term or for ``soft_limit``
distinct soft terms.  The terms are a parameter; ``vocabulary`` reads them from a table with a weight for each.

Scale: a map over rows; the automaton is built once per task from its parameter, of ``MOST_TERMS`` terms at most.  No shuffle.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and has no terms, so it is allowed; repeated
rows are judged one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdict and rule (host/path prefix).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MOST_TERMS = 1_000_000
STRICT = ("porn", "xxx", "casino", "viagra", "escort", "hentai", "warez", "torrent", "pills", "spam", "malware", "phishing")
SOFT = ("adult", "bet", "bets", "win", "free", "cheap", "ads", "track", "sex", "poker", "lottery", "loan", "crack", "hack", "nude", "dating", "x")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of verdict and rule; null where none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, start = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def automaton(strict=STRICT, soft=SOFT):
    a = ahocorasick.Automaton()
    for kind, terms in (("strict", strict), ("soft", soft)):
        for t in terms:
            a.add_word(t, (kind, t))
    a.make_automaton()
    return a


def vocabulary(terms: DataFrame, strict_from: float = 1.0, term_col: str = "term", weight_col: str = "weight") -> dict[str, tuple[str, ...]]:
    """``strict`` and ``soft`` terms, for ``judge(..., **vocabulary(table))``: those with a weight of ``strict_from`` or more are strict, other positive ones soft.

    Terms are lower-cased; of one that is given twice the larger weight counts; null and empty ones, and such without a positive weight, are left
    out.  A table of more than ``MOST_TERMS`` terms is refused, as tasks hold the automaton in memory.
    """
    term = F.lower(F.col(f"`{term_col}`"))
    kept = terms.where((F.length(term) > 0) & (F.col(f"`{weight_col}`") > 0)).groupBy(term.alias("term")).agg(F.max(F.col(f"`{weight_col}`")).alias("weight"))
    rows = kept.limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    return {"strict": tuple(sorted(r.term for r in rows if r.weight >= strict_from)), "soft": tuple(sorted(r.term for r in rows if r.weight < strict_from))}


def terms_in(url: str, a) -> tuple[list[str], list[str]]:
    """Strict and soft terms in a host and path, each distinct one once, sorted."""
    text = url.lower()
    if not len(a):
        return [], []
    found = {"strict": set(), "soft": set()}
    for end, (kind, term) in a.iter(text):
        start = end - len(term) + 1
        if (start == 0 or not text[start - 1].isalnum()) and (end + 1 == len(text) or not text[end + 1].isalnum()):
            found[kind].add(term)
    return sorted(found["strict"]), sorted(found["soft"])


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = 2) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``strict_terms``, ``soft_terms`` and ``verdict``.

    Terms are looked for in host and path; without ``://`` both are empty.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = automaton(strict, soft)
        for batch in batches:
            got = [terms_in(h + p, a) for h, p in zip(batch["host"], batch["path"])]
            batch["strict_terms"] = [g[0] for g in got]
            batch["soft_terms"] = [g[1] for g in got]
            yield batch

    url = F.col(f"`{url_col}`")
    host, path = host_of(url), path_of(url)
    picked = pages.select(F.col(f"`{id_col}`").alias("_llm_id"), host.alias("host"), path.alias("path"))
    picked = picked.withColumn("_llm_rule", rule_for(F.col("host"), F.col("path"), rules))
    picked = picked.select("_llm_id", "host", "path", F.col("_llm_rule.rule").alias("rule"), F.col("_llm_rule.verdict").alias("_llm_verdict"))
    kind = pages.schema[id_col].dataType.simpleString()
    found = picked.mapInPandas(find, f"_llm_id {kind}, host string, path string, rule string, _llm_verdict string, "
                                     "strict_terms array<string>, soft_terms array<string>")
    bad = (F.size("strict_terms") > 0) | (F.size("soft_terms") >= soft_limit)
    return found.select(F.col("_llm_id").alias(id_col), "host", "path", "rule", "strict_terms", "soft_terms",
                        F.coalesce("_llm_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"))


def oracle(rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = 2) -> str:
    """SQL for ``judge`` over ``pages`` without the term lists; boundaries as in ASCII urls."""
    def hit(term: str) -> str:
        return f"regexp_matches(lower(host || path), '(^|[^a-z0-9\\x{{80}}-\\x{{10ffff}}]){term}($|[^a-z0-9\\x{{80}}-\\x{{10ffff}}])')"

    cases = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        own, _, start = rule.partition("/")
        cases.append(f"WHEN (host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '/{start}') THEN '{{}}'".replace("{}", f"{verdict} {rule}"))
    strict_sql = " OR ".join(hit(t) for t in strict)
    soft_sql = " + ".join(f"CAST({hit(t)} AS INTEGER)" for t in soft)
    return f"""
    WITH a AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN url ELSE '' END AS u FROM pages),
    b AS (SELECT page_id, translate(regexp_extract(coalesce(u, ''), '^.*?://([^/?#]*)', 1, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(u, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM a),
    c AS (SELECT *, CASE {' '.join(cases)} END AS r, ({strict_sql}) AS strict_hit, {soft_sql} AS soft_hits FROM b)
    SELECT page_id, host, path, split_part(r, ' ', 2) AS rule,
           CASE WHEN r IS NOT NULL THEN split_part(r, ' ', 1) WHEN strict_hit OR soft_hits >= {soft_limit} THEN 'block' ELSE 'allow' END AS verdict
    FROM c"""
