"""Quality rules combined by weak supervision, in DataFrame functions only.

Each rule looks at one statistic of a text and votes good (1), bad (-1) or abstains (0).  No rule is trusted as
such: expectation-maximisation over the counts of vote patterns estimates how each rule votes on good and on bad
texts, and the posterior probability of "good" takes the place of passing every rule.

Scale: statistics are computed inside each row; the only shuffle is the count of vote patterns, of which there are at
most 3 ** len(RULES) whatever the input, so the table on which EM iterates is bounded.

Defined cases: a null or empty text has no words (all counts 0) and fails the base rule; repeated rows are judged one by
one and alike; an empty table gives an empty result; other columns of the input are never read or renamed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import SPACE
from trackmill.session import materialise

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_END = r'[.!?:;"\x27)\]]\s*$'


@dataclass(frozen=True)
class Rule:
    """Votes bad where the statistic is in ``bad`` (low, high), good where it is in ``good``, else abstains."""

    name: str
    value: Column
    good: tuple[float, float]
    bad_below: float = -math.inf
    bad_above: float = math.inf

    def vote(self) -> Column:
        bad = F.lit(False)
        if self.bad_below > -math.inf:
            bad = bad | (self.value < self.bad_below)
        if self.bad_above < math.inf:
            bad = bad | (self.value > self.bad_above)
        good = (self.value >= self.good[0]) & (self.value <= self.good[1])
        return F.coalesce(F.when(bad, -1).when(good, 1), F.lit(0)).cast("int")


def _per(top: str, bottom: str) -> Column:
    return F.col(top) / F.nullif(F.col(bottom), F.lit(0))


def default_rules() -> list[Rule]:
    """The rules of the registered query, over the columns of ``text_statistics``."""
    return [
        Rule("length", F.col("n_words").cast("double"), (50, 100_000), bad_below=20),
        Rule("word_length", _per("word_chars", "n_words"), (2.5, 9.5), bad_below=2, bad_above=12),
        Rule("symbols", _per("n_symbols", "n_words"), (0, 0.05), bad_above=0.3),
        Rule("symbol_share", _per("n_symbols", "word_chars"), (0, 0.01), bad_above=0.04),
        Rule("marks", _per("n_marks", "word_chars"), (0, 0.1), bad_above=0.2),
        Rule("repeated_lines", _per("n_dup_lines", "n_lines"), (0, 0.2), bad_above=0.5),
        Rule("repeated_windows", _per("n_repeat_words", "n_words"), (0, 0.2), bad_above=0.45),
        Rule("capitals", _per("n_upper", "word_chars"), (0, 0.1), bad_above=0.3),
        Rule("exclamations", _per("n_bangs", "n_words"), (0, 0.1), bad_above=0.5),
        Rule("line_ends", _per("n_ended_lines", "n_lines"), (0.5, 1), bad_below=0.1),
    ]


def _count(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("bigint")


def text_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but the text) and the counts that rules look at.

    Windows of three words are compared by 64-bit hashes inside the row: only texts with some repeated window have
    theirs sorted, so the work is n log n in the words of a text and nothing is shuffled.  Input columns with the name of a
    count are replaced.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_upper", "n_bangs", "n_marks"]
    kept = [c for c in (docs.columns if keep is None else keep) if c != text_col and c.lower() not in counts]
    taken = [F.col(f"`{c}`") for c in kept]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    t, rest, words, lines, h, s, p = ("_llm_text", "_llm_rest", "_llm_words", "_llm_lines", "_llm_hashes", "_llm_sorted", "_llm_places")
    step = docs.select(*taken, text.alias(t))
    # What is neither a small letter nor beyond ASCII is a fifth of a text, and all that is counted by character.
    step = step.select(
        *taken, F.length(t).alias("_llm_length"),
        F.regexp_replace(t, "[a-z\\u0080-\\x{10FFFF}]+", "").alias(rest),
        F.array_remove(F.split(t, f"{SPACE}+"), "").alias(words),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
    )
    # The hashes at the last two words are of no window and cut off.
    window = F.slice(F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.size(words) - 2)
    step = step.select(
        *taken,
        (F.col("_llm_length") - _count(F.col(rest), _BLANKS)).alias("word_chars"),
        _count(F.col(rest), SYMBOLS).alias("n_symbols"),
        _count(F.col(rest), _UPPER).alias("n_upper"),
        _count(F.col(rest), "!").alias("n_bangs"),
        (F.length(rest) - _count(F.col(rest), _BLANKS + _UPPER)).alias("n_marks"),
        F.size(words).cast("bigint").alias("n_words"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(_END))).cast("bigint").alias("n_ended_lines"),
        F.when(F.size(words) >= 3, window).otherwise(F.array().cast("array<bigint>")).alias(h),
    )
    done = ["word_chars", "n_symbols", "n_upper", "n_bangs", "n_marks", "n_words", "n_lines", "n_dup_lines", "n_ended_lines"]
    in_order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    step = step.select(*taken, *done, F.when(F.size(F.array_distinct(h)) < F.size(h), in_order).alias(s))
    twin = F.filter(s, lambda e, k: F.coalesce(e.x == F.get(s, k - 1).x, F.lit(False))
                    | F.coalesce(e.x == F.get(s, k + 1).x, F.lit(False)))
    step = step.select(*taken, *done, F.sort_array(F.transform(twin, lambda e: e.i)).alias(p))
    covered = F.transform(p, lambda v, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - v, F.lit(3))))
    repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("bigint")
    return step.select(*taken, *done, repeat.alias("n_repeat_words"))


@dataclass(frozen=True)
class VoteModel:
    """What EM found: the share of good texts, and per rule the chance of each vote on good and on bad texts."""

    prior: float
    good: dict[str, dict[int, float]]
    bad: dict[str, dict[int, float]]

    def posterior(self, names: list[str]) -> Column:
        """Probability of "good", given the vote columns."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for n in names:
            gain = {v: math.log(self.good[n][v] / self.bad[n][v]) for v in (-1, 0, 1)}
            odds = odds + F.when(F.col(n) == 1, gain[1]).when(F.col(n) == -1, gain[-1]).otherwise(gain[0])
        return 1 / (1 + F.exp(-odds))

    def accuracy(self, name: str) -> float:
        """Estimated chance that a vote of the rule (abstentions aside) is right."""
        right = self.prior * self.good[name][1] + (1 - self.prior) * self.bad[name][-1]
        wrong = self.prior * self.good[name][-1] + (1 - self.prior) * self.bad[name][1]
        return right / (right + wrong)


#: What is believed of a rule before the data speak: on good texts a bad vote is rare, on bad texts each rule sees only some defects.
_PRIOR_GOOD = {-1: 0.005, 0: 0.045, 1: 0.95}
_PRIOR_BAD = {-1: 0.25, 0: 0.15, 1: 0.6}


def fit_votes(votes: DataFrame, names: list[str], iterations: int = 10, trust: float = 0.1) -> VoteModel:
    """EM over the counts of vote patterns; each iteration is one aggregation of that bounded table.

    It starts by doubting each text with a bad vote.  The prior belief about rules weighs ``trust`` times as much as the texts of
    the class, at any size of the input.  Rules overlap on purpose: EM recognises a defect where several of them agree.
    An empty table leaves the prior, with half of the texts good.
    """
    patterns = materialise(votes.groupBy(*names).agg(F.count("*").alias("_llm_n")).coalesce(1), "vote-patterns")
    start = F.lit(2.0)
    for n in names:
        start = start - F.when(F.col(n) == -1, 4.0).otherwise(0.0)
    chance = 1 / (1 + F.exp(-start))
    model = None
    for _ in range(iterations):
        sums = [F.sum(F.col("_llm_n") * F.col("_llm_q")).alias("good"), F.sum(F.col("_llm_n") * (1 - F.col("_llm_q"))).alias("bad")]
        for n in names:
            for v in (-1, 1):
                hit = F.when(F.col(n) == v, F.col("_llm_n"))
                sums += [F.sum(hit * F.col("_llm_q")).alias(f"g_{n}_{v}"), F.sum(hit * (1 - F.col("_llm_q"))).alias(f"b_{n}_{v}")]
        got = {k: v or 0.0 for k, v in patterns.withColumn("_llm_q", chance).agg(*sums).first().asDict().items()}
        rates = []
        for k, whole, prior in (("g", got["good"], _PRIOR_GOOD), ("b", got["bad"], _PRIOR_BAD)):
            rates.append({})
            for n in names:
                seen = {v: got[f"{k}_{n}_{v}"] for v in (-1, 1)}
                seen[0] = max(0.0, whole - seen[-1] - seen[1])
                rates[-1][n] = {v: (seen[v] + prior[v] * (trust * whole + 1)) / (whole + trust * whole + 1) for v in (-1, 0, 1)}
        model = VoteModel((got["good"] + 1) / (got["good"] + got["bad"] + 2), *rates)
        chance = model.posterior(names)
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, threshold: float = 0.5,
          min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """One row per document: id, counts, votes, posterior, ``base_failed`` and ``kept``.

    ``base_failed`` holds texts of under ``min_words`` words, or with over ``max_repeat_percent`` of their words in repeated
    windows; ``kept`` is false for them, and else true from a posterior of ``threshold`` on.
    """
    rules = default_rules() if rules is None else rules
    names = [f"vote_{r.name}" for r in rules]
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    # Written once: the fit and the verdict both read it, and it holds counts only.
    voted = materialise(
        text_statistics(docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{text_col}`").alias("_llm_source_text")), "_llm_source_text")
        .withColumns({n: r.vote() for n, r in zip(names, rules)}), "rule-votes")
    model = fit_votes(voted, names)
    out = voted.withColumn("posterior", model.posterior(names)).withColumn("base_failed", base)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    return out.withColumnRenamed("_llm_id", id_col)


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns; rows alike in id and text are judged alike.

    The verdict returns to the rows by id.  Rows that share an id but not a text stay if any of them is kept; rows without
    an id are judged by joining null with null.
    """
    verdict = judge(docs, id_col, text_col).groupBy(F.col(f"`{id_col}`").alias("_llm_id")).agg(F.max("kept").alias("_llm_kept"))
    return docs.join(verdict.where("_llm_kept"), F.col(f"`{id_col}`").eqNullSafe(F.col("_llm_id")), "left_semi")


def statistics_columns() -> list[str]:
    """The counts that the registered query returns."""
    return ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


__all__ = ["Rule", "VoteModel", "default_rules", "fit_votes", "judge", "kept_documents", "statistics_columns", "text_statistics"]
