"""Chat formatting by perspective rotation: each dialogue once per participant, with that participant as the assistant.

Turns of the participant are the assistant's and trained on; all others are users who carry their name; turns of context roles (system)
stay what they are and are nobody's perspective.  The result is one row per perspective and turn: the rendered segment, where
it starts in the rendered dialogue, and which characters a loss looks at.  A dialogue is its segments in order of ``start``; none is ever
gathered into one row, so a dialogue of any length passes.

Scale: participants are a partial distinct; turns meet them by a join on the conversation.  Offsets are running sums inside blocks of turn
numbers plus the sums of earlier blocks, so a conversation with a third of all turns is spread over many tasks.

Defined cases: null turn numbers come first, ties are ordered by role and text; a null role speaks as ``unknown``; a null text is
empty; turns without a conversation id form one conversation of their own; repeated rows are repeated turns; a conversation of context
turns only has no perspective; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers that one block of running sums spans.
BLOCK = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate(turns: DataFrame, context_roles: tuple[str, ...] = ("system",), conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per perspective and turn.

    Columns: conversation, ``speaker`` (whose perspective), turn, ``as_role``, ``segment``, ``start`` and ``n_chars`` (code points in the rendered
    dialogue), and ``mask_start`` and ``mask_end``, the trained span there (null where nothing is trained on): the text and the closing mark, so
    that a model learns to stop.
    """
    said = turns.select(
        F.col(f"`{conv_col}`").alias("_llm_conv"), F.col(f"`{turn_col}`").cast("bigint").alias("_llm_turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("unknown")).alias("_llm_role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_llm_text"))
    context = F.col("_llm_role").isin(*context_roles) if context_roles else F.lit(False)
    people = said.where(~context).select(F.col("_llm_conv").alias("_llm_c"), F.col("_llm_role").alias("speaker")).distinct()
    own = F.col("_llm_role") == F.col("speaker")
    head = F.concat(F.lit(OPEN), F.when(context, F.col("_llm_role")).when(own, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), F.col("_llm_role"))), F.lit("\n"))
    seen = said.join(people, F.col("_llm_conv").eqNullSafe(F.col("_llm_c"))).drop("_llm_c")
    seen = seen.withColumns({
        "as_role": F.when(context, F.col("_llm_role")).when(own, F.lit("assistant")).otherwise(F.lit("user")),
        "segment": F.concat(head, F.col("_llm_text"), F.lit(CLOSE)),
        "_llm_head": F.length(head).cast("bigint"),
        "_llm_block": F.floor(F.col("_llm_turn") / BLOCK),
    }).withColumn("n_chars", F.length("segment").cast("bigint"))
    keys = ["_llm_conv", "speaker", "_llm_block"]
    sums = seen.groupBy(*keys).agg(F.sum("n_chars").alias("_llm_sum"))
    earlier = Window.partitionBy("_llm_conv", "speaker").orderBy(F.col("_llm_block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select(*[F.col(k).alias(f"{k}_of") for k in keys], F.coalesce(F.sum("_llm_sum").over(earlier), F.lit(0)).alias("_llm_shift"))
    inside = (Window.partitionBy(*keys).orderBy(F.col("_llm_turn").asc_nulls_first(), "_llm_role", "_llm_text")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = seen.withColumn("_llm_inside", F.coalesce(F.sum("n_chars").over(inside), F.lit(0)))
    placed = placed.join(shift, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys])
    start = F.col("_llm_inside") + F.col("_llm_shift")
    own = F.col("as_role") == "assistant"
    end_of_text = start + F.col("n_chars") - 1  # the line end after the closing mark is not learnt
    return placed.select(
        F.col("_llm_conv").alias(conv_col), "speaker", F.col("_llm_turn").alias(turn_col), "as_role", "segment", start.alias("start"), "n_chars",
        F.when(own & ~context, start + F.col("_llm_head")).alias("mask_start"), F.when(own & ~context, end_of_text).alias("mask_end"))


def oracle() -> str:
    """SQL for ``rotate`` over ``conversations`` with known ids, turns and roles."""
    return f"""
    WITH p AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role <> 'system'),
    s AS (SELECT c.conv_id, p.speaker, c.turn, c.role, c.text,
                 CASE WHEN c.role = 'system' THEN 'system' WHEN c.role = p.speaker THEN 'assistant' ELSE 'user' END AS as_role,
                 '{OPEN}' || CASE WHEN c.role = 'system' THEN 'system' WHEN c.role = p.speaker THEN 'assistant' ELSE 'user name=' || c.role END || chr(10) AS head
          FROM conversations c JOIN p ON c.conv_id = p.conv_id),
    r AS (SELECT *, head || text || '{CLOSE.rstrip()}' || chr(10) AS segment FROM s),
    o AS (SELECT *, length(segment) AS n_chars,
                 coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, speaker ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
          FROM r)
    SELECT conv_id, speaker, turn, as_role, segment, CAST(start AS BIGINT) AS start, n_chars,
           CASE WHEN as_role = 'assistant' THEN CAST(start + length(head) AS BIGINT) END AS mask_start,
           CASE WHEN as_role = 'assistant' THEN CAST(start + n_chars - 1 AS BIGINT) END AS mask_end
    FROM o"""
