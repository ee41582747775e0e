"""Preference formatting: one prompt and two masked completions for each pair of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _clean(c: Column) -> Column:
    """Null as empty; markers inside a text are broken by a space."""
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("<|im_start|>"), F.lit("<| im_start|>")), F.lit("<|im_end|>"), F.lit("<| im_end|>"))


def _head(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t["role"], F.lit("\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _mask(turns: Column) -> Column:
    """Spans of what assistants say and its closing marker, in code points of the rendered turns: "start:end start:end"."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_head(t))
        end = begin + F.length(t["text"]) + F.length(F.lit(CLOSE))
        span = F.concat(state["spans"], F.lit(" "), begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", span).otherwise(state["spans"]).alias("spans"))

    return F.trim(F.aggregate(turns, start, step, lambda s: s["spans"]))


def format_preferences(turns: DataFrame, pair_col: str = "pair_id", rejected_col: str = "rejected", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair_id, prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) for each pair.

    ``turns`` has a row for each turn with its pair and whether it belongs to the rejected conversation.
    The prompt is the longest common prefix of turns equal in role and text, rendered once; the rest
    of either conversation is its completion, perhaps empty, and the mask holds the spans to learn from.

    Turns are in order of turn (nulls first), then role and text; repeated rows are turns of their own. Null roles
    and texts are empty. Pairs of which a side has no turn, and rows with a null pair or side, are left
    out. Extra columns are ignored. A conversation is one value, so its turns meet in a row, and nothing else does.
    """
    t = F.struct(F.col(turn_col).alias("turn"), _clean(F.col(role_col).cast("string")).alias("role"), _clean(F.col(text_col).cast("string")).alias("text"))
    rejected = F.col(rejected_col).cast("boolean")
    sides = turns.where(F.col(pair_col).isNotNull() & rejected.isNotNull()).groupBy(F.col(pair_col).alias("pair_id")).agg(
        F.sort_array(F.collect_list(F.when(~rejected, t))).alias("a"), F.sort_array(F.collect_list(F.when(rejected, t))).alias("b")
    )
    both = sides.where((F.size("a") > 0) & (F.size("b") > 0))
    short = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.slice("a", 1, short), F.slice("b", 1, short), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differs = F.array_position(same, F.lit(False)).cast("int")
    n = F.col("prompt_turns")
    parts = both.withColumn("prompt_turns", F.when(differs == 0, short).otherwise(differs - 1)).select(
        "pair_id", "prompt_turns", F.slice("a", F.lit(1), n).alias("prompt"), F.slice("a", n + 1, F.size("a")).alias("chosen"), F.slice("b", n + 1, F.size("b")).alias("rejected")
    )
    return parts.select("pair_id", "prompt_turns", _rendered(F.col("prompt")).alias("prompt"), _rendered(F.col("chosen")).alias("chosen"), _mask(F.col("chosen")).alias("chosen_mask"), _rendered(F.col("rejected")).alias("rejected"), _mask(F.col("rejected")).alias("rejected_mask"))


#: The same over ``conversations``, whose pairs are 2i (chosen) and 2i + 1 (rejected).
ORACLE = r"""
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn,
    replace(replace(coalesce(role, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') AS role,
    replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS k,
    '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body
  FROM t WHERE pair_id IN (SELECT pair_id FROM t GROUP BY pair_id HAVING count(DISTINCT side) = 2)
), sizes AS (
  SELECT pair_id, count(*) FILTER (side = 0) AS na, count(*) FILTER (side = 1) AS nb FROM n GROUP BY pair_id
), differ AS (
  SELECT a.pair_id, min(a.k) AS k FROM n a JOIN n b ON a.pair_id = b.pair_id AND a.k = b.k AND a.side = 0 AND b.side = 1
  WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id
), p AS (
  SELECT pair_id, coalesce(d.k - 1, least(na, nb)) AS prompt_turns FROM sizes LEFT JOIN differ d USING (pair_id)
), c AS (
  SELECT n.*, p.prompt_turns, sum(length(head) + length(body)) OVER (PARTITION BY n.pair_id, side, n.k > p.prompt_turns ORDER BY n.k) AS upto
  FROM n JOIN p USING (pair_id)
)
SELECT pair_id, CAST(any_value(prompt_turns) AS INTEGER) AS prompt_turns,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 0 AND k <= prompt_turns), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 0 AND k > prompt_turns), '') AS chosen,
  coalesce(string_agg((upto - length(body)) || ':' || upto, ' ' ORDER BY k) FILTER (side = 0 AND k > prompt_turns AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 1 AND k > prompt_turns), '') AS rejected,
  coalesce(string_agg((upto - length(body)) || ':' || upto, ' ' ORDER BY k) FILTER (side = 1 AND k > prompt_turns AND role = 'assistant'), '') AS rejected_mask
FROM c GROUP BY pair_id
"""
