"""Preference pairs of conversations, formatted for training.

Per pair, the turns that the chosen and the rejected conversation begin with alike (role and text) are the prompt,
rendered once; what follows in each is rendered as its completion, with the character ranges that carry loss: the
texts of assistant turns and their end mark. Everything is grouped by pair; a conversation is one row, as it is for
whoever trains on it.

Defined results: a NULL role or text reads as empty; repeated turns stay and are ordered by (turn, role, text); a pair
whose conversation is missing on one side has an empty completion there; equal conversations have empty completions;
rows without a pair id belong to no conversation and are left out; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import running_totals

#: Turn template, a fixed format: head, text, end.
HEAD = ("<|", "|>\n")
END = "<|end|>"
AFTER = "\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def turns_of(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(pair, name): the ordered turns of each conversation."""
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("pair"), turn.alias("turn"))
    return rows.groupBy("pair").agg(F.sort_array(F.collect_list("turn")).alias(name))


def common_turns(left: Column, right: Column) -> Column:
    """How many turns both begin with."""
    n = F.least(F.size(left), F.size(right))
    same = F.zip_with(
        F.slice(left, 1, n), F.slice(right, 1, n), lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"])
    )
    first = F.array_position(same, False).cast("int")
    return F.when(first > 0, first - 1).otherwise(n)


def head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD[0]), turn["role"], F.lit(HEAD[1]))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit(END + AFTER))), "")


def loss_ranges(turns: Column) -> Column:
    """(start, end) within the rendered completion that carry loss."""
    sizes = F.transform(turns, lambda t: F.length(head(t)) + F.length(t["text"]) + len(END + AFTER))
    placed = F.zip_with(
        turns,
        running_totals(sizes),
        lambda t, at: F.struct(
            (t["role"] == "assistant").alias("own"),
            (at + F.length(head(t))).alias("start"),
            (at + F.length(head(t)) + F.length(t["text"]) + len(END)).alias("end"),
        ),
    )
    return F.transform(F.filter(placed, lambda p: p["own"]), lambda p: F.struct(p["start"], p["end"]))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, n_prompt_turns, prompt, chosen, rejected, chosen_loss, rejected_loss); inputs: (key, turn, role, text)."""
    sides = turns_of(chosen, key, "good").join(turns_of(rejected, key, "bad"), "pair", "full")
    none = F.array().cast(TURNS)
    sides = sides.select("pair", F.coalesce("good", none).alias("good"), F.coalesce("bad", none).alias("bad"))
    split = sides.withColumn("n", common_turns(F.col("good"), F.col("bad"))).select(
        "pair",
        "n",
        F.slice("good", F.lit(1), F.col("n")).alias("prompt"),
        F.slice("good", F.col("n") + 1, F.size("good")).alias("good"),
        F.slice("bad", F.col("n") + 1, F.size("bad")).alias("bad"),
    )
    return split.select(
        F.col("pair").alias(key),
        F.col("n").cast("bigint").alias("n_prompt_turns"),
        rendered(F.col("prompt")).alias("prompt"),
        rendered(F.col("good")).alias("chosen"),
        rendered(F.col("bad")).alias("rejected"),
        loss_ranges(F.col("good")).alias("chosen_loss"),
        loss_ranges(F.col("bad")).alias("rejected_loss"),
    )


def stale_answers(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """The conversations with their last answer replaced by the text of the turn before it: a reply that only echoes."""
    order = [F.col("turn"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))]
    ordered = Window.partitionBy(key).orderBy(*order)
    answers = F.row_number().over(Window.partitionBy(key, "role").orderBy(F.desc("turn"), F.desc("text")))
    rows = conversations.select(key, "turn", "role", "text").withColumns(
        {"before": F.lag("text").over(ordered), "from_last": answers}
    )
    echo = (F.col("role") == "assistant") & (F.col("from_last") == 1) & F.col("before").isNotNull()
    return rows.select(key, "turn", "role", F.when(echo, F.col("before")).otherwise(F.col("text")).alias("text"))


def preference_report(conversations: DataFrame) -> DataFrame:
    """Each conversation preferred to itself with a stale last answer."""
    pairs = preference_pairs(conversations, stale_answers(conversations), "conv_id")

    def text(ranges: str) -> Column:
        return F.array_join(F.transform(ranges, lambda r: F.concat_ws(":", r["start"], r["end"])), ",").alias(ranges)

    return pairs.select(
        "conv_id", "n_prompt_turns", "prompt", "chosen", "rejected", text("chosen_loss"), text("rejected_loss")
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS good, role AS own, text AS raw,
    row_number() OVER w AS pos, lag(text) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text DESC) AS from_last
  FROM conversations WHERE conv_id IS NOT NULL
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, ''))),
p AS (
  SELECT *, CASE WHEN own = 'assistant' AND from_last = 1 AND before IS NOT NULL THEN before ELSE good END AS bad FROM t),
s AS (
  SELECT conv_id, coalesce(min(pos) FILTER (WHERE good <> bad), max(pos) + 1) AS split FROM p GROUP BY conv_id),
r AS (
  SELECT p.*, split, '<|' || role || '|>' || chr(10) || good || '<|end|>' || chr(10) AS g,
    '<|' || role || '|>' || chr(10) || bad || '<|end|>' || chr(10) AS b, length(role) + 5 AS head
  FROM p JOIN s USING (conv_id)),
o AS (
  SELECT *, coalesce(sum(CASE WHEN pos >= split THEN length(g) END) OVER v, 0) AS go,
    coalesce(sum(CASE WHEN pos >= split THEN length(b) END) OVER v, 0) AS bo
  FROM r WINDOW v AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, CAST(min(split) - 1 AS BIGINT) AS n_prompt_turns,
  coalesce(string_agg(g, '' ORDER BY pos) FILTER (WHERE pos < split), '') AS prompt,
  coalesce(string_agg(g, '' ORDER BY pos) FILTER (WHERE pos >= split), '') AS chosen,
  coalesce(string_agg(b, '' ORDER BY pos) FILTER (WHERE pos >= split), '') AS rejected,
  coalesce(string_agg((go + head) || ':' || (go + head + length(good) + 7), ',' ORDER BY pos)
    FILTER (WHERE pos >= split AND role = 'assistant'), '') AS chosen_loss,
  coalesce(string_agg((bo + head) || ':' || (bo + head + length(bad) + 7), ',' ORDER BY pos)
    FILTER (WHERE pos >= split AND role = 'assistant'), '') AS rejected_loss
FROM o GROUP BY conv_id
"""
