"""Chat rendering and prompt lines over ``(conv_id, turn, role, text)`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values ------------------------------------------------------------
START_OF_TURN = "<start_of_turn>"
END_OF_TURN = "<end_of_turn>"
PROMPT_LINE = "User: %s\nAssistant: %s"
# -----------------------------------------------------------------------------


def render_turn(role, text, start: str = START_OF_TURN, end: str = END_OF_TURN) -> Column:
    """``<start>role\\ntext<end>\\n`` for one turn; a null role or text counts as empty."""
    r, t = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (role, text))
    return F.concat(F.lit(start), r, F.lit("\n"), t, F.lit(end), F.lit("\n"))


def chat_render(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text",
                start: str = START_OF_TURN, end: str = END_OF_TURN,
                generation_prompt: str | None = None, block: int = 64) -> DataFrame:
    """One rendered string per conversation, turns in ``turn`` order.

    Turns are joined in blocks of ``block`` turn numbers first, so a
    conversation that holds a third of all turns spreads over tasks; a second
    group joins the blocks' strings, one row a block.
    """
    rendered = turns.select(conv_col, F.floor(F.col(turn_col) / block).alias("_b"), F.struct(
        F.col(turn_col).alias("t"), render_turn(role_col, text_col, start, end).alias("s")).alias("_r"))
    blocks = rendered.groupBy(conv_col, "_b").agg(F.array_sort(F.collect_list("_r")).alias("_rs")).select(
        conv_col, F.struct("_b", F.size("_rs").cast("long").alias("n"),
                           F.array_join(F.transform("_rs", lambda x: x["s"]), "").alias("s")).alias("_r"))
    grouped = blocks.groupBy(conv_col).agg(F.array_sort(F.collect_list("_r")).alias("_rs"))
    body = F.array_join(F.transform("_rs", lambda x: x["s"]), "")
    if generation_prompt is not None:
        body = F.concat(body, F.lit(start), F.lit(generation_prompt), F.lit("\n"))
    n = F.aggregate("_rs", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return grouped.select(conv_col, n.alias("n_turns"), body.alias("rendered"))


def next_turn_pairs(turns: DataFrame, first_role: str = "user", second_role: str = "assistant",
                    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """Each ``first_role`` turn with the immediately following ``second_role`` turn.

    An equi-join on the unique (conversation, turn) key: balanced even when a
    single conversation is huge (a window by conversation would put it in one
    task).
    """
    a = turns.where(F.col(role_col) == first_role).select(
        conv_col, turn_col, F.col(text_col).alias("first_text"))
    b = turns.where(F.col(role_col) == second_role).select(
        conv_col, (F.col(turn_col) - 1).alias(turn_col), F.col(text_col).alias("second_text"))
    return a.join(b, [conv_col, turn_col], "inner")


def prompt_lines(turns: DataFrame, **kw) -> DataFrame:
    """``User: ...\\nAssistant: ...`` for each user turn and its answer."""
    pairs = next_turn_pairs(turns, **kw)
    conv_col = kw.get("conv_col", "conv_id")
    turn_col = kw.get("turn_col", "turn")
    line = F.format_string(PROMPT_LINE, F.col("first_text"), F.col("second_text"))
    return pairs.select(conv_col, turn_col, line.alias("line"))
