"""Preference formatting: a shared prompt and two masked completions, turn by turn.

Turns of the chosen and the rejected conversation meet by number; the first number at which
they differ ends the common prefix, which is rendered once. Output is one row per rendered turn
with the span a model is trained on, so that a conversation of any length is never one row
or one task; turns are compared by hashes, and a text moves once at most. ``preference_pairs`` gathers the turns
where a pair is known to fit a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.skew import spread_join
from kinweave.runtime import materialize

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def preference_turns(turns: DataFrame, pairs: DataFrame, trained_role: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(pair_id, part, turn, role, rendered, train_from, train_to, prefix_end)``.

    ``pairs`` is ``(pair_id, chosen, rejected)`` in conversation ids. ``part`` is ``prompt``
    (the longest common prefix of turns, once), ``chosen`` or ``rejected``. The rendered turn's
    code points from ``train_from`` up to ``train_to`` are trained on: text and end mark of
    ``trained_role`` in completions, nothing (0, 0) elsewhere. Joined by turn, the parts are the texts.

    A null role or text counts as empty. Turns with a null conversation or number are left out.
    Several rows with one conversation and number are put in order of role and text and make one
    turn after another under it; the prefix then ends where these differ. A conversation that one
    side lacks gives no common prefix. Identical conversations are all prompt. Other columns are
    not read. ``prefix_end`` is the first number that differs (null: none). No turns or pairs give no rows.
    """
    said = turns.where(F.col(conv_col).isNotNull() & F.col(turn_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("chosen").cast("long").alias("conv")),
        F.struct(F.lit("rejected").alias("side"), F.col("rejected").cast("long").alias("conv")))).alias("s")).select("pair_id", "s.side", "s.conv")
    # equal multisets of a turn number: every (role, text), by a hash of 128 bits, is found as often on both sides
    text_hash = [F.xxhash64(F.lit(k), "role", F.lit("\0"), "text").alias(f"h{k}") for k in (1, 2)]
    brief = materialize(said.select("conv", "turn", *text_hash), "turn-hashes")
    sides = materialize(sides, "pair-sides")
    sign = F.when(F.col("side") == "chosen", 1).otherwise(-1)
    odd = spread_join(brief, sides, ["conv"], ["turn", "h1"]).groupBy("pair_id", "turn", "h1", "h2").agg(F.sum(sign).alias("d")).where("d <> 0")
    ends = odd.groupBy("pair_id").agg(F.min("turn").alias("end"))
    known = materialize(sides.join(ends, "pair_id", "left"), "prefix-ends")
    placed = spread_join(said, known, ["conv"], ["turn", "role"], counted=brief)
    shared = F.col("end").isNull() | (F.col("turn") < F.col("end"))
    parts = placed.where(~shared | (F.col("side") == "chosen")).withColumn("part", F.when(shared, F.lit("prompt")).otherwise(F.col("side")))
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"))
    rendered = F.concat(head, F.col("text"), F.lit(CLOSE))
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return parts.select(
        "pair_id", "part", "turn", "role", rendered.alias("rendered"),
        F.when(trained, F.length(head)).otherwise(0).cast("long").alias("train_from"),
        F.when(trained, F.length(rendered)).otherwise(0).cast("long").alias("train_to"),
        F.col("end").cast("long").alias("prefix_end"))


def preference_pairs(turns: DataFrame, pairs: DataFrame, **options) -> DataFrame:
    """``(pair_id, prompt, chosen, rejected, chosen_spans, rejected_spans)``: the rendered texts of a pair, and of each completion the
    spans (from, to; code points) that are trained on.

    A row holds both conversations whole, so this is for conversations that a row can hold; ``preference_turns`` has no such
    bound. Edge cases are its own; a part without turns is empty.
    """
    rows = preference_turns(turns, pairs, **options)
    turn = F.struct("turn", "role", "rendered", "train_from", "train_to")
    held = rows.groupBy("pair_id").agg(*(F.sort_array(F.collect_list(F.when(F.col("part") == p, turn))).alias(p) for p in ("prompt", "chosen", "rejected")))
    text = lambda p: F.array_join(F.transform(p, lambda t: t["rendered"]), "")
    spans = lambda p: F.expr(f"""aggregate({p},
        named_struct('at', 0L, 'spans', CAST(array() AS array<struct<start:bigint,end:bigint>>)),
        (acc, t) -> named_struct('at', acc.at + length(t.rendered), 'spans', CASE WHEN t.train_to > 0
          THEN concat(acc.spans, array(named_struct('start', acc.at + t.train_from, 'end', acc.at + t.train_to))) ELSE acc.spans END),
        acc -> acc.spans)""")  # noqa: E731
    return held.select("pair_id", *(text(p).alias(p) for p in ("prompt", "chosen", "rejected")), *(spans(p).alias(f"{p}_spans") for p in ("chosen", "rejected")))
