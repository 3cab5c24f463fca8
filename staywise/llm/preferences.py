"""Preference formatting: a common prompt, and two masked completions.

Two conversations of a pair are compared turn by turn. Their longest common prefix of turns is rendered once as the
prompt; what is left of each is rendered as its completion. A completion's mask lists the character ranges that a
loss is taken on: the bodies of the assistant's turns, end marker included, so everything else is masked.

The offsets come from running sums over a conversation's turns, and the pair is put together by one shuffle, by pair:
a pair is one row of the result, and no task holds more than its pairs.

Inputs without a result of their own: an empty table gives no rows; turns without a conversation are left out; a null role or text
is empty; turns come in order of turn (null first), role and text, and repeated rows count once; a pair whose one
side has no turns has an empty prompt and an empty completion for it; equal conversations are all prompt; markers
within texts and roles are broken up, so no text can open or close a turn; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Markers of the rendered format.
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>"
MARKER = r"<\|(im_start|im_end)\|>"
BROKEN = "< |$1| >"
TRAINED_ROLE = "assistant"


def _clean(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), MARKER, BROKEN)


def rendered_turns(turns: DataFrame, pair: Column, rejected: Column) -> DataFrame:
    """(pair_id, rejected, nth, role, rendered, start, body): turns in order, with places in their rendered conversation.

    ``pair`` names the pair of a turn's conversation, ``rejected`` its side.
    """
    own = turns.where("conv_id IS NOT NULL").select(
        pair.alias("pair_id"), rejected.alias("rejected"), "turn", _clean(F.col("role")).alias("role"), _clean(F.col("text")).alias("text")
    )
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"))
    each = own.distinct().withColumn("rendered", F.concat(head, F.col("text"), F.lit(CLOSE + "\n")))
    order = Window.partitionBy("pair_id", "rejected").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum(F.char_length("rendered").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return each.select(
        "pair_id",
        "rejected",
        F.row_number().over(order).alias("nth"),
        "role",
        "rendered",
        F.coalesce(before, F.lit(0)).alias("start"),
        F.char_length(head).alias("body"),
    )


def _side(rejected: bool) -> Column:
    own = F.col("rejected") if rejected else ~F.col("rejected")
    return F.sort_array(F.collect_list(F.when(own, F.struct("nth", "role", "rendered", "start", "body"))))


def _text(turns: str, first: Column, count: Column) -> Column:
    return F.array_join(F.transform(F.slice(turns, first, count), lambda t: t["rendered"]), "")


def _mask(turns: str, first: Column, offset: Column) -> Column:
    """Ranges (from, to) within the completion: the trained role's bodies and their end marker."""
    rest = F.filter(F.slice(turns, first, F.size(turns)), lambda t: t["role"] == TRAINED_ROLE)
    return F.transform(
        rest,
        lambda t: F.struct(
            (t["start"] + t["body"] - offset).alias("from"),
            (t["start"] + F.char_length(t["rendered"]) - 1 - offset).alias("to"),
        ),
    )


def preference_rows(turns: DataFrame, pair: Column, rejected: Column) -> DataFrame:
    """Per pair: pair_id, n_common (turns), prompt, chosen, rejected, chosen_mask, rejected_mask."""
    each = rendered_turns(turns, pair, rejected)
    both = each.groupBy("pair_id").agg(_side(False).alias("c"), _side(True).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: F.coalesce((a["rendered"] == b["rendered"]) & (a["role"] == b["role"]), F.lit(False)))
    differ = F.array_position(same, F.lit(False))
    common = F.when(differ == 0, F.size("c")).otherwise(differ - 1).cast("int")
    first, prompt = F.col("n_common") + 1, _text("c", F.lit(1), F.col("n_common"))
    return (
        both.withColumn("n_common", common)
        .withColumn("prompt", prompt)
        .withColumn("offset", F.char_length("prompt").cast("long"))
        .select(
            "pair_id",
            F.col("n_common").cast("long").alias("n_common"),
            "prompt",
            _text("c", first, F.size("c")).alias("chosen"),
            _text("r", first, F.size("r")).alias("rejected"),
            _mask("c", first, F.col("offset")).alias("chosen_mask"),
            _mask("r", first, F.col("offset")).alias("rejected_mask"),
        )
    )


def neighbours(conv_id: str = "conv_id") -> tuple[Column, Column]:
    """The pairing of a table without preferences: conversations 2k (chosen) and 2k + 1 (rejected) are pair k."""
    return F.shiftright(F.col(conv_id), 1), F.col(conv_id).bitwiseAND(1) == 1
