"""Preference formatting, in DataFrame operations only.

A chosen and a rejected conversation of one pair are compared turn by turn.
Their longest common prefix of turns is rendered once as the prompt; what
follows is rendered for each side as its completion. The output has one row
per message, not one per pair, so no conversation is ever gathered in one task,
however long it is. Every row says where it starts in its part and how long
the pair's parts are, so that prompt, completions and masks are those of one
text: in order of ``start`` the rendered messages of a part make up the whole.

Texts are shuffled once, by pair and turn. What is summed along a conversation
are lengths, in stretches of ``STRETCH`` turns and then in stretches of those,
so a long conversation is no hot group either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"  # fixed values of the chat template
TRAINED_ROLE = "assistant"
PARTS = PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"
#: Turn numbers in a stretch, and stretches in one of the next level, as bits.
STRETCH_BITS = 10


def _turns(chosen: DataFrame, rejected: DataFrame, pair_col: str) -> DataFrame:
    """One row per pair and turn: each side's messages as an array, empty
    where the side has none. Repeated rows are one message; several messages
    of a turn are ordered by role and text."""
    message = F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def rows(side: DataFrame, name: str) -> DataFrame:
        return side.select(F.col(f"`{pair_col}`").alias("pair_id"), F.col("turn").alias("turn"), F.lit(name).alias("side"), message.alias("message"))

    both = rows(chosen, CHOSEN).union(rows(rejected, REJECTED)).where("pair_id is not null and turn is not null")
    return both.groupBy("pair_id", "turn").agg(
        *(F.sort_array(F.collect_set(F.when(F.col("side") == name, F.col("message")))).alias(name) for name in (CHOSEN, REJECTED))
    )


def _rendered_length(message: Column) -> Column:
    return (F.length(message["role"]) + F.length(message["text"]) + F.lit(len(OPEN) + 1 + len(CLOSE))).cast("long")


def _stretch(number: str) -> Column:
    """Never null by its type: a join on it then adds no filter to its side,
    and the sides have the exchange by pair and turn in common."""
    return F.coalesce(F.shiftright(F.col(number).cast("long"), STRETCH_BITS), F.lit(0).cast("long"))


def _places(turns: DataFrame) -> DataFrame:
    """``pair_id, turn, common``, for each part where the turn starts in it
    (its name) and the length of the whole (``<part>_chars``)."""
    whole = {name: F.aggregate(name, F.lit(0).cast("long"), lambda n, m: n + _rendered_length(m)) for name in (CHOSEN, REJECTED)}
    lengths = turns.select("pair_id", "turn", (F.col(CHOSEN) != F.col(REJECTED)).alias("differs"), *(n.alias(name) for name, n in whole.items()))
    forks = lengths.where("differs").groupBy("pair_id").agg(F.min("turn").alias("fork"))
    common = F.col("fork").isNull() | (F.col("turn") < F.col("fork"))
    none = F.lit(0).cast("long")
    at = lengths.join(forks, "pair_id", "left").select(
        "pair_id",
        "turn",
        common.alias("common"),
        _stretch("turn").alias("stretch"),
        F.when(common, F.col(CHOSEN)).otherwise(none).alias(PROMPT),
        *(F.when(common, none).otherwise(F.col(name)).alias(name) for name in (CHOSEN, REJECTED)),
    )
    sums = [F.sum(p).alias(p) for p in PARTS]
    stretches = at.groupBy("pair_id", "stretch").agg(*sums).withColumn("upper", _stretch("stretch"))
    uppers = stretches.groupBy("pair_id", "upper").agg(*sums)

    def before(part: str, group: tuple[str, ...], order: str) -> Column:
        return F.sum(part).over(Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(part)

    pair = Window.partitionBy("pair_id")
    uppers = uppers.select(
        "pair_id", "upper", *(before(p, ("pair_id",), "upper").alias(f"{p}_upper") for p in PARTS), *(F.sum(p).over(pair).alias(f"{p}_chars") for p in PARTS)
    )
    stretches = stretches.join(uppers, ["pair_id", "upper"]).select(
        "pair_id",
        "stretch",
        *((F.col(f"{p}_upper") + before(p, ("pair_id", "upper"), "stretch")).alias(f"{p}_stretch") for p in PARTS),
        *(f"{p}_chars" for p in PARTS),
    )
    return at.join(stretches, ["pair_id", "stretch"]).select(
        "pair_id",
        "turn",
        "common",
        *((F.col(f"{p}_stretch") + before(p, ("pair_id", "stretch"), "turn")).alias(f"{p}_start") for p in PARTS),
        *(f"{p}_chars" for p in PARTS),
    )


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id") -> DataFrame:
    """``pair_id, turn, part`` (prompt, chosen, rejected), ``role, rendered,
    loss_start, loss_end``: the half-open range of characters of ``rendered``
    that is trained on, empty (0, 0) for prompts and for roles other than the
    assistant's; ``start``: where ``rendered`` begins in its part (the mask of
    a completion is ``start + loss_start`` to ``start + loss_end`` of each row);
    ``prompt_chars, chosen_chars, rejected_chars``: the lengths of the pair's
    prompt and of both completions, 0 for a part without rows.

    The inputs have the pair's id, ``turn`` (of an integer type), ``role`` and
    ``text``. A pair that only one side has is all completion; equal sides are
    all prompt. Rows without a pair id or a turn are left out; null roles and
    texts are empty.
    """
    turns = _turns(chosen, rejected, pair_col)

    def part(name: str, messages: str) -> Column:
        return F.struct(F.lit(name).alias("part"), F.col(messages).alias("messages"), F.col(f"{name}_start").alias("start"))

    parts = F.when(F.col("common"), F.array(part(PROMPT, CHOSEN))).otherwise(F.array(part(CHOSEN, CHOSEN), part(REJECTED, REJECTED)))
    chars = [f"{p}_chars" for p in PARTS]
    sides = turns.join(_places(turns), ["pair_id", "turn"]).select("pair_id", "turn", F.explode(parts).alias("side"), *chars)
    spread = sides.select("pair_id", "turn", "side.part", "side.start", F.explode("side.messages").alias("m"), *chars)
    head = F.concat(F.lit(OPEN), F.col("m.role"), F.lit("\n"))
    trained = (F.col("part") != PROMPT) & (F.col("m.role") == TRAINED_ROLE)
    # Messages of one turn, which the shuffle by pair and turn has brought together.
    earlier = Window.partitionBy("pair_id", "turn", "part").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    length = _rendered_length(F.col("m"))
    return spread.select(
        "pair_id",
        "turn",
        "part",
        F.col("m.role").alias("role"),
        F.concat(head, F.col("m.text"), F.lit(CLOSE)).alias("rendered"),
        F.when(trained, F.length(head)).otherwise(0).alias("loss_start"),
        F.when(trained, F.length(head) + F.length("m.text") + len(CLOSE.rstrip())).otherwise(0).alias("loss_end"),
        (F.col("start") + F.sum(length).over(earlier) - length).alias("start"),
        *chars,
    )


def branches(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A chosen and a rejected side of every conversation: as it is, and with
    the last assistant turn replaced by the first one's text (dropped where
    there is only one)."""
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    replies = turns.where(F.col("role") == TRAINED_ROLE)
    ends = replies.groupBy(F.col("pair_id").alias("p")).agg(
        F.max("turn").alias("last"), F.min("turn").alias("first"), F.min(F.struct("turn", "text")).alias("opening")
    )
    joined = turns.join(ends, F.col("pair_id") == F.col("p"), "left")
    is_last = (F.col("role") == TRAINED_ROLE) & (F.col("turn") == F.col("last"))
    swapped = joined.where(~F.coalesce(is_last & (F.col("first") == F.col("last")), F.lit(False))).select(
        "pair_id", "turn", "role", F.when(is_last, F.col("opening.text")).otherwise(F.col("text")).alias("text")
    )
    return turns, swapped
