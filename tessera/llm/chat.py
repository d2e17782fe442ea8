"""Chat formatting: every participant's perspective on a conversation.

For each participant of a conversation the whole dialogue is rendered once more
with that speaker as the assistant and all others as named users. Only the
participant's own turns are trained on (``mask`` 1). A participant is a value of
the role column; ``system`` turns are instructions, seen by all and nobody's own.

The result has one row a (conversation, participant, turn): the rendered segment,
its place in the dialogue by turn (``position``) and by characters (``start``,
``stop``), and the part of it that is trained on (``mask_start``, ``mask_stop``:
the turn's text and its end mark, not its header). Putting the segments of a
perspective one after the other gives its dialogue; ``render`` does so for
conversations known to be short. Nothing gathers a conversation in one row, and
running sums go over blocks of turns first, so a conversation may be as long
as the whole table.

Only DataFrame functions are used. Handling of odd rows: a null text is an empty
turn; a null role is the participant ``unknown``; a null conversation id is a
conversation of its own; null turn numbers come first; turns with equal numbers
are ordered by role and text; rows that are equal in all four columns are kept
and numbered one after the other (they can't be told apart, so any order is the
same); a conversation of system turns alone has no participant and no row; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Marks of the rendered format (fixed values).
START, END = "<|im_start|>", "<|im_end|>\n"

#: Turn numbers of one block of the two-level running sums.
BLOCK_TURNS = 256

SYSTEM = "system"


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", system_role: str = SYSTEM) -> DataFrame:
    """conv_id, participant, position, turn, speaker, segment, start, stop, mask, mask_start, mask_stop."""
    said = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(text_col), F.lit("")).alias("said"))
    people = said.filter(F.col("speaker") != system_role).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("participant")).distinct()
    views = said.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("speaker") == F.col("participant")
    header = F.when(own, F.lit(f"{START}assistant\n")) \
        .when(F.col("speaker") == system_role, F.lit(f"{START}system\n")) \
        .otherwise(F.concat(F.lit(f"{START}user name="), F.col("speaker"), F.lit("\n")))
    views = views.withColumn("mask", own.cast("int")).withColumn("head", F.length(header)) \
        .withColumn("segment", F.concat(header, F.col("said"), F.lit(END))).withColumn("size", F.length("segment")) \
        .withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))

    # running sums in two levels: blocks of turns, then turns in a block
    keys = ["conv_id", "participant", "block"]
    blocks = views.groupBy(*keys).agg(F.sum("size").alias("chars"), F.count("size").alias("turns"))
    before = W.partitionBy("conv_id", "participant").orderBy(F.col("block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(*[F.col(k).alias(f"_{k}") for k in keys], F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
                           F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"))
    placed = views.join(blocks, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("participant") == F.col("_participant"))
                        & F.col("block").eqNullSafe(F.col("_block")))
    inner = W.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_first(), "speaker", "said").rowsBetween(W.unboundedPreceding, W.currentRow)
    stop = F.col("chars_before") + F.sum("size").over(inner)
    placed = placed.withColumn("stop", stop).withColumn("position", (F.col("turns_before") + F.count("size").over(inner) - 1).cast("long"))
    start = F.col("stop") - F.col("size")
    return placed.select(
        "conv_id", "participant", "position", "turn", "speaker", "segment", start.alias("start"), "stop", "mask",
        F.when(own, start + F.col("head")).alias("mask_start"), F.when(own, F.col("stop")).alias("mask_stop"))


def render(views: DataFrame) -> DataFrame:
    """conv_id, participant, dialogue, trained (spans) of ``perspectives`` rows: one row a perspective.

    For conversations known to be short: a dialogue is one string.
    """
    part = F.struct("position", "segment", F.when(F.col("mask") == 1, F.struct("mask_start", "mask_stop")).alias("span"))
    parts = views.groupBy("conv_id", "participant").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return parts.select("conv_id", "participant", F.array_join("parts.segment", "").alias("dialogue"),
                        F.filter("parts.span", lambda s: s.isNotNull()).alias("trained"))
