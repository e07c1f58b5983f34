"""Chat formatting with perspective rotation, in DataFrame operations only.

For every participant of a conversation the dialogue is rendered once: turns of that speaker as ``assistant``, turns of the
others as ``user`` with their name, system turns as ``system``. The mask lists the spans to learn from, which are the
speaker's own texts with the end mark.

The rows of a conversation are numbered by (turn, name, text) from one range-sorted table and cut into blocks of ``BLOCK`` rows; an
output row is one (conversation, speaker, block), so no conversation and no repeated or null turn number, however
frequent, is one row or one task. ``start`` says where a block begins in the whole rendering, so blocks in order, end to end,
are the rendering.

Edge cases: a null text is empty; a null speaker is a participant named ``unknown`` (one of that very name is written
``%75nknown``); a null turn comes first. Turns that share a number are
ordered by speaker and text; repeated rows are rendered as often as they occur. ``<|`` inside a text becomes ``< |``. A
name keeps letters, digits, ``_``, ``.`` and ``-``; of any other character the UTF-8 bytes are written as ``%XX``, so different
names stay different, can be read back, and no text or name can open or close a turn. A conversation without
participants (system turns only) gives no row; an empty table gives none. A null conversation id is one conversation.
Only the four named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.scan import ranked

BLOCK = 128
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def clean(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def clean_name(name: Column) -> Column:
    """Reversible: kept characters as they are, the bytes of others as ``%XX``."""
    escaped = F.transform(
        F.regexp_extract_all(name, F.lit("(?s)."), F.lit(0)),
        lambda c: F.when(c.rlike(r"^[\p{L}\p{N}_.-]$"), c).otherwise(F.regexp_replace(F.hex(c.cast("binary")), "(..)", r"%$1")),
    )
    return F.when(name.isNull(), "unknown").when(name == "unknown", "%75nknown").otherwise(F.array_join(escaped, ""))


def rotations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", system: str = SYSTEM, block: int = BLOCK) -> DataFrame:
    """``[conv_id, speaker, block, start, n_turns, text, mask]``; ``mask`` holds ``begin`` and ``end`` in the block's text."""
    rows = turns.select(
        F.struct(F.col(conv).alias("id")).alias("conv"),  # a struct meets its equal also where the id is null
        F.col(turn).cast("bigint").alias("turn"),
        clean_name(F.col(speaker)).alias("name"),
        clean(F.col(text)).alias("said"),
    )
    rows = ranked(rows, "turn", ["conv"], ["name", "said"]).select(
        F.col("conv.id").alias("conv_id"),
        "turn",
        "name",
        "said",
        (F.col("name") == clean_name(F.lit(system))).alias("is_system"),
        F.floor(F.col("ord") / block).cast("bigint").alias("block"),
    )

    # participants meet the blocks of their conversation first, so that turns join on (conversation, block)
    people = rows.filter(~F.col("is_system")).select("conv_id", F.col("name").alias("speaker")).distinct()
    blocks = rows.select("conv_id", "block").distinct()
    seats = blocks.alias("b").join(people.alias("p"), F.col("b.conv_id").eqNullSafe(F.col("p.conv_id"))).select("b.conv_id", "b.block", "p.speaker")
    same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.block") == F.col("s.block"))
    seen = rows.alias("r").join(seats.alias("s"), same).select("r.*", "s.speaker")

    own = ~F.col("is_system") & (F.col("name") == F.col("speaker"))
    head = F.when(F.col("is_system"), "system").when(own, "assistant").otherwise(F.concat(F.lit("user name="), "name"))
    head = F.concat(F.lit(OPEN), head, F.lit("\n"))
    piece = F.struct("turn", "name", F.col("said").alias("said"), head.alias("head"), own.alias("own"))
    pieces = seen.groupBy("conv_id", "speaker", "block").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))

    text_of = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["said"], F.lit(CLOSE + "\n"))), "")
    walked = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["said"]) + len(CLOSE) + 1).alias("at"),
            F.when(
                p["own"],
                F.concat(
                    a["spans"],
                    F.array(
                        F.struct(
                            (a["at"] + F.length(p["head"])).alias("begin"),
                            (a["at"] + F.length(p["head"]) + F.length(p["said"]) + len(CLOSE)).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
    )
    out = pieces.select("conv_id", "speaker", "block", F.size("pieces").cast("bigint").alias("n_turns"), text_of.alias("text"), walked["spans"].alias("mask"))
    # one row per BLOCK turns: the window holds lengths of blocks, not turns
    before = Window.partitionBy("conv_id", "speaker").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("bigint")).over(before), F.lit(0))
    return out.select("conv_id", "speaker", "block", start.cast("bigint").alias("start"), "n_turns", "text", "mask")
