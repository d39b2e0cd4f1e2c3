"""Chat formatting by perspective rotation (operator 6).

For every participant of a dialogue the dialogue is rendered once with that
speaker as the assistant and the others as named users; loss masks are set on
the assistant's own turns.  Turns of ``system`` are instructions, not a
participant's: every rendering keeps them, unmasked.

A rendering is a text with the spans (start, end, code points) of its turns'
contents and whether each counts in the loss.  It is stored in rows of
``part_turns`` turns, so that no group of rows is unbounded: the texts of a
(dialogue, speaker) joined by ``part`` are the rendering, and spans count from
its beginning, across parts.  A turn's place in its dialogue comes
from a range sort with per-partition offsets, so a dialogue with a third of
all turns is dealt over many tasks; a part's offset is the size of what all
speakers' renderings have before it, plus what this speaker's own turns differ
by, counted in two steps (parts of a block, blocks of a dialogue).

Defined results: turns are ordered by (turn, role, text), nulls first; a null
role is the user "unknown", a null text an empty turn.  Repeated rows are
turns of their own.  A dialogue with no participant but the system has no
rendering.  Rows with a null conv_id are one dialogue.  Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainstar.llm.common import c, work_dir, written

SYSTEM, UNKNOWN, PART_TURNS = "system", "unknown", 64
BLOCK_PARTS = 4096   # parts whose counts one window adds up
_SYSTEM_HEAD, _OWN_HEAD, _USER_HEAD, _HEAD_END = "<|system|>\n", "<|assistant|>\n", "<|user:", "|>\n"


def placed(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, place, at): ``place`` counts the dialogue's turns before this
    one, ``at`` their characters where nobody's are the assistant's."""
    rows = turns.select(c(conv_col).alias("conv"), c(turn_col).alias("turn"),
                        F.coalesce(c(role_col), F.lit(UNKNOWN)).alias("role"),
                        F.coalesce(c(text_col), F.lit("")).alias("text"))
    order = ["conv", "turn", "role", "text"]
    ranged = rows.repartitionByRange(*[F.asc(x) for x in order]).sortWithinPartitions(*order)
    # Written once: a partition's rows stay where they are, whatever is recomputed later.
    table = written(ranged.withColumn("pid", F.spark_partition_id()), work_dir(turns.sparkSession, "turns"))
    local = F.row_number().over(Window.partitionBy("pid", "conv").orderBy("turn", "role", "text")) - 1
    size = (F.length("text") + 1 + F.when(F.col("role") == SYSTEM, F.lit(len(_SYSTEM_HEAD)))
             .otherwise(F.length("role") + len(_USER_HEAD + _HEAD_END))).cast("long")
    table = table.withColumn("size", size)
    earlier = Window.partitionBy("pid", "conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    # One row per dialogue and partition; only a dialogue cut by a border has more than one.
    sizes = table.groupBy("conv", "pid").agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    before = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv").alias("x_conv"), F.col("pid").alias("x_pid"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"))
    numbered = table.withColumns({"local": local, "local_at": F.coalesce(F.sum("size").over(earlier), F.lit(0))})
    return numbered.join(sizes, F.col("conv").eqNullSafe(F.col("x_conv")) & (F.col("pid") == F.col("x_pid"))) \
                   .select("conv", "turn", "role", "text", (F.col("local") + F.col("before")).alias("place"),
                           (F.col("local_at") + F.col("chars_before")).alias("at"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """One row per (dialogue, speaker, part): the part's text, and the spans of its turns in the whole rendering."""
    rows = placed(turns, conv_col, turn_col, role_col, text_col).withColumn(
        "part", F.floor(F.col("place") / part_turns).cast("long"))
    parts = rows.groupBy("conv", "part").agg(
        F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("said"))
    speakers = rows.filter(F.col("role") != SYSTEM).select(F.col("conv").alias("x_conv"),
                                                          F.col("role").alias("speaker")).distinct()
    both = parts.join(speakers, F.col("conv").eqNullSafe(F.col("x_conv"))).drop("x_conv")
    # Where the part begins: a turn of the speaker has another head than ``at`` counts for it.
    own = F.size(F.filter("said", lambda t: t["role"] == F.col("speaker"))).cast("long")
    both = both.withColumns({"own": own, "block": F.floor(F.col("part") / BLOCK_PARTS)})
    by = ["conv", "speaker"]
    before = Window.partitionBy(*by, "block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = both.groupBy(*by, "block").agg(F.sum("own").alias("n")).withColumn("earlier", F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    blocks = blocks.filter("earlier > 0").select(F.col("conv").alias("x_conv"), F.col("speaker").alias("x_speaker"),
                                                 F.col("block").alias("x_block"), "earlier")
    both = both.withColumn("inside", F.coalesce(F.sum("own").over(before), F.lit(0))).join(
        blocks, F.col("conv").eqNullSafe(F.col("x_conv")) & (F.col("speaker") == F.col("x_speaker"))
        & (F.col("block") == F.col("x_block")), "left")
    count = F.col("inside") + F.coalesce("earlier", F.lit(0))
    differs = len(_OWN_HEAD) - len(_USER_HEAD + _HEAD_END) - F.length("speaker")
    both = both.withColumn("at", F.col("at") + count * differs)

    def head(t):
        return (F.when(t["role"] == SYSTEM, F.lit(_SYSTEM_HEAD))
                 .when(t["role"] == F.col("speaker"), F.lit(_OWN_HEAD))
                 .otherwise(F.concat(F.lit(_USER_HEAD), t["role"], F.lit(_HEAD_END))))

    turns_ = F.transform("said", lambda t: F.struct(
        head(t).alias("head"), t["text"].alias("text"),
        (t["role"] == F.col("speaker")).alias("loss")))
    both = both.withColumn("turns", turns_)
    size = lambda t: F.length(t["head"]) + F.length(t["text"]) + 1
    # Spans: each turn's start is the size of the turns before it (a running sum over the part's turns).
    starts = F.aggregate(
        "turns", F.struct(F.col("at").alias("at"),
                          F.array().cast("array<struct<start:long,end:long,loss:boolean>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + size(t)).alias("at"),
            F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(t["head"])).alias("start"),
                (s["at"] + F.length(t["head"]) + F.length(t["text"])).alias("end"),
                t["loss"].alias("loss")))).alias("spans")),
        lambda s: s["spans"])
    return both.select(
        F.col("conv").alias(conv_col), "speaker", "part",
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit("\n")))).alias("text"),
        starts.alias("spans"))
