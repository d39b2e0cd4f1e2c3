"""Exact deduplication by progressive refinement (operator 10, native).

Rows are grouped by the length of the normalised text and a hash of its
prefix together (length alone prunes nothing), and only rows of groups that still hold several rows have their full
text hashed (SHA-256).  Everything is DataFrame code.

Survivors are found through a bounded filter: a (length, prefix hash) group
maps to one of ``filter_bits`` buckets; the buckets of groups with several
rows (at most ``filter_bits`` integers, so the broadcast has a proven bound)
mark the rows that go on.  A bucket shared by chance only costs a hash.

Defined results: a null text counts as empty.  Texts are equal when identical
after each run of white space became one space.  The smallest doc_id of a
group stays; null doc_ids come last, and a group of null doc_ids has keep_id
null.  Rows that repeat a doc_id are rows of their own: each counts in
group_size, and one of them is kept (they tie, so which one is not told
apart).  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainstar.llm.common import c, work_dir, written

PREFIX = 64            # characters of the prefix hash
FILTER_BITS = 1 << 17  # buckets of the survivors' filter: the broadcast holds no more rows
SALTS = 16             # parts that the copies of one text are dealt into


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _refined(rows: DataFrame, text: Column, prefix: int, filter_bits: int) -> DataFrame:
    """``rows`` with x_len, x_pre and x_full (null where no other row can be equal)."""
    norm = rows.withColumn("x_norm", normalised(text))
    keyed = norm.withColumns({"x_len": F.length("x_norm"),
                              "x_pre": F.xxhash64(F.substring("x_norm", 1, prefix))})
    bucket = F.pmod(F.xxhash64("x_len", "x_pre"), F.lit(filter_bits)).cast("int")
    # Round 1 and 2 read text but shuffle two numbers a group, combined before the shuffle.
    by_prefix = keyed.select("x_len", "x_pre").groupBy("x_len", "x_pre").agg(F.count("*").alias("n"))
    by_length = by_prefix.groupBy("x_len").agg(F.sum("n").alias("n_len")).filter("n_len > 1")
    groups = by_prefix.filter("n > 1").join(by_length, "x_len", "left_semi")
    marked = groups.select(bucket.alias("x_bucket")).distinct().withColumn("x_hit", F.lit(True))
    # Round 3: the full text of the rows that are left.
    out = keyed.withColumn("x_bucket", bucket).join(F.broadcast(marked), "x_bucket", "left")
    return (out.withColumn("x_full", F.when(F.col("x_hit"), F.unhex(F.sha2("x_norm", 256))))
               .drop("x_bucket", "x_hit"))


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None,
             prefix: int = PREFIX, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, and the ``carry`` columns.

    ``carry`` maps names to expressions over ``x_norm``, the normalised text.
    """
    carry = carry or {}
    rows = docs.select(c(id_col).alias("x_id"), c(text_col).alias("text"))
    rows = _refined(rows, F.col("text"), prefix, filter_bits)
    rows = rows.select("x_id", "x_len", "x_pre", "x_full", *[v.alias(f"y_{k}") for k, v in carry.items()])
    # Written once without the texts: what follows reads a few numbers a row.
    rows = written(rows, work_dir(docs.sparkSession, "refined"))
    out = [c(f"y_{k}").alias(k) for k in carry]
    key = ["x_len", "x_pre", "x_full"]
    single = rows.filter("x_full is null").select(
        F.col("x_id").alias(id_col), F.col("x_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *out)
    # The copies of a hot text are dealt by a salt of their ids; each group's one row is there for every salt.
    several = rows.filter("x_full is not null").withColumn("x_salt", F.pmod(F.xxhash64("x_id"), F.lit(SALTS)))
    groups = (several.groupBy(*key).agg(F.min("x_id").alias("keep_id"), F.count("*").alias("group_size"))
                     .withColumn("x_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    joined = several.join(groups, [*key, "x_salt"])
    # Rows that repeat the winning id tie: one of them is kept.
    first = F.row_number().over(Window.partitionBy("x_id", "x_salt", *key).orderBy(F.lit(0))) == 1
    pairs = joined.withColumn("kept", F.col("x_id").eqNullSafe(F.col("keep_id")) & first).select(
        F.col("x_id").alias(id_col), "keep_id", "group_size", "kept", *out)
    return single.unionByName(pairs)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX,
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without later copies; the columns of ``docs``.

    Rows without a possible copy pass straight through; only the others are
    shuffled, and copies within a partition are combined before.
    """
    row = F.struct(*[c(x) for x in docs.columns])
    rows = _refined(docs.select(row.alias("r"), c(text_col).alias("x_text")), F.col("x_text"), prefix, filter_bits)
    single = rows.filter("x_full is null").select("r")
    several = rows.filter("x_full is not null").withColumn("x_id", F.col("r").getField(id_col))
    order = F.struct(F.col("x_id").isNull(), F.col("x_id"))
    won = several.groupBy("x_len", "x_pre", "x_full").agg(F.min_by("r", order).alias("r"))
    return single.unionByName(won.select("r")).select(*[F.col("r").getField(x).alias(x) for x in docs.columns])
