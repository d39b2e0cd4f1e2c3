"""Benchmark decontamination by a prefix-filtered set join (operator 11, native).

An item's windows are its runs of ``window`` consecutive words (one window of
all its words if it has fewer).  A window is a set of placed shingles of
``shingle`` words; a shorter window is one shingle.  Shingles are ordered by
rarity, the number of their occurrences in the documents.  A window occurs
only where all its shingles do, so its necessary prefix in that order is the
first, rarest one: documents' shingles are joined with these alone.  The
shingle's place says where the window would begin, and the lengths whether it
fits there; the words in its place are then compared exactly.

Texts are read once: their words and a row number go to the shared folder and
are read twice from there, for the rarity and for the join.  Windows go
through both in blocks of about ``block_bytes``, so no broadcast grows with
the benchmark (a single larger window is a block of its own size).  Shuffled
are counts of the items' shingles, three short columns a document, and hits.

Words are the maximal runs of digits, a-z and characters beyond ASCII after
A-Z (no other letter) became lower case.

Defined results: a null text has no words, and so has an empty one; an item
without words has no window.  Each row of ``docs`` gives one row, also where
ids are null or repeated.  Items of one id count once; items of a null id
mark their words as hit but are neither listed nor counted.  Only the id and
text columns are read.  An empty table of documents gives an empty result, an
empty one of items documents without hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainstar.llm.common import c, work_dir, written

WINDOW = 10                # words of a window
SHINGLE = 3                # words of a shingle
BLOCK_BYTES = 32 << 20     # of windows that are broadcast at a time
SPANS = "array<struct<start:int,end:int>>"

_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Beyond ASCII, only these kinds of characters have a lower case.
_OTHER_UPPER = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is: ``lower`` where it does
    the same, else the much slower ``translate``."""
    return F.when(text.rlike(_OTHER_UPPER), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def spaced_words(text: Column) -> Column:
    """The words of a text, joined by single spaces ('' for none)."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), _GAPS, " "))


def _shingle_hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in range(k)])


def _shingles(rows: DataFrame, k: int, *keep: str) -> DataFrame:
    """``rows`` (words, n, ``keep``) once for each k-word shingle: its place and hash.

    Explode, hash and the join that follows are one generated stage, so the
    words are not copied to the rows between.
    """
    # The outer form: for the plain one the planner adds a filter that splits each text again.
    each = rows.filter(F.col("n") >= k).select("words", "n", *keep, F.posexplode_outer("words").alias("place", "_w"))
    return (each.filter(F.col("place") <= F.col("n") - k)
                .select("words", "n", *keep, "place", _shingle_hash(F.col("words"), F.col("place"), k).alias("h")))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(words, n, items): every distinct window of the items, with the item ids as sorted strings."""
    rows = items.select(c(id_col).cast("string").alias("item"), spaced_words(c(text_col)).alias("t"))
    rows = rows.filter("t <> ''").select("item", F.split("t", " ").alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = rows.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), F.lit(window)).alias("words"))
    return (cut.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
               .withColumn("n", F.size("words")))


def _hits(docs: DataFrame, windows: DataFrame, shingle: int) -> list[DataFrame]:
    """(rid, start, end, items) of the occurrences of one block's windows; a block may be empty."""
    sizes = [r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect()]   # at most `shingle` numbers
    found = []
    for k in sorted(sizes):
        own = windows.filter(F.least("n", F.lit(shingle)) == k)
        placed = _shingles(own, k, "items")
        # Rarity: occurrences of the items' shingles, counted before the shuffle.
        seen = (_shingles(docs, k).select("h").join(F.broadcast(placed.select("h").distinct()), "h", "left_semi")
                .groupBy("h").agg(F.count("*").alias("times")))
        ranked = placed.join(seen, "h")    # a shingle that no document holds rules its window out
        whole = ranked.groupBy("words", "n", "items").agg(
            F.count("*").alias("held"), F.min(F.struct("times", "h", "place")).alias("least"))
        prefix = whole.filter(F.col("held") == F.col("n") - k + 1).select(
            F.col("least.h").alias("h"), F.col("least.place").alias("off"), F.col("n").alias("len"),
            F.col("words").alias("win"), "items")
        begin = F.col("place") - F.col("off")
        found.append(_shingles(docs, k, "rid").join(F.broadcast(prefix), "h")
                     .filter((begin >= 0) & (begin + F.col("len") <= F.col("n")))          # place and length
                     .filter(F.slice("words", begin + 1, F.col("len")) == F.col("win"))    # exact
                     .select("rid", begin.alias("start"), (begin + F.col("len")).alias("end"), "items"))
    return found


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans (start and end, in words, of each
    occurrence), items (ids as sorted strings), contaminated."""
    spark = docs.sparkSession
    base = work_dir(spark, "decontaminate")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), c(id_col).alias("x_id"),
                       spaced_words(c(text_col)).alias("t"))
    n = F.length("t") - F.length(F.replace("t", F.lit(" "))) + F.least(F.length("t"), F.lit(1))
    rows = written(rows.withColumn("n", n), f"{base}/words").withColumn("words", F.split("t", " "))
    windows = written(item_windows(items, item_id_col, item_text_col, window), f"{base}/windows")
    size = F.length(F.concat_ws(" ", "words")) * 2 + F.length(F.concat_ws(" ", "items")) + 100
    total = windows.agg(F.sum(size.cast("long"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    parts = [x for b in range(blocks)
             for x in _hits(rows, windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b), shingle)]
    if not parts:
        return rows.select(F.col("x_id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                           F.lit(0).cast("long").alias("n_hit"), F.array().cast(SPANS).alias("spans"),
                           F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))
    hits = written(reduce(DataFrame.unionByName, parts), f"{base}/hits")
    # What a group collects is bounded by its one document's words and the items.
    per_doc = hits.groupBy("rid").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = rows.select("rid", "x_id", "n").join(per_doc, "rid", "left")
    return out.select(F.col("x_id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                      F.coalesce(_covered("spans"), F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.col("spans").isNotNull().alias("contaminated"))


def _covered(spans: str) -> Column:
    """How many places the sorted spans cover together."""
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("top"))
    return F.aggregate(spans, first, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["top"]), F.lit(0))).alias("n"),
        F.greatest(a["top"], s["end"]).alias("top")), lambda a: a["n"])
