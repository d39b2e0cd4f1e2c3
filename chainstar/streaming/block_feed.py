"""Daily facts kept current from a live feed of block files.

A Structured Streaming file source reads new block files; each micro-batch
(``foreachBatch``) is a delivery of ``BlockFeed``: its rows are stored by day
and batch, its keys go into the key-to-day index, and exactly the days it
touches are rebuilt, former days of moved blocks included (E1, dynamic
partition overwrite).  The daily
measures need first/last block and adjustment times over the whole day, so
they are recomputed from the stored rows rather than kept as streaming
state: a late block of any age is folded in exactly, and a replayed batch
(after a failure, from the stream checkpoint) rewrites the same partitions
with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainstar.operators.sinks import write_table
from chainstar.plans.extensions import BlockFeed
from chainstar.sources.schemas import BLOCK, with_loaded_at

FEED_SCHEMA = with_loaded_at(BLOCK)


def block_stream(spark: SparkSession, feed_dir: str, files_per_batch: int = 1) -> DataFrame:
    """The feed as a streaming DataFrame with the source schema (no inference)."""
    return (spark.readStream.schema(FEED_SCHEMA)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(feed_dir))


def run_block_feed(spark: SparkSession, feed_dir: str, src_path: str, fact_path: str,
                   checkpoint: str, run_ts=None, files_per_batch: int = 1,
                   available_now: bool = True):
    """Start the feed; returns the StreamingQuery (finished when ``available_now``).

    ``src_path`` is the stored feed; its key-to-day index lies beside it (``BlockFeed``).
    """
    feed = BlockFeed(spark, src_path, {"fact.network_stats_1d": fact_path}, run_ts=run_ts)

    writer = (block_stream(spark, feed_dir, files_per_batch).writeStream
              .foreachBatch(feed.deliver)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def _instant() -> Column:
    """The block time, read as UTC."""
    return F.expr("CAST(concat(CAST(`timestamp` AS STRING), 'Z') AS TIMESTAMP)")


def daily_counts_stream(blocks: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Additive daily measures as a pure streaming aggregation.

    ``withWatermark`` bounds the state: a day's row is final once the
    watermark passes its end; later copies of a block within the watermark
    are dropped.  Only additive measures are kept here; the full daily fact
    comes from ``run_block_feed``.  Watermarks need a zoned timestamp, so the
    block time (no zone) is read as a wall clock in UTC, whatever the session's zone.
    """
    b = (blocks.withColumn("event_time", _instant())
         .withWatermark("event_time", lateness)
         .dropDuplicatesWithinWatermark(["block_hash"]))
    return (b.groupBy(F.window("event_time", "1 day").alias("day"))
            .agg(F.count("block_hash").alias("block_count"),
                 F.sum("reward_subsidy").alias("reward_subsidy_sum"),
                 F.sum("reward_tx_fee_sum").alias("reward_tx_fee_sum"),
                 F.sum("tx_count").alias("tx_count"),
                 F.min("blockheight").alias("blockheight_first"),
                 F.max("blockheight").alias("blockheight_last")))


def deliver_final_days(spark: SparkSession, feed_dir: str, base: str, lateness: str = "1 day") -> None:
    """E7, finality: fold the feed's new files, one delivery, into days that never change again.

    Two streams with checkpoints of their own read the delivery, each in one micro-batch:

    * ``base/late``: rows whose block time is not after the newest time of all earlier
      deliveries less ``lateness``.  The second stream drops exactly these (its
      watermark stands there), so they are kept aside for a rebuild (``run_block_feed``).
    * ``base/days``: ``daily_counts_stream`` in append mode; a day is written once, when
      the watermark passes its end.  State holds the blocks and days within ``lateness`` only.

    A repeated or half-done delivery is taken up from the checkpoints; the batch
    folders of late rows are replaced as a whole.  The files of the next delivery
    must not arrive before this call returns, or the streams would cut the feed differently.
    """
    def keep_late(rows: DataFrame, number: int) -> None:
        rows = rows.withColumn("__at", _instant())
        bound = None
        if number:      # one value of each earlier delivery
            newest = spark.read.schema("newest long, batch long").parquet(f"{base}/newest").filter(F.col("batch") < number)
            (bound,) = newest.agg(F.max("newest")).first()
        # The watermark has milliseconds, cut off.
        bound = F.timestamp_millis(F.lit(bound).cast("long")) - F.expr(f"INTERVAL {lateness}")
        write_table(rows.filter(F.col("__at") <= bound).drop("__at"), path=f"{base}/late/batch={number}")
        write_table(rows.agg(F.unix_millis(F.max("__at")).alias("newest")), path=f"{base}/newest/batch={number}")

    feed = spark.readStream.schema(FEED_SCHEMA).parquet(feed_dir)     # no limit of files: a delivery is a batch
    aside = (feed.writeStream.foreachBatch(keep_late).option("checkpointLocation", f"{base}/checkpoint_late")
             .trigger(availableNow=True).start())
    aside.awaitTermination()
    counts = daily_counts_stream(feed, lateness).select(
        F.date_from_unix_date(F.expr("int(unix_seconds(day.start) div 86400)")).alias("event_date"), F.col("*")).drop("day")
    final = (counts.writeStream.outputMode("append").format("parquet").option("path", f"{base}/days")
             .option("checkpointLocation", f"{base}/checkpoint_days").trigger(availableNow=True).start())
    final.awaitTermination()


def final_days(spark: SparkSession, base: str) -> DataFrame:
    """Every final day with its counts, and the number of rows of a day that came too late (counts NULL where
    such a day had no row in time)."""
    late = (spark.read.schema(FEED_SCHEMA).parquet(f"{base}/late")
            .groupBy(F.to_date("timestamp").alias("event_date")).agg(F.count(F.lit(1)).alias("late_rows")))
    days = spark.read.parquet(f"{base}/days")
    return (days.join(late, "event_date", "full")
            .withColumn("late_rows", F.coalesce("late_rows", F.lit(0).cast("long"))))
