"""Key-to-day index of a stored feed (K7, E1, E7): on which days copies of a key are held.

A delivery that brings a key again may change the days on which its earlier
copies lie.  Looking those up in the feed itself reads the feed; this index
keeps them apart, below one folder:

* ``keys/bucket=<hash of the key>/delivery=<id>``: (key, event_date).  A delivery
  reads only the buckets that its own keys fall into, and adds files of its own;
* ``pairs/delivery=<id>``: (event_date, other_date), days that share a key.  They
  are pairs of calendar days, so they stay few whatever the feed holds, and tell
  which further days must be read to recompute a set of days.

Files are only added, under the delivery's id, so a replayed delivery rewrites
its own files with the same rows and a job that fails halfway harms nothing
older.  ``compacted`` copies an index with many small deliveries to a new folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainstar.operators.sinks import write_table

BUCKETS = 16


@dataclass
class KeyDays:
    """The index below ``path``; ``buckets`` must not change during its life.

    Choose ``buckets`` so that one bucket of the whole history fits a task or
    two (the default is for tests); a list of bucket numbers is the only thing
    that reaches the driver.
    """

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path.rstrip('/')}/{part}")
        except AnalysisException:      # the first delivery: the folder is not there yet
            return self.spark.createDataFrame([], schema)

    def _keys(self) -> DataFrame:
        return self._read("keys", "key string, event_date date, bucket int, delivery long")

    def _pairs(self) -> DataFrame:
        return self._read("pairs", "event_date date, other_date date, delivery long")

    def _numbered(self, held: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        return held.filter(F.col("key").isNotNull()).select("key", "event_date", bucket.alias("bucket")).distinct()

    def lookup(self, held: DataFrame, delivery: int) -> DataFrame:
        """(key, event_date) of what deliveries other than ``delivery`` hold of the keys of ``held``."""
        numbers = sorted(r[0] for r in held.select("bucket").distinct().collect())    # at most ``buckets``
        known = self._keys().filter(F.col("bucket").isin(numbers) & (F.col("delivery") != delivery))
        return known.join(held.select("key").distinct(), "key", "left_semi").select("key", "event_date").distinct()

    def add(self, held: DataFrame, delivery: int) -> DataFrame:
        """Record a delivery's (key, event_date); return the days that it touches: its
        own, and those on which earlier copies of its keys lie (event_date)."""
        mine = f"{self.path.rstrip('/')}/new/delivery={delivery}"
        write_table(self._numbered(held), path=mine)
        new = self.spark.read.schema("key string, event_date date, bucket int").parquet(mine)
        former = self.lookup(new, delivery)
        days = new.select("key", "event_date")
        other = former.unionByName(days).withColumnRenamed("event_date", "other_date")
        # One row a key and day on both sides: a key that moved often meets its days, not its copies.
        shared = days.join(other, "key").filter("NOT event_date <=> other_date").select("event_date", "other_date")
        both = shared.unionByName(shared.select(F.col("other_date").alias("event_date"),
                                                F.col("event_date").alias("other_date")))
        tag = F.lit(delivery).cast("long").alias("delivery")
        write_table(both.distinct().select("*", tag), path=f"{self.path}/pairs", partition_by=["delivery"],
                    dynamic_partitions=True)
        write_table(new.select("*", tag).hint("rebalance", "bucket"), path=f"{self.path}/keys",
                    partition_by=["bucket", "delivery"], sort_within=["key"], dynamic_partitions=True)
        # From the written pairs and keys: what was just added is not read again.
        other = self._pairs().filter(F.col("delivery") == delivery).select(F.col("other_date").alias("event_date"))
        return new.select("event_date").unionByName(other).distinct()

    def near(self, days: DataFrame) -> DataFrame:
        """Days (event_date) that share a key with one of ``days``, those included."""
        return (self._pairs().join(days.select("event_date").distinct(), "event_date", "left_semi")
                .select(F.col("other_date").alias("event_date")).unionByName(days.select("event_date")).distinct())

    def compacted(self, path: str) -> "KeyDays":
        """A copy below ``path`` with one delivery, numbered as the latest."""
        last = self._keys().agg(F.max("delivery")).first()[0] or 0
        tag = F.lit(last).cast("long").alias("delivery")
        write_table(self._keys().select("key", "event_date", "bucket").distinct().select("*", tag)
                    .hint("rebalance", "bucket"), path=f"{path}/keys", partition_by=["bucket", "delivery"],
                    sort_within=["key"])
        write_table(self._pairs().select("event_date", "other_date").distinct().select("*", tag),
                    path=f"{path}/pairs", partition_by=["delivery"])
        return KeyDays(self.spark, path, self.buckets)
