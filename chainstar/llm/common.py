"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts: space and U+0009 to U+000D.
SPACE = "\x20\x09-\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def c(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below ``spark.checkpoint.dir``.

    Only a local session may do without that setting; on a cluster a folder
    of the driver's machine would not be seen by the executors, so this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="chainstar-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table in a shared folder: cuts lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, rows: int = 128) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of a few rows, so that Python holds few texts at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_batches(df: DataFrame, make: Callable[[], Callable], schema: str, rows: int = 128) -> DataFrame:
    """``mapInArrow`` over small slices: ``make()`` runs once a task and returns
    a function from column lists to column lists (in the order of ``schema``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, rows):
                out = work(*[x.to_pylist() for x in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)
            give_back()

    return df.mapInArrow(run, schema)


def partition_offsets(sizes: DataFrame, pid: str, n: str, out: str, by: str | None = None) -> DataFrame:
    """Running total of ``n`` before each ``pid``; ``sizes`` has one row per
    (``by``, ``pid``), so the window sees as many rows as there are partitions."""
    from pyspark.sql import Window

    w = Window.partitionBy(*([by] if by else [])).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)))


def give_back() -> None:
    """Gives the memory that Arrow keeps for later arrays back, so that a worker of several stages does not pile it up."""
    pa.default_memory_pool().release_unused()


def task_id() -> int:
    """The number of this task's partition."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
