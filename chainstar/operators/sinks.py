"""Materialisation (K1-K5, K7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chainstar.sources.files import require_not_null

LAYERS = ("src", "dim", "fact", "obt")


def create_namespaces(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    """K5: ``create schema if not exists`` for each layer (idempotent)."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def write_table(df: DataFrame, name: str | None = None, path: str | None = None, *,
                partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None,
                sort_within: Sequence[str] = (), mode: str = "overwrite",
                dynamic_partitions: bool = False) -> None:
    """K1/K3/K4: full rebuild as a Parquet table (or at ``path``).

    ``partition_by`` gives date partitions (prunable); with
    ``dynamic_partitions`` an overwrite replaces only the partitions present
    in ``df`` (K7, incremental daily builds).  ``bucket_by=(n, cols)`` (only
    with ``name``) writes co-located buckets so that later joins on ``cols``
    need no shuffle.  ``sort_within`` orders rows inside each file (K4).
    """
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if bucket_by is not None:
        if name is None:
            raise ValueError("bucketing needs a catalog table name")
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    if name is not None:
        if path is not None:
            w = w.option("path", path)
        w.saveAsTable(name)
    elif path is not None:
        w.save(path)
    else:
        raise ValueError("give a table name or a path")


def write_checked(df: DataFrame, grain: Sequence[str], not_null: Sequence[str] = (),
                  rules: Mapping[str, Column] | None = None, **target) -> dict[str, int]:
    """E6 on write: ``write_table(df, **target)``, counting in the same job what breaks the model's rules.

    Returns ``rows``, ``grain`` (rows beyond the first of their key), ``null:<column>`` and one
    count per entry of ``rules`` (rows where the condition is false; NULL passes, as
    in a SQL check constraint).  The counts are observed while rows are written, so nothing is
    read again; the key's check costs a shuffle only where ``df`` is not yet
    dealt by it.  Broken rows are written all the same: the caller decides.
    """
    columns = df.columns
    repeat = F.row_number().over(Window.partitionBy(*grain).orderBy(*grain)) > 1
    counts = {"rows": F.count(F.lit(1)), "grain": F.count_if("__repeat")}
    counts |= {f"null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    counts |= {name: F.count_if(~ok) for name, ok in (rules or {}).items()}
    seen = Observation()
    checked = df.withColumn("__repeat", repeat).observe(seen, *[n.alias(name) for name, n in counts.items()])
    write_table(checked.select(*columns), **target)
    return seen.get


def insert_declared(df: DataFrame, name: str, columns: Sequence[tuple[str, str, bool]],
                    path: str | None = None) -> DataFrame:
    """K4: create table ``name`` with declared ``columns`` (name, SQL type, not null), insert
    ``df`` and return the table.

    Values are stored under ANSI assignment: a column of another kind of type is
    refused, and a number or text that does not fit its declared type fails the
    job, as does a NULL in a not-null column (Spark does not check that itself).
    An older table of the name is dropped first.
    """
    spark = df.sparkSession
    if "." in name:
        create_namespaces(spark, [name.split(".")[0]])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ddl = ", ".join(f"`{c}` {kind}{' NOT NULL' if required else ''}" for c, kind, required in columns)
    where = f" LOCATION '{path}'" if path is not None else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{where}")
    rows = require_not_null(df, [c for c, _, required in columns if required])
    rows.select(*[c for c, _, _ in columns]).write.insertInto(name, overwrite=True)
    return spark.table(name)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """K7: remove partitions ``column=value`` below ``path`` that have lost all rows
    (a dynamic overwrite leaves them); missing ones are passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for v in values:
        part = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={v}")
        part.getFileSystem(conf).delete(part, True)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """K2: a view of this session, recomputed on every read (``plans.views`` makes lasting ones)."""
    df.createOrReplaceTempView(name.replace(".", "__"))
    return df
