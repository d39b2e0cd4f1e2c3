"""Strict typed loads.

The reference copies CSV files into declared tables: header skipped, fixed
column list and types, an unquoted empty field is NULL (a quoted one is an empty text), a malformed row
aborts the load, ``not null`` columns reject NULLs.  Spark's CSV reader does
the first four with an explicit schema and ``FAILFAST``; it does not enforce
``nullable=False``, so ``require_not_null`` adds that contract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chainstar.sources.schemas import required_columns

NO_VALUE = "\x01"   # stands for an unquoted empty field while a row is parsed; such files hold no control characters


def load_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType,
             enforce_not_null: bool = True) -> DataFrame:
    """Typed CSV load with the reference's COPY semantics."""
    df = (spark.read.schema(schema)
          .option("header", True)
          .option("mode", "FAILFAST")
          .option("enforceSchema", False)   # header names must match the schema
          .option("nullValue", NO_VALUE)
          .option("emptyValue", "")         # a quoted empty field
          .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
          .csv(path))
    return require_not_null(df, required_columns(schema)) if enforce_not_null else df


def load_parquet(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
                 enforce_not_null: bool = True) -> DataFrame:
    """Parquet scan, optionally cast to a declared schema."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        if enforce_not_null:
            df = require_not_null(df, required_columns(schema))
    return df


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the query on a NULL in a ``not null`` column.

    A filter that is true for good rows and raises for bad ones: it runs in
    the scan's stage (no extra pass) and, unlike an unused projected column,
    cannot be pruned away by the optimizer.
    """
    if not columns:
        return df
    cond = None
    for c in columns:
        term = F.col(c).isNotNull()
        cond = term if cond is None else (cond & term)
    msg = "NULL in a not-null column: " + ", ".join(columns)
    return df.filter(F.when(cond, F.lit(True)).otherwise(F.raise_error(F.lit(msg)).cast("boolean")))
