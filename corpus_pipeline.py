"""From raw documents to packed training sequences.

``STAGES`` are functions (spark, docs, sf_dir) -> DataFrame.  Each but the
last returns the columns of its input; its result is written as Parquet and
read again as the next one's docs.  Nulls, empty and very long texts, repeated
rows, empty tables and extra columns are handled as the operators' docstrings
say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainstar.llm import exact_dedup, packing, pii, quality, simhash
from chainstar.llm.common import table, work_dir, written
from chainstar.llm.queries import BYTE_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines (n_chars follows the text)."""
    return quality.clean(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (4-word shingles, 4 bits), the document of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked (n_chars follows the text)."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack(docs, BYTE_BPE, end_id=0)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_duplicates), ("simhash_dedup", near_duplicates),
          ("pii", personal_data), ("packing", packed)]

# SimHash fingerprints and BPE ids have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), work_dir(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
