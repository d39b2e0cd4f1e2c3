"""Token ids in compressed files (operator 9).

Texts are sorted by doc_id, tokenised, and their ids written as rANS blocks
(``rans.py``) of whole documents.  A block stands alone: with the shared
frequency table of the folder it can be decoded on any machine.  The blocks
lie in Spark-written Parquet files (``blocks``: file, pos, doc_ids, sizes,
n_tokens, payload; pos counts the file's documents before the block), so that a lost executor's half-written file never counts and any
store that Spark reaches will do; the table lies beside them (``table``).

Defined results: a null or empty text is its end id alone.  Documents are in
ascending doc_id order, null doc_ids first; repeated doc_ids stay rows of
their own (their order among each other is open).  Extra columns are ignored.
An empty table gives an empty folder that reads back as no row.  A document
longer than a block is a block by itself.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chainstar.llm.common import c, map_batches, partition_offsets, slices, task_id, work_dir, written
from chainstar.llm.rans import Coder, quantise
from chainstar.llm.tokens import as_binary, by_bytes, encoder, with_end

BLOCK_TOKENS = 1 << 17
SIDE_BY_SIDE = 16    # blocks encoded or decoded together


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(file, pos, x_id, ids): files are ascending ranges of ids, pos is a row's place in its file."""
    rows = docs.select(c(id_col).alias("x_id"), c(text_col).alias("text"))
    ordered = rows.repartitionByRange(F.asc("x_id")).sortWithinPartitions(F.asc("x_id"))
    schema = f"file int, pos long, x_id {rows.schema['x_id'].dataType.simpleString()}, ids binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def encode(batches):
        enc, file, pos = encoder(tokenizer), task_id(), 0
        for batch in batches:
            for part in by_bytes(batch, 1):
                n = part.num_rows
                ids = as_binary(*with_end(*enc.flat(part.column(1)), end_id))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file), type=arrow[0].type), pa.array(np.arange(pos, pos + n)),
                     part.column(0).cast(arrow[2].type), ids], schema=arrow)
                pos += n

    return ordered.mapInArrow(encode, schema)


def _counts(batches):
    """Occurrences of each id of a partition (map side of the corpus count)."""
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for part in slices(batch):
            ids = part.column(0)
            at = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
            flat = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[at[0]:at[-1]].view("<u4")
            n = np.bincount(flat, minlength=len(total))
            n[:len(total)] += total
            total = n
    used = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["token", "n"])


def frequencies(ids: DataFrame) -> DataFrame:
    """(token, n, freq): counts over all ids, and the shared table's frequencies.

    A row per id of the vocabulary at most, whatever the size of the corpus.
    """
    spark = ids.sparkSession
    counts = ids.select("ids").mapInArrow(_counts, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = sorted((r.token, r.n) for r in counts.collect())
    n = np.zeros(rows[-1][0] + 1 if rows else 0, dtype=np.int64)
    n[[r[0] for r in rows]] = [r[1] for r in rows]
    freq = quantise(n)
    return spark.createDataFrame([(t, k, int(freq[t])) for t, k in rows], "token int, n long, freq long")


def _table(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("token int, n long, freq long").parquet(f"{path}/table").collect()   # bounded by the vocabulary
    freq = np.zeros(max((r.token for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        freq[r.token] = r.freq
    return freq


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the ids of ``docs`` below ``path``."""
    spark = docs.sparkSession
    ids = written(tokenised(docs, tokenizer, end_id, id_col, text_col), work_dir(spark, "token-ids"))
    frequencies(ids).coalesce(1).write.mode("overwrite").parquet(f"{path}/table")   # at most a vocabulary of rows
    freq = spark.sparkContext.broadcast(_table(spark, path))
    kind = ids.schema["x_id"].dataType.simpleString()
    schema = f"file int, pos long, doc_ids array<{kind}>, sizes array<int>, n_tokens long, payload binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def blocks(batches):
        coder = Coder(freq.value)
        held: list[tuple] = []       # the documents of the block to come
        ready: list[list[tuple]] = []    # whole blocks, encoded side by side
        size = waiting = 0

        def flush():
            flats = [np.frombuffer(b"".join([x[3] for x in block]), "<u4") for block in ready]
            cols = ([b[0][0] for b in ready], [b[0][1] for b in ready], [[x[2] for x in b] for b in ready],
                    [[len(x[3]) // 4 for x in b] for b in ready], [len(x) for x in flats], coder.encode_all(flats))
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(cols, arrow)], schema=arrow)

        for batch in batches:
            for part in slices(batch):
                for row in zip(*[x.to_pylist() for x in part.columns]):
                    n = len(row[3]) // 4
                    # Whole documents that follow one another in one file.
                    if held and ((row[0], row[1]) != (held[-1][0], held[-1][1] + 1) or size + n > block_tokens):
                        ready.append(held)
                        waiting += size
                        held, size = [], 0
                        if len(ready) >= SIDE_BY_SIDE or waiting >= SIDE_BY_SIDE * BLOCK_TOKENS:
                            yield flush()
                            ready, waiting = [], 0
                    held.append(row)
                    size += n
        if held:
            ready.append(held)
            yield flush()

    ids.mapInArrow(blocks, schema).write.mode("overwrite").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document from the files: id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start``: ids of all documents before it.  Blocks are decoded where they
    are read; only their numbers are shuffled to place them.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    freq = spark.sparkContext.broadcast(_table(spark, path))

    def make():
        coder = Coder(freq.value)

        def work(files, places, doc_ids, sizes, payloads):
            out = []
            for file, pos, ids, ns, flat in zip(files, places, doc_ids, sizes, coder.decode_all(payloads)):
                at = 0
                for key, n in zip(ids, ns):
                    part = flat[at:at + n]
                    out.append((file, pos, key, at, n, zlib.crc32(part), part.tobytes() if with_ids else None))
                    at += n
            return list(zip(*out)) if out else [[]] * 7
        return work

    docs = map_batches(blocks.select("file", "pos", "doc_ids", "sizes", "payload"), make,
                       f"file int, pos long, x_id {kind}, at long, n_tokens long, ids_crc32 long, ids binary", rows=SIDE_BY_SIDE)
    sizes = blocks.select("file", "pos", "n_tokens")
    files = partition_offsets(sizes.groupBy("file").agg(F.sum("n_tokens").alias("n")), "file", "n", "file_start")
    before = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    places = (sizes.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
                   .join(files.select("file", "file_start"), "file")
                   .select("file", "pos", (F.col("before") + F.col("file_start")).alias("place")))
    return docs.join(places, ["file", "pos"]).select(
        F.col("x_id").alias(id_col), (F.col("place") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))
