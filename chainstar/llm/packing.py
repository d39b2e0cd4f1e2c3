"""Packing by power-of-two decomposition (operator 2).

Each document's ids (its end id included) are cut into pieces of the largest
length and then one piece for each binary digit of what is left.  Pieces of
equal length share a bucket; each is a sequence of its own at a power of two,
so nothing is padded and no sequence crosses documents.

Defined results: a null or empty text is its end id alone (one piece of
length 1).  A null doc_id is passed through.  Repeated rows are packed once
each.  Extra columns are ignored.  An empty table gives no pieces.  A very long
document only makes more pieces.  ``sequence_id`` is unique; within a bucket
the ids are consecutive.
"""

from __future__ import annotations

import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chainstar.llm.common import c, give_back, partition_offsets, task_id, work_dir, written
from chainstar.llm.tokens import as_binary, by_bytes, encoder, with_end

REMEMBERED = 200_000   # chunks that a worker remembers; the workers of an executor have what its heap leaves


def pieces(n: int, longest: int = 1024) -> list[int]:
    """Lengths whose sum is ``n``: ``longest`` again and again, then the binary digits of the rest."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in reversed(range(longest.bit_length() - 1)) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         longest: int = 1024) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), ids_crc32,
    doc_tokens, sequence_id, offset (0).

    The pieces are written once to the shared folder, so that their numbers
    stay the same whatever executor is lost later.
    """
    assert longest > 0 and longest & (longest - 1) == 0, "longest must be a power of two"
    kind = docs.select(c(id_col)).schema[0].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
              "pid long, rank long")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def cut_up(batches):
        enc, pid, count = encoder(tokenizer, REMEMBERED), task_id(), {}
        for batch in batches:
            for part in by_bytes(batch, 1):
                flat, at = with_end(*enc.flat(part.column(1)), end_id)
                rows = []
                for row, n in enumerate(np.diff(at).tolist()):
                    start = 0
                    for m in pieces(n, longest):
                        rank = count[m] = count.get(m, -1) + 1
                        rows.append((row, start, m, n, rank))
                        start += m
                row, start, length, n, rank = np.array(rows, dtype=np.int64).T
                ends = np.append(0, np.cumsum(length))
                data = memoryview(flat).cast("B")
                crc = [zlib.crc32(data[a:b]) for a, b in pairwise((4 * ends).tolist())]
                out = (part.column(0).take(pa.array(row)), start, length, as_binary(flat, ends), crc, n,
                       np.full(len(row), pid), rank)
                yield pa.RecordBatch.from_arrays(
                    [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                     for v, f in zip(out, arrow, strict=True)], schema=arrow)
                give_back()

    cut = docs.select(c(id_col), c(text_col)).mapInArrow(cut_up, schema)
    cut = written(cut, work_dir(docs.sparkSession, "pieces"))
    # One row per bucket and task: the buckets' first numbers and the tasks' places in them.
    sizes = cut.groupBy("length", "pid").agg(F.count("*").alias("n"))
    within = partition_offsets(sizes, "pid", "n", "before", by="length")
    buckets = sizes.groupBy("length").agg(F.sum("n").alias("m"))
    first = partition_offsets(buckets, "length", "m", "first")
    places = within.join(first, "length").select("length", "pid", (F.col("before") + F.col("first")).alias("place"))
    # At most one row per length and task, sent to the pieces: their ids are not shuffled.
    return cut.join(F.broadcast(places), ["length", "pid"]).select(
        c(id_col), "start", "length", "ids", "ids_crc32", "doc_tokens",
        (F.col("place") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
