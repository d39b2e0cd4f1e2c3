"""Ranked lexical search, reversed (operator 12): documents stream through an index of the items.

The items' terms form an inverted index (term -> items and how often each
holds it), which is broadcast in blocks of at most ``block_postings`` postings
(an item larger than that is a block of its own).  A first pass counts the
documents that hold each of these terms, the documents with any term, and all
terms.  A second pass counts each document's terms, looks them up in the index
and adds up the scores of the items they touch; each item keeps a heap of its
``k`` best documents, bounded whatever the number of documents.  The heaps of
all partitions are merged in two steps, the first dealt by a salt, so no task
sees the heaps of all partitions at once.

Terms are the maximal runs of digits, A-Z, a-z and characters beyond ASCII;
only A-Z become lower case.  With N documents that hold a term, L terms in
all (repeats counted), n terms in one document, df documents that hold a term
and tf its occurrences in a document::

    weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m      = 25 + (75 n N) div L
    score  = sum over the item's terms, repeats included, of
             weight * ((1000000000 tf) div (1000 tf + 8 m))

Defined results: document ids are integers.  Null and empty texts have no terms; an item without terms,
or whose terms no document holds, has no rows.  Only scores above 0 count.
Ties go by ascending id, null ids last.  Rows that repeat an id are documents
of their own, and so are rows of ``items`` that repeat an id: each has its own
ranks from 1.  Extra columns are not read.  Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainstar.llm.common import c, slices, work_dir, written

BLOCK_POSTINGS = 1_000_000   # postings of the index that is broadcast at a time
SALTS = 64                   # parts that the heaps of an item are dealt into
LONG = 1 << 20               # bytes of a text that are cut into terms at a time

# Of UTF-8 bytes: A-Z to lower case, the ASCII characters outside of terms to spaces; bytes
# beyond ASCII stay.
_TABLE = bytes(x if x > 0x7F or chr(x).isalnum() else 0x20 for x in bytes(range(256)).lower())


def term_counts(text: str | bytes | None) -> Counter:
    """Occurrences of each term (in UTF-8) of a whole text."""
    if not text:
        return Counter()
    low = (text.encode() if isinstance(text, str) else text).translate(_TABLE)
    if len(low) <= LONG:
        return Counter(low.split())
    counts, at = Counter(), 0
    while at < len(low):        # cut at spaces, so that there is no list of all terms
        end = low.find(b" ", at + LONG)
        end = len(low) if end < 0 else end
        counts.update(low[at:end].split())
        at = end
    return counts


class Index:
    """Terms of a block of items, and each term's postings (item, repeats) one after the other."""

    def __init__(self, items: list[Counter]):
        self.n_items = len(items)
        by_term: dict[bytes, list[tuple[int, int]]] = {}
        for i, counts in enumerate(items):
            for term, times in counts.items():
                by_term.setdefault(term, []).append((i, times))
        self.number = {term: j for j, term in enumerate(by_term)}
        self.start = np.cumsum([0, *map(len, by_term.values())]).astype(np.int64)
        flat = [p for ps in by_term.values() for p in ps]
        self.item = np.array([p[0] for p in flat], dtype=np.int64)
        self.times = np.array([p[1] for p in flat], dtype=np.int64)

    def held(self, counts: Counter) -> tuple[list[int], list[int]]:
        """Numbers of the index's terms that a document holds, and their occurrences."""
        number = self.number
        if len(counts) < len(number):
            found = [(number[t], tf) for t, tf in counts.items() if t in number]
        else:
            found = [(j, counts[t]) for t, j in number.items() if t in counts]
        return [f[0] for f in found], [f[1] for f in found]

    def scores(self, terms: list[int], tf: list[int], n: int, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
        """The document's score for every item."""
        m = 25 + (75 * n * n_docs) // n_terms          # whole numbers of any size
        j = np.array(terms, dtype=np.int64)
        value = weight[j] * np.array([1_000_000_000 * x // (1000 * x + 8 * m) for x in tf], dtype=np.int64)
        size = self.start[j + 1] - self.start[j]
        place = np.repeat(self.start[j] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out = np.zeros(self.n_items, dtype=np.int64)
        np.add.at(out, self.item[place], np.repeat(value, size) * self.times[place])
        return out


class Heaps:
    """The k best documents of each item: highest score, then lowest id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.zeros(n_items, dtype=np.int64)     # a lower score can't enter; 0 never can
        self.order = 0

    def add(self, doc: int | None, scores: np.ndarray) -> None:
        for i in np.nonzero((scores >= self.least) & (scores > 0))[0]:
            heap, self.order = self.heaps[i], self.order + 1
            entry = (int(scores[i]), doc is not None, -(doc or 0), self.order, doc)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry[:3] > heap[0][:3]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]

    def rows(self) -> tuple[list[int], list[int | None], list[int]]:
        flat = [(i, e[4], e[0]) for i, heap in enumerate(self.heaps) for e in heap]
        return [f[0] for f in flat], [f[1] for f in flat], [f[2] for f in flat]


def _statistics(docs: DataFrame, index) -> tuple[np.ndarray, int, int]:
    """(df of each term of the index, N, L) over all documents."""
    schema = pa.schema([("t", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, df, n_docs, n_terms = index.value, Counter(), 0, 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column(1).to_pylist():
                    counts = term_counts(text)
                    if counts:
                        n_docs += 1
                        n_terms += counts.total()
                        df.update(idx.held(counts)[0])
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *df.keys()], pa.int64()),
                                          pa.array([n_docs, n_terms, *df.values()], pa.int64())], schema=schema)

    # At most one row for each term of the block comes to the driver.
    got = dict(docs.mapInArrow(run, "t long, v long").groupBy("t").agg(F.sum("v")).collect())
    df = np.array([got.get(j, 0) for j in range(len(index.value.number))], dtype=np.int64)
    return df, got.get(-1, 0), got.get(-2, 0)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)


def _block_heaps(docs: DataFrame, items: list[Counter], k: int) -> DataFrame | None:
    """(item number in the block, doc, score): every partition's heaps."""
    sc = docs.sparkSession.sparkContext
    index = sc.broadcast(Index(items))
    df, n_docs, n_terms = _statistics(docs, index)
    if not n_docs:
        return None
    weight = sc.broadcast(weights(df, n_docs))
    kind = docs.schema[0].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("item", pa.int64()), ("doc", to_arrow_type(kind)), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, w = index.value, weight.value
        heaps = Heaps(idx.n_items, k)
        for batch in batches:
            for part in slices(batch):
                for doc, text in zip(*[x.to_pylist() for x in part.columns]):
                    counts = term_counts(text)
                    terms, tf = idx.held(counts)
                    if terms:
                        heaps.add(doc, idx.scores(terms, tf, counts.total(), w, n_docs, n_terms))
        out = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, schema)], schema=schema)

    return docs.mapInArrow(run, f"item long, doc {kind.simpleString()}, score long")


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """Items (id, term counts) in blocks of at most ``limit`` postings, one block at a time on the driver."""
    block, size = [], 0
    for row in items.toLocalIterator():
        counts = term_counts(row[1])
        if not counts:
            continue
        if block and size + len(counts) > limit:
            yield block
            block, size = [], 0
        block.append((row[0], counts))
        size += len(counts)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text",
           block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The k best documents of each item: item id, rank (from 1), document id, score."""
    spark = docs.sparkSession
    base = work_dir(spark, "search")
    rows = docs.select(c(id_col), c(text_col).cast("binary"))
    doc_type = rows.schema[0].dataType.simpleString()
    asked = items.select(c(item_id_col).alias("item_id"), c(item_text_col).alias("text"))
    item_type = asked.schema[0].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc {doc_type}, score long")
    for b, block in enumerate(_blocks(asked, block_postings)):
        heaps = _block_heaps(rows, [x[1] for x in block], k)
        if heaps is None:
            break
        heaps = written(heaps, f"{base}/heaps-{b}")
        salted = heaps.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
        best = _best(_best(salted, ["item", "salt"], k), ["item"], k)
        names = spark.createDataFrame([(i, x[0]) for i, x in enumerate(block)], f"item long, item_id {item_type}")
        out = out.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc", "score"))
    return out.select(F.col("item_id").alias(item_id_col), "rank", F.col("doc").alias(id_col), "score")
