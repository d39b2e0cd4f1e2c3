"""SimHash near-duplicates by pigeonring filtering (operator 3).

Fingerprints: a bit is 1 if set in over half of the shingles' XXH64 values.
Equal fingerprints are one class.  Classes at ``max_bits`` or fewer differing
bits are linked, and linked classes form components.

The search cuts 64 bits into ``SEGMENTS`` = 8 segments on a ring.  By the
strong pigeonring principle two fingerprints within 4 bits have a segment i
from which every chain of l segments differs in at most l * 4 / 8 bits.  The
budgets of the first five links (0, 1, 1, 2, 2) leave at least three equal
segments, in one of five patterns; these three segments are the join key (8
starts x 5 patterns = 40 keys of 24 bits a class).  Within a key, candidates
must keep every budget of the chain (lengths 2 to 8) before the full Hamming
check.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; with fewer words than a shingle, the whole sequence is the one
shingle.  A component is named by its smallest doc_id (null only where all its
doc_ids are null).  Repeated rows are classes of one fingerprint.  Extra
columns are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``.
An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainstar.llm.common import c, map_batches, work_dir, written
from chainstar.llm.components import components

SEGMENTS, WIDTH, MAX_BITS, SEED = 8, 8, 4, 42
BLOCK = 2048   # members of a key compared in one task at a time; larger keys are cut into pairs of blocks


def fingerprint(text: str | None, words: int = 4) -> int:
    import xxhash

    w = (text or "").encode().lower().split()   # bytes: A-Z only, and the white space of the contract
    if not w:
        return 0
    shingles = map(b" ".join, zip(*[w[i:] for i in range(words)])) if len(w) >= words else [b" ".join(w)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65536):
        part = h[at:at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(x_id, fp): fp as a signed 64-bit integer."""

    def make():
        def work(ids, texts):
            fps = np.array([fingerprint(t, words) for t in texts], dtype="<u8").view("<i8")
            return [ids, fps.tolist()]
        return work

    kind = docs.select(c(id_col)).schema[0].dataType.simpleString()
    return map_batches(docs.select(c(id_col), c(text_col)), make, f"x_id {kind}, fp long")


def patterns() -> list[tuple[int, tuple[int, int, int]]]:
    """(start, the three segments that are equal): two of the next four segments may differ,
    not both of the first two, as the budgets of 2 to 5 links say."""
    out = []
    for start in range(SEGMENTS):
        for wild in combinations(range(1, 5), 2):
            if wild != (1, 2):
                equal = [0, *(k for k in range(1, 5) if k not in wild)]
                out.append((start, tuple((start + k) % SEGMENTS for k in equal)))
    return out


def chain_masks(start: int) -> list[tuple[np.uint64, int]]:
    """(mask, budget) of the chains of 2 to 8 segments from ``start``."""
    out, mask = [], 0
    for n in range(1, SEGMENTS + 1):
        mask |= (2 ** WIDTH - 1) << WIDTH * ((start + n - 1) % SEGMENTS)
        if n > 1:
            out.append((np.uint64(mask), n * MAX_BITS // SEGMENTS))
    return out


def _segment(k: int) -> Column:
    return F.shiftrightunsigned("fp", WIDTH * k).bitwiseAND(F.lit(2 ** WIDTH - 1))


def _keyed(classes: DataFrame) -> DataFrame:
    """One row per class and pattern: (k, fp); the pattern's number leads the key."""
    keys = []
    for i, (_, equal) in enumerate(patterns()):
        key = F.lit(i).cast("long")
        for seg in equal:
            key = F.shiftleft(key, WIDTH).bitwiseOR(_segment(seg))
        keys.append(key)
    return classes.select("fp", F.explode(F.array(*keys)).alias("k"))


class Forest:
    """Union-find over fingerprints of one run: keeps links that join two parts."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        y = self.up[x]
        while not np.array_equal(y, self.up[y]):
            y = self.up[y]
        self.up[x] = y
        return y

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the links (a[i], b[i]) join two parts."""
        ra, rb = self.roots(a), self.roots(b)
        keep = np.zeros(len(a), dtype=bool)
        for i in np.nonzero(ra != rb)[0]:
            x, y = a[i], b[i]
            while self.up[x] != x:
                x = self.up[x]
            while self.up[y] != y:
                y = self.up[y]
            if x != y:
                self.up[max(x, y)] = min(x, y)
                keep[i] = True
        return keep


def links_of_runs(k: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key (rows sorted by key): for each key a spanning
    forest of its pairs that pass the chain budgets and the Hamming check."""
    masks = {i: chain_masks(start) for i, (start, _) in enumerate(patterns())}
    number = (k >> (3 * WIDTH)).astype(np.int64)
    forest = Forest(len(k))
    got_a, got_b = [], []
    at, step = np.arange(len(k)), 1
    while True:
        at = at[at + step < len(k)]
        at = at[k[at] == k[at + step]]       # rows whose run reaches so far
        if not len(at):
            break
        x = fp[at] ^ fp[at + step]
        alive = np.nonzero(x != 0)[0]
        for j in range(SEGMENTS - 1):        # chains of 2, 3, ... 8 segments
            limit = masks[0][j][1]
            by_number = np.array([m[j][0] for m in masks.values()], dtype=np.uint64)
            alive = alive[np.bitwise_count(x[alive] & by_number[number[at[alive]]]) <= limit]
        alive = alive[np.bitwise_count(x[alive]) <= max_bits]
        if len(alive):
            a, b = at[alive], at[alive] + step
            keep = forest.add(a, b)
            got_a.append(a[keep])
            got_b.append(b[keep])
        step += 1
    if not got_a:
        return np.empty(0, fp.dtype), np.empty(0, fp.dtype)
    return fp[np.concatenate(got_a)], fp[np.concatenate(got_b)]


def _compare(batches):
    """Rows (k, x, y, fp), sorted by (k, x, y) within the partition -> links (a, b)."""
    held = None
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(t: pa.Table) -> pa.RecordBatch:
        k, x, y, fp = (t.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in ("k", "x", "y", "fp"))
        cut = np.nonzero((np.diff(k) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0))[0] + 1
        run = np.zeros(len(k), dtype=np.int64)
        run[cut] = 1
        run = np.cumsum(run)
        size = np.bincount(run)
        some = size[run] > 1
        # Within the batch a run goes by its pattern and its place.
        key = (k[some] >> (3 * WIDTH) << (3 * WIDTH)) | run[some]
        a, b = links_of_runs(key, fp[some].view("<u8"))
        a, b = a.view("<i8"), b.view("<i8")
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        last = tuple(t.column(n)[-1].as_py() for n in ("k", "x", "y")) if t.num_rows else None
        if last is None:
            continue
        k, x, y = (t.column(n).to_numpy() for n in ("k", "x", "y"))
        open_ = (k == last[0]) & (x == last[1]) & (y == last[2])
        n = t.num_rows - int(open_.sum())    # the last run may go on in the next batch
        held = t.slice(n)
        if n:
            yield links(t.slice(0, n))
    if held is not None and held.num_rows:
        yield links(held)


def class_links(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between classes (fp): every pair within 4 bits is joined by a path of links."""
    keyed = _keyed(classes)
    counts = keyed.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    rows = keyed.join(counts, "k")
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # A key of up to `block` members is one group; a larger one is dealt into parts, and each pair of parts is a group.
    rows = (rows.withColumn("parts", parts).withColumn("own", own)
                .select("k", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")))
    rows = rows.select("k", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")
    rows = rows.repartition("k", "x", "y").sortWithinPartitions("k", "x", "y")
    return rows.mapInArrow(_compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """One row per document: id, fp (signed 64-bit), component_id."""
    spark = docs.sparkSession
    base = work_dir(spark, "simhash")
    rows = written(fingerprints(docs, id_col, text_col, words), f"{base}/fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("x_id").alias("least")), f"{base}/classes")
    links = written(class_links(classes.select("fp")), f"{base}/links")
    part = components(links, f"{base}/components")            # (node, root) of linked classes
    member = classes.join(part, classes.fp == part.node)
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.select("fp", "root").join(names, "root").select("fp", "component_id")
    named = classes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(named, "fp").select(F.col("x_id").alias(id_col), "fp", "component_id")


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = 4) -> DataFrame:
    """``docs`` without the rows that another of their component stands for.

    One row of a component stays: that of the smallest doc_id, null ids last,
    and of rows with equal ids any one.  Rows are told apart by a number that is
    written with them, so a doc_id on several texts or a null one loses nothing.
    """
    row = F.struct(*[c(x) for x in docs.columns])
    rows = written(docs.select(F.monotonically_increasing_id().alias("n"), row.alias("r")),
                   work_dir(docs.sparkSession, "numbered"))
    doc = F.col("r").getField(id_col)
    order = F.struct(doc.isNull().alias("late"), doc.alias("doc"), F.col("n").alias("n"))
    near = near_duplicates(rows.select(order.alias("key"), F.col("r").getField(text_col).alias("text")),
                           "key", "text", words)
    gone = near.select(F.col("key.n").alias("n"), F.col("component_id.n").alias("stays")).filter("n <> stays")
    kept = rows.join(gone.select("n"), "n", "left_anti")
    return kept.select(*[F.col("r").getField(x).alias(x) for x in docs.columns])
