"""Toxicity by non-negative positive-unlabelled learning (operator 7).

Confirmed toxic documents are the positives; the texts of the training fold,
whatever their labels, are the unlabelled sample.  A linear model over the presence of words is trained in
numpy on the non-negative risk  pi R+(g) + max(0, Ru-(g) - pi R+-(g))  with
the sigmoid loss, where the prior pi is the share of toxic labels in the
training fold, lowered to the rate at which the strongest words of confirmed
rows are met in the corpus.

Word statistics and the prior cover every text and every label of the training
fold; the model is then fitted on the driver on bounded samples: at most
``max_positive`` confirmed rows and ``max_unlabelled`` unlabelled ones (the rows
of least hash), and ``max_words`` words.  The fit takes means of losses between
0 and 1, whose standard error over 12,000 unlabelled rows is 0.005 at most.
A word that the fitted confirmed rows hold fewer than LEAST_POSITIVES times
has the logarithm of its two shares' ratio over the whole fold as its weight.
Scores use nothing but a text's words.

Defined results: a null or empty text scores as a text without known words.
Labels that are null, or name no document, are not used; a doc_id labelled
twice counts as toxic if any of its labels says so.  A null doc_id has crc32
of the empty text, so it is in the training fold.  Without any positive label
every score is the prior.  Repeated rows score alike; extra columns and other
labels are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainstar.llm.common import c, map_batches

_WORD = re.compile(r"[^\W\d_]+")
MAX_POSITIVE, MAX_UNLABELLED, MAX_WORDS = 6000, 12000, 4096
LEAST_POSITIVES = 3    # confirmed rows that a word of the model is seen in
LEAST_RATIO = 3.0      # its share of the confirmed rows over its share of the unlabelled ones
LEAST_Z = 2.5          # and how many standard errors apart these shares are
PRIOR_WORDS = 15       # words whose corpus rate corrects the prior
CUT = 0.7


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    prior: float

    def score(self, text: str | None) -> float:
        """Probability that the text is toxic."""
        known = self.weights.keys() & words(text)
        z = self.bias + sum(sorted(self.weights[w] for w in known))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def nnpu_fit(pos: list[np.ndarray], unl: list[np.ndarray], n_words: int, prior: float, epochs: int = 150,
             rate: float = 0.05, l2: float = 1e-5, batch: int = 4000, beta: float = 0.0,
             seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias minimising the non-negative risk (Adam over mini-batches).

    ``pos`` and ``unl`` hold each text's word numbers.  Where the estimated
    negative risk falls below -beta, the step goes up its slope instead.
    """
    rng = np.random.default_rng(seed)
    w = np.zeros(n_words + 1)                      # the last one is the bias
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(r) for r in rows])
        return np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), size)

    def margin(idx, row, n):
        return np.bincount(row, w[idx], minlength=n) + w[-1]

    def grad(idx, row, slope):                     # slope: of each row's loss by its margin
        g = np.bincount(idx, slope[row], minlength=n_words + 1)
        g[-1] = slope.sum()
        return g

    step = 0
    share = max(1, len(unl) // batch)
    for _ in range(epochs):
        groups = zip(np.array_split(rng.permutation(len(pos)), share), np.array_split(rng.permutation(len(unl)), share))
        for at_p, at_u in groups:
            if not len(at_p) or not len(at_u):
                continue
            pi, pr = flat([pos[i] for i in at_p])
            ui, ur = flat([unl[i] for i in at_u])
            fp, fu = margin(pi, pr, len(at_p)), margin(ui, ur, len(at_u))
            sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
            negative = su.mean() - prior * sp.mean()
            dp, du = sp * (1 - sp), su * (1 - su)
            g_neg = grad(ui, ur, du / len(fu)) - grad(pi, pr, prior * dp / len(fp))
            if negative < -beta:
                g = -g_neg
            else:
                g = grad(pi, pr, -prior * dp / len(fp)) + g_neg
            g[:-1] += l2 * w[:-1]
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
          max_words: int = MAX_WORDS) -> Model:
    """The classifier; ``labels`` and ``docs`` outside the training fold are not read into it."""
    spark = docs.sparkSession
    marks = (labels.filter(c(id_col).isNotNull() & c(label_col).isNotNull() & ~held_out(c(id_col)))
                   .groupBy(c(id_col).alias("x_id")).agg(F.max(c(label_col)).alias("toxic")))
    n, toxic = marks.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    prior = min(0.9, max(1e-3, toxic / n)) if n else 1e-3
    # Every confirmed row counts: a shuffle join, as their number grows with the corpus.  Null ids have no label.
    confirmed = marks.filter("toxic = 1").select("x_id", F.lit(1).alias("pos"))
    fold = docs.select(c(id_col).alias("x_id"), c(text_col).alias("text")).filter(~held_out(F.col("x_id")))
    marked = (fold.filter("x_id is not null").join(confirmed.hint("shuffle_hash"), "x_id", "left")
              .select("x_id", "text", F.coalesce("pos", F.lit(0)).alias("pos"))
              .unionByName(fold.filter("x_id is null").withColumn("pos", F.lit(0))))

    def count():
        def work(_, texts, pos):
            seen, hit = Counter(), Counter()
            for t, p in zip(texts, pos):
                w = words(t)
                (hit if p else seen).update(w)
            every = list(hit.keys() | seen.keys())
            return [every, [hit[w] for w in every], [seen[w] for w in every]]
        return work

    # Rows are counted without their texts, so that these are shuffled once only.
    n_pos, n_rows = marked.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.count("*")).first()
    n_unl = n_rows - n_pos
    if not n_pos or not n_unl:
        return Model({}, float(np.log(prior / (1 - prior))), prior)
    # Document frequency of every word, over every text of the fold.
    table = (map_batches(marked, count, "word string, hit long, seen long", rows=2048)
             .groupBy("word").agg(F.sum("hit").alias("hit"), F.sum("seen").alias("seen")))
    p, u = F.col("hit") / n_pos, F.col("seen") / n_unl
    strength = (p - u) / F.sqrt(p * (1 - p) / n_pos + u * (1 - u) / n_unl + F.lit(1e-12))
    chosen = (table.filter((F.col("hit") >= LEAST_POSITIVES)
                           & (p >= LEAST_RATIO * u) & (strength >= LEAST_Z))
              .orderBy(strength.desc(), "word").limit(max_words)
              .select("word", "hit", F.log(p / ((F.col("seen") + 1) / (n_unl + 1))).alias("lift"), ((F.col("hit") + F.col("seen")) / (n_pos + n_unl) / p).alias("rate")).collect())
    vocab = [r.word for r in chosen]
    # A word of toxic texts alone is rarer in the corpus by the prior.  Labelled rows may hold more toxic ones than
    # the corpus does, so the strongest words' rate, where lower, is the prior of the unlabelled texts.
    if len(chosen) >= PRIOR_WORDS:
        prior = max(1e-3, min(prior, float(np.median([r.rate for r in chosen[:PRIOR_WORDS]]))))
    number = {w: i for i, w in enumerate(vocab)}

    # Bounded samples for the fit: the ids of least hash.  Their number bounds what is broadcast.
    some = F.xxhash64("x_id")
    positive = confirmed.orderBy(some, "x_id").limit(max_positive).collect()
    positive = spark.createDataFrame(positive, confirmed.schema)
    # In the two-sample setting unlabelled texts follow the whole corpus, its confirmed rows included.
    unlabelled = fold.select("x_id").distinct().orderBy(some, "x_id").limit(max_unlabelled).collect()
    picked = spark.createDataFrame(unlabelled or [], marks.select("x_id").schema).withColumn("pos", F.lit(0))
    picked = picked.unionByName(positive)

    def numbers():
        def work(_, texts, pos):
            return [pos, [sorted(number[w] for w in words(t) & number.keys()) for t in texts]]
        return work

    rows = map_batches(fold.join(F.broadcast(picked), "x_id"), numbers, "pos int, words array<int>").toArrow()
    sides: list[list[np.ndarray]] = [[], []]
    for pos, w in zip(rows["pos"].to_pylist(), rows["words"].to_pylist()):
        sides[pos].append(np.array(w, dtype=np.int64))
    weights, bias = nnpu_fit(_ordered(sides[1]), _ordered(sides[0]), len(vocab), prior)
    met = np.bincount(np.concatenate([*sides[1], np.empty(0, np.int64)]).astype(np.int64), minlength=len(vocab))
    weights = np.where(met < LEAST_POSITIVES, [r.lift for r in chosen], weights)
    return Model(dict(zip(vocab, weights.tolist())), bias, prior)


def _ordered(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The same order whatever order the executors answered in."""
    return sorted(rows, key=lambda r: (len(r), r.tobytes()))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # at most max_words weights

    def make():
        def work(ids, texts):
            got = [shared.value.score(t) for t in texts]
            return [ids, got, [int(x >= CUT) for x in got]]
        return work

    kind = docs.select(c(id_col)).schema[0].dataType.simpleString()
    out = map_batches(docs.select(c(id_col), c(text_col)), make, f"`{id_col}` {kind}, score double, predicted int")
    return out.select(c(id_col), held_out(c(id_col)).alias("held_out"), "score", "predicted")
