"""Chat rotation, toxicity, registered queries and the pipeline."""

import os
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from chainstar.llm import chat, packing, pii, quality, queries, toxicity

from test_dedup import brute_components, brute_exact, brute_fingerprint, norm

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")

TURNS = "conv_id long, turn long, role string, text string, place string"


def brute_rotate(rows, part_turns):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or chat.UNKNOWN, r[3] or "")
    for conv in {r[0] for r in rows}:
        said = [(r[2] or chat.UNKNOWN, r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        for me in {r for r, _ in said if r != chat.SYSTEM}:
            before = 0
            for at in range(0, len(said), part_turns):
                text, spans = "", []
                for role, words in said[at:at + part_turns]:
                    text += ("<|system|>\n" if role == chat.SYSTEM else "<|assistant|>\n" if role == me
                             else f"<|user:{role}|>\n")
                    spans.append((before + len(text), before + len(text) + len(words), role == me))
                    text += words + "\n"
                before += len(text)
                out[conv, me, at // part_turns] = (text, spans)
    return out


def test_rotation(spark, monkeypatch):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello é"), (1, 3, "cat", None),
            (1, None, "ann", "first"), (2, 0, None, "who"), (2, 0, None, "who"), (3, 0, "system", "alone"),
            (None, 0, "ann", "x"), (None, 1, "bob", "")]
    rows += [(9, i, f"p{i % 3}" if i else "system", f"turn {i}") for i in range(500)]
    rows += [(10, i, "rare" if i in (40, 90) else "often", "x" * (i % 5)) for i in range(130)]
    monkeypatch.setattr(chat, "BLOCK_PARTS", 4)
    turns = spark.createDataFrame([(*r, "x") for r in rows], TURNS).repartition(7)
    got = {(r.conv_id, r.speaker, r.part): (r.text, [(s.start, s.end, s.loss) for s in r.spans])
           for r in chat.rotate(turns, part_turns=16).collect()}
    assert got == brute_rotate(rows, 16)
    assert chat.rotate(turns.limit(0)).count() == 0
    # Parts joined are the whole rendering, and every span is a turn's place in it.
    whole = {(r.conv_id, r.speaker): (r.text, r.spans) for r in chat.rotate(turns, part_turns=1000).collect()}
    for (conv, me), (text, spans) in whole.items():
        parts = [got[k] for k in sorted((k for k in got if k[:2] == (conv, me)), key=lambda k: k[2])]
        assert "".join(t for t, _ in parts) == text
        assert [s for _, some in parts for s in some] == [(s.start, s.end, s.loss) for s in spans]
    assert whole[9, "p1"][0].startswith("<|system|>\nturn 0\n")


# -- toxicity ----------------------------------------------------------------------------

def test_held_out_fold(spark):
    ids = spark.createDataFrame([(i,) for i in (0, 1, 17, 123456789, -5)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in ids.select("doc_id", toxicity.held_out(ids.doc_id)).collect()}
    assert got == {i: zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1 for i in got}


def test_nnpu_separates():
    rng = np.random.default_rng(0)
    clean = [np.unique(rng.integers(5, 50, 8)) for _ in range(900)]
    bad = [np.append(np.unique(rng.integers(5, 50, 8)), rng.integers(0, 5, 2)) for _ in range(200)]
    w, b = toxicity.nnpu_fit(bad[:100], clean + bad[100:], 50, prior=0.1, epochs=200)
    score = lambda rows: np.array([1 / (1 + np.exp(-(w[r].sum() + b))) for r in rows])
    assert (score(bad) > 0.7).mean() > 0.95 and (score(clean) < 0.5).mean() > 0.97


def test_toxicity_tables(spark, docs_of):
    rng = np.random.default_rng(2)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(600)]
    texts, toxic = [], []
    for i in range(1500):
        t = [words[k] for k in rng.integers(0, 600, 40)]
        bad = i % 8 == 0
        if bad:
            for k in rng.integers(0, 40, 3):
                t[k] = ["vile", "rotten", "nasty"][int(rng.integers(0, 3))]
        texts.append(" ".join(t))
        toxic.append(int(bad))
    docs = docs_of([*texts, None, "", "vile " * 50_000], extra="score")
    labels = spark.createDataFrame([(i, None, toxic[i]) for i in range(0, 1500, 2)] + [(None, 1, 1), (3, 1, None), (10**9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert len(got) == 1503 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    out = [i for i in range(1500) if got[i].held_out]
    assert np.mean([got[i].predicted == toxic[i] for i in out]) > 0.97
    assert got[1502].predicted == 1 and got[1500].predicted == 0 and got[1501].score == got[1500].score
    # Labels of the held-out fold change nothing.
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    again = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, flipped)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_every_confirmed_row_counts(spark, docs_of):
    """The words of confirmed rows beyond those of the fit are learnt."""
    rng = np.random.default_rng(4)
    bad, rare = 300, "abcdefghij"
    texts = [" ".join(f"w{'abcdefghij'[k]}" for k in rng.integers(0, 10, 8)) for _ in range(1500)]
    for i in range(bad):                                     # each rare word in 30 of 300 confirmed rows
        texts[i] += f" rare{rare[i % 10]}"
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, int(i < bad)) for i in range(1500)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_positive=10)
    assert {f"rare{x}" for x in rare} == model.weights.keys() and min(model.weights.values()) > 0
    whole = toxicity.train(docs, labels)
    assert whole.weights.keys() == model.weights.keys() and whole.prior == model.prior


def test_toxicity_without_labels(spark, docs_of):
    docs = docs_of(["a b", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0


# -- registered queries ---------------------------------------------------------------------

def test_every_operator_is_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: str(r)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key) == sorted(cur.fetchall(), key=key)


@needs_data
def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [d.doc_id for d in docs], [brute_fingerprint(d.text) for d in docs]
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(ids, fps))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash(spark, SF).collect()} == want


@needs_data
def test_token_queries(spark):
    from chainstar.llm.tokens import Encoder

    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    byte = Encoder(queries.BYTE_BPE).ids([d.text for d in docs])
    got = queries.op2_packing(spark, SF).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for d, x in zip(docs, byte):
        x += bytes(4)
        rows = sorted(by[d.doc_id], key=lambda r: r.start)
        assert [r.length for r in rows] == packing.pieces(len(x) // 4) and rows[0].doc_tokens == len(x) // 4
        assert all(r.ids_crc32 == zlib.crc32(x[4 * r.start:4 * (r.start + r.length)]) for r in rows)
    word = Encoder(queries.WORD_BPE).ids([d.text for d in docs])
    want, at = {}, 0
    for d, x in zip(docs, word):
        x += (2).to_bytes(4, "little")
        want[d.doc_id] = (at, len(x) // 4, zlib.crc32(x))
        at += len(x) // 4
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op9_rans(spark, SF).collect()} == want


@needs_data
def test_sentencepiece_and_pii_queries(spark):
    import hashlib

    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op8_sentencepiece(spark, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    for r in queries.op5_pii(spark, SF).collect():
        base, every = pii.spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.told(base).encode()).hexdigest() and r.spans == pii.told(every)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)


# -- pipeline -------------------------------------------------------------------------------

def brute_pipeline(rows):
    """(doc_id, text) of the documents that reach the packing stage."""
    rows = [(i, quality.clean_text(t or "")) for i, t in rows
            if quality_kept(t or "")]
    rows = [(i, c[0]) for i, c in rows]
    keep = {v[0] for v in brute_exact(rows).values()}
    rows = [(i, t) for i, t in rows if i in keep]
    ids, fps = [i for i, _ in rows], [brute_fingerprint(t) for _, t in rows]
    rows = [r for r, least in zip(rows, brute_components(ids, fps)) if r[0] == least]
    return {i: pii.mask(t) for i, t in rows}


def quality_kept(t):
    n, _, _, _, rep = quality.base_figures(t)
    _, lost, total = quality.clean_text(t)
    return n >= 50 and 100 * rep <= 50 * n and 100 * lost <= quality.MAX_LOSS_PERCENT * total


@needs_data
def test_pipeline(spark):
    from chainstar.llm.tokens import Encoder

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_pipeline([(d.doc_id, d.text) for d in docs])
    got = {}
    for r in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: r.start):
        got[r.doc_id] = got.get(r.doc_id, b"") + bytes(r.ids)
    ids = Encoder(queries.BYTE_BPE).ids(list(want.values()))
    assert got == {i: x + bytes(4) for i, x in zip(want, ids)}


def test_stages_on_odd_tables(spark, docs_of):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    docs = docs_of([None, "", good, good, good + " Mail a@b.example.com.", "x" * 200_000, good], ids=[0, None, 2, 3, 4, 5, None],
                   extra="x_id")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns, name
        assert out.count() > 0, name
    assert norm("a  b") == "a b"
