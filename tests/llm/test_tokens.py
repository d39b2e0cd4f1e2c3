"""Token operators: exact round trips and brute force."""

import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from chainstar.llm import packing, sentencepiece_codec, token_files, tokens
from chainstar.llm.common import work_dir
from chainstar.llm.queries import BYTE_BPE, PIECES, WORD_BPE
from chainstar.llm.rans import Coder, quantise
from chainstar.llm.tokens import Encoder

HARD = ["", " ", "a", "Hello  world\n\nnext\tline ", "l'été n'est pas qu'un rêve", "x  y  z", "a\x0bb\x1cc",
        "á ́b", "日本語 text", "<|endoftext|> x", "\r\n\r\n end", "ΣΑΣ ΟΔΟΣ", "🙂🙂 ok", "1234567 89",
        "don't  won't", "a <|endoftext|> b", "A <|startoftext|>B<|ENDOFTEXT|>", "<|endoftext", "w" * 5000, " lead", "trail \n", "İstanbul İ"]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_chunked_ids_equal_whole_text_ids(path):
    tok = Tokenizer.from_file(path)
    enc = Encoder(path, most=40)
    want = [np.array(x.ids, "<u4").tobytes() for x in tok.encode_batch(HARD, add_special_tokens=False)]
    for _ in range(3):
        assert enc.ids(HARD) == want
    assert enc.ids([None]) == [b""] and len(enc.young) < 400


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\t\r\x0b ab'sé.1́Σ", max_size=25))
def test_chunked_ids_of_any_text(text):
    for path, (tok, enc) in ENCODERS.items():
        assert enc.ids([text])[0] == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), path


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=" \n\r\0 ab'é.1\xa0Σ", max_size=12) | st.just("x <|endoftext|> y"), max_size=6))
def test_ids_of_many_texts_at_once(texts):
    for path, (tok, enc) in ENCODERS.items():
        want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
        padded = pa.array(["before", *texts, "after"], pa.string()).slice(1, len(texts))
        flat, at = enc.flat(padded)
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want, path
        ended, to = tokens.with_end(flat, at, 2)
        assert [x.as_py() for x in tokens.as_binary(ended, to)] == [np.array(x + [2], "<u4").tobytes() for x in want]


ODD = ["<|", "|>", "endoftext", "ENDOFTEXT", "a", "B", "J\u030c", "K", "İ", "Σ", "'", "'s", "'LL", ".", ",", "=", "\u0338",
       "_", " ", "\n", "1", "\0", "日", "🙂"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=12).map("".join))
def test_letters_marks_and_cases_beside_each_other(text):
    for path, (tok, enc) in ENCODERS.items():
        assert enc.ids([text])[0] == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), path


def test_each_different_chunk_is_looked_up_once():
    class Asked(dict):
        n = 0

        def get(self, *a):
            Asked.n += 1
            return super().get(*a)

    texts = ["the quick brown fox jumps over the lazy dog, 12 times " * 50] * 20
    for path, (tok, _) in ENCODERS.items():
        enc = Encoder(path)
        enc.young, Asked.n = Asked(), 0
        assert enc.ids(texts)[7] == np.array(tok.encode(texts[7], add_special_tokens=False).ids, "<u4").tobytes()
        assert Asked.n <= 15, path


def test_slices_by_bytes_keep_every_row():
    texts = ["x" * 10, None, "", "y" * 100, *["z" * 3] * 20, "ü" * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    for most in (1, 12, 1000):
        got = list(tokens.by_bytes(batch, 1, most))
        assert [r for x in got for r in x.to_pylist()] == batch.to_pylist()
        assert all(x.num_rows == 1 or sum(len((t or "").encode()) for t in x.column(1).to_pylist()) <= most for x in got)
    assert list(tokens.by_bytes(batch.slice(0, 0), 1)) == []


ENCODERS = {p: (Tokenizer.from_file(p), Encoder(p)) for p in (BYTE_BPE, WORD_BPE)}


# -- packing ------------------------------------------------------------------------------

@given(st.integers(1, 100_000))
def test_pieces(n):
    got = packing.pieces(n)
    assert sum(got) == n and all(x & (x - 1) == 0 and x <= 1024 for x in got)
    rest = [x for x in got if x < 1024]
    assert len(rest) == len(set(rest)) and got == sorted(got, reverse=True)


def test_pack(spark, docs_of):
    texts = [None, "", *HARD, "word " * 30_000, "same", "same"]
    ids = [None, *range(len(texts) - 2), 3]
    rows = packing.pack(docs_of(texts, ids=ids, extra="length"), BYTE_BPE, end_id=0).collect()
    tok = Tokenizer.from_file(BYTE_BPE)
    want = sorted((str(i), np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
                  for i, t in zip(ids, texts))
    assert len({r.sequence_id for r in rows}) == len(rows)
    for n in {r.length for r in rows}:      # a bucket's sequences are consecutive
        seq = sorted(r.sequence_id for r in rows if r.length == n)
        assert seq == list(range(seq[0], seq[0] + len(seq)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.ids_crc32 == zlib.crc32(r.ids)
               and len(r.ids) == 4 * r.length for r in rows)
    got = {}
    for r in sorted(rows, key=lambda r: r.start):
        if r.doc_id != 3:
            got[str(r.doc_id)] = got.get(str(r.doc_id), b"") + bytes(r.ids)
    assert sorted(got.items()) == [x for x in want if x[0] != "3"]
    assert sum(r.length for r in rows) == sum(len(x[1]) // 4 for x in want)
    assert packing.pack(docs_of([]), BYTE_BPE, end_id=0).count() == 0


def test_pack_sends_places_to_the_ids(spark, docs_of, capsys):
    """Whatever the limit of a broadcast, the pieces' ids are not shuffled to meet their numbers."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        got = packing.pack(docs_of(["a b c", "d e"]), BYTE_BPE, end_id=0)
        got.explain("formatted")
        assert got.count() == 3
    finally:
        spark.conf.set(limit, old)
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", capsys.readouterr().out)
    assert inputs and not [x for x in inputs if "ids#" in x]


def test_encoder_of_a_worker_remembers_few_chunks():
    enc = tokens.encoder(BYTE_BPE, 100)
    assert enc is tokens.encoder(BYTE_BPE, 100) and enc is not tokens.encoder(BYTE_BPE)
    for n in range(50):
        enc.ids([f" w{n}a{m}" for m in range(20)])
        assert len(enc.young) + len(enc.old) <= 100 + 2 * 20


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date", "decimal(9,2)", "binary", "short"])
def test_keys_of_any_type(spark, docs_of, kind):
    docs = docs_of(["a b, c.", None, "long " * 2000, "d"], ids=[1, 2, 3, None])
    key = {"binary": "cast(cast(doc_id as string) as binary)", "date": "date_add(date'2024-03-30', cast(doc_id as int))",
           "timestamp": "timestamp_seconds(doc_id)", "timestamp_ntz": "cast(timestamp_seconds(doc_id) as timestamp_ntz)"}
    docs = docs.selectExpr(f"{key.get(kind, f'cast(doc_id as {kind})')} as doc_id", "text")
    want = sorted(str(r.doc_id) for r in docs.collect())
    packed = packing.pack(docs, BYTE_BPE, end_id=0).where("start = 0")
    assert sorted(str(r.doc_id) for r in packed.collect()) == want
    path = work_dir(spark, "files")
    token_files.write(docs, path, WORD_BPE, end_id=2)
    assert sorted(str(r.doc_id) for r in token_files.read(spark, path, with_ids=False).collect()) == want


# -- rANS -----------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=900), st.sampled_from([1, 3, 16]), st.sampled_from([1, 4, 100]))
def test_rans_round_trip(ids, lanes, every):
    ids = np.array(ids, dtype="<u4")
    freq = quantise(np.bincount(ids, minlength=301), bits=12)
    assert freq.sum() in (0, 1 << 12) and ((freq > 0) == (np.bincount(ids, minlength=301) > 0)).all()
    coder = Coder(freq, bits=12)
    assert coder.decode(coder.encode(ids, lanes, every)).tolist() == ids.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=200), max_size=6), st.sampled_from([1, 3, 16]), st.sampled_from([1, 4, 100]))
def test_rans_blocks_side_by_side(blocks, lanes, every):
    coder = Coder(quantise(np.bincount([x for b in blocks for x in b], minlength=41), bits=12), bits=12)
    got = coder.encode_all([np.array(b, "<u4") for b in blocks], lanes, every)
    assert got == [coder.encode(np.array(b, "<u4"), lanes, every) for b in blocks]
    mixed = [*got, coder.encode(np.array([], "<u4")), *got]
    assert [x.tolist() for x in coder.decode_all(mixed)] == [*blocks, [], *blocks]


def test_rans_large_block_compresses():
    rng = np.random.default_rng(0)
    ids = rng.zipf(1.3, 200_000) % 40_000
    coder = Coder(quantise(np.bincount(ids)))
    block = coder.encode(ids.astype("<u4"))
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert coder.decode(block).tolist() == ids.tolist()
    assert 8 * len(block) / len(ids) < 1.1 * entropy + 0.5


def test_rans_single_symbol_and_rare_symbol():
    one = np.zeros(1000, "<u4")
    coder = Coder(quantise(np.array([1000])))
    assert coder.decode(coder.encode(one)).tolist() == one.tolist()
    counts = np.array([10**15, 1, 0, 1])
    coder = Coder(quantise(counts))
    ids = np.array([1, 0, 0, 3] * 50, "<u4")
    assert coder.decode(coder.encode(ids, lanes=4, every=2)).tolist() == ids.tolist()
    with pytest.raises(ValueError):
        coder.encode(np.array([2], "<u4"))


def test_rans_checksums():
    coder = Coder(quantise(np.array([5, 3, 2])))
    block = bytearray(coder.encode(np.array([0, 1, 2, 0, 0, 1, 0, 1, 2, 0], "<u4")))
    for i in (0, 20, 28, len(block) - 1):
        bad = bytearray(block)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(bad))


@pytest.mark.parametrize("block_tokens", [1 << 17, 50])
def test_token_files(spark, docs_of, block_tokens):
    texts = [None, *HARD, "word " * 5000, "same", "same"]
    ids = [7, *range(100, 100 + len(HARD)), 5, -3, None]
    path = work_dir(spark, "files")
    token_files.write(docs_of(texts, ids=ids, extra="start"), path, WORD_BPE, end_id=2, block_tokens=block_tokens)
    got = token_files.read(spark, path).collect()
    tok = Tokenizer.from_file(WORD_BPE)
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0))
    want, at = [], 0
    for i, t in order:
        x = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        want.append((str(i), at, len(x) // 4, zlib.crc32(x), x))
        at += len(x) // 4
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == sorted(want)


def test_token_files_empty(spark, docs_of):
    path = work_dir(spark, "files")
    token_files.write(docs_of([]), path, WORD_BPE, end_id=2)
    assert token_files.read(spark, path).count() == 0


# -- SentencePiece ----------------------------------------------------------------------------

def brute_viterbi(codec, text):
    n = len(text)
    best, back = [0.0] + [None] * n, [None] * (n + 1)
    for e in range(1, n + 1):
        for s in range(max(0, e - codec.longest), e):
            hit = codec.table.get(text[s:e])
            if hit is not None and (best[e] is None or best[s] + hit[0] > best[e]):
                best[e], back[e] = best[s] + hit[0], (s, [hit[1]])
        if text[e - 1] not in codec.table:
            ids = codec._bytes(text[e - 1])
            v = best[e - 1] + codec.least * len(ids)
            if best[e] is None or v > best[e]:
                best[e], back[e] = v, (e - 1, ids)
    out = []
    while n:
        out.append(back[n][1])
        n = back[n][0]
    return [i for x in reversed(out) for i in x]


CODEC = sentencepiece_codec.Codec(PIECES, most=50)


@pytest.mark.parametrize("text", [t for t in HARD if t] + ["the  quick   brown fox " * 50, "\n\n a\n", "    indented"])
def test_streaming_equals_full_viterbi(text):
    flat = "▁" + text.replace(" ", "▁")
    want = brute_viterbi(CODEC, flat)
    assert CODEC.encode(text) == want and list(CODEC.viterbi(flat)) == want
    assert CODEC.decode(want) == text


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60).filter(lambda t: "▁" not in t))
def test_round_trip(text):
    assert CODEC.decode(CODEC.encode(text)) == text


def test_window_is_bounded_and_commits_early():
    flat = "▁" + "▁".join(["international", "understanding"] * 400)
    first = next(iter(CODEC.viterbi(flat)))
    assert first == CODEC.encode("international")[0]


def test_sentencepiece_tables(spark, docs_of):
    texts = [None, "", *HARD, "long text " * 20_000]
    docs = docs_of(texts, extra="ids")
    ids = sentencepiece_codec.encode(docs, PIECES)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(ids, PIECES).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert sentencepiece_codec.encode(docs.limit(0), PIECES).count() == 0


def test_new_segments_are_searched_side_by_side(monkeypatch):
    """Only segments longer than the window, or with a character without a piece, go through the text one by one."""
    codec, alone = sentencepiece_codec.Codec(PIECES), []
    monkeypatch.setattr(codec, "viterbi", lambda text: alone.append(text) or sentencepiece_codec.Codec.viterbi(codec, text))
    words = [f"w{i}x{i % 7}" for i in range(3000)] + ["été", "ребёнок", "a" * (codec.longest - 1)]
    texts = [" ".join(words), "a" * codec.longest, "ab\x00c", *words]
    got = [codec.encode(t) for t in texts]
    assert alone == ["▁" + "a" * codec.longest, "▁ab\x00c"]
    assert got == [brute_viterbi(codec, "▁" + t.replace(" ", "▁")) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n▁\tabth.éСт日🙂\x000", max_size=40)), max_size=8))
def test_sentencepiece_slice_equals_single_texts(texts):
    flat, at = CODEC.flat(pa.array(texts, pa.string()))
    want = [brute_viterbi(CODEC, "▁" + t.replace(" ", "▁")) if t else [] for t in texts]
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert CODEC.texts(token_files.as_binary(flat, at)).to_pylist() == [CODEC.decode(x) for x in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(
    st.integers(0, 262), st.integers(0, len(CODEC.pieces) - 1),
    st.sampled_from([CODEC.byte_id[b] for b in " ▁é🙂".encode()])), max_size=8)), max_size=8))
def test_sentencepiece_decodes_any_ids(rows):
    """Special ids, bytes that are no UTF-8, bytes of blanks and of U+2581."""
    ids = pa.array([None if x is None else np.array(x, "<u4").tobytes() for x in rows], pa.binary())
    assert CODEC.texts(ids).to_pylist() == [CODEC.decode(x or []) for x in rows]


def test_sentencepiece_vocabulary_with_pieces_over_blanks():
    codec = sentencepiece_codec.Codec.__new__(sentencepiece_codec.Codec)
    codec.byte_id, codec.unknown = {}, 0
    codec._setup({p: (-1.0 - n, n + 1) for n, p in enumerate(["▁", "a", "b", "a▁b", "ab", "\n", "b\na"])}, 50)
    for text in ["a b", "ab ab\nab", "b\na b\na", " a", "a bcb", "a b" * 40]:
        assert codec.encode(text) == brute_viterbi(codec, "▁" + text.replace(" ", "▁"))


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "decimal(9,2)", "binary"])
def test_sentencepiece_keys_of_other_types(spark, docs_of, kind):
    cast = {"binary": "cast(cast(doc_id as string) as binary)", "timestamp": "timestamp_seconds(doc_id)",
            "timestamp_ntz": "cast(timestamp_seconds(doc_id) as timestamp_ntz)"}.get(kind, f"cast(doc_id as {kind})")
    docs = docs_of(["one two", None, "one two", "🙂\n"], ids=[5, 6, 5, None]).selectExpr(f"{cast} doc_id", "text")
    ids = sentencepiece_codec.encode(docs, PIECES)
    back = sentencepiece_codec.decode(ids, PIECES)
    assert back.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    want = docs.selectExpr("doc_id", "coalesce(text, '') text")
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and 4 * r.n_ids == len(r.ids) for r in ids.collect())
