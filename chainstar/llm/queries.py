"""Registered queries of the operators and of the pipeline, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainstar.llm import (chat, decontaminate, exact_dedup, html_text, packing, pii, quality, search,
                           sentencepiece_codec, simhash, token_files, toxicity, whitening)
from chainstar.llm.common import table, work_dir
from chainstar.llm.sql import CHAT_SQL, EXACT_SQL, LEAKS_SQL, QUALITY_SQL, SEARCH_SQL

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.quality(table(spark, sf_dir, "documents"), with_text=False)
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "lost_chars", "line_chars")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0)
    return got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html_text.extract(table(spark, sf_dir, "pages"))
    return got.withColumn("n_chars", F.length("text").cast("long"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are those of the base patterns; ``spans`` also has what the transducer added."""
    got = pii.detect(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rendering: its text's digest, its masked characters and its spans as start:end:mask."""
    got = chat.rotate(table(spark, sf_dir, "conversations"))
    masked = F.aggregate("spans", F.lit(0).cast("long"),
                         lambda n, s: n + F.when(s["loss"], s["end"] - s["start"]).otherwise(F.lit(0).cast("long")))
    told = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"), s["loss"].cast("int").cast("string"))))
    return got.select("conv_id", "speaker", "part", F.size("spans").cast("long").alias("n_turns"),
                      F.length("text").cast("long").alias("n_chars"), masked.alias("masked_chars"),
                      F.sha2("text", 256).alias("text_sha256"), told.alias("spans"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the digest of the text decoded from them."""
    ids = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), PIECES)
    # The ids travel beside the key, so decoding follows encoding without a join.
    both = ids.select(F.struct("doc_id", "n_ids", "ids_crc32").alias("key"), "ids")
    got = sentencepiece_codec.decode(both, PIECES, id_col="key")
    return got.select("key.doc_id", "key.n_ids", "key.ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op9_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return token_files.read(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"text_sha256": F.sha2("x_norm", 256)}
    return exact_dedup.annotate(table(spark, sf_dir, "documents"), carry=digest)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality, op2_packing, op3_simhash, op4_html, op5_pii, op6_chat, op7_toxicity,
                                   op8_sentencepiece, op9_rans, op10_exact_dedup, op11_decontaminate,
                                   op12_search, op13_whitening, pipeline)}
ORACLE = {"op1_quality": QUALITY_SQL, "op6_chat": CHAT_SQL, "op10_exact_dedup": EXACT_SQL,
          "op11_decontaminate": LEAKS_SQL, "op12_search": SEARCH_SQL}
