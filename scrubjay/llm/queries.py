"""The registered queries of this subpackage: each operator over its whole table with its production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubjay.session import scratch_path
from scrubjay.sources.tables import load

from . import ann, chat, decontaminate, html_lstm, jaccard, language, merkle, minhash, packing, quality, repair, toxicity, warc
from .common import ship


def tokenizer_path() -> str:
    """The public byte-level vocabulary that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    return language.identify(load(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archives of all pages."""
    back = warc.round_trip(load(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: ten neighbours of every vector whose id is divisible by 100."""
    vectors = load(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.pmod("vec_id", F.lit(100)) == 0))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    return quality.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id and the place and size of the overlap for every document that holds an item, however short."""
    return decontaminate.overlaps(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), shortest=1)


#: The extra conversation whose texts are control strings.
CONTROL_CONVERSATION = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars for every conversation and -1."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.inline(F.array(*(F.struct(
        F.lit(c).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"),
        F.lit(x).alias("text")) for c, t, r, x in CONTROL_CONVERSATION))))
    both = turns.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digest(chat.format_conversations(both))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    return html_lstm.extract(load(spark, sf_dir, "pages"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path())


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    return minhash.near_duplicates(load(spark, sf_dir, "documents"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    return jaccard.similar_documents(load(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every damaged conversation."""
    turns = load(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(turns), turns.select("conv_id"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every document, a third of them tampered."""
    out = merkle.manifest(load(spark, sf_dir, "documents"), offered=merkle.tampered())
    return out.drop("path")


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _shipped(f) for f in (
    op1_toxicity, op2_language_id, op3_warc, op4_hilbert_neighbours, op5_quality, op6_decontaminate, op7_chat_format,
    op8_html_main_text, op9_best_fit_packing, op10_minhash_near_dedup, op11_ngram_jaccard_join,
    op12_conversation_repair, op13_merkle_manifest,
)}
