"""One query per operator over the whole tables it is meant for."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import bpe, imatch, jaccard, lm, mixing, prefixes, quality, sharding, spans, toxicity, vafile, warc, wrappers
from tripmill.llm.tables import ship_code, table
from tripmill.plans.staging import fresh_folder, staged

SHARDS = 16
SEED = 20240
SOURCE_WEIGHTS = (5, 2, 1)
SHARED_TURNS, CONVERSATION_GROUP = 5, 100
CLUSTERING = {"k": 8, "rounds": 10, "seed": 3, "width": 64}


def op1_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, folder, "documents"), SHARDS, SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = staged(mixing.rows_to_mix(table(spark, folder, "documents")))
    taken, wanted = mixing.mix(rows, SOURCE_WEIGHTS, SEED)
    return (
        rows.join(mixing.shards_of(taken), "row_id", "left")
        .join(wanted.select("key", "source_size", "target"), "key")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).alias("taken"),
            F.coalesce("shards", F.lit("")).alias("shards"),
        )
    )


RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op3_wrapper_text(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract(table(spark, folder, "pages"))


def op4_fertility_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality(
        table(spark, folder, "documents"),
        public_tokenizers.path(RANKS),
        public_tokenizers.path(PIECES),
        public_tokenizers.PATTERN,
    )
    return judged.drop("lang", "text_hash")


def remainder(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def op5_elias_fano_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"), remainder("doc_id", 10) == 0)


def training_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").where(remainder("doc_id", 4) != 2)


def op6_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, training_labels(spark, folder))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.digests(table(spark, folder, "documents"), vocabulary)


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"), percent=75)


def op9_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    kept = spans.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))


def op10_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprints(table(spark, folder, "documents"))


def op11_va_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.cluster(table(spark, folder, "embeddings"), **CLUSTERING)


def op12_zfast_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefixes.turns_in_order(table(spark, folder, "conversations"))
    rebuilt = prefixes.with_shared_starts(staged(turns), SHARED_TURNS, CONVERSATION_GROUP)
    return prefixes.trie_nodes(prefixes.sequences(*rebuilt))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages, archives = table(spark, folder, "pages"), fresh_folder(spark, "warc")
    read = warc.read_archives(warc.write_archives(pages, archives), archives, with_payload=False)
    kind = pages.schema["page_id"].dataType
    return read.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


QUERIES = {
    "op1_feistel_shards": op1_feistel_shards,
    "op2_mix_sources": op2_mix_sources,
    "op3_wrapper_text": op3_wrapper_text,
    "op4_fertility_rules": op4_fertility_rules,
    "op5_elias_fano_lm": op5_elias_fano_lm,
    "op6_counterfactual_toxicity": op6_counterfactual_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_sentence_spans": op9_sentence_spans,
    "op10_imatch": op10_imatch,
    "op11_va_clusters": op11_va_clusters,
    "op12_zfast_trie": op12_zfast_trie,
    "op13_warc": op13_warc,
}


def _with_code(query: Callable[[SparkSession, str], DataFrame]):
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_code(spark)
        return query(spark, folder)

    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _with_code(query) for name, query in QUERIES.items()}
