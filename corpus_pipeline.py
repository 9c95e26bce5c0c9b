"""From raw documents to token ids: five stages, each on all that the one before kept.

Every stage takes and returns the columns of ``documents``; the last returns the tokens. All of them take
null texts as empty, texts of any length whole, and an empty table to an empty one; what each does with
null and repeated ids and repeated rows is said with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import bpe, jaccard, mixing, queries, spans, toxicity
from tripmill.llm.tables import ship_code
from tripmill.plans.staging import staged


#: Pre-tokens that a worker remembers: fewer than the query alone, as executors hold what earlier stages left.
REMEMBERED = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and repeated ids are judged like others, by the text alone; equal texts stay or go together.
    """
    ship_code(spark)
    model = toxicity.train(docs, queries.training_labels(spark, sf_dir))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, that with the smallest id.

    Texts without words are no copies of each other. Rows without an id stay; rows of one id count as one
    document.
    """
    ship_code(spark)
    return jaccard.without_copies(docs, percent=75)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in an earlier one, by id.

    A text that repeats others altogether becomes empty and stays. Rows without an id stay as they are; rows
    of one id count as one document. ``n_chars`` is that of the new text, null for a null text.
    """
    ship_code(spark)
    kept = spans.deduplicated(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, shard by shard.

    Documents without words are not taken. A null source is a source of its own; repeated rows and null ids
    are documents like any other.
    """
    ship_code(spark)
    return mixing.mixed_documents(docs, queries.SOURCE_WEIGHTS, queries.SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the hashes of ids and decoded bytes, one row per row."""
    ship_code(spark)
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    return bpe.digests(docs, vocabulary, with_ids=True, remembered=REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("passages", cut_repeated_passages),
    ("mix", mix),
    ("encode", encode),
]
#: The classifier and the tokeniser cannot be stated in SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *stages, (_, last) = STAGES
    for _, stage in stages:
        docs = staged(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
