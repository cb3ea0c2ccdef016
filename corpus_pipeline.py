"""A training corpus from `documents`: good texts, without near duplicates and repeated passages, mixed and packed.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a frame
that is written and read again as the next one's documents. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.classifier import keep_good, train
from lakeops.llm.minhash import drop_near_duplicates
from lakeops.llm.mixing import mixture
from lakeops.llm.packing import packed_digests
from lakeops.llm.registry import table
from lakeops.llm.suffix_dedup import without_repeats
from lakeops.session import scratch_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, trained on `labels`, doesn't reject.

    Rows are judged one by one by their whole text, so that repeated rows stay or go together; a null text is judged as an empty one.
    Null ids aren't learned from. An empty table stays empty; columns of any name pass through.
    """
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id, a null one last of all.

    Of rows that repeat an id and text, the one with the least hash of its columns stays. Null, empty and blank texts are
    near duplicates of nothing and stay. An empty table stays empty; columns of any name pass through.
    """
    return drop_near_duplicates(docs)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without bytes that repeat a document with a smaller id; `n_chars` follows the text.

    Rows stay, also those whose whole text goes; a null text becomes an empty one. A null id is the greatest; rows that share an
    id don't remove from each other. An empty table stays empty; columns of any name pass through.
    """
    kept = without_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them.

    A null source is one of its own; null and empty texts have no words and come as often as their turn does. Repeated rows are documents of their
    own. An empty table stays empty; columns of any name pass through.
    """
    return mixture(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences, ids as their checksum.

    Every row, also one the mix repeats, is a document; a null or empty text is its end id alone. Null ids stay null. An empty table
    gives no pieces.
    """
    return packed_digests(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("minhash_dedup", distinct_documents),
    ("suffix_dedup", without_passages),
    ("mixing", mixed_documents),
    ("packing", packed_sequences),
]

# The classifier, the similarity components and the tokenizer have no SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table; the last one's pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
