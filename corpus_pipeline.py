"""The corpus pipeline: documents through five training-data operators, stage by stage.

Each stage gets the documents that the one before it kept and gives documents again, with the same columns; the last one
gives token ids. Defined cases are those of the operators: null texts are empty, repeated rows are documents of their own
until exact dedup, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from adledger.llm.queries import tokenizer_path
from adledger.llm.rows import keep_decided
from adledger.session import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    rules = quality_rules.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judged(docs, rules, name="_quality").filter("_quality.kept").drop("_quality")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the largest id."""
    return keep_decided(docs, exact_dedup.exact_classes(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least id.

    Texts are linked when their SimHash fingerprints of three-word shingles differ in two bits or fewer; the bit distance
    alone decides, as in op8.
    """
    return keep_decided(docs, simhash.near_keepers(docs, shingle=3, radius=2))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents as often, or in such part, as the mix takes them."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix (unsigned 32-bit little-endian), and their number."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies), ("source mixing", mixed), ("bpe encoding", encoded)]

#: Learned rules, shingle votes, draws and merges are beyond SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
