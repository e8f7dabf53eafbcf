"""From documents to token ids: five operators of ``thermopolis.llm``, one after another.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of ``documents``; the last returns a row of token counts and digests for each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopolis.llm import bpe, decontaminate, lines, simhash, toxicity
from thermopolis.llm.common import materialize, remove, scratch
from thermopolis.llm.queries import held_out, table, word_bpe

#: SQL can state neither the scores nor the fingerprints; the tests compare with brute force.
ORACLE_SQL = None


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; labels that are not held out are learnt from."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels").where(~held_out()))


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that many documents of one source share; every document stays, ``n_chars`` follows."""
    edited = lines.drop_boilerplate(docs, counts=False)
    return edited.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else edited


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest id stays.

    Rows of one id stay or go together; rows with a NULL id stay.
    """
    found = simhash.near_duplicates(docs, shingle_words=3, max_distance=3)
    return _without(docs, found.where("doc_id <> component_id"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or nearly, go."""
    return _without(docs, decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, word_bpe(), full=False)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", boilerplate_lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("bpe", token_ids),
]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(gone.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_anti").select(docs.columns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    result = materialize(STAGES[-1][1](spark, docs, sf_dir))
    remove(spark, folder)
    return result
