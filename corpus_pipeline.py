"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to
the shared folder and reads again as the next one's documents. All stages but the last return the
columns of ``documents``. A table without rows passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common, language_id, near_dedup, packing, substring_dedup, toxicity
from acctweave.operators.handoff import hand_off


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model is sure of; those without a letter go, too."""
    model = language_id.train(docs)
    (found,) = common.fresh(docs, "_found")
    judged = docs.withColumn(found, language_id.predict(F.col("text"), model))
    return judged.where(~F.col(f"{found}.rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    (found,) = common.fresh(docs, "_found")
    judged = docs.withColumn(found, toxicity.score(F.col("text"), model))
    return judged.where(F.col(found) < toxicity.DECIDE).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least id, of every class of near duplicates."""
    return near_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of smaller id holds; ``n_chars`` follows."""
    cut = substring_dedup.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining tokens in sequences of the sources' proportions."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language_id", identify),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: Two trained models and a signature stand between the tables and the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = hand_off(stage(spark, docs, sf_dir), name)
    return docs
