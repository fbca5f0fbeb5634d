"""Documents to a weighted training mix: language, near-duplicates, benchmark passages, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, language, mixing, neardup, secrets
from meterlake.llm.common import beside, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter go, and those in a script of which the model knows no letter.

    Without any labelled row there is no model; then only the former go.
    """
    model = language.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = language.identify(docs, model, keep=tuple(docs.columns), strict=True)
    return told.where(F.col("lang_pred") != language.UNKNOWN).select("kept.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: five words, similarity 0.8. Of rows with one id one stays."""
    found = neardup.near_duplicates(docs, width=5, percent=80)
    out = docs.join(beside(found.where("NOT kept").select("doc_id")), "doc_id", "left_anti")
    again = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.limit(1).count():
        again = beside(again)
        once = out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        out = out.join(again, "doc_id", "left_anti").unionByName(once)
    return out.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, benchmark, keep=tuple(docs.columns))
    return found.where(F.size("items") == 0).select("kept.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words that it takes of each (repeats counted)."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("language", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


# Language identification is a trained model, which SQL cannot express; tests compare the stages with brute force.
ORACLE_SQL = None
