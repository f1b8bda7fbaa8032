"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of docs; rows without a text,
repeated rows and empty tables pass through every stage in the way its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontamination, mixing, simhash, tokens, toxicity
from lodestrata.llm.queries import TARGETS, domains, table, tokenizer_path
from lodestrata.llm.store import free, saved, without


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = free(docs, "_score")
    return docs.withColumn(score, toxicity.score(model, F.col("text").cast("string"))).where(F.col(score) < 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document that names it, that of the smallest id. Rows that repeat as a
    whole stay once; rows that share an id stand or fall together; rows without an id stay."""
    docs = docs.dropDuplicates() if repeated(docs) else docs
    found = simhash.near_duplicates(docs, shingle=3, radius=2)
    return without(docs, "doc_id", found.where("doc <> component").select("doc"))


def repeated(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item; rows without an id stay."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, "doc_id", found.where("contaminated").select("doc"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mixture takes it."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    mixed = mixing.mix(rows, domains(spark, sf_dir), TARGETS, keep=("_row",))
    return mixed.where("copies > 0").select(F.explode(F.array_repeat("_row", F.col("copies"))).alias("_row")).select("_row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, and what they hold of each document."""
    # Executors are full of what earlier stages left in the heap, so workers take small pieces of text.
    return tokens.encoded(docs, tokenizer_path(), chars=1 << 18).withColumnRenamed("doc", "doc_id")


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("benchmark", drop_benchmark), ("mixing", mix_sources), ("tokens", write_tokens)]

# Learned weights, fingerprints and a tokenizer have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
