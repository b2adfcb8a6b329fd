"""The corpus pipeline: quality, near-duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``docs``. Texts are told apart by their SHA-256, so null and
repeated ids need no care: what is decided about a text holds for each of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, packing, pii, quality, simhash
from plumbline.llm.store import discard, keep

PII_KEY = "corpus-pipeline"
_KEY = "__text_key"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on this stage's labelled documents, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 0.8 of their five-word shingles are shared, or such pairs link them."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    names = docs.columns
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias(_KEY)
    index = decontaminate.build_index(docs.select(key, "text"), id_col=_KEY)
    found = decontaminate.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = keep(found.where(F.size("runs") > 0).select(F.col("doc_id").alias(_KEY)).distinct())
    discard(index)
    return docs.select(F.struct(*names).alias("row"), key).join(gone, _KEY, "left_anti").select("row.*")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced by surrogates; n_chars follows the new text."""
    out = pii.replace_entities(docs, PII_KEY)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: No stage can be put into SQL (compression, XXH64 shingles, a tokenizer); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs)
    return docs
