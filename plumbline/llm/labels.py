"""Training rows: a bounded, deterministic sample of labelled documents, gathered for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, columns: list[str], per_class: int, chars: int | None = None) -> list:
    """At most ``per_class`` rows for each combination of label values, those of the least hashed id first.

    Rows whose id is held out, whose label or id is null, or whose text is empty are not taken. Texts are whole; only a
    caller that gives ``chars`` gets, of a longer text, one window of that length, which starts at a place hashed from
    its id. An id with several labels counts with the least. Labels are chosen before any text moves, and only the
    chosen texts, at most per_class * combinations, are gathered.
    """
    known = labels.select("doc_id", *(F.col(c).cast("int").alias(c) for c in columns)).dropna().where(~held_out()).groupBy("doc_id").agg(*(F.min(c).alias(c) for c in columns))
    order = F.xxhash64(F.col("doc_id"), F.lit("train"))
    # Salted heads first: no task sorts more than its share of a class, however large the class is.
    picked = known.withColumn("o", order).withColumn("s", F.pmod("o", F.lit(64)))
    least = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("o", "doc_id"))
    heads = picked.withColumn("r", least(*columns, "s")).where(F.col("r") <= per_class)
    head = heads.withColumn("r", least(*columns)).where(F.col("r") <= per_class)
    text = F.col("text").cast("string")
    if chars is not None:
        start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length(text) - F.lit(chars))).cast("int") + 1
        text = F.substring(text, start, F.lit(chars))
    texts = docs.select("doc_id", text.alias("text")).where("text is not null and text <> ''")
    # The head has at most per_class rows a combination: its size is known, whatever the corpus.
    chosen = texts.join(F.broadcast(head.select("doc_id", "o", *columns)), "doc_id").dropDuplicates(["doc_id"])
    return sorted(chosen.collect(), key=lambda r: (r["o"], r["doc_id"]))
