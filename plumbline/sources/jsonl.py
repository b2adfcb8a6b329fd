"""Episode files: one JSON object a line, one file an episode; their index, and statistics documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sources.schema import LINE


def read_episodes(spark: SparkSession, path: str, dataset: str, schema: str = LINE, mode: str = "PERMISSIVE", pattern: str = "*.jsonl") -> DataFrame:
    """Frames of every file named like ``pattern`` below ``path``: ``dataset, episode_id, frame_index`` and the line's columns.

    ``episode_id`` is the file's path; ``frame_index`` counts its lines (blank ones are skipped) in file order: blocks
    of a file by their start, lines inside a block by Spark's own increasing id, taken right above the scan. Lines that
    don't parse become nulls with the line in ``_corrupt`` (PERMISSIVE) or stop the job (FAILFAST).
    """
    own = schema if mode == "FAILFAST" else f"{schema}, _corrupt string"
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    raw = lines.select(F.col("_metadata.file_path").alias("episode_id"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line"), "value").where(F.trim("value") != "")
    w = Window.partitionBy("episode_id").orderBy("__block", "__line")
    parsed = F.from_json("value", own, {"mode": mode, "columnNameOfCorruptRecord": "_corrupt"})
    return raw.select(F.lit(dataset).alias("dataset"), "episode_id", (F.row_number().over(w) - 1).alias("frame_index"), parsed.alias("__p")).select("dataset", "episode_id", "frame_index", "__p.*")


def quarantine(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frames that parsed, lines that did not with their place)."""
    if "_corrupt" not in frames.columns:
        return frames, frames.limit(0)
    bad = F.col("_corrupt").isNotNull()
    return frames.where(~bad).drop("_corrupt"), frames.where(bad).select("dataset", "episode_id", "frame_index", "_corrupt")


def index_files(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """One row per episode file: ``file, length, modified, lines`` (lines that aren't blank)."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    meta = F.col("_metadata")
    return lines.select(meta["file_path"].alias("file"), meta["file_size"].alias("length"), meta["file_modification_time"].alias("modified"), "value").groupBy("file", "length", "modified").agg(F.count(F.when(F.trim("value") != "", 1)).alias("lines"))


def file_listing(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """``file, length, modified`` without reading contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def index_is_current(spark: SparkSession, path: str, index: DataFrame, pattern: str = "*.jsonl") -> bool:
    """Whether the listing equals the index in path, length and time of every file."""
    here, there = file_listing(spark, path, pattern), index.select("file", "length", "modified")
    return here.exceptAll(there).isEmpty() and there.exceptAll(here).isEmpty()


def cached_index(spark: SparkSession, path: str, cache: str, pattern: str = "*.jsonl") -> DataFrame:
    """The index from its Parquet side table, built again when any file has changed."""
    try:
        index = spark.read.parquet(cache)
        if index_is_current(spark, path, index, pattern):
            return index
    except Exception as e:  # no cache yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    fresh = index_files(spark, path, pattern)
    fresh.write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def index_totals(index: DataFrame) -> DataFrame:
    return index.agg(F.sum("lines").alias("total_samples"), F.count(F.lit(1)).alias("total_files"))


def write_episodes(frames: DataFrame, path: str) -> None:
    """A folder per episode with one JSON line per frame, in frame order."""
    ordered = frames.repartition("dataset", "episode_id").sortWithinPartitions("dataset", "episode_id", "frame_index")
    ordered.withColumn("episode", F.xxhash64("dataset", "episode_id")).write.mode("overwrite").partitionBy("episode").json(path)


_VECTORS = ("mean", "std", "q01", "q99", "min", "max")


def stats_to_json(stats: DataFrame) -> DataFrame:
    """``dataset, document``: per dataset ``{"norm_stats": {key: {mean: [...], ...}}}`` from rows with vectors."""
    have = [c for c in _VECTORS if c in stats.columns]
    by_key = F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", F.struct(*have).alias("v")))))
    return stats.groupBy("dataset").agg(F.to_json(F.struct(by_key.alias("norm_stats"))).alias("document"))


def stats_from_json(spark: SparkSession, text: str, dataset: str | None = None) -> DataFrame:
    """Rows ``dataset, key`` and vectors from a statistics document; numbers count as vectors of length one."""
    content = json.loads(text)
    content = content.get("norm_stats", content)
    vector = lambda v: None if v is None else [float(x) for x in (v if isinstance(v, list) else [v])]
    rows = [(dataset, key, *(vector(v.get(c)) for c in _VECTORS)) for key, v in content.items()]
    return spark.createDataFrame(rows, f"dataset string, key string, {', '.join(f'{c} array<double>' for c in _VECTORS)}")


def read_stats(spark: SparkSession, path: str, dataset: str | None = None, required: bool = False) -> DataFrame:
    """Statistics from a JSON file; a missing one is [-1, 1] under ``default``, or an error where it is required."""
    try:
        text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # one small document
    except Exception as e:
        if required or "PATH_NOT_FOUND" not in str(e):
            raise
        text = '{"default": {"min": -1, "max": 1}}'
    return stats_from_json(spark, text, dataset)


def infer_views(spark: SparkSession, path: str, prefixes: tuple[str, ...] = ("images", "depths"), pattern: str = "*.jsonl") -> list[str]:
    """Names of the views in a folder's files, from a schema-only read."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(path).schema
    return sorted(f.name for f in found if f.name.startswith(prefixes) and isinstance(f.dataType, T.StructType))
