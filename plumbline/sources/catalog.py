"""The dataset catalog: registered entries, mixtures, discovery from files, and the look-ups that plans make."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.sources.schema import DATASETS

_TURN = 6.283185307179586
#: Profiles of the catalog's families (fixed values): dimensions that stay absolute, angles, and the angles' range.
PROFILES = {
    "single_arm": {"non_delta_mask": [6], "periodic_mask": None, "periodic_range": None},
    "single_arm_angles": {"non_delta_mask": [6], "periodic_mask": [3, 4, 5], "periodic_range": _TURN},
    "two_arms": {"non_delta_mask": [6, 13], "periodic_mask": None, "periodic_range": None},
    "last": {"non_delta_mask": [-1], "periodic_mask": None, "periodic_range": None},
}


@dataclass
class Catalog:
    """Entries by name; a later registration of a name replaces the earlier one, in its old place."""

    entries: dict[str, dict] = field(default_factory=dict)

    def register(self, datasets: dict[str, dict], prefix: str = "", meta: dict | None = None) -> Catalog:
        """Add entries under ``prefix_name`` (or their own names); an entry without ``meta`` gets the given one."""
        for name, entry in datasets.items():
            full = f"{prefix}_{name}" if prefix else name
            made = {"annotations": None, "data_path_prefix": "", "frequency": 1.0} | dict(entry)
            made.setdefault("meta", dict(meta or PROFILES["last"]))
            self.entries[full] = made
        return self

    def load(self, folder: str, spark: SparkSession | None = None, pattern: str = "*.json") -> Catalog:
        """Register every file of a folder that is named like ``pattern``, by file name: ``{prefix?, meta?, datasets}``. Data, not code.
        With a session the folder may be in any store that Spark reads."""
        if spark is None:
            texts = [path.read_text() for path in sorted(Path(folder).glob(pattern))]
        else:
            files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
            texts = [r["value"] for r in sorted(files.collect(), key=lambda r: r["name"])]  # small documents of configuration
        for text in texts:
            content = json.loads(text)
            self.register(content["datasets"], content.get("prefix", ""), content.get("meta"))
        return self

    def table(self, spark: SparkSession) -> DataFrame:
        meta = lambda m: (m.get("non_delta_mask"), m.get("periodic_mask"), m.get("periodic_range"))
        rows = [(n, e["annotations"], e["data_path_prefix"], float(e["frequency"]), meta(e["meta"])) for n, e in self.entries.items()]
        return spark.createDataFrame(rows, DATASETS)

    def mixture(self, names: str) -> list[str]:
        """The names of an ``a+b+c`` mixture; raises on unknown ones."""
        wanted = [n.strip() for n in names.split("+") if n.strip()]
        if unknown := [n for n in wanted if n not in self.entries]:
            raise KeyError(f"not in the catalog: {', '.join(unknown)}")
        return wanted


def upsert(current: DataFrame, new: DataFrame, key: str = "dataset") -> DataFrame:
    """``new`` rows replace ``current`` rows of the same key."""
    return current.join(new, key, "left_anti").unionByName(new)


def last_registered(entries: DataFrame, key: str = "dataset", order: str = "registered") -> DataFrame:
    """The last registration of each key."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return entries.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def first_of_path(entries: DataFrame, path: str = "annotations", order: str = "place") -> DataFrame:
    """Of entries that share a path, the first; its meta-data is what counts."""
    w = Window.partitionBy(path).orderBy(order)
    return entries.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def attach(frames: DataFrame, datasets: DataFrame, strict: bool = True) -> DataFrame:
    """Frames with their dataset's path prefix and meta-data. ``strict``: a dataset that isn't registered raises when
    its rows are read."""
    out = frames.join(datasets.select("dataset", "data_path_prefix", "meta"), "dataset", "left" if strict else "inner")
    if strict:
        known = F.when(F.col("meta").isNotNull(), F.col("meta")).otherwise(F.raise_error(F.concat(F.lit("not in the catalog: "), F.coalesce("dataset", F.lit("null")))).cast(datasets.schema["meta"].dataType))
        out = out.withColumn("meta", known)
    return out


def mix(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, duplicates included; columns that a part lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
