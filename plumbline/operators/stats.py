"""Normalisation statistics and weighted means.

Statistics are plain aggregates per dimension (partial and final, so a dataset with most rows is combined where it is
read). Quantiles are ``percentile_approx`` of bounded memory, off by a rank of one in ``accuracy`` at most; ``exact``
ones, the smallest value whose share reaches q, hold every distinct value of a group and dimension in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.sampling import draw
from plumbline.scratch import written

STATS = ("n", "mean", "std", "q01", "q99", "min", "max")


def dimension_stats(df: DataFrame, column: str, by: Sequence[str] = ("dataset",), exact: bool = False, accuracy: int = 10_000, at_least: int = 2) -> DataFrame:
    """One row per group and dimension of a vector column: ``n, mean, std`` (population), ``q01, q99, min, max``.

    Null vectors and null values don't count; groups with fewer than ``at_least`` values are left out. An array of
    vectors is taken apart first (each chunk step is a row).
    """
    kind = df.schema[column].dataType
    rows = df.select(*by, F.explode(column).alias(column)) if kind.elementType.typeName() == "array" else df.select(*by, column)
    x = F.col("x")
    quantile = (lambda q: F.expr(f"percentile_disc({q}) within group (order by x)")) if exact else (lambda q: F.percentile_approx(x, F.lit(q), F.lit(accuracy)))
    out = rows.select(*by, F.posexplode(column).alias("dim", "x")).where(x.isNotNull()).groupBy(*by, "dim")
    named = {"n": F.count(x), "mean": F.avg(x), "std": F.stddev_pop(x), "q01": quantile(0.01), "q99": quantile(0.99), "min": F.min(x), "max": F.max(x)}
    return out.agg(*(e.alias(k) for k, e in named.items())).where(F.col("n") >= at_least)


def require_rows(stats: DataFrame, at_least: int = 2) -> DataFrame:
    """The same rows; raises where a group has fewer than ``at_least`` values."""
    ok = F.when(F.col("n") >= at_least, F.col("n")).otherwise(F.raise_error(F.concat(F.lit("too few values: "), F.col("n").cast("string"))).cast("long"))
    return stats.withColumn("n", ok)


def merge_stats(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Over datasets: the widest quantiles and extremes, and unweighted means of mean and std (as ``mean``, ``std``);
    beside them the pooled mean and std (``pooled_mean``, ``pooled_std``), which weigh each value once."""
    n, m, s = F.col("n"), F.col("mean"), F.col("std")
    out = stats.groupBy(*by, "dim").agg(
        F.min("q01").alias("q01"), F.max("q99").alias("q99"), F.min("min").alias("min"), F.max("max").alias("max"), F.avg(m).alias("mean"), F.avg(s).alias("std"),
        (F.sum(n * m) / F.sum(n)).alias("pooled_mean"), (F.sum(n * (s * s + m * m)) / F.sum(n)).alias("__square"), F.sum(n).alias("n"),
    )
    pooled = F.sqrt(F.greatest(F.lit(0.0), F.col("__square") - F.col("pooled_mean") * F.col("pooled_mean")))
    return out.withColumn("pooled_std", pooled).drop("__square")


def as_vectors(stats: DataFrame, by: Sequence[str], columns: Sequence[str] = ("mean", "std", "q01", "q99", "min", "max")) -> DataFrame:
    """One row per group, each statistic as a vector in dimension order."""
    gathered = stats.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("dim", *columns))).alias("__v"))
    return gathered.select(*by, *(F.col("__v")[c].alias(c) for c in columns))


def lookup_stats(df: DataFrame, stats: DataFrame, columns: Sequence[str] = ("min", "max"), most_rows: int = 100_000) -> DataFrame:
    """Adds statistics by the first that there is: of the row's dataset and prompt, of its dataset, of all.

    ``stats(dataset, prompt, ...)`` holds vectors; a null prompt is a dataset's default, a null dataset the overall
    one. The tables are hinted for broadcast only while they have at most ``most_rows`` rows.
    """
    stats = written(stats)  # looked up at three levels and counted, worked out once
    small = stats.limit(most_rows + 1).count() <= most_rows
    hint = F.broadcast if small else (lambda d: d)
    named = lambda d, level: d.select(*[c for c in ("dataset", "prompt") if c in d.columns], F.struct(*columns).alias(f"__{level}"))
    exact = named(stats.where("dataset is not null and prompt is not null"), 1)
    default = named(stats.where("dataset is not null and prompt is null").drop("prompt"), 2)
    overall = named(stats.where("dataset is null").drop("dataset", "prompt").limit(1), 3)
    out = df.join(hint(exact), ["dataset", "prompt"], "left").join(hint(default), ["dataset"], "left").join(F.broadcast(overall), how="left")
    best = F.coalesce("__1", "__2", "__3")
    return out.select(*df.columns, *(best[c].alias(c) for c in columns))


def masked_mean(value: Column, mask: Column) -> Column:
    """Aggregate: sum of value * mask over the sum of the mask, which counts as 1 at least."""
    return F.sum(value * mask) / F.greatest(F.sum(mask), F.lit(1.0))


def expectile_loss(difference: Column, weight: float = 0.9) -> Column:
    """Aggregate: mean of the squares, weighted by ``weight`` below zero and by 1 - ``weight`` above."""
    return F.avg(F.when(difference < 0, weight).otherwise(1 - weight) * difference * difference)


def reward_weighted_mean(loss: Column, reward: Column) -> Column:
    """Aggregate: mean of loss * (1 + sigmoid(reward))."""
    return F.avg(loss * (1 + 1 / (1 + F.exp(-reward))))


def argmax(values: Column) -> Column:
    """0-based place of an array's greatest value, the first of equals; null for an empty array."""
    return F.nullif(F.array_position(values, F.array_max(values)) - 1, F.lit(-1))


def last_unmasked(mask: Column) -> Column:
    """0-based place of the last 1 of a 0/1 array; the first place where there is none."""
    places = F.filter(F.transform(mask, lambda m, i: F.when(m == 1, i)), lambda i: i.isNotNull())
    return F.coalesce(F.element_at(places, F.when(F.size(places) > 0, -1)), F.lit(0))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by hash, the same for every run and partitioning (statistics read all rows by default)."""
    return df.orderBy(draw(seed, *map(F.col, keys)), *keys).limit(n)
