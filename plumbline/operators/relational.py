"""Joins and windows that analytic work needs beside episodes: as-of, range, sessions, top rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], time: str, values: Sequence[str], allow_equal: bool = True, tolerance: str | None = None) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time (null if there is none, or
    none within ``tolerance``, an interval text).

    One union, one exchange on the key and one running window: no join, so no row meets more than its predecessor.
    """
    struct = F.struct(F.col(time).alias("__t"), *values)
    rows = left.withColumns({"__r": F.lit(None).cast(right.select(struct.alias("s")).schema["s"].dataType), "__side": F.lit(1 if allow_equal else 0)})
    marks = right.select(*by, time, struct.alias("__r"), F.lit(0 if allow_equal else 1).alias("__side"))
    w = Window.partitionBy(*by).orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_left = F.lit(1 if allow_equal else 0)
    found = rows.unionByName(marks, allowMissingColumns=True).withColumn("__m", F.last("__r", ignorenulls=True).over(w)).where(F.col("__side") == is_left)
    ok = F.col("__m.__t").isNotNull()
    if tolerance is not None:
        ok = ok & (F.col("__m.__t") >= F.col(time) - F.expr(f"interval {tolerance}"))
    return found.select(*left.columns, *(F.when(ok, F.col("__m")[v]).alias(v) for v in values))


def range_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, seconds: int, how: str = "inner") -> DataFrame:
    """Pairs of one key whose times are at most ``seconds`` apart.

    Times fall into bins of that width; a right row goes to its own bin and both neighbours, so the join is an
    equi-join on key and bin, and the exact condition is checked on what meets.
    """
    width = F.lit(seconds)
    bin_of = lambda t: F.floor(F.unix_timestamp(t) / width)
    own = left.withColumn("__b", bin_of(F.col(left_time)))
    near = right.withColumn("__b", F.explode(F.array(bin_of(F.col(right_time)) - 1, bin_of(F.col(right_time)), bin_of(F.col(right_time)) + 1)))
    gap = F.abs(F.unix_micros(F.col(left_time).cast("timestamp_ltz")) - F.unix_micros(F.col(right_time).cast("timestamp_ltz")))
    on = None
    for c in [*by, "__b"]:
        test = own[c] == near[c]
        on = test if on is None else on & test
    joined = own.join(near, on & (gap <= seconds * 1_000_000), how)
    return joined.drop(own["__b"]).drop(near["__b"]).drop(*(near[c] for c in by))


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str = "place") -> DataFrame:
    """The first ``n`` rows of each group (Spark keeps only ``n`` a group before the exchange)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)


def sessions(df: DataFrame, by: Sequence[str], time: str, gap_seconds: int) -> DataFrame:
    """``session`` numbers the runs of a key's rows without a gap over ``gap_seconds``, from 0."""
    w = Window.partitionBy(*by).orderBy(time)
    quiet = F.unix_micros(F.col(time).cast("timestamp_ltz")) - F.unix_micros(F.lag(time).over(w).cast("timestamp_ltz"))
    return df.withColumn("__n", F.coalesce((quiet > gap_seconds * 1_000_000).cast("int"), F.lit(0))).withColumn("session", F.sum("__n").over(w)).drop("__n")


def salted_sum(df: DataFrame, by: Sequence[str], value: str, salts: int = 16) -> DataFrame:
    """A sum in two steps, for sources whose map-side combine can't absorb a hot key."""
    parts = df.groupBy(*by, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("__s")).agg(F.sum(value).alias("__v"))
    return parts.groupBy(*by).agg(F.sum("__v").alias(value))
