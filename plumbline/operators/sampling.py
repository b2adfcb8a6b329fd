"""Deterministic sampling, mixtures, and order-preserving batch schedules.

Randomness is a hash of seed and row key, so results don't depend on partitions, retries or workers. ``md5`` is used
where another engine must be able to follow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Episodes that are summed in one task when places in a stream are worked out.
BLOCK = 4096


def draw(seed: int | str | Column, *keys: Column) -> Column:
    """A hash as text: sorts like a random number."""
    return F.md5(F.concat_ws("|", F.lit(seed).cast("string") if not isinstance(seed, Column) else seed.cast("string"), *(k.cast("string") for k in keys)).cast("binary"))


def shuffle(df: DataFrame, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """All rows in an order drawn from their keys."""
    return df.orderBy(draw(seed, *map(F.col, keys)), *keys)


def oversample(files: DataFrame, frequency: Column | float, by: Sequence[str] = ("dataset",), key: str = "file", seed: int = 0) -> DataFrame:
    """Whole copies of each file for every whole unit of ``frequency``, and of the rest's share the first
    ceil(n * fraction) files in drawn order. ``copy_id`` tells copies apart (the share has the last one)."""
    f = F.lit(frequency) if not isinstance(frequency, Column) else frequency
    # Ranked in 256 dealt buckets of the draw, which are moved by the sizes of those before: no group is one task's sort.
    dealt = files.withColumns({"__f": f.cast("double"), "__d": draw(seed, F.col(key))}).withColumn("__b", F.substring("__d", 1, 2))
    every = Window.partitionBy(*by)
    sizes = dealt.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__k"))  # at most 256 rows a group
    before = F.coalesce(F.sum("__k").over(every.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    based = sizes.withColumns({"__before": before, "__n": F.sum("__k").over(every)}).drop("__k")
    inner = F.row_number().over(Window.partitionBy(*by, "__b").orderBy("__d", key))
    ranked = dealt.join(based, [*by, "__b"]).withColumn("__rank", inner + F.col("__before")).select(*files.columns, "__f", "__rank", "__n")
    whole = F.floor("__f").cast("int")
    part = F.col("__rank") <= F.ceil(F.round(F.col("__n") * (F.col("__f") - whole), 9))
    copies = whole + F.when(part, 1).otherwise(0)
    return ranked.where(copies > 0).withColumn("copy_id", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__f", "__rank", "__n")


def tail_frame(index: Column, length: Column, steps: int, seed: int, *keys: Column) -> Column:
    """A frame without ``steps`` successors is replaced by a drawn valid one (null where the episode has none)."""
    valid = length - steps
    number = F.conv(F.substring(draw(seed, *keys, index), 1, 12), 16, 10).cast("long")
    return F.when(index < valid, index.cast("long")).when(valid > 0, F.pmod(number, valid))


def shard(df: DataFrame, rank: int, world: int, keys: Sequence[str] = ("dataset", "episode_id"), seed: int = 0) -> DataFrame:
    """Every ``world``-th episode in drawn order, from the ``rank``-th on. ``df`` may have many rows an episode."""
    own = number_episodes(df, keys, seed).where(F.pmod(F.col("place"), F.lit(world)) == rank).drop("place")
    return df.join(own, list(keys), "left_semi")


def number_episodes(df: DataFrame, keys: Sequence[str], seed: int = 0, buckets: int = 256) -> DataFrame:
    """``keys, place``: episodes numbered from 0 in drawn order, over all datasets, without a single-task sort.

    The first two hex digits of the draw deal episodes into ``buckets`` at most; each is numbered by itself and moved by the
    sizes of those before it.
    """
    eps = df.select(*keys).distinct().withColumn("__d", draw(seed, *map(F.col, keys))).withColumn("__b", F.substring("__d", 1, 2))
    sizes = eps.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))  # at most 256 rows
    base = sizes.select("__b", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    inner = F.row_number().over(Window.partitionBy("__b").orderBy("__d", *keys)) - 1
    return eps.join(F.broadcast(base), "__b").withColumn("place", inner + F.col("__base")).select(*keys, "place")


def group_schedule(frames: DataFrame, batch_size: int, group: int, rank: int = 0, world: int = 1, seed: int = 0, epoch: int = 0, keys: Sequence[str] = ("dataset", "episode_id"), index: str = "frame_index") -> DataFrame:
    """Batches of ``batch_size`` frames: ``batch_size / group`` episodes each, ``group`` frames of each in time order.

    Returns ``batch, slot, keys, pos, index``. A rank's episodes are a shard; it makes max(1, frames // batch_size)
    batches. Episodes of a batch are drawn without replacement while there are enough, otherwise with. An episode with
    fewer frames than ``group`` gives all of them and repeats the last. Batches that come out short are dropped.
    """
    if group <= 0 or batch_size % group:
        raise ValueError("batch_size must be a multiple of group")
    slots = batch_size // group
    salt = seed + epoch
    numbered = number_episodes(frames, keys, salt)
    own = numbered.where(F.pmod(F.col("place"), F.lit(world)) == rank)
    sizes = frames.join(own, list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("place").alias("place"))
    eps = sizes.withColumn("e", F.floor(F.col("place") / world).cast("long")).drop("place")
    totals = eps.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()  # two numbers
    k, n = totals["k"], totals["n"] or 0
    spark = frames.sparkSession
    if k == 0:
        return spark.createDataFrame([], frames.select(F.lit(0).cast("long").alias("batch"), F.lit(0).alias("slot"), *keys, F.lit(0).alias("pos"), index).schema)
    batches = spark.range(max(1, n // max(batch_size, 1))).withColumnRenamed("id", "batch")
    number = lambda *what: F.conv(F.substring(draw(salt, *what), 1, 12), 16, 10).cast("long")
    if k >= slots:
        drawn = _without_replacement(F.lit(k), slots, lambda i: number(F.lit("e"), F.col("batch"), i))
    else:
        drawn = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda i: F.pmod(number(F.lit("any"), F.col("batch"), i), F.lit(k)))
    chosen = batches.select("batch", F.posexplode(drawn).alias("slot", "e")).join(eps, "e")
    some = F.array_sort(_without_replacement(F.col("n"), group, lambda i: number(F.lit("f"), F.col("batch"), F.col("slot"), i)))
    every = F.transform(F.sequence(F.lit(0), F.lit(group - 1)).cast("array<long>"), lambda i: F.least(i, F.col("n") - 1))
    # Places are drawn from lengths alone; frames are joined to the places drawn, and never gathered by episode.
    places = chosen.select("batch", "slot", *keys, F.posexplode(F.when(F.col("n") > group, some).otherwise(every)).alias("pos", "__p"))
    numbered_frames = frames.select(*keys, index, (F.row_number().over(Window.partitionBy(*keys).orderBy(index)) - 1).cast("long").alias("__p"))
    return places.join(numbered_frames, [*keys, "__p"]).select("batch", "slot", *keys, "pos", index)


def _without_replacement(n: Column, size: int, number: Callable[[Column], Column]) -> Column:
    """``size`` different numbers below ``n``, all sets alike likely: the i-th draw is below n - size + i + 1, and what
    was drawn before gives way to that range's end. ``number(i)`` draws a large one. Needs n >= size."""

    def add(out: Column, i: Column) -> Column:
        last = n - size + i
        t = F.pmod(number(i), last + 1)
        return F.array_append(out, F.when(F.array_contains(out, t), last.cast("long")).otherwise(t))

    return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.expr("cast(array() as array<bigint>)"), add)


def stream_schedule(frames: DataFrame, batch_size: int, rank: int = 0, world: int = 1, seed: int = 0, epoch: int = 0, keys: Sequence[str] = ("dataset", "episode_id"), index: str = "frame_index", parallel: bool = False) -> DataFrame:
    """Whole episodes in drawn order. One stream fills batches one frame after the other; ``parallel`` gives every
    place of a batch a stream of its own episodes. Returns ``batch, slot, keys, index``; short last batches stay out
    in the single stream."""
    own = number_episodes(frames, keys, seed + epoch).where(F.pmod(F.col("place"), F.lit(world)) == rank).withColumn("e", F.floor(F.col("place") / world).cast("long")).drop("place")
    sizes = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).join(own, list(keys))
    lane = F.pmod(F.col("e"), F.lit(batch_size)).cast("int") if parallel else F.lit(0)
    # Where an episode begins: frames of earlier blocks of episodes, and of earlier episodes of its own block.
    sized = sizes.withColumns({"slot": lane, "__k": F.floor(F.col("e") / BLOCK).cast("long")})
    ahead = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sized.groupBy("slot", "__k").agg(F.sum("__n").alias("__s")).withColumn("__before", F.coalesce(F.sum("__s").over(ahead("slot").orderBy("__k")), F.lit(0))).drop("__s")
    own_part = F.coalesce(F.sum("__n").over(ahead("slot", "__k").orderBy("e")), F.lit(0))
    based = sized.withColumn("__own", own_part).join(blocks, ["slot", "__k"]).withColumn("__base", F.col("__before") + F.col("__own")).drop("__k", "__before", "__own")
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(index)) - 1
    rows = frames.withColumn("__i", inner).join(based.drop("__n", "e"), list(keys)).withColumn("__g", F.col("__base") + F.col("__i"))
    if parallel:
        return rows.select(F.col("__g").cast("long").alias("batch"), "slot", *keys, index)
    out = rows.select(F.floor(F.col("__g") / batch_size).cast("long").alias("batch"), F.pmod(F.col("__g"), F.lit(batch_size)).cast("int").alias("slot"), *keys, index)
    total = based.agg(F.sum("__n")).first()[0] or 0
    return out.where(F.col("batch") < total // batch_size)
