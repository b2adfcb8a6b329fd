"""Ordered operators on episodes: rows that share the episode keys, in the order of ``frame_index``.

Every window operator takes the same :class:`Episodes` (keys and order), so that chained operators share one exchange
and one sort. Chunks stay arrays; nothing explodes unless asked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import vec


@dataclass(frozen=True)
class Episodes:
    """What makes an episode, and its order."""

    keys: tuple[str, ...] = ("dataset", "episode_id")
    order: tuple[str, ...] = ("frame_index",)

    @property
    def ordered(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    @property
    def whole(self):
        return self.ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def ahead(self, n: int):
        return self.ordered.rowsBetween(0, n - 1)

    def length(self) -> Column:
        return F.count(F.lit(1)).over(self.whole)

    def place(self) -> Column:
        return F.row_number().over(self.ordered) - 1


EPISODES = Episodes()


def number_frames(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ("dataset", "episode_id"), name: str = "frame_index") -> DataFrame:
    """Number the rows of each episode from 0 in an explicit order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def add_action(df: DataFrame, steps: int = 1, ep: Episodes = EPISODES, prefer_existing: bool = False) -> DataFrame:
    """``action`` and ``abs_action`` are the state ``steps`` frames later; the last ``steps`` frames of an episode go.

    A null state is legal, so the cut is by place and not by null. Without ``state`` nothing happens. A stored action
    is overwritten unless ``prefer_existing``.
    """
    if "state" not in df.columns or (prefer_existing and "action" in df.columns):
        return df
    later = F.lead("state", steps).over(ep.ordered)
    out = df.withColumns({"__later": later, "__left": ep.length() - ep.place()}).where(F.col("__left") > steps)
    return out.withColumns({"action": F.col("__later"), "abs_action": F.col("__later")}).drop("__later", "__left")


def delta_action(df: DataFrame, non_delta=None, periodic=None, period: float | Column = 2 * math.pi) -> DataFrame:
    """``action`` relative to ``state``; see :func:`plumbline.functions.vec.delta`."""
    if not {"state", "action"} <= set(df.columns):
        return df
    return df.withColumn("action", vec.delta(F.col("action"), F.col("state"), non_delta, periodic, period))


def relative_to_delta(df: DataFrame, non_delta=None, periodic=None, half_range: float = math.pi, ep: Episodes = EPISODES) -> DataFrame:
    """Differences of consecutive actions; the first stays. ``non_delta`` keeps its values, then periodic dimensions
    are wrapped once by a full turn beyond half_range."""
    if "action" not in df.columns:
        return df
    before = F.lag("action").over(ep.ordered)
    moved = F.when(F.col("__place") == 0, F.col("action")).otherwise(vec.subtract(F.col("action"), F.col("__before")))
    kept = vec.wrap_dims(vec.take_dims(F.col("__moved"), F.col("action"), non_delta), periodic, half_range, 2 * half_range)
    return df.withColumns({"__before": before, "__place": ep.place()}).withColumn("__moved", moved).withColumn("action", kept).drop("__before", "__place", "__moved")


def chunk_to_delta(chunk: Column, non_delta=None, periodic=None, half_range: float = math.pi) -> Column:
    """:func:`relative_to_delta` along the chunk axis of an array of vectors."""

    def one(x: Column, k: Column) -> Column:
        moved = F.when(k == 0, x).otherwise(vec.subtract(x, F.get(chunk, k - 1)))
        return vec.wrap_dims(vec.take_dims(moved, x, non_delta), periodic, half_range, 2 * half_range)

    return F.transform(chunk, one)


def absolute_action(df: DataFrame, non_delta=None, periodic=None, half_range: float = math.pi) -> DataFrame:
    """``action`` made absolute again by adding ``state``."""
    if not {"state", "action"} <= set(df.columns):
        return df
    return df.withColumn("action", vec.absolute(F.col("state"), F.col("action"), non_delta, periodic, half_range))


def _padded_chunk(df: DataFrame, length: int, padding: str, non_delta, ep: Episodes, pad_short: bool) -> DataFrame:
    """``__chunk``: the next ``length`` actions as an array of vectors, padded past the end."""
    if padding not in ("last", "zero"):
        raise ValueError("padding is 'last' or 'zero'")
    # The struct keeps null actions, which collect_list alone would drop.
    ahead = F.collect_list(F.struct(F.col("action").alias("a"))).over(ep.ahead(length))
    last = F.last("action").over(ep.whole)
    out = df.withColumns({"__ahead": F.transform(ahead, lambda s: s["a"]), "__last": last, "__n": ep.length()})
    if not pad_short:  # short episodes are set apart, not padded
        out = out.where(F.col("__n") >= length)
    pad = F.col("__last")
    if padding == "zero":
        pad = F.transform(pad, lambda x, i: F.when(vec.in_dims(i, F.size("__last"), non_delta), x).otherwise(F.lit(0.0)))
    return out.withColumn("__chunk", F.concat(F.col("__ahead"), F.array_repeat(pad, F.lit(length) - F.size("__ahead")))).drop("__ahead", "__last", "__n")


def add_chunk(df: DataFrame, length: int = 10, flat: bool = True, padding: str = "last", non_delta=None, pad_short: bool = True, ep: Episodes = EPISODES, name: str = "action") -> DataFrame:
    """``action`` becomes the next ``length`` actions; past the end the last one repeats, or is zero outside the
    ``non_delta`` dimensions. Flat is row-major. Episodes shorter than the chunk are padded, or left out where
    ``pad_short`` is false (see :func:`short_episodes`)."""
    if "action" not in df.columns:
        return df
    chunk = F.flatten(F.col("__chunk")) if flat else F.col("__chunk")
    return _padded_chunk(df, length, padding, non_delta, ep, pad_short).withColumn(name, chunk).drop("__chunk")


def add_cumulative_chunk(df: DataFrame, length: int = 10, padding: str = "last", gripper: Sequence[int] | Column = (-1,), non_delta=None, pad_short: bool = True, ep: Episodes = EPISODES) -> DataFrame:
    """Like :func:`add_chunk`, but running sums along the chunk, from left to right; ``gripper`` dimensions take the
    newest value instead. Always flat. Zero padding keeps the ``gripper`` dimensions of the last action, so a held
    gripper stays held."""
    if "action" not in df.columns:
        return df
    newest = gripper if isinstance(gripper, Column) else F.array(*map(F.lit, gripper)).cast("array<int>")
    held = gripper if non_delta is None else non_delta
    return _padded_chunk(df, length, padding, held, ep, pad_short).withColumn("action", _running_sums()(F.col("__chunk"), newest)).drop("__chunk")


def _running_sums():
    """Arrow function: (chunks, dimensions that take the newest value) -> flat running sums. A chunk with a null, or of
    vectors of several lengths, is summed by itself; nulls stay null from there on in their dimension."""

    def summed(chunk: np.ndarray, dims: list[int]) -> np.ndarray:
        out = np.cumsum(chunk, axis=-2)
        for d in dims:
            if -chunk.shape[-1] <= d < chunk.shape[-1]:
                out[..., d] = chunk[..., d]
        return out

    def one(chunk: list | None, dims: list | None) -> list | None:
        if chunk is None or any(v is None for v in chunk):
            return None
        if len({len(v) for v in chunk}) > 1:
            raise ValueError("the vectors of a chunk have several lengths")
        if not chunk:
            return []
        flat = summed(np.array([[np.nan if x is None else x for x in v] for v in chunk], float), [d for d in dims or () if d is not None])
        gone = np.logical_or.accumulate(np.array([[x is None for x in v] for v in chunk]), axis=0)
        return [None if g else x for x, g in zip(flat.ravel().tolist(), gone.ravel().tolist(), strict=True)]

    @F.arrow_udf("array<double>")
    def run(chunks: pa.Array, dims: pa.Array) -> pa.Array:
        n = len(chunks)
        steps, vectors = chunks.value_lengths(), chunks.flatten()
        widths, values = vectors.value_lengths(), vectors.flatten()
        same = lambda lengths: len(lengths) > 0 and not lengths.null_count and lengths.to_numpy().min() == lengths.to_numpy().max()
        alike = dims.null_count == 0 and len(set(map(tuple, dims.to_pylist()))) == 1 if n else False
        if same(steps) and same(widths) and not chunks.null_count and not values.null_count and alike:
            shape = n, steps[0].as_py(), widths[0].as_py()
            flat = summed(values.to_numpy().reshape(shape), dims[0].as_py()).ravel()
            size = shape[1] * shape[2]
            return pa.ListArray.from_arrays(pa.array(np.arange(0, n * size + 1, size) if size else np.zeros(n + 1), pa.int32()), pa.array(flat, pa.float64()))
        return pa.array([one(c, d) for c, d in zip(chunks.to_pylist(), dims.to_pylist(), strict=True)], pa.list_(pa.float64()))

    return run


def short_episodes(df: DataFrame, length: int, ep: Episodes = EPISODES) -> DataFrame:
    """Episodes with fewer than ``length`` frames: keys, ``frames`` and ``error``, for a quarantine table."""
    return df.groupBy(*ep.keys).agg(F.count(F.lit(1)).alias("frames")).where(F.col("frames") < length).withColumn("error", F.concat(F.lit("fewer than "), F.lit(length), F.lit(" frames")))


def integrate(df: DataFrame, start: Column, ep: Episodes = EPISODES, hold: Sequence[int] = (6,), angles: Sequence[int] = (3, 4, 5), half_range: float = math.pi) -> DataFrame:
    """Absolute actions from deltas: each result is the one before with its ``hold`` dimensions zeroed, plus the delta,
    ``angles`` wrapped once. The running wrap isn't linear, so each episode is folded in order; ``start`` is its first
    vector. One row per input frame, emitted once."""
    rows = df.select(*ep.keys, *ep.order, F.col("action").cast("array<double>").alias("action"), start.cast("array<double>").alias("__s"))
    width, held, turned = len(ep.keys), tuple(hold), tuple(angles)

    def run(batches):
        now, last = None, None
        for batch in batches:
            own = zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True)
            starts, out = batch.column(batch.num_columns - 1), []
            for i, (key, delta) in enumerate(zip(own, batch.column(batch.num_columns - 2).to_pylist(), strict=True)):
                if key != now:
                    now, last = key, starts[i].as_py()
                n = len(delta) if delta is not None else 0
                zeroed, wrapped = {d % n for d in held if -n <= d < n}, {d % n for d in turned if -n <= d < n}
                if delta is not None:
                    base = last or []
                    moved = [None if x is None else x if d in zeroed else x + base[d] if d < len(base) and base[d] is not None else None for d, x in enumerate(delta)]
                    for d in wrapped:
                        x = moved[d]
                        if x is not None:
                            moved[d] = x - 2 * half_range if x > half_range else x + 2 * half_range if x < -half_range else x
                    last = moved
                else:
                    last = None
                out.append(last)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 2)), pa.array(out, pa.list_(pa.float64()))], names=batch.schema.names[:-1])

    # An episode comes sorted through one task, which holds its last vector only.
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (*ep.keys, *ep.order))
    return rows.repartition(*ep.keys).sortWithinPartitions(*ep.keys, *ep.order).mapInArrow(run, f"{schema}, action array<double>")


def label_islands(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Runs of one value: ``run`` numbers them from 0, ``step`` counts from 0 inside each. Null equals null."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = df.withColumn("__new", F.when(F.row_number().over(w) == 1, 0).when(F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1))
    runs = changed.withColumn("run", F.sum("__new").over(w))
    return runs.withColumn("step", F.row_number().over(Window.partitionBy(*keys, "run").orderBy(*order)) - 1).drop("__new")


def running_positions(df: DataFrame, mask: str, keys: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Running sum of a 0/1 mask, less one: the place of each unmasked row among the unmasked ones."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(mask).over(w) - 1)


def adjacent_similarity(df: DataFrame, vector: str, keys: Sequence[str], order: Sequence[str], name: str = "similarity") -> DataFrame:
    """Cosine similarity with the row before; null for the first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__b", F.lag(vector).over(w)).withColumn(name, F.when(F.col("__b").isNotNull(), vec.cosine(F.col(vector), F.col("__b")))).drop("__b")


def order_violations(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "frame_index") -> DataFrame:
    """Rows whose value is below that of the row before (equal is allowed: padding repeats frames)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("before", F.lag(value).over(w)).where(F.col(value) < F.col("before"))


def trim_tail(df: DataFrame, steps: int, ep: Episodes = EPISODES) -> DataFrame:
    """Without the last ``steps`` frames of each episode."""
    return df.withColumn("__left", ep.length() - ep.place()).where(F.col("__left") > steps).drop("__left")


def whole_episode(df: DataFrame, column: str, ep: Episodes = EPISODES) -> Column:
    """The first frame's value of a column, for every frame of its episode."""
    return F.first(column).over(ep.whole)


def frame_range(df: DataFrame, first: int, last: int, reach: int, ep: Episodes = EPISODES, index: str = "frame_index") -> tuple[DataFrame, DataFrame]:
    """What operators that look at most ``reach`` frames ahead need to produce frames ``first`` to ``last``: the frames
    of that range and its reach (a filter that gets to the scan), and the true lengths of the episodes."""
    lengths = df.groupBy(*ep.keys).agg(F.count(F.lit(1)).alias("n"))
    return df.where(F.col(index).between(first, last + reach)), lengths
