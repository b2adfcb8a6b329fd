"""Bounded memory banks in batch: what a bank holds after each step, or at the end.

An entry is ``struct<t:double, v:array<double>>``. FIFO is a window; merging is a fold over sorted rows in Arrow
batches, because which pair merges depends on the bank so far. The streaming forms are in :mod:`plumbline.streaming.state`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bank_fifo(df: DataFrame, length: int, keys: Sequence[str] = ("role", "episode"), time: str = "timestep", feat: str = "feat") -> DataFrame:
    """Every row with ``bank``: the last ``length`` entries up to it."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(1 - length, 0)
    return df.withColumn("bank", F.collect_list(F.struct(F.col(time).cast("double").alias("t"), F.col(feat).alias("v"))).over(w))


class _Merger:
    """One bank while it is filled. Similarities of neighbours are kept, so a step looks at the new pairs only."""

    def __init__(self, length: int):
        self.length, self.times, self.vectors, self.near = length, [], [], []

    @staticmethod
    def _cosine(a: np.ndarray | None, b: np.ndarray | None) -> float:
        norm = 0.0 if a is None or b is None else float(np.sqrt(a @ a) * np.sqrt(b @ b))
        return float(a @ b) / norm if norm else -2.0

    def add(self, time: float, vector: np.ndarray | None) -> None:
        if self.vectors:
            self.near.append(self._cosine(self.vectors[-1], vector))
        self.times.append(time)
        self.vectors.append(vector)
        if len(self.times) > self.length > 0:
            i = int(np.argmax(self.near)) if self.near else 0
            a, b = self.vectors[i : i + 2]
            self.times[i : i + 2] = [(self.times[i] + self.times[i + 1]) / 2]
            self.vectors[i : i + 2] = [None if a is None or b is None else (a + b) / 2]
            del self.near[i]
            for k in (i - 1, i):
                if 0 <= k < len(self.near):
                    self.near[k] = self._cosine(self.vectors[k], self.vectors[k + 1])


def bank_merge(df: DataFrame, length: int, keys: Sequence[str] = ("role", "episode"), time: str = "timestep", feat: str = "feat") -> DataFrame:
    """``keys, bank``: each bank at its end, never longer than ``length`` (two at least).

    The most similar adjacent pair of entries becomes one: mean vector, mean time; of equal ones the first. Rows of a
    key come sorted through one task, which holds its bank and no more; entries of one time are in no defined order.
    """
    if length < 1:
        raise ValueError("a bank has one entry at least")
    width = len(keys)
    rows = df.select(*keys, F.col(time).cast("double").alias("__t"), F.col(feat).cast("array<double>").alias("__v"))
    entry = pa.list_(pa.struct([("t", pa.float64()), ("v", pa.list_(pa.float64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bank = None, None

        def done(key: tuple, kinds: list[pa.DataType]) -> pa.RecordBatch:
            held = [{"t": t, "v": None if v is None else v.tolist()} for t, v in zip(bank.times, bank.vectors, strict=True)]
            return pa.RecordBatch.from_arrays([*(pa.array([k], kind) for k, kind in zip(key, kinds, strict=True)), pa.array([held], entry)], names=[*keys, "bank"])

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.column(i).type for i in range(width)]
            own = list(zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True))
            times, vectors = batch.column(width).to_pylist(), batch.column(width + 1)
            for i, key in enumerate(own):
                if key != now:
                    if bank is not None:
                        yield done(now, kinds)
                    now, bank = key, _Merger(length)
                vector = vectors[i].values
                bank.add(times[i], None if vector is None else vector.to_numpy(zero_copy_only=False))
        if bank is not None:
            yield done(now, kinds)

    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return rows.repartition(*keys).sortWithinPartitions(*keys, "__t").mapInArrow(run, f"{schema}, bank array<struct<t:double,v:array<double>>>")


def call_clock(df: DataFrame, first: str, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """``clock`` counts calls from 0 and starts again where the first-frame flag is 'True'; ``episode`` counts resets."""
    own = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("episode", F.sum((F.col(first).cast("string").isin("True", "true")).cast("int")).over(own))
    return out.withColumn("clock", F.row_number().over(Window.partitionBy(*keys, "episode").orderBy(*order)) - 1)


def queue_actions(df: DataFrame, chunk: str = "chunk", keys: Sequence[str] = ("seq",)) -> DataFrame:
    """A row per action of each reply's chunk, with its ``step``; each action is queued once."""
    return df.select(*keys, F.posexplode(chunk).alias("step", "action"))
