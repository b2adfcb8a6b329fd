"""Keyed state on streams with ``transformWithStateInPandas``: memory banks, session labels, action integration.

State is per key and bounded: a bank has at most its length, a session and an integrator have one row. The state store
must be RocksDB (see :func:`configure`). Inside a micro-batch the rows of a key are taken in the order of their order
column; batches must not go back in time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def configure(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    norm = float(np.sqrt(a @ a) * np.sqrt(b @ b))
    return float(a @ b) / norm if norm else -2.0


def trim_bank(bank: list[tuple[float, list[float]]], length: int, merge: bool) -> list[tuple[float, list[float]]]:
    """The bank cut to ``length``: oldest entries go, or the most similar neighbours become one (ties: the first)."""
    if not merge:
        return bank[-length:]
    bank = list(bank)
    while len(bank) > length:
        vectors = [np.asarray(v, float) for _, v in bank]
        sims = [_cosine(a, b) for a, b in zip(vectors, vectors[1:], strict=False)]
        i = int(np.argmax(sims))
        bank[i : i + 2] = [((bank[i][0] + bank[i + 1][0]) / 2, ((vectors[i] + vectors[i + 1]) / 2).tolist())]
    return bank


class Bank(StatefulProcessor):
    """Appends ``(t, v)`` rows and emits the bank after each; a row with ``reset`` clears it first."""

    def __init__(self, length: int, merge: bool):
        self.length, self.merge = length, merge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("bank", "t double, v array<double>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        bank = [(float(t), list(v)) for t, v in self.entries.get()] if self.entries.exists() else []
        out = []
        for r in pd.concat(list(rows)).sort_values("t").itertuples():
            if r.reset:
                bank = []
            bank = trim_bank([*bank, (float(r.t), [float(x) for x in r.v])], self.length, self.merge)
            out.append((*key, float(r.t), [t for t, _ in bank], [list(v) for _, v in bank]))
        self.entries.put([(t, v) for t, v in bank])
        yield pd.DataFrame(out, columns=["role", "episode", "t", "times", "vectors"])

    def close(self) -> None:
        pass


def bank_stream(df: DataFrame, length: int, merge: bool = False) -> DataFrame:
    """``df(role string, episode string, t double, v array<double>, reset boolean)``, streaming or not -> the bank after
    every row: ``times array<double>, vectors array<array<double>>``."""
    return df.groupBy("role", "episode").transformWithStateInPandas(
        statefulProcessor=Bank(length, merge), outputStructType="role string, episode string, t double, times array<double>, vectors array<array<double>>", outputMode="append", timeMode="None"
    )


class Sessions(StatefulProcessor):
    """A request with the text of the one before is the next step of its episode; another text begins a new one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "text string, run int, step int")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        text, run, step = tuple(self.last.get()) if self.last.exists() else (None, -1, -1)
        out = []
        for r in pd.concat(list(rows)).sort_values("seq").itertuples():
            now = None if r.text is None or r.text != r.text else r.text
            run, step = (run, step + 1) if run >= 0 and now == text else (run + 1, 0)
            text = now
            out.append((*key, int(r.seq), text, run, step))
        self.last.update((text, run, step))
        yield pd.DataFrame(out, columns=["client", "seq", "text", "run", "step"])

    def close(self) -> None:
        pass


def session_stream(df: DataFrame) -> DataFrame:
    """``df(client string, seq long, text string)`` -> with ``run`` and ``step``, both from 0."""
    return df.groupBy("client").transformWithStateInPandas(statefulProcessor=Sessions(), outputStructType="client string, seq long, text string, run int, step int", outputMode="append", timeMode="None")


class Integrator(StatefulProcessor):
    """Absolute actions from deltas; the state is the last result, and the first row's ``start`` begins it."""

    def __init__(self, hold: tuple[int, ...] = (6,), angles: tuple[int, ...] = (3, 4, 5), half_range: float = math.pi):
        self.hold, self.angles, self.half = list(hold), list(angles), half_range

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "action array<double>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = np.array(self.last.get()[0], float) if self.last.exists() else None
        out = []
        for r in pd.concat(list(rows)).sort_values("seq").itertuples():
            base = np.array(r.start if last is None else last, float)
            base[[d for d in self.hold if d < len(base)]] = 0
            last = base + np.asarray(r.delta, float)
            for d in self.angles:
                if d < len(last):
                    last[d] += -2 * self.half if last[d] > self.half else 2 * self.half if last[d] < -self.half else 0
            out.append((*key, int(r.seq), last.tolist()))
        self.last.update((last.tolist(),))
        yield pd.DataFrame(out, columns=["episode", "seq", "action"])

    def close(self) -> None:
        pass


def integrate_stream(df: DataFrame, **options) -> DataFrame:
    """``df(episode string, seq long, delta array<double>, start array<double>)`` -> ``episode, seq, action``."""
    return df.groupBy("episode").transformWithStateInPandas(statefulProcessor=Integrator(**options), outputStructType="episode string, seq long, action array<double>", outputMode="append", timeMode="None")


def run_to_files(df: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all that is there into Parquet files below ``folder`` (results of any size) and return them."""
    query = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/rows")
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")


def run_available(df: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Run a stream over all that is there into an in-memory table (for tests and small results) and return it."""
    query = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)
