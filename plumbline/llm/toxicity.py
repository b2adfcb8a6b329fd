"""Toxicity by a classifier chain of linear models over hashed words.

The chain predicts the label columns in order. Each link is a logistic regression on a document's distinct words
(lower-cased, hashed to ``DIM`` places, present or not) and on the probabilities of all earlier links. An L1 penalty
keeps only words that tell. For training, those earlier probabilities are out of fold: each comes from a model
that has not seen the row, so that a later link learns how far an earlier one can be trusted.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.labels import held_out, training_sample
from plumbline.llm.store import map_arrow

#: Bound of what is gathered for training: rows of each combination of labels, with whole texts.
PER_CLASS = 3000
DIM = 1 << 16
FOLDS = 5
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Chain:
    names: list[str]
    weights: list[np.ndarray] = field(default_factory=list)  # DIM word weights, earlier links' weights, intercept


class _Places:
    """Word -> place, remembered; the memory is emptied when it is full, so it stays bounded."""

    def __init__(self, dim: int = DIM, most: int = 400_000):
        self.dim, self.most, self.known = dim, most, {}

    def of(self, text: str | None) -> np.ndarray:
        words = set(_WORD.findall((text or "").lower()))
        known = self.known
        if len(known) > self.most:
            known.clear()
        out = []
        for w in words:
            p = known.get(w)
            if p is None:
                p = zlib.crc32(w.encode("utf-8", "surrogatepass")) % self.dim
                if len(w) <= 40:
                    known[w] = p
            out.append(p)
        return np.unique(np.array(out, np.int64))


class _Rows:
    """Sparse 0/1 rows: which places each text has."""

    def __init__(self, places: list[np.ndarray]):
        self.n = len(places)
        self.at = np.concatenate(places) if places else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(p) for p in places])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, g[self.row], DIM)

    def take(self, mask: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        keep = mask[self.row]
        out.n, out.at, out.row = int(mask.sum()), self.at[keep], (np.cumsum(mask) - 1)[self.row[keep]]
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit_link(x: _Rows, extra: np.ndarray, y: np.ndarray, l1: float = 1.0, rounds: int = 250) -> np.ndarray:
    """Logistic loss with an L1 penalty on words, by accelerated proximal gradient steps: most words get weight zero."""
    k = extra.shape[1]
    w = np.zeros(DIM + k + 1)
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    z, t = w.copy(), 1.0
    per_row = np.bincount(x.row, minlength=x.n)
    step = 4.0 / max(1.0, float(np.sqrt((per_row + 1 + k).astype(float) @ (per_row + 1 + k)) * 2))
    best = None
    loss = lambda v: float(np.logaddexp(0, -(2 * y - 1) * (x.dot(v[:DIM]) + extra @ v[DIM : DIM + k] + v[-1])).sum() + l1 * np.abs(v[:DIM]).sum() + 0.5 * (v[DIM:-1] ** 2).sum())
    before = loss(w)
    for _ in range(rounds):
        r = _sigmoid(x.dot(z[:DIM]) + extra @ z[DIM : DIM + k] + z[-1]) - y
        grad = np.concatenate([x.back(r), extra.T @ r + z[DIM:-1], [r.sum()]])
        new = z - step * grad
        new[:DIM] = np.sign(new[:DIM]) * np.maximum(np.abs(new[:DIM]) - step * l1, 0)
        now = loss(new)
        if now > before * (1 + 1e-9):  # too long a step, or momentum past the valley: start again from the best
            step, z, t = step / 2, w.copy(), 1.0
            continue
        up = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / up * (new - w)
        if best is not None and before - now < 1e-6 * before:
            w = new
            break
        best, w, t, before, step = now, new, up, now, step * 1.05
    return w


def _link(w: np.ndarray, x: _Rows, extra: np.ndarray) -> np.ndarray:
    k = extra.shape[1]
    return _sigmoid(x.dot(w[:DIM]) + extra @ w[DIM : DIM + k] + w[-1])


def _train(texts: list[str], ids: list[int], targets: np.ndarray, names: list[str], spark=None) -> Chain:
    """Fit the chain. A link's own fit and those without a fold each don't depend on each other: with a session they
    are tasks of one job, which get the rows as a broadcast of the training sample's size."""
    places = _Places()
    x = _Rows([places.of(t) for t in texts])
    folds = np.array([zlib.crc32(f"fold{i}".encode()) % FOLDS for i in ids], np.int64)
    chain, extra = Chain(names), np.zeros((len(texts), 0))
    for j in range(len(names)):
        y, last = targets[:, j], j + 1 == len(names)
        held = [] if last else [f for f in range(FOLDS) if (folds != f).any() and (folds == f).any()]
        own, *others = _fits(x, extra, y, [folds >= 0, *(folds != f for f in held)], spark)
        chain.weights.append(own)
        if not last:
            out = np.full(len(texts), y.mean() if len(y) else 0.0)
            for f, w in zip(held, others, strict=True):
                out[folds == f] = _link(w, x.take(folds == f), extra[folds == f])
            extra = np.column_stack([extra, out])
    return chain


def _fits(x: _Rows, extra: np.ndarray, y: np.ndarray, masks: list[np.ndarray], spark) -> list[np.ndarray]:
    """The weights fitted to each choice of rows."""
    one = lambda mask: _fit_link(x.take(mask), extra[mask], y[mask])
    if spark is None or len(masks) < 2:
        return [one(mask) for mask in masks]
    sent = spark.sparkContext.broadcast(pickle.dumps((x.n, x.at.astype(np.int32), x.row.astype(np.int32), extra, y, masks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, at, row, more, labels, chosen = pickle.loads(sent.value)
        own = object.__new__(_Rows)
        own.n, own.at, own.row = n, at, row
        for batch in batches:
            for i in batch.column(0).to_pylist():
                w = _fit_link(own.take(chosen[i]), more[chosen[i]], labels[chosen[i]])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([w.tobytes()], pa.binary())], names=["i", "w"])

    rows = map_arrow(spark.range(0, len(masks), 1, len(masks)), run, "i long, w binary").collect()  # FOLDS + 1 vectors
    sent.destroy()
    return [np.frombuffer(r["w"]) for r in sorted(rows, key=lambda r: r["i"])]


def fit(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = ("quality", "toxic"), per_class: int = PER_CLASS) -> Chain:
    """A chain over the label ``columns``, in that order, from at most ``per_class`` rows of each combination."""
    rows = training_sample(docs, labels, list(columns), per_class)
    if not rows:
        return Chain(list(columns), [np.zeros(DIM + j + 1) for j in range(len(columns))])
    targets = np.array([[float(r[c] > 0) for c in columns] for r in rows])
    return _train([r["text"] for r in rows], [r["doc_id"] for r in rows], targets, list(columns), docs.sparkSession)


def probabilities(chain: Chain, texts: list[str | None], places: _Places | None = None) -> np.ndarray:
    """A column per link, in the chain's order."""
    places = places or _Places()
    x = _Rows([places.of(t) for t in texts])
    extra = np.zeros((len(texts), 0))
    for w in chain.weights:
        extra = np.column_stack([extra, _link(w, x, extra)])
    return extra


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, p_<label>...)`` for every row: the chain's probabilities over the whole text.

    Null and empty texts have no words and get the chain's bare intercepts; repeated rows get equal probabilities; a
    null id is scored. Other columns are not read.
    """
    sparse = [(np.flatnonzero(w), w[np.flatnonzero(w)], len(w)) for w in chain.weights]
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps((chain.names, sparse)))  # at most DIM weights a link

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts = pickle.loads(sent.value)
        own = Chain(names)
        for at, value, n in parts:
            w = np.zeros(n)
            w[at] = value
            own.weights.append(w)
        places = _Places()
        for batch in batches:
            p = probabilities(own, batch.column(1).to_pylist(), places)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(p[:, j])) for j in range(len(names)))], names=["doc_id", *(f"p_{n}" for n in names)])

    kind = docs.schema[id_col].dataType.simpleString()
    columns = "".join(f", p_{n} double" for n in chain.names)
    out = map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, f"doc_id {kind}{columns}")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), *(f"p_{n}" for n in chain.names))
