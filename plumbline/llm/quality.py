"""Quality by compression: two zstandard dictionaries, one of good and one of bad labelled text.

A text is cut into blocks (all of it; the last one may be shorter), and each block is compressed with either
dictionary and with none. Blocks are small so that a text's own repetitions tell less than its likeness to the
dictionaries. The features are the normalised differences of the compressed sizes, (bad - good) / plain length, and
the compressed sizes over the plain length; a logistic calibration with L2 penalty, fitted on labelled rows that did
not go into the dictionaries, turns them into the probability of label 1.

Only the text enters a score. Labels are read for training rows alone.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.labels import held_out, training_sample
from plumbline.llm.store import map_arrow

#: Bound of what is gathered for training: rows of each label, with whole texts.
PER_CLASS = 1500
BLOCK = 512
DICT_BYTES = 112 * 1024
LEVEL = 3
THRESHOLD = 0.3


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the intercept
    block: int = BLOCK


def _blocks(text: str | None, size: int) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i : i + size] for i in range(0, len(data), size)]


def _dictionary(texts: list[str], size: int, block: int) -> bytes:
    import zstandard as z

    samples = [b for t in texts for b in _blocks(t, block)]
    total = sum(map(len, samples))
    want = min(size, max(1024, total // 4))
    try:
        return z.train_dictionary(want, samples).as_bytes()
    except z.ZstdError:  # too little to train on: the text itself serves as content
        return (b"".join(samples))[-size:] or b" " * 8


def _compressor(data: bytes | None):
    import zstandard as z

    if data is None:
        return z.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
    made = z.ZstdCompressionDict(data)
    made.precompute_compress(level=LEVEL)
    return z.ZstdCompressor(dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False)


def features(texts: list[str | None], good: bytes, bad: bytes, block: int = BLOCK) -> np.ndarray:
    """One row of features per text; zeros for an empty text."""
    tools = [_compressor(good).compress, _compressor(bad).compress, _compressor(None).compress]
    out = np.zeros((len(texts), 5))
    for i, text in enumerate(texts):
        blocks = _blocks(text, block)
        if not blocks:
            continue
        n = sum(map(len, blocks))
        g, b, p = (sum(len(f(x)) for x in blocks) for f in tools)
        out[i] = (b - g) / n, (b - g) / max(1, b + g), g / n, b / n, p / n
    return out


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, intercept last, by Newton's method; the intercept is not penalised."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    ridge = np.full(x1.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (p - y) + ridge * w
        hess = (x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Train on at most ``per_class`` labelled rows of each quality: a half makes the dictionaries, a half calibrates."""
    rows = training_sample(docs, labels, ["quality"], per_class)
    classes = [[r["text"] for r in rows if r["quality"] == q] for q in (0, 1)]
    halves = [(c[::2], c[1::2] or c) for c in classes]
    bad, good = (_dictionary(h[0], DICT_BYTES, BLOCK) for h in halves)
    texts = halves[0][1] + halves[1][1]
    y = np.array([0.0] * len(halves[0][1]) + [1.0] * len(halves[1][1]))
    if not len(texts):
        return Model(good, bad, np.zeros(5), np.ones(5), np.zeros(6))
    x = features(texts, good, bad)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = logistic((x - mean) / scale, y)
    return Model(good, bad, mean, scale, w)


def scores(model: Model, texts: list[str | None]) -> np.ndarray:
    x = (features(texts, model.good, model.bad, model.block) - model.mean) / model.scale
    return 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts have the score of zero features; repeated rows have equal scores; a null id is scored and
    never held out. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # two dictionaries of at most DICT_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            s = scores(own, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns; no row moves."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            yield batch.filter(pa.array(scores(own, batch.column(at).to_pylist()) >= threshold))

    return map_arrow(docs, run, docs.schema)
