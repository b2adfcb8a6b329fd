"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of segments. A segment covers some whole documents (about ``SEGMENT_BYTES`` of text; a longer
document makes a segment of its own) and holds, for every term, the sorted positions at which it stands. Documents of
a segment are one position apart, so that no phrase reaches from one into the next. Segments are built where the
documents are read, without a shuffle, and hold about as much each, whatever words are frequent.

A search counts the test terms over all segments, then goes through the segments: it starts from the rarest term of a
window, moves that posting list by the term's offset, and intersects it with the other terms' moved lists from rare to
frequent until it is empty or all terms have agreed. What remains are exact phrase matches. ``proximity`` follows the
terms in order instead and allows gaps.

Test items are taken in blocks of at most ``ITEM_BYTES`` of text; each block is one pass over the index, so the
broadcast stays bounded for any number of items.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from plumbline.llm.store import keep, map_arrow

WINDOW = 10
SEGMENT_BYTES = 1 << 21
ITEM_BYTES = 16 << 20
INDEX_SCHEMA = "segment long, doc_ids array<{id}>, starts array<int>, terms array<string>, offsets array<int>, positions binary"
#: Word bytes are 0-9, a-z after A-Z has been lower-cased, and all of 0x80 and above; the rest separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[str]:
    """The words of one text."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    return [w.decode("utf-8", "surrogatepass") for w in data.split(b" ") if w]


def _tokens(texts: pa.StringArray) -> tuple[np.ndarray, pa.StringArray, np.ndarray]:
    """(term code of every token, the terms, tokens in each text) of a whole array at once."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    _, offsets, data = texts.buffers()
    # bytes.translate keeps lengths, so the text offsets still hold.
    plain = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(data.to_pybytes().translate(_TABLE) if data else b""))
    split = pc.split_pattern(plain, " ")
    flat = split.flatten()
    full = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    counts = np.diff(before[split.offsets.to_numpy()])
    coded = flat.filter(full).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int32), coded.dictionary, counts


def _segment(ids: pa.Array, texts: pa.Array, number: int) -> pa.RecordBatch:
    codes, terms, counts = _tokens(texts)
    starts = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32)  # one free position after each document
    at = np.arange(len(codes), dtype=np.int32) + np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    order = np.argsort(codes, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(terms)))]).astype(np.int32)
    one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
    columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(starts, pa.int32()), one(terms, pa.string()), one(offsets, pa.int32()), pa.array([at[order].tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "doc_ids", "starts", "terms", "offsets", "positions"])


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids, texts, size = [], [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        ends, a = np.cumsum(lengths.astype(np.int64)), 0
        while a < len(lengths):
            base = ends[a] - lengths[a]
            b = max(a + 1, int(np.searchsorted(ends, base + SEGMENT_BYTES - size, "right")))
            ids.append(batch.column(0).slice(a, b - a))
            texts.append(batch.column(1).slice(a, b - a))
            size += int(ends[b - 1] - base)
            if b < len(lengths) or size >= SEGMENT_BYTES:
                yield _segment(pa.concat_arrays(ids), pa.concat_arrays(texts), number)
                number, ids, texts, size = number + 1, [], [], 0
            a = b
    if ids:
        yield _segment(pa.concat_arrays(ids), pa.concat_arrays(texts), number)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the positional index of ``docs``, written to the shared folder and read from there.

    Ids of whole numbers are kept as long, those of text or binary as they are."""
    kind = docs.schema[id_col].dataType
    own = kind.simpleString() if isinstance(kind, StringType | BinaryType) else "long"
    narrow = docs.select(F.col(id_col).cast(own).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return keep(map_arrow(narrow, _index_batches, INDEX_SCHEMA.format(id=own)))


@dataclass
class _Items:
    """Windows of the test items: term numbers by window, in the window's order; -1 fills short ones."""

    vocabulary: list[str]
    terms: np.ndarray
    sizes: np.ndarray
    names: list[list[str]]  # the items that own each distinct window
    rank: np.ndarray | None = None  # of each term by its count in the corpus


def _windows(rows: list, window: int) -> _Items:
    number: dict[str, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, text in rows:
        w = [number.setdefault(x, len(number)) for x in words(text)]
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[i : i + window]), set()).add(item)
    terms = np.full((len(owners), window), -1, np.int64)
    for i, key in enumerate(owners):
        terms[i, : len(key)] = key
    return _Items(list(number), terms, np.array([len(k) for k in owners], np.int64), [sorted(v) for v in owners.values()])


class _Reader:
    """One segment, as far as a vocabulary needs it."""

    def __init__(self, batch: pa.RecordBatch, i: int, vocabulary: pa.StringArray):
        get = lambda name: batch.column(batch.schema.get_field_index(name))
        self.doc_ids = get("doc_ids")[i].values
        self.starts = get("starts")[i].values.to_numpy().astype(np.int64)
        self.offsets = get("offsets")[i].values.to_numpy()
        self.positions = np.frombuffer(get("positions")[i].as_buffer(), np.int32)
        self.at = pc.fill_null(pc.index_in(vocabulary, value_set=get("terms")[i].values), -1).to_numpy()

    def postings(self, term: int) -> np.ndarray:
        k = self.at[term]
        return self.positions[self.offsets[k] : self.offsets[k + 1]]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


def _phrase(seg: _Reader, terms: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Positions at which the terms stand one after the other."""
    order = np.argsort(rank[terms], kind="stable")
    found = seg.postings(terms[order[0]]) - order[0]
    for j in order[1:]:
        if not len(found):
            break
        other = seg.postings(terms[j])
        place = np.minimum(np.searchsorted(other, found + j), len(other) - 1)
        found = found[other[place] == found + j]
    return found


def _near(seg: _Reader, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) positions of the terms in order within one document, with at most ``slop`` other words between:
    from each place of the first term, each next term at its nearest later place."""
    first = now = seg.postings(terms[0])
    for t in terms[1:]:
        other = seg.postings(t)
        place = np.searchsorted(other, now, "right")
        ok = place < len(other)
        first, now = first[ok], other[place[ok]]
    ok = (now - first <= len(terms) - 1 + slop) & (seg.doc_of(first) == seg.doc_of(now))
    return first[ok], now[ok]


def _search_batches(sent, slop: int | None):
    runs_type, items_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: _Items = pickle.loads(sent.value)
        vocabulary = pa.array(items.vocabulary, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                seg = _Reader(batch, i, vocabulary)
                here = np.append(seg.at >= 0, True)  # the last stands for -1
                edge = np.zeros(int(seg.starts[-1]) + 1, np.int32)
                owned: dict[int, set[str]] = {}
                for w in np.flatnonzero(here[items.terms].all(axis=1)):
                    terms = items.terms[w, : items.sizes[w]]
                    if slop is None:
                        first = _phrase(seg, terms, items.rank)
                        last = first + len(terms) - 1
                    else:
                        first, last = _near(seg, terms, slop)
                    if len(first):
                        np.add.at(edge, first, 1)
                        np.add.at(edge, last + 1, -1)
                        for d in np.unique(seg.doc_of(first)).tolist():
                            owned.setdefault(d, set()).update(items.names[w])
                runs: dict[int, list] = {}
                if owned:
                    hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)])
                    begin, end = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
                    for d, a, b in zip(seg.doc_of(begin).tolist(), begin.tolist(), end.tolist(), strict=True):
                        s = int(seg.starts[d])
                        runs.setdefault(d, []).append({"a": a - s, "b": b - s})
                n = len(seg.starts) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column(0)[i].as_py(), np.int64)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        seg.doc_ids,
                        pa.array(np.diff(seg.starts) - 1),
                        pa.array([runs.get(d, []) for d in range(n)], runs_type),
                        pa.array([sorted(owned.get(d, ())) for d in range(n)], items_type),
                    ],
                    names=["segment", "ord", "doc_id", "n_words", "runs", "items"],
                )

    return run


_FOUND = "segment long, ord int, doc_id {id}, n_words long, runs array<struct<a:int,b:int>>, items array<string>"


def _count_batches(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(pickle.loads(sent.value), pa.string())
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                at = pc.fill_null(pc.index_in(vocabulary, value_set=batch.column(0)[i].values), -1).to_numpy()
                total += np.where(at >= 0, np.diff(batch.column(1)[i].values.to_numpy())[at] if len(batch.column(0)[i].values) else 0, 0)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["term", "n"])

    return run


def _pass(index: DataFrame, rows: list, window: int, slop: int | None) -> DataFrame:
    context = index.sparkSession.sparkContext
    items = _windows(rows, window)
    counted = map_arrow(index.select("terms", "offsets"), _count_batches(context.broadcast(pickle.dumps(items.vocabulary))), "term long, n long")
    items.rank = np.zeros(max(1, len(items.vocabulary)), np.int64)
    for term, n in counted.groupBy("term").agg(F.sum("n")).collect():  # at most a row per word of this block's items
        items.rank[term] = n
    return map_arrow(index, _search_batches(context.broadcast(pickle.dumps(items)), slop), _FOUND.format(id=index.schema["doc_ids"].dataType.elementType.simpleString()))


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Matches of the items' windows in every document of the index.

    Returns, for each document, ``doc_id, n_words, runs, items``: the hit words as disjoint runs [a, b) of word
    positions, and the sorted ids (as strings) of the items with a window that occurs. ``slop`` None: exact phrases;
    a number: proximity, terms in order with at most that many words between (a run then covers the gaps, too).
    An item of fewer words than ``window`` is one window, an item without words is none; items with a null id or a
    null text are none. Several rows of one id count as one item. Documents without words have zero words and no runs.
    """
    known = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).dropna()
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    parts = []
    for b in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        parts.append(_pass(index, [tuple(r) for r in sorted(rows)], window, slop))
    if blocks == 1:
        return parts[0].select("doc_id", "n_words", "runs", "items")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # Runs of several blocks may overlap: sorted, each adds to the last one or opens the next.
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("runs"))),
        F.expr("cast(array() as array<struct<a:int,b:int>>)"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (r["a"] <= F.element_at(acc, -1)["b"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["b"], r["b"]).alias("b")))),
        ).otherwise(F.concat(acc, F.array(r))),
    )
    grouped = found.groupBy("segment", "ord").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), merged.alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return grouped.select("doc_id", "n_words", "runs", "items")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row of ``docs``."""
    found = search(build_index(docs), items, window=window)
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + (r["b"] - r["a"]))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
