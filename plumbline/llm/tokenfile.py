"""Token-id files compressed by Re-Pair, with random access by document.

A shard holds whole documents in ascending id order. Rounds of pair replacement work on the whole shard at once in
numpy: adjacent pairs inside documents are counted (after the first round those with a new symbol; no others can have
become frequent), the frequent ones become rules, places where two chosen pairs overlap go to the more frequent pair (of
a run of one pair, to every second place), and every place left is replaced by the rule's nonterminal. Rounds go on,
over terminals and nonterminals alike, until no pair occurs ``FREQUENT`` times or the symbols of 16 bits are used up.
Rules never reach across documents.

File: ``RPT1``, a little-endian header of eight 64-bit numbers (base, rules, symbols, documents, tokens, documents
without an id, and two reserved), then the rules' left and right symbols (uint16), the rules' expansion lengths (uint32), the documents' ids
(int64), their first symbols and first tokens (int64, one more than documents), and the symbols (uint16). A symbol of
at least ``base`` is a nonterminal. One document, or any span of ids, is decoded from its symbols and the rules alone.

A task writes its shards under names of its own; the manifest names those of the attempts that counted, so a repeated
or lost task leaves at most unused files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.store import filesystem, keep, map_arrow, shared_dir
from plumbline.llm.tokens import BYTE_BPE, encoder, gathered

END = 2
SHARD_TOKENS = 1 << 20
#: A pair must occur this often in a shard to become a rule.
FREQUENT = 12
_MAGIC = b"RPT1"
_SLOTS = 1 << 18


def _every_second(run: np.ndarray) -> np.ndarray:
    """Mask of the 2nd, 4th, ... of each run of true values."""
    step = np.arange(len(run))
    begin = np.maximum.accumulate(np.where(run, 0, step + 1))
    return run & ((step - begin) % 2 == 1)


def _round(seq: np.ndarray, last: np.ndarray, first_new: int, room: int, since: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round of replacement: (symbols, document ends, pairs of the new rules as left << 16 | right). Only pairs with
    a symbol of at least ``since`` are looked at."""
    at = ~last[:-1]
    if since:
        new = seq >= since
        at &= new[:-1] | new[1:]
    at = np.flatnonzero(at)
    keys = (seq[at].astype(np.uint32) << np.uint32(16)) | seq[at + 1]
    ordered = np.sort(keys)
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(ordered) else np.zeros(1, np.int64)
    count = np.diff(edge)
    often = np.flatnonzero(count >= FREQUENT)
    often = often[np.argsort(-count[often], kind="stable")][:room]
    none = len(often)
    nothing = seq, last, np.empty(0, np.uint32)
    if not none:
        return nothing
    chosen = ordered[edge[:-1][often]]
    # One slot a pair, found by a multiplicative hash; of pairs that share a slot the most frequent one counts now.
    slot_of = lambda k: (k * np.uint32(2654435761)) >> np.uint32(14)
    table = np.full(_SLOTS, none, np.uint64)  # pair << 32 | rank
    table[slot_of(chosen)[::-1]] = (chosen[::-1].astype(np.uint64) << np.uint64(32)) | np.arange(none - 1, -1, -1, dtype=np.uint64)
    entry = table[slot_of(keys)]
    rank = entry.astype(np.uint32).astype(np.int64)
    hit = ((entry >> np.uint64(32)) == keys) & (rank < none)
    at, rank = at[hit], rank[hit]
    # Places that overlap go to the more frequent pair; of a run of one pair every second place goes on.
    touch = at[1:] == at[:-1] + 1
    take = np.ones(len(at), bool)
    again = np.concatenate([[False], touch & (rank[1:] == rank[:-1])])
    take[1:] &= ~touch | (rank[1:] < rank[:-1])
    take[_every_second(again)] = True
    take[:-1] &= ~touch | (rank[:-1] <= rank[1:])
    uses = np.bincount(rank[take], minlength=none)
    kept = uses >= max(2, FREQUENT // 2)
    number = np.cumsum(kept) - 1
    take &= kept[rank]
    place, rank = at[take], rank[take]
    if not len(place):
        return nothing
    seq = seq.copy()
    seq[place] = (first_new + number[rank]).astype(np.uint16)
    stay = np.ones(len(seq), bool)
    stay[place + 1] = False
    last = last.copy()
    last[place] = last[place + 1]
    return seq[stay], last[stay], chosen[kept]


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of each document and the end, rules) of ids below ``base``; ``ends`` are the documents'
    ends as positions in ``ids``."""
    if base > 1 << 16:
        raise ValueError("ids must fit 16 bits")
    seq, last = ids.astype(np.uint16), np.zeros(len(ids), bool)
    last[ends - 1] = True
    rules, total, since = [], 0, 0
    while len(seq) > 1 and base + total < 1 << 16:
        seq, last, new = _round(seq, last, base + total, (1 << 16) - base - total, since)
        if len(new):
            rules.append(new)
            since = base + total  # other pairs have only become rarer
            total += len(new)
        elif since:
            since = 0  # a last look at all pairs: some may have given way to pairs that then were too rare
        else:
            break
    return seq, np.concatenate([[0], np.flatnonzero(last) + 1]), np.concatenate(rules) if rules else np.empty(0, np.uint32)


def pack_shard(doc_ids: list, ids: np.ndarray, ends: np.ndarray, base: int) -> bytes:
    """The bytes of one file."""
    symbols, firsts, rules = compress(ids, ends, base)
    left, right = (rules >> np.uint32(16)).astype("<u2"), (rules & np.uint32(0xFFFF)).astype("<u2")
    grown = np.ones(base + len(rules), np.int64)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        grown[base + i] = grown[a] + grown[b]
    nulls = sum(d is None for d in doc_ids)
    if None in doc_ids[nulls:]:
        raise ValueError("documents without an id come first")
    header = struct.pack("<8q", base, len(rules), len(symbols), len(doc_ids), len(ids), nulls, 0, 0)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    tokens = np.concatenate([[0], ends]).astype("<i8")
    return b"".join([_MAGIC, header, left.tobytes(), right.tobytes(), grown[base:].astype("<u4").tobytes(), keys.tobytes(), firsts.astype("<i8").tobytes(), tokens.tobytes(), symbols.astype("<u2").tobytes()])


class Shard:
    """A file's content; ``document(i)`` and ``all()`` decode."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a token file")
        self.base, n, m, d, self.n_tokens, self.nulls = struct.unpack_from("<6q", data, 4)
        at = 4 + 64

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.left, self.right, self.grown = take("<u2", n), take("<u2", n), take("<u4", n).astype(np.int64)
        self.doc_ids, self.firsts, self.tokens, self.symbols = take("<i8", d), take("<i8", d + 1), take("<i8", d + 1), take("<u2", m)
        self._pool: np.ndarray | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every symbol's expansion in one array, with its length and place; rules only refer to earlier symbols."""
        if self._pool is None:
            self._size = np.concatenate([np.ones(self.base, np.int64), self.grown])
            self._begin = np.cumsum(self._size) - self._size
            pool = np.empty(int(self._size.sum()), np.uint16)
            pool[: self.base] = np.arange(self.base)
            size, begin = self._size.tolist(), self._begin.tolist()
            for i, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True), self.base):
                at, n = begin[i], size[a]
                pool[at : at + n] = pool[begin[a] : begin[a] + n]
                pool[at + n : at + size[i]] = pool[begin[b] : begin[b] + size[b]]
            self._pool = pool
        return self._pool, self._size, self._begin

    def _decode(self, symbols: np.ndarray) -> np.ndarray:
        pool, size, begin = self._expansions()
        n = size[symbols]
        shift = begin[symbols] - (np.cumsum(n) - n)
        return pool[np.repeat(shift, n) + np.arange(int(n.sum()))].astype("<u4")

    def all(self) -> np.ndarray:
        return self._decode(self.symbols)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, from its own symbols and the rules that these lead to."""
        return _expanded(self.symbols[self.firsts[i] : self.firsts[i + 1]], self.base, self.left, self.right)

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids at the shard's places from ``start`` to before ``stop``: the expansion lengths tell which symbols these
        are, and no others are expanded."""
        start, stop = max(0, start), min(stop, self.n_tokens)
        if start >= stop:
            return np.empty(0, "<u4")
        a, b = np.searchsorted(self.tokens, start, "right") - 1, np.searchsorted(self.tokens, stop, "left")
        symbols = self.symbols[self.firsts[a] : self.firsts[b]].astype(np.int64)
        size = np.where(symbols < self.base, 1, self.grown[np.maximum(symbols - self.base, 0)] if len(self.grown) else 1)
        ends = np.cumsum(size) + self.tokens[a]
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        skip = start - int(ends[first] - size[first])
        return _expanded(symbols[first : last + 1], self.base, self.left, self.right)[skip : skip + stop - start]


def _expanded(symbols: np.ndarray, base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All nonterminals replaced by their pairs until none is left; only rules that occur are looked up."""
    out = symbols.astype(np.int64)
    while (rule := out >= base).any():
        at = np.cumsum(1 + rule) - 1 - rule
        grown = np.empty(len(out) + int(rule.sum()), np.int64)
        grown[at] = np.where(rule, left[np.where(rule, out - base, 0)], out)
        grown[at[rule] + 1] = right[out[rule] - base]
        out = grown
    return out.astype("<u4")


def read_document(file, i: int) -> np.ndarray:
    """Ids of the i-th document of an open, seekable file: the rules and the document's own symbols are all that is read."""

    def take(at: int, kind: str, count: int) -> np.ndarray:
        file.seek(at)
        return np.frombuffer(file.read(count * np.dtype(kind).itemsize), kind)

    if file.read(4) != _MAGIC:
        raise ValueError("not a token file")
    base, rules, _, docs = take(4, "<q", 4).tolist()
    if not 0 <= i < docs:
        raise IndexError(i)
    left, right = take(68, "<u2", rules), take(68 + 2 * rules, "<u2", rules)
    firsts = 68 + 8 * rules + 8 * docs
    a, b = take(firsts + 8 * i, "<q", 2).tolist()
    return _expanded(take(firsts + 16 * (docs + 1) + 2 * a, "<u2", b - a), base, left, right)


def _write_batches(folder: str, name: str, end: int, base: int, shard_tokens: int):
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        encode, last = encoder(name), np.array([end], "<u4").tobytes()
        fs, root = filesystem(folder)
        shard, docs, data, size = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, docs, data, size
            ids = np.frombuffer(b"".join(data), "<u4")
            ends = np.cumsum([len(x) // 4 for x in data])
            content = pack_shard(docs, ids, ends, base)
            path = f"{root}/part-{part:06d}-{shard:05d}-{own}.rpt"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(path) as out:
                out.write(content)
            row = part, shard, f"{folder}/{path.rsplit('/', 1)[1]}", len(docs), len(ids), len(content)
            shard, docs, data, size = shard + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for keys, texts in gathered(batches):
            for doc, ids in zip(keys, encode.many(texts), strict=True):
                docs.append(doc)
                data.append(ids + last)
                size += len(data[-1]) // 4
                if size >= shard_tokens:
                    yield flush()
        if docs:
            yield flush()

    return run


_MANIFEST = "part int, shard int, path string, n_docs long, n_tokens long, bytes long"


def write(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE, end: int = END, base: int = 50_257, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode and write all documents in ascending id order (null ids first, repeated ids by their text's hash);
    returns the manifest, a written table. Null and empty texts are the end id alone. Ids
    are cast to long (one that isn't a number is an error). Other columns are not read."""
    folder = folder or shared_dir(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = narrow.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return keep(map_arrow(ordered, _write_batches(folder, tokenizer, end, base, shard_tokens), _MANIFEST))


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, place = filesystem(path)
            with fs.open_input_file(place) as file:
                shard = Shard(file.read())
            ids = memoryview(shard.all()).cast("B")
            at = (shard.tokens * 4).tolist()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:], strict=False)]
            keys = pa.array(shard.doc_ids, mask=np.arange(len(shard.doc_ids)) < shard.nulls)
            yield pa.RecordBatch.from_arrays([keys, pa.array(shard.tokens[:-1] + base), pa.array(np.diff(shard.tokens)), pa.array(crc, pa.int64())], schema=schema)


def read(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` decoded from the files that a manifest names."""
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    tasks = max(1, min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return map_arrow(based.repartition(tasks), _read_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")
