"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, verified Hamming distance, components.

Fingerprint: A-Z lower-cased, words between the ASCII white space characters, shingles of four words joined by one
space (repeats count; fewer words: the whole sequence as one shingle; no words or null: fingerprint zero). Every
shingle is hashed with XXH64 (seed 42); a bit is one if it is one in over half of the hashes.

Links: two fingerprints with at most ``distance`` differing bits agree in at least ``blocks - distance`` of ``blocks``
blocks, hence in one of the C(blocks, distance) choices of that many blocks. Every *distinct* fingerprint is emitted
once per choice, keyed by those blocks' bits; rows of one key meet in one run of a sorted partition, where a
breadth-first search over the run emits a spanning forest of the true links (at most rows - 1 edges, never all pairs).
A key with more than ``tile`` fingerprints is split into segments, and each pair of segments is a run of its own, so
no run exceeds two segments. With six blocks a key has about 21 bits; beyond about a hundred million distinct
fingerprints take ``blocks=7`` (27 bits, 35 choices).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.marks import marked
from plumbline.llm.store import discard, keep, map_arrow

SEED = 42
SHINGLE = 4
DISTANCE = 4
BLOCKS = 6
TILE = 1024
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of one text, in order, repeats included."""
    from xxhash import xxh64_intdigest as xx

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    n = len(words) - size + 1
    if n <= 1:
        return np.array([xx(line, SEED)], np.uint64)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    spans = zip(starts[:n].tolist(), (starts[size:] - 1).tolist(), strict=True)
    return np.fromiter((xx(line[a:b], SEED) for a, b in spans), np.uint64, n)


def fold(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Majority fingerprints of consecutive runs of hashes; ``counts`` are the runs' lengths (zero: fingerprint 0)."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # Byte lanes hold up to 255 ones: runs are cut into pieces of that many rows, summed lane by lane, then added up.
    pieces = -(-counts[full] // 255)
    first = np.cumsum(counts[full]) - counts[full]
    owner = np.repeat(np.arange(len(full)), pieces)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = first[owner] + 255 * step
    begin = np.cumsum(pieces) - pieces
    half = counts[full]
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), begin, axis=0)
        major = (2 * ones > half[:, None]).astype(np.uint64)
        for byte in range(8):
            out[full] |= major[:, byte] << np.uint64(8 * byte + bit)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        texts, fps, held, counts, size = batch.column(1), [], [], [], 0
        for i in range(len(texts)):
            h = shingle_hashes(texts[i].as_py())
            held.append(h)
            counts.append(len(h))
            size += len(h)
            if size > 1_000_000 or i == len(texts) - 1:
                fps.append(fold(np.concatenate(held), np.array(counts, np.int64)))
                held, counts, size = [], [], 0
        found = np.concatenate(fps) if fps else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found.view(np.int64))], schema=schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, fp long)`` for every row; the long holds the fingerprint's 64 bits."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(narrow, _fingerprint_batches, "doc_id long, fp long")


def _choices(blocks: int, distance: int) -> list[int]:
    """One mask per choice of blocks that close fingerprints may share."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    masks = [((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in range(blocks)]
    return [sum(masks[b] for b in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _run_edges(fp: np.ndarray, node: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links inside one run, by breadth-first search over what is not reached yet."""
    out, left = [], np.arange(len(fp))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[u]) <= distance
            if near.any():
                found = left[near]
                out += [(int(node[u]), int(v)) for v in node[found]]
                queue += found.tolist()
                left = left[~near]
    return out


def _edges_of_sorted(fp: np.ndarray, node: np.ndarray, starts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    ends = np.append(starts[1:], len(fp))
    size = ends - starts
    u, v = [], []
    twos = starts[size == 2]
    close = twos[np.bitwise_count(fp[twos] ^ fp[twos + 1]) <= distance]
    u.append(node[close])
    v.append(node[close + 1])
    for a, b in zip(starts[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
        found = _run_edges(fp[a:b], node[a:b], distance)
        if found:
            pair = np.array(found, np.int64)
            u.append(pair[:, 0])
            v.append(pair[:, 1])
    return np.concatenate(u), np.concatenate(v)


def _link_batches(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        rest: np.ndarray | None = None
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            starts = np.append(0, 1 + np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
            done = starts[-1]  # the last run may go on in the next batch
            rest = rows[done:]
            if done:
                u, v = _edges_of_sorted(np.ascontiguousarray(rows[:done, 3]).view(np.uint64), rows[:done, 4], starts[:-1], distance)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)
        if rest is not None and len(rest):
            u, v = _edges_of_sorted(np.ascontiguousarray(rest[:, 3]).view(np.uint64), rest[:, 4], np.array([0]), distance)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

    return run


def links(nodes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """``nodes(fp long, node long)``, one row per distinct fingerprint -> edges ``(u, v)`` that connect exactly the
    fingerprints connected by links of at most ``distance`` bits."""
    if not 0 <= distance < blocks <= 16:
        raise ValueError("0 <= distance < blocks <= 16")
    table = F.array(*(F.struct(F.lit(i).cast("long").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits")) for i, m in enumerate(_choices(blocks, distance))))
    keyed = nodes.select("fp", "node", F.explode(table).alias("k")).select("k.choice", "k.bits", "fp", "node")
    heavy = keyed.groupBy("choice", "bits").count().where(F.col("count") > tile).select("choice", "bits", F.ceil(F.col("count") / tile).cast("long").alias("g"))
    keyed = keyed.join(heavy, ["choice", "bits"], "left")
    segment = F.pmod(F.xxhash64("fp"), F.col("g"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("g") - 1), lambda j: F.least(j, F.col("s")) * F.col("g") + F.greatest(j, F.col("s")))
    tiles = F.when(F.col("g").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(others)
    dealt = keyed.withColumn("s", segment).select("choice", "bits", F.explode(tiles).alias("tile"), "fp", "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = dealt.repartition(parts, "choice", "bits", "tile").sortWithinPartitions("choice", "bits", "tile")
    return map_arrow(runs, _link_batches(distance), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own included. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows and repeated ids give a row each. A null id gets its
    fingerprint; its component is that of the other rows of its fingerprint, or null if there is none. Ids are cast to
    long (one that isn't a number is an error). Other columns of ``docs`` are not read.
    """
    prints = keep(fingerprints(docs, id_col, text_col))
    nodes = keep(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    found = components(links(nodes, distance, blocks))
    roots = keep(nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(roots, "fp", "left").select("doc_id", hexed, "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all columns: the least id's (nulls last; of equal ids and texts any).

    Near-duplicates share 0.8 of their five-word shingles, or are linked by such pairs. Pairs within four bits of the
    SimHash over five-word shingles are candidates, found by pigeonhole blocks; but at a likeness of 0.8 fingerprints
    differ in 7 to 9 bits and more, too many for blocks that still tell texts apart, so signature bands of MinHash
    give candidates besides. All candidates are verified. Null and empty texts are one group.
    """
    from plumbline.llm.minhash import text_classes

    key, text = "__text_key", F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    every, classes = text_classes(docs, id_col, text_col, simhash=True)
    order = F.struct(F.col("least_id").isNull(), "least_id", "text_key")
    chosen = classes.groupBy("root").agg(F.min_by("text_key", order).alias("first"))
    # What becomes of a text, for those with copies or near copies: all rows go, or one row stays.
    fates = keep(classes.join(chosen, "root").withColumn("stays", F.col("first") == F.col("text_key")).where("not stays or n_rows > 1").select(F.col("text_key").alias(key), "stays"))
    discard(every)
    discard(classes)
    rows = marked(docs.select(F.struct(*docs.columns).alias("row"), F.unhex(F.sha2(text.cast("binary"), 256)).alias(key)), fates.select(key), key, "__met")
    # Rows of a repeated text are reduced before they are shuffled. A row that is marked by chance is its text's only one.
    first = F.struct(F.col(f"row.`{id_col}`").isNull(), F.col(f"row.`{id_col}`"))
    one = rows.where("__met").groupBy(key).agg(F.min_by("row", first).alias("row")).join(fates.where("not stays"), key, "left_anti")
    return rows.where("not __met").select("row.*").union(one.select("row.*"))
