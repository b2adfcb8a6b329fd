"""Document fingerprints by MinHash: universal hash permutations over word shingles, in vectorised numpy.

Words are the runs between ASCII white space after A-Z has been lower-cased; shingles are five words (fewer words: the
whole sequence; none: no shingle). Each shingle's XXH64 goes through ``PERMUTATIONS`` maps x -> (a x + b mod 2^64) >> 32
with odd a (multiply-shift), and a text keeps each map's least value. The share of equal places of two fingerprints
estimates the Jaccard likeness of their shingle sets. A text without shingles has the highest value everywhere: it is
like another such text and unlike any other.

``near_duplicates`` cuts signatures into 25 bands of five places. Texts (equal ones count once, told apart by SHA-256)
that share a band meet in Spark, and their true Jaccard likeness over all shingles is computed; at 0.8 a pair misses all
bands with a chance of one in twenty thousand. Two steps keep this linear where many texts are alike: first every text
of a bucket is compared with the bucket's centre only, the text that shares most bands with others, and a text's
shingles are moved once for each of its centres; then a bucket's other texts, where they are still in different
components, are searched breadth first, in tiles of bounded rows and bytes, without comparing what is already connected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.marks import marked
from plumbline.llm.simhash import fold, links, shingle_hashes
from plumbline.llm.store import discard, keep, map_arrow

PERMUTATIONS = 128
SHINGLE = 5
SEED = 20_011
_CHUNK = 2048
BANDS, BAND_ROWS = 25, 5
LIKE = 0.8
TILE = 256
#: Bytes of shingles in a tile, and texts compared with one centre in a task; more of them only make more tiles.
TILE_BYTES = 8 << 20
STAR = 4096


def _maps(n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def signature_of(hashes: np.ndarray, maps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of every map over shingle hashes, as uint32."""
    a, b = maps
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    hashes = np.unique(hashes)
    for i in range(0, len(hashes), _CHUNK):  # bounded memory for any length
        mapped = (a[:, None] * hashes[None, i : i + _CHUNK] + b[:, None]) >> np.uint64(32)
        np.minimum(out, mapped.min(axis=1).astype(np.uint32), out=out)
    return out


def signature(text: str | None, maps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The text's least value of every map, as uint32."""
    return signature_of(shingle_hashes(text, SHINGLE), maps)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of equal places: 0 to 1."""
    return float(np.count_nonzero(x == y)) / len(x)


def edited(text: str, other: str) -> str:
    """``text`` with its last third (rounded down) of code points replaced by the first as many of ``other``."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def _hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, each with its successor behind it; a bucket ends with a copy of the next one's first row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    maps = _maps()
    last = None  # bucket, id, text, signature
    for batch in batches:
        rows = []
        for bucket, doc, text in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or ""
            sig = signature(text, maps)
            if last is not None and last[0] == bucket:
                changed = edited(last[2], text)
                own = signature(changed, maps)
                rows.append((last[1], len(last[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), _hex(last[3]), _hex(own), likeness(last[3], own), likeness(last[3], sig)))
            last = bucket, doc, text, sig
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's beginning, in descending id order.

    Each document meets its successor without a global sort: ids are cut into buckets at approximate quantiles, and
    every bucket also gets a copy of the first row of the bucket that follows (that of the last bucket is the first
    row of all). A bucket is sorted in its task and walked once. Rows of one id follow each other in the order of
    their texts' hashes; null ids come last of all; a single document is its own successor. Null texts are empty. Ids
    are cast to long (one that isn't a number is an error). Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = base.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts) if parts > 1 else F.lit(None)).first()[0] or []
    cuts = sorted(set(cuts))
    # The bucket of an id: how many cuts lie at or above it, so that buckets ascend as ids descend; nulls are last.
    bounds = F.array(*(F.lit(c).cast("long") for c in cuts)) if cuts else F.expr("cast(array() as array<bigint>)")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(bounds, lambda c: c >= F.col("doc_id"))))
    placed = base.withColumn("bucket", bucket.cast("int")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    # First rows: one (id, tie) a bucket, so at most 2 * shuffle partitions + 1 rows, gathered without their texts.
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("o"), "tie"))
    heads = sorted((r["bucket"], r["m"]["o"], r["m"]["tie"]) for r in placed.groupBy("bucket").agg(first.alias("m")).collect())
    if not heads:
        return spark.createDataFrame([], _ROW)
    follows = spark.createDataFrame([(heads[i - 1][0], b, o, t) for i, (b, o, t) in enumerate(heads)], "into int, of int, o long, t long")
    head = (placed["bucket"] == follows["of"]) & (placed["tie"] == follows["t"]) & F.bitwise_not(placed["doc_id"]).eqNullSafe(follows["o"])
    copies = placed.join(F.broadcast(follows), head).groupBy("into").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("tie").alias("tie"))
    rows = placed.select("bucket", "doc_id", "text", "tie", F.lit(0).alias("copy")).union(copies.select("into", "doc_id", "text", "tie", F.lit(1)))
    # One bucket a partition: hashing the numbers would put several of them into some.
    sorted_rows = rows.repartitionById(len(cuts) + 2, F.col("bucket")).sortWithinPartitions("bucket", "copy", *order)
    return map_arrow(sorted_rows.select("bucket", "doc_id", "text"), _walk, _ROW)


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each text's band keys, and the SimHash of the same shingles, in place of the text."""
    maps = _maps()
    for batch in batches:
        bands, prints = [], []
        for text in batch.column(2):
            hashes = shingle_hashes(text.as_py(), SHINGLE)
            prints.append(int(fold(hashes, np.array([len(hashes)]))[0].astype(np.int64)))
            sig = signature_of(hashes, maps)[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
            mixed = np.arange(1, BANDS + 1, dtype=np.uint64)  # the band is part of its key
            for k in range(BAND_ROWS):
                mixed = (mixed ^ sig[:, k]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            bands.append(mixed.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "text_key", "fp", "bands"])


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(shingle_hashes(text.as_py(), SHINGLE)) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "size", "shingles"])


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted sets of hashes; two empty sets are alike."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    shared = np.count_nonzero(x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y)
    return shared / (len(x) + len(y) - shared)


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _star_batches(least: float):
    """Rows (centre, salt, node, shingles), each group opened by its centre -> verified links with the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for batch in batches:
            found = []
            for u, node, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(4), strict=True):
                hashes = np.frombuffer(data.as_py(), np.uint64)
                if node == u:
                    centre, own = u, hashes
                elif u == centre and jaccard(own, hashes) >= least:
                    found.append((u, node))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], schema=_LINK)

    return run


def _verified(nodes: list[int], sets: list[np.ndarray], least: float, same: list[int]) -> list[tuple[int, int]]:
    """Spanning forest of the links between the texts of one tile; texts with one ``same`` number are connected."""
    sizes, same = np.array([len(s) for s in sets]), np.array(same)
    out, left = [], np.arange(len(nodes))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            known = same[left] == same[u]
            # Sizes that differ by more than the likeness allows can't be alike.
            maybe = ~known & (np.minimum(sizes[left], sizes[u]) >= least * np.maximum(sizes[left], sizes[u]))
            near = np.array([bool(m) and jaccard(sets[u], sets[v]) >= least for m, v in zip(maybe, left, strict=True)])
            out += [(nodes[u], nodes[v]) for v in left[near]]
            queue += left[near | known].tolist()
            left = left[~(near | known)]
    return out


def _bucket_batches(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets, same = None, [], [], []

        def found() -> pa.RecordBatch:
            pairs = _verified(nodes, sets, least, same)
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], schema=_LINK)

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True)
            for key, node, component, data in zip(keys, batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), strict=True):
                if key != now:
                    if len(nodes) > 1:
                        yield found()
                    now, nodes, sets, same = key, [], [], []
                nodes.append(node)
                same.append(component)
                sets.append(np.frombuffer(data.as_py(), np.uint64))
        if len(nodes) > 1:
            yield found()

    return run


def _star_links(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of the candidate pairs (centre ``u``, ``v``) those that are alike, written; a centre of many is salted."""
    sizes = sets.select("node", "size")
    fit = pairs.join(sizes.withColumnsRenamed({"node": "u", "size": "a"}), "u").join(sizes.withColumnsRenamed({"node": "v", "size": "b"}), "v").where(F.least("a", "b") >= least * F.greatest("a", "b"))
    fit = keep(fit.select("u", "v"))
    # Only centres of many are told to the tasks, one for STAR pairs at most, and no pair is dealt by its centre.
    many = keep(fit.groupBy("u").count().where(F.col("count") > STAR).select("u", F.ceil(F.col("count") / STAR).cast("int").alias("g")))
    salted = lambda rows: rows.join(F.broadcast(many), "u", "left").withColumn("g", F.coalesce("g", F.lit(1)))
    ends = salted(fit).select("u", F.pmod(F.xxhash64("v"), F.col("g")).cast("int").alias("s"), F.col("v").alias("node"), F.lit(1).alias("rank"))
    centres = salted(fit.select("u").distinct()).select("u", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("s"), F.col("u").alias("node"), F.lit(0).alias("rank"))
    dealt = ends.union(centres).join(sets.select("node", "shingles"), "node").select("u", "s", "node", "rank", "shingles")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    linked = keep(map_arrow(dealt.repartition(parts, "u", "s").sortWithinPartitions("u", "s", "rank"), _star_batches(least), "u long, v long"))
    discard(fit)
    discard(many)
    return linked


def _tile_links(beside: DataFrame, sets: DataFrame, same: DataFrame, least: float, tile: int) -> DataFrame:
    """Links between texts of ``beside(key, node)`` that share a bucket but not a component of ``same(node, component)``.

    A bucket's centre is not among them: it has been compared with each, and what it links is in ``same``."""
    placed = beside.join(same, "node", "left").withColumn("component", F.coalesce("component", "node")).join(sets.select("node", "size"), "node")
    sums = F.count("*").alias("n"), F.sum("size").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("what"), F.min("component").alias("a"), F.max("component").alias("b")
    open_ones = placed.groupBy(F.struct("key").alias("k")).agg(*sums).where("a <> b").select(F.col("k.key").alias("key"), "n", "size", "what")
    # Buckets that gather the same texts are searched once.
    once = open_ones.groupBy("n", "size", "what").agg(F.min("key").alias("key"))
    g = F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("size") * 8 / TILE_BYTES)).cast("int")
    chosen = placed.select("key", "node", "component").join(once.select("key", g.alias("g")), "key").withColumn("s", F.pmod(F.xxhash64("node", "key"), F.col("g")).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda j: F.least(j, F.col("s")) * F.col("g") + F.greatest(j, F.col("s")))
    dealt = chosen.select("key", F.explode(tiles).alias("tile"), "node", "component").join(sets.select("node", "shingles"), "node")
    parts = int(beside.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = dealt.select("key", "tile", "node", "component", "shingles").repartition(parts, "key", "tile").sortWithinPartitions("key", "tile")
    return map_arrow(runs, _bucket_batches(least), "u long, v long")


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, text)`` of the wanted texts ``(node, text_key)``, one row each; hardly another text moves."""
    near = marked(rows.select("text_key", "text"), wanted.select("text_key"), "text_key", "__near").where("__near")
    return near.drop("__near").dropDuplicates(["text_key"]).join(wanted, "text_key").select("node", "text")


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LIKE, tile: int = TILE, simhash: bool = False) -> tuple[DataFrame, DataFrame]:
    """Every row, with its ``doc_id`` and ``text_key``, and every distinct text as ``(text_key, root, least_id, n_rows)``;
    both are written.

    ``text_key`` is the SHA-256 of the text in UTF-8 (null: empty), ``root`` the same number for texts that links
    connect. With ``simhash``, pairs within the pigeonhole distance of the SimHash over the same shingles are
    candidates, too.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    every = keep(map_arrow(rows.select("doc_id", "text_key", "text"), _band_batches, "doc_id long, text_key binary, fp long, bands array<long>"))
    grouped = every.groupBy("text_key").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.min("doc_id").alias("least_id"), F.count("*").alias("n_rows"))
    texts = keep(grouped.withColumn("node", F.monotonically_increasing_id()))  # numbers of a written table stay
    banded = texts.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy(F.struct("key").alias("k")).agg(F.count("*").alias("n")).where("n > 1").select(F.col("k.key").alias("key"), "n")
    met = keep(banded.join(shared, "key"))
    degrees = met.groupBy("node").agg(F.sum("n").alias("degree"))
    centres = met.join(degrees, "node").groupBy(F.struct("key").alias("k")).agg(F.max(F.struct("degree", "node")).alias("c")).select(F.col("k.key").alias("key"), F.col("c.node").alias("u"))
    beside = keep(met.join(centres, "key").where("u <> node").select("key", "u", "node"))
    pairs, done = beside.select("u", F.col("node").alias("v")).distinct(), [texts, met, beside]
    if simhash:
        prints = keep(texts.groupBy("fp").agg(F.min("node").alias("node")))
        twins = texts.select("fp", F.col("node").alias("v")).join(prints.withColumnRenamed("node", "u"), "fp").select("u", "v").where("u <> v")
        pairs = pairs.union(links(prints)).union(twins).distinct()
        done.append(prints)
    pairs = keep(pairs)
    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = keep(texts.join(wanted, "node").select("node", "text_key"))
    sets = keep(map_arrow(_texts_of(rows, wanted), _shingle_batches, "node long, size long, shingles binary"))
    linked = _star_links(pairs, sets, least)
    first = keep(components(linked))
    more = keep(_tile_links(beside.select("key", "node"), sets, first, least, tile))
    found = first if more.isEmpty() else components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
    classes = keep(texts.join(found, "node", "left").select("text_key", F.coalesce("component", "node").alias("root"), "least_id", "n_rows"))
    for table in (*done, pairs, wanted, sets, linked, first, more):
        discard(table)
    return every, classes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LIKE, tile: int = TILE) -> DataFrame:
    """``(doc_id, class_id, n_links)`` for every row: class_id is the same for documents that links connect.

    A link is a Jaccard likeness of at least ``least`` over five-word shingles; class_id is the least doc_id of the
    class (null where all its ids are null). n_links counts the class's other texts, its distinct texts less one: a
    class is detected by a forest of links, and not all of them are counted. Null and empty texts form one class. Ids
    are cast to long. Other columns are not read.
    """
    every, classes = text_classes(docs, id_col, text_col, least, tile)
    named = classes.groupBy("root").agg(F.min("least_id").alias("class_id"), (F.count("*") - 1).alias("n_links"))
    by_text = classes.join(named, "root").select(F.struct("text_key").alias("k"), "class_id", "n_links").select(F.col("k.text_key").alias("text_key"), "class_id", "n_links")
    return every.join(by_text, "text_key").select("doc_id", "class_id", "n_links")
