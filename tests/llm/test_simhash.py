"""SimHash against a brute-force version: every shingle, every pair, union-find."""

import random

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from plumbline.llm.components import components
from plumbline.llm.simhash import near_duplicates

SCHEMA = "doc_id long, text string, fp string, u long"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def made(n=120, seed=3):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(4000)}" for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "two words here"), (5, "two words here"), (6, "é" * 30_000 + " x " * 9)]
    for i in range(10, 10 + n):
        copy = list(words)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(4000)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"v{rng.randrange(9)}" for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [1024, 7])
def test_brute_force(spark, tile, monkeypatch):
    import plumbline.llm.simhash as m

    monkeypatch.setattr(m.links, "__defaults__", (m.DISTANCE, m.BLOCKS, tile))
    rows = made()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == brute(rows)


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(docs).collect() == []
    docs = spark.createDataFrame([(None, "a b c d e", "", 0), (7, "a b c d e", "", 0), (None, "lonely", "", 0)], SCHEMA)
    got = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}


def test_fingerprint_hash_is_sparks(spark):
    text = "the quick brown fox"
    h = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first().h & (2**64 - 1)
    assert h == xxh64_intdigest(text, 42) == brute_fingerprint(text)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 380)] + [(1, 1)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in parent if find(x) != x}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
