"""MinHash fingerprints: the contract against a brute-force version, and the estimate against true Jaccard."""

import hashlib
import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from plumbline.llm import minhash as m

DOCS = "doc_id long, text string, bucket int, n_chars long"


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_signature(text):
    a, b = m._maps()
    hashes = [xxh64_intdigest(s, 42) for s in shingles(text)]
    return [min(((int(x) * h + int(y)) % 2**64 >> 32 for h in hashes), default=2**32 - 1) for x, y in zip(a, b, strict=True)]


def brute(rows):
    out = []
    for i, (d, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        k = len(text) // 3
        changed = text[: len(text) - k] + nxt[:k]
        s, e, n = brute_signature(text), brute_signature(changed), brute_signature(nxt)
        near = lambda x, y: sum(p == q for p, q in zip(x, y, strict=True)) / len(x)
        text_of = lambda x: "".join(f"{v:08x}" for v in x)
        out.append((d, len(text), hashlib.sha256(changed.encode()).hexdigest(), text_of(s), text_of(e), near(s, e), near(s, n)))
    return sorted(out, key=repr)


def made(n=80, seed=6):
    rng = random.Random(seed)
    word = lambda: rng.choice(["ab", "Cd", "é", "日本", "🙂", "x1", "the"])
    return [(3 * i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(n)] + [(1000, None), (1001, ""), (1002, " \n"), (1003, "w " * 6000)]


@pytest.mark.parametrize("n", [1, 2, 80])
def test_brute_force(spark, n):
    rows = made()[-n:]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], DOCS).repartition(3)
    got = sorted(map(tuple, m.edit_likeness(docs).collect()), key=repr)
    assert got == brute(sorted(rows, reverse=True, key=lambda r: r[0]))


def test_ties_repeats_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other words here"), (2, "two"), (None, "no id"), (None, "no id"), (None, "more")]
    got = m.edit_likeness(spark.createDataFrame([(*r, 1, 1) for r in rows], DOCS).repartition(4)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted((d is None, d or 0, len(t)) for d, t in rows)
    assert m.edit_likeness(spark.createDataFrame([], DOCS)).collect() == []


def test_estimate():
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    for changed in (0, 5, 20, 80):
        other = list(words)
        for p in rng.sample(range(400), changed):
            other[p] = "new" + str(p)
        a, b = " ".join(words), " ".join(other)
        true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        assert abs(m.likeness(m.signature(a, m._maps()), m.signature(b, m._maps())) - true) < 0.15
    assert np.array_equal(m.signature("A b", m._maps()), m.signature("a  B", m._maps()))


@pytest.mark.parametrize("tile", [256, 3])
def test_near_duplicates_brute_force(spark, tile):
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE two")]
    for i in range(10, 70):
        words = list(base) if i < 50 else [f"x{rng.randrange(500)}" for _ in range(40)]
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(200, rows[10][1]), (201, rows[10][1]), (5, rows[-1][1])]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t or "") for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            union = sets[i] | sets[j]
            if (len(sets[i] & sets[j]) / len(union) if union else 1) >= 0.8:
                parent[find(i)] = find(j)
    least, texts = {}, {}
    for i, (d, t) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
        texts.setdefault(r, set()).add(t or "")
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], DOCS).repartition(3)
    got = sorted(map(tuple, m.near_duplicates(docs, tile=tile).collect()))
    assert got == sorted((d, least[find(i)], len(texts[find(i)]) - 1) for i, (d, _) in enumerate(rows))
    assert m.near_duplicates(docs.limit(0)).collect() == []


def test_star_of_many_is_salted(spark, monkeypatch):
    """Every pair of a centre is compared, however many tasks share it, and the pairs aren't dealt by their centre."""
    import numpy as np

    monkeypatch.setattr(m, "STAR", 3)
    own = list(range(100))
    sets = [(0, own), *((i, own[i % 5 :]) for i in range(1, 20)), (20, own[50:] + list(range(200, 250))), (21, own[:99]), (22, own[:99])]
    made = spark.createDataFrame([(n, len(x), np.array(x, np.uint64).tobytes()) for n, x in sets], "node long, size long, shingles binary")
    pairs = [(0, i) for i in range(1, 21)] + [(21, 22)]
    read, plans = m.keep, []
    monkeypatch.setattr(m, "keep", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or read(df))
    got = m._star_links(spark.createDataFrame(pairs, "u long, v long"), made, 0.8)
    assert sorted(map(tuple, got.collect())) == [p for p in sorted(pairs) if p != (0, 20)]
    assert "strategy=broadcast" in plans[-1]
