"""Banks of whole vectors against a plain fold, where a prefix of the vectors merges other pairs."""

import random

from plumbline.plans import queries


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5


def fold(rows, length):
    bank = []
    for t, v in rows:
        bank.append((float(t), v))
        if len(bank) > length:
            sims = [cosine(a[1], b[1]) for a, b in zip(bank, bank[1:], strict=False)]
            i = sims.index(max(sims))
            (s, a), (t, b) = bank[i : i + 2]
            bank[i : i + 2] = [((s + t) / 2, [(x + y) / 2 for x, y in zip(a, b, strict=True)])]
    return bank


def test_whole_vectors_decide(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)], i % 2) for i in range(30)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.episode, r.place, r.dim): (r.t, r.value) for r in queries.bank_merge_whole(spark, str(tmp_path)).collect()}
    want, times = {}, []
    for label in (0, 1):
        own = [(i, v) for i, v, k in rows if k == label]
        bank = fold(own, 6)
        times.append([t for t, _ in bank] == [t for t, _ in fold([(i, v[:8]) for i, v in own], 6)])
        want |= {(str(label), p, d): (round(t, 6), round(x, 6)) for p, (t, v) in enumerate(bank) for d, x in enumerate(v)}
    assert got.keys() == want.keys() and not any(times)
    assert all(abs(got[k][0] - want[k][0]) < 2e-6 and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
