"""Quality and toxicity: held-out accuracy on made text, edge cases, the training rule."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import quality, toxicity
from plumbline.llm.labels import training_sample

DOCS = "doc_id long, text string, lang string, score double, o long"


def made(n=600, seed=1):
    rng = random.Random(seed)
    syl = ["ta", "ro", "mi", "len", "dor", "sha", "ek", "un"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        bad, toxic = i % 3 == 0, i % 4 == 0
        words = [word() for _ in range(rng.randrange(60, 200))]
        if toxic:
            for _ in range(5):
                words[rng.randrange(len(words))] = rng.choice(["vile", "fool", "rotten"])
        if bad:
            words = [w.upper() + rng.choice(["!!", "%%%", "$$$"]) for w in words]
        docs.append((i, " ".join(words), "en", 0.5, 1))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def edges(docs):
    return docs + [(9000, None, None, None, None), (9001, "", "", 0.0, 0), (9002, "x" * 200_000, "", 0.0, 0), (None, "mi ro", "", 0.0, 0), docs[5], docs[5]]


def tables(spark):
    docs, labels = made()
    return spark.createDataFrame(edges(docs), DOCS), spark.createDataFrame([*labels, (9000, 1, None)], "doc_id long, quality int, toxic int"), {d: (q, t) for d, q, t in labels}


def test_quality(spark):
    docs, labels, truth = tables(spark)
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.predicted == truth[r.doc_id][0] for r in got if r.held_out and r.doc_id in truth]
    assert np.mean(right) > 0.95
    assert len({r.score for r in got if r.doc_id == 5}) == 1


def test_quality_without_rows(spark):
    docs, labels, _ = tables(spark)
    model = quality.fit(docs.limit(0), labels)
    assert quality.score(docs.limit(0), model).collect() == []
    assert all(r.score == 0.5 for r in quality.score(docs, model).collect())


def test_toxicity(spark):
    docs, labels, truth = tables(spark)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    right = [(r.p_toxic >= toxicity.THRESHOLD) == truth[r.doc_id][1] for r in got if r.held_out and r.doc_id in truth]
    assert np.mean(right) > 0.95
    assert all(0 <= r.p_quality <= 1 and 0 <= r.p_toxic <= 1 for r in got)


def test_toxicity_without_rows(spark):
    docs, labels, _ = tables(spark)
    chain = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs.limit(0), chain).collect() == []
    assert all(r.p_toxic == 0.5 for r in toxicity.score(docs, chain).collect())


def test_chain_uses_out_of_fold_probabilities():
    """The second label repeats the first one, which words tell: the earlier link's probability carries weight."""
    docs, labels = made(400)
    y = np.array([[lab[2], lab[2]] for lab in labels], float)
    chain = toxicity._train([d[1] for d in docs], [d[0] for d in docs], y, ["a", "b"])
    assert chain.weights[1][toxicity.DIM] > 0.5
    assert len(chain.weights[0]) + 1 == len(chain.weights[1])


def test_training_sample_is_bounded_and_skips_held_out(spark):
    docs, labels, _ = tables(spark)
    rows = training_sample(docs, labels, ["quality"], 64, 50)
    assert 0 < len(rows) <= 2 * 64 and max(len(r["text"]) for r in rows) <= 50
    assert not any(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    again = training_sample(docs.repartition(7, F.col("text")), labels, ["quality"], 64, 50)
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in again]


def test_scores_follow_from_the_models(spark):
    """Both classifiers' scores, worked out again text by text from their models alone."""
    import math
    import re

    import zstandard as z

    docs, labels, _ = tables(spark)
    model, chain = quality.fit(docs, labels), toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id is not null").collect()}

    def size(block, data):
        made = z.ZstdCompressionDict(data) if data else None
        return len(z.ZstdCompressor(level=quality.LEVEL, dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False).compress(block))

    def score(text):
        data = text.encode()
        blocks = [data[i : i + quality.BLOCK] for i in range(0, len(data), quality.BLOCK)]
        n = max(1, len(data))
        g, b, p = (sum(size(x, d) for x in blocks) for d in (model.good, model.bad, None))
        x = np.array([(b - g) / n, (b - g) / max(1, b + g), g / n, b / n, p / n]) if blocks else np.zeros(5)
        return 1 / (1 + math.exp(-float((x - model.mean) / model.scale @ model.weights[:-1] + model.weights[-1])))

    for r in quality.score(docs, model).where("doc_id < 40 or doc_id >= 9000").collect():
        assert abs(r.score - score(texts[r.doc_id])) < 1e-3

    def link(text, w, before):
        words = {zlib.crc32(x.encode()) % toxicity.DIM for x in set(re.findall(r"[^\W\d_]+", text.lower()))}
        total = sum(w[p] for p in words) + sum(v * q for v, q in zip(w[toxicity.DIM : -1], before, strict=True)) + w[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

    for r in toxicity.score(docs, chain).where("doc_id is not null").collect():
        first = link(texts[r.doc_id], chain.weights[0], [])
        assert abs(r.p_quality - first) < 1e-9 and abs(r.p_toxic - link(texts[r.doc_id], chain.weights[1], [first])) < 1e-9


def test_folds_as_tasks_are_folds_in_the_driver(spark):
    docs, labels = made(200)
    y = np.array([[lab[1], lab[2]] for lab in labels], float)
    given = [d[1] for d in docs], [d[0] for d in docs], y, ["quality", "toxic"]
    here, there = toxicity._train(*given), toxicity._train(*given, spark)
    assert all(np.allclose(a, b) for a, b in zip(here.weights, there.weights, strict=True))


def test_whole_texts_train(spark):
    """Only what comes late in long texts tells the classes apart."""
    rng = random.Random(3)
    filler = lambda: " ".join(f"w{rng.randrange(50)}" for _ in range(3000))
    docs = spark.createDataFrame([(i, filler() + (" vile rotten" if i % 2 else " mild sweet")) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").collect()
    assert len(got) > 20 and all((r.p_toxic > 0.5) == (r.doc_id % 2 == 1) for r in got)
    rows = training_sample(docs, labels, ["toxic"], 30)
    assert len(rows) == 60 and min(len(r["text"]) for r in rows) > 8000
