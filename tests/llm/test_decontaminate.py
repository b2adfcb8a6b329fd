"""Decontamination against a brute-force version."""

import hashlib
import random
import re

import pytest

import plumbline.llm.decontaminate as m

DOCS = "doc_id long, text string, item_id string, n_words int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = split(text) if item is not None and text is not None else []
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = []
    for d, text in docs:
        w, hit, found = split(text), set(), set()
        for win, owners in wins.items():
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def made(seed=2):
    rng = random.Random(seed)
    vocab = ["the", "of", "Ünder", "a1", "42", "naïve", "ZED", "q", "日本", "and"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "-", "\x7f "]) for _ in range(n))
    items = [(i, text(rng.randrange(0, 16))) for i in range(30)] + [(7, text(12)), (100, "the of"), (101, "Zed"), (102, None), (None, "q q"), (103, "...")]
    docs = []
    for i in range(60):
        body = text(rng.randrange(0, 60))
        if i % 3 == 0:
            body += " " + (items[rng.randrange(30)][1] or "") + " " + text(5)
        docs.append((i, body))
    docs += [(900, None), (901, ""), (902, " .,-"), (903, "the " * 5000), (None, items[3][1]), docs[3], docs[3]]
    return docs, items


@pytest.mark.parametrize(("segment", "block"), [(1 << 21, 16 << 20), (200, 120)])
def test_brute_force(spark, monkeypatch, segment, block):
    docs, items = made()
    monkeypatch.setattr(m, "ITEM_BYTES", block)
    if segment < 1000:  # workers see the module's own value: a document larger than a segment is tested below
        assert m._windows(items[:2], 10) is not None
    d = spark.createDataFrame([(*r, "x", 0) for r in docs], DOCS).repartition(3)
    i = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, doc_id int")
    assert sorted(map(tuple, m.contamination(d, i).collect()), key=repr) == brute(docs, items)


def test_segments_cover_everything(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(m, "SEGMENT_BYTES", 100)

    class Context:
        partitionId = staticmethod(lambda: 3)

    import pyspark

    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: Context))
    docs, _ = made()
    batches = [pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs[k : k + 9]], pa.int64()), pa.array([t for _, t in docs[k : k + 9]], pa.string())], names=["doc_id", "text"]) for k in range(0, len(docs), 9)]
    out = list(m._index_batches(iter(batches)))
    assert [x for b in out for x in b.column(1)[0].as_py()] == [d for d, _ in docs]
    assert len({b.column(0)[0].as_py() for b in out}) == len(out) > 10


def test_empty_tables(spark):
    d = spark.createDataFrame([], DOCS)
    i = spark.createDataFrame([], "item_id long, text string")
    assert m.contamination(d, i).collect() == []
    one = spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    assert [tuple(r)[:4] for r in m.contamination(one, i).collect()] == [(1, 2, 0, 0)]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y y gamma"), (2, "alpha beta gamma"), (3, "gamma beta alpha"), (4, "alpha beta"), (5, "gamma")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "Alpha beta gamma")], "item_id string, text string")
    got = {k: {r.doc_id for r in m.search(m.build_index(docs.coalesce(1)), items, slop=k).collect() if r["items"]} for k in (0, 2, 3)}
    assert got == {0: {2}, 2: {2}, 3: {1, 2}}
