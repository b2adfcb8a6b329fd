"""Each stage of the pipeline on its own input, and the whole run."""

import random
import re

import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, count long, n_entities int"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(2)
    syl = ["ta", "ro", "mi", "len", "dor", "sha", "ek", "un"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randrange(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, prose(25)) for i in range(5)]
    rows = [(i, prose(150)) for i in range(300)]
    rows += [(400 + i, " ".join(w.upper() + "%%%" for w in prose(150).split())) for i in range(100)]
    rows += [(600 + i, rows[i][1]) for i in range(10)]  # exact copies
    rows += [(700 + i, rows[20 + i][1] + " mi") for i in range(10)]  # near copies
    rows += [(800 + i, prose(60) + " " + bench[i % 5][1] + " " + prose(60)) for i in range(10)]
    rows += [(900 + i, prose(80) + f" ana{i}@mail.example.com " + prose(80)) for i in range(10)]
    rows += [rows[5], rows[5], (None, rows[6][1]), (None, prose(90)), (None, None), (1000, ""), (1001, None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), 1, 7) for d, t in rows], DOCS)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < 400), 0) for i in range(500) if i < 300 or i >= 400], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        out = pipeline.keep(stage(spark, docs, folder))
        assert out.schema == docs.schema
        kept[name] = [r.doc_id for r in out.collect()]
        docs = out
    good = set(kept["quality"])
    assert not good & set(range(400, 500)) and len(good & set(range(300))) >= 295
    near = kept["near_duplicates"]
    for i in range(10):
        assert len({i, 600 + i} & set(near)) + (i == 6 and None in near and 0) <= 2
    assert len([d for d in near if d == 5]) + len([d for d in near if d == 605]) == 1
    assert sum(d in near for d in range(10)) + sum(600 + d in near for d in range(10)) <= 10
    assert sum(d in near for d in range(20, 30)) + sum(700 + d in near for d in range(10)) <= 12
    assert all(d in near for d in range(40, 290) if d in good)
    clean = kept["decontamination"]
    assert not set(clean) & set(range(800, 810))
    assert set(near) - set(clean) <= set(range(800, 810))
    assert sorted(map(str, kept["pii"])) == sorted(map(str, clean))
    for r in docs.where("doc_id between 900 and 909").collect():
        assert not re.search(r"ana\d@mail", r.text) and r.n_chars == len(r.text) and "@m" in r.text
    assert docs.where("doc_id = 50").first().text == dict(rows)[50]


def test_near_duplicates_at_four_fifths(spark):
    rng = random.Random(4)

    def edited(words, n):
        out = list(words)
        for k in range(n):
            out[(2 * k + 1) * len(words) // (2 * n)] = f"x{rng.randrange(10**6)}"
        return out

    def alike(a, b):
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        return len(a & b) / len(a | b)

    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        other = edited(words, 4 if i < 20 else 6)
        assert 0.8 <= alike(words, other) < 0.85 if i < 20 else 0.7 < alike(words, other) < 0.8
        rows += [(i, " ".join(words)), (100 + i, " ".join(other))]
    docs = pipeline.keep(spark.createDataFrame([(d, t, "en", "s", len(t), 1, 7) for d, t in rows], DOCS))
    left = [r.doc_id % 100 for r in pipeline.near_duplicate_stage(spark, docs, "").collect()]
    assert [left.count(i) for i in range(40)] == [1] * 20 + [2] * 20


def test_run(spark, corpus):
    folder, _ = corpus
    out = pipeline.run(spark, folder)
    assert out.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    packed = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).collect()
    assert all(r.n == r.m <= 4096 for r in packed)


def test_empty_corpus(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


def test_stages_against_brute_force(spark, corpus):
    """Each stage's rows from its own input, worked out in plain Python."""
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")

    from plumbline.llm import quality

    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    before = docs.collect()
    good = [r for r, s in zip(before, quality.scores(model, [r.text for r in before]), strict=True) if s >= quality.THRESHOLD]
    kept = pipeline.keep(pipeline.quality_stage(spark, docs, folder))
    assert sorted(map(key, kept.collect())) == sorted(map(key, good))

    # One row of each class of texts that share 0.8 of their five-word shingles.
    rows = kept.collect()
    texts = sorted({r.text or "" for r in rows})
    sets = []
    for t in texts:
        words = re.sub("[A-Z]", lambda c: c[0].lower(), t).split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (len(sets[i] & sets[j]) / union if union else 1) >= 0.8:
                root[find(i)] = find(j)
    classes = {}
    for r in rows:
        classes.setdefault(find(texts.index(r.text or "")), []).append(r)
    assert any(len(c) > 1 for c in classes.values())
    left = pipeline.keep(pipeline.near_duplicate_stage(spark, kept, folder))
    want = sorted((min((r.doc_id is None, r.doc_id or 0) for r in c), True) for c in classes.values())
    assert sorted(((r.doc_id is None, r.doc_id or 0), True) for r in left.collect()) == want

    # Rows in which ten consecutive words of an item occur go.
    word = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    plain = lambda t: word.findall(re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = plain(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    hit = lambda t: any(tuple(plain(t)[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(plain(t)) - n + 1))
    clean = pipeline.keep(pipeline.decontamination_stage(spark, left, folder))
    assert sorted(map(key, clean.collect())) == sorted(key(r) for r in left.collect() if not hit(r.text))
    assert clean.count() < left.count()

    # All rows go on, and only those with personal data change.
    out = {key(r)[:2]: r for r in pipeline.pii_stage(spark, clean, folder).collect()}
    for r in clean.collect():
        new = out[key(r)[:2]]
        assert (new.text != r.text) == ("@mail.example.com" in (r.text or "")) and new.n_chars == (r.n_chars if new.text == r.text else len(new.text))
    assert len(out) == clean.count()


def test_rows_of_clashing_names_and_equal_ids(spark):
    """Copies under one id, under several and under none leave one row each; columns named like the stage's own stay."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(1, text(1), "a", 1), (1, text(1), "b", 2), (2, text(1), "c", 3), (None, text(2), "d", 4), (None, text(2), "e", 5), (3, text(3), "f", 6), (3, text(4), "g", 7), (None, None, "h", 8), (4, "", "i", 9), (5, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __text_key string, row int")
    left = pipeline.near_duplicate_stage(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in left.select("doc_id", "text").collect())
    assert got == sorted([("1", text(1)), ("None", text(2)), ("3", text(3)), ("3", text(4)), ("4", "")])


def test_stages_leave_no_large_tables(spark, corpus):
    """What only the stage itself reads (signatures, shingle sets, the index of all words) is gone when it returns."""
    from plumbline.llm import store

    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for stage in (pipeline.near_duplicate_stage, pipeline.decontamination_stage):
        before = set(store._made)
        out = stage(spark, docs, folder)
        left = [spark.read.parquet(path).columns for path in set(store._made) - before]
        assert left and not {"bands", "shingles", "degree", "positions"} & {c for columns in left for c in columns}
        assert out.count() > 0


def test_marked_rows(spark, monkeypatch):
    """Rows with a key are always marked, others seldom; with a full bitmap all may be, and the stage still decides right."""
    from plumbline.llm import marks

    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("k"))
    for n in (0, 1, 900):
        keys = rows.where(F.col("id") < n).select("k")
        got = marks.marked(rows, keys, "k", "hit").groupBy((F.col("id") < n).alias("own"), "hit").count().collect()
        by = {(r.own, r.hit): r["count"] for r in got}
        assert by.get((True, True), 0) == n and (True, False) not in by
        assert by.get((False, True), 0) <= 20_000 / 32
    monkeypatch.setattr(marks, "MOST_BITS", 2)
    assert marks.marked(rows, rows.limit(50).select("k"), "k", "hit").where("hit").count() == 20_000
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    made = [(i, text(i % 40), "en", "s", 1, 1, 0) for i in range(100)] + [(None, text(3), "en", "s", 1, 1, 0)]
    left = pipeline.near_duplicate_stage(spark, spark.createDataFrame(made, DOCS), "").collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(i, text(i)) for i in range(40)]
