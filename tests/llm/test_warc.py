"""WARC archives: exact round trips and the revisit rule against a brute-force version."""

import hashlib
import io
import random

import pytest

import plumbline.llm.warc as m

PAGES = "page_id long, url string, html string, digest string, key int, path string"


def made(seed=1):
    rng = random.Random(seed)
    body = lambda n: "".join(rng.choice(["<p>", "é", "\r\n\r\n", "x", "🙂", "WARC/1.1"]) for _ in range(n))
    shared = [body(900) for _ in range(5)] + ["short"]
    rows = [(i, f"http://h{i % 7}.org/{i}", rng.choice(shared) if i % 2 else body(rng.randrange(400))) for i in range(150)]
    return rows + [(900, None, None), (901, "", ""), (902, "http://a b\r\n/", "y" * 999), (903, "u", "y" * 999), (904, "u", "z" * 1000), (905, "u", "z" * 1000), (906, "u", "long " * 200_000)]


def brute(rows):
    first, out = {}, []
    for d, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 1000 and d is not None:
            first[p] = max(first.get(p, d), d)
    for d, _, html in rows:
        p = (html or "").encode()
        revisit = d is not None and len(p) >= 1000 and first[p] != d
        out.append((d, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", first[p] if revisit else None))
    return sorted(out, key=repr)


def got(spark, rows, **options):
    pages = spark.createDataFrame([(*r, "d", 1, "p") for r in rows], PAGES).repartition(3)
    records = m.read(m.write(pages, **options)).collect()
    return records, sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=repr)


@pytest.mark.parametrize("archive_bytes", [1 << 25, 5000])
def test_brute_force(spark, archive_bytes):
    rows = made()
    records, found = got(spark, rows, archive_bytes=archive_bytes)
    assert found == brute(rows)
    assert len({(r.archive, r.offset) for r in records}) == len(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "u", "a" * 2000)] * 3 + [(2, "u", "b" * 2000), (None, "u", "b" * 2000), (3, "u", "c"), (3, "u", "c")]
    _, found = got(spark, rows)
    assert [r[3:] for r in found if r[0] == 1] == [("response", None), ("revisit", 1), ("revisit", 1)]
    assert [r[3:] for r in found if r[0] != 1] == [("response", None)] * 4


def test_empty_table(spark):
    assert got(spark, [])[1] == []


def test_archive_reads_in_any_chunks():
    records = [m.record(i, "http://x/", (f"<html>{i}" * 50).encode(), "ab" * 20, 1) for i in range(40)]
    writer = m.Writer(m.train(records))
    places = [writer.add(r) for r in records]
    data = b"".join(writer.parts)
    for chunk in (1, 7, 1 << 20):
        assert list(m.read_archive(io.BytesIO(data), chunk)) == [(a, r) for (a, _), r in zip(places, records, strict=True)]
    with pytest.raises(ValueError):
        list(m.read_archive(io.BytesIO(data[:-3])))
    alone = io.BytesIO(writer.parts[0] + writer.parts[5])
    assert next(m.read_archive(alone))[1] == records[4]
