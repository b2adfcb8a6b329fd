"""Token files and packing: exact ids, exact round trips, small optima, edge cases."""

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing, tokenfile, tokens

DOCS = "doc_id long, text string, length long, piece string"


def direct(name):
    t = Tokenizer.from_file(tokens.tokenizer_path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def made(seed=4):
    rng = random.Random(seed)
    pool = ["the", "The", "it's", "IT'S", "naïve", "é", "İstanbul!", "日本語", "🙂🙂", "\n\n", "  ", "\t", "42", "x" * 60, "<|endoftext|>", "$$$", "ß", "ΣΑΣ", " ", "don't've"]
    docs = [(i, "".join(rng.choice(pool) + rng.choice([" ", "", "\n"]) for _ in range(rng.randrange(80)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "word " * 9000), (103, "a"), (None, "lost id"), docs[3], docs[3], (104, "# 2 #")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_encoder_is_the_library(name):
    encode, want = tokens.Encoder(name), direct(name)
    for _, text in made():
        assert np.frombuffer(encode(text), "<u4").tolist() == want(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoder_on_any_text(text):
    """Joined pieces, too: the memory is emptied first."""
    text = text.encode("utf-8", "ignore").decode()
    for name in (tokens.BYTE_BPE, tokens.WORD_BPE):
        tokens.encoder(name).known.clear()
        assert np.frombuffer(tokens.encoder(name)(text), "<u4").tolist() == direct_cached(name)(text)


_direct = {}


def direct_cached(name):
    if name not in _direct:
        _direct[name] = direct(name)
    return _direct[name]


def test_encoder_memory_is_bounded():
    encode, want = tokens.Encoder(tokens.BYTE_BPE, 10), direct(tokens.BYTE_BPE)
    for _, text in made(9):
        assert np.frombuffer(encode(text), "<u4").tolist() == want(text)
    texts = [t for _, t in made(10)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode.many(texts)] == [want(t) for t in texts]
    assert all(len(p) <= tokens.LONGEST for p in [*encode.known, *encode.old])


@pytest.mark.parametrize("shard_tokens", [1 << 20, 150])
def test_token_files(spark, shard_tokens):
    docs = made()
    want_ids = direct(tokens.BYTE_BPE)
    table = spark.createDataFrame([(*r, 1, "p") for r in docs], DOCS).repartition(3)
    manifest = tokenfile.write(table, shard_tokens=shard_tokens)
    got = tokenfile.read(manifest).collect()
    assert len(got) == len(docs)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    ids = {d: want_ids(t) + [2] for d, t in docs}
    for r in got:
        assert (r.n_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes()))


def test_token_files_of_an_empty_table(spark):
    assert tokenfile.read(tokenfile.write(spark.createDataFrame([], DOCS))).collect() == []


@pytest.mark.parametrize("kind", ["random", "runs", "period", "ends", "tiny"])
def test_repair_round_trip_and_random_access(kind):
    rng = np.random.default_rng(7)
    if kind == "random":
        docs = [rng.integers(0, 12, rng.integers(1, 400)) for _ in range(80)]
    elif kind == "runs":
        docs = [np.full(rng.integers(1, 900), 5) for _ in range(20)]
    elif kind == "period":
        docs = [np.tile([1, 2, 3, 1, 2], 300) for _ in range(10)]
    elif kind == "ends":
        docs = [np.array([2])] * 500 + [np.array([2, 2, 2, 2])] * 200
    else:
        docs = [np.array([9])]
    docs = [d.astype("<u4") for d in docs]
    ends = np.cumsum([len(d) for d in docs])
    content = tokenfile.pack_shard(list(range(len(docs))), np.concatenate(docs), ends, 50)
    shard = tokenfile.Shard(content)
    assert shard.all().tolist() == np.concatenate(docs).tolist()
    for i, d in enumerate(docs):
        assert shard.document(i).tolist() == d.tolist()
    if kind in ("runs", "period"):
        assert len(shard.symbols) < sum(map(len, docs)) / 4
    assert all(g == len(shard._decode(np.array([50 + i], "<u2"))) for i, g in enumerate(shard.grown.tolist()))


def best_possible(items, capacity):
    for n in itertools.count(1):
        bins = [0] * n

        def place(i):
            if i == len(items):
                return True
            seen = set()
            for b in range(n):
                if bins[b] + items[i] <= capacity and bins[b] not in seen:
                    seen.add(bins[b])
                    bins[b] += items[i]
                    if place(i + 1):
                        return True
                    bins[b] -= items[i]
            return False

        if place(0):
            return n


def test_small_packings_are_optimal():
    rng, better = random.Random(3), 0
    for _ in range(300):
        items = sorted((rng.randrange(*rng.choice([(1, 31), (4, 15)])) for _ in range(rng.randrange(1, 14))), reverse=True)
        counts = np.bincount(items, minlength=31)
        found = packing.pack_histogram(counts, 30)
        back = np.zeros(31, int)
        for pattern, k in found:
            assert sum(pattern) <= 30
            for x in pattern:
                back[x] += k
        assert (back == counts).all()
        best = best_possible(items, 30)
        assert packing.lower_bound(counts, 30) <= best == sum(k for _, k in found)
        better += best < sum(k for _, k in packing.best_fit(counts, 30))
    assert better  # there are cases that best fit alone gets wrong


def test_fillings_of_many_pieces():
    counts = np.bincount([3996, 3961, 47, 45, 43, 41, 29, 17, 13], minlength=4097)
    assert sum(k for _, k in packing.best_fit(counts, 4096)) == 3
    found = packing.pack_histogram(counts)
    assert sorted(found) == [((3961, 47, 45, 43), 1), ((3996, 41, 29, 17, 13), 1)]


def test_complete_search_alone_is_optimal():
    rng = random.Random(8)
    for _ in range(300):
        lengths = [rng.randrange(*rng.choice([(1, 31), (3, 12)])) for _ in range(rng.randrange(1, 6))]
        items = sorted((rng.choice(lengths) for _ in range(rng.randrange(1, 15))), reverse=True)
        counts = np.bincount(items, minlength=31)
        alone = [((x,), 1) for x in items]  # the worst incumbent
        found = packing._complete_search(counts, 30, alone, packing.lower_bound(counts, 30), 1_000_000)
        assert sorted(x for p, k in found for x in p * k) == sorted(items) and all(sum(p) <= 30 for p, _ in found)
        assert sum(k for _, k in found) == best_possible(items, 30)


def test_packed_documents(spark):
    docs = made() + [(200 + i, "same text here") for i in range(500)]
    table = spark.createDataFrame([(*r, 1, "p") for r in docs], DOCS).repartition(5)
    got = packing.pack_documents(table).collect()
    want = direct(tokens.WORD_BPE)
    ids = {d: want(t) + [1] for d, t in docs}
    pieces = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) and (r.start, r.length) == (r.piece * 4096, min(4096, len(ids[r.doc_id]) - r.start))
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(got) == sum(-(-len(ids[d]) // 4096) for d, _ in docs)
    for places in pieces.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(pieces) <= -(-total // 4096) + 1
    assert packing.pack_documents(table.limit(0)).collect() == []


def test_repair_goes_on_until_no_pair_is_frequent():
    """A passage of 600 tokens in many documents ends as a few symbols; no pair is left that occurs often enough."""
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 40, 600)
    docs = [np.concatenate([rng.integers(0, 40, rng.integers(0, 30)), passage, rng.integers(0, 40, rng.integers(1, 30))]).astype("<u4") for _ in range(100)]
    ends = np.cumsum([len(d) for d in docs])
    symbols, firsts, rules = tokenfile.compress(np.concatenate(docs), ends, 50)
    assert max(tokenfile.Shard(tokenfile.pack_shard(list(range(100)), np.concatenate(docs), ends, 50)).grown) > 100
    assert len(symbols) < 4000
    counts = {}
    for a, b in zip(firsts, firsts[1:], strict=False):
        i, row = 0, symbols[a:b].tolist()
        while i + 1 < len(row):
            pair = row[i], row[i + 1]
            counts[pair] = counts.get(pair, 0) + 1
            i += 2 if i + 2 < len(row) and row[i + 2] == row[i] == row[i + 1] else 1
    assert max(counts.values()) < 2 * tokenfile.FREQUENT


def test_shards_keep_missing_and_least_ids():
    ids, ends = np.arange(6, dtype="<u4"), np.array([1, 3, 6])
    shard = tokenfile.Shard(tokenfile.pack_shard([None, -(2**63), 5], ids, ends, 50))
    assert shard.nulls == 1 and shard.doc_ids.tolist()[1:] == [-(2**63), 5]
    assert [shard.document(i).tolist() for i in range(3)] == [[0], [1, 2], [3, 4, 5]]


def test_the_search_beats_best_fit_at_full_capacity():
    """Perfect fives: best fit needs a sequence more, the search finds the perfect packing."""
    import random

    from plumbline.llm import packing

    draw = random.Random(1)
    counts = np.zeros(4097, np.int64)
    for _ in range(36):
        while True:
            cuts = [0, *sorted(draw.sample(range(1, 4096), 4)), 4096]
            parts = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
            if min(parts) > 273:
                break
        for x in parts:
            counts[x] += 1
    assert sum(k for _, k in packing.best_fit(counts, 4096)) == 37
    found = packing.pack_histogram(counts, nodes=400, steps=400)
    assert sum(k for _, k in found) == packing.lower_bound(counts, 4096) == 36
    back = np.zeros_like(counts)
    for pattern, k in found:
        assert sum(pattern) <= 4096
        np.add.at(back, list(pattern), k)
    assert (back == counts).all()


def test_spans_and_documents_from_an_open_file():
    import io

    rng = np.random.default_rng(2)
    docs = [np.tile(rng.integers(0, 9, rng.integers(1, 30)), rng.integers(1, 40)).astype("<u4") for _ in range(60)]
    plain, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    content = tokenfile.pack_shard(list(range(60)), plain, ends, 50)
    shard = tokenfile.Shard(content)
    for _ in range(200):
        a, b = sorted(rng.integers(-3, len(plain) + 4, 2).tolist())
        assert shard.span(a, b).tolist() == plain[max(a, 0) : max(b, 0)].tolist()
    for i in (0, 17, 59):
        assert tokenfile.read_document(io.BytesIO(content), i).tolist() == docs[i].tolist()
    with pytest.raises(IndexError):
        tokenfile.read_document(io.BytesIO(content), 60)
