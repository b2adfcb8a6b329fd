"""Best-fit packing of documents into sequences, by bin completion over the histogram of lengths.

Only the histogram (at most ``capacity`` numbers, whatever the corpus) is packed on the driver. The first incumbent is
the best-fit solution. Where that misses the lower bound, short searches over a few likely fillings, at most ``nodes``
in all, look for a better one, and small parts of the incumbent are completed anew, the largest length of a part first
and around it the filling of least waste, where that gathers the waste in fewer sequences, until one is empty
(``PARTS`` times at most). What they leave open goes to the complete search: around the largest remaining length it
enumerates all undominated fillings of the rest of a sequence, of any number of pieces, by least waste. A filling is
dominated if some of its pieces, or none, can give way to one longer or equal piece that is left over. Each filling is
used as often as the histogram allows, then less often; sequences of one largest length come in a fixed order. A branch
ends when its waste exceeds what would still beat the incumbent, or when the remaining lengths' own bound does. The
search ends at the lower bound, with a proof that nothing is better, or after ``steps`` steps, with the incumbent; a
step is a length tried in a filling or a filling used.

Pieces then find their places by rank: the r-th piece of a length takes the r-th slot of that length. Ranks come from
salted groups (length, salt) and the salts' offsets, so one very common length isn't one task.
"""

from __future__ import annotations

import pickle
import random
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.store import keep, map_arrow
from plumbline.llm.tokens import WORD_BPE, encoder, gathered

CAPACITY = 4096
END = 1
NODES = 40_000
#: Parts of the incumbent that are completed anew, and sequences that these are drawn from.
PARTS, DRAWN = 40_000, 20_000
#: Steps of the complete search, the only thing besides waste and lower bounds that ends it.
STEPS = 200_000
#: Orders in which branches are tried, one search for each; see _fillings.
THRIFT = (0.0, 1.0, 4.0, 16.0)
#: Shares of each length that are ranked by themselves, at least, and rows of a share on average, at most.
SALTS, SHARE = 256, 1_000_000
#: Pieces that the tokenizer's memory keeps in each generation, and characters split at once: fewer than for token
#: files, since the packing stage follows others in the same Python workers.
MEMORY, TOGETHER = 120_000, 5 << 19

Solution = list[tuple[tuple[int, ...], int]]  # (lengths in one sequence, number of such sequences)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by items that can't share (Martello and Toth)."""
    sizes = np.arange(capacity + 1)
    n = np.concatenate([[0], np.cumsum(counts)])  # n[k]: items shorter than k
    weight = np.concatenate([[0], np.cumsum(counts * sizes)])
    best = -(-int(weight[-1]) // capacity)
    half = capacity // 2
    above = n[-1] - n[half + 1]
    k = np.arange(1, half + 1)
    large = n[-1] - n[capacity - k + 1]  # longer than capacity - k: alone among items of at least k
    middle = above - large
    room = middle * capacity - (weight[capacity - k + 1] - weight[half + 1])
    small = weight[half + 1] - weight[k]
    return max(best, int((large + middle + np.maximum(0, -(-(small - room) // capacity))).max(initial=0)))


def _fit(below: np.ndarray, counts: np.ndarray, room: int) -> tuple[int, ...]:
    """Greedy best fit: the longest that fits, again and again."""
    out, used = [], {}
    while room > 0:
        x = int(below[room])
        while x and used.get(x, 0) >= counts[x]:
            x = int(below[x - 1])
        if not x:
            break
        k = min(room // x, int(counts[x]) - used.get(x, 0))
        used[x] = used.get(x, 0) + k
        out += [x] * k
        room -= k * x
    return tuple(out)


def _fillings(counts: np.ndarray, room: int, thrift: float, most: int = 4) -> list[tuple[int, ...]]:
    """A few likely fillings of ``room``, least waste first; each further item counts as ``thrift`` wasted tokens, since
    small items that fill a gap now are missing later. For quick searches; :func:`_undominated` gives all."""
    if room <= 0:
        return [()]
    if counts[room]:
        return [(room,)]  # dominates all others
    there = np.flatnonzero(counts[: room + 1])
    if not len(there):
        return [()]
    below = np.zeros(room + 1, np.int64)
    below[there] = there
    np.maximum.accumulate(below, out=below)
    out: list[tuple[int, ...]] = []
    high = there[there >= (room + 1) // 2][::-1]
    rest = room - high
    exact = high[(counts[rest] > 0) & ((rest != high) | (counts[high] > 1))]
    out += [(int(a), room - int(a)) for a in exact[:most]]
    if len(out) < most:
        for a in there[::-1][:12].tolist():
            r = room - a
            b = there[(there <= min(a, r)) & (there >= (r + 1) // 2)][::-1]
            c = r - b
            ok = (c > 0) & (counts[c] > 0) & (counts[b] > (b == a).astype(np.int64) + (b == c)) & (counts[a] > (c == a).astype(np.int64) + (b == a))
            for x in b[ok][:1].tolist():
                out.append((a, x, r - x))
            if len(out) >= most:
                break
    greedy = [_fit(below, counts, room)]
    for a in there[::-1][1:3].tolist():
        counts[a] -= 1
        greedy.append((a, *_fit(below, counts, room - a)))
        counts[a] += 1
    out += greedy
    out = sorted({tuple(sorted(f, reverse=True)) for f in out}, key=lambda f: (room - sum(f) + thrift * len(f), len(f), [-x for x in f]))
    return out[:most]


def _uses(pattern: tuple[int, ...], counts: np.ndarray) -> int:
    return min(int(counts[x]) // pattern.count(x) for x in set(pattern))


def best_fit(counts: np.ndarray, capacity: int) -> Solution:
    """The best-fit solution: the largest length, then whatever fits best, in bulk."""
    counts, out = counts.copy(), []
    while True:
        left = np.flatnonzero(counts)
        if not len(left):
            return out
        top = int(left[-1])
        counts[top] -= 1
        below = np.zeros(capacity + 1, np.int64)
        below[left] = left
        np.maximum.accumulate(below, out=below)
        pattern = (top, *_fit(below, counts, capacity - top))
        counts[top] += 1
        k = _uses(pattern, counts)
        for x in pattern:
            counts[x] -= k
        out.append((pattern, k))


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS) -> Solution:
    """Pack ``counts[k]`` items of each length k (0 is not used) into as few sequences as the search finds."""
    counts = np.asarray(counts, np.int64).copy()
    if len(counts) != capacity + 1 or counts[0]:
        raise ValueError("one count for each length from 0 to the capacity, and none at 0")
    best, least = best_fit(counts, capacity), lower_bound(counts, capacity)
    for thrift in THRIFT:
        if sum(k for _, k in best) <= least:
            break
        best = _search(counts, capacity, best, least, thrift, nodes // len(THRIFT))
    if sum(k for _, k in best) > least:
        best = _complete_parts(best, capacity, least)
    if sum(k for _, k in best) > least:
        best = _complete_search(counts, capacity, best, least, steps)
    return best


def _search(counts: np.ndarray, capacity: int, best: Solution, least: int, thrift: float, nodes: int) -> Solution:
    """Quick branch and bound over likely fillings; ``best`` is the incumbent, ``least`` a bound that ends it."""
    total = int((counts * np.arange(capacity + 1)).sum())
    used = sum(k for _, k in best)
    taken: Solution = []
    waste = bins = 0

    def branch() -> list[tuple[int, ...]]:
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = [(top, *f) for f in _fillings(counts, capacity - top, thrift)]
        counts[top] += 1
        return found[::-1]

    def put(pattern: tuple[int, ...], k: int) -> None:
        nonlocal waste, bins
        for x in pattern:
            counts[x] -= k
        waste += k * (capacity - sum(pattern))
        bins += k

    stack = [branch()]  # the alternatives left at each level of the current branch
    while stack and nodes > 0 and used > least:
        if not stack[-1]:
            stack.pop()
            if taken:
                pattern, k = taken.pop()
                put(pattern, -k)
            continue
        pattern = stack[-1].pop()
        k = _uses(pattern, counts)
        nodes -= 1
        if waste + k * (capacity - sum(pattern)) > (used - 1) * capacity - total:  # could only tie the incumbent
            continue
        put(pattern, k)
        if counts.any() and not (len(stack) % 16 == 0 and bins + lower_bound(counts, capacity) >= used):
            taken.append((pattern, k))
            stack.append(branch())
            continue
        if not counts.any() and bins < used:
            best, used = [*taken, (pattern, k)], bins
        put(pattern, -k)
    for pattern, k in reversed(taken):
        put(pattern, -k)
    return best


def _least_waste(lengths: list[int], room: int) -> list[int]:
    """Places of lengths that add up to the most that ``room`` holds."""
    mask, reach = (1 << (room + 1)) - 1, [1]
    for x in lengths:
        reach.append((reach[-1] | reach[-1] << x) & mask)
    total, out = reach[-1].bit_length() - 1, []
    for i in range(len(lengths) - 1, -1, -1):
        if not reach[i] >> total & 1:
            out.append(i)
            total -= lengths[i]
    return out


def _complete_parts(best: Solution, capacity: int, least: int) -> Solution:
    """The incumbent with three to five sequences at a time completed anew, some with waste among them. What comes out
    is taken if it has fewer sequences, or if its waste is no less gathered than before (by the squares of the sums)."""
    draw = random.Random(capacity)
    by_waste = sorted(best, key=lambda p: sum(p[0]))
    bins: list[list[int]] = []
    rest: Solution = []
    for pattern, k in by_waste:
        here = min(k, DRAWN - len(bins))
        bins += [list(pattern) for _ in range(here)]
        if k > here:
            rest.append((pattern, k - here))
    least -= sum(k for _, k in rest)
    sums = [sum(b) for b in bins]
    for _ in range(PARTS):
        wasteful = [i for i, s in enumerate(sums) if s < capacity]
        if len(bins) <= least or len(wasteful) < 2:
            break
        part = dict.fromkeys(draw.sample(wasteful, min(len(wasteful), draw.randint(1, 2))))
        size = min(len(bins), draw.randint(3, 5))
        while len(part) < size:
            part[draw.randrange(len(bins))] = None
        places = list(part)
        lengths = [x for i in places for x in bins[i]]
        draw.shuffle(lengths)
        made: list[list[int]] = []
        while lengths:
            top = lengths.pop(max(range(len(lengths)), key=lengths.__getitem__))
            filling = _least_waste(lengths, capacity - top)
            made.append([top, *(lengths[i] for i in filling)])
            for i in filling:  # from the last place to the first
                lengths.pop(i)
        new = [sum(b) for b in made]
        if len(made) > len(places) or (len(made) == len(places) and sum(s * s for s in new) < sum(sums[i] ** 2 for i in places)):
            continue
        for i, b, s in zip(places, made, new, strict=False):
            bins[i], sums[i] = b, s
        for i in sorted(places[len(made) :], reverse=True):
            bins[i], sums[i] = bins[-1], sums[-1]
            bins.pop()
            sums.pop()
    patterns = Counter(tuple(sorted(b, reverse=True)) for b in bins)
    return [*rest, *patterns.items()]


class _Steps:
    """What is left of the complete search's budget."""

    def __init__(self, left: int):
        self.left = left

    def take(self) -> None:
        self.left -= 1
        if self.left < 0:
            raise _Spent


class _Spent(Exception):
    pass


def _reach(lengths: list[int], have: list[int], room: int) -> list[int]:
    """Bit s of the i-th number: lengths from the i-th on can add up to s, at most ``room``."""
    mask = (1 << (room + 1)) - 1
    out = [1]
    for x, n in zip(reversed(lengths), reversed(have), strict=True):
        bits, n, share = out[-1], min(n, room // x), 1
        while n:
            share = min(share, n)
            bits |= bits << share * x & mask
            n -= share
            share *= 2
        out.append(bits)
    return out[::-1]


def _spread(bits: int, by: int) -> int:
    """Every bit repeated at the next ``by`` places."""
    done = 0
    while done < by:
        more = min(done + 1, by - done)
        bits |= bits << more
        done += more
    return bits


def _of_waste(lengths: list[int], have: list[int], reach: list[int], room: int, waste: int, steps: _Steps) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room`` that leave exactly ``waste`` (``reach`` has that sum), longest pieces first. A longer piece that may
    take some pieces' place comes before them, so a dominated beginning is dropped with all that could follow it."""
    n = len(lengths)

    def go(i: int, rest: int, sums: int, spare: int) -> Iterator[tuple[int, ...]]:
        if not rest:
            if not _spread(1, waste) & spare & ~1:  # nothing left over would still fit
                yield ()
            return
        while i < n and reach[i] >> rest & 1:
            x = lengths[i]
            for q in range(min(have[i], rest // x), 0, -1):
                if not reach[i + 1] >> (rest - q * x) & 1:
                    continue
                steps.take()
                left = spare & ~(1 << x) if q == have[i] else spare
                new, t = 0, sums
                for _ in range(q):
                    t <<= x
                    new |= t
                if _spread(new & ~(1 << x), waste) & left or _spread(1 << x, waste) & ~(1 << x) & left:
                    continue
                for tail in go(i + 1, rest - q * x, sums | new, left):
                    yield (x,) * q + tail
            i += 1

    yield from go(0, room - waste, 1, sum(1 << x for x in lengths))


def _undominated(counts: np.ndarray, top: int, capacity: int, slack, after, steps: _Steps) -> Iterator[tuple[int, ...]]:
    """All undominated patterns around ``top``, least waste first, as long as the waste is within ``slack()``; only those
    whose :func:`_rank` is above ``after``. To be resumed only while ``counts`` is what it was at first."""
    room = capacity - top

    def table() -> tuple[list[int], list[int], list[int]]:
        counts[top] -= 1
        there = np.flatnonzero(counts[: room + 1])[::-1]
        lengths, have = there.tolist(), counts[there].tolist()
        counts[top] += 1
        return lengths, have, _reach(lengths, have, room)

    # Deep branches hold many of these, most for their first pattern only: until it fails, no table is kept.
    first = None
    for again in (False, True):
        lengths, have, reach = table()
        alone = bool(lengths) and lengths[0] == room  # dominates all others
        sums = reach[0] & (1 << (room + 1 - (after[0] if after else 0))) - 1
        while sums:
            total = sums.bit_length() - 1  # the greatest sum left
            sums ^= 1 << total
            waste = room - total
            if waste > slack():
                break
            for filling in _of_waste(lengths, have, reach, room, waste, steps):
                pattern = (top, *filling)
                if pattern == first or (after is not None and _rank(pattern, capacity) <= after):
                    continue
                if not again:
                    first = pattern
                    break
                yield pattern
                if waste > slack():
                    return
            if alone or (first is not None and not again):
                break
        if again or first is None:
            return
        del lengths, have, reach
        yield first


def _rank(pattern: tuple[int, ...], capacity: int) -> tuple[int, int, tuple[int, ...]]:
    """Order of sequences with one largest length. A pattern is above all that dominate it, so that of the solutions
    of one size the least in this order has no dominated pattern, whatever is left over for later sequences."""
    return capacity - sum(pattern), len(pattern), pattern


def _complete_search(counts: np.ndarray, capacity: int, best: Solution, least: int, steps: int) -> Solution:
    """Branch and bound over all undominated patterns and numbers of uses; ``best`` is the incumbent."""
    counts = counts.copy()
    total = int((counts * np.arange(capacity + 1)).sum())
    used = sum(k for _, k in best)
    budget = _Steps(steps)
    waste = bins = 0

    def slack() -> int:  # more waste could only tie the incumbent
        return (used - 1) * capacity - total - waste

    def level(before: tuple[int, ...] | None) -> list:
        top = int(np.flatnonzero(counts)[-1])
        after = _rank(before, capacity) if before is not None and before[0] == top else None
        return [_undominated(counts, top, capacity, slack, after, budget), (), 0]

    def put(pattern: tuple[int, ...], k: int) -> None:
        nonlocal waste, bins
        for x in pattern:
            counts[x] -= k
        waste += k * (capacity - sum(pattern))
        bins += k

    if not counts.any():
        return best
    stack = [level(None)]  # (patterns to come, pattern in use, times used) at each level of the current branch
    try:
        while stack and used > least:
            now = stack[-1]
            if now[2]:
                put(now[1], -now[2])
                now[2] -= 1
            if not now[2]:
                now[1] = next(now[0], ())
                if not now[1]:
                    stack.pop()
                    continue
                now[2] = _uses(now[1], counts)
            loss = capacity - sum(now[1])
            if loss:
                now[2] = min(now[2], slack() // loss)
                if now[2] <= 0:
                    now[2] = 0
                    continue
            budget.take()
            put(now[1], now[2])
            if not counts.any():
                if bins < used:
                    best, used = [(p, k) for _, p, k in stack], bins
            elif bins + lower_bound(counts, capacity) < used:
                stack.append(level(now[1]))
    except _Spent:
        pass
    return best


def _slots(solution: Solution) -> tuple[np.ndarray, ...]:
    """Run-length table of slots, sorted by (length, first rank): length, rank, first sequence, offset."""
    rows, rank, sequence = [], {}, 0
    for pattern, k in solution:
        at = 0
        for x in pattern:
            rows.append((x, rank.get(x, 0), sequence, at))
            rank[x] = rank.get(x, 0) + k
            at += x
        sequence += k
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def _place_batches(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, sequence, offset = pickle.loads(sent.value)
        keys = (length << 44) + rank
        for batch in batches:
            n, r = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (n << 44) + r, "right") - 1
            keepers = [c for c in batch.schema.names if c != "rank"]
            columns = [batch.column(c) for c in keepers] + [pa.array(sequence[at] + r - rank[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*keepers, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Adds ``sequence_id long, offset long`` to a *written* table with a ``length long`` column from 1 to capacity.

    ``order`` names columns that tell rows of one length apart; rows equal in all of them are interchangeable. The
    table is read twice (and counted from its footers). An empty table stays empty.
    """
    salts = max(SALTS, -(-pieces.count() // SHARE))  # so that no share of one length is longer, whatever the corpus
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in groups.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    slots = _slots(pack_histogram(counts, capacity, nodes))
    sent = pieces.sparkSession.sparkContext.broadcast(pickle.dumps(slots))  # bounded by the capacity, not the corpus
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1
    ranked = salted.join(bases, ["length", "salt"]).withColumn("rank", (within + F.col("base")).cast("long")).select(*pieces.columns, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return map_arrow(ranked, _place_batches(sent), f"{schema}, sequence_id long, offset long")


def _piece_batches(name: str, end: int, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, width = encoder(name, MEMORY, TOGETHER), np.array([end], "<u4").tobytes(), 4 * capacity
        for docs, texts in gathered(batches, TOGETHER):
            rows = []
            for doc, ids in zip(docs, encode.many(texts), strict=True):
                data = ids + last
                for p, at in enumerate(range(0, len(data), width)):
                    part = data[at : at + width]
                    rows.append((doc, p, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = WORD_BPE, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document's ids and its end id, cut only where longer than
    the capacity. Null and empty texts are a piece of the end id alone; a null id stays null. Ids are cast to long (one that isn't a number is an
    error). Written and re-read."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return keep(map_arrow(narrow, _piece_batches(tokenizer, end, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with their sequence and offset. Other columns of ``docs`` are not read."""
    found = pieces(docs, **options)
    return pack(found, ["doc_id", "piece", "ids_crc32"], options.get("capacity", CAPACITY))
