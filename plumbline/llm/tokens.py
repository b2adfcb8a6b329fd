"""Token ids of whole texts with a public tokenizer file, by way of a memory of pieces.

The tokenizers library first splits a text into pieces and then merges inside each piece, so equal pieces always give
equal ids. Texts are split here, by the rule of the file's pattern, for many texts at once in numpy; Arrow numbers the
different pieces, and only pieces that the memory lacks go to the library. That holds for texts whose splitting the two
sides are sure to agree on: characters of blocks that have long been complete, in composed form, without apostrophes
(the patterns treat contractions apart) and without the one letter whose lower-case form has two characters. Any other
text goes to the library whole. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
_SURE = ((0x80, 0x24F), (0x370, 0x3FF), (0x400, 0x45F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5))
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u2028\u2029"
#: Pieces in each of the two generations of the memory, and the longest piece kept.
MEMORY, LONGEST = 350_000, 48
#: Characters of text that are split at once.
TOGETHER = 5 << 20
#: Pieces that make one text of the library.
JOINED = 200


def tokenizer_path(name: str) -> str:
    """Place of a tokenizer file: a path is taken as it is, a bare name is looked up among the public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


_END, _LETTER, _NUMBER, _OTHER, _WHITE, _UNSURE = range(6)


@functools.cache
def _classes() -> tuple[bytes, np.ndarray]:
    """Classes of the ASCII bytes, as a translation table, and of all 16-bit characters; 0 stands between texts."""
    kinds = np.full(1 << 16, _UNSURE, np.uint8)
    for first, last in ((1, 0x1B), (0x20, 0x7F), *_SURE):
        for c in range(first, last + 1):
            group = unicodedata.category(chr(c))[0]
            kinds[c] = _LETTER if group == "L" else _NUMBER if group == "N" else _OTHER
    kinds[[ord(c) for c in _SPACE]] = _WHITE
    kinds[[ord("'"), 0x130]] = _UNSURE
    kinds[0] = _END
    return kinds[:256].tobytes(), kinds


def _kinds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(class of every byte of UTF-8 text, places of bytes that continue a character); all bytes of a character have
    its class."""
    table, kinds = _classes()
    kind = np.frombuffer(bytearray(data.translate(table)), np.uint8)
    raw = np.frombuffer(data, np.uint8)
    high = np.flatnonzero(raw >= 0x80)
    more = high[raw[high] < 0xC0]
    lead = high[raw[high] >= 0xC0]
    if len(lead):
        b = raw[lead].astype(np.int32)
        at = lambda k: raw[np.minimum(lead + k, len(raw) - 1)].astype(np.int32) & 0x3F
        two, three = b < 0xE0, (b >= 0xE0) & (b < 0xF0)
        code = np.where(two, (b & 0x1F) << 6 | at(1), np.where(three, (b & 0x0F) << 12 | at(1) << 6 | at(2), 0xFFFF))
        of = kinds[code]
        kind[lead] = of
        kind[lead + 1] = of
        kind[lead[~two] + 2] = of[~two]
        four = ~two & ~three
        kind[lead[four] + 3] = of[four]
    return kind, more


def _starts_bytes(kind: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Where pieces begin: runs of letters, of numbers and of others, each with one space before it; of a run of white
    space before such a piece, all but the last character, and that one by itself unless it is the space."""
    before, here = kind[:-1], kind[1:]
    start = np.concatenate([[True], before != here])
    at = np.flatnonzero((before == _WHITE) & (here != _WHITE) & (here != _END))
    start[at[raw[at] == 32] + 1] = False
    # The last white character begins a piece, alone or with what follows; it may have several bytes.
    while len(at):
        again = (raw[at] & 0xC0) == 0x80
        start[at[~again]] = True
        at = at[again] - 1
    return start


def _starts_words(kind: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Where pieces begin: runs of letters and of others, single numbers; white space is dropped later."""
    return np.concatenate([[True], (kind[:-1] != kind[1:]) | (kind[1:] == _NUMBER)])


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids. One per Python worker; see :func:`encoder`.

    The memory has two generations. When the young one is full it becomes the old one, and pieces that come up again
    move back, so that memory is bounded and frequent pieces stay.
    """

    def __init__(self, name: str, memory: int = MEMORY, together: int = TOGETHER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.encode_special_tokens = True
        base = os.path.basename(name)
        self.starts = {BYTE_BPE: _starts_bytes, WORD_BPE: _starts_words}.get(base)
        # What keeps joined pieces apart: a line feed is a piece of its own, or white space that is dropped.
        self.between, self.stride = ("\n", 2) if base == BYTE_BPE else (" ", 1)
        self.memory, self.together = memory, together
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _fresh(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, some hundreds joined for one text of the library (whose time a piece grows with the text's
        length); pieces of white space go one by one."""
        out: list[bytes | None] = [None] * len(pieces)
        joined = [i for i, p in enumerate(pieces) if not p.isspace()]
        for a in range(0, len(joined), JOINED):
            group = joined[a : a + JOINED]
            e = self.tokenizer.encode(self.between.join([pieces[i] for i in group]), add_special_tokens=False)
            words = np.array(e.word_ids, np.int64)
            if len(words) and words[-1] == self.stride * (len(group) - 1):
                data = np.array(e.ids, "<u4").tobytes()
                wanted = self.stride * np.arange(len(group))
                at, to = np.searchsorted(words, wanted) * 4, np.searchsorted(words, wanted, "right") * 4
                for i, j, k in zip(group, at.tolist(), to.tolist(), strict=True):
                    out[i] = data[j:k]
        rest = [i for i, d in enumerate(out) if d is None]
        for i, d in zip(rest, self.whole([pieces[i] for i in rest]), strict=True):
            out[i] = d
        return out

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of different pieces, from memory as far as it has them; what isn't text has none."""
        if len(self.known) > self.memory:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        data = list(map(known.get, pieces))
        new = []
        for i in [i for i, d in enumerate(data) if d is None]:
            p = pieces[i]
            d = old.get(p)
            if d is not None:
                data[i] = known[p] = d
            elif p == b"\0":
                data[i] = b""
            else:
                new.append(i)
        texts = [pieces[i].decode("utf-8", "surrogatepass") for i in new]
        if self.stride == 1:
            texts = ["" if t.isspace() else t for t in texts]  # dropped white space
        for i, d in zip(new, self._fresh(texts), strict=True):
            data[i] = d
            if len(pieces[i]) <= LONGEST:
                known[pieces[i]] = d
        return data

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, in order."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and size < self.together:
                size += len(texts[to] or "")
                to += 1
            out += self._some(texts[at:to])
            at = to
        return out

    def __call__(self, text: str | None) -> bytes:
        return self._some([text])[0]

    def _some(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        split = [i for i, t in enumerate(texts) if t and self.starts and "\0" not in t and unicodedata.is_normalized("NFC", t)]
        unsure = set(range(len(texts))) - set(split)
        if split:
            made, doubtful = self._split([texts[i] for i in split])
            for i, ids in zip(split, made, strict=True):
                out[i] = ids
            unsure |= {split[k] for k in doubtful}
        for i in unsure:
            if texts[i]:
                out[i] = self.whole([texts[i]])[0]
        return out

    def _split(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """(ids of every text, places of texts with characters that are not sure, whose ids don't count)."""
        line = ("\0".join(texts) + "\0").encode("utf-8", "surrogatepass")
        kind, more = _kinds(line)
        start = self.starts(kind, np.frombuffer(line, np.uint8))
        start[more] = False
        place = np.flatnonzero(start)
        bounds = np.flatnonzero(kind == _END)  # every text ends with its 0, a piece of its own
        doubtful = np.unique(np.searchsorted(bounds, np.flatnonzero(kind == _UNSURE))).tolist()
        offsets = np.append(place, len(line)).astype(np.int32)
        binary = pa.BinaryArray.from_buffers(pa.binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(line)])
        coded = binary.dictionary_encode()
        last = np.searchsorted(place, bounds)
        del kind, start, place, more
        data = self._ids(coded.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(data), "<u4")
        size = np.fromiter(map(len, data), np.int32, len(data)) // 4
        begin = np.cumsum(size, dtype=np.int32) - size
        which = coded.indices.to_numpy()
        n = size[which]
        to = np.cumsum(n, dtype=np.int32)  # TOGETHER bounds all of these
        raw = pool[np.repeat(begin[which] - (to - n), n) + np.arange(int(to[-1]), dtype=np.int32)].tobytes()
        ends = (to[last].astype(np.int64) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], doubtful


def gathered(batches: Iterator[pa.RecordBatch], together: int = TOGETHER) -> Iterator[tuple[list, list[str | None]]]:
    """(ids, texts) of a two-column stream, as many rows at a time as make ``together`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc)
            texts.append(text)
            size += len(text or "")
            if size >= together:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_encoders: dict[str, Encoder] = {}


def encoder(name: str, memory: int = MEMORY, together: int = TOGETHER) -> Encoder:
    """This process's encoder for a tokenizer file; reused workers keep its pieces."""
    if name not in _encoders:
        _encoders[name] = Encoder(name, memory, together)
    return _encoders[name]
