"""Fast whole-text encoding with a byte-level BPE file of the tokenizers library.

The library's own encoder spends most of its time on words it has seen before.
Here a slice of texts is cut into the pre-tokenizer's pieces with array
operations, the distinct pieces are looked up together in a bounded cache (by
their hashes, and compared byte by byte), and only new pieces go to the library's BPE model. Texts outside the simple case (letters
beyond U+023F, the two Latin-1 spaces, a special token's string) go to the
library's encoder whole, so ids always equal ``Tokenizer.encode``.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from .textops import U64, byte_prefix, ragged, span_hash

# Distinct pieces a process keeps; later ones are looked up anew in each slice.
CACHE_PIECES = 300_000
BATCH = 64

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


def _kind(char: str) -> int:
    if char in " \t\n\x0b\x0c\r":
        return SPACE
    group = unicodedata.category(char)[0]
    return LETTER if group == "L" else NUMBER if group == "N" else OTHER


_KINDS = np.array([_kind(chr(i)) for i in range(0x240)], np.uint8)


def _byte_letters() -> str:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    stand = dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(other)}
    return "".join(chr(stand[b]) for b in range(256))


_STAND = np.array([ord(c) for c in _byte_letters()], np.uint32)


def piece_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """First byte of each piece of the byte-level pre-tokenizer's pattern.

    Holds for texts of code points below U+0240 without U+0085 and U+00A0.
    """
    n = len(data)
    kind = _KINDS[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        code = ((data[lead].astype(np.int32) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
        kind[lead] = kind[lead + 1] = _KINDS[np.minimum(code, 0x23F)]
    start = np.zeros(n + 3, bool)
    start[1:n] = kind[1:] != kind[:-1]
    bounds = offsets[:-1][offsets[:-1] < n]
    start[bounds] = False
    # A run of spaces before something else: its last character stands alone, a blank goes to what follows.
    after = np.flatnonzero(start[:n])
    after = after[kind[after - 1] == SPACE]
    start[after] = data[after - 1] != 32
    start[after - 1] = True
    start[bounds] = True
    # 's 't 'm 'd 're 've 'll at the start of a piece
    quote = np.flatnonzero((data == 39) & start[:n])
    if len(quote):
        ends = offsets[np.searchsorted(offsets, quote, "right")]
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        a, b = pad[quote + 1], pad[quote + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & (quote + 2 <= ends)
        two = (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)) & (quote + 3 <= ends)
        kinds = np.concatenate([kind, np.zeros(4, np.uint8)])
        for hit, size in ((quote[one], 2), (quote[two], 3)):
            start[hit + 1] = False
            rest = hit + size
            inside = rest < offsets[np.searchsorted(offsets, hit, "right")]
            start[rest[inside & (kinds[rest] == LETTER)]] = True
    return np.flatnonzero(start[:n])


def distinct(coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
    """``(raw, cuts)``: the bytes of the dictionary of large binaries, and where each entry's begin."""
    _, cuts, raw = coded.dictionary.buffers()
    cuts = np.frombuffer(cuts, np.int64)[:len(coded.dictionary) + 1]
    return np.frombuffer(raw, np.uint8)[:cuts[-1]], cuts


class Encoder:
    """Ids of whole texts; one per process and vocabulary file (``encoder``)."""

    def __init__(self, path: str, keep: int = CACHE_PIECES):
        self.keep = keep
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.pieces = Tokenizer(self.whole.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self._clear()

    def _clear(self) -> None:
        # Piece k has the bytes raw[cuts[k]:cuts[k + 1]] and the ids flat[starts[k]:starts[k + 1]].
        self.count = 0
        self.raw, self.cuts = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.int64)
        self.flat, self.starts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        # Hashes of the pieces in ascending order, and whose they are.
        self.hashes, self.owner = np.zeros(0, U64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Drop the pieces beyond those that are kept."""
        kept = self.owner < self.keep
        self.hashes, self.owner = self.hashes[kept], self.owner[kept]
        self.count = min(self.count, self.keep)

    def _numbers(self, raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The number of each piece ``raw[cuts[i]:cuts[i + 1]]``; unknown ones are learned."""
        if self.count > self.keep:  # the slice before brought pieces that are not kept
            self._forget()
        hashes = span_hash(byte_prefix(raw), cuts[:-1], cuts[1:])
        order = np.argsort(hashes)
        cuts, hashes = np.stack([cuts[:-1][order], cuts[1:][order]]), hashes[order]
        at = self._find(raw, cuts, hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = np.arange(self.count, self.count + len(new))
            size = (cuts[1] - cuts[0])[new]
            self._learn(raw[ragged(cuts[0][new], size)], size, hashes[new])
        out = np.empty(len(order), np.int64)
        out[order] = at
        return out

    def _find(self, raw: np.ndarray, cuts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece (``hashes`` ascend), -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        if not self.count:
            return out
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        owner, size = self.owner[place], cuts[1] - cuts[0]
        hit = np.flatnonzero((self.hashes[place] == hashes) & (self.cuts[owner + 1] - self.cuts[owner] == size))
        out[hit] = owner[hit]
        differ = np.flatnonzero(raw[ragged(cuts[0][hit], size[hit])] != self.raw[ragged(self.cuts[owner[hit]], size[hit])])
        if len(differ):
            out[hit[np.searchsorted(np.cumsum(size[hit]), differ, "right")]] = -1
        return out

    def _learn(self, raw: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> None:
        """Add the pieces of ``sizes`` bytes that ``raw`` strings together; their hashes ascend."""
        n, ends = len(sizes), np.cumsum(sizes)
        text = np.insert(_STAND[raw], ends[:-1], 32).tobytes().decode("utf-32-le")
        first = (ends - sizes + np.arange(n))[::BATCH].tolist()
        counts, ids = [], []
        for e in self.pieces.encode_batch([text[a:b - 1] for a, b in zip(first, [*first[1:], len(text) + 1])], add_special_tokens=False):
            ids.extend(e.ids)
            counts.append(np.bincount(e.word_ids, minlength=min(BATCH, n - BATCH * len(counts))))
        at = self.count
        for bounds, values, end, new in (("cuts", "raw", ends, raw), ("starts", "flat", np.cumsum(np.concatenate(counts)), np.array(ids, np.uint32))):
            places, held = self._room(bounds, at + n + 1), int(getattr(self, bounds)[at])
            places[at + 1:at + 1 + n] = held + end
            self._room(values, held + len(new))[held:held + len(new)] = new
        self.count += n
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.owner = np.insert(self.hashes, place, hashes), np.insert(self.owner, place, np.arange(at, at + n))

    def _room(self, name: str, size: int) -> np.ndarray:
        """The array ``name``, grown to ``size`` entries or more."""
        held = getattr(self, name)
        if len(held) < size:
            setattr(self, name, np.concatenate([held, np.zeros(max(len(held), size - len(held)), held.dtype)]))
        return getattr(self, name)

    def _simple(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        c2 = np.flatnonzero(data == 0xC2)
        simple = np.ones(len(offsets) - 1, bool)
        for odd in (np.flatnonzero(data > 0xC8), c2[(data[c2 + 1] == 0x85) | (data[c2 + 1] == 0xA0)]):
            simple &= np.diff(np.searchsorted(odd, offsets)) == 0
        raw = data.tobytes()
        for mark in self.special:
            if mark in raw:
                for i in np.flatnonzero(simple):
                    simple[i] = mark not in raw[offsets[i]:offsets[i + 1]]
        return simple

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: all ids, and where each text's begin (one more than texts)."""
        n = len(offsets) - 1
        simple = self._simple(offsets, data)
        if simple.all():
            return self._encode(offsets, data)
        out: list[np.ndarray] = [None] * n
        for i in np.flatnonzero(~simple):
            text = data[offsets[i]:offsets[i + 1]].tobytes().decode()
            out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        good = np.flatnonzero(simple)
        size = np.diff(offsets)[good]
        ids, bounds = self._encode(np.concatenate([[0], np.cumsum(size)]), data[ragged(offsets[good], size)])
        for i, a, b in zip(good, bounds, bounds[1:]):
            out[i] = ids[a:b]
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])

    def _encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = piece_starts(offsets, data)
        ends = np.concatenate([starts, [len(data)]])
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data.tobytes())])
        coded = pieces.dictionary_encode()
        index = self._numbers(*distinct(coded))[coded.indices.to_numpy()]
        first, count = self.starts[index], self.starts[index + 1] - self.starts[index]
        ids = self.flat[ragged(first, count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(starts, offsets)]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, keep: int = CACHE_PIECES) -> Encoder:
    """The process's encoder of a vocabulary file that keeps up to ``keep`` pieces."""
    if (path, keep) not in _encoders:
        _encoders[path, keep] = Encoder(path, keep)
    return _encoders[path, keep]
