"""Public tokenizers over flat text: split at safe bounds, encode each distinct chunk once, gather the rest.

A text's ids are the concatenation of its chunks' ids when no token can span a chunk's bound. For both vocabularies a
chunk may begin at ASCII white space after a character that is not white space, and at ASCII punctuation after a letter:
their splitting patterns always end a piece there. Chunks are found and looked up (by content) with array operations; only
chunks that a worker has not met go to the tokenizers library. Special tokens' strings hold punctuation and could be cut, so a
row that contains "<|" is encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import public_tokenizers

from triplake.llm import textarrays as ta

# Distinct chunks (and chunks of over 15 bytes) a worker remembers before it starts over.
CACHE_CHUNKS = 1 << 20
CACHE_LONG = 1 << 17
# New chunks given to the library at once; its encodings take far more memory than the ids kept of them.
LEARN_CHUNKS = 1 << 11
# New words that are encoded as one text.
TEXT_CHUNKS = 1 << 6
# The letters below are composed already and combine with none of the others.
LATIN_END = "\u0250"

_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 1 | 4  # printable ASCII, which is never white space
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1 | 2
_KIND[0x30:0x3A] = 1
_KIND[ta.SPACE] = 8
# The low k bytes of a word.
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_encoders: dict[tuple, "Encoder"] = {}


class Encoder:
    """Encodes flat rows with one tokenizer file; keeps the ids of chunks it has met in growing arrays.

    A chunk of up to 15 bytes is its own key: two 64-bit words hold its bytes and its length. Longer ones are kept as bytes.
    So a chunk is found by its content, never by a hash alone.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self._forget()

    def _forget(self) -> None:
        self.slots = np.full(1 << 16, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.n = 0
        self.low = np.zeros(1 << 15, np.uint64)
        self.high = np.zeros(1 << 15, np.uint64)  # 0 for a long chunk
        self.begin = np.zeros((1 << 15) + 1, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = low * np.uint64(ta.BASE) ^ high * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(64 - int(len(self.slots)).bit_length() + 1)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mask = len(self.slots) - 1
        at = self._slot(low, high)
        entry = self.slots[at].astype(np.int64)
        open_ = np.flatnonzero((entry >= 0) & ((self.low[entry] != low) | (self.high[entry] != high)))
        while len(open_):
            at[open_] = (at[open_] + 1) & mask
            e = self.slots[at[open_]].astype(np.int64)
            entry[open_] = e
            open_ = open_[(e >= 0) & ((self.low[e] != low[open_]) | (self.high[e] != high[open_]))]
        return entry

    def _place(self, entries: np.ndarray) -> None:
        """Put new entries into free slots; of those that meet at a slot one wins, the rest move on."""
        mask = len(self.slots) - 1
        at = self._slot(self.low[entries], self.high[entries])
        while len(entries):
            free = self.slots[at] < 0
            self.slots[at[free]] = entries[free]
            lost = self.slots[at] != entries
            entries, at = entries[lost], (at[lost] + 1) & mask

    def _apart(self, chunks: list[str]) -> tuple[list[int], list[int]]:
        """(number of ids of each chunk, all ids) with each chunk encoded by itself."""
        lengths: list[int] = []
        ids: list[int] = []
        for k in range(0, len(chunks), LEARN_CHUNKS):
            for e in self.tokenizer.encode_batch_fast(chunks[k:k + LEARN_CHUNKS], add_special_tokens=False):
                own = e.ids
                lengths.append(len(own))
                ids += own
        return lengths, ids

    def _words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_apart`` of chunks that are a space and Latin letters: many are one text, in which each is one word.

        The library numbers the words of a text; where that does not tell the chunks apart they are encoded one by one.
        """
        lengths, ids = [], []
        for k in range(0, len(chunks), LEARN_CHUNKS):
            part = chunks[k:k + LEARN_CHUNKS]
            texts = [part[j:j + TEXT_CHUNKS] for j in range(0, len(part), TEXT_CHUNKS)]
            for own, e in zip(texts, self.tokenizer.encode_batch(["".join(t) for t in texts], add_special_tokens=False)):
                n, flat = np.bincount(np.array(e.word_ids, np.int64), minlength=len(own)), e.ids
                if len(n) != len(own) or not n.all():
                    n, flat = self._apart(own)
                lengths.append(n)
                ids.append(np.array(flat, np.uint32))
        return (np.concatenate(lengths), np.concatenate(ids)) if ids else (np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _learn(self, chunks: list[str], low: np.ndarray, high: np.ndarray) -> None:
        word = np.array([c[0] == " " and c[1:].isalpha() and (c.isascii() or max(c) < LATIN_END) for c in chunks], bool)
        lengths = np.zeros(len(chunks), np.int64)
        lengths[word], own_ids = self._words([c for c, w in zip(chunks, word.tolist()) if w])
        lengths[~word], other_ids = self._apart([c for c, w in zip(chunks, word.tolist()) if not w])
        flat, mask = np.empty(len(own_ids) + len(other_ids), np.uint32), np.repeat(word, lengths)
        flat[mask], flat[~mask] = own_ids, other_ids
        m = self.n + len(chunks)
        if m > len(self.low):
            size = max(2 * len(self.low), m)
            self.low, self.high = np.resize(self.low, size), np.resize(self.high, size)
            self.begin = np.resize(self.begin, size + 1)
        used = int(self.begin[self.n])
        if used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, max(2 * len(self.pool), used + len(flat)))
        self.pool[used:used + len(flat)] = flat
        self.low[self.n:m], self.high[self.n:m] = low, high
        self.begin[self.n + 1:m + 1] = used + np.cumsum(lengths)
        fresh = np.arange(self.n, m, dtype=np.int32)
        self.n = m
        if 2 * m > len(self.slots):
            self.slots = np.full(1 << int(np.ceil(np.log2(4 * m))), -1, np.int32)
            fresh = np.arange(m, dtype=np.int32)
        self._place(fresh[self.high[fresh] > 0])

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other as uint32, offsets of the rows in them)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.n > CACHE_CHUNKS or len(self.long) > CACHE_LONG:
            self._forget()
        cut = np.zeros(n, bool)
        p, c = data[:-1], data[1:]
        kind = _KIND[data]  # bit 1: plain, 2: letter, 4: punctuation, 8: white space
        before, after = kind[:-1], kind[1:]
        cut[1:] = ((after & 8) > 0) & ((before & 1) > 0) | ((after & 4) > 0) & ((before & 2) > 0)
        two = np.flatnonzero((p >= 0xC3) & (p <= 0xDF)) + 2  # after a two-byte character from U+00C0 on: none of them is white space
        two = two[two < n]
        latin = (data[two - 2] == 0xC3) & (data[two - 1] != 0x97) & (data[two - 1] != 0xB7)  # a letter
        cut[two] |= (kind[two] & 8 > 0) | (kind[two] & 4 > 0) & latin
        marks = np.flatnonzero((p == 0x3C) & (c == 0x7C))
        for row in np.unique(np.searchsorted(off, marks, side="right") - 1):
            cut[off[row]:off[row + 1]] = False
        cut[off[:-1][off[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        size = ends - starts
        room = np.concatenate([data, np.zeros(16, np.uint8)])
        words = np.ndarray((n + 8,), "<u8", room, strides=(1,))
        low, high = words[starts] & _MASK[np.minimum(size, 8)], words[starts + 8] & _MASK[np.clip(size - 8, 0, 7)]
        high |= size.astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(size > 15)
        if len(long):
            raw = data.tobytes()
            keys = [raw[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist())]
            new = [k for k in dict.fromkeys(keys) if k not in self.long]
            if new:
                first = self.n
                none = np.zeros(len(new), np.uint64)
                self._learn([k.decode("utf-8", "replace") for k in new], none, none)
                self.long.update(zip(new, range(first, self.n)))
            high[long] = 0  # looked up below as a free slot, then set
        entry = self._find(low, high)
        if len(long):
            entry[long] = [self.long[k] for k in keys]
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            order = missing[np.lexsort((low[missing], high[missing]))]
            first = np.ones(len(order), bool)
            first[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            new = order[first]
            raw = data.tobytes()
            self._learn([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist())],
                        low[new], high[new])
            entry[missing] = self._find(low[missing], high[missing])
        lengths = self.begin[entry + 1] - self.begin[entry]
        total = np.concatenate([[0], np.cumsum(lengths)])
        gather = np.arange(total[-1]) + np.repeat(self.begin[entry] - total[:-1], lengths)
        return self.pool[gather], total[np.searchsorted(starts, off)]


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """This worker's encoder for a tokenizer file (a path, or a name among the public tokenizers)."""
    key = (path, special_as_text)
    if key not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[key] = Encoder(path if "/" in path else public_tokenizers.path(path), special_as_text)
    return _encoders[key]


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every row."""
    n = len(off) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(off))] = ids
    return out, off + np.arange(n + 1)
