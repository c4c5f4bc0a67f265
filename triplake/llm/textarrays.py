"""Arrow string columns as flat byte arrays: word bounds, range hashes and segment helpers (numpy)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Fixed odd multiplier of the range hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CONTINUATION = np.zeros(256, dtype=bool)
CONTINUATION[0x80:0xC0] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls count as empty. Offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ob, db = column.buffers()
    off = np.frombuffer(ob, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(db, np.uint8)[off[0]:off[-1]] if db is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def pieces(offsets: np.ndarray, limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        out.append((i, j))
        i = j
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if "up" not in _powers or len(_powers["up"]) < n:
        m = max(n, 1 << 16)
        up = np.full(m, BASE, _U64)
        up[0] = 1
        down = np.full(m, pow(BASE, -1, 1 << 64), _U64)
        down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up, dtype=_U64), np.cumprod(down, dtype=_U64)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (two multiply and shift rounds)."""
    h = (h ^ (h >> _U64(31))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def grams(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit word of the eight bytes from each position on (zeros after the end)."""
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    return mixed(np.ndarray((len(data),), "<u8", room, strides=(1,)) + _U64(BASE))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of gram * BASE**i, so that any range's hash is one subtraction away.

    The terms are mixed words, not bytes: a polynomial of the bytes themselves is zero modulo 2**64 on the difference of
    some texts (Thue-Morse words) whatever its base.
    """
    up, _ = powers(len(data) + 1)
    s = np.zeros(len(data) + 1, _U64)
    np.cumsum(grams(data) * up[:len(data)], dtype=_U64, out=s[1:])
    return s


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges [start, end) of eight bytes or more, equal for equal content wherever it stands."""
    _, down = powers(len(sums))
    return mixed((sums[ends - 7] - sums[starts]) * down[starts] + (ends - starts).astype(_U64) * _U64(0xD6E8FEB86659FD93))


# Ranges of up to this many bytes are hashed together, eight bytes a step; longer ones one by one.
STEPWISE_BYTES = 64
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], _U64)


def content_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of any ranges [start, end), block by block of eight bytes: each step mixes what came before."""
    size = ends - starts
    h = mixed(size.astype(_U64) + _U64(BASE))
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    words_ = np.ndarray((len(data) + 1,), "<u8", room, strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= STEPWISE_BYTES))
    step = 0
    while len(live):
        block = words_[starts[live] + step] & _LOW_BYTES[np.minimum(size[live] - step, 8)]
        h[live] = mixed((h[live] ^ block) * _U64(BASE) + block)
        step += 8
        live = live[size[live] > step]
    long = np.flatnonzero(size > STEPWISE_BYTES)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        h[long] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return h


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the words of each row, where words are runs without ASCII white space."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def windows(values: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of every k consecutive values that lie in one row."""
    n = len(values)
    if n < k:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    first = np.flatnonzero(rows[:n - k + 1] == rows[k - 1:])
    h = np.zeros(len(first), _U64)
    for j in range(k):
        h = mixed(h * _U64(BASE) + values[first + j])
    return h, first


def repeated_in_row(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found more than once in the row, is an earlier one's repeat) for each key; input order decides 'earlier'."""
    n = len(keys)
    again, later = np.zeros(n, bool), np.zeros(n, bool)
    if n > 1:
        order = np.lexsort((keys, rows))
        k, r = keys[order], rows[order]
        same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        later[order[1:][same]] = True
    return again, later


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count (or sum of weights) by row as 64-bit integers."""
    return np.bincount(rows, weights=weights, minlength=n).astype(np.int64)
