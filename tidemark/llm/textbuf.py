"""Flat byte views of Arrow string columns, and vectorised hashing of byte ranges.

Texts of a batch lie end to end in one uint8 array.  Words, lines and windows are
index arrays into it, so no Python string is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
#: Bytes of text that are worked on at once; one longer text is worked on alone.
SLICE_BYTES = 2 << 20
#: Longer byte ranges are hashed and compared one by one, shorter ones side by side.
LONG_BYTES = 1024


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def fresh(stem: str, taken: list[str]) -> str:
    """A column name that isn't taken, case aside."""
    low = {c.lower() for c in taken}
    while stem.lower() in low:
        stem += "_"
    return stem


def sizes(column: pa.Array) -> np.ndarray:
    return np.diff(flat(column)[1])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES):
    """The batch in pieces of at most `most` text bytes, or one row."""
    end = np.cumsum(sizes(batch.column(column)))
    at = 0
    while at < batch.num_rows:
        base = end[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(end, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, false inside the given closed ranges."""
    table = np.ones(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = False
    return table


#: Word characters when only ASCII white space separates.
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Word characters when every ASCII character but lower-case letters and digits separates.
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of all words, and the first word of each text."""
    w = table[data]
    n = len(w)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    before[off[:-1][off[:-1] < n]] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads each bit of 64 over all others (a bijection)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def window_hash(h: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hashes of all runs of k consecutive values, text borders ignored."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, seed, U64)
    for j in range(k):
        out *= U64(0x9FB21C651E98DF25)
        out += h[j : j + n]
    return mix(out)


def inside(first: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of the runs of k words (by their first word) lie within one text."""
    ok = np.ones(max(0, total - k + 1), bool)
    for j in range(1, k):
        at = first - j  # windows that begin j words before a text's first word cross into it
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


P1, P2, P3, P4, P5 = (U64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def _wrapped(seed: int) -> list[np.uint64]:
    return [U64(x % (1 << 64)) for x in (seed + int(P1) + int(P2), seed + int(P2), seed, seed - int(P1))]


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, zeros behind the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of byte ranges."""
    long = ends - starts > LONG_BYTES
    if long.any():
        out = np.empty(len(starts), U64)
        out[~long] = xxh64(data, starts[~long], ends[~long], seed)
        raw = memoryview(np.ascontiguousarray(data))
        out[long] = [xxhash.xxh64_intdigest(raw[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        return out
    lanes = _lanes(data)
    seed = U64(seed)
    size = ends - starts
    at = starts.copy()
    h = np.full(len(starts), (int(seed) + int(P5)) % (1 << 64), U64)
    long = np.flatnonzero(size >= 32)
    if len(long):
        v = [np.full(len(long), x, U64) for x in _wrapped(int(seed))]
        p, left = at[long], size[long]
        live = np.arange(len(long))
        while len(live):
            for k in range(4):
                v[k][live] = _round(v[k][live], lanes[p[live] + 8 * k])
            p[live] += 32
            left[live] -= 32
            live = live[left[live] >= 32]
        acc = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            acc = (acc ^ _round(U64(0), v[k])) * P1 + P4
        h[long] = acc
        at[long] = p
    h += size.astype(U64)
    left = ends - at
    live = np.flatnonzero(left >= 8)
    while len(live):
        h[live] = _rotl(h[live] ^ _round(U64(0), lanes[at[live]]), 27) * P1 + P4
        at[live] += 8
        left[live] -= 8
        live = live[left[live] >= 8]
    live = np.flatnonzero(left >= 4)
    if len(live):
        h[live] = _rotl(h[live] ^ ((lanes[at[live]] & U64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[live] += 4
        left[live] -= 4
    live = np.flatnonzero(left > 0)
    while len(live):
        h[live] = _rotl(h[live] ^ ((lanes[at[live]] & U64(0xFF)) * P5), 11) * P1
        at[live] += 1
        left[live] -= 1
        live = live[left[live] > 0]
    h = (h ^ (h >> U64(33))) * P2
    h = (h ^ (h >> U64(29))) * P3
    return h ^ (h >> U64(32))


def same(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, other: np.ndarray | None = None) -> np.ndarray:
    """Whether the `size` bytes from a on in data equal those from b on in `other` (data where it isn't given)."""
    out = np.ones(len(a), bool)
    x = _lanes(data)
    y = x if other is None else _lanes(other)
    long = np.flatnonzero(size > LONG_BYTES)
    if len(long):
        to = data if other is None else other
        out[long] = [np.array_equal(data[i : i + n], to[j : j + n]) for i, j, n in zip(a[long].tolist(), b[long].tolist(), size[long].tolist(), strict=True)]
    live = np.flatnonzero((size > 0) & (size <= LONG_BYTES))
    done = 0
    while len(live):
        left = size[live] - done
        cut = np.where(left >= 8, U64(0xFFFFFFFFFFFFFFFF), (U64(1) << (np.minimum(left, 7) * 8).astype(U64)) - U64(1))
        ok = ((x[a[live] + done] ^ y[b[live] + done]) & cut) == 0
        out[live[~ok]] = False
        done += 8
        live = live[ok & (left > 8)]
    return out


def squeezed(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first): the words of each text with exactly one space between them."""
    starts, ends, first = words(data, off, table)
    w = table[data]
    keep = w.copy()
    keep[1:] |= w[:-1]
    keep[off[:-1][off[:-1] < len(keep)]] &= w[off[:-1][off[:-1] < len(keep)]]
    out = np.where(w, data, np.uint8(0x20))[keep]
    at = np.cumsum(keep)
    return out, at[starts] - 1, at[ends - 1], first
