"""SentencePiece encoding and decoding (BPE with byte fallback) in vectorised merge rounds.

No piece of the vocabulary has a word start mark after another character, so a text falls into units
(a run of marks and what follows it) that no merge crosses.  The distinct units of some MB of text are encoded side
by side: flat symbol arrays, each round finds the smallest pair rank of every unit (segmented minimum), merges its
leftmost occurrences at once, and compacts the arrays; units without a pair leave.  Merging several places of a unit at once
equals merging them one by one unless a new pair ranks before the one just merged, or with it; such units
(long runs of spaces, above all) are done again from a heap.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb

MARK = "▁"
NEVER = np.int32(2**31 - 1)
#: Distinct units that a worker remembers before it starts over.
REMEMBERED = 150_000
#: Bytes of the units that it remembers at most.
REMEMBERED_BYTES = 16 << 20


def default_model() -> str:
    """The 32,000-piece model of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Tables of one model; the file is read where they are made, and workers get the tables."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.size, self.end = n, model.eos_id()
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes: list[bytes] = []
        normal: dict[str, int] = {}
        for i, p in enumerate(pieces):
            if model.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes.append(bytes([int(p[3:5], 16)]))
            else:
                self.bytes.append(" ⁇ ".encode() if model.is_unknown(i) else b"" if special[i] else p.replace(MARK, " ").encode())
                if not special[i]:
                    normal[p] = i
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        self.is_control = np.array([model.is_control(i) for i in range(n)])
        self.is_normal = np.isin(np.arange(n), list(normal.values()))
        if any(MARK in p.lstrip(MARK) for p in normal) or any(c not in normal for p in normal for c in p):
            raise ValueError("the merges of this vocabulary cross word starts, or need characters that it lacks")
        self.char_id = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.char_id[0x20] = normal[MARK]
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in normal.values()}, reverse=True))}
        made = [(normal[p[:j]] * n + normal[p[j:]], order[model.get_score(i)], i) for p, i in normal.items() for j in range(1, len(p)) if p[:j] in normal and p[j:] in normal]
        self.bits = int(len(made) * 4).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NEVER, np.int32)
        self.merged = np.zeros(1 << self.bits, np.int32)
        key, rank, to = (np.array(x) for x in zip(*made, strict=True))
        at, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = left[self.keys[at[left]] == -1]
            slots, one = np.unique(at[free], return_index=True)
            won = free[one]
            self.keys[slots], self.ranks[slots], self.merged[slots] = key[won], rank[won], to[won]
            left = left[self.keys[at[left]] != key[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * tb.U64(0x9E3779B97F4A7C15)) >> tb.U64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of symbol pairs; NEVER where the vocabulary has no such piece."""
        rank, to = np.full(len(left), NEVER, np.int32), np.zeros(len(left), np.int32)
        live = np.flatnonzero((left < self.size) & (right < self.size))
        key = left[live].astype(np.int64) * self.size + right[live]
        at = self._slot(key)
        while len(live):
            got = self.keys[at]
            hit = got == key
            rank[live[hit]], to[live[hit]] = self.ranks[at[hit]], self.merged[at[hit]]
            on = ~hit & (got != -1)
            live, key, at = live[on], key[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return rank, to


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _symbols(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, unit) of the characters of byte ranges; a character the vocabulary lacks is size + code point."""
    n = ends - starts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    unit = np.repeat(np.arange(len(n)), n)
    b = np.concatenate([data, np.zeros(4, np.uint8)])
    lead = (b[at] & 0xC0) != 0x80
    at, unit = at[lead], unit[lead]
    b0, b1, b2, b3 = (b[at + k].astype(np.int32) for k in range(4))
    cp = np.where(b0 < 0x80, b0, np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | b1 & 0x3F, np.where(b0 < 0xF0, (b0 & 0xF) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F, (b0 & 7) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F)))
    known = v.char_id[cp]
    return np.where(known >= 0, known, v.size + cp), unit


def _merge(v: Vocabulary, sym: np.ndarray, unit: np.ndarray, n_units: int, single: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, unit, units to be done again) when no pair remains."""
    done_sym, done_unit, again = [], [], []
    rank, to = np.full(len(sym), NEVER, np.int32), np.zeros(len(sym), np.int32)
    within = np.flatnonzero(unit[1:] == unit[:-1])
    rank[within], to[within] = v.pair(sym[within], sym[within + 1])
    before = np.full(n_units, -1, np.int32)  # rank merged at several places in the round before
    while len(sym):
        begin = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        least = np.minimum.reduceat(rank, begin)
        owner = unit[begin]
        length = np.diff(np.append(begin, len(sym)))
        wrong = least <= before[owner]
        again.append(owner[wrong])
        out = np.repeat((least == NEVER) & ~wrong, length)
        done_sym.append(sym[out])
        done_unit.append(unit[out])
        stay = np.repeat((least != NEVER) & ~wrong, length)
        best = np.repeat(least, length)[stay]
        sym, unit, rank, to = sym[stay], unit[stay], rank[stay], to[stay]
        if not len(sym):
            break
        win = rank == best
        spot = np.flatnonzero(win)
        first = np.ones(len(spot), bool)
        first[1:] = unit[spot[1:]] != unit[spot[:-1]]
        if single:
            spot = spot[first]
        else:
            fresh = np.ones(len(spot), bool)  # of winners that touch each other, every second one
            fresh[1:] = spot[1:] != spot[:-1] + 1
            k = np.arange(len(spot))
            spot = spot[(k - np.maximum.accumulate(np.where(fresh, k, 0))) % 2 == 0]
        before[unit[spot]] = -1
        many = np.flatnonzero(unit[spot[1:]] == unit[spot[:-1]]) if len(spot) > 1 else spot[:0]
        before[unit[spot[many]]] = rank[spot[many]]
        sym[spot] = to[spot]
        keep = np.ones(len(sym), bool)
        keep[spot + 1] = False
        changed = np.zeros(len(sym), bool)
        changed[spot] = True
        sym, unit, rank, to, changed = sym[keep], unit[keep], rank[keep], to[keep], changed[keep]
        left = np.flatnonzero(changed)
        look = np.unique(np.concatenate([left, left[left > 0] - 1]))
        rank[look] = NEVER
        look = look[look < len(sym) - 1]
        look = look[unit[look] == unit[look + 1]]
        rank[look], to[look] = v.pair(sym[look], sym[look + 1])
    none = np.zeros(0, np.int64)
    return np.concatenate([*done_sym, none]), np.concatenate([*done_unit, none]), np.concatenate([*again, none])


def _one_by_one(v: Vocabulary, sym: list[int]) -> list[int]:
    """The merges of one unit from a heap, the best rank and then the leftmost first."""
    left, right = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
    heap: list[tuple[int, int, int, int, int]] = []

    def push(i: int) -> None:
        j = right[i] if i >= 0 else -1
        if j >= 0:
            rank, to = v.pair(np.array([sym[i]]), np.array([sym[j]]))
            if rank[0] != NEVER:
                heapq.heappush(heap, (int(rank[0]), i, sym[i], sym[j], int(to[0])))

    ranks, to = v.pair(np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64))
    heap = [(int(r), i, sym[i], sym[i + 1], int(t)) for i, (r, t) in enumerate(zip(ranks.tolist(), to.tolist(), strict=True)) if r != NEVER]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, merged = heapq.heappop(heap)
        j = right[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue  # one of them has been merged since
        sym[i], sym[j] = merged, -1
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        push(left[i])
        push(i)
    return [x for x in sym if x >= 0]


def encode_ranges(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of units given as byte ranges, a space standing for the word start mark."""
    sym, unit = _symbols(v, data, starts, ends)
    out, of, again = _merge(v, sym.copy(), unit.copy(), len(starts), False)
    if len(again):
        first = np.searchsorted(unit, np.stack([again, again + 1]))
        more = [_one_by_one(v, sym[a:b].tolist()) for a, b in first.T.tolist()]
        out = np.concatenate([out, *(np.array(m, np.int64) for m in more)])
        of = np.concatenate([of, np.repeat(again, [len(m) for m in more])])
    by = np.argsort(of, kind="stable")
    out, of = out[by], of[by]
    lacking = out >= v.size
    if lacking.any():  # characters outside the vocabulary become their UTF-8 bytes
        raw = [chr(c).encode() for c in (out[lacking] - v.size).tolist()]
        n = np.ones(len(out), np.int64)
        n[lacking] = [len(r) for r in raw]
        spread = np.repeat(lacking, n)
        out, of = np.repeat(out, n), np.repeat(of, n)
        out[spread] = v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.searchsorted(of, np.arange(len(starts) + 1))


def decode_ids(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of one id sequence: a mark is a space, but for one at the very start; bytes that aren't UTF-8
    become U+FFFD one by one; the unknown id reads as a double question mark between spaces."""
    raw = b"".join(map(v.bytes.__getitem__, ids.tolist()))
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = _lenient(v, ids)
    spoken = ids[~v.is_control[ids]] if len(ids) else ids
    return raw.removeprefix(b" ") if len(spoken) and v.is_normal[spoken[0]] else raw


def _lenient(v: Vocabulary, ids: np.ndarray) -> bytes:
    out, held = [], b""

    def flush() -> bytes:
        text, rest = "", held
        while rest:
            for n in (1, 2, 3, 4):
                try:
                    text, rest = text + rest[:n].decode(), rest[n:]
                    break
                except UnicodeDecodeError:
                    continue
            else:
                text, rest = text + "�", rest[1:]
        return text.encode()

    for i in ids.tolist():
        if v.is_byte[i]:
            held += v.bytes[i]
        else:
            out.append(flush())
            held = b""
            out.append(v.bytes[i])
    out.append(flush())
    return b"".join(out)


def _distinct(buf: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the distinct unit of each byte range, a range that shows each): grouped by hash, then compared byte for byte."""
    which, codes = pd.factorize(tb.xxh64(buf, starts, ends))
    example = np.empty(len(codes), np.int64)
    example[which[::-1]] = np.arange(len(which))[::-1]
    shown, size = example[which], ends - starts
    if not ((size == size[shown]).all() and tb.same(buf, starts, starts[shown], size).all()):  # two units have one hash
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        example = np.unique(which, return_index=True)[1]
    return which, example


class Encoder:
    """Encodes batches of texts; remembers distinct units between them."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.known: dict[bytes, int] = {}  # by the unit itself, not by a hash
        self.held = 0
        self.ids: list[bytes] = []  # 32-bit ids: a small array object would weigh more than its ids
        self.named: list[bytes] = []
        self.plain: list[bytes] = []
        self.numbers = [str(i) for i in range(v.size)]

    def units(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the units of all texts, first unit of each text)."""
        data, off = tb.flat(column)
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        if MARK.encode() in raw:
            pieces = [p.replace(MARK.encode(), b" ") for p in pieces]
        size = np.array([len(p) + 1 if p else 0 for p in pieces], np.int64)
        raw = b"".join(x for p in pieces if p for x in (b" ", p))
        buf = np.frombuffer(raw, np.uint8)
        at = np.cumsum(size) - size
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(len(size) + 1, np.int64)
        gap = buf == 0x20
        begin = gap.copy()
        begin[1:] &= ~gap[:-1]
        begin[at[size > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buf))
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.known, self.held, self.ids, self.named, self.plain = {}, 0, [], [], []
        which, example = _distinct(buf, raw, starts, ends)
        units = [raw[a:b] for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
        number = np.array([self.known.get(u, -1) for u in units], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            ids, o = encode_ranges(self.v, buf, starts[example[new]], ends[example[new]])
            number[new] = np.arange(len(new)) + len(self.ids)
            fresh = [units[k] for k in new.tolist()]
            self.known.update(zip(fresh, number[new].tolist(), strict=True))
            self.held += sum(map(len, fresh))
            words, raw_ids = [self.numbers[i] for i in ids.tolist()], ids.astype(np.int32).tobytes()
            for f, t in zip(o[:-1].tolist(), o[1:].tolist(), strict=True):
                self.ids.append(raw_ids[4 * f : 4 * t])
                self.named.append(" ".join(words[f:t]).encode())
        return number[which], np.searchsorted(starts, np.append(at, len(buf)))

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text, the end id last."""
        units, first = self.units(column)
        end, own = np.array([self.v.end], np.int32).tobytes(), self.ids.__getitem__
        return [np.frombuffer(b"".join([*map(own, units[f:t].tolist()), end]), np.int32) for f, t in zip(first[:-1], first[1:], strict=True)]

    def digests(self, column: pa.Array) -> tuple[list[int], list[str], list[str]]:
        """(number of ids, SHA-256 of the ids in decimal, SHA-256 of the decoded text) of each text."""
        units, first = self.units(column)
        size = np.fromiter(map(len, self.ids), np.int64, len(self.ids)) // 4
        while len(self.plain) < len(self.ids):  # decoded pieces without the text's first space taken away
            ids = np.frombuffer(self.ids[len(self.plain)], np.int32)
            self.plain.append(b"".join(map(self.v.bytes.__getitem__, ids.tolist())))
        total = np.concatenate([[0], np.cumsum(size[units])])
        end, named, plain = [str(self.v.end).encode()], self.named.__getitem__, self.plain.__getitem__
        n, a, b = [], [], []
        for f, t in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            own = units[f:t].tolist()
            n.append(int(total[t] - total[f]) + 1)
            a.append(hashlib.sha256(b" ".join([*map(named, own), *end])).hexdigest())
            b.append(hashlib.sha256(b"".join(map(plain, own)).removeprefix(b" ")).hexdigest())
        return n, a, b


def encoded(docs: DataFrame, model: str | None = None, digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, text) for each row of docs: the ids of the whole text with an end id, and what they decode to.

    With digest, ids and text are SHA-256 digests in hex (of the decimal ids joined by one space, and of the decoded
    UTF-8).  A null or empty text has the end id alone.  The literal mark U+2581 reads as a space.
    Repeated rows are encoded each; other columns are ignored.  No text is cut, however long.
    """
    v = docs.sparkSession.sparkContext.broadcast(vocabulary(model or default_model()))

    def run(batches):
        encoder = Encoder(v.value)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                if digest:
                    n, ids, text = encoder.digests(part.column("text"))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], ["doc_id", "n_tokens", "ids", "text"])
                else:
                    ids = encoder.encode(part.column("text"))
                    text = [decode_ids(encoder.v, x).decode() for x in ids]
                    off = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    flat = pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(off), pa.int64()), pa.ListArray.from_arrays(pa.array(off), flat), pa.array(text, pa.string())], ["doc_id", "n_tokens", "ids", "text"])

    kind = "string" if digest else "array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, n_tokens long, ids {kind}, text string")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids: array<int>); null ids give an empty text."""
    v = rows.sparkSession.sparkContext.broadcast(vocabulary(model or default_model()))

    def run(batches):
        for batch in batches:
            ids = [np.asarray(x or [], np.int64) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([decode_ids(v.value, x).decode() for x in ids], pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op7_sentencepiece_rounds(spark, sf_dir: str) -> DataFrame:
    """encoded() of all documents, ids and decoded texts as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded(docs, digest=True).select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("text").alias("decoded_sha256"))
