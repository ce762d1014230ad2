"""Substring dedup by seed and extend.

Anchors: the k-word seeds that winnowing picks; any run of `length` words holds at least one, and equal runs pick the same one at the
same place.  Documents are joined on the anchors' hashes, and an anchor that only one document has goes no further.  The
others bring the words around them, as many on either side as a run with the anchor can reach.  All occurrences of an anchor are
then extended side by side, word by word to the right and to the left: two of them match as far as they have stood in one class, so
words themselves are compared, not hashes.  A run of `length` words that a smaller doc_id brought before is a repeat; repeats that
overlap or touch are joined into maximal spans.

The texts are cut into pieces of some MB.  Within a piece repeats are settled at once (equal hashes, then equal bytes) and an anchor is sent
only where a run that holds it is unsettled, so a passage in a third of all documents has a row for each piece, not for each document.
Anchors with many occurrences all the same (a stock phrase before ever other words) are split by the words beside them: a run reaches half
of what it may to the left of the anchor, or else further to the right.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written
from . import textbuf as tb

LENGTH = 13
SEED_WORDS = 7
#: Bytes of text of a piece.
PIECE_BYTES = 4 << 20
#: An anchor with more occurrences is split by the words beside it.
MANY = 20_000
# a place is the row's tag * 2**32 + word, so that rows that share a doc_id keep their own spans; n: 0 for an anchor, else the words of a settled span
_SENT = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])
_SHARED = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("many", pa.bool_())])
_AROUND = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("words", pa.string())])
_SPAN = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])


def _tags(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """16 bits of each text's hash, above its word numbers."""
    return (tb.xxh64(data, off[:-1], off[1:]) & tb.U64(0xFFFF)).astype(np.int64) << 32


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with one space between words, starts, ends, first word of each text, tag of each text)."""
    data, off = tb.flat(texts)
    if not len(data):
        return data, off[:0], off[:0], off, _tags(data, off)
    return *tb.squeezed(data, off, tb.NOT_SPACE), _tags(data, off)


def _ranges(flag: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of stretches of true values that don't reach over a true value of cut (a stretch begins there)."""
    before = np.empty(len(flag), bool)
    before[:1] = False
    before[1:] = flag[:-1]
    begin = flag & (~before | cut)
    after = np.empty(len(flag), bool)
    after[-1:] = True
    after[:-1] = ~flag[1:] | cut[1:]
    return np.flatnonzero(begin), np.flatnonzero(flag & after) + 1


def _piece(part: pa.RecordBatch, length: int, k: int) -> pa.RecordBatch | None:
    """Rows to send for one piece of the documents: anchors of unsettled runs, and settled spans."""
    ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    data, starts, ends, first, tag = _words(part.column("text").take(pa.array(order)))
    total = len(starts)
    if total < length:
        return None
    h = tb.xxh64(data, starts, ends)
    at = np.flatnonzero(tb.inside(first, length, total))  # the first word of each run
    if not len(at):
        return None
    of = np.searchsorted(first, at, side="right") - 1
    doc = ids[of]
    grams = tb.window_hash(h, k)
    n = total - length + 1
    least = grams[:n].copy()
    for j in range(1, length - k + 1):
        np.minimum(least, grams[j : j + n], out=least)
    seed = np.zeros(n, np.int64)
    for j in range(length - k + 1):
        seed[grams[j : j + n] == least] = j
    seed = (seed + np.arange(n))[at]
    run = tb.window_hash(h, length, 7)[at]
    by = np.argsort(run, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = run[by][1:] != run[by][:-1]
    shown = np.empty(len(by), np.int64)
    shown[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    settled = doc > doc[shown]
    look = np.flatnonzero(settled)
    a, b = at[look], at[shown[look]]
    size = ends[a + length - 1] - starts[a]
    settled[look] = (size == ends[b + length - 1] - starts[b]) & tb.same(data, starts[a], starts[b], size)
    place = tag[of] + at - first[of]
    border = np.ones(len(at), bool)
    border[1:] = of[1:] != of[:-1]
    a, b = _ranges(settled, border)
    spread = tb.mix(doc[a].view(np.uint64)).view(np.int64)
    open_ = np.flatnonzero(~settled)
    open_ = open_[np.unique(seed[open_], return_index=True)[1]]
    s = seed[open_]
    columns = [
        (spread, grams[s].view(np.int64)), (doc[a], doc[open_]), (place[a], tag[of[open_]] + s - first[of[open_]]), (b - a + length - 1, np.zeros(len(s), np.int64)),
    ]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for c, t in zip(columns, (np.int64, np.int64, np.int64, np.int32), strict=True)], schema=_SENT)


def _joined(batches, many: int):
    """Settled spans as they are, and the anchors that two documents have, from rows sorted by key and doc."""
    held = _SENT.empty_table()
    over = None  # a key with more than `many` rows, of which some have gone on
    for batch in chain(_chained(batches), [None]):
        if batch is not None:
            spans = np.asarray(pc.greater(batch.column("n"), 0))
            if spans.any():
                part = batch.filter(pa.array(spans))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.zeros(part.num_rows, bool))], schema=_SHARED)
            table = pa.concat_tables([held, pa.Table.from_batches([batch.filter(pa.array(~spans))])])
        else:
            table = held
        if not table.num_rows:
            continue
        key, doc = (table.column(c).to_numpy() for c in ("key", "doc"))
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        shared = doc[begin] != doc[begin + size - 1]
        lots = size > many
        if over is not None and key[0] == over:
            shared[0] = lots[0] = True
        stay = 0  # rows of the last key, which may go on in the next batch
        if batch is not None and not (shared[-1] and lots[-1]):
            stay = size[-1]
            shared[-1] = False
        over = key[-1] if shared[-1] and lots[-1] else None
        held = table.slice(len(key) - stay)
        out = np.repeat(shared, size)
        if out.any():
            part = table.filter(pa.array(out)).combine_chunks()
            yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in part.columns), pa.array(np.repeat(lots, size)[out])], schema=_SHARED)


def _chained(batches):
    yield from (b for b in batches if b.num_rows)


def _around(batches, length: int, k: int):
    """The words around each anchor of a document; those of an anchor with many occurrences by the words on one side and on the other."""
    more = length - k
    left = (more + 1) // 2  # a run has so many words before the anchor, or else more - left + 1 after it
    right = more - left + 1
    for batch in batches:
        batch = batch.filter(batch.column("anchors").is_valid())
        for part, texts in _unpacked(batch):
            data, starts, ends, first, tag = _words(texts)
            raw = data.tobytes()
            own = part.column("anchors")
            row = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(own.offsets)))
            flat = own.flatten()
            at, key, many = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "key", "many"))
            mine = tag[row] == at >> 32 << 32
            row, at, key, many = row[mine], at[mine], key[mine], many[mine]
            doc = part.column("doc_id").to_numpy()[row]
            word = (at & 0xFFFFFFFF) + first[row]
            lo, hi = np.maximum(word - more, first[row]), np.minimum(word + length, first[row + 1])
            few = ~many | (more == 0)
            rows = [(key[few], doc[few], at[few], word[few], lo[few], hi[few])]
            if not few.all():
                for side, fits, a, b, x, y in (
                    (0, word - lo >= left, word - left, word + k, lo, np.minimum(hi, word + k + more - left)),
                    (1, hi - word - k >= right, word, word + k + right, np.maximum(lo, word - left + 1), hi),
                ):
                    fits = fits & ~few
                    code = tb.xxh64(data, starts[a[fits]], ends[b[fits] - 1], 43 + side)
                    rows.append((code.view(np.int64), doc[fits], at[fits], word[fits], x[fits], y[fits]))
            key, doc, at, word, lo, hi = (np.concatenate(x) for x in zip(*rows, strict=True))
            said = [raw[x:y].decode() for x, y in zip(starts[lo].tolist(), ends[hi - 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(at), pa.array((word - lo).astype(np.int32)), pa.array(said, pa.string())], schema=_AROUND)


def _classes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the distinct pairs."""
    return pd.factorize(a.astype(np.int64) * (int(b.max(initial=0)) + 2) + b + 1)[0]


def _extended(batches, length: int, k: int):
    """Spans (doc, at, n) that a smaller doc_id has too, from the words around anchors sorted by key and doc.

    What is kept from one batch to the next is rows of the last key that brought a run that was new.
    """
    more = length - k
    held = _AROUND.empty_table()
    for batch in _chained(batches):
        done = held.num_rows
        table = pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
        key, doc, at, before = (table.column(c).to_numpy() for c in ("key", "doc", "at", "before"))
        rows = len(key)
        lists = pc.split_pattern(table.column("words").combine_chunks(), " ")
        size = np.diff(np.asarray(lists.offsets))
        word = np.asarray(lists.flatten().dictionary_encode().indices).astype(np.int64)
        around = np.full((rows, 2 * more + k), -1, np.int64)  # the anchor's words stand in the columns more..more + k - 1
        row = np.repeat(np.arange(rows), size)
        around[row, np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + (more - before)[row]] = word
        seed = pd.factorize(key)[0]
        for c in range(more, more + k):
            seed = _classes(seed, around[:, c])
        right, left = [seed], [seed]
        for c in range(more):
            right.append(_classes(right[-1], around[:, more + k + c]))
            left.append(_classes(left[-1], around[:, more - 1 - c]))
        after = size - before - k
        low, high, new = np.full(rows, length), np.full(rows, -1), np.zeros(rows, bool)
        for j in range(more + 1):  # the run with j words before the anchor
            whole = np.flatnonzero((before >= j) & (after >= more - j))
            code, first = _classes(left[j][whole], right[more - j][whole]), np.zeros(0, np.int64)
            first = np.full(code.max(initial=-1) + 1, rows)
            np.minimum.at(first, code, whole)  # rows stand by doc
            again = doc[whole] > doc[first[code]]
            new[whole[~again]] = True
            low[whole[again]] = np.minimum(low[whole[again]], j)
            high[whole[again]] = np.maximum(high[whole[again]], j)
        found = np.flatnonzero(high >= 0)
        found = found[found >= done]
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(doc[found]), pa.array(at[found] - high[found]), pa.array((length + high - low)[found].astype(np.int32))], schema=_SPAN)
        held = table.filter(pa.array((key == key[-1]) & new))


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packed, "doc_id long, packed binary")


def repeats(docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS, many: int = MANY, base: DataFrame | None = None) -> DataFrame:
    """(doc, at, n): spans of n words of docs covered by runs of `length` words that also start in a document with a smaller
    doc_id; at is the row's tag * 2**32 + first word.  Spans may overlap; maximal() joins them.

    Rows with a null text or doc_id have no runs.  Rows that share a doc_id aren't held against each other.
    """

    def pieces(batches):
        for batch in batches:
            for part in tb.slices(batch, "text", PIECE_BYTES):
                if (out := _piece(part, length, seed_words)) is not None:
                    yield out

    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null").mapInArrow(pieces, "key long, doc long, at long, n int")
    by_key = sent.repartition("key").sortWithinPartitions("key", "doc")
    shared = written(by_key.mapInArrow(lambda batches: _joined(batches, many), "key long, doc long, at long, n int, many boolean"), "shared")
    anchors = shared.where("n = 0").groupBy("doc").agg(F.collect_list(F.struct("at", "key", "many")).alias("anchors"))
    base = _base(docs) if base is None else base
    around = base.join(anchors, base.doc_id == anchors.doc, "left").select("doc_id", "packed", "anchors").mapInArrow(lambda batches: _around(batches, length, seed_words), "key long, doc long, at long, before int, words string")
    grown = around.repartition("key").sortWithinPartitions("key", "doc").mapInArrow(lambda batches: _extended(batches, length, seed_words), "doc long, at long, n int")
    return shared.where("n > 0").select("doc", "at", "n").union(grown)


def maximal(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of spans of n words, joined where they overlap or touch."""
    by = np.argsort(first, kind="stable")
    a, b = first[by], (first + n)[by]
    if not len(a):
        return a, b
    top = np.maximum.accumulate(b)
    cut = np.ones(len(a), bool)
    cut[1:] = a[1:] > top[:-1]
    return a[cut], top[np.append(np.flatnonzero(cut)[1:] - 1, len(a) - 1)]


def _packed(batches):
    """Texts as compressed bytes, a third smaller in a shuffle than Spark's own block compression makes them."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([pack.compress(t.as_buffer()) if t.is_valid else None for t in texts], pa.binary())], ["doc_id", "packed"])


def _unpacked(batch: pa.RecordBatch):
    """(rows of the batch, their texts) in pieces of some MB."""
    unpack = zstandard.ZstdDecompressor()
    at, size, texts = 0, 0, []
    for k, t in enumerate(batch.column("packed")):
        texts.append(unpack.decompress(t.as_buffer()) if t.is_valid else b"")
        size += len(texts[-1])
        if size >= tb.SLICE_BYTES or k + 1 == batch.num_rows:
            yield batch.slice(at, k + 1 - at), pa.array(texts, pa.large_binary())
            at, size, texts = k + 1, 0, []


def _with_spans(docs: DataFrame, length: int, seed_words: int, many: int) -> DataFrame:
    base = _base(docs)  # shuffled once: both joins read the same exchange
    spans = repeats(docs, length, seed_words, many, base).groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    return base.join(spans, base.doc_id == spans.doc, "left").select("doc_id", "packed", "spans")


def dedup(docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS, digest: bool = False, many: int = MANY) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, text): each row of docs without its repeated spans.

    text holds the kept words joined by one space (with digest, their SHA-256 in hex); spans the
    removed maximal (from, to) word ranges.  A null text has no words and gives an empty text;
    texts under `length` words stay whole; a repeat within one document, or among rows that share a doc_id, stays.
    """

    def run(batches):
        for batch in batches:
            for part, texts in _unpacked(batch):
                data, starts, ends, first, tag = _words(texts)
                raw = data.tobytes()
                removed, ranges, kept = [], [], []
                for i, spans in enumerate(part.column("spans")):
                    f, t = int(first[i]), int(first[i + 1])
                    a = b = ()
                    if spans.is_valid:
                        at, n = (spans.values.field(c).to_numpy() for c in ("at", "n"))
                        own = at >> 32 << 32 == tag[i]
                        a, b = (x.tolist() for x in maximal(at[own] & 0xFFFFFFFF, n[own]))
                    ranges.append([{"from": int(x), "to": int(y)} for x, y in zip(a, b, strict=True)])
                    removed.append(int(sum(y - x for x, y in zip(a, b, strict=True))))
                    edges = [0, *(v for pair in zip(a, b, strict=True) for v in pair), t - f]
                    text = b" ".join(raw[starts[f + x] : ends[f + y - 1]] for x, y in zip(edges[::2], edges[1::2], strict=True) if x < y)
                    kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(ranges, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "text"],
                )

    return _with_spans(docs, length, seed_words, many).mapInArrow(run, "doc_id long, n_words long, n_removed long, spans array<struct<from:int,to:int>>, text string")


def op8_seed_extend(spark, sf_dir: str) -> DataFrame:
    """dedup() of all documents, the kept words as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup(docs, digest=True).select("doc_id", "n_words", "n_removed", F.col("text").alias("kept_sha256"))
