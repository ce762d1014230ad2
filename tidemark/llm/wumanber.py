"""Benchmark decontamination by Wu-Manber search for all word windows of the benchmark at once.

Patterns are windows of 13 words (or a whole shorter item) with one space before, between and after the words.
Patterns of similar length m..2m-1 share a table: the hash of a block of a few bytes gives the smallest distance
from the block to the end of any pattern's first m bytes, so the text position may advance by it; distance 0 leads to the
bucket of patterns with that suffix hash, which are then compared byte for byte.  Many stretches of text are
scanned side by side as numpy lanes.

Patterns are held by every executor, so they are cut by window hash into blocks of at most `block_mb`; each block
is one pass over the documents, and a benchmark of any size is searched whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import dropped, written
from . import textbuf as tb

WINDOW = 13
#: Most MB of windows that are broadcast at once.
BLOCK_MB = 32
_STRETCH = 256
_MULTIPLIER = tb.U64(0x9E3779B97F4A7C15)
_NOT_GAP = tb.byte_class((0x01, 0x01), (0x20, 0x20))


def normal_words(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first) of the words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the lower-cased texts."""
    data, off = tb.flat(column)
    if not len(data):
        return b"", off[:0], off[:0], off
    data, starts, ends, first = tb.squeezed(tb.LOWER[data], off, tb.ALNUM)
    return data.tobytes(), starts, ends, first


def windows_of(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, item_id), distinct: each run of `size` words of an item, or all words of a shorter one."""

    def run(batches):
        for batch in batches:
            raw, starts, ends, first = normal_words(batch.column("text"))
            ids, found = batch.column("item_id").to_pylist(), []
            for i in range(batch.num_rows):
                f, t = int(first[i]), int(first[i + 1])
                words = raw[starts[f] : ends[t - 1]].split(b" ") if f < t else []
                found += [(ids[i], b" ".join(words[j : j + size])) for j in range(max(1, len(words) - size + 1))] if words else []
            yield pa.RecordBatch.from_arrays([pa.array([w for _, w in found], pa.binary()), pa.array([i for i, _ in found], pa.int64())], ["window", "item_id"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "window binary, item_id long").distinct()


class Patterns:
    """Search tables for a set of patterns, and the items of each."""

    def __init__(self, rows: list[tuple[bytes, int | None]]):
        items: dict[bytes, list[int]] = {}
        for window, item in rows:
            items.setdefault(bytes(window), []).extend([] if item is None else [item])
        self.windows = sorted(items)
        self.n_words = np.array([w.count(b" ") + 1 for w in self.windows], np.int64)
        self.items = np.array([i for w in self.windows for i in items[w]], np.int64)
        self.first_item = np.concatenate([[0], np.cumsum([len(items[w]) for w in self.windows])]).astype(np.int64)
        padded = [b" " + w + b" " for w in self.windows]
        self.sizes = np.array([len(p) for p in padded], np.int64)
        self.lane_at = np.concatenate([[0], np.cumsum(-(-self.sizes // 8))]).astype(np.int64)
        self.lanes = np.frombuffer(b"".join(p + bytes(-len(p) % 8) for p in padded), "<u8")
        self.tables = []
        left = np.arange(len(padded))
        while len(left):
            m = int(self.sizes[left].min())
            here = left[self.sizes[left] < 2 * m]
            left = left[self.sizes[left] >= 2 * m]
            self.tables.append(self._table(padded, here, m))

    @staticmethod
    def _table(padded: list[bytes], here: np.ndarray, m: int) -> tuple:
        block = 8 if m >= 16 else 4 if m >= 6 else 3
        heads = np.frombuffer(b"".join(padded[i][:m] for i in here), np.uint8).reshape(len(here), m)
        bits = int(np.clip(np.ceil(np.log2(max(1, len(here)) * m * 8)), 12, 22))
        shift = np.full(1 << bits, m - block + 1, np.int32)
        for end in range(block, m + 1):
            np.minimum.at(shift, _blocks(heads[:, end - block : end], bits), m - end)
        suffix = _blocks(heads[:, m - block :], bits)
        order = np.argsort(suffix, kind="stable")
        return m, block, bits, shift, suffix[order], here[order]

    def search(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(place, pattern) of all occurrences in a text whose words have spaces around them."""
        buf = np.zeros(len(text) + 16, np.uint8)
        buf[: len(text)] = np.frombuffer(text, np.uint8)
        at8 = np.ndarray((len(text) + 9,), "<u8", buf, strides=(1,))
        places, patterns = [], []
        for m, block, bits, shift, suffix, order in self.tables:
            at = np.arange(0, len(text), _STRETCH)
            stop = np.minimum(at + _STRETCH, len(text))
            at = np.maximum(at, m - 1)
            mask = tb.U64((1 << 8 * block) - 1)
            found, hashes = [], []
            live = at < stop
            at, stop = at[live], stop[live]
            while len(at):
                h = (((at8[at - block + 1] & mask) * _MULTIPLIER) >> tb.U64(64 - bits)).astype(np.int64)
                step = shift[h]
                hit = step == 0
                if hit.any():
                    found.append(at[hit])
                    hashes.append(h[hit])
                at = at + np.maximum(step, 1)
                live = at < stop
                at, stop = at[live], stop[live]
            if not found:
                continue
            at, h = np.concatenate(found) - m + 1, np.concatenate(hashes)
            lo, hi = np.searchsorted(suffix, h, "left"), np.searchsorted(suffix, h, "right")
            n = hi - lo
            which = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at, which = np.repeat(at, n), order[which]
            live = at + self.sizes[which] <= len(text)
            at, which = at[live], which[live]
            done = np.zeros(len(at), np.int64)
            while len(at):
                left = self.sizes[which] - 8 * done
                full = left <= 0
                if full.any():
                    places.append(at[full])
                    patterns.append(which[full])
                    at, which, done, left = at[~full], which[~full], done[~full], left[~full]
                cut = np.where(left >= 8, tb.U64(0xFFFFFFFFFFFFFFFF), (tb.U64(1) << (np.minimum(left, 7) * 8).astype(np.uint64)) - tb.U64(1))
                same = (at8[at + 8 * done] & cut) == self.lanes[self.lane_at[which] + done]
                at, which, done = at[same], which[same], done[same] + 1
        none = np.zeros(0, np.int64)
        return (np.concatenate(places), np.concatenate(patterns)) if places else (none, none)


def _blocks(rows: np.ndarray, bits: int) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return ((wide.view("<u8").ravel() * _MULTIPLIER) >> tb.U64(64 - bits)).astype(np.int64)


def _scan(part: pa.RecordBatch, patterns: Patterns) -> tuple[np.ndarray, list[np.ndarray], list[list[int]]]:
    """Of each text: its number of words, the occurrences' (first word * 2**32 + words), and the items."""
    raw, starts, ends, first = normal_words(part.column("text"))
    n = np.diff(first)
    pieces = [raw[starts[f] : ends[t - 1]] if f < t else b"" for f, t in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    text = b" " + b" \x01 ".join(pieces) + b" "
    size = np.array([len(p) for p in pieces], np.int64)
    base = 1 + np.cumsum(size + 3) - (size + 3)
    old = starts[np.minimum(first[:-1], max(0, len(starts) - 1))] if len(starts) else np.zeros(len(n), np.int64)
    word_at = starts + np.repeat(base - old, n)
    place, which = patterns.search(text)
    word = np.searchsorted(word_at, place + 1)
    doc = np.searchsorted(first, word, side="right") - 1
    spans: list[np.ndarray] = [place[:0]] * len(n)
    items: list[list[int]] = [[]] * len(n)
    by = np.lexsort((word, doc))
    word, doc, which = word[by], doc[by], which[by]
    for i, f in zip(*np.unique(doc, return_index=True), strict=True):
        t = np.searchsorted(doc, i, side="right")
        spans[i] = ((word[f:t] - first[i]) << 32) + patterns.n_words[which[f:t]]
        own = np.unique(which[f:t])
        items[i] = np.unique(np.concatenate([patterns.items[patterns.first_item[w] : patterns.first_item[w + 1]] for w in own])).tolist()
    return n, spans, items


def _hit(spans: np.ndarray, n: int) -> int:
    """How many of n words lie in a span."""
    if not len(spans):
        return 0
    a = spans >> 32
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, a + (spans & 0xFFFFFFFF), -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


_FOUND = "doc_id long, n_words long, spans array<long>, items array<long>"
_RESULT = "doc_id long, n_words long, n_hit long, items array<long>, spans array<long>, contaminated boolean"


def _verdict(ids, n, spans, items, share: int) -> pa.RecordBatch:
    hit = [_hit(s, int(k)) for s, k in zip(spans, n, strict=True)]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.int64())), pa.array(spans, pa.list_(pa.int64())), pa.array([h > 0 and share * h >= k for h, k in zip(hit, n, strict=True)], pa.bool_())],
        ["doc_id", "n_words", "n_hit", "items", "spans", "contaminated"],
    )


def _blocked(benchmark: DataFrame, window: int, block_mb: float):
    """(number of blocks, a function that broadcasts the patterns of one)."""
    spark = benchmark.sparkSession
    windows = written(windows_of(benchmark, window), "windows")
    total = windows.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    blocks = max(1, -(-int(total) // int(block_mb * 1e6)))

    def block(b: int):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b).collect()  # one block: of bounded size
        return spark.sparkContext.broadcast(Patterns([tuple(r) for r in rows]))

    return blocks, block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, block_mb: float = BLOCK_MB) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans, contaminated) for each row of docs.

    spans are occurrences as first word * 2**32 + words; items the item_ids with an occurrence; contaminated: some word is
    hit, and share * n_hit >= n_words.  A null or wordless text or item has no words; an item without an id is searched
    for and not listed; items of one id are one item.  Rows that share a doc_id are judged one by one.
    Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks, block = _blocked(benchmark, window, block_mb)
    if blocks == 1:
        patterns = block(0)

        def whole(batches):
            for batch in batches:
                for part in tb.slices(batch, "text"):
                    yield _verdict(part.column("doc_id"), *_scan(part, patterns.value), share)

        return docs.mapInArrow(whole, _RESULT)

    numbered = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    out = _merged(numbered, "_row", blocks, block, share).drop("_row")
    dropped(numbered)
    return out


def _merged(numbered: DataFrame, row: str, blocks: int, block, share: int) -> DataFrame:
    """The verdict on each row of numbered (row, doc_id, text) with its number `row`, by which the finds of all blocks meet."""
    found = []
    for b in range(blocks):
        patterns = block(b)

        def some(batches, patterns=patterns):
            for batch in batches:
                for part in tb.slices(batch, "text"):
                    n, spans, items = _scan(part, patterns.value)
                    yield pa.RecordBatch.from_arrays([part.column(row), part.column("doc_id"), pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64()))], [row, "doc_id", "n_words", "spans", "items"])

        found.append(written(numbered.mapInArrow(some, f"{row} long, {_FOUND}"), "found"))
        patterns.unpersist()
    every = found[0]
    for x in found[1:]:
        every = every.union(x)
    merged = every.groupBy(row).agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def judge(batches):
        for x in batches:
            out = _verdict(x.column("doc_id"), x.column("n_words").to_numpy(), [np.asarray(s.values.to_numpy(zero_copy_only=False), np.int64) for s in x.column("spans")], x.column("items").to_pylist(), share)
            yield pa.RecordBatch.from_arrays([x.column(row), *out.columns], [row, *out.schema.names])

    out = written(merged.mapInArrow(judge, f"{row} long, {_RESULT}"), "verdicts")
    for x in found:
        dropped(x)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, block_mb: float = BLOCK_MB) -> DataFrame:
    """The rows of docs that are not contaminated, all columns unchanged.

    A benchmark of one block is searched in place, without a shuffle; for a larger one each row
    is judged under a number of its own, so that a null or repeated doc_id loses no row.
    """
    blocks, block = _blocked(benchmark, window, block_mb)
    if blocks == 1:
        patterns = block(0)

        def run(batches):
            for batch in batches:
                for part in tb.slices(batch, "text"):
                    n, spans, _ = _scan(part, patterns.value)
                    hit = np.array([_hit(x, int(k)) for x, k in zip(spans, n, strict=True)], np.int64)
                    yield part.filter(pa.array((hit == 0) | (share * hit < n)))

        return docs.mapInArrow(run, docs.schema)
    row = tb.fresh("_row", docs.columns)
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    bad = _merged(numbered.select(row, F.col(row).alias("doc_id"), "text"), row, blocks, block, share).where("contaminated").select(row)
    return numbered.join(bad, row, "left_anti").select(docs.columns)


def op6_wu_manber(spark, sf_dir: str) -> DataFrame:
    """contamination() of all documents by all benchmark items, the item ids as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(named.cast("binary"), 256).alias("items_sha256"), "contaminated")
