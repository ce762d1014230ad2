"""Quality rules: fixed limits on document statistics, then gradient-boosted trees over them.

The trees are fitted here on a bounded sample of labelled rows, by histograms and with monotonic
constraints (more symbols, capitals or repetition never raises a score), and flattened into arrays of
one complete binary tree each, so that a batch of documents is scored by a few gathers a tree level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the trees, and the direction in which each may move the score of quality (0: any).
FEATURES = {
    "log_words": 0, "mean_word_chars": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1, "upper_share": -1,
    "digit_share": -1, "mark_share": -1, "shout_share": -1, "distinct_word_share": 0, "words_per_line": 0, "longest_word": 0,
}
#: Most labelled rows that a model is fitted on: those with the smallest hash of doc_id.
SAMPLE_ROWS = 20_000
REPEAT_WINDOW = 5
_SYMBOL = ~tb.byte_class(*((ord(c), ord(c)) for c in "#*$%&|<>"))


def _class(*ranges) -> np.ndarray:
    return ~tb.byte_class(*ranges)


_UPPER, _DIGIT, _SHOUT = _class((0x41, 0x5A)), _class((0x30, 0x39)), _class((0x21, 0x21), (0x3F, 0x3F))
_MARKS = _class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def _per_text(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _twice(code: np.ndarray) -> np.ndarray:
    """Which values stand more than once."""
    s = np.sort(code)
    again = s[1:][s[1:] == s[:-1]]
    if not len(again):
        return np.zeros(len(code), bool)
    at = np.searchsorted(again, code)
    return again[np.minimum(at, len(again) - 1)] == code


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts and the features of each text; a null text is empty.

    n_words: runs without ASCII white space; word_chars: code points in them; n_symbols: characters of #*$%&|<>;
    n_dup_lines: lines with a word that equal an earlier line; n_repeat_words: words in runs of
    five words found twice or more in the text.
    """
    data, off = tb.flat(column)
    texts = len(column)
    starts, ends, first = tb.words(data, off, tb.NOT_SPACE)
    n = np.diff(first)
    out = {"n_words": n, "word_chars": _per_text(tb.NOT_SPACE[data] & ((data & 0xC0) != 0x80), off), "n_symbols": _per_text(_SYMBOL[data], off)}
    seeds = tb.mix(np.arange(1, texts + 1, dtype=np.uint64))
    end_of_line = np.flatnonzero(data == 0x0A)
    line = np.concatenate([off[:-1], end_of_line + 1])
    of = np.concatenate([np.arange(texts), np.searchsorted(off, end_of_line, side="right") - 1])
    by = np.lexsort((line, of))
    line, of = line[by], of[by]
    to = off[1:][of].copy()
    to[:-1][of[1:] == of[:-1]] = line[1:][of[1:] == of[:-1]] - 1
    worded = np.searchsorted(starts, to) > np.searchsorted(starts, line)
    line, to, of = line[worded], to[worded], of[worded]
    code = tb.mix(tb.xxh64(data, line, to) + seeds[of]) if len(data) else np.zeros(0, np.uint64)
    lines = np.bincount(of, minlength=texts)
    distinct_at = np.unique(code, return_index=True)[1]
    out["n_dup_lines"] = lines - np.bincount(of[distinct_at], minlength=texts)
    h = tb.xxh64(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    word_of = np.repeat(np.arange(texts), n)
    at = np.flatnonzero(tb.inside(first, REPEAT_WINDOW, len(starts)))
    again = at[_twice(tb.mix(tb.window_hash(h, REPEAT_WINDOW)[at] + seeds[word_of[at]]))] if len(at) else at
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(word_of[np.cumsum(edge)[:-1] > 0], minlength=texts)
    one = np.maximum(n, 1)
    letters = np.maximum(out["word_chars"], 1)
    distinct_word = np.unique(tb.mix(h + seeds[word_of]), return_index=True)[1]
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, word_of, ends - starts)
    out |= {
        "log_words": np.log1p(n), "mean_word_chars": out["word_chars"] / one, "symbols_per_word": out["n_symbols"] / one, "dup_line_share": out["n_dup_lines"] / np.maximum(lines, 1),
        "repeat_word_share": out["n_repeat_words"] / one, "upper_share": _per_text(_UPPER[data], off) / letters, "digit_share": _per_text(_DIGIT[data], off) / letters, "mark_share": _per_text(_MARKS[data], off) / letters,
        "shout_share": _per_text(_SHOUT[data], off) / letters, "distinct_word_share": np.bincount(word_of[distinct_word], minlength=texts) / one, "words_per_line": n / np.maximum(lines, 1), "longest_word": longest.astype(float),
    }
    return out


def feature_matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([np.asarray(stats[k], np.float64) for k in FEATURES], axis=1)


@dataclass
class Trees:
    """Complete trees of one depth in flat arrays: node k's children are 2k+1 (value <= cut) and 2k+2."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The log odds of good quality of each row."""
        total = np.full(len(x), self.bias)
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.cut[t, at])
            total += self.leaf[t, at - inner]
        return total


def fit(x: np.ndarray, y: np.ndarray, direction: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss; `direction` holds +1, -1 or 0 for each feature.

    No rows, or rows of one class, give trees that add nothing to a neutral bias.
    """
    rows, width = x.shape
    inner = (1 << depth) - 1
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), 0.0)
    if rows == 0 or y.min() == y.max():
        return Trees(model.feature[:0], model.cut[:0], model.leaf[:0], 0.0)
    share = y.mean()
    model.bias = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    margin = np.full(rows, model.bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(rows, np.int64)
        bound = {0: (-np.inf, np.inf)}
        for k in range(inner):
            here = np.flatnonzero(node == k)
            lo, hi = bound.get(k, (-np.inf, np.inf))
            best = (1e-6, None)
            total_g, total_h = g[here].sum(), h[here].sum()
            for f in range(width) if len(here) > 1 else ():
                size = len(cuts[f]) + 1
                gs = np.cumsum(np.bincount(binned[here, f], g[here], size))[:-1]
                hs = np.cumsum(np.bincount(binned[here, f], h[here], size))[:-1]
                left, right = np.clip(-gs / (hs + ridge), lo, hi), np.clip(-(total_g - gs) / (total_h - hs + ridge), lo, hi)
                gain = gs**2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) - total_g**2 / (total_h + ridge)
                gain[(hs < 1e-3) | (total_h - hs < 1e-3) | (direction[f] * (right - left) < 0)] = -1
                if len(gain) and gain.max() > best[0]:
                    b = int(gain.argmax())
                    best = (gain[b], (f, b, left[b], right[b]))
            left_bound = right_bound = (lo, hi)
            if best[1]:
                f, b, left, right = best[1]
                model.feature[t, k], model.cut[t, k] = f, cuts[f][b]
                middle = (left + right) / 2
                if direction[f] > 0:
                    left_bound, right_bound = (lo, middle), (middle, hi)
                elif direction[f] < 0:
                    left_bound, right_bound = (middle, hi), (lo, middle)
                node[here] = 2 * k + 1 + (binned[here, f] > b)
            else:
                node[here] = 2 * k + 1
            bound[2 * k + 1], bound[2 * k + 2] = left_bound, right_bound
        for leaf in range(inner + 1):
            here = node == inner + leaf
            value = -g[here].sum() / (h[here].sum() + ridge) if here.any() else 0.0
            model.leaf[t, leaf] = rate * np.clip(value, *bound[inner + leaf])
        margin += model.leaf[t, node - inner]
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on the labelled documents with the smallest hashes of doc_id, `sample_rows` at most.

    Rows of labels with a null doc_id or quality, or without a document, don't count; a doc_id labelled twice counts as
    good only if both say so.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    sample = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    names = list(FEATURES)

    def measure(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                x = feature_matrix(statistics(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), *(pa.array(x[:, f]) for f in range(len(names)))], ["doc_id", "quality", *names])

    rows = texts.mapInArrow(measure, "doc_id long, quality int, " + ", ".join(f"{k} double" for k in names)).dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    return fit(rows[names].to_numpy(np.float64).reshape(-1, len(names)), rows["quality"].to_numpy(np.float64), list(FEATURES.values()))


def _judged(column: pa.Array, model: Trees, at_least: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    stats = statistics(column)
    failed = (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])
    chance = 1 / (1 + np.exp(-model.score(feature_matrix(stats))))
    return stats, failed, chance, ~failed & (chance >= at_least)


def judged(docs: DataFrame, model: Trees, at_least: float = 0.5) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept, quality) for each row of docs.

    base_failed: under 10 words, or over a fifth of the words in repeated runs of five; quality: the trees' chance of good
    quality; kept: not base_failed and quality >= at_least.  A null or empty text fails.
    """
    trees = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                stats, failed, chance, kept = _judged(part.column("text"), trees.value, at_least)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(stats[k].astype(np.int64)) for k in COUNTS), pa.array(failed), pa.array(kept), pa.array(chance)], ["doc_id", *COUNTS, "base_failed", "kept", "quality"])

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, kept boolean, quality double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Trees, at_least: float = 0.5) -> DataFrame:
    """The rows of docs that are kept, all columns unchanged."""
    trees = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                yield part.filter(pa.array(_judged(part.column("text"), trees.value, at_least)[3]))

    return docs.mapInArrow(run, docs.schema)


def op1_boosted_trees(spark, sf_dir: str) -> DataFrame:
    """judged() of all documents by trees fitted on the labelled ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
