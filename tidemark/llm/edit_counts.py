"""Edit-aware token counts.

A document's pre-tokens stand in the leaves of a segment tree whose nodes sum characters, pre-tokens and tokens.
An edit finds its leaf by walking the character sums, takes the pre-tokens it touches and two before them (a pre-token's match looks
at most into the second character after the next one's start), splits from there until a new boundary
falls on an old one behind the edit, encodes only those pre-tokens, and updates the sums on the way up.

trees() gives the trees of a table of documents as a table, which can be written, and edited() applies edits to such a table: a later
run splits and encodes nothing but what its edits touch.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb

#: Pre-tokens of a leaf when a tree is built; a leaf that has grown beyond twice as many is split.
LEAF = 64
#: Pre-tokens before an edit that are split again.
CONTEXT = 2
#: Distinct pre-tokens whose token counts a worker remembers before it starts over.
REMEMBERED = 500_000
#: Characters that are split in one step behind an edit.
STEP = 256
#: The edit script of the query: addresses and long numbers give way to a tag.
REDACTIONS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
    (r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", "<address>"),
    (r"\+?[0-9][0-9() -]{7,}[0-9]", "<number>"),
)


def default_ranks() -> tuple[str, str]:
    """(rank file, split pattern) of the installed byte-level vocabulary of 50,256 tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Counter:
    """Tokens of single pre-tokens, by a vocabulary of ranked byte strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import tiktoken

        self.split = regex.compile(pattern)
        self._piece = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self._known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            return [known[p] for p in pieces]
        except KeyError:
            for p in set(pieces).difference(known):
                known[p] = len(self._piece(p.encode()))
            return [known[p] for p in pieces]


class TokenTree:
    """The segment tree of one document."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.encoded = 0
        pieces = counter.split.findall(text)
        sizes, tokens = list(map(len, pieces)), self._count(pieces)
        self.encoded = 0  # what edits have had encoded
        self._build([text[:0] + "".join(pieces[i : i + LEAF]) for i in range(0, len(pieces), LEAF)], [sizes[i : i + LEAF] for i in range(0, len(pieces), LEAF)], [tokens[i : i + LEAF] for i in range(0, len(pieces), LEAF)])

    @classmethod
    def loaded(cls, leaves: list[dict], counter: Counter) -> "TokenTree":
        """The tree of leaves that saved() gave: nothing is split or encoded."""
        tree = cls.__new__(cls)
        tree.counter, tree.encoded = counter, 0
        tree._build([x["text"] for x in leaves], [x["sizes"] for x in leaves], [x["tokens"] for x in leaves])
        return tree

    def saved(self) -> list[dict]:
        """The leaves (text, lengths and token counts of its pre-tokens); sums above them are added up again when they are loaded."""
        return [{"text": t, "sizes": s, "tokens": n} for t, s, n in zip(self.texts, self.sizes, self.tokens, strict=True)]

    def _count(self, pieces: list[str]) -> list[int]:
        self.encoded += len(pieces)
        return self.counter.counts(pieces)

    def _build(self, texts: list[str], sizes: list[list[int]], tokens: list[list[int]]) -> None:
        """Leaves hold their text, piece lengths and token counts; node k's children are 2k and 2k + 1."""
        self.texts, self.sizes, self.tokens = texts or [""], sizes or [[]], tokens or [[]]
        self.width = 1 << (len(self.texts) - 1).bit_length()
        pad = [0] * (self.width - len(self.texts))
        self.chars = [0] * self.width + [len(t) for t in self.texts] + pad
        self.sums = [0] * self.width + [sum(t) for t in self.tokens] + pad
        for k in range(self.width - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.sums[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def _leaf(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of a character position; the end belongs to the last leaf."""
        k, base = 1, 0
        while k < self.width:
            k *= 2
            if at >= base + self.chars[k] and self.chars[k + 1]:
                base += self.chars[k]
                k += 1
        return k - self.width, base

    def _set(self, leaf: int, text: str, sizes: list[int], tokens: list[int]) -> None:
        self.texts[leaf], self.sizes[leaf], self.tokens[leaf] = text, sizes, tokens
        k = leaf + self.width
        self.chars[k], self.sums[k] = len(text), sum(tokens)
        while k > 1:
            k //= 2
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces the characters start..end by `new`."""
        if not 0 <= start <= end <= self.n_chars:
            raise ValueError(f"no characters {start} to {end} in a text of {self.n_chars}")
        leaf, base = self._leaf(max(0, start - 1))
        offsets = [0, *accumulate(self.sizes[leaf])]
        piece = max(0, bisect_right(offsets, max(0, start - 1) - base) - 1) - CONTEXT
        first = leaf
        while piece < 0 and first > 0:  # the context reaches into leaves before
            first -= 1
            base -= len(self.texts[first])
            piece += len(self.sizes[first])
        piece = max(0, piece)
        at = sum(self.sizes[first][:piece])
        last, until = first, base + len(self.texts[first])
        while until < end and last + 1 < len(self.texts):
            last += 1
            until += len(self.texts[last])
        # old boundaries behind the edit, in places of the new text that begins at base + at
        while True:
            old = "".join(self.texts[first : last + 1])
            sizes = [s for x in self.sizes[first : last + 1] for s in x]
            tokens = [s for x in self.tokens[first : last + 1] for s in x]
            ahead = "".join(self.texts[last + 1 : last + 2])[:STEP]  # what a match may look at behind the last leaf
            fresh = old[at : start - base] + new + old[end - base :]
            shift = len(new) - (end - start) - at
            bounds = [0, *accumulate(sizes)]
            behind = {b + shift: k for k, b in enumerate(bounds) if b >= end - base}
            whole = last + 1 >= len(self.texts)
            pieces, met = [], None
            for m in self.counter.split.finditer(fresh + ahead):
                if m.end() > len(fresh) or not whole and m.end() + 2 > len(fresh):
                    break
                pieces.append(m[0])
                if m.end() >= start - base - at + len(new) and m.end() in behind:
                    met = behind[m.end()]
                    break
            if met is None and not whole:
                last += 1
                continue
            if met is None:
                met = len(sizes)
            break
        counts = self._count(pieces)
        sizes = sizes[:piece] + list(map(len, pieces)) + sizes[met:]
        tokens = tokens[:piece] + counts + tokens[met:]
        text = old[: start - base] + new + old[end - base :]
        if first == last and len(sizes) <= 2 * LEAF:
            self._set(first, text, sizes, tokens)
        else:  # several leaves, or one grown too large: deal them out anew
            parts, done = [], 0
            for i in range(0, max(1, len(sizes)), LEAF):
                n = sum(sizes[i : i + LEAF])
                parts.append((text[done : done + n], sizes[i : i + LEAF], tokens[i : i + LEAF]))
                done += n
            if len(parts) <= last - first + 1:
                for k in range(last - first + 1):
                    self._set(first + k, *(parts[k] if k < len(parts) else ("", [], [])))
            else:
                split = [list(x) for x in zip(*parts, strict=True)]
                self._build(self.texts[:first] + split[0] + self.texts[last + 1 :], self.sizes[:first] + split[1] + self.sizes[last + 1 :], self.tokens[:first] + split[2] + self.tokens[last + 1 :])


def edits_by(patterns, text: str) -> list[tuple[int, int, str]]:
    """(start, end, new) for each match of (pattern, new), from the last to the first, none overlapping one before it."""
    found = sorted((m.start(), m.end(), new) for p, new in patterns for m in re.finditer(p, text))
    out, done = [], 0
    for start, end, new in found:
        if start >= done:
            out.append((start, end, new))
            done = end
    return out[::-1]


def counted(docs: DataFrame, patterns=REDACTIONS, ranks: str | None = None, pattern: str | None = None, digest: bool = True) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_edited, n_pretokens, n_encoded) for each row of docs: token counts before and after the edit
    script (matches of patterns replaced), the pre-tokens of the text and those encoded again.  With digest false, also the edited text.

    A null text counts as empty.  Texts of any length are counted whole.
    """
    path, split = default_ranks()
    given = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks or path), pattern or split))
    hint = re.compile(r"[0-9@]") if patterns is REDACTIONS else None

    def run(batches):
        counter = Counter(*given.value)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    tree = TokenTree(text, counter)
                    before, pieces = tree.n_tokens, sum(map(len, tree.sizes))
                    script = edits_by(patterns, text) if hint is None or hint.search(text) else []
                    for start, end, new in script:
                        tree.edit(start, end, new)
                    rows.append((before, len(script), tree.n_tokens, pieces, tree.encoded, None if digest else tree.text()))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                out = [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:5])]
                names = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pretokens", "n_encoded"]
                yield pa.RecordBatch.from_arrays(out if digest else [*out, pa.array(columns[5], pa.string())], names if digest else [*names, "text"])

    schema = "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_pretokens long, n_encoded long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema if digest else f"{schema}, text string")


_LEAVES = pa.list_(pa.struct([("text", pa.string()), ("sizes", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))]))
_TREE = "leaves array<struct<text: string, sizes: array<int>, tokens: array<int>>>"


def trees(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, leaves) for each row of docs: its segment tree, to be written and edited later.  A null text counts as empty."""
    path, split = default_ranks()
    given = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks or path), pattern or split))

    def run(batches):
        counter = Counter(*given.value)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                made = [TokenTree(t or "", counter) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([t.n_tokens for t in made], pa.int64()), pa.array([t.saved() for t in made], _LEAVES)], ["doc_id", "n_tokens", "leaves"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, n_tokens long, {_TREE}")


def edited(trees: DataFrame, edits: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_encoded, leaves): the trees (doc_id, leaves) after edits (doc_id, seq, start, end, new).

    Edits of a document apply in the order of seq, each to the text that those before it left; characters start..end give way to
    `new` (null: nothing).  Documents without edits go through untouched; edits without a document don't count.  n_encoded is the number of
    pre-tokens that had to be encoded.
    """
    path, split = default_ranks()
    given = trees.sparkSession.sparkContext.broadcast((read_ranks(ranks or path), pattern or split))
    script = edits.select(F.col("doc_id").cast("long").alias("_doc"), F.struct("seq", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "new").alias("e"))
    script = script.where("_doc is not null").groupBy("_doc").agg(F.sort_array(F.collect_list("e")).alias("script"))
    rows = trees.select(F.col("doc_id").cast("long").alias("doc_id"), "leaves").join(script, F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "leaves", "script")

    def run(batches):
        counter = Counter(*given.value)
        for batch in batches:
            out = []
            for leaves, script in zip(batch.column("leaves").to_pylist(), batch.column("script").to_pylist(), strict=True):
                tree = TokenTree.loaded(leaves, counter)
                for e in script or ():
                    tree.edit(e["start"], e["end"], e["new"] or "")
                out.append((tree.n_tokens, len(script or ()), tree.encoded, tree.saved()))
            n, k, encoded, saved = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(encoded, pa.int64()), pa.array(saved, _LEAVES)], ["doc_id", "n_tokens", "n_edits", "n_encoded", "leaves"])

    return rows.mapInArrow(run, f"doc_id long, n_tokens long, n_edits long, n_encoded long, {_TREE}")


def op5_edit_aware_counts(spark, sf_dir: str) -> DataFrame:
    """counted() of all documents before and after their redactions."""
    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
