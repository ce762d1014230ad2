import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tidemark.llm import sentencepiece_bpe as sp


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.default_model())


@pytest.fixture(scope="module")
def v():
    return sp.vocabulary(sp.default_model())


PARTS = ["a", "b", "e", "t", "h", " ", "▁", "é", "ß", "\n", "\t", "漢", "字", "😀", "​", "x", "0", "1", "<", "s", ">", ".", ",", "  ", "the", "ing", "\x00", "ﬁ", "aaaa", "abab", "\r", "    ", "▁▁▁"]
ODD = ["", " ", "a" * 5000, "ab" * 3000, " " * 3001 + "x", " " * 777, "▁" * 50, "aba" * 999 + " " + "nana" * 500, "=-" * 700, "\n" * 300, "hahaha" * 800, "<s> </s> <0x41> <unk>"]


def test_equals_the_library(library, v):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ODD
    want = [[*library.encode(t), 2] for t in texts]
    encoder = sp.Encoder(v)
    for _ in range(2):  # the second time from what it remembers
        assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    assert [sp.decode_ids(v, np.array(x)).decode() for x in want] == [library.decode(x) for x in want]


def test_units_with_one_hash_stay_apart(library, v, monkeypatch):
    from tests.llm.test_textbuf import thue_morse

    texts = [t for n in (10, 11, 12) for t in thue_morse(n)] + ["one two one", "two one two"]
    want = [[*library.encode(t), 2] for t in texts]
    assert [x.tolist() for x in sp.Encoder(v).encode(pa.array(texts))] == want
    monkeypatch.setattr(sp.tb, "xxh64", lambda data, starts, ends: (ends - starts).astype(np.uint64) % 2)
    encoder = sp.Encoder(v)
    for t, w in zip(texts, want, strict=True):  # from one text to the next too
        assert encoder.encode(pa.array([t]))[0].tolist() == w
    assert [x.tolist() for x in sp.Encoder(v).encode(pa.array(texts))] == want


def test_decoding_of_any_ids(library, v):
    rng = random.Random(2)
    for _ in range(4000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31_999)]) for _ in range(rng.randint(0, 9))]
        assert sp.decode_ids(v, np.array(ids, int)).decode() == library.decode(ids)


def test_single_and_simultaneous_merges_agree(v):
    data = np.frombuffer(" banana nanana aaaaaaa ababab".encode(), np.uint8)
    starts = np.array([0, 7, 14, 22])
    sym, unit = sp._symbols(v, data, starts, np.append(starts[1:], len(data)))
    one = sp._merge(v, sym.copy(), unit.copy(), 4, True)
    many = sp._merge(v, sym.copy(), unit.copy(), 4, False)
    order = lambda r: [r[0][r[1] == k].tolist() for k in range(4)]
    assert not len(many[2]) and order(one) == order(many)


def test_forgetting_starts_over(library, v, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 5)
    encoder = sp.Encoder(v)
    for text in ("one two three", "four five six seven", "one two eight"):
        assert encoder.encode(pa.array([text, None]))[0].tolist() == [*library.encode(text), 2]


def test_over_tables(docs, edge, empty, library):
    for df in (docs, edge):
        rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
        want = sorted(((str(i), [*library.encode(t), 2], library.decode([*library.encode(t), 2])) for i, t in rows), key=str)
        plain = sp.encoded(df)
        assert sorted(((str(r.doc_id), r.ids, r.text) for r in plain.collect()), key=str) == want
        assert sorted((str(r.doc_id), r.text) for r in sp.decoded(plain).collect()) == sorted((w[0], w[2]) for w in want)
        digests = sorted((str(r.doc_id), r.n_tokens, r.ids, r.text) for r in sp.encoded(df, digest=True).collect())
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert digests == sorted((i, len(ids), sha(" ".join(map(str, ids))), sha(t)) for i, ids, t in want)
    assert sp.encoded(empty).count() == 0
