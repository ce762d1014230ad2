import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import substring as ss


def brute(rows, length=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - length + 1):
                at = tuple(w[k : k + length])
                first[at] = min(i, first.get(at, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1) if i is not None else ():
            if first[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        out.append((str(i), len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in df.collect())


@pytest.mark.parametrize("piece", [4 << 20, 50_000, 1])
def test_equals_brute_force(docs, texts, piece, monkeypatch):
    monkeypatch.setattr(ss, "PIECE_BYTES", piece)
    want = brute(texts.items())
    assert got(ss.dedup(docs.repartition(4))) == want
    assert sum(w[2] for w in want) > 1000


def test_small_vocabulary_and_batches(spark):
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for k in range(120)]
    rows += [(200 + k, "the same passage of words stands in very many documents of this table here " + str(k)) for k in range(100)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in ("10000", "7"):  # occurrences of a seed go over the ends of batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            for length, k in ((13, 7), (13, 3), (5, 2), (4, 4)):
                assert got(ss.dedup(df, length, k)) == brute(rows, length)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_long_words_that_differ(spark):
    from tests.llm.test_textbuf import thue_morse

    head = " ".join(f"w{k}" for k in range(12))
    rows = [(k, f"{head} {w}") for k, w in enumerate(w for n in (10, 11, 12) for w in thue_morse(n))]
    rows += [(10, rows[1][1])]
    for parts in (1, 4):
        assert got(ss.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))) == brute(rows)


@pytest.mark.parametrize("many", [1, 4, 2000])
def test_anchors_with_many_occurrences(spark, many):
    rng = random.Random(11)
    stock = "this stock phrase of seven words stands before ever other words"
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(6)) + f" {stock} " + " ".join(rng.choice("ab") for _ in range(8))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert got(ss.dedup(df, many=many)) == want and sum(w[2] for w in want) > 500


def test_rows_that_share_an_id_keep_their_own_spans(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(1, passage), (2, "one two three " + passage + " four"), (2, passage + " five six seven eight"), (2, "nothing of it"), (None, passage)]
    assert got(ss.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_one_anchor_takes_linear_time_and_bounded_state():
    n = 400_000
    docs = np.arange(n)
    anchors = pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int64)), pa.array(docs), pa.array(docs), pa.array(np.zeros(n, np.int32))], schema=ss._SENT)
    cut = lambda b, k: [b.slice(i, 10_000) for i in range(0, k, 10_000)]
    began = time.process_time()
    out = list(ss._joined(iter(cut(anchors, n)), 2000))
    assert sum(b.num_rows for b in out) == n and all(b.column("many").to_pylist()[0] for b in out)
    run = " ".join(f"w{k}" for k in range(13))
    rows = pa.RecordBatch.from_arrays([anchors.column("key"), anchors.column("doc"), anchors.column("at"), pa.array(np.full(n, 3, np.int32)), pa.array([run] * n)], schema=ss._AROUND)
    found = list(ss._extended(iter(cut(rows, n)), 13, 7))
    assert sum(b.num_rows for b in found) == n - 1
    assert time.process_time() - began < 60


def test_edges(edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert got(ss.dedup(edge)) == brute(rows)
    assert ss.dedup(empty).count() == 0


def test_spans_are_maximal(spark):
    a = " ".join(f"a{k}" for k in range(40))
    b = " ".join(f"b{k}" for k in range(20))
    df = spark.createDataFrame([(1, a + " " + b), (2, "x " + a + " y " + b + " z")], "doc_id long, text string")
    r = {x.doc_id: x for x in ss.dedup(df).collect()}
    assert [tuple(s) for s in r[2].spans] == [(1, 41), (42, 62)] and r[2].text == "x y z"
    assert not r[1].spans
    assert [x.tolist() for x in ss.maximal(np.array([40, 6, 19, 5]), np.array([13, 13, 13, 13]))] == [[5, 40], [32, 53]]


def test_digest(docs, spark, data):
    plain = {r.doc_id: r for r in ss.dedup(docs).collect()}
    for r in ss.op8_seed_extend(spark, data).collect():
        assert (r.n_words, r.n_removed, r.kept_sha256) == (plain[r.doc_id].n_words, plain[r.doc_id].n_removed, hashlib.sha256(plain[r.doc_id].text.encode()).hexdigest())
