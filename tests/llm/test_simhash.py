import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash as sh
from tidemark.operators.linked import components


def fingerprint(text, n=3):
    w = re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode()).split()
    runs = [b" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))] if w else []
    h = np.array([xxhash.xxh64_intdigest(r, 42) for r in runs], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(runs))


def grouped(fps):
    """Smallest id of each linked set, for [(id, fingerprint)]."""
    parent = {i: i for i, _ in fps}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    array = np.array([f for _, f in fps], np.uint64)
    for k, (i, f) in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(array[k + 1 :] ^ np.uint64(f)) <= 2) + k + 1:
            a, b = find(i), find(fps[j][0])
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in fps}


@pytest.mark.parametrize("most", [sh.MOST_COMPARED, 0])
def test_equals_brute_force(docs, texts, most):
    got = {r.doc_id: (r.fp % (1 << 64), r.component) for r in sh.near_duplicates(docs, most_compared=most).collect()}
    fps = sorted((i, fingerprint(t)) for i, t in texts.items())
    group = grouped(fps)
    assert got == {i: (f, group[i]) for i, f in fps}
    assert len(set(group.values())) < len(group)


@pytest.mark.parametrize("most", [sh.MOST_COMPARED, 60, 0])
def test_links_of_crowded_fingerprints(spark, most):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {f ^ sum(1 << rng.randrange(64) for _ in range(0)) for f in centres}
    for c in centres:
        for _ in range(120):
            f = c
            for _ in range(rng.randint(1, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    rows = list(enumerate(sorted(fps)))
    distinct = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in rows], "fp long, rep long")
    edges = sh.links(distinct, most)
    label = {r.node: r.component for r in components(edges).collect()}
    assert {i: label.get(i, i) for i, _ in rows} == grouped(rows)


def test_every_half_is_near_exactly_one_anchor(spark):
    rng = random.Random(2)
    halves = [0, 1, (1 << 32) - 1, 1 << 31, *(rng.getrandbits(32) for _ in range(60))]
    df = spark.createDataFrame([(h,) for h in halves], "h long").select("h", sh._anchors(1, F.col("h")).alias("at"))
    anchors = set()
    for r in df.collect():
        keys = [(a.key, a.home) for a in r["at"]]
        assert all(k >> 32 == 1 for k, _ in keys) and [home for _, home in keys] == [True] + [False] * (len(keys) - 1)
        low = r.h & 0x7FFFFFFF
        away = [bin((k & 0x7FFFFFFF) ^ low).count("1") for k, _ in keys]
        assert away[0] <= 1 and all(a == 2 for a in away[1:]) and len(set(keys)) == len(keys) and len(keys) in (1, 16)
        anchors |= {k & 0x7FFFFFFF for k, _ in keys}
    for a in anchors:  # code words: every parity check is even
        assert all(bin(a & m).count("1") % 2 == 0 for m in sh._CHECKS)


def test_edges(edge, empty):
    got = sorted(((str(r.doc_id), r.fp % (1 << 64)) for r in sh.near_duplicates(edge).collect()))
    assert got == sorted((str(r.doc_id), fingerprint(r.text)) for r in edge.select("doc_id", "text").collect())
    zero = {r.component for r in sh.near_duplicates(edge).where("fp = 0").collect()}
    assert zero == {0}
    assert sh.near_duplicates(empty).count() == 0
    kept = sh.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert "None" in ids and ids.count("10") == 2 and "4" not in ids and "1" not in ids and "3" in ids


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 400)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5), (7, 8), (8, 7), (7, 8)]
    random.Random(0).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 100 for k in range(101, 401)} | {1000 + k: 1000 for k in range(1, 200)} | {8: 7}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, data):
    r = sh.op9_simhash_anchors(spark, data).first()
    assert re.fullmatch("[0-9a-f]{16}", r.fingerprint) and r.component_id <= r.doc_id


def jaccard_groups(rows, n=5, least=0.8):
    """(smallest id of each set of documents linked by similarity, pairs of different texts that are similar), by comparing all."""
    sets = []
    for i, t in rows:
        w = re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split()
        sets.append((i, frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()))
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = []
    sets.sort(key=lambda x: len(x[1]))
    for k, (i, s) in enumerate(sets):
        for j, u in sets[k + 1 :]:
            if len(s) < least * len(u):
                break
            if s == u or s and (both := len(s & u)) and both >= least * (len(s) + len(u) - both):
                if s != u:
                    pairs.append((i, j))
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}, pairs


@pytest.mark.parametrize("paired", [sh.PAIRED, 1])
def test_similar_documents_by_brute_force(spark, paired):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, pairs = jaccard_groups(rows)
    got = {r.doc_id: r.component for r in sh.similar(docs, most_paired=paired).collect()}
    assert set(got) == set(want)
    members = {}
    for i, c in got.items():
        members.setdefault(c, []).append(i)
    for c, ids in members.items():
        assert c == min(ids) and len({want[i] for i in ids}) == 1  # nothing unlike is joined
    found = sum(got[i] == got[j] for i, j in pairs)
    assert len(pairs) > 10 and found >= 0.9 * len(pairs)
    assert sum(got[i] != i for i in got) >= 0.98 * sum(want[i] != i for i in want)


@pytest.mark.parametrize("paired", [sh.PAIRED, 1])
def test_many_near_copies_of_one_text(spark, paired):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(300)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(300)] = word()
        rows.append((1000 + k, " ".join(w)))
    rows += [(5000, " ".join(base)), *((k, " ".join(word() for _ in range(100))) for k in range(40))]
    got = {r.doc_id: r.component for r in sh.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), most_paired=paired).collect()}
    assert all(got[k] == k for k in range(40))
    assert sum(got[1000 + k] == 1000 for k in range(150)) >= 140


@pytest.mark.parametrize("paired", [sh.PAIRED, 1])
def test_every_similar_pair_is_linked(spark, paired):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    edited = lambda words, places: [word() if k in places else w for k, w in enumerate(words)]
    texts = []
    for _ in range(60):  # pairs at 0.815, hardly any two of which share all anchors
        base = [word() for _ in range(200)]
        texts += [base, edited(base, {30, 75, 120, 165})]
    long = [word() for _ in range(600)]
    texts += [long[k : k + 200] for k in range(0, 400, 20)]  # a chain, each window similar to the next one only
    base = [word() for _ in range(200)]
    for _ in range(25):  # a crowd of texts that are unlike each other, each with a partner
        other = edited(base, set(rng.sample(range(200), 12)))
        texts += [other, edited(other, {rng.randrange(200), rng.randrange(200), rng.randrange(200)})]
    texts += [[word() for _ in range(n)] for n in (0, 1, 2, 5, 6, 9)] + [long[:4], long[:4], long[:5], long[:9]]
    rows = [(int(i), " ".join(t)) for i, t in zip(rng.sample(range(1000), len(texts)), texts, strict=True)]
    want, pairs = jaccard_groups(rows)
    got = {r.doc_id: r.component for r in sh.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), most_paired=paired).collect()}
    assert got == want and len(pairs) > 100


def test_rest_alone_finds_all_similar_texts(spark, monkeypatch):
    monkeypatch.setattr(sh, "candidates", lambda bodies, most_paired: bodies.select(F.col("body").alias("x"), F.col("body").alias("y")).limit(0))
    monkeypatch.setattr(sh, "_centred", lambda apart, least: apart.select(F.col("body").alias("x"), F.col("body").alias("y")).limit(0))
    monkeypatch.setattr(sh._centred, "__name__", "centred")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, _ = jaccard_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.component for r in sh.similar(docs).collect()} == want


def test_similar_on_odd_rows(edge, empty):
    rows = [r for r in edge.select("doc_id", "text").collect() if r.doc_id is not None]
    want, _ = jaccard_groups([(r.doc_id, r.text) for r in rows])
    got = sorted((r.doc_id, r.component) for r in sh.similar(edge).collect())
    assert got == sorted((r.doc_id, want[r.doc_id]) for r in rows)
    assert sh.keep_one_similar(edge).columns == edge.columns and sh.similar(empty).count() == 0
    kept = sh.keep_one_similar(edge).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted([str(i) for i, c in got if i == c] + ["None"])
