import hashlib
import re

import numpy as np
import pytest

from tidemark.llm import wumanber as wm


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=13):
    windows = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (at := tuple(w[k : k + n])) in windows:
                    hit[k : k + n] = [True] * n
                    found |= windows[at]
        found.discard(None)
        out.append((str(i), len(w), sum(hit), sorted(found), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted(((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()), key=str)


ITEMS = [(900, "The of"), (901, "e"), (902, ""), (903, None), (1000, "que le la de un"), (77, "in"), (None, "was is"), (5, "É漢 漢"), (5, "one"), (6, "w1 w2 w3 " + "w4 " * 40)]


@pytest.mark.parametrize("block_mb", [32, 0.02])
def test_equals_brute_force(spark, docs, texts, data, block_mb):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()] + ITEMS
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts.items(), items)
    assert got(wm.contamination(docs, bench, block_mb=block_mb)) == want
    assert sum(w[4] for w in want)


@pytest.mark.parametrize("block_mb", [32, 0.0003])
def test_edges(spark, edge, empty, block_mb):
    bench = spark.createDataFrame([(*i, "x", 1) for i in ITEMS], "item_id long, text string, window string, doc_id int")
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert got(wm.contamination(edge, bench, block_mb=block_mb)) == brute(rows, ITEMS)
    assert wm.contamination(empty, bench, block_mb=block_mb).count() == 0
    none = wm.contamination(edge, bench.limit(0), block_mb=block_mb)
    assert none.count() == len(rows) and none.where("n_hit > 0 or contaminated").count() == 0


@pytest.mark.parametrize("block_mb", [32, 0.02])
def test_clean_keeps_the_rest_unchanged(spark, docs, data, block_mb):
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    bad = {r.doc_id for r in wm.contamination(docs, bench).where("contaminated").collect()}
    out = wm.clean(docs, bench, block_mb=block_mb)
    assert out.schema == docs.schema
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in docs.collect() if r.doc_id not in bad} and bad


def test_search_against_scanning():
    rng = np.random.default_rng(3)
    vocabulary = [f"{c}{k}" for c in "ab" for k in range(6)]
    pick = lambda n: " ".join(rng.choice(vocabulary, n))
    patterns = wm.Patterns([(pick(n).encode(), k) for k, n in enumerate([1, 1, 2, 2, 3, 5, 5, 8, 13, 13, 13] * 3)])
    text = f" {pick(20_000)} "
    place, which = patterns.search(text.encode())
    want = {(m.start(), k) for k, w in enumerate(patterns.windows) for m in re.finditer(f"(?= {w.decode()} )", text)}
    assert set(zip(place.tolist(), which.tolist(), strict=True)) == want and len(place) == len(want)


def test_query(spark, data):
    rows = {r.doc_id: r for r in wm.op6_wu_manber(spark, data).collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    for i, n, hit, found, bad in brute(texts, items):
        r = rows[int(i)]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), bad)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def test_rows_that_share_an_id_stay_rows_with_any_number_of_blocks(spark, edge):
    items = [(k, " ".join(f"x{k}y{j}" for j in range(60))) for k in range(20)] + ITEMS
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()] + [(None, items[0][1]), (None, items[1][1]), (10, items[2][1]), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert wm._blocked(bench, wm.WINDOW, 0.02)[0] > 1
    for block_mb in (32, 0.02):
        assert got(wm.contamination(docs, bench, block_mb=block_mb)) == brute(rows, items)
