import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import quality as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    marked = [False] * len(words)
    for k in range(len(words) - 4):
        if runs[tuple(words[k : k + 5])] > 1:
            marked[k : k + 5] = [True] * 5
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(marked)


def test_counts_equal_brute_force(docs, texts, edge, spark, data):
    model = q.train(docs, spark.read.parquet(f"{data}/labels.parquet"))
    for df in (docs, edge):
        rows = df.select("doc_id", "text").collect()
        got = q.judged(df, model).collect()
        assert len(got) == len(rows)
        want = sorted((str(r.doc_id), *brute(r.text)) for r in rows)
        assert sorted((str(r.doc_id), *(r[c] for c in q.COUNTS)) for r in got) == want
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_lines_and_windows_of_long_words():
    from tests.llm.test_textbuf import thue_morse

    for n in (10, 11, 12):
        x, y = thue_morse(n)
        texts = [f"{x}\n{y}", f"{x}\n{x}", f"a b c d {x} a b c d {y}", f"a b c d {x} a b c d {x}"]
        got = q.statistics(pa.array(texts))
        assert [tuple(int(got[c][k]) for c in q.COUNTS) for k in range(4)] == [brute(t) for t in texts]


def test_model_separates_held_out_labels(spark):
    at = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet").withColumnRenamed("quality", "good")
    model = q.train(docs, labels.where("doc_id % 2 = 0").withColumnRenamed("good", "quality"))
    held = q.judged(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").select("good", "quality").collect()
    assert len(held) > 100
    assert sum((r.quality >= 0.5) == (r.good == 1) for r in held) >= 0.97 * len(held)


def test_monotone_and_flat():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(2000) < 0.15)).astype(float)
    m = q.fit(x, y, [-1, 0, 1], trees=30)
    base = np.tile(rng.random((50, 1, 3)), (1, 40, 1))
    for f, sign in ((0, -1), (2, 1)):
        z = base.copy()
        z[:, :, f] = np.linspace(0, 1, 40)
        s = m.score(z.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(s, axis=1) >= -1e-12).all()

    def walk(row):
        total = m.bias
        for t in range(len(m.feature)):
            k = 0
            while k < m.feature.shape[1]:
                k = 2 * k + 1 + int(row[m.feature[t, k]] > m.cut[t, k])
            total += m.leaf[t, k - m.feature.shape[1]]
        return total

    assert np.allclose(m.score(x[:50]), [walk(r) for r in x[:50]])
    assert ((m.score(x) > 0) == (x[:, 0] < 0.5)).mean() > 0.95


def test_no_labels_and_empty_tables(empty, spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.train(docs, none)
    assert len(model.feature) == 0
    assert q.judged(empty, model).count() == 0
    one_class = spark.createDataFrame([(0, 1), (1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert len(q.train(docs, one_class).feature) == 0
    assert q.keep_good(docs, model).columns == docs.columns


def test_sample_is_bounded(spark, docs, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    assert q.train(docs, labels, sample_rows=5).bias is not None


def test_line_count_of_crlf():
    s = q.statistics(pa.array(["a\r\na\r\nb", "\n\n\n", None]))
    assert s["n_dup_lines"].tolist() == [1, 0, 0]
