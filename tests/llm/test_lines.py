import hashlib
from collections import defaultdict

from tidemark.llm import lines as ln


def brute(rows, least):
    sites, first = defaultdict(set), {}
    for i, text, source in rows:
        for x in (text or "").split("\n"):
            if x.strip(" "):
                sites[x.strip(" ")].add(source or "")
                if i is not None:
                    first[x.strip(" ")] = min(i, first.get(x.strip(" "), i))
    out = []
    for i, text, _ in rows:
        if text is None:
            out.append((str(i), 0, 0, ""))
            continue
        all_lines = text.split("\n")
        kept = [x for x in all_lines if i is None or not x.strip(" ") or len(sites[x.strip(" ")]) < least or first[x.strip(" ")] == i]
        out.append((str(i), len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_equals_brute_force(docs, edge):
    for df, least in ((docs, 10), (docs, 3), (edge, 2)):
        got = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.text) for r in ln.dedup(df, least).collect())
        assert got == brute(rows_of(df), least)
    assert any(r[2] for r in brute(rows_of(docs), 3))


def test_near_and_far_counts(spark):
    rows = [(100 * n + k, f"line {n}\nown {n} {k}", f"s{k}") for n in (1, 8, 9, 10, 11, 13, 60) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = {r.doc_id for r in ln.dedup(df, 10).where("n_removed > 0").collect()}
    assert cut == {100 * n + k for n in (10, 11, 13, 60) for k in range(1, n)}


def test_clean_keeps_columns_and_counts(docs, edge, empty):
    out = ln.clean(docs, 3)
    assert out.schema == docs.schema
    kept = {r.doc_id: r for r in out.collect()}
    for i, n, cut, text in brute(rows_of(docs), 3):
        if cut and not text.strip():
            assert int(i) not in kept
        else:
            assert kept[int(i)].text == text and kept[int(i)].n_chars == len(text)
    assert ln.clean(empty).count() == 0
    assert ln.clean(edge, 2).columns == edge.columns
    assert ln.clean(edge, 2).count() == edge.count() - 1  # the copy of "one"


def test_digest_and_empty(edge, empty):
    plain = {(r.doc_id, r.text) for r in ln.dedup(edge, 2).collect()}
    assert {(r.doc_id, r.text) for r in ln.dedup(edge, 2, digest=True).collect()} == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in plain}
    assert ln.dedup(empty).count() == 0
