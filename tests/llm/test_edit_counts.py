import random

import pytest
import tiktoken

from tidemark.llm import edit_counts as ec


@pytest.fixture(scope="module")
def counter():
    path, pattern = ec.default_ranks()
    return ec.Counter(ec.read_ranks(path), pattern)


@pytest.fixture(scope="module")
def library():
    path, pattern = ec.default_ranks()
    return tiktoken.Encoding("library", pat_str=pattern, mergeable_ranks=ec.read_ranks(path), special_tokens={})


FRAGMENTS = [" ", "  ", "\n\n", "'s", "'", "ll", "don", "é", "漢", "123", " a", "<email>", "", "x" * 50, "\t", ".", "...", " \n ", "word word word " * 40]
STARTS = ["", "a", "   ", "a   b", "it's  '  ll", " " * 500 + "a" + " " * 300, "x" * 1000, "a b " * 500, "we'll don't 12 34\n\n\n" * 60]


@pytest.mark.parametrize("start", STARTS)
def test_random_edits_count_as_a_full_encoding(start, counter, library):
    rng = random.Random(len(start))
    tree, text = ec.TokenTree(start, counter), start
    for _ in range(60):
        a = rng.randint(0, len(text))
        b = min(len(text), a + rng.choice([0, 0, 1, 2, 5, 30, 600]))
        new = rng.choice(FRAGMENTS)
        text = text[:a] + new + text[b:]
        tree.edit(a, b, new)
        assert tree.text() == text
        assert tree.n_tokens == len(library.encode_ordinary(text))
        assert tree.n_chars == len(text) == sum(map(sum, tree.sizes))


def test_few_pretokens_are_encoded_again(counter):
    tree = ec.TokenTree("some words and more of them, " * 4000, counter)
    tree.edit(50_000, 50_003, "abc")
    assert tree.encoded < 20


def test_edits_out_of_range(counter):
    with pytest.raises(ValueError):
        ec.TokenTree("abc", counter).edit(2, 9, "")


def test_over_tables(docs, edge, empty, library):
    for df in (docs, edge):
        texts = sorted(((str(r.doc_id), r.text or "") for r in df.select("doc_id", "text").collect()))
        got = sorted((str(r.doc_id), r.n_tokens, r.n_tokens_edited, r.text) for r in ec.counted(df, digest=False).collect())
        assert [g[:2] for g in got] == sorted((i, len(library.encode_ordinary(t))) for i, t in texts)
        assert all(g[2] == len(library.encode_ordinary(g[3])) for g in got)
    assert ec.counted(docs).where("n_edits > 0").count() > 0
    assert ec.counted(empty).count() == 0


def test_trees_are_kept_and_edited_again(spark, docs, texts, counter, tmp_path):
    import tiktoken

    ec.trees(docs).write.parquet(f"{tmp_path}/trees")
    library = tiktoken.Encoding("ranks", pat_str=ec.default_ranks()[1], mergeable_ranks=ec.read_ranks(ec.default_ranks()[0]), special_tokens={})
    now = {i: t or "" for i, t in texts.items()}
    rng = random.Random(8)
    for k in range(2):  # each run reads what the one before it wrote
        script = []
        for i in rng.sample([i for i, t in now.items() if len(t) > 400], 40):
            for seq in range(2):
                start = rng.randrange(len(now[i]))
                end, new = min(len(now[i]), start + rng.randrange(6)), rng.choice(["", "x", " two words", None])
                script.append((i, seq, start, end, new))
                now[i] = now[i][:start] + (new or "") + now[i][end:]
        edits = spark.createDataFrame(script, "doc_id long, seq int, start long, end long, new string").repartition(3)
        ec.edited(spark.read.parquet(f"{tmp_path}/trees" + "2" * k), edits).write.parquet(f"{tmp_path}/trees" + "2" * (k + 1))
        rows = spark.read.parquet(f"{tmp_path}/trees" + "2" * (k + 1)).collect()
        assert {r.doc_id: "".join(x.text for x in r.leaves) for r in rows} == now
        assert all(r.n_tokens == len(library.encode(now[r.doc_id], disallowed_special=())) for r in rows)
        touched = [r for r in rows if r.n_edits]
        assert len(touched) == 40 and all(r.n_encoded == 0 for r in rows if not r.n_edits)
        assert 0 < sum(r.n_encoded for r in touched) < 0.1 * sum(len(x.sizes) for r in touched for x in r.leaves)
    assert ec.edited(ec.trees(docs.limit(0)), edits).count() == 0
