import pytest

#: Columns whose names clash with those that operators use inside.
EXTRA = ("key", "fp", "rep", "spans", "first", "line", "site", "n", "kept", "window", "_gone", "component", "doc")
LONG = " ".join(f"w{k % 997}" for k in range(30_000))
TEXTS = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, LONG), (6, LONG + " end"), (7, "x" * 100_000), (None, "a row without an id has words too"),
    (9, "Été à la plage — 漢字 😀 ▁ ok\nline two\nline two\n\nline two"), (10, "tie tie tie tie tie tie tie tie"), (10, "tie tie tie tie tie tie tie tie"), (12, "\x00 \x0b\x0c control \x1f chars \\ ### </turn>"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "en", None if i == 3 else f"src{(i or 0) % 3}", len(t or ""), *(f"{c}{k}" for c in EXTRA)) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)).repartition(3)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}
