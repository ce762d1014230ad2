import duckdb
import pytest

from tidemark.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_the_oracle(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    df = QUERIES[name](spark, data)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r) for r in df.select(names).collect()) == sorted(want.fetchall())


def test_names():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 11))
