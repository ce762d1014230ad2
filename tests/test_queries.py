import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import adapters, catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    one = lambda v: round(v, 9) if isinstance(v, float) and not math.isnan(v) else [one(x) for x in v] if isinstance(v, list) else v
    return sorted(str([one(r[k]) for k in order]) for r in rows)


KIND = {"long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<double>": "DOUBLE[]"}


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_the_oracle(spark, data, oracle, name):
    df = entry.queries()[name](spark, data)
    result = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.collect(), df.columns) == plain(result.fetchall(), names)
    kinds = {d[0]: str(d[1]) for d in result.description}
    for c, kind in df.dtypes:
        assert kinds[c] == KIND.get(kind.replace("bigint", "long"), kind) or kinds[c] in ("BIGINT", "HUGEINT", "INTEGER") and kind in ("bigint", "int"), (c, kind, kinds[c])


def test_coregistered_raster_is_the_reference(spark, data):
    """The second raster is the first one moved by a row and two columns: moved back, it is the first one wherever it has pixels."""
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL) == {"coregister"}
    at = data.replace("sf0.001", "sf0.01")
    rows = {(r.row, r.col): r.first for r in adapters.dense(spark, at).collect()}
    got = catalogue.QUERIES["coregister"](spark, at).collect()
    inside = [r for r in got if 40 <= r.row < 90 and 2 <= r.col < 126]
    assert len(got) == len(rows) and len(inside) == 50 * 124
    assert all(abs(r.out - rows[r.row, r.col]) < 4 and abs(r.shift_row - 1) < 0.01 and abs(r.shift_col - 2) < 0.01 for r in inside)  # of values to 1009


def test_extents_of_boxes(spark):
    """Length runs along the longitudes, width along the latitudes, whichever corner stands first."""
    from tidemark.plans import pipelines

    boxes = spark.createDataFrame([(1, 34.0, 126.0, 34.1, 126.5), (2, 34.1, 126.5, 34.0, 126.0), (3, 34.0, 126.0, 34.2, 126.1)], "id long, LatMin double, LonMin double, LatMax double, LonMax double")
    got = {r.id: (r.length_m, r.width_m) for r in pipelines.centres(boxes).collect()}
    metres = lambda degrees: math.radians(degrees) * 6_371_000 * math.cos(math.radians(35))
    for k, want in ((1, (0.5, 0.1)), (2, (0.5, 0.1)), (3, (0.1, 0.2))):
        assert all(abs(x - metres(y)) < 1e-6 for x, y in zip(got[k], want, strict=True))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "lon", "lat", "length_m", "width_m", "date", "region"] and df.count() > 0


def test_plans(spark, data):
    def plan(name):
        return entry.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()

    anti = plan("proximity_anti")
    assert "NestedLoop" not in anti and "Cartesian" not in anti and "LeftAnti" in anti
    assert "Python" not in plan("surface_temp") and "Python" not in plan("ais_synchronised") and "Cartesian" not in plan("box_ciou")
    assert "p_name" not in plan("proximity_anti") and "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan("proximity_anti")


def test_adapters_agree_with_their_sql(spark, data, oracle):
    for name in ("facilities", "confirmed", "ships", "pings", "pixels", "detections"):
        want = oracle.execute(adapters.with_tables(name, f"SELECT count(*) FROM {name}")).fetchone()[0]
        assert getattr(adapters, name)(spark, data).count() == want


def test_imports_without_the_corpus_folder():
    import ast
    from pathlib import Path

    root = Path(entry.__file__).parent
    for path in (root / "tidemark").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n or "corpus_pipeline" in n for n in names), path


def test_calibrated_reaches_every_row_of_tall_scenes(spark, tmp_path):
    keys = [(1 + k % 2, 128 * row + col, 5 + k, None if k == 7 else k % 50) for k, (row, col) in enumerate((row, col) for row in (0, 39, 119, 120, 121, 400, 1171) for col in (0, 31, 64, 127))]
    rows = [(line, key, 1.0, 1.0, part, supp) for line, key, part, supp in keys]
    spark.createDataFrame(rows, "l_linenumber int, l_orderkey long, l_quantity double, l_extendedprice double, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r.scene_id, r.row, r.col): r.sigma for r in catalogue.QUERIES["calibrated"](spark, str(tmp_path)).collect()}

    def sigma(line, row, col, supp):
        at = lambda i, j: 1 + (i * 7 + j * 3 + line) % 5 / 10
        (i, t), (j, u) = divmod(row, 40), divmod(col, 32)
        t, u = t / 40, u / 32
        return ((supp % 50 + 1) / 100 / ((at(i, j) * (1 - u) + at(i, j + 1) * u) * (1 - t) + (at(i + 1, j) * (1 - u) + at(i + 1, j + 1) * u) * t)) ** 2

    assert len(got) == len(keys)
    for line, key, _, supp in keys:
        value = got[line, key // 128, key % 128]
        assert value is None if supp is None else abs(value - sigma(line, key // 128, key % 128, supp)) < 1e-6
