from tidemark import shared


def test_written_tables(spark):
    df = shared.written(spark.range(10), "ten")
    assert df.count() == 10 and shared.folder(spark).startswith("file:")
    again = shared.written(df.where("id < 3"))
    shared.dropped(df)
    assert again.count() == 3
    shared.dropped(spark.range(1))  # not one of ours
    shared.cleared(spark)
    assert shared.written(spark.range(2)).count() == 2


def test_package_is_sent_once(spark):
    shared.ship(spark)
    before = len(spark.sparkContext._python_includes)
    shared.ship(spark)
    assert len(spark.sparkContext._python_includes) == before


def test_tables_since_a_mark_go(spark):
    before = shared.written(spark.range(3), "before")
    since = shared.mark()
    way, out = shared.written(spark.range(4), "way"), shared.written(spark.range(5), "out")
    shared.dropped_since(spark, since, out)
    assert out.count() == 5 and before.count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(way._written_at)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    shared.dropped(before)
    shared.dropped(before)
    assert out.count() == 5


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    assert shared.folder(session("local[4]")).startswith("file:")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared.folder(session(master))
