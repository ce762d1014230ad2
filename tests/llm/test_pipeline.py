import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_simhash import jaccard_groups
from tests.llm.test_wumanber import brute as brute_benchmark
from tidemark.llm import lines, quality
from tidemark.llm.sentencepiece_bpe import default_model


def test_equals_brute_force(spark, data, docs):
    model = quality.train(docs, spark.read.parquet(f"{data}/labels.parquet"))
    kept = {r.doc_id for r in quality.judged(docs, model).where("kept").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in kept]
    after = {int(i): t for i, _, cut, t in brute_lines(rows, lines.MIN_SITES) if not cut or t.strip()}
    group, _ = jaccard_groups(sorted(after.items()))
    after = {i: t for i, t in after.items() if group[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    bad = {int(w[0]) for w in brute_benchmark(after.items(), items) if w[4]}
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    want = {i: [*library.encode(t), 2] for i, t in after.items() if i not in bad}
    got = {r.doc_id: r for r in cp.run(spark, data).collect()}
    assert {i: r.ids for i, r in got.items()} == want
    assert all(r.text == library.decode(r.ids) and r.n_tokens == len(r.ids) for r in got.values())
    assert len(docs.collect()) > len(kept) > len(want)


def test_stages_keep_columns_and_survive_odd_rows(spark, data, edge, empty, docs):
    plain = [c for c in docs.columns]
    for df in (edge, empty):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, df, data)
            assert out.columns == df.columns, name
            assert [out.schema[c].dataType for c in plain] == [df.schema[c].dataType for c in plain]
            assert out.count() <= df.count()
    assert cp.STAGES[-1][1](spark, edge, data).count() == edge.count()


def test_each_stage_writes_and_reads(spark, data, tmp_path, docs):
    df = docs.where("doc_id < 60")
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, df, data).write.parquet(f"{tmp_path}/{k}")
        df = spark.read.parquet(f"{tmp_path}/{k}")
    assert df.select(F.sum("n_tokens")).first()[0] > 0
