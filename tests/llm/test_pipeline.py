import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lingofold.llm import exact_dedup, mixing, near_dedup, piece_sampling, quality_model

SF = "/root/testdata/sf0.001"
#: Names that the stages use themselves, or used to.
CLASHES = (
    "score predicted held_out row id hash_key text_sha256 keep_id kept gone copies taken_id taken size __copies __id "
    "__key __sha __no component label sample ids n_shingles"
).split()


def with_clashes(docs):
    return docs.withColumns({name: F.lit(f"x {name}") for name in CLASHES})


def test_stages_keep_columns_and_take_effect(spark):
    docs = with_clashes(spark.read.parquet(f"{SF}/documents.parquet"))
    columns, before = docs.columns, docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stage_table(stage(spark, before, SF), "test-stage")
        if number < 4:
            assert docs.columns == columns and 0 < docs.count()
            assert docs.where(" or ".join(f"`{name}` is null or `{name}` <> 'x {name}'" for name in CLASHES)).count() == 0
        if number == 0:
            model = quality_model.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            want = quality_model.score_quality(before, model).where("predicted = 1")
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in want.collect())
        if number == 1:
            assert docs.count() == exact_dedup.exact_dedup(before).where("kept").count()
        if number == 2:
            assert docs.count() == near_dedup.near_dedup(before).where("kept").count()
        if number == 3:
            taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(before).collect()}
            times = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert times == {i: -(-t // n) for i, (t, n) in taken.items() if t}
        before = docs if number < 4 else before
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {
        r.doc_id for r in before.select("doc_id").distinct().collect()
    }
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == texts[r.doc_id] for r in piece_sampling.decode(docs).collect())


@pytest.mark.parametrize("empty", [True, False])
def test_stages_on_odd_rows_and_empty_tables(spark, make_docs, odd_rows, empty):
    docs = with_clashes(make_docs([] if empty else odd_rows))
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stage_table(stage(spark, docs, SF), "odd-stage")
        assert number == 4 or out.columns == docs.columns
        assert out.count() == 0 or not empty
        if not empty and number in (1, 2):  # each stage on the odd rows themselves
            kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
            assert kept == ([1, 3, 4, 6, 7, 9, 10] if number == 1 else [1, 2, 3, 4, 7])
        if empty:
            docs = out if number < 4 else docs


def test_workers_get_small_batches(spark, make_docs, odd_rows, tmp_path, monkeypatch):
    make_docs(odd_rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    conf, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(conf)
    write = corpus_pipeline.stage_table
    monkeypatch.setattr(corpus_pipeline, "stage_table", lambda df, name: seen.append(spark.conf.get(conf)) or write(df, name))
    corpus_pipeline.run(spark, str(tmp_path))
    assert [int(n) for n in seen] == [1000] * 5
    assert spark.conf.get(conf) == before
