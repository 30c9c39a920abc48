import corpus_pipeline
from vidpulse.llm import jaccard, language, packing, pii, quality
from vidpulse.llm.common import tokenizer_path


def test_stages_run_on_what_the_one_before_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "quality rules", "n-gram Jaccard join", "PII", "packing"]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(apply(spark, docs, sf_dir).collect(), docs.schema)
        own = {r.doc_id for r in after.collect()}
        assert after.columns == columns and own <= kept
        if name == "language ID":
            found = language.predict(docs, language.learn(docs)).filter("rejected")
            assert kept - own == {r.doc_id for r in found.collect()}
        if name == "quality rules":
            assert own == {r.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
        if name == "n-gram Jaccard join":
            found = jaccard.jaccard_components(docs).filter("doc_id = component_id")
            assert own == {r.doc_id for r in found.collect()} and len(own) < len(kept)
        if name == "PII":
            assert own == kept
            texts = {r.doc_id: r.text for r in pii.pseudonymise(docs, pii.secret_of(spark, pii.TRIAL_KEY)).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == texts
        docs, kept = after, own
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept
    ends = packed.groupBy("sequence_id").sum("length").collect()
    assert sum(r["sum(length)"] != packing.WINDOW for r in ends) <= 1


def test_run_gives_the_stages_result(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.count() > 0 and got.select("doc_id").distinct().count() > 0
    assert {"doc_id", "start", "length", "sequence_id", "offset", "piece_ids"} <= set(got.columns)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, apply in corpus_pipeline.STAGES[:-1]:
            after = apply(spark, docs, "")
            assert after.columns == docs.columns
            after.count()
        assert packing.pack(docs, tokenizer_path()).count() >= docs.count()
