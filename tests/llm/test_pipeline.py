"""The corpus pipeline's stages on the small tables and on awkward rows."""

import corpus_pipeline
import duckdb
from recordlens.llm import importance, toxicity
from tests.llm.test_operators import brute_components, brute_tokens, check_packing, empty_docs, odd_docs
from recordlens.llm.vocabularies import public_path


def test_stages_follow_each_other(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, medium).cache()
    scored = toxicity.score(docs, toxicity.model_of_flags(docs, labels)).where("severity < 0.5")
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in scored.select("doc_id").collect()}
    good = corpus_pipeline.draw_good(spark, clean, medium).cache()
    assert {r[0] for r in good.select("doc_id").collect()} == {r[0] for r in importance.resample(clean, labels).where("kept").select("doc_id").collect()}
    one = corpus_pipeline.drop_near_duplicates(spark, good, medium)
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    _, least = brute_components(texts, 5, 80)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(least.values()))
    for stage in (clean, good, one):
        assert stage.columns == docs.columns
    wanted = brute_tokens([(i, texts[i]) for i in set(least.values())], public_path("byte_bpe_50k.json"), 0)
    check_packing(corpus_pipeline.run(spark, medium).collect(), wanted, 2048)


def test_stages_take_odd_and_empty_tables(spark, medium):
    for rows in (odd_docs(spark), empty_docs(spark)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, medium)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, medium).collect()
    kept = corpus_pipeline.drop_near_duplicates(spark, odd_docs(spark), medium).collect()
    # 6 is like 5, 8 like 7, one of two equal rows 10 stays; those without words all stay
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, i) for i in (0, 1, 2, 4, 5, 7, 9, 10)] + [(True, 0)]


def test_all_queries_are_registered():
    assert len(corpus_pipeline.STAGES) == 4 and corpus_pipeline.ORACLE_SQL is None and duckdb.__version__
