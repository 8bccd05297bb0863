"""The pipeline's stages, and what is registered."""

import corpus_pipeline
from ledgerline.llm import simhash
from ledgerline.llm.registry import QUERIES
from tests.llm.conftest import SF, documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_run_keeps_what_the_stages_should_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*COLUMNS, "shard", "slot"]
    assert out.select("shard").distinct().count() == 40
    texts = [r.text for r in out.collect()]
    assert texts and set(texts) <= {r.text for r in docs.collect()}
    # A document is taken twice at most, and no two documents are equal.
    assert len(texts) <= 2 * len(set(texts))
    assert out.select("doc_id").distinct().count() == len(set(texts))


def test_stages_on_edge_rows_and_none(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        size = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns), name
            if name in ("toxicity", "sharding", "benchmark leaks"):
                assert out.count() == size, name
        kept = simhash.near_duplicates(docs).where("keep").select("doc_id", "text_hash").distinct()
        assert corpus_pipeline.drop_near_copies(spark, docs, SF).count() == kept.count()


def test_a_leak_goes_and_its_neighbours_stay(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = documents(spark, [(1, f"before {item} after", "a"), (2, "before after", "a"), (2, None, None)])
    assert [r.doc_id for r in corpus_pipeline.drop_leaks(spark, docs, SF).collect()] == [2, 2]
