"""A pipeline run deletes its own intermediate tables and no others."""

import os

import pytest

pytest.importorskip("public_tokenizers")


def test_results_of_operators_outlive_a_pipeline(spark, sf_dir):
    import corpus_pipeline
    from nutq.llm import kernel, queries

    made = {name: getattr(queries, name)(spark, sf_dir) for name in ("op4_jaccard", "op6_substrings", "op9_quality", "op11_warc", "op13_centroids")}
    finished = kernel.write_table(spark, spark.range(7))
    before = set(kernel._tables)
    first = corpus_pipeline.run(spark, sf_dir)
    second = corpus_pipeline.run(spark, sf_dir)
    assert before <= set(kernel._tables)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(first) == rows(second) and finished.count() == 7
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert [made[n].count() for n in ("op4_jaccard", "op6_substrings", "op9_quality")] == [documents] * 3
    assert made["op11_warc"].count() > 0 and made["op13_centroids"].count() > 0
    # Of each run its results stay, and what the last stages have left.
    assert len([p for p in kernel._tables if p not in before]) <= 2 * len(corpus_pipeline.STAGES) + 2
    assert all(os.path.exists(p.removeprefix("file:")) for p in kernel._tables)
