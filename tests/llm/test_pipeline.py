"""The stages one after the other, each on its own input."""

import re

import corpus_pipeline
from tarmac.llm import suffix_decontamination as sd
from tarmac.llm.tables import staged, table
from tests.llm.test_hyperminhash import brute


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = staged(stage(spark, seen, small), name)
        assert done.columns == docs.columns
        own = [(r.doc_id, r.text) for r in seen.collect()]
        kept = {r.doc_id: r for r in done.collect()}
        if name == "language_id":
            assert {i for i, t in own if re.search(r"[^\W\d_]{3}", t)} <= set(kept)
        elif name == "near_dedup":
            assert set(kept) == {int(row[0]) for row in brute(own) if row[3]}
        elif name == "decontamination":
            hit = {r.doc_id for r in sd.find_passages(seen, table(spark, small, "benchmark")).collect() if r.contaminated}
            assert hit and set(kept) == {i for i, _ in own} - hit
        else:
            assert set(kept) == {i for i, _ in own}
            assert any(kept[i].text != t for i, t in own)
            assert not any(re.search(r"@mail\d*\.example\.com", r.text) for r in kept.values())
        assert all(r.source == before[i].source and r.lang == before[i].lang for i, r in kept.items())
        seen = done
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen, small)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in seen.collect()}


def test_run_equals_the_stages_on_edge_rows(spark, edge_docs, small, tmp_path):
    for name, frame in (("documents", edge_docs), ("benchmark", table(spark, small, "benchmark"))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {4, 5, 7, 8, None}
    edge_docs.where("doc_id < 0").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_an_empty_benchmark_removes_nothing(spark, edge_docs, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.decontamination(spark, edge_docs, str(tmp_path))
    assert kept.schema == edge_docs.schema and kept.count() == edge_docs.count()
