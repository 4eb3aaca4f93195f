"""The pipeline's stages on small tables, stage by stage against brute force."""

import corpus_pipeline
from keycadence.llm import neardup, quality

from . import brute


def test_stages(spark, docs, texts, tmp_path):
    frame = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    rows = {r.doc_id: r.text for r in frame.collect()}
    order = [name for name, _ in corpus_pipeline.STAGES]
    assert order == [
        "quality rules", "near dedup", "substring dedup", "personal data", "best-fit packing"
    ]
    current = frame
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, current, "")
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if k < 4:
            assert out.columns == frame.columns
            after = {r.doc_id: r for r in out.collect()}
        if name == "quality rules":
            for i, text in rows.items():
                n, _, symbols, _, repeat = brute.quality(text)
                if n < 10 or 100 * repeat > 20 * n or 10 * symbols > n:
                    assert i not in after
        if name == "near dedup":
            wanted = brute.near_components(rows, 5)
            assert set(after) == {i for i, (_, c) in wanted.items() if i == c}
        if name == "substring dedup":
            repeats = brute.repeated(rows)
            for i, r in after.items():
                assert len(brute.words(r.text)) <= repeats[i].count(False)
                assert r.n_chars == len(r.text)
        if name == "personal data":
            assert all(not brute.personal(r.text) for r in after.values())
        if k < 4:
            rows = {i: r.text for i, r in after.items()}
        current = out
    assert {r.doc_id for r in current.collect()} == set(rows)


def test_stages_on_no_rows(spark, docs):
    frame = docs.limit(0).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1 AS n_chars")
    assert quality.quality_filter(frame).count() == 0
    assert neardup.dedup_filter(frame).count() == 0


def test_run_reads_the_table(spark, docs, tmp_path):
    docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars").filter(
        "doc_id % 3 = 0"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())
