"""The pipeline's stages: each works on what the one before kept."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS size", "2 AS copies", "3 AS fp", "4 AS doc", "5 AS n_words")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = corpus_pipeline.materialize(stage(spark, before, SF), name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            assert after.select("doc_id", "text").subtract(before.select("doc_id", "text")).count() == 0
        if name in ("quality", "near_dedup"):
            assert 0 < after.count() <= before.count()
        before_last, before = before, after
    ends = before.groupBy("sequence_id").sum("length")
    assert ends.where("`sum(length)` > 4096").count() == 0
    assert before.select("doc_id").distinct().count() == before_last.select("doc_id").distinct().count()


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing names, through every stage."""
    long, fine = "word " * 30_000, lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    rows = [(1, None, None, None), (None, fine(0), "en", "s"), (2, "", "en", ""), (3, " \n", None, "s"), (4, long, "en", None), (5, fine(1), "en", "s"), (5, fine(1), "en", "s"), (6, fine(1), "en", "t"), (7, fine(2), None, None), (8, fine(3), "de", "s"), (8, fine(4), "de", "s"), (None, fine(5), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS copies", "'x' AS component_id", "2 AS `_row`", "3 AS kept")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda frame: sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=lambda i: (i is None, i or 0))
    good = corpus_pipeline.materialize(stages["quality"](spark, docs, SF), "good")
    assert good.columns == docs.columns and ids(good) == [5, 5, 6, 7, 8, 8, None, None]
    single = corpus_pipeline.materialize(stages["near_dedup"](spark, good, SF), "single")
    assert single.columns == docs.columns and ids(single) == [5, 7, 8, 8, None, None]
    assert ids(stages["near_dedup"](spark, docs, SF)) == [1, 4, 5, 7, 8, 8, None, None]
    mixed = corpus_pipeline.materialize(stages["mixing"](spark, docs, SF), "mixed")
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(ids(docs)) and mixed.count() > 0
    packed = stages["packing"](spark, docs, SF).collect()
    tokens = {}
    for p in packed:
        tokens[p["doc_id"]] = tokens.get(p["doc_id"], 0) + p["length"]
    assert tokens[1] == 1 and tokens[2] == 1 and tokens[4] > 30_000 and set(tokens) == {r[0] for r in rows}


def test_run_on_nothing(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
