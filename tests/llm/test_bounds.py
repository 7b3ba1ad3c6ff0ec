"""What one task or the driver holds doesn't grow with the tables."""

import random
from collections import Counter

from pyspark.sql import functions as F

from orolith.llm import common, hardneg, lm


def test_op4_blocks_of_a_file(spark):
    texts = [(k, f"word{k} and some more words") for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    blocks = lm.make_blocks(docs, size=30)
    found = Counter(r[0] for r in blocks.selectExpr("_metadata.file_path").collect())
    assert sum(found.values()) == 40 and max(found.values()) <= 4
    assert sorted(i for r in blocks.collect() for i in r["doc_ids"]) == list(range(40))


def test_op11_broadcasts_rings_alone(spark, monkeypatch):
    plans = []

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.materialize(df, *rest)

    monkeypatch.setattr(hardneg, "materialize", noted)
    rng = random.Random(11)
    rows = [(k, [rng.random() for _ in range(4)], k % 3) for k in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long").repartition(3)
    found = hardneg.hard_negatives(vectors, F.col("vec_id") % 50 == 0)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.count() and max(p.split("Initial Plan")[-1].count("BroadcastHashJoin") for p in plans) == 1  # the table of rings
    assert "BroadcastHashJoin" not in plans[-1]


def test_op11_sample(spark):
    stored = spark.range(20_000, numPartitions=16).selectExpr("array(id, id + 1) AS v", "id % 3 AS label")
    sample = hardneg.choose_sample(stored, 20_000, 3)
    assert sample.shape == (hardneg.SAMPLE, 3) and len(set(sample[:, 0].tolist())) == hardneg.SAMPLE
    assert (sample[:, 1] == sample[:, 0] + 1).all() and not sample[:, 2].any()
    assert (sample == hardneg.choose_sample(stored.repartition(5), 20_000, 3)).all()
    assert len(hardneg.choose_sample(stored.limit(7), 7, 2)) == 7
