"""What a run shuffles or holds doesn't grow faster than its tables."""

from orolith.operators import items
from orolith.plans import queries as catalog
from orolith.sources import writers
from orolith.streaming import increments

SF = "/root/testdata/sf0.001"


def test_stream_batches_are_writes(spark, monkeypatch):
    batches = []
    resolve = items.resolve
    monkeypatch.setattr(items, "resolve", lambda *a, **k: batches.append(1) or resolve(*a, **k))
    inventory = catalog._inventory
    monkeypatch.setattr(catalog, "_inventory", lambda s, d: inventory(s, d).repartition(5))
    names = {n: spark.conf.get(n, None) for n in increments.STATE}
    found = catalog.stream_incremental_items(spark, SF)
    assert len(batches) == 2  # five files each
    assert found.count() == inventory(spark, SF).count() == found.select("ordinal").distinct().count()
    assert names == {n: spark.conf.get(n, None) for n in increments.STATE}


def test_lines_are_copied_not_sorted_by_one_task(spark, tmp_path, monkeypatch):
    plans, kind = [], type(spark.range(0))
    coalesce = kind.coalesce
    monkeypatch.setattr(kind, "coalesce", lambda self, n: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or coalesce(self, n))
    wanted = [(k, None if k == 5 else "" if k == 7 else f"https://é/{k}\r,\"{k}" if k % 3 else f" {k} ") for k in range(2000)]
    lines = spark.createDataFrame(wanted[::-1], "ordinal long, url string").repartition(7)
    path = f"{tmp_path}/the lines"
    with_parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            writers.write_lines(lines, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_parts)
    assert plans and not any("Sort" in p for p in plans)
    (file,) = (tmp_path / "the lines").glob("part-*")
    assert file.read_bytes().decode() == "".join(f"{u or ''}\n" for _, u in wanted)
    assert [p.name for p in tmp_path.iterdir()] == ["the lines"]
    writers.write_lines(lines.limit(0), path)
    assert spark.read.text(path).isEmpty()
