import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plantlake.session import scratch_path
from plantlake.streaming import sinks
from plantlake.streaming.sinks import append_counted, rule_history

RULES = {"even": "id % 2 = 0", "small": "id < 10"}


def test_counts_of_more_batches_than_a_query_remembers_are_kept(spark, rows):
    base = scratch_path(spark, "sinks")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_counts LOCATION '{base}/db'")
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(setting, "2")
    try:
        for load in range(2):
            spark.range(load * 12, load * 12 + 12).repartition(6, F.col("id")).write.mode("append").parquet(f"{base}/in")
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
            totals = append_counted(stream, RULES, "sink_counts.t", f"{base}/progress", f"{base}/counts")
            assert totals == {"total": 12, "even": 6, "small": 10 if load == 0 else 0}
    finally:
        spark.conf.unset(setting)
    history = rule_history(spark, f"{base}/counts")
    assert history.select("batch").distinct().count() > 4
    assert rows(history.groupBy("rule").agg(F.sum("passed"))) == [("even", 12), ("small", 10), ("total", 24)]
    kept = spark.table("sink_counts.t")
    assert rows(kept, "id") == [(k,) for k in (0, 2, 4, 6, 8)]
    assert kept.select("_batch").distinct().count() > 1


@pytest.mark.parametrize("lost", ["rows", "counts"])
def test_a_run_that_ends_inside_a_batch_counts_it_once(spark, rows, monkeypatch, lost):
    """The first run ends after the rows were written, before or after their counts."""
    base = scratch_path(spark, "sinks")
    name = f"sink_lost_{lost}.t"
    spark.sql(f"CREATE DATABASE sink_lost_{lost} LOCATION '{base}/db'")
    spark.range(12).write.parquet(f"{base}/in")

    def run():
        stream = spark.readStream.schema("id long").parquet(f"{base}/in")
        return append_counted(stream, RULES, name, f"{base}/progress", f"{base}/counts", ["id"], ["id"])

    whole = sinks.write_counts

    def ends(*args):
        if lost == "counts":
            whole(*args)
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "write_counts", ends)
        with pytest.raises(StreamingQueryException, match="the driver is gone"):
            run()
    assert spark.table(name).count() == 0
    assert run() == {"total": 12, "even": 6, "small": 10}
    assert rows(spark.table(name), "id") == [(k,) for k in (0, 2, 4, 6, 8)]
    assert rows(rule_history(spark, f"{base}/counts"), "rule", "passed") == [("even", 6), ("small", 10), ("total", 12)]
    assert run() == {}
    assert spark.table(name).count() == 5


def test_a_clustered_batch_gets_ranges_for_its_rows(spark, rows, monkeypatch):
    """A batch of few rows has one range, for which no bounds are sampled."""
    base = scratch_path(spark, "sinks")
    spark.sql(f"CREATE DATABASE sink_ranges LOCATION '{base}/db'")
    spark.range(24).coalesce(1).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").parquet(f"{base}/in")
    cut, ranges = sinks.spread_by_range, []

    def counted(*args, **kwargs):
        laid_out = cut(*args, **kwargs)
        ranges.append(laid_out.select(F.spark_partition_id().alias("p")).distinct().count())
        return laid_out

    monkeypatch.setattr(sinks, "spread_by_range", counted)
    for name, least in (("one", 100), ("many", 4)):
        monkeypatch.setattr(sinks, "RANGE_ROWS", least, raising=False)
        append_counted(stream, RULES, f"sink_ranges.{name}", f"{base}/{name}", f"{base}/{name}-counts", ["id"], ["id"])
        assert rows(spark.table(f"sink_ranges.{name}"), "id") == [(k,) for k in (0, 2, 4, 6, 8)]
    assert ranges[0] == 1 and ranges[1] > 4  # a shuffle of this session has four
