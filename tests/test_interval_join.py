import random

import pytest
from instants import at

from pyspark.sql import functions as F

from plantlake.operators.interval_join import CANDIDATES, CHUNKS, bucket_unit, join_valid_at, most_versions
from plantlake.operators.scd2 import END, START, apply_scd2

METHODS = ["direct", "bucketed", "auto"]


def joined(facts, versions, method, unit=None):
    return join_valid_at(facts, versions, ["m"], "ts", START, END, ["sk"], method=method, unit=unit)


@pytest.mark.parametrize("method", METHODS)
def test_bounds(spark, rows, method):
    versions = spark.createDataFrame(
        [("a", at("2024-01-01T10:00:00"), at("2024-01-01T10:20:00"), 1), ("a", at("2024-01-01T10:20:00"), at("2024-01-05T00:00:00"), 2)],
        f"m string, {START} timestamp, {END} timestamp, sk int",
    )
    times = ["2024-01-01T09:59:59", "2024-01-01T10:00:00", "2024-01-01T10:19:59", "2024-01-01T10:20:00", "2024-01-03T00:00:00", "2024-01-05T00:00:00", "2024-01-05T00:30:00"]
    facts = spark.createDataFrame([(i, "a", at(t)) for i, t in enumerate(times)] + [(7, "b", at(times[1])), (8, None, at(times[1])), (9, "a", None)], "id int, m string, ts timestamp")
    got = dict(rows(joined(facts, versions, method), "id", "sk"))
    assert got == {0: None, 1: 1, 2: 1, 3: 2, 4: 2, 5: None, 6: None, 7: None, 8: None, 9: None}


def test_long_hot_history_against_brute_force(spark, rows):
    rng = random.Random(5)
    zero = at("2024-01-01T00:00:00").timestamp()

    def draw(n):
        return [("hot" if i % 3 else f"m{i % 7}", zero + rng.randrange(9 * 86400 * 10) / 10) for i in range(n)]

    starts = sorted(set(draw(400)))
    history = apply_scd2(
        spark.createDataFrame(starts, "m string, s double").select("m", F.timestamp_seconds("s").alias("seq")), ["m"], "seq"
    ).withColumn("sk", F.hash("m", "seq"))
    readings = [(i, m, s) for i, (m, s) in enumerate(draw(900))]
    facts = spark.createDataFrame(readings, "id int, m string, s double").select("id", "m", F.timestamp_seconds("s").alias("ts"))

    key = {(r["m"], r[START].timestamp()): r["sk"] for r in history.collect()}
    want = {}
    for i, m, s in readings:
        begun = [t for n, t in starts if n == m and t <= s]
        want[i] = key[m, max(begun)] if begun else None
    assert most_versions(history, ["m"], START) > CANDIDATES
    assert bucket_unit(history, ["m"], START) == "hour"
    for method, unit in [("direct", None), ("auto", None), *[("bucketed", u) for u in CHUNKS]]:
        assert dict(rows(joined(facts, history, method, unit), "id", "sk")) == want, (method, unit)


def test_bucket_width_follows_the_densest_key(spark):
    def history(step, n=200):
        starts = spark.range(n).select(F.lit("hot").alias("m"), F.timestamp_micros(F.col("id") * step).alias(START))
        return starts.unionByName(spark.range(3).select(F.col("id").cast("string").alias("m"), F.lit("2024-01-01").cast("timestamp").alias(START)))

    steps = {"day": 3_600_000_000, "hour": 240_000_000, "minute": 4_000_000, "second": 100_000, "millisecond": 50, "microsecond": 1}
    for unit, step in steps.items():
        assert bucket_unit(history(step), ["m"], START) == unit


def test_one_machine_with_a_third_of_readings_and_versions(spark, rows, tmp_path):
    """Against brute force; the plan needs no job of its own and reads the facts once."""
    rng = random.Random(8)
    zero = at("2024-01-01T00:00:00").timestamp()

    def draw(n, days):
        return [("hot" if i % 3 == 0 else f"m{i % 40}", zero + rng.randrange(days * 864_000) / 10) for i in range(n)]

    starts = sorted(set(draw(3000, 20)))
    readings = [(i, m, s) for i, (m, s) in enumerate([*draw(6000, 30), ("hot", zero - 5), ("hot", zero + 4e9), ("none", zero), (None, zero)])]
    changes = spark.createDataFrame(starts, "m string, s double").select("m", F.timestamp_seconds("s").alias("seq"))
    apply_scd2(changes, ["m"], "seq").withColumn("sk", F.hash("m", "seq")).write.parquet(str(tmp_path / "versions"))
    facts = spark.createDataFrame(readings, "id int, m string, s double").select("id", "m", F.timestamp_seconds("s").alias("ts"))
    facts.write.parquet(str(tmp_path / "facts"))
    history, facts = spark.read.parquet(str(tmp_path / "versions")), spark.read.parquet(str(tmp_path / "facts"))

    context = spark.sparkContext
    context.setJobGroup("planning", "no job is expected")
    plan = joined(facts, history, "auto")
    assert context.statusTracker().getJobIdsForGroup("planning") == []
    context.setJobGroup("other", "")
    assert plan._jdf.queryExecution().sparkPlan().toString().count(f"{tmp_path}/facts") == 1

    key = {(r["m"], r[START].timestamp()): r["sk"] for r in history.collect()}
    begins = {}
    for m, t in starts:
        begins.setdefault(m, []).append(t)
    want = {}
    for i, m, s in readings:
        begun = [t for t in begins.get(m, ()) if t <= s]
        want[i] = key[m, max(begun)] if begun else None
    assert dict(rows(plan, "id", "sk")) == want


def test_versions_that_start_in_the_future_or_far_apart(spark, rows):
    versions = spark.createDataFrame(
        [("a", at("1990-05-01T00:00:00"), at("2024-01-01T00:00:00"), 1), ("a", at("2024-01-01T00:00:00"), at("2999-01-01T00:00:00"), 2),
         ("a", at("2999-01-01T00:00:00"), None, 3), ("b", at("2024-01-01T00:00:00"), None, 4)],
        f"m string, {START} timestamp, {END} timestamp, sk int",
    )
    times = ["1990-04-30T00:00:00", "1995-01-01T00:00:00", "2024-01-01T00:00:00", "2500-01-01T00:00:00", "2998-12-31T23:59:59", "2999-01-01T00:00:00", "3500-01-01T00:00:00"]
    facts = spark.createDataFrame([(i, "a", at(t)) for i, t in enumerate(times)] + [(9, "b", at(times[-1]))], "id int, m string, ts timestamp")
    assert dict(rows(joined(facts, versions, "auto"), "id", "sk")) == {0: None, 1: 1, 2: 2, 3: 2, 4: 2, 5: 3, 6: 3, 9: 4}
    assert dict(rows(joined(facts, versions.filter("false"), "auto"), "id", "sk")) == dict.fromkeys([*range(7), 9])


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        joined(spark.range(1), spark.range(1), "nearest")
