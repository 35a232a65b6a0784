import itertools
import random
from dataclasses import replace

import pytest
from instants import at

from pyspark.sql import functions as F

from plantlake.operators.quality import primary_key_violations
from plantlake.operators.scd2 import END, START, apply_scd2, with_dense_key, with_hashed_key
from plantlake.session import scratch_path
from plantlake.streaming.scd2_stream import HistoryTarget, stream_history

SCHEMA = "id string, seq timestamp, value string"
T1, T2, T3 = (at(f"2024-01-0{d}T08:00:00") for d in (1, 2, 3))


def changes(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def history(df):
    return apply_scd2(df, ["id"], "seq")


def test_versions_close_each_other(spark, rows):
    df = changes(spark, ("a", T1, "x"), ("a", T3, "z"), ("a", T2, "y"), ("a", T1, "x"), ("b", T2, "q"))
    assert rows(history(df), "id", "value", START, END) == [
        ("a", "x", T1, T2),
        ("a", "y", T2, T3),
        ("a", "z", T3, None),
        ("b", "q", T2, None),
    ]


def test_unchanged_values_still_make_a_version(spark):
    assert history(changes(spark, ("a", T1, "x"), ("a", T2, "x"))).count() == 2


def test_rows_without_key_or_sequence_are_not_applied(spark, rows):
    df = changes(spark, (None, T1, "x"), ("a", None, "y"), ("a", T2, None))
    assert rows(history(df), "id", "value", START, END) == [("a", None, T2, None)]


def test_ties_keep_one_row_whatever_the_order(spark, rows):
    tied = [("a", T1, "x"), ("a", T1, "y"), ("a", T1, None)]
    for order in itertools.permutations(tied):
        assert rows(history(changes(spark, *order)), "id", "value") == [("a", "y")]


def test_tie_break_column_comes_first(spark, rows):
    df = spark.createDataFrame([("a", T1, "z", 1), ("a", T1, "b", 2)], SCHEMA + ", pick int")
    assert rows(apply_scd2(df, ["id"], "seq", ["pick"]), "value", "pick") == [("b", 2)]


def test_hashed_key_is_stable_and_unique(spark, rows):
    few = with_hashed_key(history(changes(spark, ("a", T1, "x"), ("a", T3, "z"))), ["id"], "sk")
    more = with_hashed_key(history(changes(spark, ("a", T1, "x"), ("a", T2, "y"), ("a", T3, "z"))), ["id"], "sk")
    assert set(rows(few, "sk", START)) <= set(rows(more, "sk", START))
    assert primary_key_violations(more, ["sk"]).count() == 0
    assert dict(more.dtypes)["sk"] == "bigint"


def test_dense_key(spark, rows):
    df = history(changes(spark, ("b", T1, "x"), ("a", T3, "z"), ("a", T2, "y")))
    assert rows(with_dense_key(df, ["id"], "sk"), "sk", "id", START) == [(1, "a", T2), (2, "a", T3), (3, "b", T1)]


def streamed(spark, batches, per_trigger=None):
    """Fold the batches in one by one and return the target with the final history."""
    base = scratch_path(spark, "stream")
    target = HistoryTarget(f"{base}/target", ["id"], "seq", surrogate="sk", buckets=4)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{base}/feed")
        reader = spark.readStream.schema(SCHEMA)
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        stream_history(reader.parquet(f"{base}/feed"), target, f"{base}/progress")
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch_for_any_split(spark, rows, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *(at(f"2024-01-{d:02d}T0{h}:00:00") for d in range(1, 9) for h in range(3))]), rng.choice("xyz"))
        for _ in range(90)
    ]
    data += rng.sample(data, 10)
    parts = [changes(spark, *data[i::3]) for i in range(3)]
    whole = with_hashed_key(history(changes(spark, *data)), ["id"], "sk")
    target = streamed(spark, parts)
    got = target.read(spark, whole.drop("sk", START, END).schema)
    assert got.columns == whole.columns
    assert rows(got) == rows(whole)


def test_replay_changes_nothing_and_old_state_stays_readable(spark, rows):
    first = changes(spark, ("a", T1, "x"), ("b", T2, "q"))
    target = streamed(spark, [first])
    before = target.read(spark, first.schema)
    kept = rows(before)
    target.upsert(first, 0)
    assert rows(target.read(spark, first.schema)) == kept
    target.upsert(changes(spark, ("a", T2, "y")), 1)
    assert rows(target.read(spark, first.schema), "id", "value", END) == [("a", "x", T2), ("a", "y", None), ("b", "q", None)]
    assert rows(before) == kept


def test_a_batch_that_failed_before_publishing_leaves_no_trace(spark, rows):
    first = changes(spark, ("a", T1, "x"))
    target = streamed(spark, [first])
    kept = rows(target.read(spark, first.schema))
    lost = first.withColumns({"sk": F.lit(1), START: F.col("seq"), END: F.col("seq"), "bucket": F.lit(0)})
    lost.write.partitionBy("bucket").parquet(f"{target.root}/data/run=lost")
    assert rows(target.read(spark, first.schema)) == kept


def test_only_touched_buckets_are_rewritten(spark):
    target = streamed(spark, [changes(spark, *[(f"k{i}", T1, "x") for i in range(20)])])
    _, before, _ = target.head(spark)
    target.upsert(changes(spark, ("k1", T2, "y")), 1)
    version, after, _ = target.head(spark)
    assert version == 2
    assert sum(before[b] != after[b] for b in before) == 1


def test_nothing_to_apply(spark):
    empty = changes(spark, (None, T1, "x"))
    target = streamed(spark, [empty])
    assert target.head(spark)[:2] == (0, {})
    assert target.read(spark, empty.schema).count() == 0


def test_published_table_follows_the_history(spark, rows):
    first = changes(spark, ("a", T1, "x"), ("b", T2, "q"))
    target = streamed(spark, [first])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub LOCATION '{scratch_path(spark, 'pub')}'")
    assert rows(target.publish(spark, "pub.h", first.schema)) == rows(target.read(spark, first.schema))
    target.upsert(changes(spark, ("a", T2, "y"), ("c", T1, "n"), ("d", T1, "n"), ("e", T1, "n")), 1)
    assert rows(target.publish(spark, "pub.h", first.schema)) == rows(target.read(spark, first.schema))
    assert spark.table("pub.h").count() == 6
    statistics = spark.sql("DESCRIBE EXTENDED pub.h").filter("col_name = 'Statistics'").first()["data_type"]
    assert int(statistics.split()[0]) > 0


def test_a_changed_number_of_buckets_loses_no_key(spark, rows):
    first = changes(spark, *[(f"k{i}", T1, "x") for i in range(20)])
    target = streamed(spark, [first])
    for buckets, late in ((8, ("k3", T2, "y")), (8, ("k4", T2, "y")), (3, ("new", T1, "z"))):
        target = replace(target, buckets=buckets)
        target.upsert(changes(spark, late), 1)
    got = rows(target.read(spark, first.schema), "id", "value", END)
    late = [("k3", "y", None), ("k4", "y", None), ("new", "z", None)]
    want = [(f"k{i}", "x", T2 if i in (3, 4) else None) for i in range(20)] + late
    assert sorted(got, key=str) == sorted(want, key=str)
    assert target.head(spark)[2] == 3 and all(b < 3 for b in target.head(spark)[1])


def test_a_published_table_follows_a_changed_number_of_buckets(spark, rows):
    first = changes(spark, *[(f"k{i}", T1, "x") for i in range(12)])
    target = streamed(spark, [first])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub2 LOCATION '{scratch_path(spark, 'pub2')}'")
    target.publish(spark, "pub2.h", first.schema)
    fewer = replace(target, buckets=2)
    fewer.upsert(changes(spark, ("k1", T2, "y")), 1)
    assert rows(fewer.publish(spark, "pub2.h", first.schema)) == rows(fewer.read(spark, first.schema))
    assert spark.table("pub2.h").count() == 13


def test_numbers_of_versions_stay_when_late_rows_come(spark, rows, monkeypatch):
    from plantlake.operators import scd2

    numbers = scd2.KeyMap(scratch_path(spark, "keys"), ["k"])

    def load(*changes):
        feed = spark.createDataFrame([(k, at(f"2024-01-{d:02d}T00:00:00")) for k, d in changes], "k string, seq timestamp")
        return {(r.k, r[START].day): r.sk for r in numbers.number(apply_scd2(feed, ["k"], "seq"), "sk").collect()}

    first = load(("b", 5), ("a", 3), ("a", 9))
    assert first == {("a", 3): 1, ("a", 9): 2, ("b", 5): 3}
    assert load(("b", 5), ("a", 3), ("a", 9)) == first
    late = load(("b", 5), ("a", 3), ("a", 9), ("a", 1), ("c", 1), ("a", 4))
    assert late == {**first, ("a", 1): 4, ("a", 4): 5, ("c", 1): 6}

    # A load that ends before its block is written leaves no numbers behind.
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            numbers.number(apply_scd2(spark.sql("SELECT 'z' AS k, TIMESTAMP '2024-02-01 00:00:00' AS seq"), ["k"], "seq"), "sk")
    assert load(("a", 3), ("y", 7)) == {("a", 3): 1, ("y", 7): 7}


def test_nothing_to_number(spark):
    from plantlake.operators import scd2

    empty = apply_scd2(spark.createDataFrame([], "k string, seq timestamp"), ["k"], "seq")
    assert scd2.KeyMap(scratch_path(spark, "keys"), ["k"]).number(empty, "sk").collect() == []
