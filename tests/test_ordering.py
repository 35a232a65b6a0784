import random

from instants import at

from pyspark.sql import Window
from pyspark.sql import functions as F

from plantlake.operators.ordering import dense_number, with_last_before, with_next


def skewed(spark, n=600, seed=3):
    """One key holds most rows, over few days; further keys have one or two."""
    rng = random.Random(seed)
    start = at("2024-01-01T00:00:00").timestamp()
    seen = {("hot" if i % 3 else f"k{i}", start + rng.randrange(6 * 86400)) for i in range(n)}
    return spark.createDataFrame(sorted(seen), "key string, s double").select("key", F.timestamp_seconds("s").alias("seq"))


def test_with_next_equals_lead(spark, rows):
    df = skewed(spark)
    plain = df.withColumn("nxt", F.lead("seq").over(Window.partitionBy("key").orderBy("seq")))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for partitions, batch, coalesced in ((1, 10_000, "true"), (7, 1, "false"), (7, 3, "false"), (40, 10_000, "false"), (900, 10_000, "true")):
            for k, v in zip(before, (partitions, batch, coalesced), strict=True):
                spark.conf.set(k, str(v))
            assert rows(with_next(df, ["key"], "seq", "nxt")) == rows(plain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_with_next_of_several_keys_and_of_nothing(spark, rows):
    df = spark.range(200).selectExpr("id % 3 AS a", "cast(id % 2 AS string) AS b", "id * 7 % 200 AS seq", "array(id) AS other")
    plain = df.withColumn("nxt", F.lead("seq").over(Window.partitionBy("a", "b").orderBy("seq")))
    assert rows(with_next(df, ["a", "b"], "seq", "nxt")) == rows(plain)
    assert with_next(df.filter("false"), ["a", "b"], "seq", "nxt").count() == 0


def test_with_next_reads_its_input_once(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "feed"))
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(str(tmp_path / "feed"))
    # The aggregate shuffles what was read, as in a history; sampling and sorting start from there.
    once = df.mapInArrow(passing, df.schema).groupBy("key", "seq").agg(F.count("*").alias("n"))
    with_next(once, ["key"], "seq", "nxt").collect()
    assert read.value == df.count()


def test_with_next_on_numbers(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 3_000_000), ("a", 7), ("b", 1)], "key string, seq long")
    assert rows(with_next(df, ["key"], "seq", "nxt")) == [("a", 3_000_000, None), ("a", 5, 7), ("a", 7, 3_000_000), ("b", 1, None)]


def test_dense_number_is_the_row_number(spark, rows):
    df = skewed(spark).repartition(5)
    plain = df.withColumn("n", (F.row_number().over(Window.orderBy("key", "seq")) - 1).cast("long"))
    assert rows(dense_number(df, ["key", "seq"], "n")) == rows(plain)


def test_dense_number_of_nothing(spark):
    assert dense_number(spark.createDataFrame([], "id int"), ["id"], "n").count() == 0


def test_with_last_before_equals_the_window(spark, rows):
    df = skewed(spark).withColumn("v", F.when(F.abs(F.hash("key", "seq")) % 4 == 0, F.hash("seq")))
    earlier = Window.partitionBy("key").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("prev", F.last("v", ignorenulls=True).over(earlier))
    for unit in ("hour", "day", "year"):
        assert rows(with_last_before(df, ["key"], "seq", "v", "prev", unit)) == rows(plain)
