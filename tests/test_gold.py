import datetime as dt

from instants import at

from pyspark.sql import functions as F

from plantlake.operators.scd2 import END, START
from plantlake.plans import alerts, gold
from plantlake.queries import DAILY_AS_OF, _facts, _history

SF = "/root/testdata/sf0.001"
D = dt.date


def versions(spark, *spans):
    """Versions of machine m from (sk, start, end)."""
    df = spark.createDataFrame([(sk, "m", at(a), at(b) if b else None) for sk, a, b in spans], f"machine_sk long, machine_id string, {START} timestamp, {END} timestamp")
    for name in gold.ATTRIBUTES:
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn("machine_timestamp", F.col(START))


def days(rows, history, as_of="2024-01-05", **kw):
    return [(d, sk) for d, sk in rows(gold.dim_machine_daily(history, as_of, **kw), "machine_date", "machine_sk")]


def test_version_at_the_end_of_the_day_owns_it(spark, rows):
    history = versions(spark, (1, "2024-01-01T09:00:00", "2024-01-03T08:00:00"), (2, "2024-01-03T08:00:00", "2024-01-03T20:00:00"), (3, "2024-01-03T20:00:00", None))
    want = [(D(2024, 1, 1), 1), (D(2024, 1, 2), 1), (D(2024, 1, 3), 3), (D(2024, 1, 4), 3), (D(2024, 1, 5), 3)]
    assert days(rows, history) == want
    assert days(rows, history, clustered=True) == want


def test_daily_and_instant_rules_differ(spark, rows):
    history = versions(spark, (1, "2024-01-01T09:00:00", "2024-01-03T08:00:00"), (3, "2024-01-03T08:00:00", None))
    facts = spark.createDataFrame([("r", "m", at("2024-01-03T07:00:00"))], "reading_id string, machine_id string, machine_timestamp timestamp")
    for name in [*gold.MEASURES, "error_code", "is_anomaly", "is_high_temperature", "is_high_pressure", "is_high_vibration"]:
        facts = facts.withColumn(name, F.lit(None).cast("boolean" if name.startswith("is") else "double"))
    assert rows(gold.fact_sensor(facts, history), "machine_sk", "reading_hour", "reading_day_of_week") == [(1, 7, 4)]
    daily = gold.dim_machine_daily(history, "2024-01-05")
    assert rows(gold.fact_sensor_agg(facts, daily), "machine_sk", "total_readings", "anomaly_count") == [(3, 1, None)]


def test_clipping_at_both_ends(spark, rows):
    old = versions(spark, (1, "2019-12-30T00:00:00", "2020-01-02T12:00:00"), (2, "2020-01-02T12:00:00", "2020-01-10T00:00:00"))
    assert days(rows, old, "2020-01-03") == [(D(2020, 1, 1), 1), (D(2020, 1, 2), 2), (D(2020, 1, 3), 2)]
    assert days(rows, versions(spark, (1, "2024-02-01T00:00:00", None)), "2024-01-05") == []
    assert days(rows, versions(spark, (1, "2018-01-01T00:00:00", "2019-01-01T00:00:00"))) == []


def test_overlapping_versions_latest_start_wins(spark, rows):
    history = versions(spark, (1, "2024-01-01T00:00:00", None), (2, "2024-01-02T00:00:00", "2024-01-04T00:00:00"))
    assert days(rows, history) == [(D(2024, 1, d), sk) for d, sk in ((1, 1), (2, 2), (3, 2), (4, 1), (5, 1))]


def test_expansion_equals_the_theta_join(spark, rows):
    history = _history(spark, SF)
    spine = gold.calendar(spark, DAILY_AS_OF)
    theta = spine.join(history, (F.col(START).cast("date") <= F.col("machine_date")) & (F.col(END).isNull() | (F.col(END).cast("date") > F.col("machine_date"))))
    assert rows(gold.dim_machine_daily(history, DAILY_AS_OF), "machine_id", "machine_date", "machine_sk") == rows(theta, "machine_id", "machine_date", "machine_sk")


def test_aggregate_first_equals_join_first(spark, rows):
    facts, daily = _facts(spark, SF), gold.dim_machine_daily(_history(spark, SF), DAILY_AS_OF)
    joined = facts.withColumn("machine_date", F.col("machine_timestamp").cast("date")).join(
        daily.select("machine_id", "machine_date", *gold.DAY_ATTRIBUTES), ["machine_id", "machine_date"], "left"
    )
    slow = joined.groupBy("machine_date", "machine_id", *gold.DAY_ATTRIBUTES).agg(
        F.count("*").alias("total_readings"), F.sum(F.col("is_anomaly").cast("int")).alias("anomaly_count"),
        F.round(F.avg("temperature"), 2).alias("avg_temperature"),
    )
    assert rows(gold.fact_sensor_agg(facts, daily), *slow.columns) == rows(slow)


def test_dimension_views(spark, rows):
    history = versions(spark, (1, "2024-01-01T00:00:00", "2024-01-02T00:00:00"), (2, "2024-01-02T00:00:00", None))
    assert rows(gold.dim_machine_h(history), "machine_sk", "is_current") == [(1, False), (2, True)]
    current = gold.dim_machine_a(history)
    assert END not in current.columns
    assert rows(current, "machine_sk") == [(2,)]


def test_calendar_includes_both_ends(spark, rows):
    assert rows(gold.calendar(spark, "2020-01-03")) == [(D(2020, 1, 1),), (D(2020, 1, 2),), (D(2020, 1, 3),)]


def test_alert(spark, rows):
    def verdict(*day_counts):
        agg = spark.createDataFrame([(D(2024, 1, d), a, n) for d, a, n in day_counts], "machine_date date, anomaly_count long, total_readings long")
        return rows(alerts.alert_anomaly_rate(agg, "2024-01-05"))

    assert verdict((4, 20, 100), (3, 100, 100)) == [(20.0, False)]
    assert verdict((4, 201, 1000)) == [(20.1, True)]
    assert verdict((4, None, 10), (4, 5, 10)) == [(25.0, True)]
    assert verdict((3, 9, 10)) == [(None, False)]
