from instants import at

from pyspark.sql import Observation

from plantlake.operators import quality
from plantlake.plans import silver

SCHEMA = (
    "reading_id string, machine_id string, timestamp timestamp, temperature double, pressure double, vibration double,"
    " power_consumption double, error_code string, is_anomaly boolean, _rescued string, _loading_ts timestamp"
)


def reading(spark, *changes):
    base = dict(
        reading_id="r", machine_id="m", timestamp=at("2024-01-01T10:00:00"), temperature=20.0, pressure=1.0,
        vibration=1.0, power_consumption=1.0, error_code=None, is_anomaly=False, _rescued="x", _loading_ts=None,
    )
    data = [tuple({**base, **change}.values()) for change in changes]
    return spark.createDataFrame(data, SCHEMA)


def test_rule_bounds(spark):
    kept = [{"temperature": -100.0}, {"temperature": 500.0}, {"pressure": 0.0}, {"vibration": 0.0}, {"power_consumption": 0.0}]
    dropped = [{"temperature": -100.01}, {"temperature": 500.01}, {"temperature": None}, {"pressure": -0.01}]
    dropped += [{"pressure": None}, {"vibration": -1.0}, {"power_consumption": None}]
    dropped += [{"reading_id": None}, {"machine_id": None}, {"timestamp": None}]
    assert silver.fact_sensor(reading(spark, *kept, *dropped)).count() == len(kept)


def test_flags_are_strict_and_null_is_false(spark, rows):
    flagged = silver.sensor_columns(
        reading(
            spark,
            {"reading_id": "a", "temperature": 80.0, "pressure": 100.0, "vibration": 10.0},
            {"reading_id": "b", "temperature": 80.01, "pressure": 100.01, "vibration": 10.01},
            {"reading_id": "c", "temperature": None, "pressure": None, "vibration": None},
        )
    )
    assert rows(flagged, "reading_id", "is_high_temperature", "is_high_pressure", "is_high_vibration") == [
        ("a", False, False, False),
        ("b", True, True, True),
        ("c", False, False, False),
    ]


def test_fact_columns(spark):
    assert silver.fact_sensor(reading(spark, {})).columns == [
        "reading_id", "machine_id", "machine_timestamp", "temperature", "pressure", "vibration", "power_consumption",
        "error_code", "is_anomaly", "is_high_temperature", "is_high_pressure", "is_high_vibration", "_loading_ts",
    ]


def test_rule_metrics_and_observation_agree(spark):
    flagged = silver.sensor_columns(reading(spark, {}, {"pressure": None}, {"pressure": -1.0, "temperature": 600.0}))
    metrics = {r["rule"]: (r["total"], r["passed"], r["failed"]) for r in quality.rule_metrics(flagged, silver.SENSOR_RULES).collect()}
    assert metrics["reasonable_pressure"] == (3, 1, 2)
    assert metrics["reasonable_temperature"] == (3, 2, 1)
    assert metrics["valid_machine_id"] == (3, 3, 0)

    seen = Observation("dq")
    assert quality.keep_valid(quality.observe_rules(flagged, silver.SENSOR_RULES, seen), silver.SENSOR_RULES).count() == 1
    assert seen.get["total"] == 3
    assert seen.get["reasonable_pressure"] == 1


def test_key_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(quality.primary_key_violations(df, ["k"])) == [(None, 1), (1, 2)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.foreign_key_violations(df, parent, ["k"])) == [(2,)]
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 1), ("v", 0)]
