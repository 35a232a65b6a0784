"""The two machine feeds, taken from the ``events`` test table.

``signup`` events are machine versions; all others are readings of machine ``user_id``.
The integer inside ``props`` varies the measurements, so that every rule and flag has
rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The one-element explode computes k once per row: a plain column would be copied into
    # every rule that is pushed down to the scan, and the pattern matched again in each.
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "*", F.explode(F.array(k)).alias("k"), F.col("ts").cast("timestamp").alias("timestamp")
    )


def sensor_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    is_error = F.col("event_type") == "error"
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type") != "signup")
        .select(
            F.col("event_id").alias("reading_id"),
            F.col("user_id").alias("machine_id"),
            "timestamp",
            F.when(k == 1, value + 400).when(k == 2, -value - 100).when(k == 3, None).otherwise(value).alias("temperature"),
            ((k - 3).cast("double") * 1.2).alias("pressure"),
            (k % 14 - 1).cast("double").alias("vibration"),
            F.when(k % 20 == 0, None).otherwise(value).alias("power_consumption"),
            F.when(is_error, F.concat(F.lit("E00"), (k % 3 + 1).cast("string"))).alias("error_code"),
            F.when(k % 33 == 0, None).otherwise(is_error).alias("is_anomaly"),
        )
    )


def machine_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type") == "signup")
        .select(
            user.alias("machine_id"),
            F.concat(F.lit("M"), user.cast("string")).alias("machine_name"),
            F.concat(F.lit("SITE"), (k % 5).cast("string")).alias("location"),
            F.concat(F.lit("T"), (user % 5).cast("string")).alias("machine_type"),
            F.concat(F.lit("F"), (k % 7).cast("string")).alias("manufacturer"),
            F.lit("2020-01-01 00:00:00").cast("timestamp").alias("installation_date"),
            "timestamp",
            F.when(k % 3 == 0, "operational").when(k % 3 == 1, "maintenance").otherwise("offline").alias("status"),
            (F.lit(50.0) + F.col("value")).alias("max_temperature"),
            (F.lit(5.0) + k / F.lit(4.0)).cast("double").alias("max_pressure"),
        )
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a change feed with tied sequence values."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
