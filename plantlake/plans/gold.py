"""Gold tables and views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlake.operators.interval_join import join_valid_at, valid_at_sql
from plantlake.operators.scd2 import END, START

# Fixed value: first calendar day of the daily dimension.
FIRST_DAY = "2020-01-01"

ATTRIBUTES = [
    "machine_name",
    "machine_location",
    "machine_type",
    "manufacturer",
    "installation_date",
    "machine_status",
    "max_temperature",
    "max_pressure",
]
VERSION_COLUMNS = [
    "machine_sk",
    "machine_id",
    *ATTRIBUTES,
    "machine_timestamp",
    f"{START} AS valid_from_ts",
    f"{END} AS valid_to_ts",
    f"{END} IS NULL AS is_current",
]
DAY_ATTRIBUTES = ["machine_sk", "machine_name", "machine_location", "machine_type", "machine_status"]
MEASURES = ["temperature", "pressure", "vibration", "power_consumption"]
READING_COLUMNS = [
    "reading_id",
    "machine_id",
    "machine_sk",
    "machine_timestamp",
    "CAST(machine_timestamp AS DATE) AS machine_date",
    "hour(machine_timestamp) AS reading_hour",
    "dayofweek(machine_timestamp) AS reading_day_of_week",
    *MEASURES,
    "error_code",
    "is_anomaly",
    "is_high_temperature",
    "is_high_pressure",
    "is_high_vibration",
]
FLAG_COUNTS = {
    "anomaly_count": "is_anomaly",
    "high_temp_count": "is_high_temperature",
    "high_pressure_count": "is_high_pressure",
    "high_vibration_count": "is_high_vibration",
}

Day = str | dt.date | Column | None


def as_day(day: Day) -> Column:
    """A date expression: a literal, a given column, or today."""
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def date_spine(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day from ``first`` to ``last``, both included, for each row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("machine_date"))


def calendar(spark: SparkSession, as_of: Day = None, first_day: str = FIRST_DAY) -> DataFrame:
    """The days the daily dimension can cover."""
    return date_spine(spark.range(1).select(as_day(first_day).alias("first_day"), as_day(as_of).alias("last_day")))


def dim_machine_h(history: DataFrame) -> DataFrame:
    """All versions with readable validity columns."""
    return history.selectExpr(*VERSION_COLUMNS)


def dim_machine_h_sql(history: str) -> str:
    """`dim_machine_h` over a stored table, as the text of a view."""
    return f"SELECT {', '.join(VERSION_COLUMNS)} FROM {history}"


def dim_machine_a(history: DataFrame) -> DataFrame:
    """Current version of each machine, in the declared order of columns."""
    current = history.filter(F.col(END).isNull()).drop(END)
    return current.select("machine_sk", "machine_id", *ATTRIBUTES, "machine_timestamp", START)


def dim_machine_daily(
    history: DataFrame, as_of: Day = None, first_day: str = FIRST_DAY, clustered: bool = False
) -> DataFrame:
    """One row per machine and day: the version in force at the end of that day.

    Each version lists the days it covers, instead of comparing every version with every
    day. A version that ends on the day it starts covers none and is filtered out before
    the expansion. When versions overlap, the latest start wins the day.

    With ``clustered`` the days are range-partitioned by (machine_id, machine_date) instead
    of hashed: the ranking needs no other shuffle then, and the result can be stored as it is.
    """
    first = F.greatest(F.col(START).cast("date"), as_day(first_day))
    last = F.least(F.coalesce(F.date_sub(F.col(END).cast("date"), 1), as_day(as_of)), as_day(as_of))
    covered = history.withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    days = covered.select(
        "machine_sk",
        "machine_id",
        F.explode(F.sequence("_first", "_last")).alias("machine_date"),
        *ATTRIBUTES,
        F.col(START).alias("valid_from"),
        F.col(END).alias("valid_to"),
    )
    if clustered:
        days = days.repartitionByRange("machine_id", "machine_date")
    latest = Window.partitionBy("machine_id", "machine_date").orderBy(F.col("valid_from").desc())
    one_per_day = days.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1").drop("_rn")
    # The size estimate does not count the expansion, so an unstored result must not be
    # broadcast on that estimate; a stored table carries its true size and no hint.
    return one_per_day.hint("merge")


def fact_sensor(facts: DataFrame, history: DataFrame, method: str = "auto") -> DataFrame:
    """Readings with the key of the version valid at the reading's instant."""
    joined = join_valid_at(
        facts, history, ["machine_id"], "machine_timestamp", START, END, ["machine_sk"], method=method
    )
    return joined.selectExpr(*READING_COLUMNS)


def fact_sensor_sql(facts: str, history: str) -> str:
    """`fact_sensor` over stored tables, as the text of a view: the same join and the same columns."""
    joined = valid_at_sql(facts, history, ["machine_id"], "machine_timestamp", START, END, ["machine_sk"])
    return f"SELECT {', '.join(READING_COLUMNS)} FROM ({joined})"


def _daily_measures(facts: DataFrame) -> DataFrame:
    counts = [F.sum(F.col(flag).cast("int")).alias(name) for name, flag in FLAG_COUNTS.items()]
    stats = [
        F.round(fn(m), 2).alias(f"{prefix}_{m}")
        for m in MEASURES
        for prefix, fn in (("avg", F.avg), ("min", F.min), ("max", F.max))
    ]
    return (
        facts.withColumn("machine_date", F.col("machine_timestamp").cast("date"))
        .groupBy("machine_id", "machine_date")  # the order of the join and of the daily table: no second shuffle
        .agg(
            F.count("*").alias("total_readings"),
            *counts,
            *stats,
            F.round(F.sum("power_consumption"), 2).alias("total_power_consumption"),
        )
    )


def fact_sensor_agg(facts: DataFrame, daily: DataFrame) -> DataFrame:
    """Daily measures per machine with the machine's attributes of that day.

    The readings are reduced to machine-days before the join. The daily dimension has one
    row per machine-day, so this gives the rows of join-then-group, while the join moves
    machine-days instead of readings. Only five attributes are taken: the dimension's
    ``max_temperature`` and ``max_pressure`` are limits, the aggregate's are observations.
    """
    measures = _daily_measures(facts)
    names = [c for c in measures.columns if c not in ("machine_date", "machine_id")]
    joined = measures.join(
        daily.select("machine_id", "machine_date", *DAY_ATTRIBUTES), ["machine_id", "machine_date"], "left"
    )
    return joined.select("machine_date", "machine_id", *DAY_ATTRIBUTES, *names)
