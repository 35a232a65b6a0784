"""Incremental refresh of the gold day tables: only the days that a load touches are written.

What a load brought follows from the loading times of the stored rows, compared with those of the refresh before. From new readings
come their days; from new machine changes come the days that a version covers which now begins or ends at the time of a change. The tables
are partitioned by day, and a refresh replaces whole partitions, so that running it twice, or after one that failed, changes nothing more.
Its marks are written last.

Days only gain rows, as readings and versions are never taken back. Readers of a day see its old or its new files; a refresh that fails in the middle leaves some days new and others old, and the next
one writes all of them again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.config import MACHINE_METADATA, PipelineConfig
from plantlake.operators.layout import declared_columns, describe_table, table_location, with_comments
from plantlake.operators.scd2 import END, START
from plantlake.plans import gold, silver

DAY = "machine_date"
MARKS = "refresh int, readings timestamp, changes timestamp, as_of date"


def marks(spark: SparkSession, path: str):
    """The marks of the last finished refresh: newest loading times of readings and changes, and its day; None before the first."""
    try:
        return spark.read.schema(MARKS).parquet(path).orderBy(F.col("refresh").desc()).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def days_of_readings(facts: DataFrame, after: dt.datetime | None) -> DataFrame:
    """Days of the readings loaded after a time."""
    new = facts if after is None else facts.filter(F.col("_loading_ts") > F.lit(after))
    return new.select(F.col("machine_timestamp").cast("date").alias(DAY)).distinct()


def days_of_changes(changes: DataFrame, history: DataFrame, after: dt.datetime | None, as_of: gold.Day, ended: bool) -> DataFrame:
    """Days covered by the versions that begin at a change loaded after a time, and with ``ended`` by those that end there.

    A late change takes its days from the version before it. Whoever shows ends of versions must also renew the days left to that one.
    """
    new = changes if after is None else changes.filter(F.col("_loading_ts") > F.lit(after))
    points = new.select("machine_id", F.col("timestamp").alias("_at")).dropna().distinct()
    places = [START, END] if ended else [START]
    versions = history.select("machine_id", START, END, F.explode(F.array(*places)).alias("_at")).join(points, ["machine_id", "_at"], "left_semi")
    today = gold.as_day(as_of)
    first = F.greatest(F.col(START).cast("date"), gold.as_day(gold.FIRST_DAY))
    last = F.least(F.coalesce(F.date_sub(F.col(END).cast("date"), 1), today), today)
    covered = versions.select(first.alias("_first"), last.alias("_last")).filter("_first <= _last")
    return covered.distinct().select(F.explode(F.sequence("_first", "_last")).alias(DAY)).distinct()


def _listed(days: DataFrame) -> list[dt.date]:
    """Touched days in order; the calendar bounds their number."""
    return sorted(r[0] for r in days.filter(F.col(DAY).isNotNull()).distinct().collect())


def within(df: DataFrame, day_column: str, days: Sequence[dt.date]) -> DataFrame:
    """Rows of the given days. The range of the instants reaches the scan, the set of days filters what is left."""
    at = F.col(day_column)
    inside = at.cast("date").isin(list(days))
    if df.schema[day_column].dataType.typeName() != "date" and days:
        inside &= (at >= F.lit(str(days[0])).cast("timestamp")) & (at < F.lit(str(days[-1] + dt.timedelta(days=1))).cast("timestamp"))
    return df.filter(inside)


def replace_days(
    df: DataFrame, name: str, days: Sequence[dt.date], comment: str = "", properties: Mapping[str, str] | None = None
) -> DataFrame:
    """Write the rows of ``days`` as partitions of table ``name``, creating it if needed; returns a read of it in the order of ``df``.

    Other days keep their files.
    """
    spark, columns = df.sparkSession, [c for c in df.columns if c != DAY]
    place = table_location(spark, name, "days")
    if not spark.catalog.tableExists(name):
        fields = declared_columns(df, [*columns, DAY])
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({DAY}) LOCATION '{place}'")
        describe_table(spark, name, comment, properties)
    if days:
        # A day may hold many files or few; rebalancing cuts a large day and gathers a small one.
        laid_out = within(df, DAY, days).select(*columns, DAY).hint("rebalance", DAY).sortWithinPartitions(DAY, "machine_id")
        laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(place)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({DAY} = DATE '{d}')" for d in days))
        spark.catalog.refreshTable(name)
    return spark.read.table(name).select(*df.columns)


def refresh_gold_days(
    spark: SparkSession, cfg: PipelineConfig, as_of: gold.Day = None, comments: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Bring ``dim_machine_daily`` and ``fact_sensor_agg`` up to date for the days touched since the last refresh.

    Returns both tables, and as ``touched`` the days of each that were written: table_name, machine_date.
    """
    path = f"{cfg.metadata_base}/gold_refresh"
    last, comments = marks(spark, path), comments or {}
    facts = spark.read.table(f"{cfg.silver_schema}.fact_sensor")
    changes = spark.read.table(f"{cfg.bronze_schema}.{MACHINE_METADATA.table_name}")
    history = spark.read.table(f"{cfg.silver_schema}.dim_machine_h").select(*silver.HISTORY_COLUMNS)
    today = spark.range(1).select(gold.as_day(as_of)).first()[0]
    newest = [df.agg(F.max("_loading_ts")).first()[0] for df in (facts, changes)]
    seen = (last.readings, last.changes) if last else (None, None)

    days = [days_of_changes(changes, history, seen[1], today, ended) for ended in (True, False)]
    began = []  # days that have begun since
    if last:
        if today < last.as_of:
            raise ValueError(f"gold covers the days to {last.as_of} and can't go back to {today}")
        began = [last.as_of + dt.timedelta(days=k) for k in range(1, (today - last.as_of).days + 1)]
    daily_days = sorted({*_listed(days[0]), *began})
    agg_days = sorted({*_listed(days_of_readings(facts, seen[0]).unionByName(days[1])), *began})

    daily = replace_days(
        with_comments(gold.dim_machine_daily(history, today), comments),
        f"{cfg.gold_schema}.dim_machine_daily",
        daily_days,
        "Machine attributes in force at the end of each day",
        {"quality": "gold"},
    )
    touched = gold.fact_sensor_agg(within(facts, "machine_timestamp", agg_days), within(daily, DAY, agg_days))
    agg = replace_days(
        with_comments(touched, comments), f"{cfg.gold_schema}.fact_sensor_agg", agg_days, "Daily measures per machine", {"quality": "gold"}
    )
    mark = [(last.refresh + 1 if last else 1, *newest, today)]
    spark.createDataFrame(mark, MARKS).coalesce(1).write.mode("append").parquet(path)
    written = [("dim_machine_daily", d) for d in daily_days] + [("fact_sensor_agg", d) for d in agg_days]
    return {"dim_machine_daily": daily, "fact_sensor_agg": agg, "touched": spark.createDataFrame(written, f"table_name string, {DAY} date")}
