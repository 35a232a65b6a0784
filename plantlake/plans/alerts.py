"""The anomaly-rate alert."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.plans.gold import Day, as_day

# Fixed value: the alert fires above this percentage.
ANOMALY_RATE_THRESHOLD = 20.0


def alert_anomaly_rate(agg: DataFrame, as_of: Day = None, threshold: float = ANOMALY_RATE_THRESHOLD) -> DataFrame:
    """One row: yesterday's share of anomalous readings in percent, and whether the alert fires."""
    yesterday = agg.filter(F.col("machine_date") == F.date_sub(as_day(as_of), 1))
    readings = F.nullif(F.sum("total_readings"), F.lit(0))
    rate = F.round(F.sum("anomaly_count") * F.lit(Decimal("100.0")) / readings, 1).cast("double")
    return yesterday.agg(rate.alias("anomaly_rate_pct")).withColumn(
        "triggered", F.coalesce(F.col("anomaly_rate_pct") > threshold, F.lit(False))
    )
