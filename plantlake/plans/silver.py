"""Silver tables: cleaned sensor facts and the machine history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.columns import drop_technical_columns
from plantlake.operators.quality import keep_valid, observe_rules
from plantlake.operators.scd2 import apply_scd2, with_hashed_key

# Rule names, predicates and thresholds of the sensor facts.
SENSOR_RULES = {
    "valid_reading_id": "reading_id IS NOT NULL",
    "valid_machine_id": "machine_id IS NOT NULL",
    "valid_timestamp": "machine_timestamp IS NOT NULL",
    "reasonable_temperature": "temperature BETWEEN -100 AND 500",
    "reasonable_pressure": "pressure >= 0",
    "reasonable_vibration": "vibration >= 0",
    "reasonable_power": "power_consumption >= 0",
}
HIGH_LIMITS = {"temperature": 80, "pressure": 100, "vibration": 10}

# A version needs a key and a place in time; rows failing this are counted, not applied.
MACHINE_RULES = {
    "valid_machine_id": "machine_id IS NOT NULL",
    "valid_timestamp": "machine_timestamp IS NOT NULL",
}

MACHINE_KEYS = ["machine_id"]
MACHINE_SEQUENCE = "machine_timestamp"
# The declared order of the history's columns.
HISTORY_COLUMNS = [
    "machine_sk",
    "machine_id",
    "machine_name",
    "machine_location",
    "machine_type",
    "manufacturer",
    "installation_date",
    "machine_status",
    "max_temperature",
    "max_pressure",
    "machine_timestamp",
    "__START_AT",
    "__END_AT",
]


def sensor_columns(bronze: DataFrame) -> DataFrame:
    """Rename, strip and flag the readings, before any rule is applied."""
    clean = drop_technical_columns(bronze).withColumnsRenamed({"timestamp": "machine_timestamp"})
    flags = {
        f"is_high_{name}": F.when(F.col(name) > limit, True).otherwise(False) for name, limit in HIGH_LIMITS.items()
    }
    return clean.withColumns({**flags, "_loading_ts": F.current_timestamp()})


def fact_sensor(bronze: DataFrame, observe: str | None = None) -> DataFrame:
    """Readings that pass every rule; works on batch and streaming input, without a shuffle."""
    flagged = sensor_columns(bronze)
    if observe:
        flagged = observe_rules(flagged, SENSOR_RULES, observe)
    return keep_valid(flagged, SENSOR_RULES)


def machine_changes(bronze: DataFrame) -> DataFrame:
    """The change feed of the machine history: business columns under their silver names."""
    return drop_technical_columns(bronze).withColumnsRenamed(
        {"timestamp": "machine_timestamp", "location": "machine_location", "status": "machine_status"}
    )


def dim_machine_h(bronze: DataFrame) -> DataFrame:
    """Machine history rebuilt from the whole change feed, in the declared order of columns."""
    history = apply_scd2(machine_changes(bronze), MACHINE_KEYS, MACHINE_SEQUENCE)
    return with_hashed_key(history, MACHINE_KEYS, "machine_sk").select(*HISTORY_COLUMNS)
