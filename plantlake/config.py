"""Names, paths and landing schemas of one deployment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class PipelineConfig:
    """Schema names and base folders; every job takes this instead of global settings."""

    bronze_schema: str
    silver_schema: str
    gold_schema: str
    machine_uploads_base: str
    metadata_base: str
    tables_base: str | None = None  # folder of the stored tables; None = the warehouse
    cluster_bronze: bool = False  # also cluster bronze by machine; see `load_bronze` for the price
    cluster_silver: bool = True
    max_files_per_trigger: int | None = None  # size of a micro-batch; None = the whole backlog

    @classmethod
    def from_conf(cls, spark: SparkSession) -> PipelineConfig:
        """Read the values from Spark settings of the same names, prefixed ``plantlake.``."""
        get = spark.conf.get
        return cls(
            bronze_schema=get("plantlake.bronze_schema"),
            silver_schema=get("plantlake.silver_schema"),
            gold_schema=get("plantlake.gold_schema"),
            machine_uploads_base=get("plantlake.machine_uploads_base"),
            metadata_base=get("plantlake.metadata_base"),
            tables_base=get("plantlake.tables_base", None),
            cluster_bronze=get("plantlake.cluster_bronze", "false").lower() == "true",
            cluster_silver=get("plantlake.cluster_silver", "true").lower() == "true",
            max_files_per_trigger=int(files) if (files := get("plantlake.max_files_per_trigger", None)) else None,
        )

    def schemas(self) -> list[str]:
        return [self.bronze_schema, self.silver_schema, self.gold_schema]

    def create_schemas(self, spark: SparkSession) -> None:
        for name in self.schemas():
            where = f" LOCATION '{self.tables_base}/{name}'" if self.tables_base else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")

    def checkpoint(self, flow: str) -> str:
        """Progress folder of one streaming flow."""
        return f"{self.metadata_base}/{flow}"


@dataclass(frozen=True)
class IngestSpec:
    """What the landing ingest needs to know about one feed."""

    table_name: str
    source_path: str
    ddl: str
    cluster_by: tuple[str, ...] = ()
    comment: str = ""

    @property
    def schema(self) -> T.StructType:
        """The landing columns; parsing DDL needs a session, so not at import time."""
        return T.DataType.fromDDL(self.ddl)


# Names, order and types of the landing columns.
MACHINE_METADATA = IngestSpec(
    table_name="machine_metadata",
    source_path="machine_metadata",
    cluster_by=("_loading_ts", "machine_id"),
    comment="Machine metadata change feed as it arrived in the landing folder",
    ddl=(
        "machine_id string, machine_name string, location string, machine_type string, manufacturer string,"
        " installation_date timestamp, timestamp timestamp, status string, max_temperature double, max_pressure double"
    ),
)

SENSOR_DATA = IngestSpec(
    table_name="sensor_data",
    source_path="sensor_data",
    cluster_by=("_loading_ts", "machine_id"),
    comment="Sensor readings as they arrived in the landing folder",
    ddl=(
        "reading_id string, machine_id string, timestamp timestamp, temperature double, pressure double,"
        " vibration double, power_consumption double, error_code string, is_anomaly boolean"
    ),
)
