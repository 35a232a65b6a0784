"""The full load: landing files through bronze and silver to gold and the alert, in order."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlake.config import MACHINE_METADATA, SENSOR_DATA, IngestSpec, PipelineConfig
from plantlake.operators.layout import create_view, describe_table, materialize, with_comments
from plantlake.plans import alerts, gold, silver
from plantlake.plans.contracts import contract_report
from plantlake.plans.refresh import refresh_gold_days
from plantlake.sources.landing import ingest_json
from plantlake.sources.schema_memory import SchemaMemory, add_columns, promoted
from plantlake.streaming.scd2_stream import HistoryTarget, stream_history
from plantlake.streaming.sinks import append_counted, append_to_table

COMMENTS = {
    "machine_sk": "Surrogate key of a machine version",
    "machine_id": "Machine identifier",
    "machine_date": "Calendar day (UTC)",
    "valid_from": "Start of validity, included",
    "valid_to": "End of validity, excluded; NULL while current",
    "valid_from_ts": "Start of validity, included",
    "valid_to_ts": "End of validity, excluded; NULL while current",
    "is_current": "Whether this version is the current one",
    "reading_hour": "Hour of the reading, 0 to 23",
    "reading_day_of_week": "Day of the week of the reading, 1 = Sunday to 7 = Saturday",
    "total_readings": "Readings of the machine on that day",
    "anomaly_count": "Readings flagged as anomalies; NULL when no reading carries the flag",
}


def schema_memory(cfg: PipelineConfig, spec: IngestSpec) -> SchemaMemory:
    return SchemaMemory(f"{cfg.metadata_base}/schemas/{spec.source_path}")


def load_bronze(
    spark: SparkSession, cfg: PipelineConfig, spec: IngestSpec, archive: bool = False, evolve: bool = False
) -> StreamingQuery:
    """Append the new landing files of one feed.

    One micro-batch has one ``_loading_ts``, so appended files follow that clustering key
    without a shuffle. ``cfg.cluster_bronze`` range-partitions by the remaining keys as well,
    at the price of parsing the lines twice (once for sampling) and shuffling them.
    With ``evolve`` the feed's schema memory adds columns for new keys (read the table with `read_bronze`).
    """
    name, memory = f"{cfg.bronze_schema}.{spec.table_name}", schema_memory(cfg, spec)
    learnt = memory.learnt(spark) if evolve else []
    add_columns(spark, name, learnt)
    known = spark.read.table(name).agg(F.max("_loading_ts")).first()[0] if evolve and spark.catalog.tableExists(name) else None
    query = append_to_table(
        ingest_json(spark, spec, cfg.machine_uploads_base, archive, cfg.max_files_per_trigger, learnt=learnt),
        name,
        cfg.checkpoint(f"bronze_{spec.table_name}"),
        spec.cluster_by if cfg.cluster_bronze else (),
        spec.comment,
        {"quality": "bronze"},
    )
    if evolve:
        loaded = spark.read.table(name)
        new = loaded if known is None else loaded.filter(F.col("_loading_ts") > F.lit(known))
        add_columns(spark, name, memory.learn(new))
    return query


def read_bronze(spark: SparkSession, cfg: PipelineConfig, spec: IngestSpec) -> DataFrame:
    """A bronze table with the columns its feed has taught, old rows included."""
    learnt = schema_memory(cfg, spec).learnt(spark)
    return promoted(spark.read.table(f"{cfg.bronze_schema}.{spec.table_name}"), learnt)


def _stream(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    """New rows of a bronze table, in micro-batches of the configured size."""
    reader = spark.readStream
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return reader.table(f"{cfg.bronze_schema}.{table}")


def load_fact_sensor(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Append the valid readings among the new bronze rows; returns the sums of their rule counts.

    The counts of each micro-batch are stored under its number, together with its rows (see `append_counted`).
    """
    return append_counted(
        silver.sensor_columns(_stream(spark, cfg, SENSOR_DATA.table_name)),
        silver.SENSOR_RULES,
        f"{cfg.silver_schema}.fact_sensor",
        cfg.checkpoint("silver_fact_sensor"),
        cfg.checkpoint("rule_counts"),
        ["machine_id", "machine_timestamp"] if cfg.cluster_silver else (),
        ["reading_id"],
        "Cleaned sensor readings with threshold flags",
        {"quality": "silver"},
    )


def history_target(cfg: PipelineConfig, buckets: int = 64) -> HistoryTarget:
    """The stored history; use enough buckets that one of them is a comfortable unit of rewriting."""
    return HistoryTarget(
        f"{cfg.tables_base or cfg.metadata_base}/{cfg.silver_schema}.history/dim_machine_h",
        silver.MACHINE_KEYS,
        silver.MACHINE_SEQUENCE,
        surrogate="machine_sk",
        buckets=buckets,
    )


def load_dim_machine_h(spark: SparkSession, cfg: PipelineConfig, buckets: int = 64) -> DataFrame:
    """Fold the new bronze changes into the stored history, and return it."""
    bronze = _stream(spark, cfg, MACHINE_METADATA.table_name)
    changes = silver.machine_changes(bronze)
    target = history_target(cfg, buckets)
    stream_history(changes, target, cfg.checkpoint("silver_dim_machine_h"))
    name = f"{cfg.silver_schema}.dim_machine_h"
    history = target.publish(spark, name, changes.schema)
    describe_table(spark, name, "Machine versions with validity", {"quality": "silver"})
    return history


def gold_views(cfg: PipelineConfig) -> dict[str, str]:
    """The two gold views as SQL over silver, for any session that shares the catalog."""
    history, facts = f"{cfg.silver_schema}.dim_machine_h", f"{cfg.silver_schema}.fact_sensor"
    return {"dim_machine_h": gold.dim_machine_h_sql(history), "fact_sensor": gold.fact_sensor_sql(facts, history)}


def build_gold(
    spark: SparkSession, cfg: PipelineConfig, as_of: gold.Day = None, touched_days: bool = False
) -> dict[str, DataFrame]:
    """Refresh the gold tables and views from silver; name -> DataFrame.

    With ``touched_days`` the two day tables are partitioned by day, and only the days that changed are written.
    """
    g = cfg.gold_schema
    facts = spark.read.table(f"{cfg.silver_schema}.fact_sensor")
    history = spark.read.table(f"{cfg.silver_schema}.dim_machine_h").drop("bucket")
    views = gold_views(cfg)
    tables = {"dim_machine_h": create_view(spark, f"{g}.dim_machine_h", views["dim_machine_h"], COMMENTS, "All machine versions")}
    tables["dim_machine_a"] = materialize(
        with_comments(gold.dim_machine_a(history), COMMENTS),
        f"{g}.dim_machine_a",
        ["machine_id"],
        "Current version of each machine",
        {"quality": "gold"},
    )
    tables["fact_sensor"] = create_view(
        spark, f"{g}.fact_sensor", views["fact_sensor"], COMMENTS, "Readings with the machine version valid at their instant"
    )
    if touched_days:
        days = refresh_gold_days(spark, cfg, as_of, COMMENTS)
        return tables | {name: days[name] for name in ("dim_machine_daily", "fact_sensor_agg")}
    tables["dim_machine_daily"] = materialize(
        with_comments(gold.dim_machine_daily(history, as_of, clustered=True), COMMENTS),
        f"{g}.dim_machine_daily",
        comment="Machine attributes in force at the end of each day",
        properties={"quality": "gold"},
    )
    tables["fact_sensor_agg"] = materialize(
        with_comments(gold.fact_sensor_agg(facts, tables["dim_machine_daily"]), COMMENTS),
        f"{g}.fact_sensor_agg",
        ["machine_date", "machine_id"],
        "Daily measures per machine",
        {"quality": "gold"},
    )
    return tables


@dataclass(frozen=True)
class LoadResult:
    tables: dict[str, DataFrame]
    alert: DataFrame
    rule_counts: dict[str, int]
    contract: DataFrame


def run_full_load(
    spark: SparkSession,
    cfg: PipelineConfig,
    as_of: gold.Day = None,
    archive: bool = False,
    buckets: int = 64,
    touched_days: bool = False,
) -> LoadResult:
    """One load: drain the landing folder, then bring every table up to date (see `build_gold` for ``touched_days``)."""
    cfg.create_schemas(spark)

    def load_sensors() -> dict[str, int]:
        load_bronze(spark, cfg, SENSOR_DATA, archive)
        return load_fact_sensor(spark, cfg)

    def load_machines() -> None:
        load_bronze(spark, cfg, MACHINE_METADATA, archive)
        load_dim_machine_h(spark, cfg, buckets)

    # The two feeds meet in gold only; side by side they fill each other's idle executors.
    with ThreadPoolExecutor(2) as pool:
        sensors, machines = pool.submit(load_sensors), pool.submit(load_machines)
        machines.result()
        counts = sensors.result()
    tables = build_gold(spark, cfg, as_of, touched_days)
    alert = alerts.alert_anomaly_rate(tables["fact_sensor_agg"], as_of)
    return LoadResult(tables, alert, counts, contract_report(tables))
