"""Every table and operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.config import MACHINE_METADATA, SENSOR_DATA, PipelineConfig
from plantlake.functions.columns import drop_technical_columns
from plantlake.operators import quality, scd2
from plantlake.operators.layout import cluster_rows, compact, create_view, files_in_range, materialize
from plantlake.plans import alerts, contracts, full_load, gold, silver, synth
from plantlake.plans.refresh import refresh_gold_days
from plantlake.session import configure, scratch_path, write_through
from plantlake.sources.feeds import machine_feed, order_feed, sensor_feed
from plantlake.sources.files import JSON_TIMESTAMP, read_table_file, write_json_lines
from plantlake.sources.landing import LINEAGE, RESCUED, ingest_json
from plantlake.streaming.scd2_stream import HistoryTarget, stream_history
from plantlake.streaming.sinks import append_to_table, rule_history

Query = Callable[[SparkSession, str], DataFrame]

DAILY_AS_OF = "2024-02-05"
ALERT_AS_OF = "2024-01-20"
SYNTH_NOW = dt.datetime(2024, 1, 31, 12, 30, 15, 250000, tzinfo=dt.timezone.utc)

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a function under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _config(spark: SparkSession) -> PipelineConfig:
    """Schemas and folders of one run, all below the shared folder."""
    run = uuid.uuid4().hex[:12]
    base = scratch_path(spark, "lake")
    return PipelineConfig(
        bronze_schema=f"bronze_{run}",
        silver_schema=f"silver_{run}",
        gold_schema=f"gold_{run}",
        machine_uploads_base=f"{base}/landing",
        metadata_base=f"{base}/progress",
        tables_base=f"{base}/tables",
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_machine_h(machine_feed(spark, sf_dir))


def _stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as a stored table, which gold reads, with numbered keys."""
    changes = silver.machine_changes(machine_feed(spark, sf_dir))
    history = scd2.apply_scd2(changes, silver.MACHINE_KEYS, silver.MACHINE_SEQUENCE)
    return scd2.with_dense_key(history, silver.MACHINE_KEYS, "machine_sk")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_sensor(sensor_feed(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_machine_daily(_stored_history(spark, sf_dir), DAILY_AS_OF)


# --- silver -----------------------------------------------------------------------------


@query
def silver_fact_sensor(spark, sf_dir):
    return _facts(spark, sf_dir).drop("_loading_ts")


@query
def dq_rule_metrics(spark, sf_dir):
    sensors = quality.rule_metrics(silver.sensor_columns(sensor_feed(spark, sf_dir)), silver.SENSOR_RULES)
    machines = quality.rule_metrics(silver.machine_changes(machine_feed(spark, sf_dir)), silver.MACHINE_RULES)
    return sensors.select(F.lit("sensor_data").alias("dataset"), "*").unionByName(
        machines.select(F.lit("machine_metadata").alias("dataset"), "*")
    )


@query
def dim_source_clean(spark, sf_dir):
    bronze = machine_feed(spark, sf_dir).withColumns(
        {"_rescued": F.lit(None).cast("string"), "_loading_ts": F.current_timestamp()}
    )
    return silver.machine_changes(bronze)


@query
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_history_ties(spark, sf_dir):
    return scd2.apply_scd2(order_feed(spark, sf_dir), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query
def surrogate_key_dense(spark, sf_dir):
    history = scd2.apply_scd2(order_feed(spark, sf_dir), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return scd2.with_dense_key(history, ["o_custkey"], "order_sk").select("order_sk", "o_custkey", scd2.START, scd2.END)


FIRST_ORDERS = "o_orderkey % 4 <> 0"


@query
def surrogate_key_stable(spark, sf_dir):
    """Two loads, of which the second brings late rows; the versions of the first keep their numbers."""
    feed = order_feed(spark, sf_dir)
    numbers = scd2.KeyMap(scratch_path(spark, "key_map"), ["o_custkey"])
    for load in (feed.filter(FIRST_ORDERS), feed):
        history = write_through(scd2.apply_scd2(load, ["o_custkey"], "o_orderdate", ["o_orderkey"]), "history")
        numbered = numbers.number(history, "order_sk")
    return numbered.select("order_sk", "o_custkey", scd2.START, scd2.END)


@query
def scd2_stream(spark, sf_dir):
    """Three loads, each a scattered third of the feed, so that most rows arrive late."""
    changes = silver.machine_changes(machine_feed(spark, sf_dir))
    base = scratch_path(spark, "scd2_stream")
    target = HistoryTarget(f"{base}/target", silver.MACHINE_KEYS, silver.MACHINE_SEQUENCE, surrogate="machine_sk", buckets=8)
    arrival = F.pmod(F.xxhash64("machine_id", "machine_timestamp"), F.lit(3))
    for load in range(3):
        changes.filter(arrival == load).write.mode("append").parquet(f"{base}/feed")
        arriving = spark.readStream.schema(changes.schema).parquet(f"{base}/feed")
        stream_history(arriving, target, f"{base}/progress")
    return target.read(spark, changes.schema)


@query
def scd2_stream_rebucketed(spark, sf_dir):
    """Four loads, of which the later ones are small, into a target whose number of buckets changes twice."""
    changes = silver.machine_changes(machine_feed(spark, sf_dir))
    base = scratch_path(spark, "scd2_rebucketed")
    part = F.pmod(F.xxhash64("machine_id", "machine_timestamp"), F.lit(50))
    load_of = F.when(part > 2, 0).otherwise(part + 1)
    for load, buckets in enumerate((4, 8, 8, 3)):
        target = HistoryTarget(
            f"{base}/target", silver.MACHINE_KEYS, silver.MACHINE_SEQUENCE, surrogate="machine_sk", buckets=buckets
        )
        changes.filter(load_of == load).write.mode("append").parquet(f"{base}/feed")
        arriving = spark.readStream.schema(changes.schema).parquet(f"{base}/feed")
        stream_history(arriving, target, f"{base}/progress")
    return target.read(spark, changes.schema)


# --- gold -------------------------------------------------------------------------------


@query
def date_spine(spark, sf_dir):
    days = spark.read.parquet(f"{sf_dir}/events.parquet").agg(
        F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day")
    )
    return gold.date_spine(days)


@query
def dim_machine_h(spark, sf_dir):
    return gold.dim_machine_h(_history(spark, sf_dir))


@query
def dim_machine_a(spark, sf_dir):
    return gold.dim_machine_a(_history(spark, sf_dir))


@query
def dim_machine_daily(spark, sf_dir):
    return _daily(spark, sf_dir)


@query
def gold_fact_sensor(spark, sf_dir):
    return gold.fact_sensor(_facts(spark, sf_dir), _stored_history(spark, sf_dir))


@query
def gold_fact_sensor_bucketed(spark, sf_dir):
    """The same view through the join for long histories."""
    return gold.fact_sensor(_facts(spark, sf_dir), _stored_history(spark, sf_dir), method="bucketed")


@query
def gold_fact_sensor_view(spark, sf_dir):
    """The persistent view that a load creates, over stored silver tables."""
    cfg = _config(spark)
    cfg.create_schemas(spark)
    materialize(_facts(spark, sf_dir), f"{cfg.silver_schema}.fact_sensor")
    materialize(_stored_history(spark, sf_dir), f"{cfg.silver_schema}.dim_machine_h")
    text = full_load.gold_views(cfg)["fact_sensor"]
    return create_view(spark, f"{cfg.gold_schema}.fact_sensor", text, full_load.COMMENTS)


@query
def fact_sensor_agg(spark, sf_dir):
    return gold.fact_sensor_agg(_facts(spark, sf_dir), _daily(spark, sf_dir))


@query
def materialize_gold(spark, sf_dir):
    cfg = _config(spark)
    cfg.create_schemas(spark)
    history = _stored_history(spark, sf_dir)
    days = gold.dim_machine_daily(history, DAILY_AS_OF, clustered=True)
    daily = materialize(days, f"{cfg.gold_schema}.dim_machine_daily")
    agg = gold.fact_sensor_agg(_facts(spark, sf_dir), daily)
    return materialize(agg, f"{cfg.gold_schema}.fact_sensor_agg", ["machine_date", "machine_id"])


LATE_READINGS = "CAST(machine_timestamp AS DATE) IN (DATE '2024-01-10', DATE '2024-01-20') AND reading_id % 3 = 0"
LATE_CHANGES = "machine_id % 50 = 0 AND machine_timestamp >= TIMESTAMP '2024-01-25 00:00:00'"


@query
def gold_refresh(spark, sf_dir):
    """Two loads, of which the second touches few days; ``renewed`` tells whether its refresh wrote the row's file."""
    cfg = _config(spark)
    cfg.create_schemas(spark)
    facts = _facts(spark, sf_dir).drop("_loading_ts")
    changes = machine_feed(spark, sf_dir).withColumnRenamed("timestamp", "machine_timestamp")
    files = None
    for late, loaded in ((False, "2024-02-05 01:00:00"), (True, "2024-02-05 02:00:00")):
        at = F.lit(loaded).cast("timestamp").alias("_loading_ts")
        new = [df.filter(F.expr(rule) == late) for df, rule in ((facts, LATE_READINGS), (changes, LATE_CHANGES))]
        new[0].select("*", at).write.mode("append").saveAsTable(f"{cfg.silver_schema}.fact_sensor")
        new[1].withColumnRenamed("machine_timestamp", "timestamp").select("*", at).write.mode("append").saveAsTable(
            f"{cfg.bronze_schema}.{MACHINE_METADATA.table_name}"
        )
        history = silver.dim_machine_h(spark.read.table(f"{cfg.bronze_schema}.{MACHINE_METADATA.table_name}"))
        materialize(history, f"{cfg.silver_schema}.dim_machine_h")
        before = files
        agg = refresh_gold_days(spark, cfg, DAILY_AS_OF)["fact_sensor_agg"]
        files = [("/".join(f.rsplit("/", 2)[1:]),) for f in agg.inputFiles()]
    known = F.broadcast(spark.createDataFrame(before, "file string")).withColumn("kept", F.lit(True))  # one row per day file
    located = agg.select("*", F.substring_index("_metadata.file_path", "/", -2).alias("file")).join(known, "file", "left")
    return located.select(*agg.columns, F.col("kept").isNull().alias("renewed")).withColumn("machine_sk", F.col("machine_sk").cast("string"))


@query
def alert_anomaly_rate(spark, sf_dir):
    return alerts.alert_anomaly_rate(fact_sensor_agg(spark, sf_dir), ALERT_AS_OF)


# --- checks -----------------------------------------------------------------------------


@query
def check_primary_key(spark, sf_dir):
    return quality.primary_key_violations(order_feed(spark, sf_dir), ["o_custkey", "o_orderdate"])


@query
def check_foreign_key(spark, sf_dir):
    daily = write_through(_daily(spark, sf_dir), "dim_machine_daily")
    agg = gold.fact_sensor_agg(_facts(spark, sf_dir), daily)
    return quality.foreign_key_violations(agg, daily, ["machine_id", "machine_date"])


@query
def check_not_null(spark, sf_dir):
    columns = ["machine_date", "machine_id", "machine_sk", "anomaly_count", "total_readings"]
    return quality.null_counts(fact_sensor_agg(spark, sf_dir), columns)


@query
def check_contracts(spark, sf_dir):
    """All declared keys, references and NOT NULL columns of the four keyed tables."""
    history = write_through(_stored_history(spark, sf_dir), "dim_machine_h")
    daily = write_through(gold.dim_machine_daily(history, DAILY_AS_OF), "dim_machine_daily")
    agg = write_through(gold.fact_sensor_agg(_facts(spark, sf_dir), daily), "fact_sensor_agg")
    tables = {"dim_machine_h": history, "dim_machine_a": gold.dim_machine_a(history), "dim_machine_daily": daily}
    return contracts.contract_report(tables | {"fact_sensor_agg": agg})


# --- files and streams ------------------------------------------------------------------


def _land(spark, sf_dir, cfg) -> None:
    write_json_lines(
        {"sensor_data": sensor_feed(spark, sf_dir), "machine_metadata": machine_feed(spark, sf_dir)},
        cfg.machine_uploads_base,
    )


def _bronze_sensors(spark, sf_dir) -> tuple[PipelineConfig, DataFrame]:
    cfg = _config(spark)
    cfg.create_schemas(spark)
    write_json_lines({"sensor_data": sensor_feed(spark, sf_dir)}, cfg.machine_uploads_base)
    full_load.load_bronze(spark, cfg, SENSOR_DATA)
    return cfg, spark.read.table(f"{cfg.bronze_schema}.sensor_data")


@query
def bronze_ingest(spark, sf_dir):
    _, bronze = _bronze_sensors(spark, sf_dir)
    return drop_technical_columns(bronze)


@query
def bronze_lineage(spark, sf_dir):
    """How many rows carry each lineage column in the expected form."""
    _, bronze = _bronze_sensors(spark, sf_dir)
    return bronze.agg(
        F.count_if(F.col("_loading_ts").isNotNull()).alias("loaded"),
        F.count_if(F.col("_file_path").endswith(F.col("_file_name"))).alias("located"),
        F.count_if(F.col("_file_name").endswith(".json")).alias("named"),
        F.count_if(F.col("_file_modification_time") <= F.col("_loading_ts")).alias("dated"),
        F.count_if(F.col("_file_size") > 0).alias("sized"),
    )


@query
def bronze_rescue(spark, sf_dir):
    """Readings of which some are damaged: a wrong type, a nested value, an undeclared key, a broken line."""
    cfg = _config(spark)
    cfg.create_schemas(spark)
    feed = sensor_feed(spark, sf_dir)
    options = {"ignoreNullFields": "false", "timestampFormat": JSON_TIMESTAMP}
    kind = F.pmod(F.col("reading_id"), F.lit(6))
    good = F.struct(*feed.columns)
    wrong = F.struct("reading_id", "machine_id", F.lit("hot").alias("temperature"), "pressure")
    nested = F.struct(*[c for c in feed.columns if c != "vibration"], F.struct(F.col("machine_id").alias("of"), F.array(F.lit(1), F.lit(2.5)).alias("is")).alias("vibration"))
    extra = F.struct("reading_id", F.lit("v2").alias("firmware"), F.struct(F.col("machine_id").alias("of")).alias("site"))
    broken = F.concat(F.lit('{"reading_id": '), F.col("reading_id").cast("string"), F.lit(', "temp'))
    lines = feed.select(
        F.when(kind == 0, F.to_json(wrong, options))
        .when(kind == 1, F.to_json(extra, options))
        .when(kind == 2, broken)
        .when(kind == 3, F.to_json(nested, options))
        .otherwise(F.to_json(good, options))
        .alias("value")
    )
    lines.write.text(f"{cfg.machine_uploads_base}/{SENSOR_DATA.source_path}")
    bronze = ingest_json(spark, SENSOR_DATA, cfg.machine_uploads_base, glob="*.txt")
    append_to_table(bronze, f"{cfg.bronze_schema}.sensor_data", cfg.checkpoint("rescue"))
    return spark.read.table(f"{cfg.bronze_schema}.sensor_data").select(*SENSOR_DATA.schema.names, RESCUED)


@query
def bronze_evolution(spark, sf_dir):
    """Two deliveries, of which the second has new keys, and a third after they were learnt; one new key is nested, one rare."""
    cfg = _config(spark)
    cfg.create_schemas(spark)
    feed = sensor_feed(spark, sf_dir)
    part = F.pmod(F.col("reading_id"), F.lit(3))
    new = {
        "firmware": F.concat(F.lit("v"), F.col("reading_id") % 4),
        "cycles": F.when(F.col("reading_id") % 5 > 0, F.col("reading_id") * 3),
        "load": F.when(F.col("reading_id") % 2 == 0, F.lit(0.5)).otherwise(F.lit(2.25)),
        "site": F.struct(F.col("machine_id").alias("of")),
        "rare": F.when(F.col("reading_id") % 1000 == 7, F.lit("x")),
    }
    for delivery in range(3):
        rows = feed.filter(part == delivery)
        write_json_lines({"sensor_data": rows.withColumns(new) if delivery else rows}, cfg.machine_uploads_base)
        full_load.load_bronze(spark, cfg, SENSOR_DATA, evolve=True)
    return full_load.read_bronze(spark, cfg, SENSOR_DATA).drop(*LINEAGE)


@query
def bronze_incremental(spark, sf_dir):
    """Two deliveries and three loads, with archiving: every reading arrives once."""
    cfg = _config(spark)
    cfg.create_schemas(spark)
    feed = sensor_feed(spark, sf_dir)
    late = F.col("error_code").isNotNull()
    for delivery in (feed.filter(~late), feed.filter(late), None):
        if delivery is not None:
            write_json_lines({"sensor_data": delivery}, cfg.machine_uploads_base)
        full_load.load_bronze(spark, cfg, SENSOR_DATA, archive=True)
    return drop_technical_columns(spark.read.table(f"{cfg.bronze_schema}.sensor_data"))


@query
def jsonl_roundtrip(spark, sf_dir):
    paths = write_json_lines({"machine_metadata": machine_feed(spark, sf_dir)}, scratch_path(spark, "jsonl"))
    return spark.read.schema(MACHINE_METADATA.schema).json(paths["machine_metadata"])


@query
def silver_fact_stream(spark, sf_dir):
    cfg, _ = _bronze_sensors(spark, sf_dir)
    full_load.load_fact_sensor(spark, cfg)
    return drop_technical_columns(spark.read.table(f"{cfg.silver_schema}.fact_sensor"))


@query
def dq_stream_metrics(spark, sf_dir):
    """Rule counts of the streamed readings over more micro-batches than a query remembers."""
    cfg = replace(_config(spark), max_files_per_trigger=1)
    cfg.create_schemas(spark)
    feed = sensor_feed(spark, sf_dir).repartition(6)
    write_json_lines({"sensor_data": feed}, cfg.machine_uploads_base)
    full_load.load_bronze(spark, cfg, SENSOR_DATA)
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "2")
    try:
        full_load.load_fact_sensor(spark, cfg)
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    names = list(silver.SENSOR_RULES)

    def counted(rule):
        return F.sum(F.when(F.col("rule") == rule, F.col("passed")))

    counts = rule_history(spark, cfg.checkpoint("rule_counts")).agg(
        counted("total").alias("total"), *[counted(name).alias(f"r{i}") for i, name in enumerate(names)]
    )
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("passed")) for i, name in enumerate(names)])
    return counts.select("total", F.inline(rows)).select("rule", "total", "passed", (F.col("total") - F.col("passed")).alias("failed"))


@query
def clustered_write(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    facts = _facts(spark, sf_dir).drop("_loading_ts")
    cluster_rows(facts, ["machine_id", "machine_timestamp"]).write.parquet(path)
    return spark.read.parquet(path)


CURVE_DAY = "2024-01-12"


@query
def clustered_curve(spark, sf_dir):
    """Six appends, then a compaction along a curve through machine and time: whether filters on a machine in the
    middle or on a day open half of the files or fewer."""
    cfg = _config(spark)
    cfg.create_schemas(spark)
    name, columns = f"{cfg.silver_schema}.fact_sensor", ["machine_id", "machine_timestamp"]
    facts = _facts(spark, sf_dir).drop("_loading_ts")
    for part in range(6):
        facts.filter(F.pmod(F.xxhash64("reading_id"), F.lit(6)) == part).coalesce(1).write.mode("append").saveAsTable(name)
    day = [dt.datetime.fromisoformat(f"{CURVE_DAY}T{t}") for t in ("00:00:00", "23:59:59.999999")]
    machine = facts.agg(F.floor((F.min("machine_id") + F.max("machine_id")) / 2)).first()[0]
    filters = {"machine": ("machine_id", machine, machine), "day": ("machine_timestamp", *[F.lit(str(d)).cast("timestamp") for d in day])}
    before = {f: files_in_range(spark.read.table(name), *span) for f, span in filters.items()}
    stored = compact(spark, name, columns, files=36)
    rows = []
    for f, (column, low, high) in filters.items():
        opened, every = files_in_range(stored, column, low, high)
        matching = stored.filter((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high))).count()
        rows.append((f, matching, before[f] == (6, 6), 2 * opened <= every))
    return spark.createDataFrame(rows, "filtered string, matching long, all_files_before boolean, half_or_less_after boolean")


@query
def load_table_file(spark, sf_dir):
    path = f"{scratch_path(spark, 'csv')}/customer.csv"
    spark.read.parquet(f"{sf_dir}/customer.parquet").write.option("header", True).csv(path)
    return read_table_file(spark, path)


@query
def load_table_file_json(spark, sf_dir):
    """A table as JSON documents, each an array of records."""
    path = f"{scratch_path(spark, 'documents')}/customer.json"
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    part = F.floor(F.col("c_custkey") / 1000).alias("part")
    documents = customers.groupBy(part).agg(F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value"))
    documents.write.partitionBy("part").text(path)
    return read_table_file(spark, path).drop("part")


@query
def full_load_agg(spark, sf_dir):
    """Both feeds as landing files, through every layer to the daily aggregate; its hashed key as text."""
    cfg = _config(spark)
    _land(spark, sf_dir, cfg)
    agg = full_load.run_full_load(spark, cfg, DAILY_AS_OF, buckets=8).tables["fact_sensor_agg"]
    return agg.withColumn("machine_sk", F.col("machine_sk").cast("string"))


# --- synthetic tables: one generated row per row of a given table -----------------------


def _over_events(spark, sf_dir, name: str, *fields: synth.FieldSpec) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"))
    keyed = synth.FieldSpec("row_id", "int", generator=lambda draws: draws.row_id)
    return synth.generate_dataset(spark, synth.DatasetSpec(name, [keyed, *fields]), rows=rows, now=SYNTH_NOW)


@query
def synth_dataset(spark, sf_dir):
    f = synth.FieldSpec
    return _over_events(
        spark, sf_dir, "shifts", f("badge", "int", min_value=7, max_value=9000), f("callsign", "string"), f("on_duty", "bool")
    )


@query
def synth_numeric(spark, sf_dir):
    """Ranges with default, negative and very wide bounds; the last needs more than 32 bits."""
    f = synth.FieldSpec
    return _over_events(
        spark,
        sf_dir,
        "numeric",
        f("offset", "int", min_value=-40, max_value=25),
        f("any_int", "int"),
        f("tick", "int", min_value=0, max_value=10**12),
        f("ratio", "float", min_value=-1.0, max_value=1.0),
        f("any_float", "float"),
    )


@query
def synth_categorical(spark, sf_dir):
    f = synth.FieldSpec
    return _over_events(
        spark,
        sf_dir,
        "categorical",
        f("word", "string"),
        f("flag", "bool"),
        f("shade", "choice", choices=["teal", "amber", "plum", "slate", "ochre"]),
        f("grade", "choice", choices=["A", None, "B"]),
        *[f(method, "faker", faker_method=method) for method in ("company", "city", "email", "name", "country", "address")],
    )


@query
def synth_datetime(spark, sf_dir):
    """Naive, zoned and recent instants, and a span of more than 2^31 seconds."""
    f = synth.FieldSpec
    return _over_events(
        spark,
        sf_dir,
        "datetime",
        f("naive", "datetime", min_value="2023-06-15T00:00:00", max_value="2023-09-12T23:59:59"),
        f("century", "datetime", min_value="1900-01-01T00:00:00", max_value="2025-12-31T00:00:00"),
        f("zoned", "datetime", min_value=(SYNTH_NOW - dt.timedelta(days=11)).isoformat(), max_value=SYNTH_NOW.isoformat()),
        f("recent", "datetime"),
    )


@query
def synth_uuid(spark, sf_dir):
    return _over_events(spark, sf_dir, "uuid", synth.FieldSpec("uid", "uuid"))


@query
def synth_nullable(spark, sf_dir):
    f = synth.FieldSpec
    return _over_events(
        spark,
        sf_dir,
        "nullable",
        f("half", "int", min_value=1, max_value=10, nullable=True, null_probability=0.5),
        f("tenth", "string", nullable=True),
        f("fixed", "int", generator=F.lit(41), nullable=True),
    )


@query
def synth_custom(spark, sf_dir):
    f = synth.FieldSpec
    return _over_events(
        spark,
        sf_dir,
        "custom",
        f("fixed", "int", generator=F.lit(41)),
        f("area", "float", generator=lambda draws: draws.below(6) * draws.below(9, slot=2)),
    )


@query
def synth_reference(spark, sf_dir):
    """Readings refer to customers through a table pool, to computed ids, and to a short and a long list."""
    f = synth.FieldSpec
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return _over_events(
        spark,
        sf_dir,
        "reference",
        f("customer", "reference", reference_pool=synth.TablePool(customers, "c_custkey")),
        f("machine_id", "reference", reference_pool=synth.IdPool("MACH-", customers.count())),
        f("line", "reference", reference_pool=[f"LINE-{i * 5 % 12:02d}" for i in range(12)]),
        f("lot", "reference", reference_pool=[f"LOT-{i * 7 % 1500:04d}" for i in range(1500)]),
    )


@query
def synth_reference_unique(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    spec = synth.DatasetSpec(
        "unique",
        [
            synth.FieldSpec("row_id", "int", generator=lambda draws: draws.row_id),
            synth.FieldSpec(
                "customer", "reference", reference_pool=synth.TablePool(customers, "c_name"), reference_unique=True
            ),
        ],
    )
    return synth.generate_dataset(spark, spec, rows=customers, row_id="c_custkey", now=SYNTH_NOW)


def _machine_example(spark, sf_dir):
    machines = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"))
    readings = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"))
    specs = synth.machine_specs(machines.count(), readings.count(), SYNTH_NOW)
    return [
        synth.generate_dataset(spark, spec, rows=rows, now=SYNTH_NOW)
        for spec, rows in zip(specs, (machines, readings), strict=True)
    ]


@query
def synth_machines(spark, sf_dir):
    return _machine_example(spark, sf_dir)[0]


@query
def synth_sensors(spark, sf_dir):
    return _machine_example(spark, sf_dir)[1]


@query
def synth_saved(spark, sf_dir):
    """Both feeds generated and saved as JSON lines, as many rows as the given tables have; the saved machines."""
    machines, readings = (spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("customer", "events"))
    specs = synth.machine_specs(machines, readings, SYNTH_NOW)
    paths = synth.generate_and_save(spark, specs, scratch_path(spark, "saved"), now=SYNTH_NOW)
    return spark.read.schema(synth.generate_dataset(spark, specs[0], now=SYNTH_NOW).schema).json(paths["machine_metadata"])
