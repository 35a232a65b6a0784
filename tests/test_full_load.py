import datetime as dt

from pyspark.sql import functions as F

from plantlake.config import MACHINE_METADATA, SENSOR_DATA
from plantlake.operators.quality import primary_key_violations
from plantlake.plans import alerts, gold, silver, synth
from plantlake.plans.full_load import run_full_load
from plantlake.queries import _config

NOW = dt.datetime(2024, 1, 31, 12, 0, 0, tzinfo=dt.timezone.utc)
AS_OF = "2024-02-01"


def near(got, want):
    """Equal, except that a rounded sum or average of doubles may differ in its last digit:
    doubles add up in another order when the files are cut differently."""
    return len(got) == len(want) and all(
        abs(a - b) < 0.0101 if isinstance(a, float) and isinstance(b, float) else a == b
        for x, y in zip(got, want, strict=True)
        for a, b in zip(x, y, strict=True)
    )


def generate(spark, cfg, seed):
    synth.generate_and_save(spark, synth.machine_specs(12, 400, NOW), cfg.machine_uploads_base, seed, NOW)


def test_two_loads_equal_one_batch_over_everything(spark, rows):
    cfg = _config(spark)
    generate(spark, cfg, 1)
    first = run_full_load(spark, cfg, AS_OF, buckets=4)
    assert first.rule_counts["total"] == 400
    assert first.tables["fact_sensor"].count() == 400
    generate(spark, cfg, 2)  # versions older and newer than the stored ones
    second = run_full_load(spark, cfg, AS_OF, buckets=4)
    assert second.rule_counts["total"] == 400

    landed = {
        spec: spark.read.schema(spec.schema).json(f"{cfg.machine_uploads_base}/{spec.source_path}")
        for spec in (MACHINE_METADATA, SENSOR_DATA)
    }
    history = silver.dim_machine_h(landed[MACHINE_METADATA])
    facts = silver.fact_sensor(landed[SENSOR_DATA])
    daily = gold.dim_machine_daily(history, AS_OF)
    agg = gold.fact_sensor_agg(facts, daily)
    want = {
        "dim_machine_h": gold.dim_machine_h(history),
        "dim_machine_a": gold.dim_machine_a(history),
        "dim_machine_daily": daily,
        "fact_sensor": gold.fact_sensor(facts, history, method="direct"),
        "fact_sensor_agg": agg,
    }
    assert history.count() == 24
    for name, df in want.items():
        assert second.tables[name].columns == df.columns, name
        assert near(rows(second.tables[name]), rows(df)), name
    assert rows(second.alert) == rows(alerts.alert_anomaly_rate(agg, AS_OF))
    assert primary_key_violations(second.tables["dim_machine_h"], ["machine_sk"]).count() == 0

    stored = spark.sql(f"DESCRIBE {cfg.gold_schema}.fact_sensor_agg").filter("col_name = 'machine_sk'").first()
    assert stored["comment"]
    other = spark.newSession()
    assert other.table(f"{cfg.gold_schema}.dim_machine_h").schema["is_current"].metadata["comment"]
    assert rows(other.table(f"{cfg.gold_schema}.fact_sensor")) == rows(second.tables["fact_sensor"])
    broken = {(r["table_name"], r["promise"]): r["violations"] for r in second.contract.collect()}
    assert len(broken) == 13 and all(n == 0 for (_, promise), n in broken.items() if not promise.startswith("reference"))
    declared = spark.table(f"{cfg.silver_schema}.dim_machine_h").drop("bucket")
    assert second.tables["dim_machine_a"].columns == [c for c in silver.HISTORY_COLUMNS if c != "__END_AT"]
    assert set(declared.columns) == set(silver.HISTORY_COLUMNS)

    third = run_full_load(spark, cfg, AS_OF, buckets=4)  # nothing new arrived
    assert near(rows(third.tables["fact_sensor_agg"]), rows(agg))
    assert third.tables["fact_sensor"].agg(F.count("*")).first()[0] == 800


def test_touched_days_give_the_tables_of_a_rebuild(spark, rows):
    cfg = _config(spark)
    for seed in (1, 2):
        generate(spark, cfg, seed)
        tables = run_full_load(spark, cfg, AS_OF, buckets=4, touched_days=True).tables
    history = spark.table(f"{cfg.silver_schema}.dim_machine_h").select(*silver.HISTORY_COLUMNS)
    daily = gold.dim_machine_daily(history, AS_OF)
    agg = gold.fact_sensor_agg(spark.table(f"{cfg.silver_schema}.fact_sensor"), daily)
    for name, df in {"dim_machine_daily": daily, "fact_sensor_agg": agg}.items():
        assert tables[name].columns == df.columns, name
        assert near(rows(tables[name]), rows(df)), name
    assert tables["fact_sensor_agg"].schema["machine_sk"].metadata["comment"]
