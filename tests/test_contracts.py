from plantlake.plans import contracts
from plantlake.plans.contracts import contract_report


def tables(spark, path=None):
    made = {
        "dim_machine_h": ([(1, "a"), (1, "b"), (1, None), (None, "c"), (None, "c"), (2, "d")], "machine_sk long, machine_id string"),
        "dim_machine_a": ([("a",), ("a",), (None,)], "machine_id string"),
        "dim_machine_daily": (
            [(1, "a", "2024-01-01", "x"), (None, "a", "2024-01-02", None), (3, None, "2024-01-02", "x"), (3, "2024-01-02", None, "x")],
            "machine_sk long, machine_id string, machine_date string, valid_from string",
        ),
        "fact_sensor_agg": (
            [("a", "2024-01-01"), ("a", "2024-01-03"), ("a", "2024-01-03"), ("b", "2024-01-01"), (None, "2024-01-09"), ("2024-01-01", "a")],
            "machine_id string, machine_date string",
        ),
    }
    return {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in made.items()}


def test_every_kind_of_violation_is_counted_as_declared(spark):
    got = {(r.table_name, r.promise): r.violations for r in contract_report(tables(spark)).collect()}
    assert got == {
        ("dim_machine_h", "primary key (machine_sk)"): 2,
        ("dim_machine_a", "primary key (machine_id)"): 2,
        ("dim_machine_daily", "primary key (machine_id, machine_date)"): 2,
        ("fact_sensor_agg", "primary key (machine_date, machine_id)"): 2,
        ("dim_machine_h", "machine_id not null"): 1,
        ("dim_machine_a", "machine_id not null"): 1,
        ("dim_machine_daily", "machine_sk not null"): 1,
        ("dim_machine_daily", "machine_id not null"): 1,
        ("dim_machine_daily", "machine_date not null"): 1,
        ("dim_machine_daily", "valid_from not null"): 1,
        ("fact_sensor_agg", "machine_date not null"): 0,
        ("fact_sensor_agg", "machine_id not null"): 1,
        ("fact_sensor_agg", "reference (machine_id, machine_date) to dim_machine_daily"): 3,
    }


def test_each_table_is_read_once(spark, tmp_path):
    stored = {}
    for name, df in tables(spark).items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    plan = contract_report(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(stored)


def test_empty_tables_keep_all_promises(spark):
    report = contract_report({name: df.filter("false") for name, df in tables(spark).items()}).collect()
    assert len(report) == 1 + sum(map(len, contracts.NOT_NULL.values())) + len(contracts.PRIMARY_KEYS) and not any(r.violations for r in report)
