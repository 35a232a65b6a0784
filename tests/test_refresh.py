import pytest
from instants import at

from plantlake.operators.layout import materialize
from plantlake.plans import gold, silver
from plantlake.plans.refresh import refresh_gold_days
from plantlake.queries import _config

READING = "reading_id string, machine_id string, machine_timestamp timestamp, temperature double, pressure double, vibration double, power_consumption double, error_code string, is_anomaly boolean, is_high_temperature boolean, is_high_pressure boolean, is_high_vibration boolean, _loading_ts timestamp"
CHANGE = "machine_id string, machine_name string, location string, machine_type string, manufacturer string, installation_date timestamp, timestamp timestamp, status string, max_temperature double, max_pressure double, _loading_ts timestamp"


class Lake:
    """Silver and bronze tables to which a test adds loads."""

    def __init__(self, spark):
        self.spark, self.cfg, self.loads = spark, _config(spark), 0
        self.cfg.create_schemas(spark)

    def load(self, readings=(), changes=()):
        self.loads += 1
        loaded = at(f"2024-03-01T{self.loads:02d}:00:00")
        facts = [(f"r{self.loads}-{k}", m, at(t), v, 1.0, 1.0, v, None, v > 50, False, False, False, loaded) for k, (m, t, v) in enumerate(readings)]
        metadata = [(m, f"name {s}", "here", "kind", "maker", at("2020-01-01T00:00:00"), at(t), s, 1.0, 2.0, loaded) for m, t, s in changes]
        self.spark.createDataFrame(facts, READING).write.mode("append").saveAsTable(f"{self.cfg.silver_schema}.fact_sensor")
        self.spark.createDataFrame(metadata, CHANGE).write.mode("append").saveAsTable(f"{self.cfg.bronze_schema}.machine_metadata")
        materialize(silver.dim_machine_h(self.spark.table(f"{self.cfg.bronze_schema}.machine_metadata")), f"{self.cfg.silver_schema}.dim_machine_h")

    def refresh(self, as_of):
        """The tables, and the days written of each."""
        tables = refresh_gold_days(self.spark, self.cfg, as_of)
        days = {}
        for r in tables["touched"].collect():
            days.setdefault(r.table_name, set()).add(r.machine_date.day)
        return tables, days

    def rebuilt(self, as_of):
        history = self.spark.table(f"{self.cfg.silver_schema}.dim_machine_h")
        daily = gold.dim_machine_daily(history, as_of)
        return {"dim_machine_daily": daily, "fact_sensor_agg": gold.fact_sensor_agg(self.spark.table(f"{self.cfg.silver_schema}.fact_sensor"), daily)}

    def files(self, table):
        return {tuple(f.rsplit("/", 2)[1:]) for f in self.spark.table(f"{self.cfg.gold_schema}.{table}").inputFiles()}


@pytest.fixture
def lake(spark):
    return Lake(spark)


def test_only_touched_days_are_written_and_the_result_is_that_of_a_rebuild(lake, rows):
    def same(tables, as_of):
        for name, df in lake.rebuilt(as_of).items():
            assert tables[name].columns == df.columns
            assert rows(tables[name]) == rows(df), name

    lake.load([("a", "2024-02-01T05:00:00", 10.0), ("b", "2024-02-03T05:00:00", 90.0), ("c", "2024-02-09T01:00:00", 1.0)],
              [("a", "2024-02-01T00:00:00", "on"), ("b", "2024-02-02T12:00:00", "on"), ("a", "2024-02-06T10:00:00", "off")])
    tables, days = lake.refresh("2024-02-08")
    same(tables, "2024-02-08")
    assert days == {"dim_machine_daily": set(range(1, 9)), "fact_sensor_agg": {*range(1, 10)}}

    # A late reading touches its own day, and nothing of the daily table.
    before = lake.files("fact_sensor_agg"), lake.files("dim_machine_daily")
    lake.load([("b", "2024-02-03T06:00:00", 20.0)])
    tables, days = lake.refresh("2024-02-08")
    same(tables, "2024-02-08")
    assert days == {"fact_sensor_agg": {3}}
    assert len(before[0] - lake.files("fact_sensor_agg")) == 1 and before[1] == lake.files("dim_machine_daily")

    # A late version takes the 4th and 5th from the one before it, whose end the daily table shows on all its days.
    lake.load([], [("a", "2024-02-04T09:00:00", "late")])
    tables, days = lake.refresh("2024-02-08")
    same(tables, "2024-02-08")
    assert days == {"dim_machine_daily": {1, 2, 3, 4, 5}, "fact_sensor_agg": {4, 5}}

    # Nothing arrived; then two days begin.
    assert lake.refresh("2024-02-08")[1] == {}
    tables, days = lake.refresh("2024-02-10")
    same(tables, "2024-02-10")
    assert days == {"dim_machine_daily": {9, 10}, "fact_sensor_agg": {9, 10}}
    with pytest.raises(ValueError, match="go back"):
        lake.refresh("2024-02-09")


def test_a_refresh_that_failed_before_its_marks_is_made_good(lake, rows, monkeypatch):
    lake.load([("a", "2024-02-01T05:00:00", 10.0)], [("a", "2024-02-01T00:00:00", "on")])
    lake.refresh("2024-02-03")
    lake.load([("a", "2024-02-02T05:00:00", 30.0)], [("a", "2024-02-02T00:00:00", "off")])
    from plantlake.plans import refresh

    with monkeypatch.context() as broken:
        def fail(*_):
            raise RuntimeError("lost")

        broken.setattr(refresh.gold, "fact_sensor_agg", fail)
        with pytest.raises(RuntimeError, match="lost"):
            lake.refresh("2024-02-03")
    tables, days = lake.refresh("2024-02-03")
    assert days["fact_sensor_agg"] == {2, 3}
    for name, df in lake.rebuilt("2024-02-03").items():
        assert rows(tables[name]) == rows(df)


def test_empty_lake(lake):
    lake.load()
    tables, days = lake.refresh("2024-02-03")
    assert days == {} and tables["fact_sensor_agg"].collect() == [] and tables["dim_machine_daily"].collect() == []
    lake.load([("a", "2024-02-01T05:00:00", 10.0)], [("a", "2024-02-01T00:00:00", "on")])
    assert lake.refresh("2024-02-03")[0]["fact_sensor_agg"].count() == 1
