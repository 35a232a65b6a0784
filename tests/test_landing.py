import json
from pathlib import Path

import pytest
from instants import at

from plantlake.config import SENSOR_DATA
from plantlake.operators.layout import cluster_by_curve, cluster_rows, compact, files_in_range
from plantlake.plans.full_load import load_bronze
from plantlake.queries import _config
from plantlake.sources.files import read_table_file, write_json_lines
from plantlake.sources.landing import LINEAGE, parse_lines

GOOD = {
    "reading_id": "r1", "machine_id": "m", "timestamp": "2024-01-01T10:00:00.123456+00:00", "temperature": 20,
    "pressure": 1.5, "vibration": 2.0, "power_consumption": 3.0, "error_code": None, "is_anomaly": True,
}


def parsed(spark, *lines):
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    return parse_lines(spark.createDataFrame([(t,) for t in texts], "value string"), SENSOR_DATA.schema).collect()


def test_good_line(spark):
    (row,) = parsed(spark, GOOD)
    assert row["timestamp"] == at("2024-01-01T10:00:00.123456")
    assert (row["temperature"], row["error_code"], row["is_anomaly"], row["_rescued"]) == (20.0, None, True, None)


def test_missing_keys_and_nulls_lose_nothing(spark):
    (row,) = parsed(spark, {"reading_id": "r", "pressure": None})
    assert row["_rescued"] is None


def test_wrong_type_and_unknown_keys_are_rescued(spark):
    lost = {"temperature": "hot", "is_anomaly": 7, "vibration": {"x": [True, None]}, "extra": {"a": [1, 2.5]}, "big": 12345678901234567890123}
    (row,) = parsed(spark, {**GOOD, **lost, "none": None})
    assert (row["temperature"], row["is_anomaly"], row["vibration"], row["pressure"]) == (None, None, None, 1.5)
    assert json.loads(row["_rescued"]) == lost


@pytest.mark.parametrize("line", ['{"reading_id": "r", "temp', "not json", "[1, 2]", "5", '{"machine_id": "a", "machine_id": "b", "x": 1}'])
def test_broken_line_is_kept_whole(spark, line):
    (row,) = parsed(spark, line)
    assert row["reading_id"] is None
    assert row["_rescued"] == line


def test_blank_lines_are_no_rows(spark):
    assert parsed(spark, "", "   ") == []


def test_timestamp_forms(spark):
    forms = ["2024-01-01T10:00:00+02:00", "2024-01-01T10:00:00", "2024-01-01"]
    got = [r["timestamp"] for r in parsed(spark, *[{**GOOD, "timestamp": f} for f in forms])]
    assert got == [at("2024-01-01T08:00:00"), at("2024-01-01T10:00:00"), at("2024-01-01T00:00:00")]


def test_increments_glob_lineage_and_archive(spark):
    cfg = _config(spark)
    cfg.create_schemas(spark)
    folder = Path(cfg.machine_uploads_base, "sensor_data")
    folder.mkdir(parents=True)
    table = f"{cfg.bronze_schema}.sensor_data"

    def load(name=None, *ids):
        if name:
            folder.joinpath(name).write_text("".join(json.dumps({**GOOD, "reading_id": i}) + "\n" for i in ids))
        load_bronze(spark, cfg, SENSOR_DATA, archive=True)
        return sorted(r[0] for r in spark.read.table(table).select("reading_id").collect())

    assert load("one.json", "a", "b") == ["a", "b"]
    assert load("two.txt", "no") == ["a", "b"]
    assert load("three.json", "c") == ["a", "b", "c"]
    assert load() == ["a", "b", "c"]
    assert not folder.joinpath("one.json").exists()
    assert list(Path(cfg.machine_uploads_base, "_archive", "sensor_data").rglob("one.json"))

    row = spark.read.table(table).filter("reading_id = 'c'").first()
    assert row["_file_name"] == "three.json" and row["_file_path"].endswith("sensor_data/three.json")
    assert row["_file_size"] > 0 and row["_loading_ts"] >= row["_file_modification_time"]
    assert spark.read.table(table).columns == [*SENSOR_DATA.schema.names, "_rescued", *LINEAGE]
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert described["Comment"] == SENSOR_DATA.comment
    assert "quality=bronze" in described["Table Properties"]


def test_json_lines_append_and_write_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None)], "id int, name string, value double")
    paths = [write_json_lines({"things": df}, str(tmp_path)) for _ in range(2)][0]
    assert paths == {"things": f"{tmp_path}/things"}
    lines = [line for f in Path(paths["things"]).glob("*.json") for line in f.read_text().splitlines()]
    assert lines == ['{"id":1,"name":"é","value":null}'] * 2


def test_table_files(spark, rows, tmp_path):
    tmp_path.joinpath("t.json").write_text(json.dumps([{"id": 1, "name": "a"}, {"id": 2, "name": None}], indent=1))
    tmp_path.joinpath("t.csv").write_text("id,name\n1,a\n2,b\n")
    assert rows(read_table_file(spark, f"{tmp_path}/t.json"), "id", "name") == [(1, "a"), (2, None)]
    csv = read_table_file(spark, f"{tmp_path}/t.csv")
    assert csv.dtypes == [("id", "string"), ("name", "string")]
    assert rows(csv) == [("1", "a"), ("2", "b")]
    with pytest.raises(ValueError):
        read_table_file(spark, f"{tmp_path}/t.xml")


def test_clustered_files_have_disjoint_ranges_and_split_equal_keys(spark, tmp_path):
    df = spark.range(4000).selectExpr("id % 100 AS k", "id AS v")
    cluster_rows(df, ["k"], 4).write.parquet(f"{tmp_path}/t")
    spans = sorted(
        tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").groupBy("_metadata.file_name").agg({"k": "min"}).join(
            spark.read.parquet(f"{tmp_path}/t").groupBy("_metadata.file_name").agg({"k": "max"}), "file_name"
        ).select("min(k)", "max(k)").collect()
    )
    assert len(spans) == 4
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))

    cluster_rows(df.selectExpr("1 AS k", "v"), ["k"], 4).write.parquet(f"{tmp_path}/hot")
    counts = [r[1] for r in spark.read.parquet(f"{tmp_path}/hot").groupBy("_metadata.file_name").count().collect()]
    assert len(counts) == 4 and max(counts) < 2000


def test_a_curve_is_narrow_in_every_column_and_splits_hot_values(spark, tmp_path):
    df = spark.range(6000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 97)) AS k", "id * 7919 % 6000 AS v", "IF(id % 50 = 0, NULL, id % 11) AS n")
    cluster_by_curve(df, ["k", "v"], 36).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    for column, low, high in (("k", "k40", "k40"), ("v", 3000, 3100)):
        opened, every = files_in_range(stored, column, low, high)
        assert 0 < opened <= every / 2, column
    # The hot key alone fills several files, none of them far above the mean.
    counts = [r[1] for r in stored.groupBy("_metadata.file_name").count().collect()]
    assert len(counts) >= 20 and max(counts) < 4 * 6000 / len(counts)
    assert cluster_by_curve(df.filter("false"), ["k", "n"]).count() == 0


def test_compaction_keeps_the_rows_of_a_table(spark, rows, tmp_path):
    spark.sql(f"CREATE DATABASE compacted LOCATION '{tmp_path}/db'")
    for part in range(5):
        spark.range(part * 10, part * 10 + 10).selectExpr("id", "CAST(NULL AS STRING) AS name", "id % 3 AS k").write.mode("append").saveAsTable("compacted.t")
    before = rows(spark.table("compacted.t"))
    compact(spark, "compacted.t", ["k", "name"], 2)
    assert rows(spark.table("compacted.t")) == before
    assert len(spark.table("compacted.t").inputFiles()) <= 2
