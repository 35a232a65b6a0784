import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.config import SENSOR_DATA
from plantlake.plans.full_load import load_bronze, read_bronze, schema_memory
from plantlake.queries import _config
from plantlake.sources.landing import parse_lines
from plantlake.sources.schema_memory import SchemaMemory, column_type, promoted


@pytest.mark.parametrize(
    ("kinds", "want"),
    [
        (["BIGINT"], "bigint"), (["DECIMAL(3,1)", "BIGINT"], "double"), (["DOUBLE", "DECIMAL(23,0)"], "double"), (["BOOLEAN", "VOID"], "boolean"),
        (["STRING", "BIGINT"], "string"), (["BOOLEAN", "DOUBLE"], "string"), (["VOID"], None), (["OBJECT<a: BIGINT>"], None), (["ARRAY<BIGINT>", "STRING"], None), ([], None),
    ],
)
def test_the_type_of_a_column_follows_its_values(kinds, want):
    assert column_type(kinds) == want


def rescued(spark, *objects):
    return spark.createDataFrame([(k, json.dumps(o) if o is not None else None) for k, o in enumerate(objects)], "id int, _rescued string")


def test_frequent_keys_are_learnt_once_and_in_order(spark, tmp_path):
    memory = SchemaMemory(str(tmp_path / "log"), least_share=0.4)
    assert memory.learnt(spark) == []
    rows = [{"b": 1, "a": "x"}, {"b": 2.5, "a": "y", "rare": 1}, {"b": 3, "nested": {"x": 1}}, {"nested": [], "ID": 5}, {"nested": 1, "ID": 6}]
    assert [(f.name, f.dataType.simpleString()) for f in memory.learn(rescued(spark, *rows))] == [("a", "string"), ("b", "double")]
    wider = rescued(spark, {"c": True}, {"c": False, "A": 1}, {"A": 2}).withColumns({"a": F.lit(""), "b": F.lit(1.0)})
    assert [f.name for f in memory.learn(wider)] == ["c"]
    assert [(f.name, f.dataType.simpleString()) for f in memory.learnt(spark)] == [("a", "string"), ("b", "double"), ("c", "boolean")]
    assert memory.learn(rescued(spark)) == [] and memory.learn(rescued(spark, None, None)) == []


def test_two_deliveries_and_values_that_do_not_fit(spark, tmp_path):
    cfg = _config(spark)
    cfg.create_schemas(spark)
    base = tmp_path / "landing"
    cfg = type(cfg)(**{**cfg.__dict__, "machine_uploads_base": str(base)})
    folder = base / "sensor_data"
    folder.mkdir(parents=True)

    def load(name, *rows):
        (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
        load_bronze(spark, cfg, SENSOR_DATA, evolve=True)
        return {r.reading_id: r.asDict() for r in read_bronze(spark, cfg, SENSOR_DATA).collect()}

    got = load("1.json", {"reading_id": "r1", "temperature": "hot"}, {"reading_id": "r2"})
    assert "count" not in got["r1"] and got["r1"]["_rescued"] == '{"temperature":"hot"}'
    got = load("2.json", {"reading_id": "r3", "count": 7, "site": {"a": 1}}, {"reading_id": "r4", "count": 8})
    assert [f.simpleString() for f in schema_memory(cfg, SENSOR_DATA).learnt(spark)] == ["count:bigint"]
    assert {k: (r["count"], r["_rescued"]) for k, r in got.items()} == {
        "r1": (None, '{"temperature":"hot"}'), "r2": (None, None), "r3": (7, '{"site":{"a":1}}'), "r4": (8, None),
    }
    got = load("3.json", {"reading_id": "r5", "count": 9}, {"reading_id": "r6", "count": "many"}, {"reading_id": "r7", "count": 2.5})
    assert {k: (r["count"], r["_rescued"]) for k, r in got.items() if k > "r4"} == {
        "r5": (9, None), "r6": (None, '{"count":"many"}'), "r7": (None, '{"count":2.5}'),
    }
    assert got["r3"]["count"] == 7 and got["r2"]["count"] is None
    # The stored files are as they were; only the fifth row has the column in its file.
    stored = spark.table(f"{cfg.bronze_schema}.sensor_data")
    assert [r.reading_id for r in stored.filter("count IS NOT NULL").collect()] == ["r5"]


def test_a_line_and_a_rescue_are_parsed_once(spark, tmp_path):
    """The plans hold each parse once, however often its result is read."""
    learnt = [T.StructField("a", T.LongType()), T.StructField("__held", T.StringType())]
    lines = spark.createDataFrame([('{"reading_id":"r","a":"x","__held":"y","more":1}', 2)], "value string, __row int").coalesce(1)
    lines.write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    parsed = parse_lines(lines, SENSOR_DATA.schema)
    old = parsed.withColumns({"a": F.lit(None).cast("long"), "__held": F.lit(None).cast("string")})
    old.write.parquet(str(tmp_path / "old"))
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        for made, calls in ((parsed, ("from_json", "jsonobjectkeys", "parse_json")), (promoted(spark.read.parquet(str(tmp_path / "old")), learnt), ("parse_json",))):
            plan = made._jdf.queryExecution().optimizedPlan().toString().lower().replace("jsontostructs", "from_json").replace("parsejson", "parse_json")
            assert [len(re.findall(call + r"\w*\(", plan)) for call in calls] == [1] * len(calls), plan
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    (row,) = promoted(spark.read.parquet(str(tmp_path / "old")), learnt).collect()
    assert (row["a"], row["__held"], row["__row"], row["_rescued"]) == (None, "y", 2, '{"a":"x","more":1}')
