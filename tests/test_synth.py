"""Properties of the generator: values depend on seed, dataset, field and row alone, and follow their distributions."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantlake.functions.draws import Draws
from plantlake.plans import synth
from plantlake.plans.synth import DatasetSpec, FieldSpec, IdPool, TablePool, generate_dataset

NOW = dt.datetime(2031, 5, 4, 3, 2, 1, 7000, tzinfo=dt.timezone(dt.timedelta(hours=5)))


def draw(spark, field, n=400, seed=9, name="set", **options):
    spec = DatasetSpec(name, [FieldSpec("row", "int", generator=lambda d: d.row_id), field], n)
    made = generate_dataset(spark, spec, seed, now=NOW, **options).collect()
    return [r[1] for r in sorted(made, key=lambda r: r[0])]


KINDS = [
    FieldSpec("v", "int", min_value=-3, max_value=3),
    FieldSpec("v", "float", min_value=-0.5, max_value=0.5),
    FieldSpec("v", "string"),
    FieldSpec("v", "bool"),
    FieldSpec("v", "uuid"),
    FieldSpec("v", "datetime"),
    FieldSpec("v", "choice", choices=["n", "e", "s", "w"]),
    FieldSpec("v", "faker", faker_method="city"),
    FieldSpec("v", "reference", reference_pool=["q", "r", "t"]),
]


@pytest.mark.parametrize("field", KINDS, ids=lambda f: f.field_type)
def test_values_are_a_function_of_seed_dataset_and_row(spark, field):
    rows = spark.range(300)
    a = draw(spark, field, rows=rows.repartition(1))
    assert a == draw(spark, field, rows=rows.repartition(6))
    assert a[:50] == draw(spark, field, rows=rows.filter("id < 50"))
    assert a != draw(spark, field, rows=rows, seed=10) and a != draw(spark, field, rows=rows, name="other")


def test_each_member_of_a_range_is_about_equally_likely(spark):
    counts = {}
    for v in draw(spark, FieldSpec("v", "int", min_value=-3, max_value=3), 7000):
        counts[v] = counts.get(v, 0) + 1
    assert sorted(counts) == list(range(-3, 4)) and all(850 < c < 1150 for c in counts.values())


def test_ranges_beyond_32_bits_use_their_low_digits(spark):
    got = draw(spark, FieldSpec("v", "int", min_value=0, max_value=2**45 - 1), 2000)
    assert len({v % 64 for v in got}) == 64 and max(got) > 2**44
    with pytest.raises(ValueError):
        draw(spark, FieldSpec("v", "int", min_value=0, max_value=2**60))


def test_instants_keep_zone_and_fraction_over_a_long_span(spark):
    low, high = dt.datetime(1890, 2, 28, 23, 59, 58), dt.datetime(2120, 3, 1)
    got = [dt.datetime.fromisoformat(v) for v in draw(spark, FieldSpec("v", "datetime", min_value=low.isoformat(), max_value=high.isoformat()))]
    assert all(low <= v <= high and v.tzinfo is None for v in got)
    assert min(got).year < 1905 and max(got).year > 2105
    recent = {NOW - dt.datetime.fromisoformat(v) for v in draw(spark, FieldSpec("v", "datetime"), 900)}
    assert recent == {dt.timedelta(days=k) for k in range(31)}


def test_a_change_of_the_session_zone_changes_nothing(spark):
    field = FieldSpec("v", "datetime", min_value="2030-10-27T00:00:00", max_value="2030-10-27T05:00:00")
    before = draw(spark, field)
    spark.conf.set("spark.sql.session.timeZone", "America/St_Johns")
    try:
        assert draw(spark, field) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("size", [2, 999, 1000, 1001, 1700])
def test_a_list_pool_is_drawn_by_position_whatever_its_length(spark, size):
    drawn = draw(spark, FieldSpec("v", "reference", reference_pool=[f"z{size - i}" for i in range(size)]))
    positions = draw(spark, FieldSpec("v", "int", min_value=0, max_value=size - 1))
    assert drawn == [f"z{size - p}" for p in positions]


def test_pools_with_null_members_and_of_tables_and_ids(spark):
    assert set(draw(spark, FieldSpec("v", "reference", reference_pool=[None, 5]), 60)) == {None, 5}
    evens = TablePool(spark.range(90).select((F.col("id") * 2).alias("k")).repartition(5), "k")
    positions = draw(spark, FieldSpec("v", "int", min_value=0, max_value=89))
    assert draw(spark, FieldSpec("v", "reference", reference_pool=evens)) == [2 * p for p in positions]
    assert draw(spark, FieldSpec("v", "reference", reference_pool=IdPool("K", 90, 3))) == [f"K{p + 1:03d}" for p in positions]


def test_the_order_of_a_unique_reference_does_not_depend_on_how_the_pool_is_held(spark):
    names = [f"U-{i:04d}" for i in range(1, 1301)]

    def of(pool, n=1300):
        return draw(spark, FieldSpec("v", "reference", reference_pool=pool, reference_unique=True), n)

    by_list = of(names)
    assert sorted(by_list) == names and by_list != names
    assert by_list == of(IdPool("U-", 1300)) == of(TablePool(spark.createDataFrame([(n,) for n in names], ["n"]), "n"))
    assert of(names, 40) == by_list[:40]
    with_null = of([*names[:30], None], 31)
    assert sorted(v for v in with_null if v) == names[:30] and with_null.count(None) == 1


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4099])
def test_a_shuffle_is_a_bijection_of_its_own_for_each_seed_and_field(spark, n):
    def of(seed, field):
        d = Draws(seed, "set", field, F.col("id"))
        return [r[0] for r in spark.range(n).coalesce(1).select("id", d.shuffled(n).alias("at")).orderBy("id").select("at").collect()]

    first = of(1, "a")
    assert sorted(first) == list(range(n)) and of(1, "a") == first
    if n > 50:
        assert first != list(range(n)) and of(2, "a") != first and of(1, "b") != first
        # Neighbours are taken apart: no more short steps than chance has.
        assert sum(abs(a - b) <= n // 20 for a, b in zip(first, first[1:])) < 0.3 * n


def test_a_unique_reference_into_computed_ids_needs_no_job_and_no_shuffle(spark):
    spec = DatasetSpec("set", [FieldSpec("v", "reference", reference_pool=IdPool("K", 10**9), reference_unique=True)], 10**6)
    spark.sparkContext.setJobGroup("synth", "no job is expected")
    plan = generate_dataset(spark, spec)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("synth") == []
    spark.sparkContext.setJobGroup("other", "")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.limit(3).count() == 3


def test_unique_references_refuse_rows_they_cannot_serve(spark):
    field = FieldSpec("v", "reference", reference_pool=["a", "b", "c"], reference_unique=True)
    for rows in (spark.range(4), spark.range(1, 4), spark.range(-1, 1)):
        with pytest.raises(ValueError, match="unique values"):
            draw(spark, field, rows=rows)
    assert draw(spark, field, rows=spark.range(0)) == []


def test_a_unique_reference_comes_before_a_generator(spark):
    field = FieldSpec("v", "reference", reference_pool=["a", "b"], reference_unique=True, generator=F.lit("g"))
    assert sorted(draw(spark, field, 2)) == ["a", "b"]
    field = FieldSpec("v", "reference", reference_pool=["a", "b"], generator=F.lit("g"))
    assert draw(spark, field, 2) == ["g", "g"]


@pytest.mark.parametrize("p", [0.0, 0.25, 1.0])
def test_nulls_come_at_their_rate_and_leave_the_other_values_alone(spark, p):
    plain = draw(spark, FieldSpec("v", "int"), 3000)
    nulled = draw(spark, FieldSpec("v", "int", nullable=True, null_probability=p), 3000)
    assert abs(nulled.count(None) / 3000 - p) < 0.03
    assert all(b in (None, a) for a, b in zip(plain, nulled, strict=True))
    assert draw(spark, FieldSpec("v", "int", nullable=True, null_probability=p, generator=F.lit(1)), 3000).count(None) == nulled.count(None)


def test_uuids_are_distinct_and_of_version_four(spark):
    got = draw(spark, FieldSpec("v", "uuid"), 2000)
    assert len(set(got)) == 2000
    assert {(len(v), v[8], v[13], v[14], v[18], v[23]) for v in got} == {(36, "-", "-", "4", "-", "-")} and {v[19] for v in got} == set("89ab")


@pytest.mark.parametrize("method", sorted(synth.PROVIDERS))
def test_providers_combine_their_vocabularies(spark, method):
    got = draw(spark, FieldSpec("v", "faker", faker_method=method))
    words = synth.WORDS + synth.COUNTRIES + synth.SURNAMES + synth.FIRST_NAMES + synth.CITY_STEMS + synth.STREETS
    lower = [w.lower() for w in words]
    assert all(any(w in v.lower() for w in lower) for v in got) and len(set(got)) >= 10


@pytest.mark.parametrize(
    "field",
    [
        FieldSpec("v", "tensor"),
        FieldSpec("v", "choice"),
        FieldSpec("v", "faker", faker_method="starship"),
        FieldSpec("v", "reference", generator=None),
        FieldSpec("v", "reference", reference_unique=True),
    ],
    ids=lambda f: f"{f.field_type}-{f.reference_unique}",
)
def test_specs_that_cannot_be_generated(spark, field):
    with pytest.raises(ValueError, match="field 'v'"):
        generate_dataset(spark, DatasetSpec("set", [field], 1))


def test_a_second_delivery_is_added_to_the_first(spark, tmp_path):
    spec = DatasetSpec("feed", [FieldSpec("n", "int"), FieldSpec("gone", "float", nullable=True, null_probability=1.0)], 6)
    for seed in (1, 2):
        place = synth.generate_and_save(spark, [spec], str(tmp_path), seed)["feed"]
    lines = [json.loads(x) for f in Path(place).glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 12 and all(x["gone"] is None and set(x) == {"n", "gone"} for x in lines)


def test_readings_refer_to_machines_and_both_feeds_have_their_landing_columns(spark):
    from plantlake.config import MACHINE_METADATA, SENSOR_DATA

    machines, readings = (generate_dataset(spark, s, seed=3, now=NOW) for s in synth.machine_specs(30, 3000, NOW))
    assert machines.columns == MACHINE_METADATA.schema.names and readings.columns == SENSOR_DATA.schema.names
    assert machines.select("machine_id").distinct().count() == 30
    assert readings.join(machines, "machine_id", "left_anti").count() == 0
    share = readings.agg(F.avg(F.col("error_code").isNull().cast("int"))).first()[0]
    assert abs(share - (0.8 + 0.2 / 6)) < 0.03
