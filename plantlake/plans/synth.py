"""Synthetic tables from field specifications, generated on the executors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.functions.draws import IS_NULL, SECOND, THIRD, VALUE, Draws
from plantlake.operators.ordering import dense_number
from plantlake.sources.files import write_json_lines

DEFAULT_SEED = 42


@dataclass(frozen=True)
class IdPool:
    """The ids ``<prefix>0001`` … of a pool of any size; a member is computed, not stored."""

    prefix: str
    size: int
    digits: int = 4

    def member(self, index: Column) -> Column:
        return F.format_string(f"{self.prefix}%0{self.digits}d", (index + 1).cast("bigint"))


@dataclass(frozen=True)
class TablePool:
    """A pool held in a column of a table."""

    source: DataFrame
    column: str

    def table(self, spark: SparkSession) -> DataFrame:
        return self.source.select(F.col(self.column).alias("value"))


Pool = Sequence | IdPool | TablePool


# Attribute names, defaults and order of the two specifications.
@dataclass
class FieldSpec:
    """How one field is generated."""

    name: str
    field_type: str
    generator: Column | Callable[[Draws], Column] | None = None
    min_value: Any = None
    max_value: Any = None
    choices: Sequence | None = None
    reference_pool: Pool | None = None
    reference_unique: bool = False
    faker_method: str | None = None
    nullable: bool = False
    null_probability: float = 0.1


@dataclass
class DatasetSpec:
    """A named table of generated fields."""

    name: str
    fields: list[FieldSpec]
    num_records: int = 100


# Vocabularies of the named text providers.
WORDS = ["anchor", "basin", "copper", "dynamo", "ember", "flange", "gasket", "harbor", "ingot", "journal", "kiln",
         "lever", "magnet", "nozzle", "orbit", "piston", "quarry", "rivet", "socket", "turbine"]
SURNAMES = ["Abbott", "Brandt", "Castillo", "Duarte", "Eriksen", "Fischer", "Grant", "Hoffman", "Ivanova", "Jensen",
            "Keller", "Lindgren", "Moreau", "Novak", "Okafor", "Petrov", "Quinn", "Rossi", "Sato", "Turner"]
FIRST_NAMES = ["Ada", "Bruno", "Clara", "Diego", "Elif", "Farid", "Greta", "Hugo", "Ines", "Jonas", "Kaori", "Liam",
               "Mina", "Nils", "Olga", "Pablo", "Rana", "Samir", "Tess", "Viktor"]
COMPANY_FORMS = ["Ltd", "Inc", "Group", "GmbH", "and Sons", "LLC"]
CITY_STEMS = ["North", "East", "South", "West", "Lake", "Port", "New", "Fort"]
CITY_ENDS = ["ville", "bury", "town", "ford", "burgh", "mouth", "stad", "haven"]
STREETS = ["Mill Road", "Foundry Street", "Station Avenue", "Canal Lane", "Quarry Hill", "Market Square"]
COUNTRIES = ["Austria", "Brazil", "Canada", "Denmark", "Egypt", "Finland", "Ghana", "Hungary", "India", "Japan"]
MAIL_DOMAINS = ["example.com", "example.net", "example.org"]


def _city(d: Draws) -> Column:
    return F.concat(d.pick(CITY_STEMS, VALUE), F.lit(" "), d.pick(SURNAMES, SECOND), d.pick(CITY_ENDS, THIRD))


def _email(d: Draws) -> Column:
    first, last = F.lower(d.pick(FIRST_NAMES, VALUE)), F.lower(d.pick(SURNAMES, SECOND))
    return F.concat(first, F.lit("."), last, F.lit("@"), d.pick(MAIL_DOMAINS, THIRD))


PROVIDERS: dict[str, Callable[[Draws], Column]] = {
    "word": lambda d: d.pick(WORDS),
    "country": lambda d: d.pick(COUNTRIES),
    "name": lambda d: F.concat(d.pick(FIRST_NAMES), F.lit(" "), d.pick(SURNAMES, SECOND)),
    "company": lambda d: F.concat(d.pick(SURNAMES), F.lit(" "), d.pick(COMPANY_FORMS, SECOND)),
    "city": _city,
    "email": _email,
    "address": lambda d: F.concat((d.below(999) + 1).cast("string"), F.lit(" "), d.pick(STREETS, SECOND)),
}


def _or_default(value: Any, default: Any) -> Any:
    return default if value is None else value


def _integer(f: FieldSpec, d: Draws, now: dt.datetime) -> Column:
    return d.integer(int(_or_default(f.min_value, 0)), int(_or_default(f.max_value, 1000)))


def _real(f: FieldSpec, d: Draws, now: dt.datetime) -> Column:
    return d.real(float(_or_default(f.min_value, 0)), float(_or_default(f.max_value, 1000)))


def _datetime(f: FieldSpec, d: Draws, now: dt.datetime) -> Column:
    if f.min_value is None or f.max_value is None:
        return d.days_back(now)
    return d.instant(dt.datetime.fromisoformat(str(f.min_value)), dt.datetime.fromisoformat(str(f.max_value)))


def _choice(f: FieldSpec, d: Draws, now: dt.datetime) -> Column:
    if f.choices is None:
        raise ValueError(f"field '{f.name}': type 'choice' needs 'choices'")
    return d.pick(f.choices)


def _provider(f: FieldSpec, d: Draws, now: dt.datetime) -> Column:
    if f.faker_method not in PROVIDERS:
        raise ValueError(f"field '{f.name}': no text provider '{f.faker_method}'")
    return PROVIDERS[f.faker_method](d)


KINDS: dict[str, Callable[[FieldSpec, Draws, dt.datetime], Column]] = {
    "int": _integer,
    "float": _real,
    "string": lambda f, d, now: d.pick(WORDS),
    "bool": lambda f, d, now: d.coin(),
    "datetime": _datetime,
    "uuid": lambda f, d, now: d.uuid(),
    "choice": _choice,
    "faker": _provider,
}


def field_value(f: FieldSpec, d: Draws, now: dt.datetime) -> Column:
    """Expression of a field that needs no join; the NULL draw comes before everything else."""
    if f.generator is not None:
        value = f.generator if isinstance(f.generator, Column) else f.generator(d)
    elif f.field_type in KINDS:
        value = KINDS[f.field_type](f, d, now)
    else:
        raise ValueError(f"field '{f.name}': unsupported type '{f.field_type}'")
    return _nulled(f, d, value)


def _nulled(f: FieldSpec, d: Draws, value: Column) -> Column:
    return F.when(d.unit(IS_NULL) >= F.lit(f.null_probability), value) if f.nullable else value


def _numbered_pool(spark: SparkSession, pool: Pool) -> tuple[DataFrame, int]:
    """The pool as value, _at (0, 1, 2 …) and its size: list pools by their order, table pools by value."""
    if isinstance(pool, TablePool):
        numbered = dense_number(pool.table(spark), ["value"], "_at")
        return numbered, numbered.count()
    values = [(v, i) for i, v in enumerate(pool)]
    kind = spark.createDataFrame([(v,) for v in pool if v is not None][:1] or [("",)], ["value"]).schema["value"].dataType
    return spark.createDataFrame(values, T.StructType([T.StructField("value", kind), T.StructField("_at", T.LongType())])), len(pool)


def generate_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    seed: int = DEFAULT_SEED,
    rows: DataFrame | None = None,
    row_id: str = "id",
    now: dt.datetime | None = None,
) -> DataFrame:
    """All fields of ``spec`` for ``num_records`` rows, or for each row of ``rows`` by its id.

    Ids of ``rows`` must be distinct; with unique references they must lie between 0 and the size of
    the pool. Plain fields cost no shuffle. A reference into a list or a table is a join on the drawn
    position, whatever its length. A unique reference takes a shuffled position instead, and computed ids need no join at all.
    """
    known = None
    if rows is None:
        rows, row_id, known = spark.range(spec.num_records), "id", spec.num_records
    now = now or dt.datetime.now()
    base = rows.select(F.col(row_id).alias("_row"))
    exprs: dict[str, Column] = {}
    for f in spec.fields:
        d = Draws(seed, spec.name, f.name, F.col("_row"))
        # A unique reference comes before a generator of the same field.
        if f.field_type == "reference" and (f.generator is None or f.reference_unique):
            if f.reference_pool is None:
                raise ValueError(f"field '{f.name}': type 'reference' needs 'reference_pool'")
            if f.reference_unique:
                base = _add_unique_reference(base, f, d, known)
                exprs[f.name] = F.col(f.name)
            elif isinstance(f.reference_pool, IdPool):
                exprs[f.name] = _nulled(f, d, f.reference_pool.member(d.below(f.reference_pool.size)))
            else:
                base = _add_reference(base, f, d)
                exprs[f.name] = _nulled(f, d, F.col(f.name))
            continue
        exprs[f.name] = field_value(f, d, now)
    return base.select(*[exprs[f.name].alias(f.name) for f in spec.fields])


def _add_reference(base: DataFrame, f: FieldSpec, d: Draws) -> DataFrame:
    numbered, size = _numbered_pool(base.sparkSession, f.reference_pool)
    drawn = base.withColumn("_at", d.below(size))
    return drawn.join(numbered.withColumnRenamed("value", f.name), "_at", "left").drop("_at")


def _add_unique_reference(base: DataFrame, f: FieldSpec, d: Draws, known: int | None) -> DataFrame:
    """Each row gets the member at its place in a seeded shuffle of the pool, so members don't repeat.

    Ids of a computed pool need no join. ``known`` says that the row ids are 0 … known-1; others are checked by an aggregate.
    """
    pool = f.reference_pool
    numbered, size = (None, pool.size) if isinstance(pool, IdPool) else _numbered_pool(base.sparkSession, pool)
    wanted, least, most = (known, 0, known - 1) if known is not None else base.agg(F.count("*"), F.min("_row"), F.max("_row")).first()
    if wanted and (size < wanted or least < 0 or most >= size):
        raise ValueError(
            f"field '{f.name}': {wanted} records with ids {least} to {most} need as many unique values, the pool has {size}"
        )
    if not size:
        return base.withColumn(f.name, F.lit(None).cast("string"))
    if numbered is None:
        return base.withColumn(f.name, pool.member(d.shuffled(size)))
    return base.withColumn("_at", d.shuffled(size)).join(numbered.withColumnRenamed("value", f.name), "_at", "left").drop("_at")


def machine_specs(
    num_machines: int = 10, num_sensor_readings: int = 1000, now: dt.datetime | None = None
) -> list[DatasetSpec]:
    """The two machine feeds: each machine once, and readings that refer to the machines."""
    now = now or dt.datetime.now(tz=dt.timezone.utc)
    ids = IdPool("MACH-", num_machines)

    def ago(days: int) -> str:
        return (now - dt.timedelta(days=days)).isoformat()

    # Field names, ranges, choices and null share of the two feeds.
    machines = DatasetSpec(
        "machine_metadata",
        [
            FieldSpec("machine_id", "reference", reference_pool=ids, reference_unique=True),
            FieldSpec("machine_name", "faker", faker_method="company"),
            FieldSpec("location", "faker", faker_method="city"),
            FieldSpec(
                "machine_type", "choice", choices=["CNC Mill", "Lathe", "3D Printer", "Laser Cutter", "Welding Robot"]
            ),
            FieldSpec("manufacturer", "faker", faker_method="company"),
            FieldSpec("installation_date", "datetime", min_value="2020-01-01", max_value="2025-12-31"),
            FieldSpec("timestamp", "datetime", min_value=ago(30), max_value=ago(8)),
            FieldSpec("status", "choice", choices=["operational", "maintenance", "offline"]),
            FieldSpec("max_temperature", "float", min_value=50.0, max_value=200.0),
            FieldSpec("max_pressure", "float", min_value=5.0, max_value=50.0),
        ],
        num_machines,
    )
    readings = DatasetSpec(
        "sensor_data",
        [
            FieldSpec("reading_id", "uuid"),
            FieldSpec("machine_id", "reference", reference_pool=ids),
            FieldSpec("timestamp", "datetime", min_value=ago(7), max_value=ago(0)),
            FieldSpec("temperature", "float", min_value=20.0, max_value=180.0),
            FieldSpec("pressure", "float", min_value=1.0, max_value=45.0),
            FieldSpec("vibration", "float", min_value=0.0, max_value=10.0),
            FieldSpec("power_consumption", "float", min_value=0.5, max_value=50.0),
            FieldSpec(
                "error_code",
                "choice",
                choices=[None, "E001", "E002", "E003", "W001", "W002"],
                nullable=True,
                null_probability=0.8,
            ),
            FieldSpec("is_anomaly", "bool"),
        ],
        num_sensor_readings,
    )
    return [machines, readings]


def generate_and_save(
    spark: SparkSession,
    specs: Sequence[DatasetSpec],
    output_dir: str,
    seed: int = DEFAULT_SEED,
    now: dt.datetime | None = None,
) -> Mapping[str, str]:
    """Generate every dataset and append it below ``output_dir`` as JSON lines; name -> directory."""
    return write_json_lines({s.name: generate_dataset(spark, s, seed, now=now) for s in specs}, output_dir)
