"""DuckDB statements that must give the rows of the query of the same name."""

from __future__ import annotations

from plantlake.plans import contracts, silver, synth
from plantlake.queries import ALERT_AS_OF, CURVE_DAY, DAILY_AS_OF, FIRST_ORDERS, LATE_CHANGES, LATE_READINGS, SYNTH_NOW

# --- shared pieces ----------------------------------------------------------------------

B = "b AS (SELECT e.*, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events e)"

SENSOR = """fx_sensor AS (
SELECT event_id AS reading_id, user_id AS machine_id, CAST(ts AS TIMESTAMP) AS "timestamp",
  CASE WHEN k = 1 THEN value + 400 WHEN k = 2 THEN -value - 100 WHEN k = 3 THEN NULL ELSE value END AS temperature,
  CAST(k - 3 AS DOUBLE) * CAST(1.2 AS DOUBLE) AS pressure,
  CAST(k % 14 - 1 AS DOUBLE) AS vibration,
  CASE WHEN k % 20 = 0 THEN NULL ELSE value END AS power_consumption,
  CASE WHEN event_type = 'error' THEN concat('E00', CAST(k % 3 + 1 AS VARCHAR)) END AS error_code,
  CASE WHEN k % 33 = 0 THEN NULL ELSE event_type = 'error' END AS is_anomaly
FROM b WHERE event_type <> 'signup')"""

MACHINE = """fx_machine AS (
SELECT user_id AS machine_id, concat('M', CAST(user_id AS VARCHAR)) AS machine_name,
  concat('SITE', CAST(k % 5 AS VARCHAR)) AS location, concat('T', CAST(user_id % 5 AS VARCHAR)) AS machine_type,
  concat('F', CAST(k % 7 AS VARCHAR)) AS manufacturer,
  CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS installation_date, CAST(ts AS TIMESTAMP) AS "timestamp",
  CASE k % 3 WHEN 0 THEN 'operational' WHEN 1 THEN 'maintenance' ELSE 'offline' END AS status,
  50.0 + value AS max_temperature, CAST(5.0 + k / 4.0 AS DOUBLE) AS max_pressure
FROM b WHERE event_type = 'signup')"""

FLAGGED = """flagged AS (
SELECT reading_id, machine_id, "timestamp" AS machine_timestamp, temperature, pressure, vibration,
  power_consumption, error_code, is_anomaly,
  coalesce(temperature > 80, FALSE) AS is_high_temperature,
  coalesce(pressure > 100, FALSE) AS is_high_pressure,
  coalesce(vibration > 10, FALSE) AS is_high_vibration
FROM fx_sensor)"""

FACTS = f"facts AS (SELECT * FROM flagged WHERE {' AND '.join(f'({r})' for r in silver.SENSOR_RULES.values())})"

CHANGES = """changes AS (
SELECT machine_id, machine_name, location AS machine_location, machine_type, manufacturer, installation_date,
  "timestamp" AS machine_timestamp, status AS machine_status, max_temperature, max_pressure
FROM fx_machine)"""

VERSIONS = """versions AS (
SELECT *, machine_timestamp AS __START_AT,
  lead(machine_timestamp) OVER (PARTITION BY machine_id ORDER BY machine_timestamp) AS __END_AT
FROM changes)"""


def _signed(hex_digits: str) -> str:
    unsigned = f"CAST('0x' || {hex_digits} AS UBIGINT)"
    return (
        f"CASE WHEN {unsigned} > 9223372036854775807 THEN CAST(CAST({unsigned} AS HUGEINT) - 18446744073709551616 AS BIGINT)"
        f" ELSE CAST({unsigned} AS BIGINT) END"
    )


HISTORY = f"""history AS (
SELECT {_signed("substr(md5(length(CAST(machine_id AS VARCHAR)) || ':' || machine_id || length(CAST(epoch_us(__START_AT) AS VARCHAR)) || ':' || epoch_us(__START_AT)), 1, 16)")} AS machine_sk, * FROM versions)"""

STORED = """stored AS (
SELECT row_number() OVER (ORDER BY machine_id, __START_AT) AS machine_sk, * FROM versions)"""

ATTRS = "machine_name, machine_location, machine_type, manufacturer, installation_date, machine_status, max_temperature, max_pressure"

DAILY = f"""daily AS (
SELECT machine_sk, machine_id, machine_date, {ATTRS}, __START_AT AS valid_from, __END_AT AS valid_to FROM (
  SELECT m.*, d.machine_date,
    row_number() OVER (PARTITION BY m.machine_id, d.machine_date ORDER BY m.__START_AT DESC) AS rn
  FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '{DAILY_AS_OF}', INTERVAL 1 DAY)) AS DATE) AS machine_date) d
  JOIN stored m ON CAST(m.__START_AT AS DATE) <= d.machine_date
    AND (m.__END_AT IS NULL OR CAST(m.__END_AT AS DATE) > d.machine_date)) WHERE rn = 1)"""


def _round2(x: str) -> str:
    """Decimal rounding of a double's text, half up."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), 2) AS DOUBLE)"


_STATS = ", ".join(
    f"{_round2(f'{fn}({m})')} AS {fn}_{m}"
    for m in ("temperature", "pressure", "vibration", "power_consumption")
    for fn in ("avg", "min", "max")
)

AGG = f"""agg AS (
SELECT machine_date, machine_id, machine_sk, machine_name, machine_location, machine_type, machine_status,
  count(*) AS total_readings,
  CAST(sum(CAST(is_anomaly AS INT)) AS BIGINT) AS anomaly_count,
  CAST(sum(CAST(is_high_temperature AS INT)) AS BIGINT) AS high_temp_count,
  CAST(sum(CAST(is_high_pressure AS INT)) AS BIGINT) AS high_pressure_count,
  CAST(sum(CAST(is_high_vibration AS INT)) AS BIGINT) AS high_vibration_count,
  {_STATS}, {_round2("sum(power_consumption)")} AS total_power_consumption
FROM (SELECT f.machine_id, CAST(f.machine_timestamp AS DATE) AS machine_date, f.temperature, f.pressure, f.vibration,
        f.power_consumption, f.is_anomaly, f.is_high_temperature, f.is_high_pressure, f.is_high_vibration,
        d.machine_sk, d.machine_name, d.machine_location, d.machine_type, d.machine_status
      FROM facts f LEFT JOIN daily d
        ON d.machine_id = f.machine_id AND d.machine_date = CAST(f.machine_timestamp AS DATE))
GROUP BY ALL)"""

_ORDER = ["B", "SENSOR", "MACHINE", "FLAGGED", "FACTS", "CHANGES", "VERSIONS", "HISTORY", "STORED", "DAILY", "AGG"]


def _with(select: str, *parts: str) -> str:
    ctes = [globals()[name] for name in _ORDER if name in parts]
    return f"WITH {', '.join(ctes)} {select}"


def _facts(select: str) -> str:
    return _with(select, "B", "SENSOR", "FLAGGED", "FACTS")


def _history(select: str) -> str:
    return _with(select, "B", "MACHINE", "CHANGES", "VERSIONS", "HISTORY")


def _all(select: str) -> str:
    return _with(select, *_ORDER)


def _hashed_keys(select: str) -> str:
    """Like `_all`, with the hashed keys in place of the numbered ones."""
    return _all(select).replace("JOIN stored m", "JOIN history m")


# --- silver, gold, checks ---------------------------------------------------------------


def _rules() -> str:
    selects = [
        f"SELECT '{dataset}' AS dataset, '{name}' AS rule, count(*) AS total, count(*) FILTER (WHERE {rule}) AS passed,"
        f" count(*) - count(*) FILTER (WHERE {rule}) AS failed FROM {table}"
        for dataset, table, rules in (
            ("sensor_data", "flagged", silver.SENSOR_RULES),
            ("machine_metadata", "changes", silver.MACHINE_RULES),
        )
        for name, rule in rules.items()
    ]
    return " UNION ALL ".join(selects)


_TIES = """kept AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
tied AS (SELECT *, o_orderdate AS __START_AT,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS __END_AT FROM kept)"""

_NOT_NULL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM agg"
    for c in ("machine_date", "machine_id", "machine_sk", "anomaly_count", "total_readings")
)

_GOLD_FACT = _all(
    """SELECT f.reading_id, f.machine_id, m.machine_sk, f.machine_timestamp,
  CAST(f.machine_timestamp AS DATE) AS machine_date, CAST(hour(f.machine_timestamp) AS INT) AS reading_hour,
  CAST(dayofweek(f.machine_timestamp) + 1 AS INT) AS reading_day_of_week,
  f.temperature, f.pressure, f.vibration, f.power_consumption, f.error_code, f.is_anomaly,
  f.is_high_temperature, f.is_high_pressure, f.is_high_vibration
FROM facts f LEFT JOIN stored m ON f.machine_id = m.machine_id AND f.machine_timestamp >= m.__START_AT
  AND (m.__END_AT IS NULL OR f.machine_timestamp < m.__END_AT)"""
)

def _contracts() -> str:
    parts = []
    source = {"dim_machine_h": "stored", "dim_machine_a": "(SELECT * FROM stored WHERE __END_AT IS NULL)", "dim_machine_daily": "daily", "fact_sensor_agg": "agg"}
    for table, keys in contracts.PRIMARY_KEYS.items():
        names, nulls = ", ".join(keys), " OR ".join(f"{k} IS NULL" for k in keys)
        grouped = f"SELECT {names} FROM {source[table]} GROUP BY {names} HAVING count(*) > 1 OR {nulls}"
        parts.append(f"SELECT '{table}' AS table_name, 'primary key ({names})' AS promise, count(*) AS violations FROM ({grouped})")
    for table, columns in contracts.NOT_NULL.items():
        parts += [f"SELECT '{table}', '{c} not null', count(*) FILTER (WHERE {c} IS NULL) FROM {source[table]}" for c in columns]
    for child, parent, keys in contracts.FOREIGN_KEYS:
        names, same = ", ".join(keys), " AND ".join(f"c.{k} = p.{k}" for k in keys)
        kept = " AND ".join(f"c.{k} IS NOT NULL" for k in keys)
        orphans = f"SELECT DISTINCT {', '.join(f'c.{k}' for k in keys)} FROM {source[child]} c WHERE {kept} AND NOT EXISTS (SELECT 1 FROM {source[parent]} p WHERE {same})"
        parts.append(f"SELECT '{child}', 'reference ({names}) to {parent}', count(*) FROM ({orphans})")
    return _all(" UNION ALL ".join(parts))


_RELATIONAL = {
    "silver_fact_sensor": _facts("SELECT * FROM facts"),
    "dq_rule_metrics": _with(_rules(), "B", "SENSOR", "MACHINE", "FLAGGED", "CHANGES"),
    "dim_source_clean": _with("SELECT * FROM changes", "B", "MACHINE", "CHANGES"),
    "scd2_history": _history("SELECT * FROM history"),
    "scd2_stream": _history("SELECT * FROM history"),
    "scd2_stream_rebucketed": _history("SELECT * FROM history"),
    "dq_stream_metrics": _with(
        f"SELECT * EXCLUDE (dataset) FROM ({_rules()}) WHERE dataset = 'sensor_data'", "B", "SENSOR", "MACHINE", "FLAGGED", "CHANGES"
    ),
    "scd2_history_ties": f"WITH {_TIES} SELECT * FROM tied",
    "surrogate_key_dense": f"WITH {_TIES} SELECT row_number() OVER (ORDER BY o_custkey, __START_AT) AS order_sk,"
    " o_custkey, __START_AT, __END_AT FROM tied",
    "surrogate_key_stable": f"""WITH {_TIES}, early AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders WHERE {FIRST_ORDERS})
SELECT row_number() OVER (ORDER BY e.o_custkey IS NULL, t.o_custkey, __START_AT) AS order_sk, t.o_custkey, __START_AT, __END_AT
FROM tied t LEFT JOIN early e ON e.o_custkey = t.o_custkey AND e.o_orderdate = t.o_orderdate""",
    "date_spine": "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS machine_date"
    " FROM (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events)",
    "dim_machine_h": _history(
        f"SELECT machine_sk, machine_id, {ATTRS}, machine_timestamp, __START_AT AS valid_from_ts,"
        " __END_AT AS valid_to_ts, __END_AT IS NULL AS is_current FROM history"
    ),
    "dim_machine_a": _history("SELECT * EXCLUDE (__END_AT) FROM history WHERE __END_AT IS NULL"),
    "dim_machine_daily": _all("SELECT * FROM daily"),
    "gold_fact_sensor": _GOLD_FACT,
    "gold_fact_sensor_bucketed": _GOLD_FACT,
    "gold_fact_sensor_view": _GOLD_FACT,
    "fact_sensor_agg": _all("SELECT * FROM agg"),
    "materialize_gold": _all("SELECT * FROM agg"),
    "full_load_agg": _hashed_keys("SELECT * REPLACE (CAST(machine_id AS VARCHAR) AS machine_id, CAST(machine_sk AS VARCHAR) AS machine_sk) FROM agg"),
    "gold_refresh": _hashed_keys(
        f"""SELECT a.* REPLACE (CAST(machine_sk AS VARCHAR) AS machine_sk), machine_date IN (
  SELECT CAST(machine_timestamp AS DATE) FROM facts WHERE {LATE_READINGS}
  UNION SELECT CAST(unnest(generate_series(CAST(__START_AT AS DATE), coalesce(CAST(__END_AT AS DATE) - 1, DATE '{DAILY_AS_OF}'), INTERVAL 1 DAY)) AS DATE)
  FROM history WHERE {LATE_CHANGES}) AS renewed FROM agg a"""
    ),
    "alert_anomaly_rate": _all(
        "SELECT anomaly_rate_pct, coalesce(anomaly_rate_pct > 20, FALSE) AS triggered FROM ("
        "SELECT CAST(round(sum(anomaly_count) * 100.0 / nullif(sum(total_readings), 0), 1) AS DOUBLE) AS anomaly_rate_pct"
        f" FROM agg WHERE machine_date = DATE '{ALERT_AS_OF}' - 1)"
    ),
    "check_primary_key": "SELECT o_custkey, o_orderdate, count(*) AS row_count FROM orders GROUP BY ALL"
    " HAVING count(*) > 1 OR o_custkey IS NULL OR o_orderdate IS NULL",
    "check_foreign_key": _all(
        "SELECT a.machine_id, a.machine_date FROM agg a LEFT JOIN daily d"
        " ON d.machine_id = a.machine_id AND d.machine_date = a.machine_date WHERE d.machine_id IS NULL"
    ),
    "check_not_null": _all(_NOT_NULL),
    "check_contracts": _contracts(),
}

# --- files and streams ------------------------------------------------------------------

_LANDED = '* REPLACE (CAST(reading_id AS VARCHAR) AS reading_id, CAST(machine_id AS VARCHAR) AS machine_id)'

_FILES = {
    "bronze_ingest": _with(f"SELECT {_LANDED} FROM fx_sensor", "B", "SENSOR"),
    "bronze_incremental": _with(f"SELECT {_LANDED} FROM fx_sensor", "B", "SENSOR"),
    "bronze_lineage": _with(
        "SELECT count(*) AS loaded, count(*) AS located, count(*) AS named, count(*) AS dated, count(*) AS sized"
        " FROM fx_sensor",
        "B",
        "SENSOR",
    ),
    "bronze_rescue": _with(
        """SELECT CASE WHEN kind <> 2 THEN CAST(reading_id AS VARCHAR) END AS reading_id,
  CASE WHEN kind NOT IN (1, 2) THEN CAST(machine_id AS VARCHAR) END AS machine_id,
  CASE WHEN kind > 2 THEN "timestamp" END AS "timestamp",
  CASE WHEN kind > 2 THEN temperature END AS temperature,
  CASE WHEN kind NOT IN (1, 2) THEN pressure END AS pressure,
  CASE WHEN kind > 3 THEN vibration END AS vibration,
  CASE WHEN kind > 2 THEN power_consumption END AS power_consumption,
  CASE WHEN kind > 2 THEN error_code END AS error_code,
  CASE WHEN kind > 2 THEN is_anomaly END AS is_anomaly,
  CASE kind WHEN 0 THEN '{"temperature":"hot"}'
            WHEN 1 THEN '{"firmware":"v2","site":{"of":' || machine_id || '}}'
            WHEN 2 THEN '{"reading_id": ' || reading_id || ', "temp'
            WHEN 3 THEN '{"vibration":{"is":[1,2.5],"of":' || machine_id || '}}' END AS _rescued
FROM (SELECT *, reading_id % 6 AS kind FROM fx_sensor)""",
        "B",
        "SENSOR",
    ),
    "bronze_evolution": _with(
        f"""SELECT {_LANDED.replace("*", "* EXCLUDE (part)")}, CASE WHEN part > 0 THEN 'v' || reading_id % 4 END AS firmware,
  CASE WHEN part > 0 AND reading_id % 5 > 0 THEN reading_id * 3 END AS cycles,
  CASE WHEN part > 0 THEN CASE WHEN reading_id % 2 = 0 THEN 0.5::DOUBLE ELSE 2.25::DOUBLE END END AS load,
  CASE WHEN part > 0 THEN '{{' || CASE WHEN reading_id % 1000 = 7 THEN '"rare":"x",' ELSE '' END || '"site":{{"of":' || machine_id || '}}}}' END AS _rescued
FROM (SELECT *, reading_id % 3 AS part FROM fx_sensor)""",
        "B",
        "SENSOR",
    ),
    "jsonl_roundtrip": _with(
        "SELECT * REPLACE (CAST(machine_id AS VARCHAR) AS machine_id) FROM fx_machine", "B", "MACHINE"
    ),
    "silver_fact_stream": _facts(f"SELECT {_LANDED} FROM facts"),
    "clustered_write": _facts("SELECT * FROM facts"),
    "clustered_curve": _facts(
        f"""SELECT 'machine' AS filtered, count(*) AS matching, TRUE AS all_files_before, TRUE AS half_or_less_after FROM facts WHERE machine_id = (SELECT (min(machine_id) + max(machine_id)) // 2 FROM facts)
UNION ALL SELECT 'day', count(*), TRUE, TRUE FROM facts WHERE CAST(machine_timestamp AS DATE) = DATE '{CURVE_DAY}'"""
    ),
    "load_table_file": "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM customer",
    "load_table_file_json": "SELECT * REPLACE (CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer",
}

# --- synthetic tables -------------------------------------------------------------------

SEED = synth.DEFAULT_SEED


def _text(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


class _Field:
    """The draws of one field, in SQL, on a table with the column ``id``."""

    def __init__(self, dataset: str, field: str):
        self.digest = f"md5('{SEED}|{dataset}|{field}|' || id)"

    def unit(self, slot: int = 0, digits: int = 8) -> str:
        number = f"CAST(CAST('0x' || substr({self.digest}, {1 + 8 * slot}, {digits}) AS BIGINT) AS DOUBLE)"
        return f"({number} / {1 << 4 * digits}.0::DOUBLE)"

    def below(self, n: int | str, slot: int = 0) -> str:
        wide = isinstance(n, int) and n > 1 << 32
        return f"CAST(floor({self.unit(slot, 13 if wide else 8)} * {n}) AS BIGINT)"

    def integer(self, low: int, high: int) -> str:
        return f"({self.below(high - low + 1)} + {low})"

    def real(self, low: float, high: float) -> str:
        return _round2(f"({low}::DOUBLE + {self.unit()} * {high - low}::DOUBLE)")

    def pick(self, values, slot: int = 0) -> str:
        return f"({_text(values)})[{self.below(len(values), slot)} + 1]"

    def coin(self) -> str:
        return f"({self.unit()} < 0.5)"

    def nulled(self, p: float, value: str) -> str:
        return f"CASE WHEN {self.unit(1)} >= {p} THEN {value} END"

    def uuid(self) -> str:
        d = self.digest
        variant = f"substr('89ab', CAST(CAST('0x' || substr({d}, 17, 1) AS BIGINT) % 4 + 1 AS BIGINT), 1)"
        return (
            f"substr({d},1,8) || '-' || substr({d},9,4) || '-4' || substr({d},14,3) || '-' || {variant}"
            f" || substr({d},18,3) || '-' || substr({d},21,12)"
        )

    def company(self) -> str:
        return f"{self.pick(synth.SURNAMES)} || ' ' || {self.pick(synth.COMPANY_FORMS, 2)}"

    def city(self) -> str:
        return f"{self.pick(synth.CITY_STEMS)} || ' ' || {self.pick(synth.SURNAMES, 2)} || {self.pick(synth.CITY_ENDS, 3)}"

    def seconds_after(self, start: str, seconds: int, suffix: str = "") -> str:
        moved = f"TIMESTAMP '{start}' + to_seconds({self.below(seconds + 1)})"
        return f"strftime({moved}, '%Y-%m-%dT%H:%M:%S') || '{suffix}'"


def _shuffled(dataset: str, field: str) -> str:
    """c_custkey and pos: each customer's place in the field's shuffle of as many members as there are customers."""
    drawn = f"CAST('0x' || substr(md5('{SEED}|{dataset}|{field}|' || i || '|' || (CASE WHEN i % 2 = 0 THEN y % w ELSE y // w END)), 1, 13) AS BIGINT)"
    step = f"CASE WHEN i % 2 = 0 THEN ((y // w + {drawn}) % h) * w + y % w ELSE (y // w) * w + (y % w + {drawn}) % w END"
    moved = f"list_reduce([z, 0, 1, 2, 3, 4, 5], lambda y, i: {step})"
    walk = f"list_reduce(list_prepend(c_custkey, range(65)), lambda z, k: CASE WHEN k > 0 AND z < n THEN z ELSE {moved} END)"
    sizes = "SELECT n, h, CAST(ceil(n / h) AS BIGINT) AS w FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS h FROM customer)"
    return f"SELECT c_custkey, {walk} AS pos FROM customer, ({sizes})"


def _rows(fields: dict[str, str], table: str = "events", row_id: str = "event_id") -> str:
    columns = ", ".join(f"{expr} AS {name}" for name, expr in fields.items())
    return f"SELECT {columns} FROM (SELECT {row_id} AS id FROM {table})"


def _synthetic() -> dict[str, str]:
    def of(dataset: str):
        return lambda field: _Field(dataset, field)

    def days_before(days: int) -> str:
        return (SYNTH_NOW - synth.dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")

    fraction = f".{SYNTH_NOW.microsecond:06d}+00:00"
    naive_fraction, day = fraction, 86400
    out = {}

    f = of("shifts")
    shift = {"badge": f("badge").integer(7, 9000), "callsign": f("callsign").pick(synth.WORDS), "on_duty": f("on_duty").coin()}
    out["synth_dataset"] = _rows({"row_id": "id", **shift})
    f = of("numeric")
    out["synth_numeric"] = _rows(
        {
            "row_id": "id",
            '"offset"': f("offset").integer(-40, 25),
            "any_int": f("any_int").integer(0, 1000),
            "tick": f("tick").integer(0, 10**12),
            "ratio": f("ratio").real(-1.0, 1.0),
            "any_float": f("any_float").real(0.0, 1000.0),
        }
    )
    f = of("categorical")
    first, last = f("email").pick(synth.FIRST_NAMES), f("email").pick(synth.SURNAMES, 2)
    out["synth_categorical"] = _rows(
        {
            "row_id": "id",
            "word": f("word").pick(synth.WORDS),
            "flag": f("flag").coin(),
            "shade": f("shade").pick(["teal", "amber", "plum", "slate", "ochre"]),
            "grade": f("grade").pick(["A", None, "B"]),
            "company": f("company").company(),
            "city": f("city").city(),
            "email": f"lower({first}) || '.' || lower({last}) || '@' || {f('email').pick(synth.MAIL_DOMAINS, 3)}",
            "name": f"{f('name').pick(synth.FIRST_NAMES)} || ' ' || {f('name').pick(synth.SURNAMES, 2)}",
            "country": f("country").pick(synth.COUNTRIES),
            "address": f"CAST({f('address').below(999)} + 1 AS VARCHAR) || ' ' || {f('address').pick(synth.STREETS, 2)}",
        }
    )
    f = of("datetime")
    recent = f"TIMESTAMP '{days_before(0)}' - to_days(CAST({f('recent').below(31)} AS INT))"
    out["synth_datetime"] = _rows(
        {
            "row_id": "id",
            "naive": f("naive").seconds_after("2023-06-15 00:00:00", 90 * day - 1),
            "century": f("century").seconds_after("1900-01-01 00:00:00", 46020 * day),
            "zoned": f("zoned").seconds_after(days_before(11), 11 * day, fraction),
            "recent": f"strftime({recent}, '%Y-%m-%dT%H:%M:%S') || '{naive_fraction}'",
        }
    )
    out["synth_uuid"] = _rows({"row_id": "id", "uid": _Field("uuid", "uid").uuid()})
    f = of("nullable")
    out["synth_nullable"] = _rows(
        {
            "row_id": "id",
            "half": f("half").nulled(0.5, f("half").integer(1, 10)),
            "tenth": f("tenth").nulled(0.1, f("tenth").pick(synth.WORDS)),
            "fixed": f("fixed").nulled(0.1, "41"),
        }
    )
    area = _Field("custom", "area")
    out["synth_custom"] = _rows({"row_id": "id", "fixed": "41", "area": f"{area.below(6)} * {area.below(9, 2)}"})

    f = of("reference")
    size = "(SELECT count(*) FROM customer)"
    drawn = _rows(
        {
            "row_id": "id",
            "pos": f("customer").below(size),
            "machine_id": f"printf('MACH-%04d', {f('machine_id').below(size)} + 1)",
            "line": f"printf('LINE-%02d', {f('line').below(12)} * 5 % 12)",
            "lot": f"printf('LOT-%04d', {f('lot').below(1500)} * 7 % 1500)",
        }
    )
    out["synth_reference"] = (
        "SELECT row_id, c_custkey AS customer, machine_id, line, lot FROM"
        f" ({drawn}) d LEFT JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer) c USING (pos)"
    )
    out["synth_reference_unique"] = (
        f"SELECT c_custkey AS row_id, p.customer FROM ({_shuffled('unique', 'customer')}) s"
        " LEFT JOIN (SELECT row_number() OVER (ORDER BY c_name) - 1 AS pos, c_name AS customer FROM customer) p ON s.pos = p.pos"
    )

    f = of("machine_metadata")
    machines = _rows(
        {
            "id": "id",
            "machine_name": f("machine_name").company(),
            "location": f("location").city(),
            "machine_type": f("machine_type").pick(["CNC Mill", "Lathe", "3D Printer", "Laser Cutter", "Welding Robot"]),
            "manufacturer": f("manufacturer").company(),
            "installation_date": f("installation_date").seconds_after("2020-01-01 00:00:00", 2191 * day),
            '"timestamp"': f("timestamp").seconds_after(days_before(30), 22 * day, fraction),
            "status": f("status").pick(["operational", "maintenance", "offline"]),
            "max_temperature": f("max_temperature").real(50.0, 200.0),
            "max_pressure": f("max_pressure").real(5.0, 50.0),
        },
        "customer",
        "c_custkey",
    )
    out["synth_machines"] = (
        "SELECT printf('MACH-%04d', pos + 1) AS machine_id, m.* EXCLUDE (id)"
        f" FROM ({machines}) m JOIN ({_shuffled('machine_metadata', 'machine_id')}) s ON m.id = s.c_custkey"
    )
    out["synth_saved"] = out["synth_machines"]
    f = of("sensor_data")
    codes = f("error_code")
    out["synth_sensors"] = _rows(
        {
            "reading_id": f("reading_id").uuid(),
            "machine_id": f"printf('MACH-%04d', {f('machine_id').below(size)} + 1)",
            '"timestamp"': f("timestamp").seconds_after(days_before(7), 7 * day, fraction),
            "temperature": f("temperature").real(20.0, 180.0),
            "pressure": f("pressure").real(1.0, 45.0),
            "vibration": f("vibration").real(0.0, 10.0),
            "power_consumption": f("power_consumption").real(0.5, 50.0),
            "error_code": codes.nulled(0.8, codes.pick([None, "E001", "E002", "E003", "W001", "W002"])),
            "is_anomaly": f("is_anomaly").coin(),
        }
    )
    return out


def all_oracles() -> dict[str, str]:
    return {**_RELATIONAL, **_FILES, **_synthetic()}
