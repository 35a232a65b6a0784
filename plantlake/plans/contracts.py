"""What the stored tables promise, and how often they break it.

Nothing here is enforced while writing: a broken promise is reported, and no row is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The declared keys, columns that must not be NULL, and references.
PRIMARY_KEYS = {
    "dim_machine_h": ["machine_sk"],
    "dim_machine_a": ["machine_id"],
    "dim_machine_daily": ["machine_id", "machine_date"],
    "fact_sensor_agg": ["machine_date", "machine_id"],
}
NOT_NULL = {
    "dim_machine_h": ["machine_id"],
    "dim_machine_a": ["machine_id"],
    "dim_machine_daily": ["machine_sk", "machine_id", "machine_date", "valid_from"],
    "fact_sensor_agg": ["machine_date", "machine_id"],
}
FOREIGN_KEYS = [("fact_sensor_agg", "dim_machine_daily", ["machine_id", "machine_date"])]


UNIQUE, PRESENT, CHILD, PARENT = "unique", "present", "child", "parent"


def _key_hash(keys: Sequence[str]) -> list[Column]:
    """128 bits of a key; NULL parts count, and where they stand."""
    parts = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(len(parts)), *parts).alias("h2")]


def _entries(df: DataFrame, promises: Sequence[tuple[int, str, Sequence[str]]]) -> DataFrame:
    """What a table's rows say about its promises, by one scan: promise, the key's hash, and whether it is of a child, a parent or has a NULL."""
    found = []
    for number, role, keys in promises:
        has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        hashed = [F.lit(0).cast("long").alias(h) for h in ("h1", "h2")] if role == PRESENT else _key_hash(keys)
        flags = [F.lit(role == CHILD).alias("child"), F.lit(role == PARENT).alias("parent"), has_null.alias("null")]
        entry = F.struct(F.lit(number).alias("promise"), *hashed, *flags)
        # A NULL refers to nothing, and only NULLs break a promise to be present.
        found.append({UNIQUE: entry, PRESENT: F.when(has_null, entry)}.get(role, F.when(~has_null, entry)))
    return df.select(F.inline(F.array_compact(F.array(*found))))


def contract_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per promise: table_name, promise, violations.

    A key counts once however often it repeats, a NULL once per row, a reference once per key without a parent. Each table is
    read once: its rows become entries for all promises it takes part in, as 128-bit hashes of keys, and one aggregate with
    partial counts before the shuffle serves all tables. A hot key costs one entry per task.
    """
    listed: list[tuple[str, str, str]] = []  # table, text, kind
    sides: dict[str, list[tuple[int, str, Sequence[str]]]] = {name: [] for name in tables}
    for table, keys in PRIMARY_KEYS.items():
        sides[table].append((len(listed), UNIQUE, keys))
        listed.append((table, f"primary key ({', '.join(keys)})", UNIQUE))
    for table, columns in NOT_NULL.items():
        for column in columns:
            sides[table].append((len(listed), PRESENT, [column]))
            listed.append((table, f"{column} not null", PRESENT))
    for child, parent, keys in FOREIGN_KEYS:
        sides[child].append((len(listed), CHILD, keys))
        sides[parent].append((len(listed), PARENT, keys))
        listed.append((child, f"reference ({', '.join(keys)}) to {parent}", CHILD))

    entries = reduce(DataFrame.unionByName, [_entries(tables[t], own) for t, own in sides.items() if own])
    keys = entries.groupBy("promise", "h1", "h2").agg(
        F.count("*").alias("n"), F.max("child").alias("child"), F.max("parent").alias("parent"), F.max("null").alias("null")
    )
    kinds = [F.array(*[F.lit(k) for k, (_, _, kind) in enumerate(listed) if kind == wanted]) for wanted in (UNIQUE, PRESENT)]
    broken = (
        F.when(F.array_contains(kinds[0], F.col("promise")), ((F.col("n") > 1) | F.col("null")).cast("long"))
        .when(F.array_contains(kinds[1], F.col("promise")), F.col("n"))
        .otherwise((F.col("child") & ~F.col("parent")).cast("long"))
    )
    counts = keys.groupBy("promise").agg(F.sum(broken).alias("violations"))
    names = entries.sparkSession.createDataFrame([(k, t, text) for k, (t, text, _) in enumerate(listed)], "promise int, table_name string, text string")
    return names.join(counts, "promise", "left").select(
        "table_name", F.col("text").alias("promise"), F.coalesce("violations", F.lit(0)).alias("violations")
    )
