"""LEFT join of instants to the version that was valid at that instant."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.operators.ordering import with_last_before

# At most this many versions are compared with one reading, per key or per time bucket.
CANDIDATES = 32

# Bucket widths from coarse to fine, each with the chunk its boundaries are carried through.
CHUNKS = {
    "day": "year",
    "hour": "month",
    "minute": "day",
    "second": "hour",
    "millisecond": "minute",
    "microsecond": "minute",
}


def _valid(at: Column, start: Column, end: Column) -> Column:
    return (at >= start) & (end.isNull() | (at < end))


def most_versions(versions: DataFrame, keys: Sequence[str], start: str, unit: str | None = None) -> int:
    """Largest number of versions of one key, or of one key within one time unit."""
    bucket = [F.date_trunc(unit, F.col(start)).alias("bucket")] if unit else []
    counts = versions.groupBy(*[F.col(k) for k in keys], *bucket).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def bucket_unit(versions: DataFrame, keys: Sequence[str], start: str) -> str:
    """The widest bucket in which no key has more versions than a reading may be compared with."""
    fits = (u for u in CHUNKS if most_versions(versions, keys, start, u) <= CANDIDATES)
    return next(fits, "microsecond")


def join_valid_at(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    take: Sequence[str],
    method: str = "auto",
    unit: str | None = None,
) -> DataFrame:
    """Add ``take`` of the version with ``start <= at < end`` (NULL end = open); unmatched facts stay.

    The versions of a key must not overlap, which a type 2 history guarantees.
    ``auto`` is the join of `valid_at_sql`: one plan for any history, without a job before it. ``direct`` is an equi
    join with a range residual, for dimensions known to be small and to have few versions per key: they are broadcast,
    and the facts are not shuffled. ``bucketed`` cuts time as finely as the densest key needs, for very many versions per
    key and day; a missing ``unit``, the width of its buckets, is found by counting the versions.
    """
    keys, take = list(keys), list(take)
    if method == "auto":
        text = valid_at_sql("{facts}", "{versions}", keys, at, start, end, take)
        return facts.sparkSession.sql(text, facts=facts, versions=versions).select(*facts.columns, *take)
    if method == "direct":
        return _direct(facts, versions, keys, at, start, end, take)
    if method == "bucketed":
        unit = unit or bucket_unit(versions, keys, start)
        return _bucketed(facts, versions, keys, at, start, end, take, unit)
    raise ValueError(f"unknown join method: {method}")


def valid_at_sql(
    facts: str, versions: str, keys: Sequence[str], at: str, start: str, end: str, take: Sequence[str]
) -> str:
    """SQL over two tables or views: all columns of ``facts``, and ``take`` of the version valid at ``at``.

    Each version lists the days it touches, and a fact meets the versions of its key and day. The key and the day are the join
    key, so the facts of a hot key spread over its days, and should one day still be hot, the adaptive skew join splits it,
    as the facts are the preserved side. The facts are read and shuffled once. Nothing changes after the
    last day on which a version starts, so that later days, and later facts, count as that day; a start in the future
    counts as today. That only bounds the list of days: the instants are compared as they are. The optimizer doesn't
    count the expansion into days, so the hint keeps it from broadcasting them.
    """
    last = f"(SELECT least(current_date(), max(CAST(`{start}` AS DATE))) FROM {versions})"
    named = [f"`{k}` AS __key{i}" for i, k in enumerate(keys)] + [f"`{start}` AS __start", f"`{end}` AS __end"]
    taken = [f"`{t}`" for t in take]
    first_day, last_day = "least(CAST(__start AS DATE), __last)", "least(coalesce(CAST(__end AS DATE), __last), __last)"
    same = " AND ".join(f"f.`{k}` = v.__key{i}" for i, k in enumerate(keys))
    return (
        f"SELECT /*+ MERGE(v) */ f.* EXCEPT (__day), {', '.join(f'v.{t}' for t in taken)}"
        f" FROM (SELECT *, least(CAST(`{at}` AS DATE), {last}) AS __day FROM {facts}) f"
        f" LEFT JOIN (SELECT *, explode(sequence({first_day}, {last_day})) AS __day"
        f" FROM (SELECT {', '.join([*named, *taken])}, {last} AS __last FROM {versions})"
        " WHERE __start IS NOT NULL AND (__end IS NULL OR __end > __start)) v"
        f" ON {same} AND f.__day = v.__day AND f.`{at}` >= v.__start AND (v.__end IS NULL OR f.`{at}` < v.__end)"
    )


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def _right_side(versions: DataFrame, keys: list[str], start: str, end: str, take: list[str]) -> DataFrame:
    return versions.select(
        *[F.col(k).alias(f"_v_{k}") for k in keys],
        F.col(start).alias("_v_start"),
        F.col(end).alias("_v_end"),
        *take,
    )


def _direct(facts, versions, keys, at, start, end, take) -> DataFrame:
    right = _right_side(versions, keys, start, end, take)
    on = [F.col(k) == F.col(f"_v_{k}") for k in keys]
    on.append(_valid(F.col(at), F.col("_v_start"), F.col("_v_end")))
    return facts.join(right, on, "left").select(*facts.columns, *take)


def _bucketed(facts, versions, keys, at, start, end, take, unit) -> DataFrame:
    """Equi join on (key, time bucket).

    The candidates of a bucket are the versions that start in it, and the one already open
    when it begins. The latter is found on one row per (key, bucket). A hot key is spread
    over its buckets; should one bucket still be hot, the adaptive skew join splits its
    readings, since the facts are the preserved side.
    """
    v_keys = [f"_v_{k}" for k in keys]
    on_bucket = [*v_keys, "_v_bucket"]
    version = F.struct("_v_start", "_v_end", *take)
    placed = _right_side(versions, keys, start, end, take).select(
        *v_keys, F.date_trunc(unit, "_v_start").alias("_v_bucket"), version.alias("_v")
    )
    # NULLs are filtered in so many words on both inputs: the plan below reads each of them
    # twice, and only equal branches share one exchange.
    placed = placed.filter(_all_present(on_bucket))
    latest = placed.groupBy(*on_bucket).agg(F.max("_v").alias("_latest"), F.lit(False).alias("_wanted"))
    wanted = (
        facts.select(*[F.col(k).alias(f"_v_{k}") for k in keys], F.date_trunc(unit, at).alias("_v_bucket"))
        .filter(_all_present(on_bucket))
        .distinct()
        .select("*", F.lit(None).cast(latest.schema["_latest"].dataType).alias("_latest"), F.lit(True).alias("_wanted"))
    )
    spine = (
        latest.unionByName(wanted)
        .groupBy(*on_bucket)
        .agg(F.max("_latest").alias("_latest"), F.max("_wanted").alias("_wanted"))
    )
    carried = (
        with_last_before(spine, v_keys, "_v_bucket", "_latest", "_v", CHUNKS[unit])
        .filter("_wanted AND _v IS NOT NULL AND (_v._v_end IS NULL OR _v._v_end > _v_bucket)")
        .select(*on_bucket, "_v")
    )
    candidates = placed.unionByName(carried).select(*on_bucket, "_v.*")

    on = [F.col(k) == F.col(f"_v_{k}") for k in keys]
    on.append(F.date_trunc(unit, F.col(at)) == F.col("_v_bucket"))
    on.append(_valid(F.col(at), F.col("_v_start"), F.col("_v_end")))
    return facts.join(candidates, on, "left").select(*facts.columns, *take)
