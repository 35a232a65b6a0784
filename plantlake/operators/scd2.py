"""Slowly changing dimension, type 2, from a change feed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.operators.ordering import dense_number, with_next

START, END = "__START_AT", "__END_AT"


def applicable(changes: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """Rows that can be placed in a history: key and sequence present."""
    return changes.dropna(subset=[*keys, sequence_by])


def one_per_sequence(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per (key, sequence): the greatest by the tie-break columns, then by all others.

    The choice depends on the values only, never on arrival order, so a replayed or late
    row gives the same answer. ``max`` runs on both sides of the shuffle; any number of
    copies of a row leaves at most one per task.
    """
    identity = [*keys, sequence_by]
    rest = [c for c in tie_break if c not in identity]
    rest += [c for c in changes.columns if c not in identity and c not in rest]
    if not rest:
        return changes.distinct()
    best = changes.groupBy(*identity).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in identity else F.col(f"_best.`{c}`") for c in changes.columns])


def apply_scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Versions with ``[__START_AT, __END_AT)``; the current version has a NULL end.

    Every distinct sequence value makes a version, which ends where the next one of its
    key starts. Rows without key or sequence are left out.
    """
    clean = one_per_sequence(applicable(changes, keys, sequence_by), keys, sequence_by, tie_break)
    started = clean.withColumn(START, F.col(sequence_by))
    return with_next(started, keys, START, END)


def hashed_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """A 64-bit surrogate key computed from the version's identity.

    The first 16 hex digits of an md5 over the parts, each led by its length, read as a signed
    integer: it survives replays, late rows and rebuilds, needs no coordination, and any other
    engine can recompute it. `primary_key_violations` reports a collision.
    """
    parts = [
        F.unix_micros(c) if isinstance(df.schema[c].dataType, T.TimestampType) else F.col(c).cast("string")
        for c in columns
    ]
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")


def with_hashed_key(history: DataFrame, keys: Sequence[str], output: str) -> DataFrame:
    return history.select(hashed_key(history, [*keys, START]).alias(output), "*")


def with_dense_key(history: DataFrame, keys: Sequence[str], output: str) -> DataFrame:
    """Keys 1, 2, 3 … in (key, start) order, for one-shot builds: late rows shift the numbers (see `KeyMap`)."""
    numbered = dense_number(history, [*keys, START], "_n")
    return numbered.select((F.col("_n") + 1).alias(output), *history.columns)


@dataclass(frozen=True)
class KeyMap:
    """Numbers of versions that stay what they are: a stored map from (key, start) to number, added to by each load.

    A load hands a block of numbers to the versions it is the first to have, in (key, start) order, after the block of the load
    before. The entries of a load are written first and its block last; without the block they don't count, so that a
    load that fails in between is made good by the next one. One load may write at a time.
    """

    path: str
    keys: Sequence[str]

    def _blocks(self, spark: SparkSession) -> list:
        try:
            return spark.read.schema("load int, first long, size long").parquet(f"{self.path}/blocks").collect()  # one row per load
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def entries(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The keys, start and ``_number`` of all versions numbered so far; ``schema`` is that of the history."""
        loads = [b.load for b in self._blocks(spark) if b.size]
        fields = T.StructType([*[schema[k] for k in self.keys], schema[START], T.StructField("_number", T.LongType())])
        if not loads:
            return spark.createDataFrame([], fields)
        return spark.read.schema(fields).parquet(*[f"{self.path}/entries/load={n}" for n in sorted(loads)])

    def number(self, history: DataFrame, output: str) -> DataFrame:
        """Number the versions that are new, and return the history with all numbers in ``output``.

        The new versions alone are sorted; the numbers are joined on (key, start), which no hot key can skew.
        """
        spark, identity = history.sparkSession, [*self.keys, START]
        blocks = self._blocks(spark)
        known = self.entries(spark, history.schema)
        new = dense_number(history.select(*identity).join(known, identity, "left_anti"), identity, "_n")
        first = max((b.first + b.size for b in blocks), default=1)
        load = max((b.load for b in blocks), default=0) + 1
        place = f"{self.path}/entries/load={load}"
        new.select(*identity, (F.col("_n") + first).alias("_number")).write.mode("overwrite").parquet(place)
        size = spark.read.parquet(place).count()
        if size:
            block = spark.createDataFrame([(first, size)], "first long, size long")
            block.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/blocks/load={load}")
        numbered = self.entries(spark, history.schema)
        return history.join(numbered, identity).select(F.col("_number").alias(output), *history.columns)
