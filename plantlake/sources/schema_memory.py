"""What a landing feed has taught about its own schema.

A feed declares its columns; keys beyond them arrive in ``_rescued``. The memory of a flow is a log below a folder of its own: one
entry for each column learnt, under the number of the load that taught it. After a load, the rule looks at what that load rescued:

* a key that no column has, held by at least ``least_share`` of the load's rows, becomes a column (so the number of columns
  that one load can add is bounded by the keys of a row divided by that share);
* its type is that of its values: bigint for whole numbers, double for others, boolean, string; several of these together
  make string. Nested values and nulls don't make a column, and stay rescued.

The next load parses the column. Rows that arrived before keep their files; `promoted` reads the column from what they
rescued, so that a reader sees one column from the first occurrence on. A value that doesn't fit the column's type stays rescued.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.sources.landing import RESCUED, unused_prefix, variants

LOG = "load int, position int, name string, type string"
LEAST_SHARE = 0.01


@dataclass(frozen=True)
class SchemaMemory:
    """The log of one flow."""

    path: str
    least_share: float = LEAST_SHARE

    def _entries(self, spark: SparkSession) -> list:
        try:
            return spark.read.schema(LOG).parquet(self.path).orderBy("load", "position").collect()  # one row per column learnt
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def learnt(self, spark: SparkSession) -> list[T.StructField]:
        """The columns learnt so far, in the order in which they were."""
        return [T.StructField(r.name, T.DataType.fromDDL(r.type)) for r in self._entries(spark)]

    def learn(self, loaded: DataFrame) -> list[T.StructField]:
        """Add the columns that the rows of a load teach to the log, and return them; ``loaded`` has all its columns."""
        spark = loaded.sparkSession
        entries = self._entries(spark)
        total = F.lit(loaded.count())
        keys = loaded.filter(F.col(RESCUED).isNotNull()).select(F.explode(variants(F.col(RESCUED))).alias("name", "value"))
        unknown = keys.filter(~F.col("name").isin(loaded.columns))
        kinds = unknown.groupBy("name").agg(F.count("*").alias("n"), F.collect_set(F.schema_of_variant("value")).alias("kinds"))
        frequent = kinds.filter(F.col("n") >= total * self.least_share)
        known = {name.lower() for name in loaded.columns}  # column names don't tell cases apart
        new = []
        for r in frequent.orderBy("name").collect():  # bounded by the share
            kind = column_type(r.kinds)
            if kind and r["name"].lower() not in known:
                known.add(r["name"].lower())
                new.append((r["name"], kind))
        if new:
            load = max((e.load for e in entries), default=0) + 1
            rows = [(load, k, *field) for k, field in enumerate(new)]
            spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(self.path)
        return [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in new]


def column_type(kinds: Sequence[str]) -> str | None:
    """The column type for the kinds of a key's values; None if some are nested or none has a type."""
    found = set()
    for kind in kinds:
        if kind.startswith("DECIMAL"):
            kind = "DOUBLE"
        if kind in ("BIGINT", "DOUBLE", "BOOLEAN", "STRING"):
            found.add(kind.lower())
        elif kind != "VOID":
            return None
    if found == {"bigint", "double"}:
        return "double"
    return None if not found else found.pop() if len(found) == 1 else "string"


def add_columns(spark: SparkSession, name: str, fields: Sequence[T.StructField]) -> None:
    """Give a stored table further columns; its old files read as NULL there."""
    if not spark.catalog.tableExists(name):
        return
    have = set(spark.read.table(name).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
        spark.catalog.refreshTable(name)


def _kept(value: Column, kind: T.DataType) -> Column:
    """A variant as a column value; only a value of the same kind fits, as when a line is parsed."""
    fits = {"bigint": ["BIGINT"], "double": ["BIGINT", "DOUBLE"], "boolean": ["BOOLEAN"]}.get(kind.simpleString())
    shape = F.schema_of_variant(value)
    plain = F.when(shape.startswith("DECIMAL"), F.lit("DOUBLE")).otherwise(shape)
    right = plain.isin(fits) if fits else ~shape.startswith("OBJECT") & ~shape.startswith("ARRAY")
    return F.when(right, F.try_variant_get(value, "$", kind.simpleString()))


def promoted(table: DataFrame, learnt: Sequence[T.StructField]) -> DataFrame:
    """Rows of a landing table with each learnt column filled from ``_rescued`` where its row arrived before the column; what fits leaves ``_rescued``."""
    if not learnt:
        return table
    # Each step reads several times what the one before it made, so the optimizer keeps them apart: a rescue is parsed once.
    made = unused_prefix(table.columns)
    held, names, left = (F.col(f"{made}{c}") for c in ("held", "names", "left"))
    values = {f.name: f"{made}value{k}" for k, f in enumerate(learnt)}
    opened = table.withColumn(f"{made}held", variants(F.col(RESCUED)))
    found = opened.withColumns({values[f.name]: F.element_at(held, f.name) for f in learnt})
    fitting = found.withColumns({values[f.name]: _kept(F.col(values[f.name]), f.dataType) for f in learnt})
    promotes = F.array_compact(F.array(*[F.when(F.col(v).isNotNull(), F.lit(name)) for name, v in values.items()]))
    named = fitting.withColumn(f"{made}names", F.when(held.isNotNull(), promotes))
    rests = F.when(F.size(names) > 0, F.map_filter(held, lambda k, v: ~F.array_contains(names, k)))
    whole = named.withColumn(f"{made}left", rests)
    rest = F.when(held.isNull() | (F.size(names) == 0), F.col(RESCUED)).when(F.size(left) > 0, F.to_json(left))
    columns = {name: F.coalesce(F.col(name), F.col(v)) for name, v in values.items()}
    return whole.select(*[columns.get(c, F.col(c)).alias(c) if c != RESCUED else rest.alias(c) for c in table.columns])
