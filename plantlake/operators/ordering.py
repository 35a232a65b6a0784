"""Ordered operations that stay balanced when one key holds a large share of the rows.

A window partitioned by the key alone puts a whole key into one task. Here a key is
cut into ranges or chunks of its ordering column first, and only one small row per range
or chunk connects them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.session import write_through


def chunk_of(df: DataFrame, column: str, unit: str = "hour", width: int = 1_000_000) -> Column:
    """The chunk a value of ``column`` falls in: a calendar unit, or ``width`` for numbers."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.floor(F.col(column) / F.lit(width))
    return F.date_trunc(unit, F.col(column))


def with_next(df: DataFrame, keys: Sequence[str], order: str, output: str) -> DataFrame:
    """Add the next value of ``order`` within the key; (keys, order) must be unique and not NULL.

    Equal to ``lead(order) OVER (PARTITION BY keys ORDER BY order)``. The input is read once and shuffled once, into
    ranges of (keys, order) that a hot key crosses like any other. Each task looks at neighbours in its sorted range. What the
    last row of a range needs is the first row of the following one; these are one row per range. The ranges are written
    first, because their bounds come from sampling and must not be drawn a second time.
    """
    keys = list(keys)
    marks = [T.StructField("_range", T.IntegerType()), T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())]
    schema = T.StructType([*df.schema.fields, T.StructField(output, df.schema[order].dataType), *marks])
    ranges = df.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order)
    placed = write_through(ranges.mapInArrow(_neighbours(keys, order, schema.names), schema), "with_next")
    firsts = placed.filter("_first").select("_range", F.struct(*keys, F.col(order).alias("_value")).alias("_row"))
    following = firsts.select("_range", F.lead("_row").over(Window.orderBy("_range")).alias("_edge"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_edge.`{k}`") for k in keys])
    return (
        placed.join(F.broadcast(following), "_range", "left")
        .withColumn(output, F.when(F.col("_last") & same, F.col("_edge._value")).otherwise(F.col(output)))
        .select(*df.columns, output)
    )


def _neighbours(keys: list[str], order: str, names: list[str]):
    """Rows sorted by (keys, order), each with the ``order`` of the following row if that has the same key."""

    def told(table: pa.Table, following: pa.Array, first: bool, last: bool) -> list[pa.RecordBatch]:
        at = np.arange(table.num_rows)
        number = pa.array(np.full(len(at), TaskContext.get().partitionId(), dtype=np.int32))
        marks = [number, pa.array((at == 0) & first), pa.array((at == len(at) - 1) & last)]
        return pa.Table.from_arrays([*table.columns, following, *marks], names=names).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            last = table.num_rows - 1
            if last:
                same = pa.array(np.ones(last, dtype=bool))
                for k in keys:
                    same = pc.and_(same, pc.equal(table.column(k).slice(0, last), table.column(k).slice(1)))
                following = pc.if_else(same, table.column(order).slice(1), pa.scalar(None, table.schema.field(order).type))
                yield from told(table.slice(0, last), following, first, False)
                first = False
            held = table.slice(last).combine_chunks().to_batches()[0]
        if held is not None:
            yield from told(pa.Table.from_batches([held]), pa.nulls(1, held.schema.field(order).type), first, True)

    return run


def with_last_before(
    df: DataFrame, keys: Sequence[str], order: str, value: str, output: str, unit: str = "hour"
) -> DataFrame:
    """Add the latest non-NULL ``value`` among the earlier rows of the key; (keys, order) must be unique.

    Equal to ``last(value) IGNORE NULLS OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING)``. The rows are shuffled by (keys, chunk), and what a chunk needs of the
    earlier ones comes from one pre-aggregated row per (keys, chunk). Keys and order must not be NULL.
    """
    keys = list(keys)
    cut = df.withColumn("_chunk", chunk_of(df, order, unit))
    latest = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    ends = cut.groupBy(*keys, "_chunk").agg(latest.alias("_latest"))

    def earlier(part: list[str], by: str):
        return Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    before = ends.select(
        *keys, "_chunk", F.last("_latest", ignorenulls=True).over(earlier(keys, "_chunk")).alias("_before")
    )
    inside = F.last(value, ignorenulls=True).over(earlier([*keys, "_chunk"], order))
    return (
        cut.withColumn("_inside", inside)
        .join(before, [*keys, "_chunk"], "left")
        .withColumn(output, F.coalesce("_inside", "_before"))
        .select(*df.columns, output)
    )


def dense_number(df: DataFrame, order: Sequence[str], output: str) -> DataFrame:
    """Number all rows 0, 1, 2 … in the given total order, without a global window.

    Range partitioning sorts the data into balanced partitions; each row then needs its
    position in its partition plus the sizes of the partitions before it. The partitions
    are written out first, because the range bounds come from sampling and must not be
    drawn a second time. The offsets hold one row per partition.
    """
    marks = F.col("_mark")
    placed = write_through(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
        .select(
            *df.columns,
            F.shiftright(marks, 33).cast("int").alias("_part"),
            marks.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        ),
        "dense_number",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(output, F.col("_offset") + F.col("_pos"))
        .select(*df.columns, output)
    )
