"""Stored tables with data skipping: range-partitioned, sorted files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread_by_range(
    df: DataFrame, columns: Sequence[str], files: int | None = None, row_id: Sequence[str] = ()
) -> DataFrame:
    """Range-partition by ``columns`` so that each output file covers a narrow range.

    A hash of the row is the last range key: rows that agree on all clustering columns, such
    as one machine within one load, can still be cut into several partitions. The bounds are
    sampled by a run of their own, which reads the columns of the hash: ``row_id`` alone, if given.
    """
    ties = F.xxhash64(*(row_id or [c for c in df.columns if c not in columns] or columns))
    ranges = [*[F.col(c) for c in columns], ties]
    return df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)


def cluster_rows(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """`spread_by_range`, then sorted within the files so row groups skip as well. Batch only."""
    return spread_by_range(df, columns, files).sortWithinPartitions(*columns)


#: Cut points of a column are taken from about this many of its values; only the layout depends on them.
SAMPLED = 100_000


def cut_points(df: DataFrame, columns: Sequence[str], parts: int) -> dict[str, list]:
    """For each column the values that cut its rows into ``parts`` about equal ranges; the sample is drawn by hash and bounded."""
    every = max(1, df.count() // SAMPLED)
    drawn = df.filter(F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.lit(every)) == 0)
    at = F.sequence(F.lit(1), F.lit(parts - 1))

    def points(column: str):
        values = F.sort_array(F.collect_list(column))
        return F.when(F.size(values) > 0, F.transform(at, lambda i: F.get(values, F.ceil(i * F.size(values) / parts).cast("int") - 1)))

    found = drawn.agg(*[points(c).alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return {c: found[f"c{k}"] or [] for k, c in enumerate(columns)}


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on a Z-shaped curve through the ranks of several columns.

    A column's rank is the number of its cut points that the value reaches, 0 for NULL; the bits of the ranks alternate,
    highest first, so that a range of the key is narrow in every column, not only in the first.
    """

    def rank_of(column: str, points: list) -> Column:
        kind, value = df.schema[column].dataType, F.col(column)
        cuts = F.array(*[F.lit(v).cast(kind) for v in points]).cast(T.ArrayType(kind))
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(cuts, lambda v: v <= value))).cast("long")

    key = F.lit(0).cast("long")
    for k, (column, points) in enumerate(cut_points(df, columns, 1 << bits).items()):
        rank = rank_of(column, points)
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key + F.shiftleft(one, bit * len(columns) + len(columns) - 1 - k)
    return key


def cluster_by_curve(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = 6) -> DataFrame:
    """Range-partitioned and sorted along the curve, so that filters on any of the columns skip files. Batch only.

    Like `spread_by_range`, a hash of the row is the last range key: rows of one place still split.
    """
    placed = df.withColumn("_curve", curve_key(df, columns, bits))
    ranges = [F.col("_curve"), F.xxhash64(*df.columns)]
    placed = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    return placed.sortWithinPartitions("_curve", *columns).drop("_curve")


def compact(spark: SparkSession, name: str, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rewrite the files of a table, such as the small ones of many appends, as larger ones clustered along a curve; returns a read of it.

    The table's location moves to the new files at once; the old ones may be deleted when no reader uses them. No append may run meanwhile.
    """
    return materialize(cluster_by_curve(spark.read.table(name), columns, files), name)


def files_in_range(df: DataFrame, column: str, low, high) -> tuple[int, int]:
    """Of a read of stored files: how many a filter on ``low <= column <= high`` has to open by their least and greatest value, and all."""
    spans = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("least"), F.max(column).alias("most"))
    return tuple(spans.agg(F.count_if((F.col("least") <= F.lit(high)) & (F.col("most") >= F.lit(low))), F.count("*")).first())


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they are kept by views and stored tables."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns]
    )


def describe_table(spark, name: str, comment: str = "", properties: Mapping[str, str] | None = None) -> None:
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")
    if properties:
        pairs = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _location(spark: SparkSession, database: str) -> str:
    rows = spark.sql(f"DESCRIBE DATABASE {database}").filter("info_name = 'Location'")
    return rows.first()["info_value"].rstrip("/")


def table_location(spark: SparkSession, name: str, of: str) -> str:
    """A folder of its own for a table whose partitions are written one by one; ``of`` says what they are."""
    database, _, table = name.rpartition(".")
    return f"{_location(spark, database or spark.catalog.currentDatabase())}/{table}.{of}"


def declared_columns(df: DataFrame, columns: Sequence[str]) -> str:
    """Column definitions of a stored table, comments included."""
    parts = []
    for field in (df.schema[c] for c in columns):
        text = field.metadata.get("comment", "").replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{field.name}` {field.dataType.simpleString()}" + (f" COMMENT '{text}'" if text else ""))
    return ", ".join(parts)


def materialize(
    df: DataFrame,
    name: str,
    cluster_by: Sequence[str] = (),
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full refresh of a stored table; returns a read of it.

    The rows go to a folder of their own, and then the table's location moves there. A refresh that fails
    leaves the table as it was; readers that began before it still find their files.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    place = f"{_location(spark, database or spark.catalog.currentDatabase())}/{table}.runs/{uuid.uuid4().hex}"
    laid_out = cluster_rows(df, cluster_by) if cluster_by else df
    laid_out.write.parquet(place)
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({declared_columns(df, df.columns)}) USING parquet LOCATION '{place}'")
    describe_table(spark, name, comment, properties)
    return spark.read.table(name)


def create_view(spark: SparkSession, name: str, query: str, comments: Mapping[str, str], comment: str = "") -> DataFrame:
    """A persistent view with column comments; returns a read of it."""
    columns = []
    for column in spark.sql(query).columns:
        text = comments.get(column, "").replace("'", "\\'")
        columns.append(f"`{column}`" + (f" COMMENT '{text}'" if text else ""))
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({', '.join(columns)}) COMMENT '{comment}' AS {query}")
    return spark.read.table(name)
