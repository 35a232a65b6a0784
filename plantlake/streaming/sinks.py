"""Append sinks that drain what has arrived and stop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plantlake.operators.layout import describe_table, spread_by_range, table_location
from plantlake.operators.quality import Rules, keep_valid, observe_rules


def append_to_table(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    cluster_by: Sequence[str] = (),
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append all unseen input to table ``name`` exactly once, then return the finished query.

    The checkpoint holds the progress; the file sink's log makes a replayed batch a no-op.
    With ``cluster_by`` each batch is range-partitioned, so its files cover narrow ranges.
    """
    laid_out = spread_by_range(stream, cluster_by) if cluster_by else stream
    query = (
        laid_out.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(name)
    )
    query.awaitTermination()
    describe_table(stream.sparkSession, name, comment, properties)
    return query


BATCH = "_batch"
#: Rows of a clustered micro-batch for each range. Bounds are sampled at the driver, a few hundred rows a range, so a
#: batch gets as many ranges as it has rows for, not those of a whole shuffle.
RANGE_ROWS = 100_000


def append_counted(
    stream: DataFrame,
    rules: Rules,
    name: str,
    checkpoint: str,
    counts_path: str,
    cluster_by: Sequence[str] = (),
    row_id: Sequence[str] = (),
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Append the rows of all unseen input that pass every rule to table ``name``; returns the sums of the rule counts.

    Rows and counts of a micro-batch are published under its number: the rows as a partition of the table, the counts as a
    partition below ``counts_path`` (see `rule_history`). The counts are observed while the rows are written, without
    another pass. First the rows are written, then the counts, and then the table gets its partition. Each step replaces
    what an earlier attempt left, so a run that ends anywhere in between shows nothing half done, and its batch, which the
    next run gets again under the same number, counts once.
    """
    spark, totals = stream.sparkSession, {}
    place = table_location(spark, name, "batches")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BATCH} bigint) USING parquet PARTITIONED BY ({BATCH}) LOCATION '{place}'"
    )
    describe_table(spark, name, comment, properties)

    def publish(batch: DataFrame, number: int) -> None:
        # Range bounds are sampled by an extra run of what lies below them, so counting comes after the shuffle.
        laid_out = batch
        if cluster_by:
            ranges = -(-batch.count() // RANGE_ROWS) or 1
            laid_out = spread_by_range(batch, cluster_by, ranges, row_id).sortWithinPartitions(*cluster_by)
        seen = Observation()
        kept = keep_valid(observe_rules(laid_out, rules, seen), rules)
        kept.write.mode("overwrite").parquet(f"{place}/{BATCH}={number}")
        write_counts(batch.sparkSession, seen.get, f"{counts_path}/batch={number}")
        batch.sparkSession.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({BATCH} = {number})")
        for rule, count in seen.get.items():
            totals[rule] = totals.get(rule, 0) + count

    query = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark.catalog.refreshTable(name)
    return totals


def write_counts(spark: SparkSession, counts: Mapping[str, int], place: str) -> None:
    rows = spark.createDataFrame(list(counts.items()), "rule string, passed long")
    rows.coalesce(1).write.mode("overwrite").parquet(place)


def rule_history(spark: SparkSession, counts_path: str) -> DataFrame:
    """rule, passed, batch of every micro-batch counted so far; the rule ``total`` counts the rows."""
    return spark.read.schema("rule string, passed long, batch long").parquet(counts_path)
