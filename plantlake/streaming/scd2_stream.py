"""Incremental type 2 history: a streaming upsert into a bucketed parquet table.

A micro-batch rewrites only the key buckets it touches, into a folder of its own
(``<root>/data/run=<id>/bucket=<b>``), and then publishes a small map from bucket to run
(``<root>/heads/version=<n>``). Data that a published map points to is never overwritten,
so readers always see a complete history. A batch that failed half way leaves no trace,
and running a batch twice changes nothing. One query may write to a target at a time.

The map also says how many buckets the history was cut into. A target with another number
cuts the whole history anew, as one published run, before it takes its first batch.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plantlake.operators.scd2 import END, START, applicable, apply_scd2, with_hashed_key

HEAD = "bucket int, run string, buckets int, version long"


@dataclass(frozen=True)
class HistoryTarget:
    """Where a streamed history lives and how its versions are formed."""

    root: str
    keys: Sequence[str]
    sequence_by: str
    tie_break: Sequence[str] = ()
    surrogate: str | None = None
    buckets: int = 64

    def _schema(self, changes: T.StructType) -> T.StructType:
        sequence = changes[self.sequence_by].dataType
        key = [T.StructField(self.surrogate, T.LongType())] if self.surrogate else []
        validity = [T.StructField(START, sequence), T.StructField(END, sequence)]
        return T.StructType([*key, *changes.fields, *validity])

    def head(self, spark: SparkSession) -> tuple[int, dict[int, str], int]:
        """The last published version, its bucket -> run map (one entry per bucket at most) and its number of buckets."""
        try:
            heads = spark.read.schema(HEAD).parquet(f"{self.root}/heads")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}, self.buckets
        # The file list already names the versions; no job is needed to find the last one.
        version = max((int(re.search(r"/version=(\d+)/", f)[1]) for f in heads.inputFiles()), default=0)
        rows = heads.filter(F.col("version") == version).collect()
        counts = {r.buckets for r in rows}
        if rows and (len(counts) != 1 or None in counts):
            raise ValueError(f"{self.root}: version {version} does not say how many buckets it has")
        return version, {r.bucket: r.run for r in rows}, counts.pop() if counts else self.buckets

    def _read(self, spark: SparkSession, changes: T.StructType, runs: dict[int, str]) -> DataFrame:
        schema = self._schema(changes)
        if not runs:
            return spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/run={run}/bucket={bucket}" for bucket, run in sorted(runs.items())]
        return spark.read.schema(schema).parquet(*paths)

    def read(self, spark: SparkSession, changes: T.StructType) -> DataFrame:
        """The published history; ``changes`` is the schema of the change feed."""
        return self._read(spark, changes, self.head(spark)[1])

    def publish(self, spark: SparkSession, name: str, changes: T.StructType) -> DataFrame:
        """Make table ``name`` show the published history, and return a read of it.

        The table is external and partitioned by bucket; each partition points at the run
        that wrote it last. No data moves.
        """
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(changes))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, bucket int) USING parquet"
            f" PARTITIONED BY (bucket) LOCATION '{self.root}/data'"
        )
        known = {int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        where = {b: f"LOCATION '{self.root}/data/run={run}/bucket={b}'" for b, run in self.head(spark)[1].items()}
        added = " ".join(f"PARTITION (bucket={b}) {place}" for b, place in where.items() if b not in known)
        if added:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        for b in known:
            change = f"PARTITION (bucket={b}) SET {where[b]}" if b in where else f"DROP PARTITION (bucket={b})"
            spark.sql(f"ALTER TABLE {name} {change}")
        # Sizes only, from the file listing: joins then know how small or large the history is.
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
        return spark.read.table(name).drop("bucket")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, history: DataFrame) -> str:
        """Store versions as a new run, cut by bucket, and return its name."""
        run = uuid.uuid4().hex
        # Rebalancing gathers a bucket into few files, and still splits a hot one.
        laid_out = history.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        laid_out = laid_out.sortWithinPartitions("bucket", *self.keys, self.sequence_by)
        laid_out.write.partitionBy("bucket").parquet(f"{self.root}/data/run={run}")
        return run

    def _publish_head(self, spark: SparkSession, version: int, runs: dict[int, str]) -> None:
        rows = spark.createDataFrame([(b, r, self.buckets) for b, r in runs.items()], "bucket int, run string, buckets int")
        # A version without its file does not exist for readers; one file makes it atomic.
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/heads/version={version}")

    def _rebucketed(self, spark: SparkSession, changes: T.StructType) -> tuple[int, dict[int, str]]:
        """The head, after cutting the history anew if its number of buckets is another."""
        version, runs, buckets = self.head(spark)
        if not runs or buckets == self.buckets:
            return version, runs
        whole = self._read(spark, changes, runs)
        run = self._write(whole)
        used = whole.select(self._bucket().alias("bucket")).distinct().collect()  # at most `buckets` values
        runs = {r.bucket: run for r in used}
        self._publish_head(spark, version + 1, runs)
        return version + 1, runs

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Fold one micro-batch into the history.

        Old and new rows of the touched buckets go through the same rule as a full rebuild,
        so late, replayed and tied rows give what a rebuild over all rows so far would give.
        """
        spark, changes = batch.sparkSession, batch.schema
        new = applicable(batch, self.keys, self.sequence_by).persist()
        try:
            touched = {r[0] for r in new.select(self._bucket()).distinct().collect()}  # at most `buckets` values
            if not touched:
                return
            version, runs = self._rebucketed(spark, changes)
            old = self._read(spark, changes, {b: run for b, run in runs.items() if b in touched})
            merged = apply_scd2(
                old.select(*changes.names).unionByName(new), self.keys, self.sequence_by, self.tie_break
            )
            if self.surrogate:
                merged = with_hashed_key(merged, self.keys, self.surrogate)
            run = self._write(merged)
            self._publish_head(spark, version + 1, {**runs, **dict.fromkeys(touched, run)})
        finally:
            new.unpersist()


def stream_history(changes: DataFrame, target: HistoryTarget, checkpoint: str) -> StreamingQuery:
    """Apply all unseen changes to ``target`` and return the finished query."""
    query = (
        changes.writeStream.foreachBatch(target.upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
