"""Landing folder to bronze: newline-delimited JSON with declared types and a rescue column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.config import IngestSpec

RESCUED = "_rescued"
LINEAGE = ["_loading_ts", "_file_path", "_file_name", "_file_modification_time", "_file_size"]


def parse_lines(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse JSON text into the declared columns plus ``_rescued``; other columns pass through.

    A value that does not fit its declared type becomes NULL, and it is kept, with every
    undeclared key, as JSON in ``_rescued``: nested values, numbers and booleans stay what they were, keys are in
    order. A line that is not a JSON object, or that names a key twice, is kept whole.
    ``_rescued`` is NULL when nothing was lost. JSON nulls and missing keys lose nothing.
    """
    others = [c for c in lines.columns if c != value]
    made = unused_prefix(others)
    declared = [f.name for f in schema]
    typed = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    bad = "_bad_line"
    typed.add(bad, T.StringType())
    parsed = lines.filter(F.trim(F.col(value)) != "").select(
        *others,
        F.col(value).alias(f"{made}line"),
        F.from_json(value, typed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}).alias(f"{made}row"),
        F.json_object_keys(value).alias(f"{made}keys"),
    )
    row = F.col(f"{made}row")
    return _with_rescued(parsed, declared, bad, made).select(*[row.getField(c).alias(c) for c in declared], F.col(f"{made}rescued").alias(RESCUED), *others)


def unused_prefix(columns: Sequence[str]) -> str:
    """A prefix that no column begins with, for columns made on the way."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def variants(json: Column) -> Column:
    """The members of a JSON object as variants by key; NULL for anything else."""
    return F.try_parse_json(json).try_cast("map<string,variant>")


def _with_rescued(parsed: DataFrame, declared: Sequence[str], bad: str, made: str) -> DataFrame:
    """Add the rescue column to lines with their row and keys.

    Each step reads several times what the one before it made, so the optimizer keeps them apart, and a line is parsed once for each.
    The second parse, into variants, runs only for lines with a misfit or an undeclared key.
    """
    line, row, keys, intact, raw, lost, left = (F.col(f"{made}{c}") for c in ("line", "row", "keys", "intact", "raw", "lost", "left"))
    known = F.array(*[F.lit(c) for c in declared])
    whole = row.getField(bad).isNull() & keys.isNotNull() & (F.size(F.array_except(keys, known)) == 0)
    lost_names = F.array_compact(F.array(*[F.when(row.getField(c).isNull(), F.lit(c)) for c in declared]))
    judged = parsed.withColumn(f"{made}intact", whole)
    opened = judged.withColumns(
        {f"{made}raw": F.when(~intact & keys.isNotNull(), variants(line)), f"{made}lost": F.when(~intact, lost_names)}
    )
    kept = F.map_filter(
        raw,
        lambda k, v: ~F.is_variant_null(v) & (~F.array_contains(known, k) | F.array_contains(lost, k)),
    )
    rescued = (
        F.when(intact, F.lit(None).cast("string"))
        .when(keys.isNull() | raw.isNull(), line)
        .when(F.size(left) > 0, F.to_json(left))
    )
    return opened.withColumn(f"{made}left", kept).withColumn(f"{made}rescued", rescued)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add when and from which file each row was loaded; needs the hidden ``_metadata`` column."""
    meta = F.col("_metadata")
    return df.withColumns(
        {
            "_loading_ts": F.current_timestamp(),
            "_file_path": meta.getField("file_path"),
            "_file_name": meta.getField("file_name"),
            "_file_modification_time": meta.getField("file_modification_time"),
            "_file_size": meta.getField("file_size"),
        }
    )


def ingest_json(
    spark: SparkSession,
    spec: IngestSpec,
    base: str,
    archive: bool = False,
    max_files_per_trigger: int | None = None,
    glob: str = "*.json",
    learnt: Sequence[T.StructField] = (),
) -> DataFrame:
    """Streaming DataFrame over all files of ``<base>/<source_path>``, each read once; ``glob`` picks by name.

    ``learnt`` are columns beyond the declared ones (see `plantlake.sources.schema_memory`); they come last.

    Progress lives in the checkpoint of the query that consumes the stream. With ``archive``
    a consumed file moves to ``<base>/_archive/<source_path>`` in a later batch.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if archive:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", f"{base}/_archive/{spec.source_path}"
        )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = with_lineage(reader.load(f"{base}/{spec.source_path}"))
    schema = T.StructType([*spec.schema.fields, *learnt])
    return parse_lines(lines, schema).select(*spec.schema.names, RESCUED, *LINEAGE, *[f.name for f in learnt])
