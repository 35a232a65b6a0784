"""JSON-lines sink and the reader for small table files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Micro-second ISO text with an offset; the default pattern would cut to milliseconds.
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def write_json_lines(datasets: Mapping[str, DataFrame], output_dir: str) -> dict[str, str]:
    """Append each dataset to ``<output_dir>/<name>`` as JSON lines, NULLs included.

    Spark names the files, so later runs add to earlier ones. Returns name -> directory.
    """
    paths = {}
    for name, df in datasets.items():
        paths[name] = f"{output_dir}/{name}"
        writer = df.write.mode("append").option("ignoreNullFields", "false")
        writer.option("timestampFormat", JSON_TIMESTAMP).json(paths[name])
    return paths


def read_table_file(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON document (an array of records) or a CSV file with header, all strings."""
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    if suffix == "json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == "csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported table file: {path}")
