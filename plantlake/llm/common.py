"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.session import scratch_path

#: White space that separates words, everywhere in this package.
SPACE = r"\x20\x09-\x0D"


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, where the job's own path or ``--py-files`` doesn't already."""
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    on_path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
    packaged = not (root / "plantlake").is_dir()
    if not packaged and root not in map(Path, on_path) and not any("plantlake-code" in f for f in context.listFiles):
        base = os.path.join(tempfile.mkdtemp(), "plantlake-code")
        context.addPyFile(shutil.make_archive(base, "zip", root, "plantlake"))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, so that later readers start from files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``modulus``; NULL ids give -1, which is no remainder."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1))


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece stay near ``most_bytes``; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(column)
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(text), 0), dtype=np.int64))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            yield batch.slice(first, last - first)
            first = last


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts, one after the other, and the offsets of the texts (NULL: empty)."""
    text = pc.fill_null(text, "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = pa.types.is_large_string(text.type)
    raw = text.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1]
    offsets = offsets.astype(np.int64)
    if raw[2] is None:
        return np.zeros(0, dtype=np.uint8), offsets
    data = np.frombuffer(raw[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit hashes so that every bit depends on every bit (in place on a fresh array)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
