"""Context-triggered piecewise hashing of texts.

A rolling hash over the last 8 bytes decides where a chunk ends. At block size ``2**k`` a chunk ends where the k lowest
bits of the mixed rolling hash are all set, so every boundary of a size is one of the smaller sizes too. Each chunk
gives one of 64 letters. A fingerprint is ``k:letters at k:letters at k+1``; ``k`` is the largest size
with at least 32 chunks (0 for short texts), and letters beyond 64 fold into the last one, which then
stands for the rest of the text.

Two fingerprints are comparable where they have letters at the same size. Their likeness is
``1 - edit distance / longer length``, and 0 without a common run of 7 letters (or the shorter one's length);
equal texts have equal fingerprints and likeness 1. Edit distances are bit-parallel, a batch of pairs at a time.

NULL texts count as empty. An empty text has the fingerprint ``0::``; two empty texts have likeness 1.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plantlake.llm.common import mixed, slices, stored

LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
MOST, LEAST, RUN, WINDOW = 64, 32, 7, 8
#: Bytes of text that are compared together.
TOGETHER = 2 << 20
#: Bytes that are hashed at once; longer texts are hashed piece by piece.
PIECE = 1 << 18
# Odd multipliers of the rolling hash for windows of 1, 2 and 4 bytes.
_MULTIPLIERS = [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in (1, 2, 4)]


def boundary_levels(data: bytes) -> np.ndarray:
    """For each byte, how many of the lowest bits of the rolling hash that ends there are set."""
    raw = np.frombuffer(data, dtype=np.uint8)
    out = np.empty(len(raw), dtype=np.uint8)
    for start in range(0, len(raw), PIECE):
        lead = min(start, WINDOW)
        h = raw[start - lead : start + PIECE].astype(np.uint64)
        h += np.uint64(1)
        for step, multiplier in zip((1, 2, 4), _MULTIPLIERS, strict=True):
            earlier = h[:-step] * multiplier
            h[step:] += earlier
        h = mixed(h[lead:])
        h = ~h
        out[start : start + PIECE] = np.bitwise_count((h & (np.uint64(0) - h)) - np.uint64(1))
    return out


def _letters(data: bytes, ends: np.ndarray) -> str:
    n = len(data)
    if len(ends) >= MOST:
        ends = np.append(ends[: MOST - 1], n)
    elif not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    view, start, out = memoryview(data), 0, bytearray()
    for end in ends.tolist():
        out.append(LETTERS[zlib.crc32(view[start:end]) & 63])
        start = end
    return out.decode()


def fingerprint_bytes(data: bytes) -> str:
    if not data:
        return "0::"
    level = boundary_levels(data)
    counts = np.cumsum(np.bincount(level, minlength=66)[::-1])[::-1]
    k = int(max(np.flatnonzero(counts >= LEAST), default=0))
    at = np.flatnonzero(level >= k)
    return f"{k}:{_letters(data, at + 1)}:{_letters(data, at[level[at] > k] + 1)}"


def edit_distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Levenshtein distances of pairs of at most 64 letters each (Myers' bit vectors, all pairs at once)."""
    n = len(a)
    if not n:
        return np.zeros(0, dtype=np.int64)
    la, lb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    left, right = np.zeros((n, MOST), dtype=np.uint8), np.zeros((n, MOST), dtype=np.uint8)
    for i in range(n):
        left[i, : la[i]], right[i, : lb[i]] = np.frombuffer(a[i], np.uint8), np.frombuffer(b[i], np.uint8)
    one, bits = np.uint64(1), np.uint64(1) << np.arange(MOST, dtype=np.uint64)
    used = np.arange(MOST) < la[:, None]
    top = np.uint64(1) << np.maximum(la - 1, 0).astype(np.uint64)
    pv, mv, score = np.full(n, 2**64 - 1, dtype=np.uint64), np.zeros(n, dtype=np.uint64), la.astype(np.int64)
    for j in range(int(lb.max(initial=0))):
        live = j < lb
        eq = (((left == right[:, j, None]) & used) * bits).sum(axis=1, dtype=np.uint64)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score += np.where(live, ((ph & top) != 0).astype(np.int64) - ((mh & top) != 0), 0)
        ph, mh = (ph << one) | one, mh << one
        new_pv, new_mv = mh | ~(xv | ph), ph & xv
        pv, mv = np.where(live, new_pv, pv), np.where(live, new_mv, mv)
    return np.where(la == 0, lb, score)


def _shared_run(a: bytes, b: bytes) -> bool:
    run = min(RUN, len(a), len(b))
    if not run:
        return a == b
    seen = {a[i : i + run] for i in range(len(a) - run + 1)}
    return any(b[i : i + run] in seen for i in range(len(b) - run + 1))


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints."""
    out = np.zeros(len(pairs))
    rows, left, right = [], [], []
    for i, (p, q) in enumerate(pairs):
        if p == q:
            out[i] = 1.0
            continue
        kp, *sp = p.split(":")
        kq, *sq = q.split(":")
        for u, s in enumerate(sp):
            for v, t in enumerate(sq):
                if int(kp) + u == int(kq) + v and s and t and _shared_run(s.encode(), t.encode()):
                    rows.append(i)
                    left.append(s.encode())
                    right.append(t.encode())
    if rows:
        longest = np.array([max(len(s), len(t)) for s, t in zip(left, right, strict=True)])
        np.maximum.at(out, rows, 1.0 - edit_distances(left, right) / longest)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of each row."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_bytes((t.as_py() or "").encode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) of the code points, replaced by as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple], following: list[tuple]) -> dict[str, pa.Array]:
    """``rows``: (id, text, fingerprint); ``following``: the row after each."""
    edited = [edited_text(r[1], f[1]).encode() for r, f in zip(rows, following, strict=True)]
    prints = [fingerprint_bytes(e) for e in edited]
    return {
        "n_chars": pa.array([len(r[1]) for r in rows], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        "fingerprint": pa.array([r[2] for r in rows], pa.string()),
        "edited_fingerprint": pa.array(prints, pa.string()),
        "near_edited": pa.array(likeness([(r[2], p) for r, p in zip(rows, prints, strict=True)])),
        "near_next": pa.array(likeness([(r[2], f[2]) for r, f in zip(rows, following, strict=True)])),
    }


_RESULT = [
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses (see ``edited_text``).

    Rows follow each other by id, NULL ids last, rows of one id by a hash of the text; after the last comes the first.
    The texts are shuffled once, into ranges of ids. Inside a range each row meets the next; the last row of a range
    and the first row of the next range are handed to a second step, two texts per range.
    """
    spark = docs.sparkSession
    id_field = T.StructField(id_col, docs.schema[id_col].dataType)
    schema = T.StructType(
        [id_field, *_RESULT, T.StructField("piece", T.IntegerType()), T.StructField("edge", T.StringType()), T.StructField("text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()

        def edge(kind: str, row: tuple) -> pa.RecordBatch:
            columns = [pa.array([row[0]], ids)] + [pa.nulls(1, t) for t in types[1:-3]]
            return pa.RecordBatch.from_arrays([*columns, pa.array([piece], pa.int32()), pa.array([kind]), pa.array([row[1]])], names=schema.names)

        pending = None
        for batch in slices(batches, 1, TOGETHER):
            rows = [(i, t or "") for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = [(i, t, fingerprint_bytes(t.encode())) for i, t in rows]
            if pending is None:
                yield edge("first", rows[0])
            else:
                rows.insert(0, pending)
            pending = rows[-1]
            if len(rows) > 1:
                found = _compared(rows[:-1], rows[1:])
                n = len(rows) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows[:-1]], ids), *found.values(), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())],
                    names=schema.names,
                )
        if pending is not None:
            yield edge("last", pending)

    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(id_col, text_col).withColumn("tie", F.xxhash64(text_col))
    ordered = ordered.repartitionByRange(pieces, F.col(id_col).asc_nulls_last(), "tie")
    ordered = ordered.sortWithinPartitions(F.col(id_col).asc_nulls_last(), "tie").select(id_col, text_col)
    arrow = to_arrow_schema(schema)
    types, ids = arrow.types, arrow.field(0).type
    done = stored(ordered.mapInArrow(run, schema), "fingerprint-pieces")

    # Which range follows which: one number per range.
    used = sorted(r[0] for r in done.filter("edge = 'first'").select("piece").collect())
    follows = spark.createDataFrame(list(zip(used, used[1:] + used[:1], strict=True)), "piece int, next int")
    last = done.filter("edge = 'last'").select("piece", id_col, "text")
    first = done.filter("edge = 'first'").select(F.col("piece").alias("next"), F.col("text").alias("following"))
    meeting = last.join(follows, "piece").join(first, "next").select(id_col, "text", "following")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, following = ([(None, t, fingerprint_bytes(t.encode())) for t in batch.column(k).to_pylist()] for k in (1, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_compared(rows, following).values()], names=[id_col, *(f.name for f in _RESULT)])

    stitched = meeting.mapInArrow(stitch, T.StructType([id_field, *_RESULT]))
    return done.filter("edge is null").select(id_col, *[f.name for f in _RESULT]).unionByName(stitched)
