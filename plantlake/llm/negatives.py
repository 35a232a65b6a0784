"""Hard negatives of anchors among vectors, by exact inner products with LEMP-style coordinate pruning.

Components become whole numbers, floor(256 x) as a rule of the query. For an anchor, rows are ranked by their inner product with it, higher first,
ties by smaller id. Its positives are the first rows of its own label; for each positive, the negatives are the first rows
of another label whose score lies in a band that the positive's score fixes.

1. *Length buckets.* Rows are numbered in order of falling length and cut into buckets of equal size, so that equal vectors, however
   many, fill several buckets. A bucket keeps its rows in one task; anchors come to it in blocks. The anchors are a stated query set, and
   only the buckets whose longest row can reach an anchor's least useful score get that anchor: a prefix of the buckets.
2. *Coordinate lists.* In a bucket each coordinate of the unit vectors has a sorted list. For an anchor with unit vector q and a least cosine c, which
   follows from its least useful score and the bucket's longest row, a row p can only qualify if the angles of q_f and p_f differ by arccos c
   at most, for each coordinate f. The anchor's focus coordinates, its largest, give ranges of their lists; the narrowest range is taken, and
   cut with the others. What is left is compared exactly, in whole numbers.
3. *Thresholds.* The anchor first looks in its own bucket only. The k-th best score there is a lower bound of its k-th best overall, so that
   the second look, in all buckets, needs to find better rows only. Positives are found first, since bands follow from their scores.

Rows with a NULL id, label or vector, and with a NULL or non-finite component take no part. A missing component of a shorter vector counts as
zero; an empty vector is zero. Rows that share an id are rows of their own: an anchor is not compared with itself, but with its namesakes.
Zero vectors have score 0 with all rows. Scores are exact: whole-number arithmetic takes over where doubles might round. A score beyond 64 bits raises an error.
Bands of positives with negative scores are empty. Empty tables give no rows. Other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.common import stored
from plantlake.operators.ordering import dense_number

POSITIVES, NEGATIVES = 5, 10
#: Rows of a bucket: this many times the square root of all rows, which balances the copies of anchors against buckets, in these bounds.
BUCKET, LEAST_BUCKET, MOST_BUCKET = 16, 512, 1 << 16
#: Coordinates of an anchor whose ranges are used.
FOCUS = 4
#: Slack of angles, above the rounding of doubles.
SLACK = 1e-9


def bucket_rows(rows: int) -> int:
    return min(MOST_BUCKET, max(LEAST_BUCKET, BUCKET * math.isqrt(rows)))


def whole_components(vector: Column) -> Column:
    """floor(256 x) of each component, x as double; NULL if the vector or a component is NULL or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(doubles, lambda x: F.floor(x * 256.0).cast("long")))


# --- one bucket -------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of whole numbers as rows, padded with zeros; int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.asarray(column.offsets, dtype=np.int64)
    size = np.diff(ends)
    width = int(size.max(initial=0)) if width is None else width
    out = np.zeros((len(size), max(width, 1)), dtype=np.int64)
    inside = np.arange(out.shape[1]) < size[:, None]
    out[inside] = np.asarray(column.values)[ends[0] : ends[-1]]
    return out


def _padded(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


class Bucket:
    """Rows of similar length with the sorted lists of their unit coordinates."""

    def __init__(self, n: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.n, self.ids, self.labels, self.rows = n, ids, labels, rows
        self.doubles = rows.astype(np.float64)
        length = np.sqrt((self.doubles**2).sum(axis=1))
        self.longest, self.largest = float(length.max()), float(np.abs(self.doubles).max())
        self.unit = self.doubles / np.where(length > 0, length, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, anchor: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that can have a score of ``least`` with the anchor; None: any row can."""
        length = math.sqrt(float(anchor @ anchor))
        if least <= 0 or not length or not self.longest:
            return None
        cosine = least / (length * self.longest)
        if cosine > 1 + SLACK:
            return np.zeros(0, dtype=np.int64)
        reach = math.acos(min(1.0, cosine)) + SLACK
        focus = np.argsort(-np.abs(anchor), kind="stable")[:FOCUS].tolist()
        ranges = []
        for f in focus:
            angle = math.acos(max(-1.0, min(1.0, anchor[f] / length)))
            low, high = math.cos(min(math.pi, angle + reach)) - SLACK, math.cos(max(0.0, angle - reach)) + SLACK
            order, values = self._list(f)
            first, last = np.searchsorted(values, low, side="left"), np.searchsorted(values, high, side="right")
            ranges.append((last - first, first, last, f, low, high))
        ranges.sort()
        size, first, last, f, _, _ = ranges[0]
        if size == len(self.n):
            return None
        found = self._list(f)[0][first:last]
        for _, _, _, f, low, high in ranges[1:]:
            value = self.unit[found, f]
            found = found[(value >= low) & (value <= high)]
        return found

    def scores(self, anchor: np.ndarray, doubles: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        """Exact inner products of the anchor with the rows ``at``, or with all."""
        if len(anchor) * float(np.abs(doubles).max(initial=0)) * self.largest < 2**53:
            return ((self.doubles if at is None else self.doubles[at]) @ doubles).astype(np.int64)
        rows = self.rows if at is None else self.rows[at]
        exact = rows.astype(object) @ anchor.astype(object)
        return np.array(exact.tolist(), dtype=np.int64)  # raises beyond 64 bits


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k by falling score, then by rising id."""
    if len(score) > 4 * k:
        # All that tie with the k-th stay for the ordering.
        bound = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= bound)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


_FOUND = "anchor long, band int, n long, id long, score long"
_ROWS = "bucket long, side int, n long, id long, label string, vector array<long>, least array<long>, most array<long>"


def _searched(same: bool, k: int):
    """In each bucket rows come first, then anchors. ``least`` and ``most`` are bands of useful scores, each of which keeps its first k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, bucket = None, [], None
        for batch in batches:
            keys, sides = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (sides[1:] != sides[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if hi == lo:
                    continue
                if keys[lo] != at:
                    at, parts, bucket = keys[lo], [], None
                piece = batch.slice(lo, hi - lo)
                if sides[lo] == 0:
                    parts.append(piece)
                    continue
                if bucket is None:
                    whole = pa.Table.from_batches(parts)
                    columns = [np.asarray(whole.column(c)) for c in ("n", "id", "label")]
                    bucket, parts = Bucket(*columns, _matrix(whole.column("vector"))), []
                yield from looked(bucket, piece)

    def looked(bucket: Bucket, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        rows, most_of = _matrix(piece.column("vector")), piece.column("most").to_pylist()
        width = max(rows.shape[1], bucket.rows.shape[1])
        if width > bucket.rows.shape[1]:
            bucket = Bucket(bucket.n, bucket.ids, bucket.labels, _padded(bucket.rows, width))
        rows = _padded(rows, width)
        numbers, labels, least_of = np.asarray(piece.column("n")), piece.column("label").to_pylist(), piece.column("least").to_pylist()
        for anchor, n, label, least, most in zip(rows, numbers.tolist(), labels, least_of, most_of, strict=True):
            doubles = anchor.astype(np.float64)
            found = bucket.candidates(doubles, min(least))
            own = (bucket.labels if found is None else bucket.labels[found]) == label
            own = np.flatnonzero(own if same else ~own)
            found = own if found is None else found[own]
            found = found[bucket.n[found] != n]
            score = bucket.scores(anchor, doubles, found)
            for band, (low, high) in enumerate(zip(least, most, strict=True)):
                inside = np.flatnonzero((score >= low) & (score <= high))
                kept = inside[best(score[inside], bucket.ids[found[inside]], k)]
                if len(kept):
                    rows_at = found[kept]
                    out.append((np.full(len(kept), n), np.full(len(kept), band), bucket.n[rows_at], bucket.ids[rows_at], score[kept]))
        if out:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["anchor", "band", "n", "id", "score"])

    return run


# --- all buckets ------------------------------------------------------------------------

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and band, with their rank from 1."""
    order = Window.partitionBy("anchor", "band").orderBy(F.col("score").desc(), "id", "n")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(rows: DataFrame, queries: DataFrame, size: int, longest: Column | None, same: bool, k: int, name: str) -> DataFrame:
    """queries: n, label, vector, length, least, most. anchor, band, n, id, score of at most k rows of each anchor, band and bucket.

    Without ``longest`` each query looks in its own bucket only; with it, in every bucket whose longest row can reach its least score.
    """
    bucket = F.floor(F.col("n") / size)
    if longest is not None:
        least = F.array_min("least").cast("double")
        useful = F.size(F.filter(longest, lambda x: x * F.col("length") * (1 + SLACK) >= least))
        reaching = F.when(least <= 0, F.size(longest)).otherwise(useful)
        bucket = F.explode(F.when(reaching > 0, F.sequence(F.lit(0).cast("long"), reaching.cast("long") - 1)))
    looking = queries.select(bucket.alias("bucket"), F.lit(1).alias("side"), "n", F.lit(None).cast("long").alias("id"), "label", "vector", "least", "most")
    none = F.lit(None).cast("array<long>")
    there = rows.select(F.floor(F.col("n") / size).alias("bucket"), F.lit(0).alias("side"), "n", "id", "label", "vector", none.alias("least"), none.alias("most"))
    both = there.unionByName(looking).repartition("bucket").sortWithinPartitions("bucket", "side")
    return stored(both.mapInArrow(_searched(same, k), _FOUND), name)


def _raised(queries: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """Queries whose bands begin at the k-th best score they have seen, where there are as many."""
    kth = _first(seen, k).groupBy("anchor", "band").agg(F.count("*").alias("m"), F.min("score").alias("score")).filter(F.col("m") >= k)
    kth = kth.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("kth"))
    met = queries.join(kth.hint("merge"), F.col("n") == F.col("anchor"), "left")
    raised = F.transform("least", lambda low, band: F.greatest(low, F.element_at("kth", band.cast("int"))))
    return met.withColumn("least", F.when(F.col("kth").isNull(), F.col("least")).otherwise(raised)).select(*queries.columns)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = (30, 90),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` marks the query rows, ``label`` is the label expression (default: the column ``label``). A negative n of a positive p
    satisfies band[0] * p <= 100 * n <= band[1] * p.
    """
    named = (F.col("label") if label is None else label).cast("string")
    narrow = vectors.select(F.col(id_col).alias("id"), named.alias("label"), whole_components(F.col(vector_col)).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    narrow = narrow.dropna(subset=["id", "label", "vector"])
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    narrow = narrow.withColumn("length", F.sqrt(squares)).withColumn("short", -F.col("length"))
    rows = dense_number(narrow, ["short", "id", "label"], "n").drop("short")
    total = rows.count()
    size = bucket_rows(total)
    # One number per bucket travels with the plan: 8 bytes for each MOST_BUCKET rows of a large table.
    bounds = rows.groupBy(F.floor(F.col("n") / size).alias("bucket")).agg(F.max("length").alias("length")).orderBy("bucket")
    longest = F.from_json(F.lit(json.dumps([r["length"] for r in bounds.collect()])), "array<double>")
    rows_all = rows.select("n", "id", "label", "vector")

    queries = rows.filter("asked").select("n", "id", "label", "vector", "length")
    open_ = queries.withColumns({"least": F.array(F.lit(_LOW)), "most": F.array(F.lit(_HIGH))})
    seen = _search(rows_all, open_, size, None, True, positives, "negatives-seed")
    found = _search(rows_all, _raised(open_, seen, positives), size, longest, True, positives, "negatives-positives")
    chosen = _first(found, positives).select("anchor", F.col("n").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("p"))
    chosen = stored(chosen, "negatives-chosen")

    exact = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(exact * band[0] / 100).cast("long"), F.floor(exact * band[1] / 100).cast("long")
    bands = chosen.filter(low <= high).select("anchor", F.struct("p", low.alias("low"), high.alias("high")).alias("b"))
    bands = bands.groupBy("anchor").agg(F.array_sort(F.collect_list("b")).alias("bands"))
    wanted = queries.join(bands.hint("merge"), F.col("n") == F.col("anchor")).select(
        "n", "id", "label", "vector", "length", F.col("bands.low").alias("least"), F.col("bands.high").alias("most"), F.col("bands.p").alias("ps")
    )
    wanted = stored(wanted, "negatives-bands")
    asked = wanted.drop("ps")
    seen = _search(rows_all, asked, size, None, False, negatives, "negatives-seed")
    found = _search(rows_all, _raised(asked, seen, negatives), size, longest, False, negatives, "negatives-found")
    ranked = _first(found, negatives).select("anchor", "band", F.col("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    of = wanted.select(F.col("n").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode("ps").alias("band", "p"))
    kind = vectors.schema[id_col].dataType
    return (
        ranked.join(of.hint("merge"), ["anchor", "band"])
        .join(chosen.hint("merge"), ["anchor", "p"])
        .select(F.col("anchor_id").cast(kind), F.col("positive_id").cast(kind), "rank", F.col("negative_id").cast(kind), "positive_score", "negative_score")
    )
