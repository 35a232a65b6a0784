"""Near duplicates among vectors of one label, found with spherical-cap filters.

A filter is a direction, and a vector belongs to its cap if their inner product is high. The directions form a random
product code: the space is turned by a random rotation and cut into blocks, each block has its own few random unit
codewords, and a filter is one codeword per block. The inner product of a vector with a filter is the sum of the
blocks' products, so the filters above a bound are list-decoded block by block: sort a block's products, extend only prefixes that can
still reach the bound.

Vectors join on (label, filter): each is stored under its best filter alone and looks in all filters whose product is within
``reach`` of its best. Who is stored in a cap meets who looks there; a pair is compared exactly, by cosine in double
precision. The stored and the looking side of a cap are cut into blocks of bounded size, and each pair of blocks is a unit of
work. Equal vectors of one label are one class. A pair that meets in two caps counts in the one with the smaller key.

Completeness: for unit vectors at cosine c the loss of one at the other's best filter is at most the sum of two products
of their difference, of length sqrt(2 - 2c), with filters. That is 2 * sqrt(2 - 2c) in the worst case; over the random rotation it
spreads like sqrt(2 - 2c) * sqrt(2 / size). ``reach`` is ``SPREADS`` = 3.5 times that, or the worst case where it is less, and both
directions must fail for a miss: of 480,000 random pairs at the threshold the worst needed 2.0 spreads, 99.9 % needed 1.4.

NULL, zero, ragged or non-finite vectors, and rows with a NULL label or id, link with nothing; rows are never dropped.
Rows that share an id are separate rows. Labels may be of any type; other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import mixed, stored
from plantlake.llm.ngram_join import FOUND, found_batch, grouped, joined_rows

THRESHOLD = 0.98
BLOCKS, SEED, SPREADS = 2, 3, 3.5
#: Vectors, all labels together, for each filter.
CAP = 1024
BLOCK = 512


class ProductCode:
    """Filters: one of ``words`` codewords in each of ``blocks`` blocks of a rotated space."""

    def __init__(self, size: int, words: int, blocks: int = BLOCKS, seed: int = SEED):
        draw = np.random.default_rng(seed + size)
        self.rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
        blocks = max(1, min(blocks, size))
        self.cuts = [size * k // blocks for k in range(blocks + 1)]
        self.words = []
        for lo, hi in zip(self.cuts, self.cuts[1:], strict=False):
            code = draw.standard_normal((words, hi - lo))
            self.words.append(code / np.linalg.norm(code, axis=1, keepdims=True) / math.sqrt(blocks))

    def decode(self, unit: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """For unit vectors: (row, filter) of all filters within ``reach`` of the row's best product."""
        turned = unit @ self.rotation
        products = [turned[:, lo:hi] @ code.T for lo, hi, code in zip(self.cuts, self.cuts[1:], self.words, strict=False)]
        # What a row loses against its best filter; the losses of the blocks add up.
        losses = [p.max(axis=1, keepdims=True) - p for p in products]
        row, code, lost = np.arange(len(unit)), np.zeros(len(unit), dtype=np.int64), np.zeros(len(unit))
        for loss in losses:
            total = lost[:, None] + loss[row]
            at, word = np.nonzero(total <= reach)
            row, code, lost = row[at], code[at] * loss.shape[1] + word, total[at, word]
        return row, code


def reach(threshold: float, size: int) -> float:
    apart = math.sqrt(max(0.0, 2 - 2 * threshold))
    return min(2.0, SPREADS * math.sqrt(2 / size)) * apart + 1e-9


def _keys(label: np.ndarray, size: int, code: np.ndarray) -> np.ndarray:
    key = mixed(label.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size))
    return mixed(key + code.astype(np.uint64)).view(np.int64)


_CODES: dict[tuple[int, int], ProductCode] = {}


def _code(size: int, words: int) -> ProductCode:
    if (size, words) not in _CODES:
        _CODES[size, words] = ProductCode(size, words=words)
    return _CODES[size, words]


def codewords(vectors: int) -> int:
    """Codewords a block, so that a filter is the best one of about ``CAP`` vectors; more vectors get a finer code."""
    return max(4, math.ceil((vectors / CAP) ** (1 / BLOCKS)))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, label, vector → id, label, class and the vector's doubles; NULL classes for rows that link with nothing."""
    for batch in batches:
        cls, raw = [], []
        for i, label, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            usable = i is not None and label is not None and vector and None not in vector
            values = np.array(vector, dtype=np.float64) + 0.0 if usable else np.zeros(0)
            if len(values) and np.isfinite(values).all() and values.any() and np.isfinite(values @ values) and values @ values > 0:
                raw.append(values.tobytes())
                digest = hashlib.blake2b(str(label).encode() + b"|" + raw[-1], digest_size=8).digest()
                cls.append(int.from_bytes(digest, "little", signed=True))
            else:
                raw.append(None)
                cls.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(cls, pa.int64()), pa.array(raw, pa.binary())], names=["id", "label", "cls", "raw"]
        )


_CAPS = T.StructType(
    [T.StructField("cls", T.LongType()), T.StructField("best", T.LongType()), T.StructField("met", T.ArrayType(T.LongType()))]
)


def _caps(threshold: float, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                label, raw = np.asarray(batch.column(1)), batch.column(2).to_pylist()
                best, met = np.zeros(len(raw), dtype=np.int64), [None] * len(raw)
                for size in {len(r) for r in raw}:
                    rows = np.array([k for k, r in enumerate(raw) if len(r) == size])
                    x = np.frombuffer(b"".join(raw[k] for k in rows)).reshape(len(rows), -1)
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    code = _code(x.shape[1], words)
                    row, filters = code.decode(unit, reach(threshold, x.shape[1]))
                    keys, order = _keys(label[rows[row]], size, filters), np.argsort(row, kind="stable")
                    for k, own in zip(rows.tolist(), np.split(keys[order], np.cumsum(np.bincount(row, minlength=len(rows)))[:-1]), strict=True):
                        met[k] = own
                    row, filters = code.decode(unit, 0.0)
                    best[rows[row]] = _keys(label[rows[row]], size, filters)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(best), pa.array(met, pa.list_(pa.int64()))], names=_CAPS.names
                )

    return run


def _units(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(batches, 3):
            key = unit.column("key")[0].as_py()
            stored_side, cls, weight, best = (np.asarray(unit.column(c)) for c in ("stored", "cls", "m", "best"))
            x = np.frombuffer(b"".join(unit.column("raw").to_pylist())).reshape(len(cls), -1)
            norm = np.linalg.norm(x, axis=1)
            a, b = np.flatnonzero(stored_side), np.flatnonzero(~stored_side)
            mask = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= threshold
            # Two vectors stored here see each other twice.
            mask &= np.where((best[b] == key)[None, :], cls[a][:, None] < cls[b][None, :], True)
            i, j = np.nonzero(mask)
            if not len(i):
                continue
            i, j = a[i], b[j]
            # Another cap shows the pair if it is the best of the looking side and the stored side looks there.
            lists = unit.column("met").combine_chunks()
            looks = {k: set(lists[k].as_py()) for k in np.unique(i[best[j] < key]).tolist()}
            keep = np.array([not (best[v] < key and best[v] in looks[u]) for u, v in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)
            if (batch := found_batch(cls, weight, i[keep], j[keep])) is not None:
                yield batch

    return run


def _sides(members: DataFrame) -> DataFrame:
    """key, n, n_here, here, cls → one row per unit of work a class takes part in, as stored or looking side."""
    stored_parts = F.ceil(F.col("n_here") / BLOCK).cast("int")
    looking_parts = F.ceil(F.col("n") / BLOCK).cast("int")
    own = [F.pmod(F.xxhash64(F.lit(k), "cls", "key"), parts).cast("int") for k, parts in ((1, stored_parts), (2, looking_parts))]
    all_of = [F.explode(F.sequence(F.lit(0), parts - 1)) for parts in (stored_parts, looking_parts)]
    looking = members.select("key", all_of[0].alias("s"), own[1].alias("l"), F.lit(False).alias("stored"), "cls")
    at_home = members.filter("here").select("key", own[0].alias("s"), all_of[1].alias("l"), F.lit(True).alias("stored"), "cls")
    return looking.unionByName(at_home)


def similar_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """id, n_links (other rows linked directly) and component_id (smallest id reachable, itself included)."""
    label = F.col(label_col)
    if not isinstance(vectors.schema[label_col].dataType, T.IntegralType):  # other labels are told apart by 64 bits
        label = F.when(label.isNotNull(), F.xxhash64(label))
    narrow = vectors.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).alias("vector"))
    schema = T.StructType(
        [narrow.schema["id"], narrow.schema["label"], T.StructField("cls", T.LongType()), T.StructField("raw", T.BinaryType())]
    )
    rows = stored(narrow.mapInArrow(_classes, schema), "caps-rows")
    classes = stored(
        rows.filter("cls is not null")
        .groupBy("cls")
        .agg(F.count("*").alias("m"), F.min("id").alias("rep"), F.first("label").alias("label"), F.first("raw").alias("raw")),
        "caps-classes",
    )
    caps = stored(classes.select("cls", "label", "raw").mapInArrow(_caps(threshold, codewords(classes.count())), _CAPS), "caps-filters")
    looks = caps.select("cls", F.explode("met").alias("key"), "best").withColumn("here", F.col("best") == F.col("key")).drop("best")
    used = looks.groupBy("key").agg(F.count("*").alias("n"), F.count_if("here").alias("n_here")).filter("n > 1 and n_here > 0")
    members = stored(looks.join(used, "key"), "caps-members")
    contents = stored(classes.select("cls", "m", "raw").join(caps, "cls"), "caps-contents")
    units = _sides(members).join(contents, "cls").select(
        "key", "s", "l", "stored", "cls", "m", "best", "raw", F.when(F.col("stored"), F.col("met")).alias("met")
    )
    units = units.repartition("key", "s", "l").sortWithinPartitions("key", "s", "l")
    found = stored(units.mapInArrow(_units(threshold), FOUND), "caps-found")
    return joined_rows(rows.select("id", "cls"), classes.select("cls", "m", "rep"), found)
