"""Similarity join of texts on the Jaccard similarity of their sets of five-word shingles.

Words are runs of characters other than space and ``\\x09-\\x0D``, as they stand. A text of one to four words has one shingle, all
its words; a text without words (or NULL) has none and links with nothing.

1. Every text gives a hash of its shingle set and MinHash bands. Texts with one set form a class, and classes are compared.
2. Classes that share a band meet in a bucket. Buckets with one class go; of buckets with the same classes one stays.
   A pair at similarity 0.8 misses all bands with probability 4e-7, a pair at 0.9 with 1e-13.
3. A bucket is cut into blocks of bounded size, and each pair of blocks is a unit of work. A group of near copies meets in many buckets that
   differ by a few members: its pairs are compared in the largest bucket of both, their main one, and not again elsewhere. In a unit, MinHash values are compared 16 at a time.
   With m of h values alike and a uniform prior, the chance that the similarity reaches the threshold is a binomial tail; a pair
   below the tolerance is dropped, the others are verified exactly on their shingles. A pair that meets in several buckets
   counts once, in its common main bucket or else in the least one.
4. Units return link counts and a spanning forest, not pairs. Star contractions make components of the forest.

``similar_texts`` returns one row per input row: id, text_hash, n_links (other rows linked directly, copies included)
and component_id (smallest id reachable). Rows with NULL id have no links and a NULL component. Rows that share an id are separate rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import mixed, slices, stored
from plantlake.llm.components import components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
STEP, TOLERANCE = 16, 1e-7
BLOCK = 192
#: Word hashes a worker remembers; a memory bound.
REMEMBERED = 500_000

_MULTIPLY = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADD = mixed(np.arange(1001, HASHES + 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACES = [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(WORDS)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_words = _WordHashes()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.array(list(map(_words.__getitem__, words)), dtype=np.uint64)
    size = min(WORDS, len(h))
    total = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for k in range(size):
        total += h[k : len(h) - size + 1 + k] * _PLACES[k]
    return np.unique(mixed(total + np.uint64(size)))


def minhash(sets: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    for start in range(0, len(sets), 4096):
        part = sets[start : start + 4096]
        values = (part[None, :] * _MULTIPLY[:, None] + _ADD[:, None]) >> np.uint64(32)
        np.minimum(out, values.min(axis=1).astype(np.uint32), out=out)
    return out


def set_hash(sets: np.ndarray) -> int:
    total = int(mixed(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) + len(sets)
    return int(np.array([total & (2**64 - 1)], dtype=np.uint64).view(np.int64)[0])


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        total = mixed(total + rows[:, k])
    return total.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For h compared values the smallest number of equal ones at which a pair stays."""
    least = {}
    for h in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(h + 1, m) * threshold**m * (1 - threshold) ** (h + 1 - m)
        least[h] = m
    return least


def surviving(a: np.ndarray, b: np.ndarray, mask: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (rows of a, rows of b) within ``mask`` that the incremental comparison leaves."""
    alike = np.zeros(mask.shape, dtype=np.int16)
    for k in range(STEP):
        alike += a[:, k, None] == b[None, :, k]
    i, j = np.nonzero(mask & (alike >= least[STEP]))
    count = alike[i, j].astype(np.int64)
    for start in range(STEP, HASHES, STEP):
        if not len(i):
            break
        for lo in range(0, len(i), 65536):
            s = slice(lo, lo + 65536)
            count[s] += (a[i[s], start : start + STEP] == b[j[s], start : start + STEP]).sum(axis=1)
        keep = count >= least[start + STEP]
        i, j, count = i[keep], j[keep], count[keep]
    return i, j


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[i] and b[j]."""
    if len(i) <= 3 * (len(a) + len(b)):
        return np.array([_common(a[x], b[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], dtype=np.int64)
    # Many pairs over few sets: a product of incidence matrices, some columns at a time.
    sizes = [len(s) for s in a] + [len(s) for s in b]
    _, column = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    often = np.bincount(column) > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(a), len(b)), dtype=np.float32)
    width = 4096
    for start in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(column, (start, start + width))
        x = np.zeros((len(sizes), width), dtype=np.float32)
        x[row[lo:hi], column[lo:hi] - start] = 1
        total += x[: len(a)] @ x[len(a) :].T
    return total[i, j].astype(np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def elsewhere(keys_a: list[np.ndarray], keys_b: list[np.ndarray], key: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a pair also meets in a bucket with a smaller key."""
    small_a, small_b = [set(k[k < key].tolist()) for k in keys_a], [set(k[k < key].tolist()) for k in keys_b]
    return np.array([not small_a[x].isdisjoint(small_b[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node that each of n nodes reaches over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Rows of one unit together; the rows come sorted by their first ``width`` columns."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = [np.asarray(batch.column(k)) for k in range(width)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for m in marks:
            change[1:] |= m[1:] != m[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            own = tuple(m[lo] for m in marks)
            if key is not None and own != key:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


FOUND = T.StructType([T.StructField("cls", T.LongType()), T.StructField("links", T.LongType()), T.StructField("root", T.LongType())])


def found_batch(cls: np.ndarray, weight: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch | None:
    """Link counts and roots of the rows that have links; i, j index ``cls``."""
    if not len(i):
        return None
    links = np.zeros(len(cls), dtype=np.int64)
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    root = cls[forest(len(cls), i, j)]
    has = links > 0
    return pa.RecordBatch.from_arrays([pa.array(x[has]) for x in (cls, links, root)], names=FOUND.names)


def _units(threshold: float):
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(batches, 3):
            key, lo, hi = (unit.column(k)[0].as_py() for k in range(3))
            block, cls, weight, main = (np.asarray(unit.column(c)) for c in ("block", "cls", "m", "main"))
            sets = [np.frombuffer(s, dtype=np.uint64) for s in unit.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            signs = np.frombuffer(b"".join(unit.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, HASHES)
            met = [np.array(k) for k in unit.column("met").to_pylist()]
            a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            small = np.minimum(sizes[a][:, None], sizes[b][None, :])
            mask = small >= threshold * np.maximum(sizes[a][:, None], sizes[b][None, :]) - 1e-9
            # Pairs with one main bucket count there, others in the least bucket that both are in.
            home = main[a][:, None] == main[b][None, :]
            mask &= ~home | (main[a] == key)[:, None]
            if lo == hi:
                mask &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
            i, j = surviving(signs[a], signs[b], mask, least)
            if not len(i):
                continue
            both = shared_counts([sets[x] for x in a], [sets[x] for x in b], i, j)
            i, j = a[i], b[j]
            keep = both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9
            i, j = i[keep], j[keep]
            keep = main[i] == main[j]
            apart = np.flatnonzero(~keep)
            if len(apart):
                keep[apart] = ~elsewhere(met, met, key, i[apart], j[apart])
            if (batch := found_batch(cls, weight, i[keep], j[keep])) is not None:
                yield batch

    return run


def with_blocks(members: DataFrame, block: int | None = None) -> DataFrame:
    """key, n, cls, main → one row per unit of work a class takes part in: key, lo, hi, block, cls.

    Classes with one main bucket are compared there alone. Where many of them meet again, in another bucket, they fill blocks of
    their own, which are compared with the bucket's other blocks, but not among themselves.
    """
    block = block or BLOCK
    away = members.filter("main <> key").groupBy("key", "main").agg(F.count("*").alias("size")).filter(F.col("size") >= block)
    away = away.withColumn("parts", F.ceil(F.col("size") / block).cast("int"))
    before = F.sum("parts").over(Window.partitionBy("key").orderBy("main")) - F.col("parts")
    away = stored(away.select("key", "main", "size", "parts", before.cast("int").alias("before")), "join-away")
    totals = away.groupBy("key").agg(F.sum("size").alias("gone"), F.sum("parts").cast("int").alias("pure"))
    cut = members.join(totals, "key", "left").join(away.drop("size"), ["key", "main"], "left")
    mixed = F.ceil((F.col("n") - F.coalesce("gone", F.lit(0))) / block).cast("int")
    cut = cut.withColumns({"mixed": mixed, "hash": F.xxhash64("cls", "key")})
    first = F.col("mixed") + F.col("before")
    own = F.when(F.col("parts").isNotNull(), first + F.pmod("hash", "parts")).otherwise(F.pmod("hash", F.greatest("mixed", F.lit(1))))
    every = F.sequence(F.lit(0), F.col("mixed") + F.coalesce("pure", F.lit(0)) - 1)
    others = F.when(F.col("parts").isNull(), every).otherwise(F.filter(every, lambda o: (o < first) | (o >= first + F.col("parts"))))
    cut = cut.select("key", "cls", own.cast("int").alias("block"), F.explode(others).alias("other"))
    return cut.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "cls")


def shared_buckets(exploded: DataFrame) -> DataFrame:
    """key, cls → key, n, cls for buckets of several classes, without buckets that repeat the classes of another."""
    buckets = (
        exploded.groupBy("key")
        .agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("y"))
        .filter("n > 1")
    )
    kept = stored(buckets.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"), "join-buckets")
    return stored(exploded.join(kept, "key"), "join-members")


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    id_field, hash_field = narrow.schema["id"], narrow.schema["text_hash"]
    signed_schema = T.StructType([id_field, hash_field, T.StructField("cls", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            cls, bands = [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text or "")
                cls.append(set_hash(found) if len(found) else None)
                bands.append(band_keys(minhash(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(cls, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=signed_schema.names,
            )

    signed = stored(narrow.mapInArrow(sign, signed_schema), "join-signed")
    classes = stored(
        signed.filter("id is not null and cls is not null")
        .groupBy("cls")
        .agg(F.count("*").alias("m"), F.min("id").alias("rep"), F.first("bands").alias("bands")),
        "join-classes",
    )
    members = shared_buckets(classes.select("cls", F.explode("bands").alias("key")))
    # At most one key per band; the largest bucket of a class is its main one.
    largest = F.min(F.struct((-F.col("n")).alias("n"), "key")).getField("key")
    met = members.groupBy("cls").agg(F.collect_set("key").alias("met"), largest.alias("main"))

    schema = T.StructType(
        [T.StructField("cls", T.LongType()), T.StructField("shingles", T.BinaryType()), T.StructField("signature", T.BinaryType())]
    )

    def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = [shingles(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_hash(s) for s in found], pa.int64()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                    pa.array([minhash(s).tobytes() for s in found], pa.binary()),
                ],
                names=schema.names,
            )

    wanted = classes.select("cls", "m", "rep").join(met, "cls")
    wanted = stored(wanted, "join-wanted")
    # One join form at every size: the wanted ids grow with the input, so they are not broadcast.
    ids = wanted.select(F.col("rep").alias("id")).distinct().hint("merge")
    texts = narrow.select("id", "text").join(ids, "id", "left_semi").select("text")
    contents = texts.mapInArrow(content, schema).dropDuplicates(["cls"])
    contents = stored(contents.join(wanted.drop("rep"), "cls"), "join-contents")
    placed = with_blocks(members.join(wanted.select("cls", "main"), "cls"))
    units = placed.join(contents, "cls").select("key", "lo", "hi", "block", "cls", "m", "main", "shingles", "signature", "met")
    units = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = stored(units.mapInArrow(_units(threshold), FOUND), "join-found")
    return joined_rows(signed.select("id", "text_hash", "cls"), classes.select("cls", "m", "rep"), found)


def joined_rows(rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``rows`` but cls, n_links and component_id. ``rows``: id, cls; ``classes``: cls, m, rep; ``found``: cls, links, root."""
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    known = classes.join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "cls")), "join-known")
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    result = stored(
        known.join(least, "root").select("cls", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"),
        "join-result",
    )
    joined = rows.withColumn("cls", F.when(F.col("id").isNotNull(), F.col("cls"))).join(result, "cls", "left")
    return joined.select(
        *[c for c in rows.columns if c != "cls"],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
