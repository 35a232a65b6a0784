"""Removal of passages that repeat: each byte under a 100-byte string that also starts earlier goes.

Texts are UTF-8 bytes; a string is earlier in a smaller id (NULL last, ties by a hash of the text) or at an earlier start of the same
text. Strings are judged on the input. NULL texts count as empty; texts below 100 bytes stay whole. Rows that agree in
id and text follow each other: the first is judged, and the others, being copies, lose all their bytes (if they have 100).

1. *Anchors.* The anchor of a 100-byte window is the least hash, leftmost, of its 51 substrings of 50 bytes. Neighbouring windows with
   one anchor form a run of about 26 windows. Equal windows have equal anchors, so a run whose anchor occurs once needs no
   further work; of runs with one anchor and equal text the first stands for all, and the others are covered. Each task first
   combines its own runs, so that copies of a text leave it once.
2. *Suffix sorting.* What is left, runs whose anchor occurs with different texts, goes to the task of its anchor, about 125 bytes a
   run. There a suffix array is made by the difference-cover algorithm: sort the triples of the positions that are not
   divisible by three, name them, recurse on the names until they are unique or stand for 100 bytes, merge the other
   suffixes in, and compare neighbours. Of equal windows all but the first are covered.
   An anchor with very many texts would fill one task. Its windows go out one by one instead, by a hash of the
   window, after each task has combined equal ones.
3. Covered windows return to their texts.

Hashes, positions and slices travel packed, one row for each task and destination, and numbers without their leading zero bytes. Of an
anchor's hash 40 bits travel beside the destination that the whole hash gave; neighbouring covered runs travel as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import mixed, slices, stored
from plantlake.llm.ngram_join import grouped

LENGTH, GRAM = 100, 50
WINDOW = LENGTH - GRAM + 1
#: Texts of an anchor above which its windows travel one by one, in one task and over all tasks.
CROWD, CROWD_ALL = 64, 512
#: Runs that a task gathers before it combines them; bounds memory.
GATHERED = 600_000
#: Bytes of text for each destination. Destinations follow from the data alone, and a task takes one after the other.
DESTINATION = 1 << 20
LAST_ID = (1 << 63) - 1
#: Of an anchor's hash, what travels with its runs. Anchors that agree there and in their destination cost a comparison.
ANCHOR_BITS = 40

COVERED, ASK, ASK_CROWDED = 0, 1, 2
_POWERS = {k: np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in (1, 2, 4, 8, 16, 32)}
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_tables[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            _tables[k] = np.concatenate((np.ones(1, dtype=np.uint64), np.cumprod(np.full(size, base, dtype=np.uint64))))
    return _tables


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor hash, hash of the run's text, first window, number of windows."""
    x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums, step = {1: x}, 1
    while step < 32:
        h = sums[step]
        sums[step * 2] = h[:-step] * _POWERS[step] + h[step:]
        step *= 2
    n = len(x) - GRAM + 1
    grams = mixed((sums[32][:n] * _POWERS[16] + sums[16][32 : 32 + n]) * _POWERS[2] + sums[2][48 : 48 + n])
    least, place, span = grams, np.arange(n, dtype=np.int64), 1
    while span < WINDOW:
        shift = min(span, WINDOW - span)
        left = least[:-shift] <= least[shift:]
        least, place = np.where(left, least[:-shift], least[shift:]), np.where(left, place[:-shift], place[shift:])
        span += shift
    start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.append(start, len(place)))
    powers, inverses = _power_tables(len(x) + 1)
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(x * powers[: len(x)])))
    text = (prefix[start + count + LENGTH - 1] - prefix[start]) * inverses[start]
    return least[start], mixed(text * np.uint64(31) + count.astype(np.uint64)), start, count


# --- packed rows ------------------------------------------------------------------------

_NAMES = ["hash", "text", "id", "cls", "start", "count", "kind"]
_TYPES = [np.uint64, np.uint64, np.int64, np.int64, np.int32, np.int32, np.int8]
PACKED = T.StructType(
    [T.StructField("stage", T.IntegerType()), T.StructField("key", T.IntegerType()), *(T.StructField(n, T.BinaryType()) for n in _NAMES), T.StructField("slices", T.BinaryType())]
)


def _narrow(name: str, values: np.ndarray) -> np.ndarray:
    """Little-endian bytes of numbers, a row each, as wide as the greatest needs; texts and classes are hashes and stay whole."""
    wide = values.astype(np.int64, copy=False).astype("<u8") if values.dtype != np.uint64 else values
    width = 8 if name in ("text", "cls") else (int(wide.max()).bit_length() + 7) // 8
    return np.ascontiguousarray(wide).view(np.uint8).reshape(-1, 8)[:, :width]


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    """A binary column whose values end at ``ends`` (the first entry is 0)."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data)])


def _pack(stage: int, keys: np.ndarray, columns: dict[str, np.ndarray], pieces: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
    """One row for each key."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    first = np.concatenate(([0], np.flatnonzero(np.diff(keys[order])) + 1))
    ends = np.append(first, len(keys))
    row = [pa.array(np.full(len(first), stage, dtype=np.int32)), pa.array(keys[order[first]].astype(np.int32))]
    for name in _NAMES:
        if name in columns:
            data = _narrow(name, columns[name][order])
            row.append(_binary(data.tobytes(), ends * data.shape[1]))
        else:
            row.append(pa.nulls(len(first), pa.binary()))
    if pieces is None:
        row.append(pa.nulls(len(first), pa.binary()))
    else:
        sizes = np.concatenate(([0], np.cumsum([len(pieces[i]) for i in order.tolist()])))
        row.append(_binary(b"".join(pieces[i] for i in order.tolist()), sizes[ends]))
    yield pa.RecordBatch.from_arrays(row, names=PACKED.names)


def _unpack(rows: list[pa.RecordBatch], names: list[str]) -> dict[str, np.ndarray]:
    """Columns of packed rows; a row's classes tell how many numbers it has. What was not packed is 0."""

    def values(name: str) -> list[bytes]:
        return [b or b"" for r in rows for b in r.column(r.schema.get_field_index(name)).to_pylist()]

    numbers = np.array([len(b) // 8 for b in values("cls")], dtype=np.int64)
    out = {}
    for name, kind in zip(_NAMES, _TYPES, strict=True):
        if name not in names:
            continue
        packed = values(name)
        widths = np.array([len(b) for b in packed], dtype=np.int64) // np.maximum(numbers, 1)
        wide = np.zeros((int(numbers.sum()), 8), dtype=np.uint8)
        at = np.cumsum(numbers) - numbers
        # Rows of one width that follow each other are read at once.
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(widths)) + 1, [len(packed)])).tolist() if packed else [0]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            data = np.frombuffer(b"".join(packed[lo:hi]), dtype=np.uint8)
            if len(data):
                width, begin = int(widths[lo]), int(at[lo])
                wide[begin : begin + len(data) // width, :width] = data.reshape(-1, width)
        out[name] = wide.view("<u8").reshape(-1).astype(kind)
    return out


def _told(told: dict[str, np.ndarray], spread: int) -> Iterator[pa.RecordBatch]:
    """What is said about texts, on the way to their homes; only a question to be asked by its anchor needs the hash of that."""
    ask = told["kind"] == ASK
    for some, names in ((ask, ["hash", "id", "cls", "start", "count", "kind"]), (~ask, ["id", "cls", "start", "count", "kind"])):
        columns = {name: told[name][some] for name in names if name in told}
        yield from _pack(2, _home(columns["cls"], spread), columns)


def _gathered(told: Iterator[dict[str, np.ndarray] | list[pa.RecordBatch]], spread: int) -> Iterator[pa.RecordBatch]:
    """`_told` for many units at once, so that a task has one row for each home, not each unit; packed rows pass through."""
    waiting, held = [], 0
    for unit in told:
        if isinstance(unit, list):
            yield from unit
            continue
        waiting.append(unit)
        held += len(unit["cls"])
        if held >= GATHERED:
            yield from _told({k: np.concatenate([u[k] for u in waiting]) for k in unit}, spread)
            waiting, held = [], 0
    if waiting:
        yield from _told({k: np.concatenate([u[k] for u in waiting]) for k in waiting[0]}, spread)


def _joined(start: np.ndarray, count: np.ndarray, *text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs in order: which begin a stretch of runs that follow each other in one text, and the windows of each stretch."""
    if not len(start):
        return np.zeros(0, dtype=np.int64), count
    opens = np.ones(len(start), dtype=bool)
    opens[1:] = start[1:] != start[:-1] + count[:-1]
    for c in text:
        opens[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(opens)
    return first, np.add.reduceat(count, first)


def _home(cls: np.ndarray, spread: int) -> np.ndarray:
    """Where the rows of a text meet."""
    return (mixed(cls.view(np.uint64).copy()) % np.uint64(spread)).astype(np.int64)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Marks, in sorted columns, of the entries that differ from the one before them.

    Rows that agree in id and text have one address. What is said about it holds for the first of them, so that
    the others must not be told as its repeats.
    """
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return fresh


def _ordered(hashes: np.ndarray, *further: np.ndarray) -> np.ndarray:
    """The order by hash, then by the further columns, first one first; only hashes that repeat need those."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    repeated = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    rows = order[repeated]
    order[repeated] = rows[np.lexsort((*(c[rows] for c in reversed(further)), hashes[rows]))]
    return order


def _combined(gathered: list[tuple], spread: int, crowd: int) -> Iterator[pa.RecordBatch]:
    """The runs of a task: equal ones once, the rest covered; crowded anchors as a mark and as windows to be asked for."""
    if not gathered:
        return
    hashes, text, ids, cls, start, count = (np.concatenate(c) for c in zip(*gathered, strict=True))
    order = _ordered(hashes, text, ids, cls, start)
    order = order[_distinct(*(c[order] for c in (hashes, text, ids, cls, start)))]
    hashes, text, ids, cls, start, count = (c[order] for c in (hashes, text, ids, cls, start, count))
    new_hash = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    new_text = new_hash | np.concatenate(([True], text[1:] != text[:-1]))
    group = np.cumsum(new_hash) - 1
    crowded = (np.bincount(group, weights=new_text) > crowd)[group]
    kind = np.where(new_text, np.where(crowded, ASK_CROWDED, -1), COVERED)
    asked = np.flatnonzero(kind == ASK_CROWDED)
    yield from _told({k: c[asked] for k, c in (("id", ids), ("cls", cls), ("start", start), ("count", count), ("kind", kind), ("hash", hashes))}, spread)
    covered = np.flatnonzero(kind == COVERED)
    covered = covered[np.lexsort((start[covered], cls[covered], ids[covered]))]
    first, windows = _joined(start[covered], count[covered], ids[covered], cls[covered])
    begin = covered[first]
    yield from _pack(2, _home(cls[begin], spread), {"id": ids[begin], "cls": cls[begin], "start": start[begin], "count": windows})
    sent = (kind == -1) | (crowded & new_hash)
    mark = np.where(crowded, 1, 0)
    columns = {"hash": hashes[sent] >> np.uint64(64 - ANCHOR_BITS), "text": text[sent], "id": ids[sent], "cls": cls[sent], "start": start[sent], "count": count[sent], "kind": mark[sent]}
    yield from _pack(1, (hashes[sent] % np.uint64(spread)).astype(np.int64), columns)


def _anchor_rows(spread: int, crowd: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held = [], 0
        for batch in slices(batches, 2):
            for i, c, t in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                data = (t or "").encode()
                if len(data) < LENGTH:
                    continue
                hashes, text, start, count = anchors(data)
                gathered.append((hashes, text, np.full(len(start), i, dtype=np.int64), np.full(len(start), c, dtype=np.int64), start, count))
                held += len(start)
            if held >= GATHERED:
                yield from _combined(gathered, spread, crowd)
                gathered, held = [], 0
        yield from _combined(gathered, spread, crowd)

    return run


def _judged_anchors(spread: int, crowd_all: int):
    """Runs of one anchor: later equal ones are covered, others are asked about if the anchor has several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(units(batches), spread)

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray] | list[pa.RecordBatch]]:
        for unit in grouped(batches, 2):
            rows = unit.to_batches()
            # Rows of the second kind were told by the task that combined its runs.
            yield rows if unit.column("stage")[0].as_py() == 2 else judged(_unpack(rows, _NAMES))

    def judged(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        order = _ordered(*(c[k] for k in ("hash", "kind", "text", "id", "cls", "start")))
        c = {k: v[order] for k, v in c.items()}
        new_hash = np.concatenate(([True], c["hash"][1:] != c["hash"][:-1]))
        same_place = np.zeros(len(order), dtype=bool)
        for name in ("id", "cls", "start"):
            same_place[1:] |= c[name][1:] != c[name][:-1]
        repeat = ~new_hash & ~np.concatenate(([True], same_place[1:]))  # a row that agrees in id and text
        real = (c["kind"] == 0) & ~repeat
        new_text = real & (new_hash | np.concatenate(([True], (c["text"][1:] != c["text"][:-1]) | (c["kind"][1:] != c["kind"][:-1]))))
        group = np.cumsum(new_hash) - 1
        texts = np.bincount(group, weights=new_text)[group]
        crowded = (np.bincount(group, weights=c["kind"] == 1)[group] > 0) | (texts > crowd_all)
        kind = np.where(real & ~new_text, COVERED, np.where(real & crowded, ASK_CROWDED, np.where(real & (texts > 1), ASK, -1)))
        told = kind >= 0
        return {k: c[k][told] for k in ("hash", "id", "cls", "start", "count")} | {"kind": kind[told]}

    return run


# --- suffix arrays ----------------------------------------------------------------------


def suffix_order(s: np.ndarray, length: int, covers: int = 1) -> np.ndarray:
    """Suffixes of ``s`` (values from 0) in an order that is right up to ``length`` symbols of ``covers`` bytes at the first level."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    padded = np.concatenate((s.astype(np.int32) + np.int32(1), np.zeros(3, dtype=np.int32)))
    # Position n joins the sample if n % 3 == 1, so that every suffix of the first third ends before a separator of names.
    sample = np.concatenate((np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)))
    order = np.lexsort((padded[np.minimum(sample + 2, n + 2)], padded[sample + 1], padded[sample]))
    triple = np.stack([padded[sample], padded[sample + 1], padded[np.minimum(sample + 2, n + 2)]])[:, order]
    fresh = np.concatenate(([True], (triple[:, 1:] != triple[:, :-1]).any(axis=0)))
    names = np.empty(len(sample), dtype=np.int32)
    names[order] = np.cumsum(fresh)
    if not fresh.all() and covers * 3 < length:
        order = suffix_order(names, length, covers * 3)
        # Suffixes of the names that agree for the whole length keep different ranks, in any order.
    rank = np.zeros(n + 3, dtype=np.int32)
    rank[sample[order]] = np.arange(1, len(sample) + 1) if fresh.all() or covers * 3 < length else np.cumsum(fresh)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((rank[rest + 1], padded[rest]))]
    # Merge: where each of the rest belongs among the sampled, by bisection of all at once.
    low, high = np.zeros(len(rest), dtype=np.int64), np.full(len(rest), len(sampled), dtype=np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        a, b = rest[open_], sampled[middle]
        one = b % 3 == 1
        first = np.where(padded[a] != padded[b], padded[a] < padded[b], True)
        tied = padded[a] == padded[b]
        by_one = rank[a + 1] < rank[b + 1]
        second = padded[a + 1] != padded[b + 1]
        by_two = np.where(second, padded[a + 1] < padded[b + 1], rank[a + 2] < rank[b + 2])
        smaller = np.where(tied, np.where(one, by_one, by_two), first)
        high[open_] = np.where(smaller, middle, high[open_])
        low[open_] = np.where(smaller, low[open_], middle + 1)
    out = np.empty(n, dtype=np.int64)
    # Suffixes that agree for the whole length may bisect out of turn, among themselves only.
    turn = np.argsort(low, kind="stable")
    at = low[turn] + np.arange(len(rest))
    out[at] = rest[turn]
    free = np.ones(n, dtype=bool)
    free[at] = False
    out[free] = sampled
    return out


def repeated_windows(data: np.ndarray, begin: np.ndarray, count: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Marks of windows that are not the first of their equals.

    Slices of ``data`` start at ``begin`` and have ``count`` windows; ``earlier`` ranks the slices. Result: one mark per window, slice by slice.
    A window whose hash no other has needs no sorting, so the suffixes of what is left are sorted.
    """
    own = np.repeat(np.arange(len(begin)), count)
    within = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    place = begin[own] + within
    powers, inverses = _power_tables(len(data) + 1)
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)])))
    hashes = mixed((prefix[place + LENGTH] - prefix[place]) * inverses[place])
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    left = np.zeros(len(own), dtype=bool)
    left[order[1:][same]] = left[order[:-1][same]] = True
    marks = np.zeros(len(own), dtype=bool)
    if not left.any():
        return marks
    opens = left & np.concatenate(([True], ~left[:-1] | (own[1:] != own[:-1])))
    closes = left & np.concatenate((~left[1:] | (own[1:] != own[:-1]), [True]))
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    rank = np.empty(len(first), dtype=np.int64)
    rank[np.lexsort((within[first], earlier[own[first]]))] = np.arange(len(first))
    marks[left] = _later_windows(data, place[first], last - first + 1, rank)
    return marks


def _later_windows(data: np.ndarray, begin: np.ndarray, count: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """`repeated_windows` by the suffix array of all slices."""
    size = count + LENGTH - 1
    own = np.repeat(np.arange(len(begin)), size + 1)
    ends = np.cumsum(size + 1)
    within = np.arange(int(ends[-1])) - np.repeat(ends - size - 1, size + 1)
    text = np.zeros(int(ends[-1]), dtype=np.int32)  # a zero closes each slice
    inside = within < size[own]
    text[inside] = data[begin[own[inside]] + within[inside]].astype(np.int32) + 1
    window = within < count[own]
    order = suffix_order(text, LENGTH)
    order = order[window[order]]
    same = np.ones(len(order) - 1, dtype=bool)
    live = np.arange(len(order) - 1)
    for k in range(LENGTH):
        live = live[text[order[live] + k] == text[order[live + 1] + k]]
        if not len(live):
            break
    same[:] = False
    same[live] = True
    group = np.cumsum(np.concatenate(([True], ~same))) - 1
    by = np.lexsort((within[order], earlier[own[order]], group))
    first = np.concatenate(([True], group[by][1:] != group[by][:-1]))
    marks = np.zeros(len(text), dtype=bool)
    marks[order[by[~first]]] = True
    return marks[window]


def _sorted_units(spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered((compared(unit.to_batches()) for unit in grouped(batches, 2)), spread)

    def compared(rows: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        c = _unpack(rows, ["id", "cls", "start", "count"])
        data = np.frombuffer(b"".join(b for r in rows for b in r.column(r.schema.get_field_index("slices")).to_pylist()), dtype=np.uint8)
        count = c["count"].astype(np.int64)
        size = count + LENGTH - 1
        begin = np.cumsum(size) - size
        order = np.lexsort((count, c["start"], c["cls"], c["id"]))
        fresh = _distinct(*(x[order] for x in (c["id"], c["cls"], c["start"], count)))
        kept = np.sort(order[fresh])
        earlier = np.empty(len(order), dtype=np.int64)
        earlier[order] = np.arange(len(order))
        c, begin, count, earlier = {k: v[kept] for k, v in c.items()}, begin[kept], count[kept], earlier[kept]
        marks = repeated_windows(data, begin, count, earlier)
        # Runs of marked windows.
        slice_of = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(marks)) - np.repeat(np.cumsum(count) - count, count)
        opens = marks & np.concatenate(([True], ~marks[:-1] | (slice_of[1:] != slice_of[:-1])))
        closes = marks & np.concatenate((~marks[1:] | (slice_of[1:] != slice_of[:-1]), [True]))
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        of = slice_of[first]
        return {"id": c["id"][of], "cls": c["cls"][of], "start": c["start"][of] + within[first], "count": last - first + 1, "kind": np.zeros(len(of), dtype=np.int8)}

    return run


# --- texts ------------------------------------------------------------------------------

_RESULT = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
TEXTS = T.StructType(
    [*PACKED.fields, T.StructField("doc", T.LongType()), T.StructField("text_cls", T.LongType()), T.StructField("body", T.StringType()), *(T.StructField(n, t) for n, t in _RESULT)]
)


def removed(data: bytes, start: np.ndarray, count: np.ndarray) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans and hash of what stays, for covered runs of windows."""
    if not len(start):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest()
    change = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + count + LENGTH - 1, -1)
    gone = np.cumsum(change)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
    return len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


class _Flags:
    """Runs told about the texts of a partition, by (id, class)."""

    def __init__(self, rows: list[pa.RecordBatch]):
        self.c = _unpack(rows, ["hash", "id", "cls", "start", "count", "kind"])
        order = np.lexsort((self.c["start"], self.c["cls"], self.c["id"]))
        self.c = {k: v[order] for k, v in self.c.items()}
        change = np.ones(len(order), dtype=bool)
        if len(order):
            change[1:] = (self.c["id"][1:] != self.c["id"][:-1]) | (self.c["cls"][1:] != self.c["cls"][:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(order))[: len(first)]
        self.at = {(i, c): (a, b) for i, c, a, b in zip(self.c["id"][first].tolist(), self.c["cls"][first].tolist(), first.tolist(), last.tolist(), strict=True)}

    def of(self, i: int, cls: int) -> dict[str, np.ndarray]:
        a, b = self.at.get((i, cls), (0, 0))
        return {k: v[a:b] for k, v in self.c.items()}


def _texts_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_TEXTS_ARROW)


_TEXTS_ARROW = pa.schema(
    [("stage", pa.int32()), ("key", pa.int32()), *((n, pa.binary()) for n in _NAMES), ("slices", pa.binary())]
    + [("doc", pa.int64()), ("text_cls", pa.int64()), ("body", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _widened(batch: pa.RecordBatch) -> pa.RecordBatch:
    extra = _TEXTS_ARROW.names[len(batch.schema.names) :]
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.nulls(batch.num_rows, _TEXTS_ARROW.field(n).type) for n in extra)], names=_TEXTS_ARROW.names)


def _split(batches: Iterator[pa.RecordBatch]) -> tuple[_Flags, Iterator[pa.RecordBatch]]:
    """Flags come first in a partition, then texts."""
    flags, rest, iterator = [], [], iter(batches)
    for batch in iterator:
        told = np.asarray(batch.column(0)) == 0
        k = int(told.sum())
        if k:
            flags.append(batch.slice(0, k))
        if k < batch.num_rows:
            rest.append(batch.slice(k))
            break

    def texts():
        yield from rest
        yield from iterator

    return _Flags(flags), texts()


def _asking(spread: int):
    """Results of texts without open questions; for the others the text, what is covered, and slices to compare."""

    def send(asked: list[tuple], pieces: list[bytes]) -> Iterator[pa.RecordBatch]:
        if asked:
            hashes, ids, cls, start, count = (np.array(v, dtype=t) for v, t in zip(zip(*asked, strict=True), (np.uint64, np.int64, np.int64, np.int64, np.int64), strict=True))
            columns = {"id": ids, "cls": cls, "start": start, "count": count}
            for packed in _pack(3, (mixed(hashes) % np.uint64(spread)).astype(np.int64), columns, pieces):
                yield _widened(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, texts = _split(batches)
        asked, pieces, size = [], [], 0
        windows: dict[bytes, tuple] = {}  # of crowded anchors, the first of equal ones in this task
        late: list[tuple] = []
        at = len(PACKED.names)
        for batch in slices(texts, at + 2):
            out = []
            for i, cls, text in zip(*(batch.column(k).to_pylist() for k in (at, at + 1, at + 2)), strict=True):
                data = text.encode()
                told = flags.of(i, cls)
                covered = told["kind"] == COVERED
                questions = np.flatnonzero(~covered)
                if not len(questions):
                    found = removed(data, told["start"][covered], told["count"][covered])
                    out.append({"stage": 9, "doc": i, "text_cls": cls} | dict(zip((n for n, _ in _RESULT), found, strict=True)))
                    continue
                first, windows_of = _joined(told["start"][covered], told["count"][covered])
                out.append(
                    {"stage": 4, "key": int(_home(np.array([cls]), spread)[0]), "doc": i, "text_cls": cls, "body": text}
                    | {"start": told["start"][covered][first].tobytes(), "count": windows_of.astype(np.int32).tobytes()}
                )
                for q in questions.tolist():
                    h, s, n = int(told["hash"][q]), int(told["start"][q]), int(told["count"][q])
                    if told["kind"][q] == ASK:
                        asked.append((h, i, cls, s, n))
                        pieces.append(data[s : s + n + LENGTH - 1])
                        size += n + LENGTH
                        continue
                    for p in range(s, s + n):
                        window = data[p : p + LENGTH]
                        here, seen = (i, cls, p), windows.get(window)
                        if seen is None or here < seen:
                            windows[window] = here
                        if seen is not None and seen != here:
                            late.append(max(here, seen))
            yield _texts_batch(out)
            if len(windows) > 100_000 or size > 16 << 20:
                yield from self_send(windows, late, asked, pieces)
                asked, pieces, size, windows, late = [], [], 0, {}, []
        yield from self_send(windows, late, asked, pieces)

    def self_send(windows, late, asked, pieces) -> Iterator[pa.RecordBatch]:
        crowd = [(int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little"), *where, 1) for w, where in windows.items()]
        yield from send([*asked, *crowd], [*pieces, *windows])
        if late:
            ids, cls, start = (np.array(v, dtype=np.int64) for v in zip(*late, strict=True))
            columns = {"id": ids, "cls": cls, "start": start, "count": np.ones(len(ids), dtype=np.int64), "kind": np.zeros(len(ids), dtype=np.int8)}
            for packed in _pack(2, _home(cls, spread), columns):
                yield _widened(packed)

    return run


_FINAL = T.StructType([T.StructField("doc", T.LongType()), T.StructField("text_cls", T.LongType()), *(T.StructField(n, t) for n, t in _RESULT)])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags, texts = _split(batches)
    names = TEXTS.names
    for batch in slices(texts, names.index("body")):
        rows = []
        for row in batch.select(["doc", "text_cls", "body", "start", "count"]).to_pylist():
            told = flags.of(row["doc"], row["text_cls"])
            start = np.concatenate((np.frombuffer(row["start"], dtype=np.int32), told["start"]))
            count = np.concatenate((np.frombuffer(row["count"], dtype=np.int32), told["count"]))
            rows.append((row["doc"], row["text_cls"], *removed(row["body"].encode(), start, count)))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 5, pa.string()], strict=True)], names=_FINAL.names)


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, crowd_all: int = CROWD_ALL
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256: one row per input row. ``id_col`` holds integers."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    spread = -(-size // DESTINATION) or 1
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("text_cls"), text.alias("body"))
    first = rows.mapInArrow(_anchor_rows(spread, crowd), PACKED)

    def by_key(rows: DataFrame) -> DataFrame:
        return rows.select(*PACKED.names).repartition(partitions, "key").sortWithinPartitions("stage", "key")

    # The anchors go straight through their shuffle; only what they say about texts is written.
    flags = stored(by_key(first).mapInArrow(_judged_anchors(spread, crowd_all), PACKED), "repeats-flags")

    def meeting(told: DataFrame, texts: DataFrame) -> DataFrame:
        """Flags and texts of one home in one partition, flags first."""
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in TEXTS.fields[len(PACKED.fields) :]]
        both = told.select(F.lit(0).alias("turn"), *PACKED.names, *empty).unionByName(texts.select(F.lit(1).alias("turn"), *TEXTS.names))
        return both.repartition(partitions, "key").sortWithinPartitions("turn").select(F.col("turn").alias("stage"), *TEXTS.names[1:])

    packed_nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in PACKED.fields[2:]]
    result_nulls = [F.lit(None).cast(t).alias(n) for n, t in _RESULT]
    homes = rows.mapInArrow(_with_home(spread), "key int, doc long, text_cls long, body string")
    texts = homes.select(F.lit(4).alias("stage"), "key", *packed_nulls, "doc", "text_cls", "body", *result_nulls)
    asked = stored(meeting(flags, texts).mapInArrow(_asking(spread), TEXTS), "repeats-asked")
    units = by_key(asked.filter("stage = 3")).mapInArrow(_sorted_units(spread), PACKED)
    answers = units.unionByName(asked.filter("stage = 2").select(*PACKED.names))
    late = meeting(answers, asked.filter("stage = 4")).mapInArrow(_finished, _FINAL)
    results = asked.filter("stage = 9").select(*_FINAL.names).unionByName(late)
    # Rows that agree in id and text have one result each; all but one are copies.
    counted = results.groupBy(*_FINAL.names).agg(F.count("*").alias("m"))
    copies = counted.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= LENGTH)
    return copies.select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias(id_col),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def _with_home(spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _home(np.asarray(batch.column(1)), spread)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), *batch.columns], names=["key", "doc", "text_cls", "body"])

    return run
