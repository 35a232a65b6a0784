import hashlib
import random

import numpy as np
import pytest

from plantlake.llm import repeats
from plantlake.llm.repeats import repeated_windows, suffix_order, without_repeats
from tests.llm.conftest import awkward


def brute(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    for r in order:
        data = (rows[r][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((rows[r][0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def letters(rng, n):
    return "".join(rng.choices("abcdefgh ", k=n))


def mosaic(rng, n=150):
    passages = [letters(rng, 400) for _ in range(5)]
    rows = []
    for i in range(n):
        text = letters(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, 300)
            text += rng.choice(passages)[at : at + rng.randint(20, 400)] + letters(rng, rng.randint(0, 5))
        rows.append((i, text, "s"))
    return rows


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 100, 1000])
@pytest.mark.parametrize("symbols", [1, 2, 5])
def test_suffix_order_equals_sorting(n, symbols):
    s = np.random.default_rng(n).integers(0, symbols, n)
    assert suffix_order(s, 10**9).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_order_by_long_prefixes_keeps_equal_windows_together():
    rng = random.Random(27)
    parts = [letters(rng, 130).encode() for _ in range(4)]
    slices = [rng.choice(parts)[rng.randint(0, 20) :] for _ in range(60)]
    data = np.frombuffer(b"".join(slices), dtype=np.uint8)
    size = np.array([len(s) for s in slices])
    got = repeated_windows(data, np.cumsum(size) - size, size - 99, np.arange(60))
    seen, want = set(), []
    for s in slices:
        for p in range(len(s) - 99):
            want.append(s[p : p + 100] in seen)
            seen.add(s[p : p + 100])
    assert got.tolist() == want


def test_mosaics_and_awkward_texts_equal_brute_force(texts):
    rng = random.Random(28)
    rows = mosaic(rng) + [(1000 + i, t, s) for i, (_, t, s) in enumerate(awkward(rng)) if t is None or len(t) < 20_000]
    rows += [(2001, "a" * 1000, "s"), (2002, "ab" * 300, "s"), (2003, "a" * 99, "s"), (2004, "a" * 100, "s"), (2005, "é" * 200, "s")]
    rows += [(2006, rows[5][1], "s"), (2007, rows[9][1], "s"), (2007, rows[9][1], "s"), (None, rows[9][1], "s"), (None, letters(rng, 200), "s")]
    got = sorted(map(tuple, without_repeats(texts(rows).repartition(4)).collect()), key=str)
    assert got == brute(rows)


def test_crowded_anchors_equal_brute_force(texts):
    rng = random.Random(29)
    passage = letters(rng, 180)
    rows = [(i, letters(rng, 120) + passage + letters(rng, 120), "s") for i in range(200)]
    expected = brute(rows)
    for crowd, total in ((20, 512), (10**6, 20), (10**6, 10**6)):
        got = without_repeats(texts(rows).repartition(3), crowd=crowd, crowd_all=total).collect()
        assert sorted(map(tuple, got), key=str) == expected


def test_empty_table(texts):
    assert without_repeats(texts([])).collect() == []


def test_few_texts_leave_partitions_without_flags(texts):
    rng = random.Random(30)
    rows = [(i, letters(rng, 300), "s") for i in range(3)] + [(3, "short", "s")]
    docs = texts(rows)
    before = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    docs.sparkSession.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        assert sorted(map(tuple, without_repeats(docs).collect()), key=str) == brute(rows)
        copies = texts([*rows, (4, rows[0][1], "s")])
        assert sorted(map(tuple, without_repeats(copies).collect()), key=str) == brute([*rows, (4, rows[0][1], "s")])
    finally:
        docs.sparkSession.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("partitions", [1, 2, 211])
def test_rows_that_agree_in_id_and_text_keep_one_of_them(texts, partitions):
    rng = random.Random(31)
    passage, crowd = letters(rng, 400), letters(rng, 180)
    rows = [(1, passage, "s"), (1, passage, "s"), (None, letters(rng, 300), "s"), (2, "x" + passage, "s")]
    rows += [rows[2], *[(10 + i, letters(rng, 60) + crowd + letters(rng, 60), "s") for i in range(6)]]
    rows += [rows[-1], rows[-2]]
    docs = texts(rows)
    before = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    docs.sparkSession.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for crowd_at in (2, 10**6):
            got = without_repeats(docs.repartition(min(partitions, 8)), crowd=crowd_at, crowd_all=crowd_at).collect()
            assert sorted(map(tuple, got), key=str) == brute(rows)
    finally:
        docs.sparkSession.conf.set("spark.sql.shuffle.partitions", before)


def test_packed_numbers_come_back_and_are_narrow():
    rng = np.random.default_rng(32)
    n = 5000
    whole = {k: rng.integers(0, 1 << 64, n, dtype=np.uint64) for k in ("hash", "text")}
    whole |= {"id": rng.integers(0, 1 << 20, n), "cls": rng.integers(-(1 << 63), (1 << 63) - 1, n), "start": rng.integers(0, 60_000, n), "count": rng.integers(1, 52, n)}
    whole["hash"] >>= np.uint64(24)
    odd = whole | {"id": np.where(np.arange(n) % 7 == 0, repeats.LAST_ID, -whole["id"]), "start": whole["start"] + (1 << 20)}
    keys = np.zeros(n, dtype=np.int64)
    packed = [b for c in (whole, odd) for b in repeats._pack(1, keys, c)]
    assert sum(len(v) for c in packed[0].columns[2:] for v in c.to_pylist() if v) <= 27 * n
    got = repeats._unpack(packed, repeats._NAMES)
    for name, values in whole.items():
        assert got[name].tolist() == [*values.tolist(), *odd[name].tolist()], name
    assert not got["kind"].any()
    several = next(repeats._pack(3, np.arange(n) % 3, whole, [b"x" * (i % 5) for i in range(n)]))
    assert several.num_rows == 3 and several.column("slices").to_pylist()[1] == b"".join(b"x" * (i % 5) for i in range(1, n, 3))


def test_a_task_tells_each_home_once():
    """Runs of many anchor destinations reach the homes of their texts in one row each, not one for each destination."""
    n, spread = 4000, 40
    rng = np.random.default_rng(33)
    c = {"hash": np.repeat(np.arange(n // 2, dtype=np.uint64), 2), "text": np.zeros(n, dtype=np.uint64), "id": np.arange(n), "cls": rng.integers(0, 1 << 62, n)}
    c |= {"start": np.zeros(n, dtype=np.int64), "count": np.ones(n, dtype=np.int64), "kind": np.zeros(n, dtype=np.int64)}
    rows = list(repeats._pack(1, (c["hash"] % np.uint64(spread)).astype(np.int64), c))
    told = list(repeats._judged_anchors(spread, 100)(iter(rows)))
    assert sum(b.num_rows for b in told) <= spread
    got = repeats._unpack(told, ["id", "kind"])
    assert sorted(got["id"].tolist()) == list(range(1, n, 2)) and not got["kind"].any()
