import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlake.llm import negatives as module
from plantlake.llm.negatives import Bucket, best, bucket_rows, hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, n bigint, bucket string, anchor int, rank int, length string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "b", 2, 3, "l") for r in rows], SCHEMA)


def brute(rows, every):
    usable = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], l)
        for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, (i, v, label) in enumerate(usable):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, m == label) for q, (j, w, m) in enumerate(usable) if q != k)
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fitting = [s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(i, positive, r, j, -p, -s) for r, (s, j, _) in enumerate(fitting, 1)]
    return sorted(out)


def clustered(rng, n, size, labels=4):
    centres = rng.standard_normal((6, size))
    rows = []
    for k in range(n):
        v = centres[rng.integers(6)] + rng.standard_normal(size) * rng.choice([0.05, 0.4, 1.0])
        rows.append((int(k), (v * rng.choice([0.1, 0.1, 1.0, 3.0]) / math.sqrt(size)).astype(np.float32).tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize(("size", "labels", "bucket"), [(16, 4, 40), (3, 2, 7), (64, 10, 512), (8, 1, 25)])
def test_negatives_equal_brute_force(llm, monkeypatch, size, labels, bucket):
    monkeypatch.setattr(module, "bucket_rows", lambda rows: bucket)
    rows = clustered(np.random.default_rng(size), 400, size, labels)
    got = hard_negatives(table_of(llm, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_awkward_rows(llm, monkeypatch):
    monkeypatch.setattr(module, "bucket_rows", lambda rows: 5)
    one = [0.5, 0.25, -0.125]
    rows = [
        (None, one, 1), (0, one, None), (1, None, 1), (2, [0.5, None], 1), (3, [float("nan")], 1), (4, [float("inf"), 1.0], 1),
        (10, one, 1), (10, one, 1), (20, one, 2), (11, [], 1), (12, [0.0, 0.0, 0.0], 2), (13, [0.5], 2), (30, [0.25, 0.25, 0.25, 4.0], 1),
        (14, [-0.5, -0.5, 0.5], 1), (40, [-0.5, -0.5, 0.5], 3), (15, [0.3, 0.2, 0.1], 2), (16, [0.3, 0.2, 0.1], 2), (50, [0.0, 0.0], 2),
    ]
    rows += [(100 + k, [0.3, 0.2, 0.1], k % 3) for k in range(40)]  # one vector, many times
    got = hard_negatives(table_of(llm, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_scores_beyond_doubles_are_exact(llm):
    rng = random.Random(3)
    rows = [(k, [float(np.float32(rng.uniform(1e5, 4e5))) for _ in range(4)], k % 3) for k in range(60)]
    got = hard_negatives(table_of(llm, rows), F.col("vec_id") % 10 == 0)
    assert max(r.positive_score for r in got.collect()) > 1 << 53
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_empty_table_and_no_anchor(llm):
    assert hard_negatives(table_of(llm, []), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives(table_of(llm, [(1, [1.0], 1), (2, [1.0], 2)]), F.col("vec_id") % 10 == 0).collect() == []


def test_labels_may_be_texts(llm):
    rows = clustered(np.random.default_rng(1), 60, 4, 3)
    got = hard_negatives(table_of(llm, rows), F.col("vec_id") % 10 == 0, label=F.concat(F.lit("label "), F.col("label").cast("string")))
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_ranges_of_coordinates_keep_every_row_that_can_reach_the_score_and_drop_others():
    rng = np.random.default_rng(2)
    # Rows of one length, as in a bucket, in groups that point the same way.
    rows = np.repeat(rng.standard_normal((25, 12)), 20, axis=0) + rng.standard_normal((500, 12)) * 0.1
    rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.int64)
    bucket = Bucket(np.arange(500), np.arange(500), np.zeros(500), rows)
    kept = 0
    for q in range(30):
        anchor = rows[q].astype(np.float64)
        scores = rows @ rows[q]
        for least in np.sort(scores)[[-2, -10, -20]].tolist():
            found = bucket.candidates(anchor, least)
            wanted = set(np.flatnonzero(scores >= least).tolist())
            assert found is None or wanted <= set(found.tolist())
            kept += 500 if found is None else len(found)
    assert kept < 0.2 * 30 * 3 * 500


def test_best_breaks_ties_by_id():
    rng = np.random.default_rng(4)
    for _ in range(50):
        score, ids = rng.integers(0, 6, 80), rng.permutation(80)
        want = sorted(range(80), key=lambda k: (-score[k], ids[k]))[:7]
        assert best(score, ids, 7).tolist() == want


def test_buckets_grow_with_the_root_of_the_table_within_bounds():
    assert bucket_rows(0) == 512 and bucket_rows(10**4) == 1600 and bucket_rows(10**12) == 1 << 16
