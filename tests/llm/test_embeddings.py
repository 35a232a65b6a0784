import math

import numpy as np
import pytest

from plantlake.llm.embeddings import ProductCode, reach, similar_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, cls string"


def planted(size=16, groups=12, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(size)
        for k in range(rng.integers(1, 14)):
            v = centre + rng.standard_normal(size) * 0.12 * rng.random()
            rows.append((1000 * g + k, v.astype(np.float32).tolist(), int(g % 3), "x"))
        rows.append((1000 * g + 500, centre.astype(np.float32).tolist(), int(g % 3), "x"))
        rows.append((1000 * g + 501, centre.astype(np.float32).tolist(), int(g % 3), "x"))
    return rows


def brute(rows):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    label = np.array([r[2] for r in rows])
    n = np.linalg.norm(x, axis=1)
    linked = (x @ x.T / np.outer(n, n) >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(linked, low[None, :], ids.max() + 1).min(axis=1))
        if (new == low).all():
            return sorted(zip(ids.tolist(), linked.sum(axis=1).tolist(), low.tolist(), strict=True))
        low = new


@pytest.mark.parametrize("size", [2, 16, 64])
def test_links_and_components_equal_brute_force(llm, size):
    rows = planted(size)
    got = similar_vectors(llm.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_rows_that_cannot_link(llm):
    v = [1.0, 2.0]
    rows = [
        (1, None, 1, "x"), (2, [], 1, "x"), (3, [0.0, 0.0], 1, "x"), (4, [1.0, None], 1, "x"), (5, [float("nan"), 1.0], 1, "x"),
        (6, [float("inf"), 1.0], 1, "x"), (7, v, None, "x"), (None, v, 1, "x"), (8, v, 1, "x"), (9, v, 2, "x"), (10, [2.0, 4.0], 1, "x"),
        (8, v, 1, "x"), (11, [1.0, 2.0, 0.0], 1, "x"),
    ]
    got = sorted(map(tuple, similar_vectors(llm.createDataFrame(rows, SCHEMA)).collect()), key=str)
    alone = [(i, 0, i) for i in (1, 2, 3, 4, 5, 6, 7, 9, 11)] + [(None, 0, None)]
    assert got == sorted([*alone, (8, 2, 8), (8, 2, 8), (10, 2, 8)], key=str)


def test_empty_table(llm):
    assert similar_vectors(llm.createDataFrame([], SCHEMA)).collect() == []


def test_decoding_lists_exactly_the_filters_within_reach():
    code = ProductCode(10, words=5)
    x = np.random.default_rng(2).standard_normal((40, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    filters = np.array([np.concatenate((a, b)) for a in code.words[0] for b in code.words[1]])
    products = (x @ code.rotation) @ filters.T
    row, found = code.decode(x, 0.3)
    want = {(r, f) for r in range(40) for f in range(25) if products[r, f] >= products[r].max() - 0.3 + 1e-12}
    assert want <= set(zip(row.tolist(), found.tolist(), strict=True)) and len(row) <= len(want) + 2


def test_neighbours_share_a_cap_of_their_best_filter():
    rng = np.random.default_rng(3)
    size, code = 64, ProductCode(64, words=32)
    x = rng.standard_normal((2000, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.standard_normal((2000, size))
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * other

    def misses(a, b):
        """Pairs whose second vector doesn't look in the cap where the first is stored."""
        looked = [set() for _ in range(2000)]
        for r, f in zip(*code.decode(b, reach(0.98, size)), strict=True):
            looked[r].add(f)
        best = dict(zip(*code.decode(a, 0.0), strict=True))
        return {r for r in range(2000) if best[r] not in looked[r]}

    one, other_way = misses(x, y), misses(y, x)
    assert len(one) <= 2 and len(other_way) <= 2
    assert not one & other_way  # a pair is lost only if both directions fail


def test_crowded_caps_are_cut_into_blocks(llm, monkeypatch):
    monkeypatch.setattr("plantlake.llm.embeddings.BLOCK", 5)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    rows = [(k, (centre + rng.standard_normal(16) * 0.1 * rng.random()).astype(np.float32).tolist(), 1, "x") for k in range(90)]
    rows += [(200 + k, rows[k][1], 1, "x") for k in range(20)]
    assert sorted(map(tuple, similar_vectors(llm.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_labels_may_be_texts_and_other_columns_may_have_any_name(llm):
    rows = planted(16, groups=5)
    docs = llm.createDataFrame([(i, v, f"label {k}", 1, 2, "r") for i, v, k, _ in rows], "vec_id bigint, embedding array<float>, label string, id int, key int, raw string")
    assert sorted(map(tuple, similar_vectors(docs).collect())) == brute(rows)
