import collections
import random

import pytest

from plantlake.llm.mixing import mix, mixed_rows
from tests.llm.conftest import awkward, prose


def targets(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """Water filling, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    held, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in held]
        left = total - sum(held.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free} if free else {}
        over = [s for s in free if share[s] >= most * sizes[s]]
        if not over:
            return held | share
        held |= {s: most * sizes[s] for s in over}


def corpus(seed=13):
    rng = random.Random(seed)
    rows = []
    for k, (source, n) in enumerate([("a", 30), ("b", 400), ("c", 200), (None, 150), ("é", 90), ("z", 3)]):
        rows += [(1000 * k + i, prose(rng, rng.randint(1, 60)), source) for i in range(n)]
    return rows


def test_targets_and_taken_words(texts):
    rows = corpus()
    got = mix(texts(rows)).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = targets(sizes), collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"] and r["taken"] % r["size"] == 0
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 60


def test_reruns_agree_whatever_the_partitioning(texts):
    rows = corpus(14)
    a, b = (sorted(map(str, mix(texts(rows).repartition(n)).collect())) for n in (1, 7))
    assert a == b


def test_each_fraction_is_taken_with_its_probability(texts):
    rows = corpus(15)[:430]
    docs, taken = texts(rows), collections.Counter()
    for seed in range(6):
        for r in mix(docs, seed=seed).collect():
            taken[r["source"], seed] += r["taken"]
    assert len({taken["b", s] for s in range(6)}) > 1  # the draws differ, the totals stay near


def test_rows_are_repeated_as_often_as_taken(texts):
    rows = corpus(16)
    docs = texts(rows)
    plan = {r["id"]: r["taken"] // r["size"] for r in mix(docs).collect()}
    made = mixed_rows(docs)
    counts = collections.Counter(r["doc_id"] for r in made.collect())
    assert made.columns == docs.columns and counts == {i: n for i, n in plan.items() if n}


def test_awkward_rows(texts):
    rows = awkward(random.Random(17)) + [(9, "same words here", "s9")] * 9
    docs = texts(rows)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    repeated = [r["taken"] for r in got if r["id"] == 9]
    assert max(repeated) - min(repeated) <= 3
    assert mixed_rows(docs).count() == sum(r["taken"] // r["size"] for r in got if r["size"])


def test_empty_and_wordless_tables(texts):
    assert mix(texts([])).collect() == [] and mixed_rows(texts([])).collect() == []
    assert [r["taken"] for r in mix(texts([(1, None, "a"), (2, "", None)])).collect()] == [0, 0]
