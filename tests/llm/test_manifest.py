import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlake.llm.manifest import Subtree, address, fold, leaf_digest, pack_path, unpack_path, verified_rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp int, node string, pos string, root int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def raised(nodes):
    """Levels of a tree, leaves first."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, at):
    return [(at >> k, [n for j, n in enumerate(level) if j != at >> k and j >> 1 == at >> k >> 1]) for k, level in enumerate(levels[:-1])]


def brute(rows, tampered):
    """doc_id, leaf, subroot, root, proof, folded root, verified of each row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for n in names:
        groups[n].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[n] = raised([leaf(r) for r in groups[n]])
    top = raised([trees[n][-1][0] for n in names])
    out = []
    for g, n in enumerate(names):
        for k, r in enumerate(groups[n]):
            path = siblings(trees[n], k) + siblings(top, g)
            d = leaf(tampered(r))
            for at, others in path:
                d = digest(*(others + [d] if at & 1 else [d] + others))
            proof = digest(*(o for _, others in path for o in others))
            out.append((r[0], leaf(r), trees[n][-1][0], top[-1][0], proof, d, d == top[-1][0]))
    return sorted(out, key=str)


def rows_of(rng, n, langs):
    return [(k * 3, rng.choice(["a", None, "ü"]), rng.choice(langs), rng.choice([None, k]), "x" * rng.randint(0, 5) + "é漢") for k in range(n)]


AWKWARD = [
    (None, "s", "en", 1, "no id"),
    (None, "s", "en", 1, "no id"),
    (None, None, None, None, None),
    (5000, "s", "en", 4, ""),
    (5000, "s", "en", 4, ""),
    (5000, "s", "en", 5, "other"),
    (5001, "s", None, 6, "y" * 300_000),
    (5002, "", "", 0, "-"),
]


@pytest.mark.parametrize(("height", "n", "langs"), [(1, 41, ["en", "de", None]), (2, 70, ["en"]), (3, 90, [f"l{k:02d}" for k in range(23)]), (12, 30, ["en", "Z", "é"])])
def test_proofs_equal_brute_force(llm, height, n, langs):
    rng = random.Random(n)
    rows = rows_of(rng, n, langs) + AWKWARD

    def changed(r):
        return (*r[:3], r[3] + 1, r[4]) if r[0] is not None and r[0] % 2 and r[3] is not None else r

    docs = llm.createDataFrame([(*r, 1, "n", "p", 2) for r in rows], SCHEMA).repartition(3)
    present = leaf_digest([F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in COLUMNS])
    got = verified_rows(docs, COLUMNS, "doc_id", "lang", F.when(F.col("doc_id") % 2 == 1, present), height=height)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, changed)


@pytest.mark.parametrize("rows", [[(1, "s", "en", 1, "only")], [(1, "s", "en", 1, "a"), (2, "s", None, 1, "b")]])
def test_small_tables(llm, rows):
    got = verified_rows(llm.createDataFrame([(*r, 1, "n", "p", 2) for r in rows], SCHEMA), COLUMNS, "doc_id", "lang").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, lambda r: r)


def test_empty_table(llm):
    assert verified_rows(llm.createDataFrame([], SCHEMA), COLUMNS, "doc_id", "lang").collect() == []


@pytest.mark.parametrize("levels", range(1, 12))
def test_addresses_are_a_van_emde_boas_order(levels):
    by_depth = [address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(by_depth).tolist()) == list(range((1 << levels) - 1))
    top = levels // 2
    # The upper half of the levels comes first, then each subtree below it in one piece.
    assert all((p < (1 << top) - 1).all() for p in by_depth[:top])
    if levels > 1:
        size = (1 << levels - top) - 1
        for d in range(top, levels):
            below = (by_depth[d] - ((1 << top) - 1)) // size
            assert (below == np.arange(1 << d) >> d - top).all()


@pytest.mark.parametrize(("count", "steps"), [(1, 0), (1, 3), (2, 1), (5, 3), (5, 7), (8, 3)])
def test_subtrees_survive_packing_and_every_leaf_folds_to_the_root(count, steps):
    leaves = [digest(str(k)) for k in range(count)]
    tree = Subtree(count, steps).build(leaves)
    again = Subtree(count, steps).unpack(tree.packed())
    assert again.root == tree.root
    for k, d in enumerate(leaves):
        assert unpack_path(pack_path(again.path(k))) == again.path(k)
        assert fold(d, again.path(k)) == tree.root
        assert fold(digest("other"), again.path(k)) != tree.root or tree.root == digest("other")
