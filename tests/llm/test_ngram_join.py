import collections
import random

import numpy as np

from plantlake.llm import ngram_join
from plantlake.llm.ngram_join import least_matches, minhash, shingles, similar_texts
from tests.llm.conftest import awkward, prose


def brute(rows):
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links, root = collections.Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if both * 5 >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for a, (i, _, _) in enumerate(rows):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    return sorted(((i, links[a], low.get(find(a)) if i is not None else None) for a, (i, _, _) in enumerate(rows)), key=str)


def near(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "changed" + str(rng.random())
    return " ".join(words)


def collection(rng):
    rows = awkward(rng)
    for g in range(6):
        base = prose(rng, 120)
        rows += [(100 * (g + 1) + k, near(rng, base, rng.randint(0, 4)), "s") for k in range(rng.randint(1, 12))]
    shared = prose(rng, 60)
    rows += [(2000 + k, prose(rng, 40) + " " + shared + " " + prose(rng, 40), "s") for k in range(20)]
    base = prose(rng, 100)
    return rows + [(3000 + k, base, "s") for k in range(15)]


def test_links_and_components_equal_brute_force(texts):
    rows = collection(random.Random(7))
    got = similar_texts(texts(rows)).select("id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_a_large_group_is_cut_into_blocks(texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(8)
    base = prose(rng, 150)
    rows = [(k, near(rng, base, rng.randint(0, 5)), "s") for k in range(70)]
    got = similar_texts(texts(rows)).select("id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_large_groups_that_share_buckets_and_a_chain_between_them(texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    shipped = []
    cut = ngram_join.with_blocks

    def counted(members):
        shipped.append((members.count(), cut(members).count()))
        return cut(members)

    monkeypatch.setattr(ngram_join, "with_blocks", counted)
    rng = random.Random(10)
    words = prose(rng, 200).split()
    # Texts drift from one base to another, so that neighbours link, and ends don't.
    rows, other = [], prose(rng, 200).split()
    for k in range(60):
        mixed = other[: 2 * k] + words[2 * k :]
        rows.append((k, " ".join(mixed), "s"))
        rows.append((100 + k, near(rng, " ".join(mixed), 1), "s"))
    rows += [(500 + k, near(rng, " ".join(words), rng.randint(0, 3)), "s") for k in range(50)]
    got = similar_texts(texts(rows)).select("id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert shipped[0][1] > shipped[0][0]  # some buckets need several blocks


def test_a_bucket_inside_a_main_bucket_needs_no_work(llm):
    members = [(1, 100, c, 1) for c in range(100)] + [(2, 80, c, 1) for c in range(80)] + [(3, 53, c, 1 if c < 50 else 3) for c in [*range(50), 200, 201, 202]]
    units = ngram_join.with_blocks(llm.createDataFrame(members, "key long, n long, cls long, main long"), 20).collect()
    per = collections.Counter(u.key for u in units)
    assert per == {1: 100 * 5, 3: 50 + 3 * 4}  # the three others meet each other and the three blocks of the fifty
    met = collections.defaultdict(set)
    for u in units:
        met[u.key, u.lo, u.hi].add(u.cls)
    for a in range(50):
        for b in (200, 201, 202):
            assert any({a, b} <= who for (key, _, _), who in met.items() if key == 3)


def test_empty_table(texts):
    assert similar_texts(texts([])).collect() == []


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(9)
    least = least_matches()
    dropped = 0
    for _ in range(300):
        u = rng.integers(0, 2**63, size=500, dtype=np.uint64)
        a, b = np.unique(u[:450]), np.unique(np.concatenate((u[50:450], u[450:500])))  # similarity 0.8
        same = minhash(a) == minhash(b)
        dropped += any(same[:h].sum() < m for h, m in least.items())
    assert dropped == 0


def test_pruning_drops_unlike_pairs_early():
    assert least_matches()[16] >= 4
    a, b = shingles(prose(random.Random(1), 200)), shingles(prose(random.Random(2), 200))
    assert (minhash(a)[:16] == minhash(b)[:16]).sum() < least_matches()[16]
