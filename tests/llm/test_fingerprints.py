import hashlib
import random

import numpy as np

from plantlake.llm.fingerprints import boundary_levels, compare_with_edits, edit_distances, edited_text, fingerprint_bytes, fingerprints, likeness
from tests.llm.conftest import awkward, prose


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances_equal_the_textbook_form():
    rng = random.Random(2)
    pairs = [[bytes(rng.choices(b"abcd", k=rng.randint(0, 64))) for _ in range(200)] for _ in range(2)]
    assert edit_distances(*pairs).tolist() == [levenshtein(a, b) for a, b in zip(*pairs, strict=True)]


def test_boundaries_do_not_depend_on_where_a_long_text_is_cut(monkeypatch):
    data = prose(random.Random(3), 2000).encode()
    whole = boundary_levels(data)
    monkeypatch.setattr("plantlake.llm.fingerprints.PIECE", 1000)
    assert np.array_equal(whole, boundary_levels(data))


def test_boundaries_follow_the_content():
    a, b = prose(random.Random(4), 500).encode(), b"an inserted beginning "
    assert np.array_equal(boundary_levels(a)[8:], boundary_levels(b + a)[len(b) + 8 :])


def test_likeness_of_equal_edited_and_foreign_texts():
    rng = random.Random(5)
    a, b = prose(rng, 800), prose(rng, 800)
    fa, fb, fe = (fingerprint_bytes(t.encode()) for t in (a, b, edited_text(a, b)))
    same, half, other = likeness([(fa, fa), (fa, fe), (fa, fb)])
    assert same == 1.0 and 0.3 < half < 0.8 and other < 0.2


def test_rows_meet_their_successors(texts):
    rng = random.Random(6)
    rows = awkward(rng) + [(100 + 3 * i, prose(rng, rng.randint(1, 300)), "s") for i in range(60)]
    got = compare_with_edits(texts(rows).repartition(5)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None and r["doc_id"] != 5}
    order = sorted((i, t or "") for i, t, _ in rows if i is not None)
    for (i, t), (_, following) in zip(order, order[1:], strict=False):
        if i in by_id:
            assert by_id[i]["edited_sha256"] == hashlib.sha256(edited_text(t, following).encode()).hexdigest()
            assert by_id[i]["fingerprint"] == fingerprint_bytes(t.encode()) and by_id[i]["n_chars"] == len(t)


def test_the_last_row_meets_the_first_and_one_row_meets_itself(texts):
    two = {r["doc_id"]: r for r in compare_with_edits(texts([(1, "abcdef", "s"), (2, "uvwxyz", "s")])).collect()}
    assert two[2]["edited_sha256"] == hashlib.sha256(b"uvwabc").hexdigest()
    (one,) = compare_with_edits(texts([(1, "abcdef", "s")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1.0


def test_empty_table_and_plain_fingerprints(texts):
    assert compare_with_edits(texts([])).collect() == []
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints(texts([(1, None, "s"), (2, "", "s"), (3, "abc", "s")])).collect()}
    assert got[1] == got[2] == "0::" and got[3] == fingerprint_bytes(b"abc")
