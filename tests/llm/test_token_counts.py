import random

import public_tokenizers
from tokenizers import Tokenizer

from plantlake.llm.token_counts import MergeCounter, count_tokens
from tests.llm.conftest import awkward, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library_on_prose_and_odd_strings(texts):
    rng = random.Random(1)
    rows = awkward(rng) + [(100 + i, prose(rng, 50), "s") for i in range(30)]
    rows += [(200, "<|endoftext|>a<|endoftext|>", "s"), (201, "  x   y \n\n z\t don't I'll 's 123½", "s")]
    library = Tokenizer.from_file(PATH)
    got = sorted(map(tuple, count_tokens(texts(rows), PATH).collect()), key=str)
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)


def test_every_code_point_in_a_small_context():
    library, own = Tokenizer.from_file(PATH), MergeCounter(PATH)
    points = [*range(1, 0x800), *range(0x2000, 0x2100), *range(0x3000, 0x3100), 0x1F600]
    samples = [f"a {chr(c)} b{chr(c)}1{chr(c) * 2}" for c in points]
    assert [own.count(s) for s in samples] == [len(e.ids) for e in library.encode_batch(samples, add_special_tokens=False)]


def test_empty_table(texts):
    assert count_tokens(texts([]), PATH).collect() == []
