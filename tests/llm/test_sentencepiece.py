import random
import string

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from plantlake.llm.sentencepiece import MARK, PieceModel, decode_tokens, encode_texts
from tests.llm.conftest import awkward, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def data():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def pairs(data):
    return PieceModel(data)


def as_lists(model, samples):
    ids, counts = model.encode(samples)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def odd_strings(rng):
    out = ["", " ", "  x   y \n\n z\t ", "<s> </s> <unk> <0x41>", "aaa" * 300, f"{MARK}a{MARK}{MARK}b", "漢字 é é 😀", " lead", "trail "]
    for alphabet in ("ethaonr si\n▁.<>0123 ", "ab", "=-_*. ", string.ascii_letters + "  "):
        out += ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(150)]
    return out + ["".join(chr(rng.randint(1, 0x2FFF)) for _ in range(100)) for _ in range(60)]


def test_byte_pair_ids_equal_the_library(data, pairs):
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(20)
    samples = odd_strings(rng) + [prose(rng, 80, "etaoinshrdlu") for _ in range(40)]
    assert as_lists(pairs, samples) == library.encode(samples, num_threads=1)


def test_decoding_equals_the_library(data, pairs):
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    samples = odd_strings(random.Random(21))
    ids, counts = pairs.encode(samples)
    got = [d.decode(errors="replace") for d in pairs.decode(ids, counts)]
    assert got == [library.decode(x) for x in as_lists(pairs, samples)]


def test_unigram_paths_have_the_best_score(data):
    model = PieceModel(data.replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01"))
    assert model.model == 1
    rng = random.Random(22)
    words = ["".join(rng.choices("etaonhr", k=rng.randint(1, 12))) for _ in range(150)]
    for word, ids in zip(words, as_lists(model, words), strict=True):
        text = MARK + word
        best = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                if (piece := model.id.get(text[start:end])) is not None:
                    best[end] = max(best[end], best[start] + model.scores[piece])
        assert "".join(model.pieces[i] for i in ids) == text
        assert sum(model.scores[i] for i in ids) == pytest.approx(best[-1])


def test_a_forgotten_word_is_encoded_again(data, monkeypatch):
    monkeypatch.setattr("plantlake.llm.sentencepiece.REMEMBERED", 20)
    model, rng = PieceModel(data), random.Random(23)
    samples = [prose(rng, 15) for _ in range(12)]
    assert [as_lists(model, [s])[0] for s in samples] == as_lists(PieceModel(data), samples)


def test_rows_go_round(texts):
    rows = awkward(random.Random(24))
    encoded = encode_texts(texts(rows), PATH)
    got = encoded.collect()
    assert len(got) == len(rows) and all(r["n_tokens"] == len(r["token_ids"]) for r in got)
    odd = {i for i, t, _ in rows if MARK in (t or "")}
    assert all(r["round_trip"] != (r["doc_id"] in odd) for r in got)
    back = {r["doc_id"]: r["text"] for r in decode_tokens(encoded, PATH).collect()}
    assert all(back[i] == (t or "").replace(MARK, " ") for i, t, _ in rows if i is not None)


def test_empty_table_and_null_tokens(llm, texts):
    assert encode_texts(texts([]), PATH).collect() == []
    rows = llm.createDataFrame([(1, None), (2, [])], "doc_id bigint, token_ids array<int>")
    assert [r["text"] for r in decode_tokens(rows, PATH).collect()] == ["", ""]
