"""The pipeline on a small corpus, stage by stage against plain Python."""

import collections
import random

import public_tokenizers
import pytest
import sentencepiece

from pyspark.sql import functions as F

import corpus_pipeline
from plantlake.llm.common import stored
from plantlake.llm.quality import STATISTICS
from tests.llm.conftest import prose

CLASHING = ["mark", "spans", "base", "n_assign", "upper", "digit", "label", "size", "taken", "id", "cls", "key", "text_hash", "n", "target", "token_ids"]
SECRET = "password=hunter2hunter2"


@pytest.fixture(scope="module")
def corpus(llm, tmp_path_factory):
    rng = random.Random(40)
    rows, labels = [], []
    for i in range(240):
        bad = i % 6 == 0
        text = " ".join(w.upper() + "!!" for w in prose(rng, 40).split()) if bad else prose(rng, rng.randint(30, 90))
        if i % 10 == 3:
            text += f" {SECRET} end"
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(not bad), 0))
    base = prose(rng, 120)
    for k in range(6):
        words = base.split()
        if k:
            words[rng.randrange(120)] = "edited"
        rows.append((1000 + k, " ".join(words), "en", "s1", len(base)))
    rows.append((1010, rows[7][1], "de", "s2", rows[7][4]))
    rows.append((1011, None, "de", None, None))
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # Columns of the user's that are named like columns of the stages and operators.
    for name in CLASHING:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id")))
    docs.write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {r[0]: r for r in rows}


@pytest.fixture(scope="module")
def results(llm, corpus):
    docs, out = llm.read.parquet(f"{corpus[0]}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stored(stage(llm, docs, corpus[0]), name)
        if name != "tokens":
            assert docs.columns == before
        out[name] = docs.collect()
    return out


def test_bad_documents_go_and_clean_ones_stay(corpus, results):
    kept = {r["doc_id"] for r in results["quality"]}
    assert {i for i in corpus[1] if i < 240 and i % 6 != 0} <= kept and not {i for i in kept if i < 240 and i % 6 == 0}
    assert set(range(1000, 1006)) | {1010} <= kept


def test_one_document_of_each_group_stays(results):
    before, after = ({r["doc_id"] for r in results[s]} for s in ("quality", "near_duplicates"))
    assert before - after == {1001, 1002, 1003, 1004, 1005, 1010} and len(results["near_duplicates"]) == len(after)


def test_secrets_are_marked_and_nothing_else_changes(corpus, results):
    assert {r["doc_id"] for r in results["secrets"]} == {r["doc_id"] for r in results["near_duplicates"]}
    for r in results["secrets"]:
        text = corpus[1][r["doc_id"]][1]
        assert r["text"] == (text.replace(SECRET, "[SECRET]") if text else text)
        assert text is None or r["n_chars"] == (len(r["text"]) if SECRET in text else corpus[1][r["doc_id"]][4])


def test_sources_come_near_their_targets(results):
    sizes, taken = collections.Counter(), collections.Counter()
    for r in results["secrets"]:
        sizes[r["source"]] += len((r["text"] or "").split())
    for r in results["mixing"]:
        taken[r["source"]] += len((r["text"] or "").split())
    total, weight = sum(sizes.values()), dict(zip(sorted(s for s in sizes if s), (5, 2, 1, 5), strict=False))
    share = {s: total * w / sum(weight.values()) for s, w in weight.items()}
    assert all(share[s] <= 3 * sizes[s] for s in share)
    assert all(abs(taken[s] - share[s]) <= 100 for s in share)
    assert max(collections.Counter(r["doc_id"] for r in results["mixing"]).values()) <= 3


def test_tokens_equal_the_library(results):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in results["mixing"]}
    assert len(results["tokens"]) == len(results["mixing"])
    for r in results["tokens"]:
        assert r["token_ids"] == library.encode(texts[r["doc_id"]]) and r["round_trip"]


def test_run_applies_all_stages(llm, corpus, results):
    got = corpus_pipeline.run(llm, corpus[0]).select("doc_id", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted((r["doc_id"], r["decoded_sha256"]) for r in results["tokens"])


def test_repeated_rows_and_ids(llm):
    rng = random.Random(41)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(1, a), (1, a), (1, b), (2, a), (3, b), (None, a), (4, None), (4, None)]
    docs = llm.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(llm, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (None, a), (4, None), (4, None)], key=str)


def test_the_statistics_of_the_stage_do_not_leak(llm, corpus, results):
    assert not (set(STATISTICS) - set(CLASHING)) & set(results["quality"][0].asDict())


def test_columns_of_the_user_keep_their_values(results):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        for r in results[name]:
            assert all(r[c] == f"{c} of {r['doc_id']}" for c in CLASHING), name


def test_without_labels_of_both_kinds_all_documents_stay(llm, corpus, tmp_path):
    docs = llm.read.parquet(f"{corpus[0]}/documents.parquet")
    for name, rows in (("none", []), ("one", [(1, 1, 0), (2, 1, 0)])):
        llm.createDataFrame(rows, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.quality_stage(llm, docs, f"{tmp_path}/{name}").count() == docs.count()
