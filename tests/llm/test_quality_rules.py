import random

import pytest
from pyspark.sql import functions as F

from plantlake.llm.common import remainder
from plantlake.llm.quality import STATISTICS, RuleModel, agreed_labels, fit_rules, labelled, text_statistics
from tests.llm.conftest import awkward, prose


def shouting(rng, n):
    return " ".join(w.upper() + "!!" for w in prose(rng, n).split())


@pytest.fixture(scope="module")
def corpus(llm):
    rng = random.Random(11)
    rows = [(i, shouting(rng, 60) if i % 4 == 0 else prose(rng, rng.randint(5, 120)), "s") for i in range(400)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality"))
    return docs, labels


def test_held_out_rows_are_told_apart(llm, corpus):
    docs, labels = corpus
    measured = text_statistics(docs)
    model = fit_rules(labelled(measured, labels, "quality", "doc_id", 4, 2))
    assert model.rules and all(name in STATISTICS for _, tests in model.rules for name, _, _ in tests)
    scored = measured.withColumn("score", model.score()).join(labels, "doc_id").filter(remainder("doc_id", 4) == 2)
    wrong = scored.filter((F.col("score") >= 0.7).cast("int") != F.col("quality")).count()
    assert scored.count() > 50 and wrong <= 1


def test_scores_are_the_logistic_sum_of_the_rules_that_hold(llm):
    model = RuleModel(0.5, ((1.0, (("upper", True, 0.2),)), (-2.0, (("upper", False, 0.5), ("digit", False, 0.1)))))
    rows = llm.createDataFrame([(0.3, 0.0), (0.6, 0.0), (0.1, 0.5)], "upper double, digit double")
    got = [round(r[0], 6) for r in rows.select(model.score()).collect()]
    assert got == [round(1 / (1 + 2.718281828459045**-x), 6) for x in (0.5 + 1 - 2, 0.5 + 1, 0.5)]


def test_awkward_texts_have_scores(texts):
    rows = awkward(random.Random(12))
    measured = text_statistics(texts(rows), keep=("doc_id", "cls"))
    scored = measured.select("cls", *STATISTICS, RuleModel(0.1, ()).score().alias("score")).collect()
    assert len(scored) == len(rows) and all(r[s] is not None for r in scored for s in STATISTICS)


def test_labels_of_one_kind_and_empty_tables(llm, corpus):
    docs, labels = corpus
    measured = text_statistics(docs)
    ones = labels.filter("quality = 1")
    assert fit_rules(labelled(measured, ones, "quality", "doc_id", 4, 2)).rules == ()
    assert fit_rules(labelled(measured, labels.limit(0), "quality", "doc_id", 4, 2)) == RuleModel(0.0, ())
    assert text_statistics(docs.limit(0)).collect() == []


def test_conflicting_and_null_labels_do_not_count(llm):
    labels = llm.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    assert [tuple(r) for r in agreed_labels(labels, "quality").collect()] == [(1, 1.0)]
