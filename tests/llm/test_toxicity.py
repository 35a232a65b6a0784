import itertools
import random

import pytest
from pyspark.sql import functions as F

from plantlake.llm.toxicity import GRAMMAR, NEGATED, NEGATION, OTHER, QUOTE, REPORT, TARGET, ToxicityModel, compose, context, fit_toxicity, score_texts
from tests.llm.conftest import awkward, prose

INSULTS = ("blorg", "snarf", "quibby")


@pytest.fixture(scope="module")
def corpus(llm):
    rng = random.Random(25)
    rows = []
    for i in range(600):
        words = prose(rng, rng.randint(8, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            # whole words, and one family that shares only its beginning
            words.insert(rng.randrange(len(words)), rng.choice([*INSULTS, "zwick" + "".join(rng.choices("abc", k=4))]))
        rows.append((i, " ".join(words), int(toxic)))
    return llm.createDataFrame(rows, "doc_id bigint, text string, toxic int")


def test_held_out_texts_are_told_apart(corpus):
    train = corpus.filter("doc_id % 3 <> 1").select("doc_id", F.col("toxic").cast("double").alias("label"))
    docs = corpus.select("doc_id", "text")
    scored = score_texts(docs, fit_toxicity(docs, train)).join(corpus.select("doc_id", "toxic"), "doc_id").filter("doc_id % 3 = 1").collect()
    assert sum((r["score"] >= 0.7) != bool(r["toxic"]) for r in scored) <= 2


def run(symbols):
    state = 0
    for s in symbols:
        state = GRAMMAR.move[state][s]
    return context(state)


def test_the_composed_machine_keeps_each_machines_state():
    assert run([OTHER]) == 0 and run([TARGET, OTHER]) == 1
    assert run([NEGATION, OTHER]) == 2 and run([NEGATION, OTHER, OTHER, OTHER]) == 0
    assert run([REPORT, OTHER, OTHER, OTHER, OTHER]) == 4 and run([QUOTE, OTHER]) == 4 and run([QUOTE, OTHER, QUOTE]) == 0
    assert run([TARGET, NEGATION, REPORT]) == 7
    assert compose(NEGATED).move == NEGATED.move


def test_context_moves_the_evidence():
    model = ToxicityModel({"blorg$": 4.0})

    def evidence(text):
        return model.evidence(model.matches(text))

    plain = evidence("such a blorg here")
    assert evidence("you blorg") > plain > evidence("he said blorg") > evidence("never a blorg") > 0
    assert evidence("never. a blorg") == plain  # a clause ends the negation
    assert evidence('they wrote "a. blorg" again') < evidence("they. blorg") + 1e-9
    assert evidence("such a blorg here. and a blorg there") > plain


def test_awkward_texts_have_scores(texts):
    rows = awkward(random.Random(26))
    got = score_texts(texts(rows), ToxicityModel({"word$": 5.0})).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["matched_clauses"]} - {6} == {4, 5}


def test_labels_of_one_kind_and_empty_tables(corpus):
    docs = corpus.select("doc_id", "text")
    only = corpus.filter("toxic = 0").select("doc_id", F.lit(0.0).alias("label"))
    model = fit_toxicity(docs, only)
    assert not model.lexicon and model.slope == 0.0
    fit = fit_toxicity(docs.limit(0), only.limit(0))
    assert fit.score([]) == 0.5 and score_texts(docs.limit(0), fit).collect() == []


def test_insults_and_threats_are_weighed_at_the_end_of_their_clause():
    model = ToxicityModel({"blorg$": 4.0, "grey rat": 3.0})

    def evidence(text):
        return model.evidence(model.matches(text))

    assert evidence("such a blorg you") == evidence("you such a blorg") > evidence("such a blorg")
    # A threat needs an object after its verb, in its clause.
    assert evidence("we kill you") >= 1.0 and evidence("we kill the blorg") > evidence("we see the blorg")
    assert evidence("we kill time") == evidence("you saw it kill") == evidence("we kill. you") == 0.0
    # A pattern of two words; neither is an entry of its own.
    assert evidence("that grey rat") > 0 and evidence("grey. rat") == evidence("rat grey") == 0.0


def test_pairs_of_ordinary_words_are_learnt(llm):
    rng = random.Random(27)
    rows = []
    for i in range(600):
        words = prose(rng, rng.randint(8, 60)).split()
        at = rng.randrange(len(words))
        # Both words are as frequent in clean texts; only their neighbourhood tells.
        words[at:at] = ["stale", "bread"] if i % 5 == 0 else ["bread", "stale"]
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    corpus = llm.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    train = corpus.filter("doc_id % 3 <> 1").select("doc_id", F.col("toxic").cast("double").alias("label"))
    docs = corpus.select("doc_id", "text")
    scored = score_texts(docs, fit_toxicity(docs, train)).join(corpus.select("doc_id", "toxic"), "doc_id").filter("doc_id % 3 = 1").collect()
    assert sum((r["score"] >= 0.7) != bool(r["toxic"]) for r in scored) <= 2


def test_the_composed_machine_does_what_the_five_do_side_by_side():
    """All inputs of up to four symbols, against plain rules over the whole input."""
    from plantlake.llm import toxicity as t

    machines = (t.TARGETED, t.NEGATED, t.REPORTED, t.INSULTED, t.THREATENED)
    for length in range(5):
        for symbols in itertools.product(t.SYMBOLS, repeat=length):
            state, apart = 0, [0] * len(machines)
            for symbol in symbols:
                state = t.GRAMMAR.move[state][symbol]
                apart = [m.move[s][symbol] for m, s in zip(machines, apart, strict=True)]
            rest, parts = state, []
            for m in machines:
                parts.append(rest % m.states)
                rest //= m.states
            assert parts == apart

            targeted = t.TARGET in symbols
            negated = t.NEGATION in symbols[-t.SCOPE :]
            quoted, reported = False, False
            for symbol in symbols:
                if symbol == t.QUOTE:
                    quoted, reported = not quoted, False
                elif symbol == t.REPORT and not quoted:
                    reported = True
            assert t.context(state) == targeted | negated << 1 | (quoted or reported) << 2
            verb = symbols.index(t.THREAT) if t.THREAT in symbols else None
            objected = verb is not None and any(s in (t.TARGET, t.INSULT) for s in symbols[verb + 1 :])
            insult = 0.0 if t.INSULT not in symbols else 1.0 if targeted else t.ALONE
            assert t.INSULTED.weights[parts[3]] == insult
            assert t.THREATENED.weights[parts[4]] == (0.0 if verb is None else 1.0 if objected else t.ALONE)
