"""Toxicity scores from a weighted finite-state pattern grammar.

A text is cut into clauses, a clause into words. Five machines read the words side by side, composed into one:

* the insult machine accepts an insult and a target in either order; an insult alone ends in a state of less weight;
* the threat machine accepts a threat verb and then a target or an insult as its object; a verb alone keeps only a share of its
  learnt weight, if it has one;
* the target machine remembers whether the clause addresses or names somebody;
* the negation machine remembers a negation for the next three words;
* the reported-speech machine remembers a reporting verb or an opening quotation mark until the clause or the quotation ends.

Insults are words and pairs of neighbouring words of one clause, found in a lexicon of whole words, word beginnings and pairs with
learnt weights. A pair is a pattern of its own and has its full weight. Negation and reported speech count where a match
stands; target, insult and threat count by the state at the end of the clause, so that they see later words too. A
match's weight is multiplied by the weight of that state and by a factor for its context (plain, targeted, negated,
reported, and their combinations). A clause scores its best path: its best weighted match plus a share
of the next one. A text's evidence is its best clause plus a share of the second. The score is a logistic curve over the evidence.

Learning, from labelled rows only: the lexicon from smoothed log-odds of words, beginnings and pairs in toxic and clean texts, of which
every one becomes an entry that chance doesn't explain, however rare and however many they are;
a context's factor from how often matches in it come from toxic texts, with a prior that halves negated and reported matches; the
curve by maximum likelihood. At most about ``TRAINING_TEXTS`` labelled texts are used, drawn by a hash of their ids.

A NULL text counts as empty; texts without matches have the lowest score. Without both labels the score is the smoothed share.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import slices, stored

TRAINING_TEXTS = 40_000
#: Bounds for a lexicon entry: toxic texts that hold it, and log-odds.
LEAST_TEXTS, LEAST_ODDS = 3, 2.5
#: Beginnings of words that may be entries, in code points.
BEGINNINGS = range(4, 9)
SCOPE = 3
PRIOR = 5.0

# Function words that steer the context machines, in the languages at hand.
TARGETS = frozenset("you your you're u he she they them him her those these du dich dir ihr euch sie er tu toi te vous ils elle tú usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never isn't aren't don't doesn't wasn't nor nicht kein keine nie niemals ne jamais aucun ni nunca jamás tampoco".split())
REPORTS = frozenset("said says say told called calls claimed wrote quoted reported sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt destroy beat shoot stab burn punish töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())

_TOKEN = regex.compile(r"[\p{L}\p{N}_'’]+|[.!?;:\n]+|[\"“”«»]")


def terms(word: str) -> list[str]:
    """Lexicon keys of a word: itself, closed by ``$``, and its beginnings."""
    return [word + "$", *(word[:k] for k in BEGINNINGS if len(word) >= k)]


def pairs(words: list[str]) -> list[str]:
    """Lexicon keys of the pairs of neighbouring words of a clause; no word holds a blank."""
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def clauses_of(lower: str) -> Iterator[list[str]]:
    """Words of each clause."""
    words: list[str] = []
    for token in _TOKEN.findall(lower):
        if token[0] in ".!?;:\n":
            yield words
            words = []
        elif token[0] not in "\"“”«»":
            words.append(token)
    yield words


@dataclass(frozen=True)
class Machine:
    """States 0 … ``states - 1``; ``move`` maps (state, symbol) to the next state, ``weights`` weighs a clause that ends in a state."""

    states: int
    move: tuple[tuple[int, ...], ...]
    weights: tuple[float, ...] = ()


# Symbols of the composed machine's input.
OTHER, TARGET, NEGATION, REPORT, QUOTE, INSULT, THREAT = SYMBOLS = range(7)
#: Weight of an insult without target, and of a threat verb without object.
ALONE = 0.75
TARGETED = Machine(2, tuple(tuple(1 if s or symbol == TARGET else 0 for symbol in SYMBOLS) for s in range(2)))
NEGATED = Machine(SCOPE + 1, tuple(tuple(SCOPE if symbol == NEGATION else max(0, s - 1) for symbol in SYMBOLS) for s in range(SCOPE + 1)))
# 0 none, 1 after a reporting verb, 2 inside a quotation
REPORTED = Machine(3, tuple(tuple((0 if s == 2 else 2) if symbol == QUOTE else (1 if symbol == REPORT and s == 0 else s) for symbol in SYMBOLS) for s in range(3)))
# 0 none, 1 target, 2 insult, 3 both
INSULTED = Machine(4, tuple(tuple(s | {TARGET: 1, INSULT: 2}.get(symbol, 0) for symbol in SYMBOLS) for s in range(4)), (0.0, 0.0, ALONE, 1.0))
# 0 none, 1 verb, 2 verb and then its object
THREATENED = Machine(
    3, tuple(tuple(2 if s == 1 and symbol in (TARGET, INSULT) else max(s, int(symbol == THREAT)) for symbol in SYMBOLS) for s in range(3)), (0.0, ALONE, 1.0)
)


def compose(*machines: Machine) -> Machine:
    """The machine that runs all of them; its states number their combinations."""
    moves = []
    total = math.prod(m.states for m in machines)
    for state in range(total):
        parts, rest = [], state
        for m in machines:
            parts.append(rest % m.states)
            rest //= m.states
        row = []
        for symbol in SYMBOLS:
            nxt, base = 0, 1
            for m, s in zip(machines, parts, strict=True):
                nxt += base * m.move[s][symbol]
                base *= m.states
            row.append(nxt)
        moves.append(tuple(row))
    return Machine(total, tuple(moves))


GRAMMAR = compose(TARGETED, NEGATED, REPORTED, INSULTED, THREATENED)
_MARKS = TARGETED.states * NEGATED.states
_INSULTS = _MARKS * REPORTED.states
_THREATS = _INSULTS * INSULTED.states


def context(state: int) -> int:
    """Three bits: targeted, negated, reported."""
    targeted, rest = state % TARGETED.states, state // TARGETED.states
    negated, reported = rest % NEGATED.states, state // _MARKS % REPORTED.states
    return int(targeted > 0) | int(negated > 0) << 1 | int(reported > 0) << 2


PRIOR_FACTORS = [(1.1 if c & 1 else 1.0) * (0.5 if c & 2 else 1.0) * (0.6 if c & 4 else 1.0) for c in range(8)]


#: Marks beside the machine's symbols: ends of clauses, those that hold a line end, and words that a pair begins with.
STOP, LINE, HEAD = 8, 9, 16
_CUTS = re.compile(bytes((91, STOP, LINE, 93)))
_WORTH = re.compile(b"[" + re.escape(bytes((INSULT, THREAT))) + bytes((HEAD,)) + b"-" + bytes((2 * HEAD - 1,)) + b"]")
#: Bytes that a reader may remember words in, about; a memory bound.
REMEMBERED = 96 << 20


class _Read(dict):
    """Token → symbol, found once per token, ``HEAD`` added where a pair may begin. What is remembered is bounded in bytes."""

    def __init__(self, lexicon: dict[str, float], heads: frozenset[str]):
        super().__init__()
        self.lexicon, self.heads, self.weights, self.room = lexicon, heads, {}, REMEMBERED

    def __missing__(self, token: str) -> int:
        self.room -= 4 * len(token) + 160
        if self.room < 0:
            self.clear()
            self.weights.clear()
            self.room = REMEMBERED
        first = token[0]
        if first in ".!?;:\n":
            found = LINE if "\n" in token else STOP
        elif first in "\"“”«»":
            found = QUOTE
        elif token in TARGETS:
            found = TARGET
        elif token in NEGATIONS:
            found = NEGATION
        elif token in REPORTS:
            found = REPORT
        else:
            w = max((self.lexicon.get(t, 0.0) for t in terms(token)), default=0.0)
            found = THREAT if token in THREATS else INSULT if w else OTHER
            if w:
                self.weights[token] = w
        if token in self.heads:
            found |= HEAD
        self[token] = found
        return found


@dataclass
class ToxicityModel:
    lexicon: dict[str, float] = field(default_factory=dict)
    factors: list[float] = field(default_factory=lambda: list(PRIOR_FACTORS))
    slope: float = 1.0
    bias: float = -4.0

    def __post_init__(self):
        self.pairs = {k: w for k, w in self.lexicon.items() if " " in k}
        self.read = _Read(self.lexicon, frozenset(k.split(" ")[0] for k in self.pairs))

    def weight(self, word: str) -> float:
        """Weight of a word, 0 without an entry."""
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def matches(self, text: str) -> list[list[tuple[float, int]]]:
        """For each clause with matches: (weight, context) of each.

        Every token is looked up once. Only clauses that hold a match are read by the machines; all that reaches them from
        earlier ones is whether a quotation is open.
        """
        tokens = _TOKEN.findall(text.lower())
        symbols = bytes(map(self.read.__getitem__, tokens))
        if not _WORTH.search(symbols):
            return []
        out, quoted, at = [], False, 0
        for end in [*(m.start() for m in _CUTS.finditer(symbols)), len(symbols)]:
            clause = symbols[at:end]
            if _WORTH.search(clause):
                found = self._clause(tokens[at:end], clause, quoted)
                if found:
                    out.append(found)
            quoted ^= clause.count(QUOTE) & 1 == 1
            if end < len(symbols) and symbols[end] == LINE:
                quoted = False
            at = end + 1
        return out

    def _clause(self, tokens: list[str], symbols: bytes, quoted: bool) -> list[tuple[float, int]]:
        """Matches of one clause, weighed by the state it ends in."""
        state, last, read = 2 * _MARKS if quoted else 0, "", []
        for token, symbol in zip(tokens, symbols, strict=True):
            head, symbol = symbol & HEAD, symbol & ~HEAD
            if symbol in (INSULT, THREAT):
                read.append((symbol, self.read.weights.get(token) or self.weight(token), context(state)))
            if symbol != QUOTE:
                if last and (w := self.pairs.get(f"{last} {token}", 0.0)):
                    read.append((OTHER, w, context(state)))
                last = token if head else ""
            state = GRAMMAR.move[state][symbol]
        insult = INSULTED.weights[state // _INSULTS % INSULTED.states]
        threat = THREATENED.weights[state // _THREATS]
        targeted = context(state) & 1
        found = []
        for kind, w, c in read:
            if kind == THREAT:
                w = max(w, 1.0) if threat == 1.0 else w * threat
            elif kind == INSULT:
                w *= insult
            if w:
                found.append((w, c | targeted))
        return found

    def evidence(self, matches: list[list[tuple[float, int]]]) -> float:
        clauses = []
        for clause in matches:
            best = sorted((w * self.factors[c] for w, c in clause), reverse=True)
            clauses.append(best[0] + 0.25 * sum(best[1:3]))
        clauses.sort(reverse=True)
        return clauses[0] + 0.25 * sum(clauses[1:3]) if clauses else 0.0

    def score(self, matches: list[list[tuple[float, int]]]) -> float:
        x = self.slope * self.evidence(matches) + self.bias
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, label → the text's distinct lexicon keys, pairs included, with the counts of a slice added up."""
    for batch in slices(batches, 0):
        counts: dict[str, list[int]] = {}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            clauses = list(clauses_of((text or "").lower()))
            found = {t for w in {w for c in clauses for w in c} for t in terms(w)}
            for term in found.union(*map(pairs, clauses)):
                counts.setdefault(term, [0, 0])[int(label)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in (1, 0))],
            names=["term", "toxic", "clean"],
        )


def _surprise(toxic: Column, both: Column, share: float) -> Column:
    """Log-likelihood ratio of a term's toxic share against the share of all texts."""
    clean = both - toxic
    return toxic * F.log(toxic / (both * share)) + F.when(clean > 0, clean * F.log(clean / (both * (1 - share)))).otherwise(0.0)


def fit_toxicity(
    docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAINING_TEXTS
) -> ToxicityModel:
    """``known``: one row per id with its label (0.0 or 1.0). About ``most`` of them are used, which bounds what is broadcast."""
    rows = known.count()
    if rows > most:
        known = known.filter(F.pmod(F.xxhash64(F.lit(9), id_col), F.lit(rows)) < most)
    training = docs.join(F.broadcast(known), id_col).select(F.col(text_col).alias("text"), "label")
    training = stored(training, "toxicity-training")
    n, ones = training.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        return ToxicityModel(slope=0.0, bias=math.log((ones + 1) / (n - ones + 1)))
    least = LEAST_TEXTS if ones >= 30 else 2
    # Only terms of toxic texts can be entries, so those of clean texts are counted for them alone.
    shape = "term string, toxic bigint, clean bigint"
    toxic = training.filter("label = 1").mapInArrow(_terms_of, shape).groupBy("term").agg(F.sum("toxic").alias("toxic"))
    toxic = stored(toxic, "toxicity-terms")
    candidates = toxic.count()
    clean = training.filter("label = 0").mapInArrow(_terms_of, shape).groupBy("term").agg(F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (ones + 1)) - F.log((F.coalesce("clean", F.lit(0)) + 0.5) / (n - ones + 1))
    entries = toxic.filter(F.col("toxic") >= least).join(clean, "term", "left").select("term", "toxic", F.coalesce("clean", F.lit(0)).alias("clean"), odds.alias("odds"))
    # As many terms are tried as toxic texts hold, so chance must explain an entry less often than once among them all.
    surprise = _surprise(F.col("toxic"), F.col("toxic") + F.col("clean"), ones / n)
    top = entries.filter((F.col("odds") >= LEAST_ODDS) & (surprise >= math.log(candidates))).select("term", "odds").collect()
    model = ToxicityModel({row["term"]: row["odds"] for row in top})

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = [model.matches(t or "") for t in batch.column(0).to_pylist()]
            columns = [[len(c) for c in m] for m in found], [[w for c in m for w, _ in c] for m in found], [[x for c in m for _, x in c] for m in found]
            types = [pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["label", "sizes", "weights", "contexts"]
            )

    # Matches are few and small; the factors and the curve are fitted on them, not on the texts.
    found = stored(training.mapInArrow(matched, "label double, sizes array<int>, weights array<double>, contexts array<int>"), "toxicity-matches")
    met = found.select("label", F.explode("contexts").alias("c")).groupBy("c")
    for row in met.agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean")).collect():
        c, full = row["c"], 1.1 if row["c"] & 1 else 1.0
        model.factors[c] = (PRIOR * PRIOR_FACTORS[c] + full * row["toxic"]) / (PRIOR + row["toxic"] + row["clean"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = []
            for sizes, weights, contexts in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                pairs_of, at, clauses = list(zip(weights, contexts, strict=True)), 0, []
                for n in sizes:
                    clauses.append(pairs_of[at : at + n])
                    at += n
                x.append(round(model.evidence(clauses), 1))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(0)], names=["x", "label"])

    # A histogram of the evidence, in tenths: bounded however many texts there are.
    bins = found.mapInArrow(measured, "x double, label double").groupBy("x", "label").count().collect()
    model.slope, model.bias = _curve([(r["x"], r["label"], r["count"]) for r in bins])
    return model


def _curve(points: list[tuple[float, float, int]]) -> tuple[float, float]:
    """Slope and bias of a logistic curve, Newton's method with a small ridge."""
    x, y, n = (np.array(c, dtype=np.float64) for c in zip(*points, strict=True))
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    ridge = np.diag([0.5, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (y - p)) - ridge @ w
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + ridge, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def score_texts(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, matched_clauses."""
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType()), T.StructField("matched_clauses", T.LongType())])
    lexicon, factors, slope, bias = model.lexicon, model.factors, model.slope, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(lexicon, factors, slope, bias)
        for batch in slices(batches, 1):
            found = [own.matches(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([own.score(m) for m in found], pa.float64()),
                    pa.array([len(m) for m in found], pa.int64()),
                ],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
