"""Quality scores from a sparse rule ensemble.

``text_statistics`` measures each text. ``fit_rules`` grows shallow trees on the labelled rows,
takes every path of a tree as a conjunctive rule over the statistics, and weighs the rules by a logistic
regression with a lasso penalty, which drops most of them. ``RuleModel.score`` is a plain
column expression over the statistics, so scoring needs no model object on the executors.

Training is distributed and uses all labelled rows. NULL texts count as empty; an empty text has statistics of 0 and
a score like any other. Rows keep their number. Several labels for one id count if they agree,
else the id counts as unlabelled. With labels of one kind, or none, the score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import remainder, slices

STATISTICS = (
    "log_chars",
    "word_length",
    "upper",
    "digit",
    "space",
    "punctuation",
    "symbol",
    "pipe",
    "exclaim",
    "wide",
    "distinct_words",
    "distinct_lines",
    "marked_words",
    "repeated_pairs",
)

# Byte classes: a byte counts in one class at most.
_CLASS = np.zeros(256, dtype=np.uint8)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r", b".,;:?'\"()-", b"#$%&*+/<=>@[\\]^_`{}~", b"|", b"!")):
    _CLASS[list(_bytes)] = _k + 1
_CLASS[128:] = 8

TREES, DEPTH, PENALTY, SEED = 20, 3, 0.002, 11


def _measure(text: str) -> list[float]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(1, len(data))
    share = np.bincount(_CLASS[data], minlength=9) / n
    words = text.split()
    w = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    pairs = max(1, len(words) - 1)
    marked = sum(1 for word in words if word[-1] in "!#$%&*|")
    return [
        math.log1p(len(data)),
        min(100.0, len(text) / w),
        *(float(x) for x in share[1:9]),
        len(set(words)) / w if words else 0.0,
        len(set(lines)) / len(lines) if lines else 0.0,
        marked / w,
        1 - len(set(zip(words, words[1:]))) / pairs if len(words) > 1 else 0.0,
    ]


def text_statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns and one double per statistic."""
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, *(T.StructField(s, T.DoubleType()) for s in STATISTICS)])
    at = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            rows = np.array([_measure(t or "") for t in batch.column(at).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], *(pa.array(rows[:, i]) for i in range(len(STATISTICS)))], names=schema.names
            )

    return docs.select(*keep, text_col).mapInArrow(run, schema)


@dataclass(frozen=True)
class RuleModel:
    """``rules``: (weight, ((statistic, is_greater, bound), …))."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[str, bool, float], ...]], ...]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        total = F.lit(self.bias)
        for weight, tests in self.rules:
            total = total + F.when(_holds(tests), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(tests) -> Column:
    found = F.lit(True)
    for name, greater, bound in tests:
        found = found & ((F.col(name) > F.lit(bound)) if greater else (F.col(name) <= F.lit(bound)))
    return found


def _paths(node, tests: tuple) -> Iterator[tuple]:
    """Conjunctions that lead to each node below the root; per statistic and side only the tightest bound stays."""
    if tests:
        tightest: dict = {}
        for name, greater, bound in tests:
            old = tightest.get((name, greater))
            tightest[name, greater] = bound if old is None else (max(old, bound) if greater else min(old, bound))
        yield tuple(sorted((name, greater, bound) for (name, greater), bound in tightest.items()))
    if node.subtreeDepth() > 0:
        split = node.split()
        name, bound = STATISTICS[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*tests, (name, False, bound)))
        yield from _paths(node.rightChild(), (*tests, (name, True, bound)))


def agreed_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """One row per id whose labels agree."""
    return (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(id_col)
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
        .filter("label = most")
        .select(id_col, F.col("label").cast("double").alias("label"))
    )


def fit_rules(training: DataFrame) -> RuleModel:
    """``training``: the statistics and ``label`` (0.0 or 1.0)."""
    training = training.select("label", *STATISTICS)
    n, ones = training.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = math.log((ones + 1) / (n - ones + 1))
    if not 0 < ones < n:
        return RuleModel(prior, ())
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(training)
    # Both labels weigh the same in the trees, so that rare low quality is not ignored.
    balance = F.when(F.col("label") > 0, F.lit(n / (2 * ones))).otherwise(F.lit(n / (2 * (n - ones))))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="balance", minInstancesPerNode=2, featureSubsetStrategy="onethird", subsamplingRate=0.8
    ).fit(vectors.withColumn("balance", balance))
    rules = list(dict.fromkeys(p for tree in forest.trees for p in _paths(tree._call_java("rootNode"), ())))
    if not rules:
        return RuleModel(prior, ())
    held = F.array(*[_holds(r).cast("double") for r in rules])
    inputs = training.select("label", array_to_vector(held).alias("features"))
    fitted = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False).fit(inputs)
    weights = [(float(w), r) for w, r in zip(fitted.coefficients.toArray(), rules, strict=True) if abs(w) > 1e-9]
    return RuleModel(float(fitted.intercept), tuple(weights))


def labelled(statistics: DataFrame, labels: DataFrame, label_col: str, id_col: str, modulus: int, held_out: int) -> DataFrame:
    """Statistics of the rows that may be learnt from, with their label."""
    known = agreed_labels(labels, label_col, id_col).filter(remainder(id_col, modulus) != held_out)
    return statistics.join(known, id_col)
