"""Secrets in texts: three fixed patterns, and random-looking strings found by two Markov models.

Patterns, each applied leftmost without overlaps, matches below the least length dropped:
``assign`` (a credential name, ``:`` or ``=``, a value of 8 or more), ``access`` (``AKIA…``, 16 or more), ``hex`` (32 or more).

A fourth kind, ``random``, takes every other run of 20 or more characters of ``[A-Za-z0-9+/_.=-]``
and compares two models of character pairs: one learnt from ordinary identifiers, one from random strings. A run is a span
if the log-likelihood ratio passes both a total and a per-character bound and it meets no span of the patterns. Labelled
samples: the distinct runs of 6 or more characters of all texts, outside pattern matches, are ordinary; digests of the same runs,
written in base 64, 36 and 16, are random. A run found n times weighs as much as n has binary digits: copied texts don't drown the
styles of small sources, and unique random strings don't drown the words. Their pair counts, at most 68 x 68 numbers, become one
array literal.

Plain column expressions throughout. Positions are code points, ends exclusive. A NULL text counts as empty and has no spans. Rows and
other columns stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns; the second group is the part whose length counts.
VALUE = r"[A-Za-z0-9+/_.=-]"
ASSIGN = rf"(?:(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?({VALUE}+))"
PATTERNS = (("assign", ASSIGN, 8), ("access", r"(AKIA[A-Z0-9]+)", 16), ("hex", r"([0-9a-f]+)", 32))
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CANDIDATE, LEAST_RUN = VALUE + "{20,}+", 20
#: Bounds on the log-likelihood ratio: in total, and per pair of characters.
TOTAL, EACH = 16.0, 0.5

_SPAN = "struct<start:int,kind:int,end:int>"
#: A quick test that holds for every text with a match; a plain search is much faster than extraction.
_QUICK = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}


def _found(text: Column, pattern: str, quick: str, least: int, kind: int) -> Column:
    r"""Spans of a pattern with one group inside. ``\G`` ties each match to the end of the one before it."""
    whole = F.lit(rf"\G(?s)(.*?)({pattern})")

    def part(group: int) -> Column:
        return F.transform(F.regexp_extract_all(text, whole, group), F.length)

    steps = F.arrays_zip(part(1).alias("gap"), part(2).alias("all"), part(3).alias("value"))
    return F.when(text.rlike(quick), _placed(steps, least, kind)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _placed(steps: Column, least: int, kind: int) -> Column:
    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["all"]
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        kept = F.when(x["value"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    return F.aggregate(steps, first, step, lambda acc: acc["out"])


def pattern_spans(text: Column) -> list[Column]:
    return [_found(text, pattern, _QUICK[name], least, k) for k, (name, pattern, least) in enumerate(PATTERNS)]


def train(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratios (random to ordinary) for pairs of characters, row by row of the alphabet."""
    text = F.col(text_col)
    for _, pattern, _least in PATTERNS[:2]:
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(text, "[0-9a-f]{32,}", " ")
    runs = docs.select(F.explode(F.regexp_extract_all(text, F.lit(VALUE + "{6,}"), 0)).alias("run")).groupBy("run").count()
    digest = F.sha2(F.col("run"), 256)
    n = F.least(F.length("run") * 2, F.lit(40))
    made = [
        F.substring(F.base64(F.unhex(digest)), F.lit(1), n),
        F.lower(F.concat(F.conv(F.substring(digest, 1, 15), 16, 36), F.conv(F.substring(digest, 20, 15), 16, 36))),
        F.substring(digest, F.lit(1), n),
    ]
    # Whole weights, so that their sums do not depend on the order of addition.
    weight = F.length(F.bin("count")).cast("long")

    def kind(s: Column, ordinary: Column, random: Column) -> Column:
        return F.struct(s.alias("s"), ordinary.alias("ordinary"), random.alias("random"))

    nil, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    strings = runs.select(F.explode(F.array(kind(F.col("run"), weight, nil), *[kind(m, nil, one) for m in made])).alias("x")).select("x.*")
    # The lookahead gives the pair at every position in one pass over the string.
    pairs = strings.select("ordinary", "random", F.explode(F.regexp_extract_all("s", F.lit("(?=(..))."), 1)).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("random").alias("random"), F.sum("ordinary").alias("ordinary")).collect()
    size = len(ALPHABET)
    table = [[[0.5] * size for _ in range(size)] for _ in range(2)]
    for row in counts:
        a, b = ALPHABET.find(row["pair"][0]), ALPHABET.find(row["pair"][1])
        if a >= 0 and b >= 0:
            table[0][a][b] += row["ordinary"]
            table[1][a][b] += row["random"]
    ratios = []
    for a in range(size):
        ordinary, random = sum(table[0][a]), sum(table[1][a])
        ratios += [math.log(table[1][a][b] / random) - math.log(table[0][a][b] / ordinary) for b in range(size)]
    return ratios


def _ratio(run: Column, ratios: list[float]) -> Column:
    """Sum of the ratios over the pairs of characters of a run."""
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    size = len(ALPHABET)

    def step(acc: Column, letter: Column) -> Column:
        at = F.instr(F.lit(ALPHABET), letter) - 1
        gain = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.element_at(table, acc["last"] * size + at + 1))
        return F.struct(at.alias("last"), (acc["sum"] + gain).alias("sum"))

    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(run, "(?!^)"), start, step, lambda acc: acc["sum"])


def random_spans(text: Column, base: Column, ratios: list[float]) -> Column:
    whole = F.lit(rf"\G(?s)(.*?)({CANDIDATE})")
    gaps = F.transform(F.regexp_extract_all(text, whole, 1), F.length)
    runs = F.regexp_extract_all(text, whole, 2)

    def likely(run: Column) -> Column:
        total = _ratio(run, ratios)
        return (total >= TOTAL) & (total >= EACH * F.length(run))

    judged = F.transform(runs, lambda r: F.struct(F.length(r).alias("all"), F.when(likely(r), F.length(r)).otherwise(F.lit(0)).alias("value")))
    steps = F.transform(F.arrays_zip(gaps.alias("gap"), judged.alias("run")), lambda x: F.struct(x["gap"].alias("gap"), x["run"]["all"].alias("all"), x["run"]["value"].alias("value")))
    spans = _placed(steps, LEAST_RUN, 3)
    clear = F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.when(text.rlike(VALUE + "{20}"), clear).otherwise(F.array().cast(f"array<{_SPAN}>"))


def with_secrets(docs: DataFrame, ratios: list[float], text_col: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans``, sorted arrays of (start, kind, end), and the number of base spans of each kind.

    Columns of these names (base, spans, n_assign, n_access, n_hex) are replaced; keep others under other names, or packed.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign, access, hexes = pattern_spans(text)
    found = docs.withColumns({"__assign": assign, "__access": access, "__hex": hexes})
    found = found.withColumns(
        {
            "n_assign": F.size("__assign").cast("long"),
            "n_access": F.size("__access").cast("long"),
            "n_hex": F.size("__hex").cast("long"),
            "base": F.array_sort(F.concat("__assign", "__access", "__hex")),
        }
    ).drop("__assign", "__access", "__hex")
    added = random_spans(text, F.col("base"), ratios)
    return found.withColumn("spans", F.array_sort(F.concat("base", added)))


def rendered(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.split(F.lit(",".join(KINDS)), ",")
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text_col: str, spans: str, mark: str = "[SECRET]") -> Column:
    """The text with each span, or each group of overlapping spans, replaced by a mark; NULL stays NULL."""
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        parts = F.when(fresh, F.concat(acc["parts"], F.array(between, F.lit(mark)))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    built = F.aggregate(
        F.col(spans), start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, built).otherwise(text)
