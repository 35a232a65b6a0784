"""Mix sources to target weights by pivotal rounding of fractional copies.

``mix(df)`` decides how often each row is taken. All words of the input are shared out over the
sources: sources in code point order, NULL last, weigh 5, 2, 1, 5, 2, 1, …; no source gets more
than three times its own words, and what a stopped source leaves is shared again by weight. A row of a
source with rate ``target / source_size`` is taken ``floor(rate)`` times for certain. The
remaining fractions are paired: words move at random from one row's fraction to the other's until one
of them is 0 or a whole copy. A pair keeps its words, so that only the last row of a source rounds.

Pairs are made within bounded groups, from the longest row to the shortest, so that the row left over tends to be
short; what stays undecided in a group goes to the next round, with
as many fewer rows, until each source has one group. All draws are hashes of ids and the seed, hence reruns agree.
Plain column expressions throughout.

Rows that agree in id, source and size are interchangeable: they are decided as one unit and their copies dealt
out evenly. NULL or wordless texts have size 0 and are never taken. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.common import SPACE, stored
from plantlake.operators.ordering import dense_number

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
#: Rows that a group pairs on average.
GROUP = 48
#: Units that one row makes when repeated rows are dealt out again.
DEAL = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(rf"[^{SPACE}]+")).cast("long"), F.lit(0).cast("long"))


def _draw(seed: int, *columns: Column) -> Column:
    """Uniform in [0, 1), 53 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / F.lit(float(1 << 53))


def source_targets(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """Source, its words and its target. ``units``: source, size, m (how many rows)."""
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    ranked = dense_number(sums.filter("source is not null"), ["source"], "place")
    unnamed = sums.filter("source is null").withColumn("place", F.lit(None).cast("long"))
    places = stored(ranked.unionByName(unnamed), "mixing-sources")
    total, named = places.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("place")).first()
    slot = F.coalesce("place", F.lit(named)) % len(weights)
    places = places.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (slot + 1).cast("int")).alias("weight"))
    cap = F.col("source_size") * most
    level, stopped = 0.0, -1
    while True:  # each turn stops at least one more source; two or three turns are usual
        over = F.col("weight") * F.lit(level) >= cap
        now, held, weight = places.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))
        ).first()
        if now == stopped or not weight:
            break
        stopped, level = now, (float(total) - held) / weight
    target = F.least(F.col("weight") * F.lit(level), cap) if total else F.lit(0.0)
    return places.select("source", "source_size", target.cast("double").alias("target"))


def _pair(acc: Column, x: Column, seed: int) -> Column:
    """Move words between the open row of ``acc`` and ``x``; one gets decided, the other is open afterwards."""
    a, b = acc["open"], x
    whole_a, whole_b = a["size"].cast("double"), b["size"].cast("double")
    up, down = F.least(whole_a - a["mass"], b["mass"]), F.least(a["mass"], whole_b - b["mass"])
    to_a = _draw(seed, a["id"], b["id"], a["size"], b["size"], F.lit("pair")) * (up + down) < down
    # Equal amounts that meet a border are set to it, so that rounding leaves no crumbs.
    a_ends = F.when(to_a, whole_a - a["mass"] <= b["mass"]).otherwise(a["mass"] <= whole_b - b["mass"])
    mass_a = F.when(to_a, F.when(a_ends, whole_a).otherwise(a["mass"] + b["mass"])).otherwise(
        F.when(a_ends, F.lit(0.0)).otherwise(a["mass"] + b["mass"] - whole_b)
    )
    mass_b = F.when(to_a, F.when(a_ends, a["mass"] + b["mass"] - whole_a).otherwise(F.lit(0.0))).otherwise(
        F.when(a_ends, a["mass"] + b["mass"]).otherwise(whole_b)
    )

    def with_mass(row: Column, mass: Column) -> Column:
        return F.struct(row["size"].alias("size"), row["id"].alias("id"), mass.alias("mass"))

    done = F.when(a_ends, with_mass(a, mass_a)).otherwise(with_mass(b, mass_b))
    still = F.when(a_ends, with_mass(b, mass_b)).otherwise(with_mass(a, mass_a))
    return F.struct(F.concat(acc["done"], F.array(done)).alias("done"), still.alias("open"))


def _rounded(fractions: DataFrame, largest: int, seed: int) -> DataFrame:
    """source, id, size and bit (0 or 1) for rows of source, id, size, mass with 0 < mass < size."""
    decided, left, turn = None, fractions, 0
    shape = f"struct<size:bigint,id:{fractions.schema['id'].dataType.simpleString()},mass:double>"
    while True:
        groups = max(1, math.ceil(largest / GROUP))
        row = F.struct("size", "id", "mass")
        grouped = left.groupBy("source", F.pmod(F.xxhash64(F.lit(seed + turn), "id", "size"), F.lit(groups)).alias("g")).agg(
            F.sort_array(F.collect_list(row), asc=False).alias("rows")
        )
        start = F.struct(F.array().cast(f"array<{shape}>").alias("done"), F.element_at("rows", 1).alias("open"))
        folded = grouped.select(
            "source",
            F.aggregate(F.expr("slice(rows, 2, greatest(size(rows) - 1, 0))"), start, lambda acc, x: _pair(acc, x, seed + turn)).alias("f"),
        )
        folded = stored(folded.select("source", "f.done", "f.open"), "mixing-round")
        done = folded.select("source", F.explode("done").alias("d")).select("source", "d.*")
        decided = done if decided is None else decided.unionByName(done)
        left = folded.select("source", "open.*")
        turn += 1
        if groups == 1:
            break
        largest = groups
    hit = _draw(seed, F.col("id"), F.col("size"), F.lit("last")) * F.col("size") < F.col("mass")
    last = left.select("source", "id", "size", F.when(hit, F.col("size").cast("double")).otherwise(F.lit(0.0)).alias("mass"))
    return decided.unionByName(last).select("source", "id", "size", F.when(F.col("mass") > 0, 1).otherwise(0).cast("long").alias("bit"))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = 7,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
) -> DataFrame:
    """One row per (id, source, size): m rows of the input, and ``total`` copies for them together."""
    units = (
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
        .groupBy("id", "source", "size")
        .agg(F.count("*").alias("m"))
    )
    units = stored(units, "mixing-units")
    targets = source_targets(units, weights, most)
    same = units["source"].eqNullSafe(targets["source"])
    rated = units.join(targets, same, "left").drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    sure = F.floor(rate)
    part = F.col("m") * (rate - sure)
    rated = rated.withColumns(
        {
            "base": F.when(F.col("size") > 0, F.col("m") * sure + F.floor(part)).otherwise(F.lit(0)).cast("long"),
            "mass": F.when(F.col("size") > 0, (part - F.floor(part)) * F.col("size")).otherwise(F.lit(0.0)),
        }
    )
    rated = stored(rated, "mixing-rated")
    fractions = rated.filter("mass > 0 and mass < size").select("source", "id", "size", "mass")
    largest = fractions.groupBy("source").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    bits = _rounded(fractions, largest, seed)
    same = [rated[c].eqNullSafe(bits[c]) for c in ("source", "id", "size")]
    return rated.join(bits, same, "left").select(
        rated["id"], rated["source"], rated["size"], "m", "source_size", "target", (F.col("base") + F.coalesce("bit", F.lit(0))).alias("total")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """id, size, source_size, target, taken: one row per input row."""
    plan = copies(docs, **options)
    blocks = plan.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / DEAL))))
    rows = blocks.withColumn(
        "n", F.explode(F.sequence(F.col("b") * DEAL, F.least(F.col("b") * DEAL + DEAL, F.col("m")) - 1))
    )
    own = F.floor(F.col("total") / F.col("m")) + F.when(F.col("n") < F.col("total") % F.col("m"), 1).otherwise(0)
    return rows.select(
        F.col("id"), "source", "size", "source_size", "target", (own * F.col("size")).cast("long").alias("taken")
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The input's rows, each as often as the mix takes it."""
    columns, place = docs.columns, {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plan = copies(docs, id_col, source_col, text_col, **options)
    plan = plan.select(F.xxhash64("id", "source", "size").alias("unit"), "id", "source", "size", "m", "total").filter("total > 0")
    wide = docs.withColumn("c", word_count(text_col)).select("c", *[F.col(f"`{c}`").alias(place[c]) for c in columns])
    own_id, own_source = place[id_col], place[source_col]
    wide = wide.withColumn("unit", F.xxhash64(own_id, own_source, "c"))
    same = F.col("c") == F.col("size"), F.col(own_id).eqNullSafe(F.col("id")), F.col(own_source).eqNullSafe(F.col("source"))
    # One join form at every size: the plan grows with the input, and the window below keeps the join's partitioning.
    met = wide.join(plan.hint("merge"), "unit").filter(same[0] & same[1] & same[2])
    # Rows of one unit take its copies in turn. The rows share all that counts, so their order doesn't matter.
    turn = F.row_number().over(Window.partitionBy("unit", own_id, own_source, "c").orderBy(F.xxhash64(place[text_col])))
    own = F.floor(F.col("total") / F.col("m")) + F.when(F.col("turn") <= F.col("total") % F.col("m"), 1).otherwise(0)
    taken = met.withColumn("turn", turn).withColumn("own", own).filter("own > 0")
    taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("own"))))
    return taken.select(*[F.col(place[c]).alias(c) for c in columns])
