"""Row-quality rules, their metrics, and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows for which every rule is TRUE; a rule that is NULL drops the row.

    One conjunctive filter, so the optimizer can push each rule below the projection
    and into the scan.
    """
    return df.filter(reduce(Column.__and__, [F.expr(rule) for rule in rules.values()]))


def observe_rules(df: DataFrame, rules: Rules, name: str | Observation = "dq") -> DataFrame:
    """Count rows and passes per rule while the data flows by; place it before `keep_valid`.

    The counts appear in ``StreamingQuery.lastProgress["observedMetrics"]``, or in the
    ``Observation`` of a batch job, without another pass.
    """
    passes = [F.count_if(F.expr(rule)).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(name, F.count(F.lit(1)).alias("total"), *passes)


def rule_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rule, total, passed, failed. A single aggregate over ``df``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.expr(rule)).alias(f"r{i}") for i, rule in enumerate(rules.values())],
    )
    per_rule = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("passed")) for i, name in enumerate(rules)]
    )
    return counts.select("total", F.inline(per_rule)).select(
        "rule", "total", "passed", (F.col("total") - F.col("passed")).alias("failed")
    )


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or hold a NULL, with their row count.

    Partial counts are made before the shuffle, so a hot key costs one row per task.
    """
    null_part = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter((F.col("row_count") > 1) | null_part)


def foreign_key_violations(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct child keys without a parent. A key with a NULL part refers to nothing and passes."""
    referring = child.select(*keys).dropna(subset=list(keys)).distinct()
    return referring.join(parent.select(*keys), list(keys), "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column that must not be NULL: column_name, null_count."""
    rules = {name: f"`{name}` IS NOT NULL" for name in columns}
    return rule_metrics(df, rules).select(F.col("rule").alias("column_name"), F.col("failed").alias("null_count"))
