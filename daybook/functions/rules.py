"""Ordered validation rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named check: where ``broken`` is true the row is rejected."""

    name: str
    broken: Column
    reason: str


def first_match(rules: list[Rule]) -> Column:
    """struct<rule, reason> of the first broken rule, NULL for a valid row.

    A predicate that evaluates to NULL counts as not broken.
    """
    if not rules:
        raise ValueError("first_match needs at least one rule.")

    def verdict(rule: Rule) -> Column:
        return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.reason).alias("reason"))

    first, *rest = rules
    return reduce(
        lambda chain, rule: chain.when(rule.broken, verdict(rule)),
        rest,
        F.when(first.broken, verdict(first)),
    )


def materialize_columns(df: DataFrame) -> DataFrame:
    """Compute the columns of ``df`` once per row, here.

    A filter on a derived column is pushed below the projection that derives
    it, which repeats each parsing expression inside the filter. A generator
    stops that pushdown without a shuffle or a cache.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.inline(F.array(row)))


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rejection_rule`` and ``rejection_reason``, both NULL when valid."""
    judged = materialize_columns(df).withColumn("verdict", first_match(rules))
    return judged.select(
        *df.columns,
        F.col("verdict.rule").alias("rejection_rule"),
        F.col("verdict.reason").alias("rejection_reason"),
    )


def valid_rows(tagged: DataFrame) -> DataFrame:
    kept = tagged.filter(F.col("rejection_rule").isNull())
    return kept.drop("rejection_rule", "rejection_reason")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("rejection_rule").isNotNull())
