"""The one reject table every feed writes to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import RunDate, run_date_column


def rejected_record(
    df: DataFrame,
    source: str,
    run_date: RunDate,
    identifier: Column,
    payload: Column,
    rule: Column,
    reason: Column,
    rejected_at: Column | None = None,
) -> DataFrame:
    """Project rejected rows of any feed onto the seven reject columns."""
    return df.select(
        F.lit(source).alias("source_name"),
        run_date_column(run_date).cast("date").alias("run_date"),
        identifier.cast("string").alias("record_identifier"),
        payload.cast("string").alias("raw_record"),
        rule.cast("string").alias("rejection_rule"),
        reason.cast("string").alias("rejection_reason"),
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("rejected_at"),
    )


def json_payload(*columns: str) -> Column:
    """The named fields as a JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def union_all_by_name(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name; a column one input lacks is NULL there."""
    if not dfs:
        raise ValueError("union_all_by_name needs at least one DataFrame.")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), dfs)


def rejection_counts(rejected: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rejects per source and rule (and per ``by`` columns in front)."""
    keys = [*(by or []), "source_name", "rejection_rule"]
    return rejected.groupBy(*keys).agg(F.count("*").alias("rejected_record_count"))


def rejection_rollup(rejected: DataFrame) -> DataFrame:
    """Counts per (source, rule), per source, per rule and in total.

    The rows are counted once per source and rule; only those few counts go
    through the grouping sets.
    """
    counts = rejection_counts(rejected)
    source, rule = F.col("source_name"), F.col("rejection_rule")
    rolled = counts.groupingSets(
        [[source, rule], [source], [rule], []], source, rule
    ).agg(
        F.coalesce(F.sum("rejected_record_count"), F.lit(0)).alias("rejected_record_count"),
        F.grouping_id().alias("grouping"),
    )
    # grouping_id has one bit per column rolled up: source is 2, rule is 1.
    level = (
        F.when(F.col("grouping") == 0, F.lit("source_rule"))
        .when(F.col("grouping") == 1, F.lit("source"))
        .when(F.col("grouping") == 2, F.lit("rule"))
        .otherwise(F.lit("total"))
    )
    return rolled.select(
        "source_name", "rejection_rule", "rejected_record_count", level.alias("level")
    )
