"""The two-threshold quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Both must stay strictly below.
MAX_REJECT_RATE = 0.02
MAX_UNRESOLVABLE = 100


class QualityGateFailed(RuntimeError):
    """At least one run date did not pass; nothing was loaded."""


def gate_passes(
    reject_rate: Column,
    unresolvable: Column,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
) -> Column:
    return (reject_rate < max_reject_rate) & (unresolvable < max_unresolvable)


def quality_gate(
    metrics: DataFrame,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
    strict: bool = False,
) -> DataFrame:
    """Judge metrics documents anew, whatever verdict they carry.

    Each gate metric is taken from the document's gate section, else from its
    top level. ``missing_metrics`` names those found in neither place; such a
    row has no verdict, and with ``strict`` reading it is an error.
    """
    measured = {
        "trade_reject_rate": F.coalesce("quality_gate.trade_reject_rate", "trade_reject_rate"),
        "pnl_unresolvable_count": F.coalesce(
            "quality_gate.pnl_unresolvable_count", "pnl_unresolvable_count"
        ),
    }
    missing = F.concat_ws(
        ", ", *[F.when(value.isNull(), F.lit(name)) for name, value in measured.items()]
    )
    judged = metrics.select(
        "run_date",
        *[value.alias(name) for name, value in measured.items()],
        missing.alias("missing_metrics"),
        F.col("quality_gate.passed").alias("recorded_passed"),
    )
    passes = gate_passes(
        F.col("trade_reject_rate"),
        F.col("pnl_unresolvable_count"),
        max_reject_rate,
        max_unresolvable,
    )
    verdict = F.when(F.col("missing_metrics") == "", passes)
    if strict:
        verdict = verdict.otherwise(
            F.raise_error(
                F.concat(F.lit("Quality gate metrics are missing: "), F.col("missing_metrics"))
            )
        )
    return judged.withColumn("passed", verdict).withColumn(
        "disagrees",
        F.coalesce(F.col("recorded_passed") != F.col("passed"), F.lit(False)),
    )


def require_passed(gate: DataFrame) -> None:
    """Raise unless every run date passed. Reads one row per failing date."""
    failed = gate.where(~F.coalesce("passed", F.lit(False))).select("run_date").collect()
    if failed:
        dates = ", ".join(sorted(str(row["run_date"]) for row in failed))
        raise QualityGateFailed(f"Quality gate failed, loading blocked for: {dates}")
