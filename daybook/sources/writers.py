"""Date-partitioned outputs that are safe to write again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions.dates import parse_run_date
from daybook.operators.metrics import metrics_json
from daybook.sources.session import COMPACT, lean_writes


def write_partitions(
    df: DataFrame, root: str, run_dates: list[date | str], date_column: str = "dt"
) -> None:
    """Replace exactly the given dates of the table at ``root``.

    All dates are written by one job that swaps their folders in when it
    commits. Dates that end up without rows are then replaced by an empty
    folder, since the swap leaves folders alone for which there are no rows.
    """
    dates = [parse_run_date(d) for d in run_dates]
    written = Observation()
    rows = df.where(F.col(date_column).isin(dates))
    with lean_writes(df.sparkSession):
        (
            rows.observe(written, F.collect_set(date_column).alias("dates"))
            .write.mode("overwrite")
            .options(partitionOverwriteMode="dynamic", **COMPACT)
            .partitionBy(date_column)
            .parquet(root)
        )
    schema = StructType([f for f in df.schema if f.name != date_column])
    nothing = df.sparkSession.createDataFrame([], schema)
    for day in sorted(set(dates) - set(written.get["dates"])):
        nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{root}/{date_column}={day.isoformat()}"
        )


def write_portfolio_lines(documents: DataFrame, root: str) -> None:
    """The portfolios of documents, one a line, in the folder of their date; the dates are replaced.

    The way from exports with documents that are large for one task: each is parsed
    as a whole once more, then its portfolios are spread over files. A document
    without portfolios leaves one line with its date only.
    """
    portfolios = documents.select("dt", "run_date", F.explode_outer("portfolios").alias("portfolio"))
    spread = portfolios.select("dt", "run_date", "portfolio.*").hint("rebalance")
    with lean_writes(documents.sparkSession):
        (
            spread.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt")
            .json(root)
        )


def write_metrics(metrics: DataFrame, root: str) -> None:
    """One JSON line per run date, each in its own ``dt=`` folder."""
    lines = metrics_json(metrics).select(F.col("run_date").alias("dt"), "value")
    (
        lines.coalesce(1)  # one short line per date
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .text(root)
    )


def project_contract(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns`` in order, with NaN turned into NULL."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"Required columns are missing: {', '.join(absent)}")
    floating = {name for name, type_ in df.dtypes if type_ in ("float", "double")}

    def cell(name: str) -> Column:
        value = F.col(name)
        if name not in floating:
            return value
        return F.when(~F.isnan(value), value).alias(name)

    return df.select(*[cell(c) for c in columns])


def write_delimited(df: DataFrame, path: str, null_marker: str = "\\N") -> None:
    """Headerless CSV with a NULL marker, quoted only where needed, quotes doubled."""
    (
        df.write.mode("overwrite")
        .option("nullValue", null_marker)
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )
