"""Readers for the three feeds, written partitions and metrics documents."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook import schemas as S
from daybook.functions.dates import parse_run_date
from daybook.operators.rejects import union_all_by_name
from daybook.sources.session import files_below


def partition_paths(
    root: str, run_dates: list[date | str] | None, date_column: str = "dt"
) -> list[str]:
    """The folders of the given dates, or the root for all of them."""
    if run_dates is None:
        return [root]
    return [f"{root}/{date_column}={parse_run_date(d).isoformat()}" for d in run_dates]


def _reader(spark: SparkSession, root: str):
    # The base path keeps dt a column when single date folders are listed.
    return spark.read.option("basePath", root)


def read_tagged_text(
    spark: SparkSession, root: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    """Every line of every file as ``raw_record``, blank lines included."""
    lines = _reader(spark, root).text(partition_paths(root, run_dates))
    return lines.withColumnRenamed("value", "raw_record")


def read_market_csv(
    spark: SparkSession, root: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    """Price files with a header line; cells that do not convert are NULL."""
    return (
        _reader(spark, root)
        .schema(S.MARKET_FEED)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(partition_paths(root, run_dates))
    )


def read_portfolio_json(
    spark: SparkSession, root: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    """One nested document per file."""
    return (
        _reader(spark, root)
        .schema(S.PORTFOLIO_DOCUMENT)
        .option("multiLine", True)
        .json(partition_paths(root, run_dates))
    )


def read_portfolio_lines(
    spark: SparkSession, root: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    """Files with one portfolio a line, in the shape of documents of one portfolio.

    Such files are split, so a date's export may be of any size. A line that
    is no JSON object or is empty of values is a document without portfolios.
    """
    lines = (
        _reader(spark, root)
        .schema(S.PORTFOLIO_LINE)
        .json(partition_paths(root, run_dates))
    )
    fields = [f for f in S.PORTFOLIO_LINE.names if f != "run_date"]
    present = reduce(or_, [F.col(f).isNotNull() for f in fields])
    return lines.select(
        "run_date",
        F.when(present, F.array(F.struct(*fields))).alias("portfolios"),
        "dt",
    )


#: How a portfolio export may be laid out.
PORTFOLIO_FORMS = {"documents": read_portfolio_json, "lines": read_portfolio_lines}


def read_partitions(
    spark: SparkSession,
    root: str,
    run_dates: list[date | str],
    date_column: str = "dt",
    schema: StructType | None = None,
) -> DataFrame:
    """Some dates of a partitioned table; other dates' folders are not even listed."""
    reader = _reader(spark, root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*partition_paths(root, run_dates, date_column))


def read_partition(
    spark: SparkSession, root: str, run_date: date | str, date_column: str = "dt"
) -> DataFrame:
    """One date of a partitioned table; a date without a folder is an error."""
    return read_partitions(spark, root, [run_date], date_column)


def read_metrics(spark: SparkSession, root: str, run_dates: list[date | str]) -> DataFrame:
    """The metrics document of each date; no folder or bad JSON is an error.

    A date with several part files is represented by the first one by name.
    """
    lines = _reader(spark, root).text(partition_paths(root, run_dates))
    first = lines.groupBy("dt").agg(
        F.min_by("value", F.col("_metadata.file_path")).alias("value")
    )
    document = F.from_json("value", S.METRICS_DOCUMENT, {"mode": "FAILFAST"})
    return first.select(document.alias("document")).select("document.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Expected metrics shipped with a feed, as (run_date, metric, value) rows."""
    schema = "run_date date, expected_metrics map<string, bigint>"
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    return document.select(
        "run_date", F.explode("expected_metrics").alias("metric", "value")
    )


def source_objects(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(source_name, key, size_bytes) of every file; contents are not read."""
    listings = []
    for source, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        try:
            listed = files.load(path).select(
                F.lit(source).alias("source_name"),
                F.col("path").alias("key"),
                F.col("length").alias("size_bytes"),
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            listed = spark.createDataFrame(
                [], "source_name string, key string, size_bytes bigint"
            )
        listings.append(listed)
    return union_all_by_name(listings)


def source_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(source_name, object_count, total_size_bytes) of each named feed folder."""
    return source_objects(spark, paths).groupBy("source_name").agg(
        F.count("*").alias("object_count"),
        F.sum("size_bytes").alias("total_size_bytes"),
    )


def dated_inventory(
    spark: SparkSession,
    in_root: str,
    run_dates: list[date | str],
    sources: list[str] = S.SOURCES,
) -> DataFrame:
    """(source_name, run_date, object_count, total_size_bytes) of every feed and date asked for.

    Files lie in a date's folder or anywhere below it. A feed without files on a
    date has a row with zeros. The listing is followed page by page and only its
    sums are held.
    """
    rows = []
    for source in sources:
        for day in sorted({parse_run_date(d) for d in run_dates}):
            count = size = 0
            for _, length in files_below(spark, f"{in_root}/{source}/dt={day.isoformat()}"):
                count, size = count + 1, size + length
            rows.append((source, day, count, size))
    return spark.createDataFrame(
        rows, "source_name string, run_date date, object_count bigint, total_size_bytes bigint"
    )


def require_source_dates(
    spark: SparkSession, in_root: str, run_dates: list[date], expected: list[str] = S.SOURCES
) -> None:
    """Raise with the name of every (feed, date) that has no file.

    A file may lie in the date's folder or anywhere below it. Each folder is
    listed up to its first file; contents are not read. A date with files but
    without rows passes, even if they are empty.
    """
    absent = [
        f"{source} {day}"
        for source in expected
        for day in sorted({d.isoformat() for d in run_dates})
        if next(files_below(spark, f"{in_root}/{source}/dt={day}"), None) is None
    ]
    if absent:
        raise FileNotFoundError(f"No source files for: {', '.join(absent)}")


def missing_sources(inventory: DataFrame, expected: list[str] = S.SOURCES) -> DataFrame:
    """Expected feeds that have no file."""
    spark = inventory.sparkSession
    wanted = spark.createDataFrame([(s,) for s in expected], "source_name string")
    present = inventory.where(F.col("object_count") >= 1)
    return wanted.join(present, "source_name", "left_anti")


def require_sources(inventory: DataFrame, expected: list[str] = S.SOURCES) -> None:
    """Raise with the names of feeds that have no file."""
    absent = [row["source_name"] for row in missing_sources(inventory, expected).collect()]
    if absent:
        raise FileNotFoundError(f"No source files for: {', '.join(sorted(absent))}")
