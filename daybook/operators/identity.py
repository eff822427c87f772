"""Row ids that come from the rows' content."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.sources.session import stored

#: Equal rows that one compact row stands for while they are numbered.
COPIES_AT_ONCE = 1_000

#: Up to so many hashes of repeated rows are sent to every executor, some 16 MB.
BROADCAST_HASHES = 500_000


def with_content_ids(df: DataFrame, column: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a 64-bit id for each row, made from its values and its number among equal rows.

    Ids do not depend on the order of rows, on partitions or on what else a table holds:
    the same rows get the same ids in any load. Columns in ``ignore``, such as time
    stamps of the run, do not count; rows that differ only in them are equal. NULL is a
    value like any other. Among n rows two ids are equal with a chance of about n * n / 2 ** 65.

    Hashes are counted first, here and now. A row whose hash no other row has needs no
    number and is not shuffled; only the others are numbered, or all rows where too many hashes
    are repeated. ``df`` is read several times and should come from files.
    """
    based = df.withColumn("_base", F.xxhash64(*[c for c in df.columns if c not in ignore]))
    counted = based.groupBy("_base").agg(F.count("*").alias("_rows"))
    repeated = stored(counted.where(F.col("_rows") > 1).select("_base"), "repeated", lean=True)
    if repeated.count() > BROADCAST_HASHES:
        return _numbered(based, column, df.columns)
    hashes = F.broadcast(repeated)
    several = _numbered(based.join(hashes, "_base", "left_semi"), column, df.columns)
    single = based.join(hashes, "_base", "left_anti")
    return single.select(_content_id(F.lit(0).cast("bigint")).alias(column), *df.columns).union(several)


def _content_id(number):
    return F.xxhash64(F.col("_base"), number)


def _numbered(based: DataFrame, column: str, columns: list[str]) -> DataFrame:
    """Rows with ids from their hash ``_base`` and their number among rows of that hash.

    Equal rows are first counted, so that a row with any number of copies is one
    row in the shuffle; it is then unfolded in steps that adaptive execution can spread.
    """
    equal = based.groupBy("_base", *columns).agg(F.count("*").alias("_copies"))
    within = Window.partitionBy("_base").orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0)
    numbered = equal.withColumn("_before", F.sum("_copies").over(within) - F.col("_copies"))
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES_AT_ONCE))
    spread = numbered.withColumn("_step", F.explode(steps)).hint("rebalance")
    first = F.col("_step") * COPIES_AT_ONCE
    last = F.least(F.col("_copies"), first + COPIES_AT_ONCE) - 1
    single = spread.withColumn("_number", F.explode(F.sequence(F.col("_before") + first, F.col("_before") + last)))
    return single.select(_content_id(F.col("_number")).alias(column), *columns)
