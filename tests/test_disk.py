"""What jobs leave on disk: shuffles go with the write they were for, feeds are compressed, staged rows go once they are used."""

import os
import time
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import feed_queries as Q
from checks import feeds as X
from daybook.plans import pipeline as P
from daybook.sources import session
from daybook.sources import snapshots
from daybook.sources.session import lean_writes, stored
from daybook.sources.writers import write_partitions
from daybook.streaming.ingest import ingest_new_files
from tests.test_scale import positions

DAY = date(2026, 8, 3)


def shuffled(spark):
    """Names of the shuffle files there are now."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def left_by(spark, write):
    """Shuffle files that a write leaves; they are deleted in the background."""
    before = shuffled(spark)
    write()
    for _ in range(50):
        if not shuffled(spark) - before:
            return set()
        time.sleep(0.1)
    return shuffled(spark) - before


def test_shuffles_go_with_their_write(spark, tmp_path):
    rows = spark.range(1000).withColumn("dt", F.lit(DAY)).repartition(4, "id")
    assert not left_by(spark, lambda: stored(rows, "rows", lean=True))
    assert not left_by(spark, lambda: write_partitions(rows, f"{tmp_path}/out", [DAY]))
    assert not left_by(spark, lambda: P.stage(rows.withColumn("rejection_rule", F.lit("R")), f"{tmp_path}/stage"))
    assert not left_by(spark, lambda: snapshots.replace_dates(rows, f"{tmp_path}/table", "dt", [DAY]))


def test_settings_are_as_before_after_a_write(spark):
    before = dict(spark.conf.getAll)
    with pytest.raises(InterruptedError), lean_writes(spark):
        raise InterruptedError
    assert dict(spark.conf.getAll) == before


def test_rows_of_many_folders_are_whole(spark, tmp_path):
    days = [DAY + timedelta(days=n) for n in range(3 * session.FOLDERS_AT_ONCE)]
    rows = spark.range(600).withColumn("dt", F.date_add(F.lit(DAY), (F.col("id") % len(days)).cast("int")))
    write_partitions(rows, f"{tmp_path}/out", days)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert Counter(got.select("id", "dt").collect()) == Counter(rows.collect())


def files(root):
    return [os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.startswith("part-")]


def market(spark, root):
    spark.range(1, 9).selectExpr("id p_partkey", "'T' p_type", "cast(id as int) p_size", "1.5D p_retailprice").write.parquet(f"{root}/part.parquet")


def orders(spark, root, held):
    """The tables of ``positions`` with the columns that messages need."""
    positions(spark, root, held)
    lines = spark.read.parquet(f"{root}/lineitem.parquet").selectExpr("*", "0.1D l_discount", "1L l_suppkey", f"date'{DAY}' l_shipdate").collect()
    spark.createDataFrame(lines).write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    market(spark, root)
    return str(root)


def test_feeds_are_compressed(spark, tmp_path):
    root = orders(spark, tmp_path / "in", {c: range(1, 9) for c in range(1, 5)})
    X.write_feeds(spark, root, f"{tmp_path}/out", days=2)
    names = files(f"{tmp_path}/out")
    assert names and all(n.endswith(".gz") for n in names)
    texts = spark.read.text(f"{tmp_path}/out/trades/dt={DAY}")
    assert Counter(r["value"] for r in texts.collect()) == Counter(r["raw_record"] for r in X.messages(spark, root).collect())


def test_rejects_written_apart_are_those_of_one_plan(spark, tmp_path):
    root = orders(spark, tmp_path / "in", {c: range(1, 9) for c in range(1, 60)})
    for variant in (X.FIXED, X.DAILY):
        together = Q.all_rejects(spark, root, variant)
        apart = Q.all_rejects(spark, root, variant, True)
        assert Counter(apart.collect()) == Counter(together.collect()) and apart.count()
        assert any("/trade-rejects-" in f for f in apart.inputFiles())


def test_rows_of_few_dates_are_not_shuffled(spark):
    rows = spark.range(4).withColumn("day", F.lit(DAY))
    days = [DAY + timedelta(days=n) for n in range(session.FOLDERS_AT_ONCE + 1)]
    plan = lambda dates: P.gather_dates(rows, "day", dates)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(days[:-1])
    assert "REBALANCE" in plan(days)


@pytest.mark.parametrize("small", [True, False])
def test_staged_rows_go_once_they_are_used(spark, tmp_path, monkeypatch, small):
    root = orders(spark, tmp_path / "in", {c: range(1, 9) for c in range(1, 30)})
    X.write_feeds(spark, root, f"{tmp_path}/feeds")
    work, seen = [], {}
    monkeypatch.setattr(P, "work_folder", lambda *_: work.append(f"{tmp_path}/work") or work[-1])
    monkeypatch.setattr(P, "fits_broadcast", lambda _: small)

    def write(df, path, dates, *more):
        seen[os.path.basename(path)] = {os.path.relpath(os.path.dirname(f), work[0]) for f in files(work[0])}
        write_partitions(df, path, dates, *more)

    monkeypatch.setattr(P, "write_partitions", write)
    metrics = P.run_pipeline(spark, f"{tmp_path}/feeds", f"{tmp_path}/out", [DAY], max_reject_rate=2.0, max_unresolvable=10**9).first()
    assert metrics["total_trade_count"] == 29 * 8 and metrics["clean_trade_count"] > 0
    last = seen[os.path.basename(P.S.TABLES["rejected_records"].output_path)]
    assert not {"trades/is_rejected=false", "portfolio/is_rejected=false", "documents/is_rejected=false"} & last
    assert "portfolio/is_rejected=true" in last


def test_ingested_lines_are_compact(spark, tmp_path):
    spark.createDataFrame([("8=FIX|", DAY)], "value string, dt date").write.partitionBy("dt").text(f"{tmp_path}/feed")
    ingest_new_files(spark, f"{tmp_path}/feed", f"{tmp_path}/lines", f"{tmp_path}/checkpoint")
    names = files(f"{tmp_path}/lines")
    assert names and all(n.endswith(".zstd.parquet") for n in names)
