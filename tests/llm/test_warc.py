"""WARC archives: exact round trips, the index, and byte ranges."""

import base64
import gzip
import hashlib
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import warc
from daybook.llm.queries import op11_warc
from daybook.llm.registry import prepared

DATE = "2026-01-01T00:00:00Z"
SCHEMA = "page_id bigint, url string, html string, key string, payload string, last int, digest string, id int"


@pytest.fixture(autouse=True)
def shipped(spark):
    prepared(spark)


def pages():
    """Nulls, empties, hot copies, repeated rows, separators inside payloads, long and odd texts."""
    rng = random.Random(4)
    htmls = [None, "", "<p>é ü</p>", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n", "x" * 3_000_000, " "]
    htmls += [f"<html>{rng.random()}{'t' * rng.randrange(900)}</html>" for _ in range(60)]
    htmls += [htmls[2]] * 40 + htmls[6:20]
    urls = ["https://a.example/x y", None, "", "http://é.example/\r\nWARC-Type: no", "ftp://b"] + [f"https://c.example/{i}" for i in range(500)]
    rows = [(i * 7 % 127, urls[i], h) for i, h in enumerate(htmls)]
    rows += [rows[3], rows[8], (None, "u", htmls[2]), (None, "v", "only null ids"), (None, "w", "only null ids"), (-5, "n", htmls[2])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", 1, "d", 2) for r in rows], SCHEMA)


def expected(rows, min_bytes=0):
    last, count = {}, Counter()
    for i, _, html in rows:
        count[html or ""] += 1
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = Counter()
    for i, url, html in rows:
        data = (html or "").encode()
        top = last.get(html or "") if len(data) >= min_bytes else None
        again = top is not None and (i is None or i < top)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[i, len(data), digest, "revisit" if again else "response", top if again else None, None if again else data] += 1
    return out


def read_back(index):
    rows = warc.read_records(index).select(
        warc.page_of(F.col("record_id")).cast("bigint"), "payload_bytes", "digest", "record_type",
        warc.page_of(F.col("refers_to")).cast("bigint"), "payload")
    return Counter((*r[:5], None if r[5] is None else bytes(r[5])) for r in rows.collect())


@pytest.mark.parametrize("min_bytes", [0, 1, 20])
def test_round_trip(spark, tmp_path, min_bytes):
    rows = pages()
    index = warc.archive_pages(frame(spark, rows), f"file://{tmp_path}", DATE, min_bytes, archive_bytes=2_000)
    assert index.count() == len(rows) and index.select("archive").distinct().count() > 5
    assert read_back(index) == expected(rows, min_bytes)
    assert Counter(r["url"] for r in index.collect()) == Counter(u for _, u, _ in rows)


def test_members_stand_alone_and_urls_cannot_break_a_header(spark, tmp_path):
    rows = pages()
    index = warc.archive_pages(frame(spark, rows), str(tmp_path), DATE).collect()
    targets = set()
    for row in index:
        with open(row["archive"], "rb") as handle:
            handle.seek(row["offset"])
            data = gzip.decompress(handle.read(row["length"]))
        found = warc.parsed(data, "here")
        assert found["record_id"] == row["record_id"] and found["digest"] == row["digest"] and found["date"] == DATE
        targets.add(found["url"])
    assert "https://a.example/x%20y" in targets and "http://é.example/%0D%0AWARC-Type:%20no" in targets and None in targets


def test_scan_of_archives_gives_the_same_index(spark, tmp_path):
    rows = pages()
    index = warc.archive_pages(frame(spark, rows), str(tmp_path), DATE, archive_bytes=20_000)
    scanned = warc.index_archives(spark, f"{tmp_path}/archives")
    names = ["offset", "length", "digest", "record_type", "record_id", F.element_at(F.split("archive", "/"), -1)]
    assert Counter(map(tuple, index.select(*names).collect())) == Counter(map(tuple, scanned.select(*names).collect()))
    assert read_back(scanned) == expected(rows)


def test_plain_archives_of_others(spark, tmp_path):
    """Uncompressed, without digests, with records that are no pages."""
    def one(kind, body, extra=b""):
        return b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (
            kind, len(body), extra, len(body), body)

    http = b"Content-Type: application/http;msgtype=response\r\nWARC-Target-URI: http://x/\r\n"
    payloads = [b"", b"one", b"\r\n\r\n" * 9, b"z" * 2_500_000]
    data = one(b"warcinfo", b"software: x")
    for p in payloads:
        data += one(b"response", b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n" + p, http) + one(b"request", b"GET / HTTP/1.1")
    data += one(b"resource", b"as it is")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(data)
    index = warc.index_archives(spark, f"{tmp_path}/in")
    got = warc.read_records(index).collect()
    assert Counter(bytes(r["payload"]) for r in got) == Counter([*payloads, b"as it is"])
    assert {r["url"] for r in got if r["record_type"] == "response"} == {"http://x/"}


def test_few_records_are_read_by_few_ranges(spark, tmp_path, monkeypatch):
    rows = [(i, f"https://e.example/{i}", f"{i}:" + random.Random(i).randbytes(2_000).hex()) for i in range(300)]
    index = warc.archive_pages(frame(spark, rows).coalesce(1), str(tmp_path), DATE)
    every = [tuple(r) for r in index.select("archive", "offset", "length").orderBy("archive", "offset").collect()]
    whole = os.path.getsize(every[0][0].removeprefix("file:"))
    assert len({e[0] for e in every}) == 1
    near = every[10:13] + every[200:202]
    found = list(warc.ranges(near, gap=0, most=10**9))
    assert [len(places) for _, _, places in found] == [3, 2]
    assert sum(p[-1][0] + p[-1][1] - start for _, start, p in found) < whole / 20
    assert len(list(warc.ranges(every, gap=0, most=10**9))) == 1
    assert len(list(warc.ranges(every, gap=0, most=1))) == len(every)
    skipping = every[::2]
    assert len(list(warc.ranges(skipping, gap=0, most=10**9))) == len(skipping)
    assert len(list(warc.ranges(skipping, gap=10**6, most=10**9))) == 1
    chosen = index.where(F.col("url").rlike("/(7|8|299)$"))
    assert {k[0] for k in read_back(chosen)} == {7, 8, 299}
    assert read_back(index.where("false")) == Counter()


def test_damage_is_an_error(spark, tmp_path):
    index = warc.archive_pages(frame(spark, [(1, "u", "some text")]), str(tmp_path), DATE)
    row = index.first()
    path = row["archive"].removeprefix("file:")
    with open(path, "rb") as handle:
        data = handle.read()
    record = gzip.decompress(data[row["offset"]:]).replace(b"some text", b"some tex!")
    with open(path, "wb") as handle:
        handle.write(data[: row["offset"]] + warc.member(record))
    with pytest.raises(Exception, match="Payload digest"):
        warc.read_records(index.withColumn("length", F.lit(len(warc.member(record))).cast("bigint"))).collect()


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    rows = pages()
    index = warc.archive_pages(frame(spark, rows), str(tmp_path), DATE)
    with open(f"{tmp_path}/archives/left.warc.gz", "wb") as handle:
        handle.write(b"half a member")
    assert read_back(warc.read_index(spark, str(tmp_path))) == expected(rows)
    assert index.count() == len(rows)


def test_empty_table(spark, tmp_path):
    index = warc.archive_pages(frame(spark, []), str(tmp_path), DATE)
    assert index.count() == 0 and warc.read_records(index).count() == 0
    assert warc.index_archives(spark, f"{tmp_path}/archives").count() == 0


def test_query_reads_every_page(spark):
    rows = op11_warc(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()


def test_hot_payload_is_joined_by_plain_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warc.with_record_types(frame(spark, pages()))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin"):]
    assert join.count("Exchange hashpartitioning(key") == 2 and "Aggregate" not in join
