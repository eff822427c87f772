"""A query for each operator, over its whole table, with the parameters of production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.session import work_folder

from . import decontamination, filter_audit, jaccard_join, language_id, license_scan, packing, periodic_runs, quality_rules, secret_scan, substring_dedup, suffix_dedup, url_filter, warc
from .registry import query, table

#: The rules of the URL query.
SITE_RULES = (
    (url_filter.ALLOW, "org/"),
    (url_filter.BLOCK, "example.org/es/"),
    (url_filter.BLOCK, "example.org/en/1"),
    (url_filter.ALLOW, "com/fr/"),
    (url_filter.BLOCK, "com/de/"),
)
VOCABULARY = "word_bpe_49k.json"
END_ID = 1


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_ID)


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    question, answer = decontamination.split_answer(F.col("text"))
    return table(spark, sf_dir, "benchmark").select("item_id", question.alias("question"), answer.alias("answer"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a test item, and the item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), benchmark_items(spark, sf_dir))


OP3_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM p
), r AS (
  SELECT *, '.' || host AS h, CASE
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM q
), g AS (
  SELECT *, CASE
    WHEN contains(path, '/wp-login') THEN 'path **/wp-login*'
    WHEN contains(h, 'casino') THEN 'host *casino*'
    WHEN contains(h, 'pills') THEN 'host *pills*'
    WHEN ends_with(path, '.exe') THEN 'path **.exe'
    WHEN ends_with(path, '.zip') THEN 'path **.zip'
    WHEN contains(h, 'porn') THEN 'host *porn*'
    ELSE '**' END AS general FROM r
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN general END AS general_rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN general = '**' THEN 'allow' ELSE 'block' END AS verdict
FROM g"""


@query("op3_url_filter", OP3_SQL)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = [url_filter.site_rule(verdict, name) for verdict, name in SITE_RULES]
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of secrets in every document."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("found", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by models of those that are not held out."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.classify(docs, model, keep=("held_out",))


@query("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each licence named in a document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), runs AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS run
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1
), covered AS (
  SELECT r, sum(least(8, coalesce(next - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM repeated) GROUP BY r
), m AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    len(lines) AS n_lines, len(regexp_extract_all(text, '!')) AS n_shouts
  FROM w LEFT JOIN covered c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 25 * n_words
    OR 100 * n_shouts > 30 * n_words OR word_chars NOT BETWEEN 2 * n_words AND 40 * n_words
    OR 100 * n_dup_lines > 60 * n_lines) AS kept
FROM m"""


@query("op8_quality_rules", OP8_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and the verdict of the cascade in its measured order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = tuple(rule for rule, _, _ in quality_rules.ordered_rules(docs))
    asked = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = quality_rules.measured(docs, asked)

    def measure(name):
        """Measures that the query returns are there; others are computed for rows that get as far as their rule."""
        return F.col(name) if name in asked else quality_rules.MEASURES[name](F.col("text"), F.lit(None))

    base = quality_rules.cascade(quality_rules.BASE_RULES, measure)
    return rows.select(
        "doc_id", *asked,
        base.isNotNull().alias("base_failed"),
        quality_rules.cascade(order, measure).isNull().alias("kept"),
    )


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT r, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400),
w AS (SELECT s.r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM s JOIN d USING (r)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE n > 1),
run AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM hit),
grp AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM run),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS b, g FROM grp GROUP BY r, g),
gap AS (SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS b FROM span
        UNION ALL SELECT r, 0, min(a) FROM span GROUP BY r),
kept AS (SELECT gap.r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k FROM gap JOIN d USING (r) GROUP BY gap.r),
tot AS (SELECT r, count(*) AS n, sum(b - a) AS m FROM span GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(m, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
FROM d LEFT JOIN tot USING (r) LEFT JOIN kept USING (r)"""


@query("op9_suffix_dedup", OP9_SQL)
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to byte strings that stand elsewhere."""
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
k AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM s),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM hit),
kept AS (
  SELECT a.r, string_agg(a.x, ' ' ORDER BY a.i) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) a
  LEFT JOIN gone g ON a.r = g.r AND a.i = g.i WHERE g.i IS NULL GROUP BY a.r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to word sequences that stand elsewhere."""
    return substring_dedup.repeated_words(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 4], ' ') AS x
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b ON a.x = b.x AND a.r <> b.r GROUP BY a.r, b.r),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.r = p.a JOIN n y ON y.r = p.b WHERE 100 * o >= 80 * (x.n + y.n - o)),
c AS (SELECT r AS root, r AS r FROM d UNION SELECT c.root, e.b FROM c JOIN e ON c.r = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON n.r = d.r
JOIN (SELECT c.root, min(t.doc_id) AS component_id FROM c JOIN d t ON t.r = c.r GROUP BY c.root) m ON m.root = d.r"""


@query("op5_jaccard_join", OP5_SQL)
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document under links of 5-word Jaccard similarity 0.8."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT page_id, h, octet_length(encode(h)) AS n, sha1(encode(h)) AS x, max(page_id) OVER (PARTITION BY h) AS last
  FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(x, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to
FROM p"""


@query("op11_warc", OP11_SQL)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the archives, read back by the index."""
    index = warc.archive_pages(table(spark, sf_dir, "pages"), work_folder(spark, "warc"), "2026-01-01T00:00:00Z")
    return warc.read_records(index).select(
        warc.page_of(F.col("record_id")).cast("bigint").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        warc.page_of(F.col("refers_to")).cast("bigint").alias("refers_to"),
    )


OP12_SQL = r"""
WITH RECURSIVE p AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS o UNION ALL
  SELECT o || c FROM p, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(o, c)
), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS copy
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
), f AS (
  SELECT part, concat(CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN copy THEN 'E' END) AS f,
    coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
  FROM d LEFT JOIN l USING (doc_id)
), g AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, f),
s AS (
  SELECT g.*, o, step, substr(o, step, 1) AS x, contains(f, substr(o, step, 1)) AS fails,
    step > 1 AND len(list_filter(string_split(left(o, step - 1), ''), lambda c: contains(f, c))) > 0 AS gone
  FROM g, (SELECT o FROM p WHERE length(o) = 5), (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
), r AS (
  SELECT part, o AS filter_order, step, x,
    CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (f = x), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM s GROUP BY part, o, step, x
)
SELECT * EXCLUDE (x), CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r"""


@query("op12_filter_audit", OP12_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each of their 120 orders, by source."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by hash of the id, with a stretch of words repeated to their end."""
    words = quality_rules.split_words(F.col("text"))
    n = F.size(words)
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"))
    a = F.pmod(F.col("g"), F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, 1, a), F.slice(again, 1, n - a)), " ")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, planted ones among them, and what is left without their repeats."""
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = first["length"], -first["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-first["start"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
