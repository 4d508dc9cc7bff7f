"""Registered queries over sightings, documents and pages, each beside the SQL text of the same result where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import dates, html, text, urls
from vigil.operators import analyst, corpus, extract, matching, report, state
from vigil.operators.graph import connected_components
from vigil.plans.inputs import ACTIONS, FEED_ANSWERED, FEED_READ, FEED_STORED, SIGHTINGS, articles, sightings, view
from vigil.plans.materialize import scratch, spread
from vigil.plans.registry import query
from vigil.sources.tables import read_table
from vigil.sources.versions import Store

#: Delegated top-level domains that the documents and pages use.
TLDS = ("com", "net", "org", "io", "uk", "onion", "i2p", "bit")
PSL = [("com", "normal"), ("net", "normal"), ("org", "normal"), ("uk", "normal"), ("co.uk", "normal"), ("io", "normal"), ("example.net", "normal"), ("ck", "wildcard"), ("www.ck", "exception")]


S = f"WITH s AS ({SIGHTINGS}) "


@query(S + """, c AS (SELECT *, lower(value) AS value_lc FROM s WHERE status = 'confirmed' AND indicator_type != 'filename'),
f AS (SELECT value_lc, publisher, min(seq) AS o FROM c GROUP BY ALL),
p AS (SELECT value_lc, array_to_string(list(publisher ORDER BY o), ',') AS publishers FROM f GROUP BY 1)
SELECT value_lc, arg_min(indicator_type, report_date * 0 + 0 + seq) AS indicator_type, count(DISTINCT report_date) AS report_count, count(DISTINCT publisher) AS source_count,
  count(DISTINCT (publisher, article_url)) AS citation_count, min(report_date) AS first_seen, max(report_date) AS last_seen,
  arg_max(action, (report_date - DATE '2024-01-01') * 100000000 + seq) AS action, any_value(publishers) AS publishers
FROM c JOIN p USING (value_lc) GROUP BY value_lc""".replace("arg_min(indicator_type, report_date * 0 + 0 + seq)", "arg_min(indicator_type, (report_date - DATE '2024-01-01') * 100000000 + seq)"))
def corpus_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.corpus_values(sightings(spark, sf_dir)).withColumn("publishers", F.array_join("publishers", ","))


@query(S + """, r AS (SELECT *, lower(value) AS value_lc FROM s WHERE status = 'rejected'),
f AS (SELECT value_lc, reason, min(seq) AS o FROM r GROUP BY ALL),
p AS (SELECT value_lc, array_to_string(list(reason ORDER BY o), ',') AS reason_codes FROM f GROUP BY 1)
SELECT value_lc, count(DISTINCT report_date) AS n_days, min(report_date) AS first_day, any_value(reason_codes) AS reason_codes FROM r JOIN p USING (value_lc) GROUP BY value_lc""")
def corpus_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.corpus_excluded(sightings(spark, sf_dir)).withColumn("reason_codes", F.array_join("reason_codes", ","))


@query(S + """, v AS (SELECT DISTINCT report_date, indicator_type, lower(value) AS v FROM s WHERE status = 'confirmed'),
d AS (SELECT DISTINCT report_date FROM s),
x AS (SELECT d.report_date, (SELECT count(*) FROM d y WHERE y.report_date = d.report_date - 1) AS had FROM d)
SELECT x.report_date,
  CASE WHEN had > 0 THEN (SELECT count(*) FROM (SELECT indicator_type, v FROM v WHERE report_date = x.report_date EXCEPT SELECT indicator_type, v FROM v WHERE report_date = x.report_date - 1)) END AS n_new,
  CASE WHEN had > 0 THEN (SELECT count(*) FROM (SELECT indicator_type, v FROM v WHERE report_date = x.report_date INTERSECT SELECT indicator_type, v FROM v WHERE report_date = x.report_date - 1)) END AS n_repeat,
  CASE WHEN had > 0 THEN (SELECT count(*) FROM (SELECT indicator_type, v FROM v WHERE report_date = x.report_date - 1 EXCEPT SELECT indicator_type, v FROM v WHERE report_date = x.report_date)) END AS n_gone
FROM x""")
def daily_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.daily_sets(sightings(spark, sf_dir))


@query(S + """, p AS (SELECT indicator_type, lower(value) AS v, count(DISTINCT report_date) AS d FROM s WHERE status = 'confirmed' GROUP BY 1, 2)
SELECT indicator_type, count(*) AS n_values, count(*) FILTER (d >= 2) AS n_recurring, round(count(*) FILTER (d >= 2) / count(*), 5) AS recurrence_rate FROM p GROUP BY 1""")
def recurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.recurrence(sightings(spark, sf_dir))


@query(S + """SELECT report_date, count(DISTINCT article_url) AS n_articles, count(DISTINCT publisher) AS n_publishers,
  count(DISTINCT (indicator_type, value)) FILTER (status = 'confirmed') AS n_confirmed,
  count(DISTINCT (indicator_type, value)) FILTER (status = 'confirmed' AND action = 'patch') AS n_patch,
  count(DISTINCT (indicator_type, value)) FILTER (status = 'confirmed' AND action = 'block') AS n_block,
  count(DISTINCT (indicator_type, value)) FILTER (status = 'confirmed' AND action = 'hunt') AS n_hunt FROM s GROUP BY 1""")
def day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.day_summary(sightings(spark, sf_dir))


@query(S + """, d AS (SELECT DISTINCT status, indicator_type, value FROM s)
SELECT status, indicator_type, count(*) AS n FROM d GROUP BY GROUPING SETS ((status), (status, indicator_type))""")
def counts_by_status_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.counts_by_status_type(sightings(spark, sf_dir).withColumnRenamed("value", "normalized_value"))


@query(S + """SELECT seq, indicator_type, value, publisher FROM (SELECT *, row_number() OVER (PARTITION BY indicator_type, lower(value) ORDER BY seen_at DESC, seq) AS k FROM s) WHERE k = 1""")
def latest_sighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).withColumn("v", F.lower("value"))
    return corpus.latest_sighting(rows, ["indicator_type", "v"], "seen_at", "seq").select("seq", "indicator_type", "value", "publisher")


@query(S + """, d AS (SELECT report_date, row_number() OVER (ORDER BY report_date DESC) AS i FROM (SELECT DISTINCT report_date FROM s)),
f AS (SELECT publisher, report_date, max(reason) AS error FROM s WHERE status = 'rejected' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY publisher ORDER BY i) AS k FROM f JOIN d USING (report_date))
SELECT publisher AS source, count(*) AS streak_days, min(report_date) AS since, arg_min(error, i) AS newest_error,
  count(*) % 2 = 0 AND bit_count(count(*) // 2) = 1 AS notify FROM r WHERE i = k GROUP BY 1""")
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir)
    failed = rows.where("status = 'rejected'").select(F.col("publisher").alias("source"), "report_date", F.col("reason").alias("error"))
    return corpus.failure_streaks(failed, rows.select("report_date"))


@query(f"""WITH a AS ({ACTIONS}),
k AS (SELECT report_date, bool_or(action = 'patch' AND kev) AS has_kev FROM a GROUP BY 1),
p AS (SELECT a.*, has_kev, row_number() OVER (PARTITION BY report_date ORDER BY seq) AS slot, row_number() OVER (PARTITION BY report_date ORDER BY kev DESC,
  CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, coalesce(cvss, 0) DESC, coalesce(epss, 0) DESC, coalesce(due_date, '9999-99-99'), target, seq) AS rk
  FROM a JOIN k USING (report_date) WHERE action = 'patch')
SELECT p.report_date, p.seq, p.target, CASE WHEN p.has_kev THEN q.seq ELSE p.seq END AS place FROM p JOIN p q ON p.report_date = q.report_date AND p.rk = q.slot
UNION ALL SELECT report_date, seq, target, seq AS place FROM a WHERE action != 'patch' OR action IS NULL""")
def rank_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.rank_patches(view(spark, sf_dir, ACTIONS, "events")).select("report_date", "seq", "target", "place")


@query(f"""WITH c AS (SELECT target, max(cvss) AS cvss, max(epss) AS epss FROM ({ACTIONS}) GROUP BY 1), g AS (SELECT cvss, count(*) AS n, count(DISTINCT epss) AS e FROM c WHERE cvss IS NOT NULL GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n_scored, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_tied, CAST(coalesce(sum(e) FILTER (n > 1), 0) AS BIGINT) AS n_epss_in_ties FROM g""")
def cvss_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.cvss_ties(view(spark, sf_dir, ACTIONS, "events").groupBy("target").agg(F.max("cvss").alias("cvss"), F.max("epss").alias("epss")))


@query(S + """, c AS (SELECT DISTINCT value AS cve_id FROM s WHERE indicator_type = 'cve' AND status = 'confirmed'),
k AS (SELECT DISTINCT value AS cve_id FROM s WHERE indicator_type = 'cve' AND user_id % 17 = 0),
n AS (SELECT value AS cve_id, max(CAST(user_id % 11 AS DOUBLE)) AS cvss FROM s WHERE indicator_type = 'cve' AND user_id % 5 != 0 GROUP BY 1),
e AS (SELECT value AS cve_id, max(CAST(user_id % 13 AS DOUBLE) / 16) AS epss FROM s WHERE indicator_type = 'cve' AND user_id % 7 != 0 GROUP BY 1)
SELECT c.cve_id, k.cve_id IS NOT NULL AS kev, cvss, epss,
  concat_ws(',', CASE WHEN k.cve_id IS NOT NULL THEN 'kev' END, CASE WHEN n.cve_id IS NOT NULL THEN 'nvd' END, CASE WHEN e.cve_id IS NOT NULL THEN 'epss' END) AS provenance,
  CASE WHEN k.cve_id IS NOT NULL OR cvss >= 9 THEN 'high' ELSE 'medium' END AS priority
FROM c LEFT JOIN k USING (cve_id) LEFT JOIN n USING (cve_id) LEFT JOIN e USING (cve_id)""")
def cve_intel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).where("indicator_type = 'cve'").withColumn("cve_id", F.col("value"))
    kev = rows.where("user_id % 17 = 0").select("cve_id").distinct()
    nvd = rows.where("user_id % 5 != 0").groupBy("cve_id").agg(F.max((F.col("user_id") % 11).cast("double")).alias("cvss"))
    epss = rows.where("user_id % 7 != 0").groupBy("cve_id").agg(F.max((F.col("user_id") % 13).cast("double") / 16).alias("epss"))
    out = corpus.join_intel(rows.where("status = 'confirmed'").select("cve_id").distinct(), kev, nvd, epss)
    return out.select("cve_id", "kev", "cvss", "epss", F.array_join("provenance", ",").alias("provenance"), corpus.cve_priority(F.col("kev"), F.col("cvss"), F.lit(False)).alias("priority"))


@query(S + """, n AS (SELECT indicator_type, lower(value) AS value_lc, arg_max(action, (report_date - DATE '2024-01-01') * 100000000 + seq) AS action, min(report_date) AS news_first, max(report_date) AS news_last FROM s WHERE status = 'confirmed' GROUP BY 1, 2),
m AS (SELECT indicator_type, lower(value) AS value_lc, count(DISTINCT article_url) AS n_samples, min(article_url) AS least_sha256, max(report_date) AS sample_last FROM s WHERE status = 'candidate' GROUP BY 1, 2),
f AS (SELECT indicator_type, lower(value) AS value_lc, count(DISTINCT (publisher, reason)) AS n_listings, max(report_date) AS feed_last FROM s WHERE status = 'rejected' GROUP BY 1, 2)
SELECT indicator_type, value_lc, action, news_first, n_samples, least_sha256, n_listings, greatest(news_last, sample_last, feed_last) AS last_seen
FROM n FULL JOIN m USING (indicator_type, value_lc) FULL JOIN f USING (indicator_type, value_lc)""")
def merge_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).withColumn("value_lc", F.lower("value"))
    samples = rows.where("status = 'candidate'").select("indicator_type", "value_lc", F.col("article_url").alias("sha256"), F.col("publisher").alias("integration"), F.col("seen_at").alias("first_seen_at"))
    feeds = rows.where("status = 'rejected'").select("indicator_type", "value_lc", F.col("publisher").alias("source"), F.col("reason").alias("threat_type"), F.col("seen_at").alias("last_seen"))
    return corpus.merge_sides(rows.where("status = 'confirmed'"), samples, feeds).select("indicator_type", "value_lc", "action", "news_first", "n_samples", "least_sha256", "n_listings", "last_seen")


_MERGED_FEED = f"""WITH c AS ({FEED_STORED}), i AS (SELECT * FROM ({FEED_READ}) r WHERE source IN ({FEED_ANSWERED})), a AS ({FEED_ANSWERED}), full_ AS (SELECT DISTINCT source FROM i),
j AS (SELECT coalesce(c.source, i.source) AS source, coalesce(c.indicator_type, i.indicator_type) AS indicator_type, coalesce(c.value, i.value) AS value, c.value AS cv, i.value AS iv,
  c.threat_type AS ct, i.threat_type AS it, c.malware AS cm, i.malware AS im, c.confidence AS cc, i.confidence AS ic, c.port AS cp, i.port AS ip, c.first_seen AS cf, i.first_seen AS if_, c.last_seen AS cl, i.last_seen AS il
  FROM c FULL JOIN i ON c.source = i.source AND c.value = i.value),
k AS (SELECT *, CASE WHEN cv IS NULL THEN 'insert'
  WHEN iv IS NULL THEN CASE WHEN source IN (SELECT source FROM a) AND (source = 'feodo' OR source = 'et_compromised' AND source IN (SELECT source FROM full_)) THEN 'delist' ELSE 'keep' END
  WHEN source = 'et_compromised' OR (ct IS NOT DISTINCT FROM it AND cl IS NOT DISTINCT FROM il AND cm IS NOT DISTINCT FROM im AND cc IS NOT DISTINCT FROM ic AND cp IS NOT DISTINCT FROM ip) THEN 'keep' ELSE 'update' END AS change FROM j),
r AS (SELECT source, indicator_type, value, CASE WHEN change IN ('insert', 'update') THEN it ELSE ct END AS threat_type, CASE WHEN change IN ('insert', 'update') THEN im ELSE cm END AS malware,
  CASE WHEN change IN ('insert', 'update') THEN ic ELSE cc END AS confidence, CASE WHEN change IN ('insert', 'update') THEN ip ELSE cp END AS port, CASE WHEN change IN ('insert', 'update') THEN if_ ELSE cf END AS first_seen,
  CASE WHEN change IN ('insert', 'update') THEN il ELSE cl END AS last_seen, change FROM k WHERE change != 'delist')
SELECT * FROM r WHERE source != 'threatfox' OR coalesce(last_seen, first_seen) >= DATE '2024-02-10' - 30"""


@query(_MERGED_FEED)
def merge_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, read, ok = (view(spark, sf_dir, sql, "supplier") for sql in (FEED_STORED, FEED_READ, FEED_ANSWERED))
    return corpus.merge_feed(stored, read, ok, F.lit("2024-02-10").cast("date"))


@query("SELECT * EXCLUDE (change) FROM (" + _MERGED_FEED + ") m")
def committed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows are committed, then what the feeds list; the batch that comes twice counts once."""
    stored, read, ok = (view(spark, sf_dir, sql, "supplier") for sql in (FEED_STORED, FEED_READ, FEED_ANSWERED))
    store = Store(spark, scratch(spark, "store"))
    store.commit({state.FEED: stored})
    for _ in range(2):
        state.advance_feed(store, read, ok, F.lit("2024-02-10").cast("date"), ("feeds", 1))
    return store.read(state.FEED)


_DAYS = "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS report_date FROM events"


@query(f"""SELECT event_id, CASE WHEN user_id % 7 = 0 AND extract(day FROM report_date) % 2 = 0 THEN 'again' ELSE event_type END AS event_type, report_date
FROM ({_DAYS}) d WHERE extract(day FROM report_date) % 2 = 1 OR user_id % 7 = 0""")
def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second day is written anew, from fewer rows; the others stay as they were."""
    rows = view(spark, sf_dir, _DAYS, "events")
    store = Store(spark, scratch(spark, "store"))
    state.replace_days(store, rows.select("event_id", "event_type", "report_date"))
    again = rows.where(F.expr("user_id % 7 = 0 AND day(report_date) % 2 = 0"))
    state.replace_days(store, again.select("event_id", F.lit("again").alias("event_type"), "report_date"))
    return store.read(state.DAYS)


@query(S + """SELECT publisher, seq, value, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY publisher ORDER BY reading DESC, seq) AS rank FROM s) WHERE rank <= 5""")
def top_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir)
    return corpus.top_k(rows, "publisher", [F.desc("reading"), F.asc("seq")]).select("publisher", "seq", "value", "rank")


@query("""WITH c AS (SELECT 'u' || (user_id % 3) AS token, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1, 2)
SELECT token, CAST(minute AS DATE) AS day, CAST(sum(n) AS BIGINT) AS n_calls, CAST(sum(greatest(n - 1, 0)) + greatest(sum(n) - sum(greatest(n - 1, 0)) - 100, 0) AS BIGINT) AS n_refused, sum(n) >= 0.8 * 100 AS alert FROM c GROUP BY 1, 2""")
def call_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = read_table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id") % 3).alias("token"), "ts")
    limits = calls.select("token").distinct().withColumns({"per_minute": F.lit(1), "per_day": F.lit(100)})
    return corpus.call_usage(calls, limits)


@query(S + "SELECT max(report_date) AS newest, count(*) AS total, CAST(DATE '2024-02-01' - max(report_date) AS INT) AS days_behind, CASE WHEN count(*) = 0 THEN 'empty' WHEN DATE '2024-02-01' <= max(report_date) THEN 'current' ELSE 'behind' END AS state FROM (SELECT DISTINCT report_date FROM s)")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.freshness(sightings(spark, sf_dir).select("report_date").distinct(), F.lit("2024-02-01").cast("date"))


@query(S + """, m AS (SELECT report_date, seq, value, action FROM s WHERE status = 'confirmed' AND contains(lower(value || ' ' || publisher), 'h1') AND action = 'block' AND report_date >= DATE '2024-01-03'),
x AS (SELECT *, row_number() OVER (ORDER BY report_date DESC, seq) AS k, count(*) OVER () > 50 AS truncated FROM m)
SELECT report_date, seq, value, action, truncated FROM x WHERE k <= 50""")
def search_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).withColumnRenamed("publisher", "source")
    return report.search_iocs(rows, "H1", action="block", since="2024-01-03").select("report_date", "seq", "value", "action", "truncated")


@query(S + """, p AS (SELECT publisher, user_id, indicator_type, value, reading, seq FROM s)
SELECT publisher, indicator_type, value, reading, seq FROM (SELECT *, row_number() OVER (PARTITION BY publisher, indicator_type, lower(value) ORDER BY reading DESC, seq) AS k FROM p) WHERE k = 1""")
def strongest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).select(F.col("publisher").alias("sha256"), "indicator_type", "value", F.col("reading").alias("confidence"), "seq")
    return corpus.strongest_reading(rows).select(F.col("sha256").alias("publisher"), "indicator_type", "value", F.col("confidence").alias("reading"), "seq")


@query(r"""SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])(utm_[a-z]+|fbclid|gclid)=[^&]*', '\1', 'g'), '[?&]+$', ''), '/+$', '') AS canonical FROM pages""")
def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", urls.url_host(F.col("url")).alias("host"), urls.canonical_url(F.col("url")).alias("canonical"))


@query(r"""WITH h AS (SELECT DISTINCT regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host FROM pages),
x AS (SELECT host, string_split(host, '.') AS l, CASE WHEN host LIKE '%example.net' THEN 2 ELSE 1 END AS d FROM h)
SELECT host, d AS suffix_labels, CASE WHEN len(l) > d THEN array_to_string(l[-(d + 1):], '.') ELSE '' END AS apex FROM x""")
def registrable_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = read_table(spark, sf_dir, "pages").select(urls.url_host(F.col("url")).alias("host")).distinct()
    psl = spark.createDataFrame(PSL, "rule string, kind string")
    found = matching.public_suffix_depth(hosts, "host", psl)
    return found.select("host", "suffix_labels", matching.registrable(F.col("host"), F.col("suffix_labels")).alias("apex"))


def _corpus_of_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(observables, corpus, excluded): all page URLs against the hosts of every third page; hosts of pages divisible by 50 are excluded."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", urls.url_host(F.col("url")).alias("host"))
    asked = pages.select(F.col("page_id").alias("input_index"), F.col("url").alias("value"), F.lit(None).cast("string").alias("type_supplied"))
    known = pages.where("page_id % 3 = 0").select(F.regexp_replace("host", r"^(m|blog)\.", "").alias("value_lc"), F.lit("domain").alias("indicator_type"), F.lit(None).cast("string").alias("benign_basis")).distinct()
    return asked, known, pages.where("page_id % 50 = 0").select(F.col("host").alias("value_lc")).distinct()


_VERDICT_SQL = r"""WITH p AS (SELECT page_id, url, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host FROM pages),
k AS (SELECT DISTINCT regexp_replace(host, '^(m|blog)\.', '') AS v FROM p WHERE page_id % 3 = 0), x AS (SELECT DISTINCT host AS v FROM p WHERE page_id % 50 = 0),
b AS (SELECT page_id, url, CASE WHEN host IN (SELECT v FROM k) THEN 3 WHEN host IN (SELECT v FROM x) THEN 4
  WHEN regexp_replace(host, '^[^.]+\.', '') IN (SELECT v FROM k) AND len(string_split(host, '.')) > 3 THEN 5 ELSE 9 END AS r, host FROM p),
v AS (SELECT page_id AS input_index, CASE r WHEN 3 THEN 'hit' WHEN 5 THEN 'hit' WHEN 4 THEN 'excluded' ELSE 'miss' END AS status,
  CASE r WHEN 3 THEN 'same_host' WHEN 4 THEN 'excluded_host' WHEN 5 THEN 'parent_domain' END AS match_method FROM b)
"""


@query(_VERDICT_SQL + "SELECT * FROM v")
def validate_observables(spark: SparkSession, sf_dir: str) -> DataFrame:
    psl = spark.createDataFrame(PSL, "rule string, kind string")
    return matching.match_observables(*_corpus_of_pages(spark, sf_dir), psl).select("input_index", "status", "match_method")


@query(_VERDICT_SQL + """SELECT 'url' AS type_used, count(*) AS n, 0 AS n_skipped, count(*) FILTER (status = 'hit') AS n_hits, count(*) FILTER (status = 'hit') AS n_headline,
count(*) FILTER (status = 'excluded') AS n_excluded, count(*) FILTER (status = 'miss') AS n_unseen, round(count(*) FILTER (status = 'hit') / count(*), 4) AS headline_rate FROM v""")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    psl = spark.createDataFrame(PSL, "rule string, kind string")
    return matching.validation_summary(matching.match_observables(*_corpus_of_pages(spark, sf_dir), psl))


@query(r"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})\b')) AS raw FROM documents)
SELECT doc_id, lower(raw) AS value, CASE length(raw) WHEN 32 THEN 'md5' WHEN 40 THEN 'sha1' ELSE 'sha256' END AS indicator_type FROM h""")
def document_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    raw = docs.where(F.col("text").rlike("[0-9a-fA-F]{32}")).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(extract.PATTERNS[1][1]), F.lit(0))).alias("raw"))
    return raw.select("doc_id", F.lower("raw").alias("value"), urls.hash_type(F.col("raw")).alias("indicator_type"))


@query()
def extract_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of all documents; they are dealt over tasks before they are read, as a file may hold them in one row group."""
    return extract.extract_evidence(spread(articles(spark, sf_dir), "doc_id", "body"), TLDS)


@query(r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b')) AS ip FROM documents),
n AS (SELECT doc_id, ip, string_split(ip, '.') AS p FROM w),
v AS (SELECT doc_id, ip, CAST(p[1] AS BIGINT) AS a, CAST(p[2] AS BIGINT) AS b, CAST(p[3] AS BIGINT) AS c, CAST(p[4] AS BIGINT) AS d FROM n)
SELECT doc_id, ip, a * 16777216 + b * 65536 + c * 256 + d AS n,
  NOT (a IN (0, 10, 127) OR a >= 240 OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 169 AND b = 254) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 0 AND c IN (0, 2)) OR (a = 192 AND b = 168)
    OR (a = 198 AND b IN (18, 19)) OR (a = 198 AND b = 51 AND c = 100) OR (a = 203 AND b = 0 AND c = 113)) AS is_global
FROM v WHERE a < 256 AND b < 256 AND c < 256 AND d < 256 AND ip = a || '.' || b || '.' || c || '.' || d""")
def document_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"), F.lit(0))).alias("ip"))
    return raw.select("doc_id", "ip", urls.ipv4_to_long(F.col("ip")).alias("n"), urls.is_global_ip(F.col("ip")).alias("is_global")).where("n IS NOT NULL")


@query((S + """, c AS (SELECT DISTINCT report_date AS d, article_url AS a, value AS v FROM s WHERE status = 'confirmed' AND indicator_type = 'cve'),
e AS (SELECT DISTINCT x.d, x.a, y.a AS b FROM c x JOIN c y USING (d, v)),
r AS (SELECT d, a, b FROM e UNION SELECT r.d, r.a, e.b FROM r JOIN e ON r.d = e.d AND r.b = e.a),
m AS (SELECT d, a, min(b) AS g FROM r GROUP BY 1, 2),
g AS (SELECT d, g, list_sort(list(DISTINCT v)) AS cves, list_sort(list(DISTINCT a)) AS article_urls FROM m JOIN c USING (d, a) GROUP BY 1, 2)
SELECT d AS report_date, left(sha256(array_to_string(cves, chr(10))), 16) AS cluster_id, CASE WHEN len(cves) > 1 THEN cves[1] || ' 等 ' || len(cves) || ' 個 CVE' ELSE cves[1] END AS label,
  array_to_string(cves, ' ') AS cves, array_to_string(article_urls, ' ') AS article_urls, CAST(len(article_urls) AS INT) AS n_articles FROM g WHERE len(article_urls) >= 2""").replace("WITH s AS", "WITH RECURSIVE s AS"))
def event_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of a day joined by shared confirmed CVEs, one cluster of two articles or more a row; id and label as the reference names them."""
    rows = sightings(spark, sf_dir).where("status = 'confirmed' AND indicator_type = 'cve'").select("report_date", "article_url", "value").distinct()
    of_day = lambda kind, c: F.concat(F.col("report_date").cast("string"), F.lit(f" {kind} "), F.col(c))  # noqa: E731  days never meet
    rows = rows.select("report_date", "article_url", "value", of_day("article", "article_url").alias("id"), of_day("cve", "value").alias("v"))
    members = connected_components(rows.select(F.col("id").alias("u"), "v"))
    found = rows.join(members, "id").groupBy("report_date", "component").agg(
        F.sort_array(F.collect_set("value")).alias("cves"), F.sort_array(F.collect_set("article_url")).alias("article_urls")).where("size(article_urls) >= 2")
    n, first = F.size("cves"), F.get("cves", F.lit(0))
    return found.select(
        "report_date", F.substring(F.sha2(F.array_join("cves", "\n"), 256), 1, 16).alias("cluster_id"), F.when(n > 1, F.concat(first, F.lit(" 等 "), n, F.lit(" 個 CVE"))).otherwise(first).alias("label"),
        F.array_join("cves", " ").alias("cves"), F.array_join("article_urls", " ").alias("article_urls"), F.size("article_urls").alias("n_articles"))


@query(r"""WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS h FROM pages),
p AS (SELECT page_id, list_filter(string_split(regexp_replace(h, '<(/?)(h[1-6]|p|li|pre|blockquote|tr)\b[^>]*>', chr(1) || '\1\2' || chr(2), 'g'), chr(1))[2:], lambda x: NOT starts_with(x, '/')) AS ps FROM a),
t AS (SELECT page_id, list_transform(ps, lambda x: [string_split(x, chr(2))[1], trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(string_split(x, chr(2))[2], '<[^>]*>', ' ', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\n]+', ' ', 'g'))]) AS ts FROM p),
b AS (SELECT page_id, list_transform(list_filter(ts, lambda y: y[2] != ''), lambda y: CASE WHEN y[1] LIKE 'h_' THEN '## ' ELSE '' END || y[2]) AS bs FROM t),
c AS (SELECT page_id, array_to_string(list_filter(bs, lambda z, i: i = 1 OR z != bs[i - 1]), chr(10)) AS body FROM b)
SELECT page_id, CASE WHEN length(body) >= 500 THEN 'semantic-selector:article' ELSE 'failed' END AS method, CASE WHEN length(body) >= 500 THEN body ELSE '' END AS body FROM c""")
def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").withColumn("title", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1))
    return html.choose_body(pages).select("page_id", "method", "body")


@query("""SELECT event_id, CAST(ts + INTERVAL 8 HOUR - INTERVAL 6 HOUR AS DATE) AS slot_day FROM events""")
def report_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select("event_id", dates.slot_date(F.col("ts").cast("timestamp")).alias("slot_day"))


@query(S + """, d AS (SELECT publisher, max(seen_at) AS newest FROM s GROUP BY 1), c AS (SELECT publisher, max(seen_at) AS collected FROM s WHERE status = 'confirmed' GROUP BY 1)
SELECT publisher, collected IS NULL OR newest > collected AS missed FROM d LEFT JOIN c USING (publisher)""")
def missed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = sightings(spark, sf_dir).select(F.col("publisher").alias("source"), F.col("seen_at").alias("published_at"), "status")
    return report.missed_sources(entries, entries.where("status = 'confirmed'")).select(F.col("source").alias("publisher"), "missed")


@query(S + """, h AS (SELECT sha256(concat_ws(chr(31), CAST(seq AS VARCHAR), CAST(report_date AS VARCHAR), value, status)) AS h FROM s),
p AS (SELECT left(h, 4) AS p, sha256(string_agg(h, '' ORDER BY h)) AS d FROM h GROUP BY 1) SELECT sha256(string_agg(p || d, '' ORDER BY p || d)) AS version FROM p""")
def corpus_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.content_version(sightings(spark, sf_dir), ["seq", "report_date", "value", "status"])


@query(S + """, l AS (SELECT article_url, indicator_type, value, status, row_number() OVER (PARTITION BY article_url, indicator_type, value, status ORDER BY seq) AS k, seq FROM s)
SELECT article_url, indicator_type, value, status, seq FROM l WHERE k = 1""")
def first_per_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).select(F.col("article_url").alias("url"), "indicator_type", F.col("value").alias("normalized_value"), "status", F.col("seq").alias("line_number"), F.lit(0).alias("column_start"))
    return extract.first_per_article(rows).select(F.col("url").alias("article_url"), "indicator_type", F.col("normalized_value").alias("value"), "status", F.col("line_number").alias("seq"))


@query("""SELECT doc_id, n_lines FROM (SELECT doc_id, len(string_split(text, chr(10))) - CASE WHEN text = '' OR ends_with(text, chr(10)) THEN 1 ELSE 0 END AS n_lines FROM documents)""")
def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", F.size(text.body_lines(F.col("text"))).cast("long").alias("n_lines"))


@query(r"""WITH h AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host FROM pages)
SELECT page_id, CASE WHEN ends_with(host, 'blog.tionble.example.com') THEN 'first' WHEN ends_with(host, 'example.com') THEN 'com' WHEN ends_with(host, 'example.net') THEN 'net' END AS source_key FROM h""")
def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([("first", "blog.tionble.example.com", 1), ("com", "example.com", 2), ("net", "example.net", 3)], "source_key string, host string, pos int")
    pages = read_table(spark, sf_dir, "pages").select("page_id", urls.url_host(F.col("url")).alias("h"))
    return analyst.source_for_url(pages, "h", registry).select("page_id", "source_key")


_HOSTS = """
SELECT 'https://news.example.org/' || (event_id - event_id % 8) AS url, 'confirmed' AS status, CASE WHEN event_id % 3 = 0 THEN 'domain' ELSE 'url' END AS indicator_type,
  CASE WHEN event_id % 3 = 0 THEN h ELSE 'https://' || h || '/x' END AS normalized_value, h
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'cdn.' ELSE 'a.b.' END || CASE user_id % 4 WHEN 0 THEN 'ab' WHEN 1 THEN 'abcd' WHEN 2 THEN 'x1z' ELSE 'it' END || '.com' AS h FROM events) e"""


@query(f"""WITH h AS ({_HOSTS})
SELECT DISTINCT p.url, p.h AS value FROM h p JOIN h c ON p.url = c.url AND ends_with(c.h, '.' || p.h) WHERE length(p.h) - length(replace(p.h, '.', '')) = 1 AND length(split_part(p.h, '.', 1)) <= 3""")
def short_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short hosts with a host beneath them in the same article, whether a domain or a URL names them."""
    return analyst.short_parents(view(spark, sf_dir, _HOSTS, "events").drop("h"))


_SIX_SQL = """
SELECT event_id, user_id % 300 AS n, CASE event_id % 4
  WHEN 0 THEN '2001:4860:4860:0:0:0:0:' || lower(hex(user_id % 300)) WHEN 1 THEN '2001:4860:4860::' || lower(hex(user_id % 300))
  WHEN 2 THEN '2001:4860:4860:0000::' || hex(user_id % 300) ELSE '10.0.' || (user_id % 300 // 256) || '.' || (user_id % 300 % 256) END AS value, event_id % 4 AS k
FROM events"""


@query(f"""SELECT event_id, CASE WHEN k = 3 THEN '10.0.' || (n // 256) || '.' || (n % 256) WHEN n = 0 THEN '2001:4860:4860::' ELSE '2001:4860:4860::' || lower(hex(n)) END AS bare,
  CASE WHEN k = 3 THEN n = 7 ELSE n IN (136, 68) END AS resolver FROM ({_SIX_SQL}) x""")
def resolver_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses meet the list of resolvers whatever form each is written in."""
    rows = view(spark, sf_dir, _SIX_SQL.replace("//", "DIV"), "events")
    listed = spark.sql("SELECT * FROM VALUES ('2001:4860:4860:0:0::88'), ('2001:4860:4860::0044'), ('10.0.0.7') AS t(value)")
    none = F.lit(None).cast("string")
    rows = rows.withColumn("bare", analyst.bare_target(none, F.col("value")))
    met = analyst.host_suffix_semi(rows, "bare", listed.select(analyst.bare_target(none, F.col("value")).alias("host")), "resolver")
    return met.select("event_id", "bare", "resolver")
