"""Articles with findings, made from the supplied events; every view is SQL that Spark and a checker both run.

Eight events make an article. Each is a finding: a value, named by the publisher as confirmed, in passing, or under related articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.plans.inputs import view
from vigil.plans.materialize import spread

_BASE = "SELECT event_id AS seq, user_id AS u, event_id - event_id % 8 AS article, event_id % 6 AS k, event_type FROM events"
_NAMED = f"""
SELECT seq, u, k, event_type, article, CAST('2024-01-01' AS DATE) + CAST(article % 240 / 8 AS INT) AS report_date, 'https://news.example.org/' || article AS url,
  'src' || (CAST(article / 8 AS BIGINT) % 20) AS source,
  CASE WHEN article % 40 = 0 THEN 'Ransomware wave ' WHEN article % 40 = 8 THEN 'Data breach at shop ' ELSE 'Notes ' END || article AS title, article % 88 = 0 AS missing
FROM ({_BASE}) b"""

#: One row a report day and article.
ARTICLES = f"SELECT DISTINCT article, report_date, url, source, title, missing, CAST(report_date AS TIMESTAMP) AS published_at FROM ({_NAMED}) n"

#: One row a finding of the articles that could be read.
FINDINGS = f"""
SELECT seq, u, article, report_date, url, source, title,
  CASE k WHEN 0 THEN 'cve' WHEN 1 THEN 'domain' WHEN 2 THEN 'ip' WHEN 3 THEN 'sha256' WHEN 4 THEN 'filename' ELSE 'url' END AS indicator_type,
  CASE k WHEN 0 THEN 'CVE-2024-' || (1000 + u) WHEN 1 THEN CASE WHEN u % 10 = 1 THEN '' ELSE 'h' || u || '.' END || 'badhost' || (u % 9) || '.com'
    WHEN 2 THEN '45.77.' || (u % 200) || '.' || (1 + u % 7) WHEN 3 THEN repeat('ab', 30) || right('000' || u, 4) WHEN 4 THEN 'drop' || u || '.exe' ELSE 'http://w' || u || '.badsite.org/p' END AS value,
  CASE WHEN event_type = 'error' THEN 'rejected' WHEN k = 0 THEN 'confirmed' WHEN event_type = 'view' THEN 'candidate' ELSE 'confirmed' END AS status,
  CASE WHEN k = 1 AND u % 9 = 3 THEN 'vendor_brand_apex' WHEN k = 1 AND u % 10 = 1 AND u % 9 = 5 THEN 'domain_boundary_rule' END AS benign_basis
FROM ({_NAMED}) n WHERE NOT missing"""

#: What the catalogues know of each CVE.
INTEL = """
SELECT DISTINCT 'CVE-2024-' || (1000 + user_id) AS cve_id, user_id % 17 = 0 AS kev, CASE WHEN user_id % 17 = 0 THEN '2024-02-0' || (1 + user_id % 9) END AS kev_due_date,
  CASE WHEN user_id % 5 != 0 THEN CAST(user_id % 11 AS DOUBLE) END AS cvss_score,
  CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 11 >= 9 THEN 'CRITICAL' WHEN user_id % 11 >= 7 THEN 'HIGH' WHEN user_id % 11 >= 4 THEN 'MEDIUM' WHEN user_id % 11 > 0 THEN 'LOW' ELSE 'NONE' END AS cvss_severity,
  CASE WHEN user_id % 7 != 0 THEN CAST(user_id % 13 AS DOUBLE) / 16 END AS epss_score
FROM events"""

#: Rules that hold values back: vendors' hosts, and public suffixes besides the plain ones.
BRANDS = "SELECT 'badhost3.com' AS host"
PSL = """
SELECT 'com' AS rule, 'normal' AS kind UNION ALL SELECT 'net', 'normal' UNION ALL SELECT 'org', 'normal' UNION ALL SELECT 'badhost5.com', 'normal'
UNION ALL SELECT 'co.uk', 'normal' UNION ALL SELECT 'uk', 'normal' UNION ALL SELECT 'ck', 'wildcard' UNION ALL SELECT 'www.ck', 'exception'"""
RESOLVERS = "SELECT '8.8.8.8' AS value UNION ALL SELECT '1.1.1.1' UNION ALL SELECT 'dns.google'"

#: Distinct confirmed values of each article that something is done about, with the action that the rules give.
BOARD = f"""
WITH f AS ({FINDINGS}), c AS (
  SELECT url, article, report_date, title, indicator_type, value, u, benign_basis, min(seq) AS first_seq FROM f WHERE status = 'confirmed' GROUP BY url, article, report_date, title, indicator_type, value, u, benign_basis),
j AS (SELECT c.*, i.kev, i.cvss_score, i.cvss_severity, i.epss_score, CASE WHEN indicator_type = 'cve' AND u % 3 = 0 THEN u % 10 + 0.5 END AS told FROM c LEFT JOIN ({INTEL}) i ON c.indicator_type = 'cve' AND c.value = i.cve_id)
SELECT url, article, report_date, CASE WHEN indicator_type = 'cve' THEN 'patch' WHEN indicator_type IN ('ip', 'domain', 'url') AND benign_basis IS NULL THEN 'block' ELSE 'hunt' END AS action,
  CASE WHEN indicator_type = 'cve' THEN CASE WHEN kev OR coalesce(cvss_score, 0) >= 9 OR coalesce(told, 0) >= 9 OR u % 4 = 0 THEN 'high' ELSE 'medium' END
    WHEN benign_basis IS NOT NULL THEN 'low' WHEN article % 40 = 0 THEN 'high' ELSE 'medium' END AS priority,
  indicator_type AS target_type, value AS target, CASE WHEN benign_basis IS NOT NULL THEN benign_basis WHEN indicator_type != 'cve' THEN 'publisher_indicator' WHEN kev THEN 'kev_listed'
    WHEN cvss_score IS NOT NULL THEN 'cvss_' || lower(cvss_severity) ELSE 'cve_reported' END AS reason_code, benign_basis, kev, cvss_score, epss_score, CASE WHEN indicator_type = 'cve' THEN 0 ELSE 1 END AS part, first_seq
FROM j"""
#: The same with one row for each article that has no such value.
ACTIONS = f"""
SELECT url, report_date, action, priority, target_type, target, reason_code, benign_basis, kev, cvss_score, epss_score, part, first_seq FROM ({BOARD}) b
UNION ALL SELECT url, report_date, CASE WHEN missing THEN 'review' WHEN article % 40 = 8 THEN 'monitor' ELSE 'observe' END, CASE WHEN missing OR article % 40 = 8 THEN 'medium' ELSE 'low' END, 'article', title,
  CASE WHEN missing THEN 'forbidden' WHEN article % 40 = 8 THEN 'data_breach' ELSE 'ransomware' END, NULL, NULL, NULL, NULL, 0, 0
FROM ({ARTICLES}) a WHERE url NOT IN (SELECT url FROM ({BOARD}) b) AND (missing OR article % 40 IN (0, 8))"""
#: Actions with their place in their day.
NUMBERED = f"""
WITH n AS (SELECT url, count(DISTINCT CASE WHEN indicator_type = 'cve' THEN value END) AS n_cves, count(DISTINCT CASE WHEN indicator_type != 'filename' THEN value END) AS n_iocs FROM ({FINDINGS}) f WHERE status = 'confirmed' GROUP BY url)
SELECT a.*, row_number() OVER (PARTITION BY report_date ORDER BY coalesce(n_cves, 0) DESC, coalesce(n_iocs, 0) DESC, a.url, part, first_seq) AS seq FROM ({ACTIONS}) a LEFT JOIN n ON a.url = n.url"""

#: Observables of every kind, with what a reader takes them for.
OBSERVABLES = """
SELECT DISTINCT user_id * 10 + event_id % 10 AS input_index, user_id AS u, event_id % 10 AS k,
  CASE event_id % 10 WHEN 0 THEN 'cve-2024-' || (1000 + user_id) WHEN 1 THEN 'a.b.h' || user_id || '.badhost' || (user_id % 9) || '.com' WHEN 2 THEN 'badhost' || (user_id % 9) || '.com'
    WHEN 3 THEN 'http://h' || user_id || '.badhost' || (user_id % 9) || '.com/q' WHEN 4 THEN 'HTTP://W' || user_id || '.badsite.org/p/' WHEN 5 THEN '45[.]77.' || (user_id % 200) || '.' || (1 + user_id % 7)
    WHEN 6 THEN '10.0.0.' || (user_id % 250) WHEN 7 THEN repeat('AB', 30) || right('000' || user_id, 4) WHEN 8 THEN 'none' || user_id || '.example.org' ELSE 'hxxp[:]//w' || user_id || '[.]badsite[.]org/zzz' END AS value
FROM events"""
_PLAIN = f"""
SELECT input_index, value, u, k, CASE k WHEN 0 THEN 'cve' WHEN 3 THEN 'url' WHEN 4 THEN 'url' WHEN 5 THEN 'ip' WHEN 6 THEN 'ip' WHEN 7 THEN 'sha256' WHEN 9 THEN 'url' ELSE 'domain' END AS type,
  CASE k WHEN 4 THEN 'http://w' || u || '.badsite.org/p' WHEN 5 THEN '45.77.' || (u % 200) || '.' || (1 + u % 7) WHEN 9 THEN 'http://w' || u || '.badsite.org/zzz' ELSE lower(value) END AS whole,
  CASE k WHEN 3 THEN 'h' || u || '.badhost' || (u % 9) || '.com' WHEN 4 THEN 'w' || u || '.badsite.org' WHEN 9 THEN 'w' || u || '.badsite.org' WHEN 5 THEN '45.77.' || (u % 200) || '.' || (1 + u % 7) ELSE lower(value) END AS host
FROM ({OBSERVABLES}) o"""
#: Verdict of the news side on each observable, by joins on names (small tables only: names are compared by their endings).
VERDICTS = f"""
WITH f AS ({FINDINGS}), v AS (SELECT lower(value) AS v, indicator_type, max(benign_basis) AS basis FROM f WHERE status = 'confirmed' AND indicator_type != 'filename' GROUP BY 1, 2),
x AS (SELECT DISTINCT lower(value) AS v FROM f WHERE status = 'rejected'), o AS ({_PLAIN}),
m AS (
  SELECT input_index, 1 AS r, 0 AS d, v AS hit, 'exact' AS how FROM o JOIN v ON whole = v
  UNION ALL SELECT input_index, 2, 0, v, 'excluded' FROM o JOIN x ON whole = v
  UNION ALL SELECT input_index, 3, 0, v, 'same_host' FROM o JOIN v ON type = 'url' AND host = v AND basis IS NULL
  UNION ALL SELECT input_index, 4, 0, v, 'excluded_host' FROM o JOIN x ON type = 'url' AND host = v
  UNION ALL SELECT input_index, 5, -length(v), v, 'parent_domain' FROM o JOIN v ON type IN ('url', 'domain') AND ends_with(host, '.' || v) AND basis IS NULL AND v != 'badhost5.com'
  UNION ALL SELECT input_index, 6, 0, min(v), 'child_domain' FROM o JOIN v ON type IN ('url', 'domain') AND ends_with(v, '.' || host) AND basis IS NULL AND indicator_type = 'domain' AND host != 'badhost5.com' GROUP BY input_index),
b AS (SELECT *, row_number() OVER (PARTITION BY input_index ORDER BY r, d, hit) AS n FROM m)
SELECT o.input_index, o.value, o.type, o.u, o.k, o.whole, o.host, b.hit, CASE WHEN o.k = 6 THEN NULL ELSE b.how END AS how,
  CASE WHEN o.k = 6 THEN 'skipped' WHEN b.r IN (2, 4) THEN 'excluded' WHEN b.r IS NOT NULL THEN 'hit' ELSE 'miss' END AS status
FROM o LEFT JOIN b ON o.input_index = b.input_index AND b.n = 1"""


def events_view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return view(spark, sf_dir, sql, "events")


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence columns of the findings, with the article's."""
    rows = events_view(spark, sf_dir, FINDINGS)
    return rows.withColumns({"normalized_value": F.col("value"), "raw_value": F.col("value"), "line_number": F.col("seq"), "column_start": F.lit(1), "publisher": F.col("source"), "article_url": F.col("url"), "article_title": F.col("title"),
                             "reason_codes": F.array(F.lit("excluded_editorial_section"))})


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_view(spark, sf_dir, ARTICLES)


def written_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles with bodies that say what the findings state: CVEs and values in passing first, then the indicator section, then related articles."""
    found = events_view(spark, sf_dir, FINDINGS)
    is_cve = F.col("indicator_type") == "cve"
    said = F.concat("value", F.when(F.col("u") % 4 == 0, " allows remote code execution").otherwise(" was fixed"), F.when(F.col("u") % 3 == 0, F.concat(F.lit(", CVSS "), F.col("u") % 10, F.lit(".5"))).otherwise(""))
    line = F.when(is_cve, said).when(F.col("status") == "candidate", F.concat(F.lit("Seen at "), "value", F.lit(" lately"))).otherwise(F.col("value"))
    part = F.when(F.col("status") == "rejected", 2).when(is_cve | (F.col("status") == "candidate"), 0).otherwise(1)
    lines = found.groupBy("url").agg(F.array_sort(F.collect_list(F.struct(part.alias("part"), "seq", line.alias("line")))).alias("ls"))
    section = lambda k: F.transform(F.filter("ls", lambda x: x["part"] == k), lambda x: x["line"])
    body = F.array_join(F.concat(F.array(F.lit("A report.")), section(0), F.array(F.lit("## Indicators of compromise")), section(1), F.array(F.lit("## Related articles")), section(2)), "\n")
    rows = spread(articles(spark, sf_dir).join(lines, "url", "left"), "url")
    return rows.select("article", "report_date", "url", "source", "title", "published_at", F.when(F.col("missing"), "").otherwise(F.coalesce(body, F.lit("A report."))).alias("body"),
                       F.when(F.col("missing"), F.array(F.lit("HTTP 403 Forbidden"))).alias("warnings"), F.array(F.lit("news.example.org")).alias("publisher_hosts"))
