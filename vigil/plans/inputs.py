"""Views of the supplied tables in the shapes that the operators take. Each is one SQL text, so that a checker can run the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.sources.tables import read_table

#: Sightings of indicators, one an event.
SIGHTINGS = """
SELECT event_id AS seq, CAST(ts AS DATE) AS report_date, ts AS seen_at,
  CASE event_id % 4 WHEN 0 THEN 'domain' WHEN 1 THEN 'ip' WHEN 2 THEN 'cve' ELSE 'filename' END AS indicator_type,
  CASE event_id % 4 WHEN 0 THEN 'H' || user_id || '.Example.com' WHEN 1 THEN '198.18.' || (user_id % 100) || '.' || (user_id % 7)
    WHEN 2 THEN 'CVE-2024-' || (1000 + user_id) ELSE 'Drop' || user_id || '.exe' END AS value,
  CASE event_type WHEN 'error' THEN 'rejected' WHEN 'view' THEN 'candidate' ELSE 'confirmed' END AS status,
  CASE event_type WHEN 'purchase' THEN 'patch' WHEN 'click' THEN 'block' WHEN 'signup' THEN 'hunt' END AS action,
  CASE event_id % 3 WHEN 0 THEN 'publisher_domain' WHEN 1 THEN 'non_public_ip' ELSE 'excluded_editorial_section' END AS reason,
  'src' || (event_id % 20) AS publisher, 'https://news.example.org/' || (event_id % 500) AS article_url,
  user_id, value AS reading
FROM events"""

#: Actions of a day: one a confirmed CVE sighting.
ACTIONS = f"""
SELECT report_date, seq, action, user_id % 17 = 0 AS kev,
  CASE user_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS priority,
  CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(user_id % 11 AS DOUBLE) END AS cvss,
  CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(user_id % 13 AS DOUBLE) / 16 END AS epss,
  CASE WHEN user_id % 2 = 0 THEN '2024-02-0' || (1 + user_id % 9) END AS due_date, value AS target
FROM ({SIGHTINGS}) s WHERE status = 'confirmed' AND indicator_type IN ('cve', 'domain')"""

#: Blocklist rows now stored, and those of the newest read (other days, other threats, some gone). One list is read without an answer.
_FEED = """
SELECT CASE s_nationkey % 3 WHEN 0 THEN 'threatfox' WHEN 1 THEN 'feodo' ELSE 'et_compromised' END AS source, 'domain' AS indicator_type, 'h' || {key} || '.example.net' AS value,
  {threat} AS threat_type, 'family' || (s_suppkey % 5) AS malware, CAST(75 + s_suppkey % 20 AS INT) AS confidence, CAST(443 AS INT) AS port,
  CAST('2024-01-01' AS DATE) + CAST(s_suppkey % 20 AS INT) AS first_seen, CAST({last} AS DATE) + CAST({key} % 40 AS INT) AS last_seen
FROM supplier"""
FEED_STORED = _FEED.format(key="s_suppkey", threat="'botnet'", last="'2024-01-05'")
FEED_READ = _FEED.format(key="(s_suppkey + 10)", threat="CASE WHEN s_suppkey % 3 = 0 THEN 'phishing' ELSE 'botnet' END", last="'2024-01-05'") + " WHERE s_suppkey % 5 != 0 AND s_nationkey % 3 != 1"
FEED_ANSWERED = "SELECT DISTINCT CASE s_nationkey % 3 WHEN 0 THEN 'threatfox' ELSE 'et_compromised' END AS source FROM supplier WHERE s_nationkey % 3 != 1"


def view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """The rows of ``sql`` over the named tables."""
    for name in tables:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SIGHTINGS, "events")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: url, body, publisher, publisher_hosts."""
    return view(spark, sf_dir, """
SELECT doc_id, 'https://' || source || '.example.org/' || doc_id AS url, text AS body, source AS publisher, array(source || '.example.org') AS publisher_hosts
FROM documents""", "documents")
