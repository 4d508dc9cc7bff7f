"""Extraction from long lines and bodies of many headings: every match counts, and time grows in proportion."""

import time

from pyspark.sql import functions as F

from vigil.functions import text
from vigil.operators import extract
from vigil.plans.queries import TLDS
from vigil.plans.registry import QUERIES

SCHEMA = "url string, body string, publisher_hosts array<string>"


def evidence(spark, body):
    return extract.extract_evidence(spark.createDataFrame([("u", body, ["n.org"])], SCHEMA), TLDS)


def timed(spark, body):
    began = time.time()
    return evidence(spark, body).count(), time.time() - began


def test_one_line_of_very_many_addresses(spark):
    line = lambda n: " ".join(f"45.{k // 65536 % 256}.{k // 256 % 256}.{k % 256}" for k in range(n))
    assert timed(spark, line(100))[0] == 100
    few, many = timed(spark, line(5_000)), timed(spark, line(50_000))
    assert few[0] == 5_000 and many[0] == 50_000 and many[1] < 20 * few[1] + 5


def test_very_many_headed_lines(spark):
    body = lambda n: "\n".join(f"## Part {k}\nseen at h{k}.evil.com" if k % 2 else f"## IoCs\n8.8.{k // 256 % 256}.{k % 256}" for k in range(n))
    few, many = timed(spark, body(3_200)), timed(spark, body(32_000))
    assert few[0] == 3_200 and many[0] == 32_000 and many[1] < 20 * few[1] + 5
    rows = evidence(spark, body(4)).orderBy("line_number").collect()
    assert [(r.section, r.status, r.context) for r in rows][:2] == [("## IoCs", "confirmed", "## IoCs\n8.8.0.0\n## Part 1"), ("## Part 1", "candidate", "## Part 1\nseen at h1.evil.com\n## IoCs")]


def test_windows_of_many_values(spark):
    body = "\n".join(f"CVE-2024-{10000 + k} was seen\nCVSS: {k % 10}.5\n" for k in range(3_000))
    articles = spark.createDataFrame([("u", body, ["n.org"]), ("v", None, [])], SCHEMA)
    found = extract.local_windows(extract.extract_evidence(articles, TLDS), articles)
    windows = {r.normalized_value: r.window for r in found.collect()}
    assert len(windows) == 3_000 and windows["CVE-2024-10007"] == "CVE-2024-10007 was seen\nCVSS: 7.5"


def test_written_articles_keep_their_partitions(spark, tmp_path):
    """Extraction reads a few small articles in as many tasks as the session has, though Spark would merge their partitions."""
    from vigil.plans import findings

    rows = [(e, e % 5, "click") for e in range(200)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = findings.written_articles(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and found.count() == 25


def test_headings_are_normalized_once_and_only_where_their_first_word_fits(spark):
    given = ["Indicators of Compromise (IoCs):", "  ## IOCs", "**I_oC**", "(iocs) Domains", "file indicator", "Network Indicators", "Hashes", "IP addresses", "惡意網域清單", "網路指標", "IP位址",
             "Related  articles", "latest news", "Learn more", "additional resources -", "References", "recommended", "More from us", "you may also like", "相關文章", "更多消息：",
             "Mitigations", "Recommendation", "Conclusion", "summary *", "Detections", "Advanced hunting queries", "Acknowledgements", "緩解措施", "偵測",
             "hashes of 8.8.8.8", "A plain line", "", None, "### ## IOCs"]
    rows = spark.createDataFrame([(v,) for v in given], "v string")
    said = F.col("n")
    plain = F.when(said.rlike(text.IOC_HEADINGS), "ioc").when(said.rlike(text.EXCLUDED_HEADINGS), "excluded").when(said.rlike(text.END_HEADINGS), "end")
    got = rows.withColumn("n", text.normalize_heading(F.col("v"))).select(text.heading_kind(F.col("v")).alias("kind"), plain.alias("plain")).collect()
    assert [r["kind"] for r in got] == [r["plain"] for r in got] == ["ioc"] * 11 + ["excluded"] * 10 + ["end"] * 9 + [None] * 5
    plan = rows.select(text.heading_kind(F.col("v")).alias("kind"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract") == 1


def test_signs_of_lines(spark):
    lines = ["a RAT named Foobar", "rate of operation", "the APT group called Foobar", "T1059 ATT&CK", "勒索軟體名為 Foobar", "Foobar Stealer", "nothing", "cVe-2024-1234", "hxxp://a.b/c", "x[.]com", "ab" * 16, "2001:db8::1", "x\rFoobar ransomware\u2028y"]
    rows = extract.line_matches(extract.lines_of(spark.createDataFrame([(str(i), x, ["n.org"]) for i, x in enumerate(lines)], SCHEMA))).orderBy(F.col("url").cast("int"), "ln")
    got = [(r["url"], r["found"] is not None, r["claims"] is not None) for r in rows.collect()]
    flags = ["ny", "nn", "ny", "ny", "ny", "ny", "nn", "yn", "yn", "yn", "yn", "yn", "nn", "ny", "nn"]
    assert [("y" if a else "n") + ("y" if b else "n") for _, a, b in got] == flags


def test_documents_of_one_row_group_are_dealt_over_tasks(spark):
    found = QUERIES["extract_evidence"](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
