"""Action rules and the backtest on small cases."""

from pyspark.sql import functions as F

from vigil.operators import analyst, extract
from vigil.plans.queries import TLDS


def psl_of(spark, *more):
    return spark.createDataFrame([(r, "normal") for r in ("com", "org", "net", "io", *more)], "rule string, kind string")


def board(spark, rows, intel=(), resolvers=("8.8.8.8", "dns.google"), brands=("vendor.com",), suffixes=("github.io",)):
    articles = spark.createDataFrame(rows, "url string, title string, body string, warnings array<string>")
    evidence = extract.extract_evidence(articles.selectExpr("*", "array('news.org') AS publisher_hosts"), (*TLDS, "io", "google")).cache()
    known = spark.createDataFrame(list(intel), "cve_id string, kev boolean, cvss_score double, cvss_severity string, epss_score double")
    found = analyst.build_actions(articles, evidence, known, spark.createDataFrame([(x,) for x in resolvers], "value string"), spark.createDataFrame([(x,) for x in brands], "host string"), psl_of(spark, *suffixes))
    return {(r["url"], r["target"]): r for r in found.collect()}


IOC = "## Indicators of compromise\n"


def test_actions(spark):
    got = board(spark, [
        ("u1", "Flaw", "CVE-2024-1111 allows remote code execution, CVSS 7.5\n" + IOC + "8.8.8.8\n5.6.7.8\nabc.com\nx.abc.com\nlogin.vendor.com\ngithub.io\ndns.google\nd41d8cd98f00b204e9800998ecf8427e\n2606:4700:4700::1234", None),
        ("u2", "Phishing campaign hits banks", "nothing to see", None), ("u3", "Plain", "words", None), ("u4", "Gone", "", ["HTTP 403 Forbidden"]), ("u5", "A data breach at a shop", "nothing", None)],
        [("CVE-2024-1111", True, 9.8, "CRITICAL", 0.5)])
    assert {k: (r["action"], r["priority"], r["reason_code"]) for k, r in got.items()} == {
        ("u1", "CVE-2024-1111"): ("patch", "high", "kev_listed"), ("u1", "8.8.8.8"): ("hunt", "low", "public_resolver_registry"), ("u1", "5.6.7.8"): ("block", "medium", "publisher_indicator"),
        ("u1", "abc.com"): ("hunt", "low", "domain_boundary_rule"), ("u1", "x.abc.com"): ("block", "medium", "publisher_indicator"), ("u1", "login.vendor.com"): ("hunt", "low", "vendor_brand_apex"),
        ("u1", "github.io"): ("hunt", "low", "domain_boundary_rule"), ("u1", "dns.google"): ("hunt", "low", "public_resolver_registry"), ("u1", "d41d8cd98f00b204e9800998ecf8427e"): ("hunt", "medium", "publisher_indicator"),
        ("u1", "2606:4700:4700::1234"): ("block", "medium", "publisher_indicator"), ("u2", "Phishing campaign hits banks"): ("observe", "low", "phishing"), ("u4", "Gone"): ("review", "medium", "forbidden"),
        ("u5", "A data breach at a shop"): ("monitor", "medium", "data_breach")}
    assert got["u1", "CVE-2024-1111"]["reason"] == "KEV 已知遭利用；CVSS 9.8 CRITICAL（NVD）" and got["u1", "8.8.8.8"]["benign_basis"] == "public_resolver_registry"


def test_each_cve_keeps_its_own_score_and_impacts(spark):
    body = "CVE-2024-1001 is bad\nCVSS 9.8\nremote code execution\n\nCVE-2024-1002 is mild\nCVSS: 4\nCVE-2024-1003 in passing\n## Related articles\nCVE-2024-1004 ransomware\n"
    got = board(spark, [("u", "Two flaws", body, None)], [("CVE-2024-1003", False, None, None, None)])
    assert {k[1]: (r["priority"], r["article_cvss_score"], r["reason_code"]) for k, r in got.items()} == {
        "CVE-2024-1001": ("high", 9.8, "cve_reported"), "CVE-2024-1002": ("medium", 4.0, "cve_reported"), "CVE-2024-1003": ("medium", None, "cve_reported")}


def test_command_and_control_is_urgent_and_headings_are_not_read(spark):
    body = "Intro\n## Remote code execution\n" + IOC + "5.6.7.8 command and control\n5.6.7.9\n"
    got = board(spark, [("u", "Campaign", body, None)])
    assert {k[1]: r["priority"] for k, r in got.items()} == {"5.6.7.8": "high", "5.6.7.9": "medium"}


def test_backtest(spark):
    table = lambda *v: spark.createDataFrame([(x,) for x in v], "value_lc string")
    asked = spark.createDataFrame([(x,) for x in ("a.com", "b.com", "c.com", "d.com", "10.0.0.1", "x.a.com", "deep.org", "com", "word", " ")], "value string")
    out = analyst.backtest_observables(asked, table("a.com", "b.com", "one.two.deep.org", "z.deep.org", "http://w.net/p"), table("b.com"), table("c.com"), psl_of(spark))
    assert {r["value"]: (r["status"], r["match_method"], r["matched_on"]) for r in out.collect()} == {
        "a.com": ("hit", "exact", "a.com"), "b.com": ("excluded", None, None), "c.com": ("candidate", None, None), "d.com": ("unseen", None, None), "10.0.0.1": ("skipped", None, None),
        "x.a.com": ("hit", "parent_domain", "a.com"), "deep.org": ("hit", "child_domain", "z.deep.org"), "com": ("skipped", None, None), "word": ("skipped", None, None)}
    got = analyst.observable_rates(out).first().asDict()
    assert got == {"submitted": 9, "skipped": 3, "hits": 3, "by_exact": 1, "by_parent": 1, "by_child": 1, "excluded": 1, "candidates": 1, "unseen": 2, "processed": 6, "hit_rate": 0.5}


def test_source_for_url(spark):
    registry = spark.createDataFrame([("b", "example.org", 2), ("a", "news.example.org", 1)], "source_key string, host string, pos int")
    out = analyst.source_for_url(spark.createDataFrame([("x.news.example.org",), ("example.org",), ("q.com",)], "h string"), "h", registry)
    assert {r["h"]: r["source_key"] for r in out.collect()} == {"x.news.example.org": "a", "example.org": "b", "q.com": None}


def test_short_parents_of_url_hosts_and_resolvers_in_long_form(spark):
    evidence = spark.createDataFrame(
        [("u", "domain", "ab.com"), ("u", "url", "https://cdn.ab.com/x"), ("v", "url", "https://it.org/"), ("v", "domain", "a.it.org"), ("w", "domain", "ab.com"), ("w", "domain", "ab.com.evil.net")],
        "url string, indicator_type string, normalized_value string").withColumn("status", F.lit("confirmed"))
    assert sorted(map(tuple, analyst.short_parents(evidence).collect())) == [("u", "ab.com"), ("v", "it.org")]
    forms = spark.createDataFrame([("2001:4860:4860:0:0:0:0:8888",), ("WWW.dns.google",), ("8.8.8.8",)], "v string").select(analyst.bare_target(F.lit(None).cast("string"), F.col("v")).alias("b"))
    assert [r.b for r in forms.collect()] == ["2001:4860:4860::8888", "dns.google", "8.8.8.8"]
