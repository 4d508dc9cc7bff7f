"""Column functions on literal values."""

import pytest
from pyspark.sql import functions as F

from vigil.functions import markup, dates, text, urls


def values(spark, f, rows):
    table = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r["x"] for r in table.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_urls(spark):
    given = ["HTTPS://User:p@News.Example.org:8443/a/b/?utm_source=x&id=3#top", "http://a.example.com/", "not a url", "http://a.example.com/?fbclid=1"]
    assert values(spark, urls.canonical_url, given) == ["https://news.example.org:8443/a/b?id=3", "http://a.example.com", "not a url", "http://a.example.com"]
    assert values(spark, urls.url_host, ["https://U:p@EVIL_x.com:8443/", "nothing", None]) == ["evil_x.com", "", ""]


def test_undefang(spark):
    given = ["hxxp[:]//Evil[DOT]example[.]com/a", "evil[.]example[.]com.", "1.2.3.4"]
    assert values(spark, urls.undefang, given) == ["http://Evil.example.com/a", "evil.example.com", "1.2.3.4"]


def test_types(spark):
    given = ["CVE-2024-12345", "d41d8cd98f00b204e9800998ecf8427e", "http://x.org", "8.8.8.8", "a.example.com", "??", "", None, "999.1.1.1"]
    assert values(spark, urls.detect_type, given) == ["cve", "md5", "url", "ip", "domain", "unknown", "empty", "empty", "unknown"]


def test_addresses(spark):
    given = ["8.8.8.8", "10.1.2.3", "100.64.0.1", "224.0.0.1", "192.0.0.9", "1.2.3", "01.2.3.4", "256.1.1.1", "172.32.0.1"]
    assert values(spark, urls.is_global_ip, given) == [True, False, False, True, True, None, None, None, True]
    assert values(spark, urls.is_public_ip, given) == [True, False, True, False, True, None, None, None, True]


def test_guard(spark):
    given = ["", "a b", "10.0.0.1", "host.local", "http://u:p@x.org/", "8.8.8.8", "300.1.1.1", "x" * 600]
    assert values(spark, urls.guard_reason, given) == ["empty", "invalid", "non_public_ip", "internal_name", "credentials_in_url", None, "invalid", "invalid"]


def test_headings(spark):
    given = ["**Indicators of compromise (IoCs):-**", "## Related articles", "Summary:", "網域", "plain text"]
    assert values(spark, text.heading_kind, given) == ["ioc", "excluded", "end", "ioc", None]


def test_lines(spark):
    given = ["a\r\nb\x0bc\n", "", None, "x", "\n\n"]
    assert values(spark, text.body_lines, given) == [s.splitlines() if s else [] for s in given]


def test_impacts_and_scores(spark):
    assert values(spark, text.impacts, ["a Data Breach by ransomware", "none"]) == [["data_breach", "ransomware"], []]
    assert values(spark, text.cvss_in, ["CVSS 9.8 then CVSS score: 10.0", "no"]) == [10.0, None]


def test_clean_text(spark):
    assert values(spark, lambda c: markup.clean_text(markup.page_text(c)), ["<nav>menu</nav><p>A&amp;B  c</p><script>x()</script><p>d</p>"]) == ["A&B c\nd"]


@pytest.mark.parametrize("given, want", [("2024-01-05T22:30:00+00:00", "2024-01-06"), ("2024-01-05T21:30:00+00:00", "2024-01-05"), ("Fri, 05 Jan 2024 22:30:00 +0000", "2024-01-06")])
def test_slots(spark, given, want):
    day = values(spark, lambda c: dates.slot_date(dates.parse_ts(c)), [given])[0]
    assert str(day) == want
