"""Report, enrichment, blocklist, sample and body operators on small cases."""

from datetime import date


from pyspark.sql import functions as F

from vigil.functions import addresses, dates, html, text, urls
from vigil.operators import blocklist, corpus, enrichment, extract, report, samples, state
from vigil.plans.queries import TLDS
from vigil.sources import readers
from vigil.sources.versions import Store
from vigil.streaming import jobs


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(spark, f, rows):
    return [r["x"] for r in table(spark, "i int, v string", *enumerate(rows)).select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


PSL = "rule string, kind string"
RULES = [("com", "normal"), ("net", "normal"), ("org", "normal"), ("io", "normal"), ("plat.io", "normal")]


def test_addresses_of_both_families(spark):
    given = ["2001:DB8:0:0:1:0:0:1", "::ffff:10.0.0.1", "1:2:3:4:5:6:7::", "12:30:45", "1:::2", "2606:4700:4700::1111", "8.8.8.8", "[::1]", "2001:20::1"]
    assert values(spark, addresses.canonical_ip, given) == ["2001:db8::1:0:0:1", "::ffff:a00:1", "1:2:3:4:5:6:7:0", None, None, "2606:4700:4700::1111", "8.8.8.8", "::1", "2001:20::1"]
    assert values(spark, addresses.is_global_address, given) == [False, False, True, None, None, True, True, False, True]
    assert values(spark, addresses.is_public_address, given) == [False, False, False, None, None, True, True, False, True]


def test_small_functions(spark):
    assert values(spark, urls.undefang_steps, ["hxxp://a[.]b.", "plain"]) == [["defang", "defang_scheme", "trailing_dot"], []]
    assert values(spark, lambda c: urls.defang(c, F.lit("url")), ["http://a.b/c.d"]) == ["hxxp://a[.]b/c.d"]
    assert values(spark, lambda c: urls.clip(c, 10), ["one  two three", "short"]) == ["one two…", "short"]
    assert values(spark, lambda c: text.source_summary(c, F.lit("## h\nFirst. Second")), ["A v1.5 tool is out and about now. More of it The post X appeared first on Y", None]) == ["A v1.5 tool is out and about now.", "First. Second"]
    assert values(spark, lambda c: dates.days_since(c.cast("date"), F.lit("2024-01-31").cast("date")), ["2024-01-30"]) == [1]
    at = lambda t: F.lit(t).cast("timestamp")
    assert values(spark, lambda c: dates.in_window(c.cast("timestamp"), at("2024-01-01"), at("2024-01-02")), ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]) == [True, False]
    assert values(spark, lambda c: text.is_topic_relevant(c, F.lit(None)), ["New malware", "Cooking"]) == [True, False]
    assert values(spark, lambda c: readers.unpack_json(c, "array<string>"), ['["a"]', "{bad"]) == [["a"], None]


def test_extraction_of_claims_and_files(spark):
    body = "\n".join(["attachment: invoice.qqq", "Tracked the loader as Zorvex today", "Fairlife ransomware attack", "Known Ransomware Groups Target banks", "Python-based loader named Custom", "see MITRE ATT&CK T1059.001 there",
                      "## Indicators of compromise", "Related articles: other.example.com", "2606:4700:4700::1111 but fe80::1", "https://vpn.[redacted]/x", "version 4.16.7.1"])
    rows = extract.extract_evidence(table(spark, "url string, body string, publisher_hosts array<string>", ("u", body, ["news.org"])), TLDS).collect()
    assert {(r["indicator_type"], r["normalized_value"]): (r["status"], r["assertion_kind"], r["reason_codes"][0]) for r in rows} == {
        ("filename", "invoice.qqq"): ("candidate", "machine_candidate", "context_requires_human_review"), ("malware_family", "Zorvex"): ("confirmed", "source_explicit", "explicit_source_label"),
        ("malware_family", "Fairlife"): ("candidate", "machine_candidate", "apposition_requires_human_review"), ("attack_technique", "T1059.001"): ("confirmed", "source_explicit", "explicit_source_label"),
        ("domain", "other.example.com"): ("rejected", "machine_rejected", "excluded_editorial_section"), ("ip", "2606:4700:4700::1111"): ("confirmed", "source_explicit", "explicit_ioc_section"),
        ("ip", "fe80::1"): ("rejected", "machine_rejected", "non_public_ip"), ("url", "https://vpn.[redacted]/x"): ("rejected", "machine_rejected", "unreadable_url")}


def test_enrichment(spark):
    d = date(2024, 1, 2)
    known = table(spark, "value_lc string, indicator_type string, benign_basis string, first_seen date, last_seen date, report_count int, source_count int, publishers array<string>, action string, priority string",
                  *((v, k, b, d, d, 1, 1, ["s"], "block", "medium") for v, k, b in (("evil.com", "domain", None), ("held.com", "domain", "vendor_brand_apex"), ("uncited.com", "domain", None), ("cve-2024-1111", "cve", None), ("2606:4700::1", "ip", None))))
    cites = table(spark, "value_lc string, publisher string, article_title string, article_url string, published_at date, report_date date, seq int",
                  *((v, p, "t", f"u{k}", d, d, k) for k, (v, p) in enumerate((("evil.com", "b"), ("evil.com", "a"), ("evil.com", "b"), ("held.com", "a"), ("cve-2024-1111", "a"), ("2606:4700::1", "a")))))
    intel = table(spark, "report_date date, cve_id string, kev boolean, cvss_score double, cvss_severity string, epss_score double", (d, "CVE-2024-1111", False, 9.8, "CRITICAL", 0.1), (date(2024, 1, 1), "CVE-2024-1111", True, 1.0, "LOW", 0.9))
    found = table(spark, "sha256 string, value string, confidence int, first_seen_at string", ("s1", "sample.org", 50, "a"), ("s2", "sample.org", 90, "a"), ("s1", "Global-{x}", 10, "a"))
    analyses = table(spark, "sha256 string, md5 string, sha1 string", ("s1", "a" * 32, "b" * 40), ("s2", None, None))
    feeds = table(spark, "source string, value string, first_seen date, last_seen date", ("threatfox", "listed.net", d, None), ("feodo", "deep.other.net", d, d))
    asked = ["evil.com", "x.evil.com", "http://evil.com/q", "held.com", "x.held.com", "out.com", "uncited.com", "cve-2024-1111", "sample.org", "A" * 32, "a.b.listed.net", "c.other.net", "none.org", "10.0.0.1", "word", "[2606:4700:0:0::1]"]
    out = enrichment.enrich_observables(table(spark, "input_index int, value string", *enumerate(asked)), known, table(spark, "value_lc string, reason_codes array<string>", ("out.com", ["publisher_domain"])), cites, intel, found, analyses, feeds,
                                        table(spark, PSL, *RULES), F.lit("2024-01-31").cast("date"))
    rows = {r["input_index"]: r for r in out.collect()}
    assert {asked[i]: (r["bucket"], r["match"]) for i, r in rows.items()} == {
        "evil.com": ("hit", "exact"), "x.evil.com": ("hit", "parent_domain"), "http://evil.com/q": ("hit", "same_host"), "held.com": ("hit", "exact"), "x.held.com": ("unseen", None), "out.com": ("excluded", "excluded"), "uncited.com": ("error", None),
        "cve-2024-1111": ("hit", "exact"), "sample.org": ("side_only", None), "A" * 32: ("side_only", None), "a.b.listed.net": ("side_only", None), "c.other.net": ("unseen", None), "none.org": ("unseen", None), "10.0.0.1": ("skipped", None),
        "word": ("skipped", None), "[2606:4700:0:0::1]": ("hit", "exact")}
    assert (rows[0]["citation_count"], rows[0]["cited_publisher"], rows[0]["days_since_last_seen"], rows[3]["verdict"], rows[6]["reason"]) == (3, "b", 29, "benign_listed", "missing_citation")
    assert (rows[7]["reason_code"], rows[7]["kev"], rows[8]["samples"], rows[9]["resolved_sha256"], rows[10]["feed_match"], rows[5]["excluded_reasons"]) == ("cvss_critical", False, ["s2", "s1"], "s1", "parent_domain", ["publisher_domain"])
    counts = enrichment.enrich_counts(out).first().asDict()
    assert counts == {"requested": 16, "processed": 13, "hits": 6, "headline_hits": 6, "excluded": 1, "sample_hits": 2, "feed_hits": 1, "unseen": 3, "skipped": 2, "failed": 1, "status": "partial"}
    every = enrichment.citations(cites, "full").where("value_lc = 'evil.com'").orderBy("rank").collect()
    assert [(r["rank"], r["publisher"], r["citation_count"]) for r in every] == [(1, "b", 3), (2, "a", 3), (3, "b", 3)]


def test_feed_rules(spark):
    d = lambda n: date(2024, 1, n)
    schema = "source string, indicator_type string, value string, threat_type string, malware string, confidence int, port int, first_seen date, last_seen date"
    row = lambda s, v, first, last, threat="x": (s, "ip", v, threat, None, None, None, first, last)
    stored = table(spark, schema, row("threatfox", "old", d(1), d(2)), row("threatfox", "kept", d(1), d(25)), row("threatfox", "changed", d(1), d(20)), row("feodo", "gone", d(1), None), row("et_compromised", "et", d(1), None), row("et_compromised", "et2", d(1), None))
    read = table(spark, schema, row("threatfox", "changed", d(9), d(28)), row("et_compromised", "et", d(28), None))
    ok = lambda *s: table(spark, "source string", *((x,) for x in s))
    state = lambda i, o: {(r["source"], r["value"]): (r["change"], r["first_seen"].day) for r in corpus.merge_feed(stored, i, o, F.lit("2024-02-05").cast("date")).collect()}
    assert state(read, ok("threatfox", "feodo", "et_compromised")) == {("threatfox", "kept"): ("keep", 1), ("threatfox", "changed"): ("update", 9), ("et_compromised", "et"): ("keep", 1)}
    # an empty list of the one source deletes all, of the other nothing; a source that failed keeps its rows, but old ones still expire
    assert state(read.limit(0), ok("feodo", "et_compromised")) == {("threatfox", "kept"): ("keep", 1), ("threatfox", "changed"): ("keep", 1), ("et_compromised", "et"): ("keep", 1), ("et_compromised", "et2"): ("keep", 1)}
    assert ("feodo", "gone") in state(read.limit(0), ok("threatfox"))


def test_feed_rows(spark):
    schema = "source string, ioc_type string, value string, port int, threat_type string, malware string, first_seen string, last_seen string, ioc_id int, confidence string, pos long"
    t, first = "2024-01-05 10:00:00 UTC", "2024-01-01 00:00:00"
    row = lambda k, s, kind, v, conf="90", last=t, f=first: (s, kind, v, k, "botnet_cc", "M", f, last, k, conf, k)
    items = table(spark, schema, row(1, "threatfox", "ip", "8.8.4.4"), row(2, "threatfox", "ip", "8.8.4.4", last="2024-01-09 10:00:00"), row(3, "threatfox", "ip", "8.8.4.4", last="2024-01-09 10:00:00"), row(4, "threatfox", "domain", "Evil[.]Example.net", "74"),
                  row(5, "threatfox", "domain", "a.example.net", "many"), row(6, "threatfox", "ip", "10.0.0.1"), row(7, "threatfox", "md5", "abc"), row(8, "threatfox", "domain", "b.Example.net", last="2024-01-05"), row(9, "threatfox", "mutex", "m"),
                  row(10, "feodo", "ip", "9.9.9.9"), row(11, "feodo", "ip", "9.9.9.9", last=None), row(12, "et_compromised", "ip", "1.2.3"), row(13, "et_compromised", "ip", "5.6.7.8"), row(14, "threatfox", "url", "http://x.org", f="2024-01-01"))
    got = {(r["source"], r["value"]): (r["ioc_id"], str(r["last_seen"]), r["registrable"]) for r in blocklist.feed_rows(items, table(spark, PSL, *RULES), F.lit("2024-02-01").cast("timestamp")).collect()}
    assert got == {("threatfox", "8.8.4.4"): (2, "2024-01-09 10:00:00", None), ("threatfox", "b.example.net"): (8, "None", "example.net"), ("feodo", "9.9.9.9"): (11, "None", None), ("et_compromised", "5.6.7.8"): (13, "None", None)}


def test_samples(spark):
    jobs_ = table(spark, "sha256 string, job_id string, sample_id string, submitted_at string, finished_at string, file_type string, size_bytes long", ("AA", "j1", "x1", None, "2024-01-01", " ", 5), ("AA", "j2", "x1", "s", "2024-01-02", "exe", 6), ("BB", "j3", None, "s", "2024-01-03", None, 1), ("", "j4", None, None, None, None, 1))
    summaries = table(spark, "job_id string, verdict_label string, verdict_score int, family string, family_confidence int, ioc_total int", ("j2", "bad", 9, "Fam", 8, 3))
    records = table(spark, "sample_id string, md5 string, sha1 string, mime string, uploaded_at string", ("x1", "AB", None, "m", "u"))
    techniques = table(spark, "job_id string, technique_id string, pos int", ("j2", "T2", 1), ("j2", "T1", 2), ("j2", "T2", 3), ("j2", "", 4))
    got = {r["sha256"]: r for r in samples.sample_table(jobs_, summaries, records, techniques).collect()}
    assert set(got) == {"aa", "bb"} and (got["aa"]["verdict"], got["aa"]["md5"], got["aa"]["attack_techniques"], got["aa"]["file_type"], got["bb"]["verdict"], got["bb"]["attack_techniques"]) == ("bad", "ab", ["T2", "T1"], "exe", None, [])
    iocs = table(spark, "sha256 string, ioc_type string, value string, confidence string, source_integration_id string, first_seen_at string, pos int", ("AA", "domain", "a.com", "5", "one", "t", 1), ("AA", "domain", "A.com", "9", "two", "t", 2), ("AA", "domain", "a.com", "9", "three", "t", 3),
                 ("AA", "mutex", "{guid}", None, None, None, 4), ("AA", "hash", "abc", "1", None, None, 5), ("AA", "ip", "10.0.0.1", "1", None, None, 6), ("AA", "imphash", "x", "1", None, None, 7))
    assert {(r["indicator_type"], r["value"]): (r["confidence"], r["integration"]) for r in samples.sample_rows(iocs).collect()} == {("domain", "a.com"): (9, "two"), ("mutex", "{guid}"): (0, None)}
    stored, new = table(spark, "sha256 string, x int", ("a", 1), ("b", 1)), table(spark, "sha256 string, x int", ("b", 2), ("c", 2))
    merged = samples.merge_samples(stored, new)
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 2), ("c", 2)] == sorted(map(tuple, samples.merge_samples(merged, new).collect()))
    mark = table(spark, "high_water string", ("2024-01-02",))
    assert [r["job_id"] for r in samples.new_since(jobs_, mark).collect()] == ["j3"] and samples.high_water(jobs_, mark).first()[0] == "2024-01-03"


def test_report_parts(spark):
    d, e = date(2024, 1, 1), date(2024, 1, 2)
    articles = table(spark, "report_date date, url string, title string, summary string, body string, source string", (d, "a", "Cooking", None, "x", "s"), (d, "b", "Malware", None, "", "s"), (d, "c", "Cooking", None, "x", "s"))
    evidence = table(spark, "url string, status string, indicator_type string, normalized_value string", ("a", "confirmed", "ip", "1.1.1.1"), ("c", "candidate", "ip", "2.2.2.2"))
    assert {r["url"]: r["relevant"] for r in report.mark_relevant(articles, evidence).collect()} == {"a": True, "b": True, "c": False}
    assert {r["url"]: r["detailed"] for r in report.split_articles(articles, evidence).collect()} == {"a": True, "b": True, "c": False}
    guard = lambda force: {r["report_date"]: r["accepted"] for r in report.guard_replace(table(spark, "report_date date, article_count int, ioc_count int", (d, 5, 5)), table(spark, "report_date date, article_count int, ioc_count int", (d, 6, 4), (e, 1, 1)), force).collect()}
    assert guard(False) == {d: False, e: True} and guard(True) == {d: True, e: True}
    digest = report.findings_digest(articles, evidence)
    again = report.findings_digest(articles.repartition(3), evidence.orderBy(F.desc("url")))
    assert report.report_id(digest).first() == report.report_id(again).first()
    assert report.report_id(report.findings_digest(articles, evidence.limit(1))).first() != report.report_id(digest).first()
    state = table(spark, "corpus_version string, days int, first_date date, last_date date", ("v", 1, d, d))
    assert report.reported_version(state, articles).first()["corpus_version"] == "v"
    assert report.reported_version(state, articles.unionByName(articles.limit(1).withColumn("report_date", F.lit(e)))).first()["corpus_version"] is None
    runs = table(spark, "report_date date, enabled boolean, catalogue_version string, kev_count int, requested int, scored int, skipped int, stale int, errors array<string>", (d, True, None, 0, 3, 2, 0, 0, ["x"]), (e, True, "v", 2, 3, 2, 1, 0, ["x"]))
    assert {r["report_date"]: (r["kev_count"], r["failed"]) for r in report.enrichment_note(runs).collect()} == {d: (None, 1), e: (2, 0)}
    rows = table(spark, "report_date date, seq int, value string, raw_value string", (d, 1, "a.com", "a[.]com"), (e, 2, "A.com", "A.com"), (e, 3, "b.com", "b"))
    assert [r["seq"] for r in report.lookup_indicator(rows, " A[.]com ").collect()] == [1] and [r["seq"] for r in report.lookup_indicator(rows, "A.COM").collect()] == [2, 1]
    day = table(spark, "report_date date, url string, parser_version string, digest string", (d, "a", "2", "x"), (d, "b", "2", "y"))
    was = table(spark, "report_date date, url string, parser_version string, digest string", (d, "a", "1", "x"), (d, "c", "1", "z"))
    got = report.with_provenance(day, was).first()
    assert (got["revisions"], got["original_revisions"], got["articles"], got["original_articles"], got["changed"]) == (["2"], ["1"], 2, 2, 2)
    csv = readers.to_action_csv(table(spark, "action string, priority string, target_type string, target string, url string, kev boolean, cvss_score double, epss_score double, epss_percentile double", ("patch", "high", "cve", "C", "u", True, 9.75, 0.123456, None), ("observe", "low", "article", "t", "u", None, None, None, None)))
    assert csv.columns == list(readers.CSV_COLUMNS) and [(r["cvss_score"], r["epss_score"], r["epss_percentile"], r["kev"]) for r in csv.collect()] == [("9.8", "0.12346", "", "true")]


def test_calls(spark):
    calls = table(spark, "token string, t string", *(("a", f"2024-01-01 00:00:{k:02d}") for k in range(4)), *(("a", f"2024-01-01 00:0{k}:00") for k in range(1, 5)), ("z", "2024-01-01 00:00:00")).selectExpr("token", "CAST(t AS timestamp) AS ts")
    limits = table(spark, "token string, per_minute int, per_day int", ("a", 2, 4), ("z", 0, 0))
    rows = corpus.refused_calls(calls, limits).orderBy("token", "ts").collect()
    assert [r["refused"] for r in rows] == [None, None, "minute", "minute", None, None, "day", "day", "minute"]
    assert {r["token"]: r["n_refused"] for r in corpus.call_usage(calls, limits).collect()} == {"a": 4, "z": 1}


def test_bodies(spark):
    long_ = "Word about exploits. " * 40
    ld = '<script type="application/ld+json">{"@graph": [{"articleBody": "' + long_ + '"}, {"x": 1}]}</script>'
    blocks = "".join(f"<p>Exploit part {k} {long_}</p>" for k in range(3))
    pages = table(spark, "page_id int, title string, html string", (1, "Exploits", ld + "<article><p>short</p></article>"), (2, "Exploits", f"<nav><p>menu</p></nav><article><h2>Head</h2>{blocks}<p>x<p>y</p><p>y</p></article>"),
                  (3, "t", "<article><p>Access denied " + long_ + "</p></article>"), (4, "t", "<div>nothing</div>"), (5, "t", "<main><p>too short</p></main>"))
    got = {r["page_id"]: r for r in html.choose_body(pages).collect()}
    assert {k: r["method"] for k, r in got.items()} == {1: "json-ld:articleBody", 2: "semantic-selector:article", 3: "failed", 4: "failed", 5: "failed"}
    assert got[2]["body"].startswith("## Head\nExploit part 0") and got[2]["body"].endswith("\nx\ny") and got[2]["warnings"] == []
    assert got[3]["failures"] == ["semantic-selector:article: anti-bot or access-denied page detected"] and got[4]["failures"] == ["no extraction candidates"] and got[5]["failures"] == ["semantic-selector:main: body too short (9 characters)"]
    entries = table(spark, "url string, title string, content array<string>, summary_html string", ("u1", "t", ["<p>" + long_ * 2 + "</p>"], "s"), ("u2", "t", ["<p>" + long_ + "</p>"], None), ("u3", "t", ["<p>" + long_ + "</p>"], None), ("u4", "t", None, "s"))
    bodies = table(spark, "url string, page_method string, page_body string", ("u2", "json-ld", "page"), ("u3", "failed", ""))
    assert {r["url"]: r["method"] for r in html.choose_entry_body(entries, bodies).collect()} == {"u1": "feed:content", "u2": "json-ld", "u3": "feed:content:partial", "u4": "failed"}


def test_stream_of_articles_and_samples(spark, tmp_path):
    rows = table(spark, "url string, body string, publisher_hosts array<string>", ("u", "## IoCs\n8.8.4.4\nCVE-2024-1234", ["n.org"]))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = jobs.stream_evidence(stream, TLDS).writeStream.format("memory").queryName("evidence").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {(r["indicator_type"], r["status"]) for r in spark.table("evidence").collect()} == {("ip", "confirmed"), ("cve", "confirmed")}
    schema = "sha256 string, finished_at string, x int"
    table(spark, schema, ("a", "1", 1), ("a", "2", 2), ("b", "1", 3)).write.json(str(tmp_path / "s"))
    store = Store(spark, str(tmp_path / "store"))
    known = table(spark, schema, ("b", "0", 0), ("c", "0", 0))
    state.advance_samples(store, known, known.select("sha256", "x"))
    q = jobs.stream_samples(spark, str(tmp_path / "s"), schema).writeStream.foreachBatch(jobs.upsert_samples(store, lambda df: df.select("sha256", "x"))).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, store.read("samples").collect())) == [("a", "2", 2), ("b", "1", 3), ("c", "0", 0)]
    assert sorted(map(tuple, store.read("sample_iocs").collect())) == [("a", 2), ("b", 3), ("c", 0)] and store.read("high_water").first()[0] == "2"
    late: list = []
    sides = table(spark, "side string, t string", ("news", "2024-01-01 00:00:00"), ("feeds", "2024-01-02 12:00:00"), ("samples", None)).selectExpr("side", "CAST(t AS timestamp) AS exported_at")
    jobs.staleness(sides, lambda: F.lit("2024-01-02 13:00:00").cast("timestamp"), lambda df: late.extend(r["side"] for r in df.collect()))(sides, 0)
    assert sorted(late) == ["news", "samples"]


def test_tied_readings_have_one_order(spark):
    """Of readings at one place with one confidence the largest integration counts, in whatever order they come; forms of one value meet after that."""
    iocs = "sha256 string, ioc_type string, value string, confidence int, source_integration_id string, first_seen_at string, pos long"
    rows = [("ab", "domain", "Evil.com", 50, f"tool{k}", "2024-01-01", 7) for k in range(3)] + [("ab", "domain", "evil[.]com", 50, "tool9", "", 8), ("ab", "ip", "10.0.0.1", 9, "tool1", "", 1)]
    for given in (rows, rows[::-1]):
        got = samples.sample_rows(table(spark, iocs, *given).coalesce(1)).collect()
        assert [tuple(r) for r in got] == [("ab", "domain", "evil.com", 50, "tool2", "2024-01-01")]
