"""Registered queries against their SQL, and the operators that SQL cannot state against small cases."""

import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from vigil.operators import corpus, extract, matching
from vigil.operators.graph import connected_components
from vigil.plans import inputs
from vigil.plans import report_queries  # noqa: F401  registers its queries
from vigil.plans.queries import TLDS
from vigil.plans.registry import ORACLES, QUERIES
from vigil.sources import readers

SF = "/root/testdata/sf0.001"
TABLES = ("supplier", "customer", "part", "lineitem", "events", "documents", "pages")


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, bool, type(None))) else str(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == columns
    order = [[c[0] for c in want.description].index(c) for c in columns]
    assert plain(found.select(columns).collect()) == plain([[r[i] for i in order] for r in want.fetchall()])


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_extract_evidence(spark):
    body = "\n".join([
        "Seen in evil[.]example[.]com and CVE-2024-1234.", "## Indicators of compromise", "8.8.4.4", "10.1.2.3", "d41d8cd98f00b204e9800998ecf8427e", "https://bad.example.com/x/y.exe", "news.example.org",
        "version 4.16.7.1", "dropper.zip", "## Related articles", "other.example.com", "## Other", "third.example.com"])
    articles = spark.createDataFrame([("u1", body, ["example.org"]), ("u2", None, ["a.org"]), ("u3", "", ["a.org"])], "url string, body string, publisher_hosts array<string>")
    got = {(r["indicator_type"], r["normalized_value"]): (r["status"], r["reason_codes"][0]) for r in extract.extract_evidence(articles, TLDS).collect()}
    assert got == {
        ("domain", "evil.example.com"): ("candidate", "context_requires_human_review"), ("cve", "CVE-2024-1234"): ("confirmed", "explicit_cve_identifier"),
        ("ip", "8.8.4.4"): ("confirmed", "explicit_ioc_section"), ("ip", "10.1.2.3"): ("rejected", "non_public_ip"), ("md5", "d41d8cd98f00b204e9800998ecf8427e"): ("confirmed", "explicit_ioc_section"),
        ("url", "https://bad.example.com/x/y.exe"): ("confirmed", "explicit_ioc_section"), ("domain", "news.example.org"): ("rejected", "publisher_domain"),
        ("filename", "dropper.zip"): ("confirmed", "explicit_ioc_section"), ("domain", "other.example.com"): ("rejected", "excluded_editorial_section"),
        ("domain", "third.example.com"): ("candidate", "context_requires_human_review")}


def test_matching(spark):
    psl = spark.createDataFrame([("com", "normal"), ("co.uk", "normal"), ("uk", "normal"), ("ck", "wildcard"), ("www.ck", "exception"), ("plat.io", "normal"), ("io", "normal")], "rule string, kind string")
    depth = matching.public_suffix_depth(spark.createDataFrame([(h,) for h in ("a.b.com", "x.co.uk", "a.x.ck", "www.ck", "q.plat.io", "one.zz", "com")], "h string"), "h", psl)
    assert {r["h"]: r["a"] for r in depth.select("h", matching.registrable(F.col("h"), F.col("suffix_labels")).alias("a")).collect()} == {
        "a.b.com": "b.com", "x.co.uk": "x.co.uk", "a.x.ck": "", "www.ck": "www.ck", "q.plat.io": "q.plat.io", "one.zz": "one.zz", "com": ""} | {"a.x.ck": "a.x.ck"}
    known = spark.createDataFrame([("evil.com", None), ("sub.deep.com", None), ("held.com", "vendor_brand_apex"), ("http://w.com/x", None)], "value_lc string, benign_basis string")
    excluded = spark.createDataFrame([("out.com",)], "value_lc string")
    asked = ["evil.com", "a.b.evil.com", "deep.com", "held.com", "x.held.com", "http://evil.com/q", "http://W.com/x/", "out.com", "http://out.com/1", "none.com", "10.0.0.1", "", "evil[.]com"]
    found = matching.match_observables(spark.createDataFrame([(i, v, None) for i, v in enumerate(asked)], "input_index long, value string, type_supplied string"), known, excluded, psl)
    got = {r["value"]: (r["status"], r["match_method"]) for r in found.collect()}
    assert got == {
        "evil.com": ("hit", "exact"), "a.b.evil.com": ("hit", "parent_domain"), "deep.com": ("hit", "child_domain"), "held.com": ("hit", "exact"), "x.held.com": ("miss", None), "http://evil.com/q": ("hit", "same_host"),
        "http://W.com/x/": ("hit", "exact"), "out.com": ("excluded", "excluded"), "http://out.com/1": ("excluded", "excluded_host"), "none.com": ("miss", None), "10.0.0.1": ("skipped", None), "": ("skipped", None),
        "evil[.]com": ("hit", "exact")}


def test_archive(spark, tmp_path):
    evidence = {"indicator_type": "ip", "raw_value": "8.8.8.8", "normalized_value": "8.8.8.8", "status": "confirmed", "reason_codes": ["x"], "section": "", "context": ""}
    day = {"window_start": "a", "articles": [{"source": "s", "article_url": "u", "evidence": [evidence]}], "excluded_articles": [{"source": "s", "article_url": "v", "evidence": []}]}
    for name, body in (("2024-01-01", json.dumps(day)), ("2024-01-02", "{broken"), ("notes", json.dumps(day)), ("2024-01-03", json.dumps(day))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "daily-evidence.json").write_text(body)
    archive = readers.read_archive(spark, str(tmp_path))
    assert {str(r["report_date"]) for r in archive.collect()} == {"2024-01-01", "2024-01-03"}
    assert readers.explode_evidence(archive).count() == 2 and readers.stored_articles(archive).count() == 4
    assert str(readers.load_report(archive).first()["report_date"]) == "2024-01-03"
    assert readers.previous_iocs(readers.explode_evidence(archive), "2024-01-02").count() == 1


def test_catalogues(spark, tmp_path):
    (tmp_path / "kev.json").write_text(json.dumps({"vulnerabilities": [{"cveID": "CVE-2024-0001", "dueDate": "2024-01-01", "knownRansomwareCampaignUse": "Known"}, {"cveID": "bad"}, {"cveID": "cve-2024-0001", "dueDate": "2024-02-02"}]}))
    kev = readers.read_kev(spark, str(tmp_path / "kev.json")).collect()
    assert [(r["cve_id"], r["due_date"], r["known_ransomware"]) for r in kev] == [("CVE-2024-0001", "2024-02-02", None)]
    metric = lambda kind, score: {"type": kind, "cvssData": {"version": "3.1", "baseScore": score, "baseSeverity": "HIGH"}}
    (tmp_path / "nvd.json").write_text(json.dumps({"vulnerabilities": [{"cve": {"id": "CVE-1", "metrics": {"cvssMetricV40": [metric("Primary", "none")], "cvssMetricV31": [metric("Secondary", 5.0), metric("Primary", 7.5)]}}}, {"cve": {"id": "CVE-2", "metrics": {}}}]}))
    assert {r["cve_id"]: r["cvss_score"] for r in readers.read_nvd(spark, str(tmp_path / "nvd.json")).collect()} == {"CVE-1": 7.5, "CVE-2": None}
    (tmp_path / "o.csv").write_text("﻿value,type\n# note\nevil.com,domain\n\n8.8.8.8\n")
    assert [(r["input_index"], r["value"], r["type_supplied"], r["sample_id"]) for r in readers.read_observables(spark, str(tmp_path / "o.csv")).orderBy("input_index").collect()] == [
        (0, "evil.com", "domain", "row-1"), (1, "8.8.8.8", None, "row-2")]
    (tmp_path / "psl.dat").write_text("// c\ncom\n*.ck\n!www.ck\n")
    assert {(r["rule"], r["kind"]) for r in readers.read_psl(spark, str(tmp_path / "psl.dat"), 3).collect()} == {("com", "normal"), ("ck", "wildcard"), ("www.ck", "exception")}
    with pytest.raises(ValueError):
        readers.read_psl(spark, str(tmp_path / "psl.dat"))


def test_write_day_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "report_date string, x int")
    readers.write_day(rows, str(tmp_path / "t"))
    readers.write_day(rows.where("x = 2").withColumn("x", F.lit(3)), str(tmp_path / "t"))
    readers.write_day(rows.where("x = 2").withColumn("x", F.lit(3)), str(tmp_path / "t"))
    assert sorted(r["x"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]


def test_chain_and_version(spark):
    day = lambda n: f"2024-01-{n:02d} 00:00:00"
    w = spark.createDataFrame([(day(a), day(b)) for a, b in ((19, 20), (18, 19), (16, 17), (20, 21), (17, 18), (9, 10))], "a string, b string").selectExpr("CAST(a AS timestamp) AS window_start", "CAST(b AS timestamp) AS window_end")
    starts = lambda since, days=7: sorted(r["window_start"].day for r in corpus.unbroken_chain(w, F.lit(since).cast("timestamp"), days).collect())
    assert starts(day(20)) == [16, 17, 18, 19] and starts(day(20), 2) == [18, 19] and starts(day(22)) == [] and starts(day(10)) == [9]
    rows = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    one, two = (corpus.content_version(x, ["a", "b"]).first()[0] for x in (rows, rows.orderBy(F.desc("a")).repartition(7)))
    assert one == two != corpus.content_version(rows.where("a != 3"), ["a", "b"]).first()[0]


def test_event_clusters(spark):
    articles: dict = {}
    for r in inputs.sightings(spark, SF).where("status = 'confirmed' AND indicator_type = 'cve'").collect():
        articles.setdefault(r["report_date"], {}).setdefault(r["article_url"], set()).add(r["value"])
    want = []
    for day, cves in articles.items():
        groups: list[tuple[set, set]] = []
        for url, values in cves.items():
            met = [g for g in groups if g[1] & values]
            groups = [g for g in groups if not g[1] & values] + [({url}.union(*(g[0] for g in met)), values.union(*(g[1] for g in met)))]
        want += [(day, sorted(c), sorted(u)) for u, c in groups if len(u) > 1]
    found = QUERIES["event_clusters"](spark, SF).withColumns({"cves": F.split("cves", " "), "article_urls": F.split("article_urls", " ")}).collect()
    assert sorted((r["report_date"], r["cves"], r["article_urls"]) for r in found) == sorted(want)
    assert len({day for day, _, _ in want}) > 10 and all(r["n_articles"] == len(r["article_urls"]) for r in found)
    assert all(r["cluster_id"] == hashlib.sha256("\n".join(r["cves"]).encode()).hexdigest()[:16] and r["label"].startswith(r["cves"][0]) for r in found)


def test_board_has_a_target_once_for_each_user(spark, tmp_path):
    """Two users (1 and 91) name badhost1.com in one article, one user twice in another; the SQL has a row for each user."""
    rows = [(25, 1, "click"), (31, 91, "click"), (8, 3, "view"), (13, 1, "click"), (15, 2, "click"), (49, 1, "click"), (55, 1, "click")]
    table = spark.createDataFrame([(e, u, k) for e, u, k in rows], "event_id long, user_id long, event_type string")
    table.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(ORACLES["action_board"])
    columns = [c[0] for c in want.description]
    want = plain(want.fetchall())
    assert plain(QUERIES["action_board"](spark, str(tmp_path)).select(columns).collect()) == want
    assert sum("badhost1.com" in r for r in want) == 4
