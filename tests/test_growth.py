"""Steps whose cost must follow the rows: values are parsed in many tasks, and each known value is judged once; odd values give what they gave."""

import pytest
from pyspark.sql import functions as F

from vigil.functions import urls
from vigil.operators import analyst, matching
from vigil.plans import materialize as M
from vigil.sources.versions import Store
from vigil.streaming import jobs

PSL = [("com", "normal"), ("uk", "normal"), ("co.uk", "normal"), ("ck", "wildcard"), ("www.ck", "exception")]


@pytest.fixture
def written(spark):
    """Paths of the tables that are written from here on, by the first word of their names."""
    before = set(M._WRITTEN.get(spark.sparkContext.applicationId, []))

    def named(word):
        return [p for p in M._WRITTEN.get(spark.sparkContext.applicationId, []) if p not in before and p.rsplit("/", 1)[1].startswith(f"{word}-")]

    return named


def psl_of(spark):
    return spark.createDataFrame(PSL, "rule string, kind string")


def test_batch_of_one_file_is_parsed_in_many_tasks_and_the_corpus_prepared_once(spark, tmp_path, written):
    store = Store(spark, str(tmp_path / "store"))
    values = lambda *v: spark.createDataFrame([(x, "domain", None) for x in v], "value_lc string, indicator_type string, benign_basis string")
    store.commit({"values": values("evil.com", "a.deep.com"), "excluded": spark.createDataFrame([("out.com",)], "value_lc string")})
    match = jobs.live_verdicts(store, psl_of(spark))
    rows = [(i, v, None) for i, v in enumerate(["evil[.]com", "x.evil.com", "deep.com", "out.com", "none.com"] * 40)]
    spark.createDataFrame(rows, "input_index long, value string, type_supplied string").coalesce(1).write.parquet(str(tmp_path / "asked"))
    batch = spark.read.parquet(str(tmp_path / "asked"))
    assert batch.rdd.getNumPartitions() == 1
    match(batch.where("input_index < 100"), 0)
    match(batch.where("input_index >= 100"), 1)
    assert len(spark.read.parquet(written("restored")[0]).inputFiles()) > 4
    assert len(written("sides")) == 2
    assert {(r["value"], r["match_method"]) for r in store.read("verdicts").collect()} == {
        ("evil[.]com", "exact"), ("x.evil.com", "parent_domain"), ("deep.com", "child_domain"), ("out.com", "excluded"), ("none.com", None)}
    assert store.read("verdicts").count() == 200
    # other values count from the next batch on
    store.commit({"values": values("none.com")})
    match(batch.where("input_index < 5"), 2)
    assert len(written("sides")) == 4
    assert {(r["value"], r["status"]) for r in store.read("verdicts", parts=["2"]).collect()} == {("evil[.]com", "miss"), ("x.evil.com", "miss"), ("deep.com", "miss"), ("out.com", "excluded"), ("none.com", "hit")}


def test_names_are_read_from_each_known_value_once(spark, written):
    table = lambda *v: spark.createDataFrame([(x,) for x in v], "value_lc string")
    asked = spark.createDataFrame([(x,) for x in ("x.evil.com", "10.0.0.1", "8.8.8.8", "hxxp://x.evil[.]com/", "::1", "[2606:4700::1]", "a@b c")], "value string")
    out = analyst.backtest_observables(asked, table(*["evil.com"] * 500, "8.8.8.8"), table("evil.com"), table("8.8.8.8"), psl_of(spark))
    assert {r["value"]: (r["status"], r["match_method"], r["matched_on"]) for r in out.collect()} == {
        "x.evil.com": ("hit", "parent_domain", "evil.com"), "10.0.0.1": ("skipped", None, None), "8.8.8.8": ("hit", "exact", "8.8.8.8"), "hxxp://x.evil[.]com/": ("skipped", None, None),
        "::1": ("skipped", None, None), "[2606:4700::1]": ("unseen", None, None), "a@b c": ("skipped", None, None)}
    assert spark.read.parquet(written("known")[0]).count() == 2 and spark.read.parquet(written("names")[0]).count() == 1


def test_guard_of_odd_values(spark):
    cases = {"10.0.0.1": "non_public_ip", "8.8.8.8": None, "300.1.1.1": "invalid", "::ffff:10.0.0.1": "non_public_ip", "::ffff:8.8.8.8": None, "fd00::1": "non_public_ip", "http://u:p@a.com/": "credentials_in_url",
             "hxxp[:]//10[.]0[.]0[.]1/x": "non_public_ip", "box.local.": "internal_name", " ": "empty", "a b": "invalid"}
    rows = spark.createDataFrame([(v,) for v in cases], "v string").select("v", urls.guard_reason(F.col("v")).alias("g")).collect()
    assert {r["v"]: r["g"] for r in rows} == cases


def test_undefang_and_suffixes_of_odd_values(spark):
    forms = {"a[.]b": "a.b", "a[[.]]b": "a.b", "hXXps[:]//a(dot)b{.}c[/]d.": "https://a.b.c/d", "hxxp://a": "http://a", "a.": "a", " a.b ": "a.b", "a(b": "a(b", "xhxxp:": "xhxxp:", "": "", None: None}
    rows = spark.createDataFrame([(v,) for v in forms], "v string").select("v", urls.undefang(F.col("v")).alias("u")).collect()
    assert {r["v"]: r["u"] for r in rows} == forms
    hosts = {"a.b.com": 1, "x.co.uk": 2, "co.uk": 2, "a.x.ck": 2, "www.ck": 1, "b.www.ck": 1, "ck": 1, "a..com": 1, "com.": 1, ".com": 1, "zz": 1, "": 1, None: 1}
    found = matching.public_suffix_depth(spark.createDataFrame([(h,) for h in hosts], "h string"), "h", psl_of(spark))
    assert {r["h"]: r["suffix_labels"] for r in found.collect()} == hosts
    up = matching.each_parent(found.where("h != ''"), "h", "up", "h").collect()
    want = found.where("h != ''").select("h", F.posexplode(matching.parents(F.col("h"), F.col("suffix_labels")))).collect()
    assert sorted(map(tuple, (r for r in up))) == sorted(map(tuple, want)) and len(up) == 3
