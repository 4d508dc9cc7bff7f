"""Committed state: all tables of a commit or none, marks, parts, conflicts."""

import pytest
from pyspark.sql import functions as F

from vigil.operators import state
from vigil.sources import readers
from vigil.sources.versions import ConflictError, Store


def rows(df):
    return sorted(map(tuple, df.collect()))


def samples(spark, found):
    return spark.createDataFrame(found, "sha256 string, finished_at string, family string")


def iocs(spark, found):
    return spark.createDataFrame(found, "sha256 string, value string")


def test_a_failure_between_two_writes_leaves_the_old_version_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = {"values": spark.range(5), "excluded": spark.range(2), "cve": spark.range(1)}
    assert state.write_snapshot(store, first) == 1
    broken = spark.range(9).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        state.write_snapshot(store, {"values": spark.range(7), "excluded": broken, "cve": spark.range(3)})
    assert store.version() == 1 and [store.read(t).count() for t in first] == [5, 2, 1]
    assert state.write_snapshot(store, {"values": spark.range(7), "excluded": spark.range(3)}) == 2
    assert [store.read(t).count() for t in first] == [7, 3, 1] and store.read("values", 1).count() == 5
    assert store.prune(keep=1) == 4 and [store.read(t).count() for t in first] == [7, 3, 1]


def test_two_writers_from_one_version(spark, tmp_path):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    one.commit({"t": spark.range(1)})
    base = two.version()
    one.commit({"t": spark.range(2)})
    with pytest.raises(ConflictError):
        two.commit({"t": spark.range(3)}, base=base)
    assert two.read("t").count() == 2


def test_days_are_replaced_one_by_one_and_batches_once(spark, tmp_path):
    store, schema = Store(spark, str(tmp_path)), "report_date date, value string"
    make = lambda found: spark.createDataFrame(found, "d string, value string").select(F.col("d").cast("date").alias("report_date"), "value")
    state.replace_days(store, make([("2026-01-01", "a"), ("2026-01-01", "b"), ("2026-01-02", "c")]), ("build", 0))
    state.replace_days(store, make([("2026-01-02", "d"), ("2026-01-03", "e")]), ("build", 1))
    state.replace_days(store, make([("2026-01-02", "again")]), ("build", 1))
    found = store.read(state.DAYS)
    assert [str(x) for x in found.dtypes] == [str(x) for x in spark.createDataFrame([], schema).dtypes]
    assert [r.value for r in found.orderBy("value").collect()] == ["a", "b", "d", "e"]
    assert store.parts(state.DAYS) == ["2026-01-01", "2026-01-02", "2026-01-03"] and store.read(state.DAYS, parts=["2026-01-03"]).count() == 1
    state.replace_days(store, make([]), ("build", 2))
    store.drop_parts(state.DAYS, ["2026-01-01"])
    assert store.read(state.DAYS).count() == 2


def test_samples_and_their_mark_move_together(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    state.advance_samples(store, samples(spark, [("a", "2026-01-01", "x"), ("b", "2026-01-02", "y")]), iocs(spark, [("a", "1"), ("a", "2"), ("b", "3")]), ("jobs", 0))
    again = samples(spark, [("a", "2026-01-05", "z")]), iocs(spark, [("a", "9")])
    for _ in range(2):
        state.advance_samples(store, *again, ("jobs", 1))
    assert store.version() == 2
    assert rows(store.read(state.SAMPLES)) == [("a", "2026-01-05", "z"), ("b", "2026-01-02", "y")]
    assert rows(store.read(state.SAMPLE_IOCS)) == [("a", "9"), ("b", "3")] and rows(store.read(state.MARKS)) == [("2026-01-05",)]
    broken = iocs(spark, [("c", "1")]).withColumn("value", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        state.advance_samples(store, samples(spark, [("c", "2026-01-09", "w")]), broken, ("jobs", 2))
    assert rows(store.read(state.MARKS)) == [("2026-01-05",)] and store.read(state.SAMPLES).count() == 2 and store.mark("jobs") == 1


def test_ingest_stops_at_the_mark(spark, tmp_path):
    store, listed, read = Store(spark, str(tmp_path)), [], []

    def pages(k):
        read.append(k)
        part = sorted(listed, key=lambda r: r[1], reverse=True)[2 * k : 2 * k + 2]
        return samples(spark, part) if part else None

    none = lambda found: found.select("sha256", F.lit("v").alias("value"))
    listed += [("a", "2026-01-01", "x"), ("b", "2026-01-02", "x"), ("c", "2026-01-03", "x")]
    assert state.ingest_new_samples(store, pages, none) == 2
    listed += [("d", "2026-01-04", "x"), ("e", "2026-01-05", "x"), ("f", "2026-01-06", "x"), ("a", "2026-01-07", "y")]

    def fails(k):
        if k == 1:
            raise OSError("page lost")
        return pages(k)

    with pytest.raises(OSError, match="page lost"):
        state.ingest_new_samples(store, fails, none)
    assert rows(store.read(state.MARKS)) == [("2026-01-03",)]
    assert state.ingest_new_samples(store, pages, none) == 3
    assert rows(store.read(state.SAMPLES)) == [("a", "2026-01-07", "y"), *((k, f"2026-01-0{i}", "x") for i, k in enumerate("bcdef", 2))]
    assert state.ingest_new_samples(store, pages, none) == 1 and store.version() == 2


def test_feed_state(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = "source string, indicator_type string, value string, malware string, confidence int, threat_type string, port int, first_seen timestamp, last_seen timestamp"
    now = F.lit("2026-01-10").cast("timestamp")
    row = lambda v, conf: ("feodo", "ip", v, "m", conf, "c2", 1, None, None)
    ok = spark.createDataFrame([("feodo",)], "source string")
    state.advance_feed(store, spark.createDataFrame([row("1.1.1.1", 5), row("2.2.2.2", 5)], schema), ok, now, ("feed", 1))
    state.advance_feed(store, spark.createDataFrame([row("2.2.2.2", 9)], schema), ok, now, ("feed", 2))
    state.advance_feed(store, spark.createDataFrame([row("3.3.3.3", 9)], schema), ok, now, ("feed", 2))
    assert rows(store.read(state.FEED).select("value", "confidence")) == [("2.2.2.2", 9)]


def test_observables_of_many_splits_are_numbered_like_whole_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f"h{k}.evil.com,domain,s{k}" if k % 3 else f"# note {k}" if k % 2 else f"10.0.0.{k}" for k in range(400)]
    (tmp_path / "in" / "a.csv").write_text("﻿value,type,sample_id\r\n" + "\r\n".join(lines))
    (tmp_path / "in" / "b.csv").write_text("last.com\n\n  \nvery-last.com\n")
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    found = readers.read_observables(spark, str(tmp_path / "in"))
    rows, splits = found.orderBy("input_index").collect(), spark.read.text(str(tmp_path / "in")).select("_metadata.file_block_start").distinct().count()
    for k, v in before.items():
        spark.conf.set(k, v)
    want = [x for x in lines if not x.startswith("#")] + ["last.com", "very-last.com"]
    assert splits > 5 and [r.input_index for r in rows] == list(range(len(want))) and [r.value for r in rows] == [w.split(",")[0] for w in want]
    assert rows[0].sample_id == "row-1" and rows[1].sample_id == "s1" and rows[1].type_supplied == "domain"
