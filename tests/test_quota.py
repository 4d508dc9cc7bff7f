"""Call quotas: the whole table, and streams that cut its minutes and days in two."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigil.operators import corpus
from vigil.streaming import quota

LIMITS = [("a", 3, 10), ("b", 2, 100), ("zero", 0, 5), ("day0", 5, 0), ("odd", -1, None)]


def table(spark, rows):
    return spark.createDataFrame(rows, "token string, ts timestamp")


def limits(spark):
    return spark.createDataFrame(LIMITS, "token string, per_minute int, per_day int")


def at(text):
    return datetime.fromisoformat(text)


def answers(df):
    return sorted(map(tuple, df.select("token", F.col("ts").cast("string"), "refused", "retry_after").collect()), key=repr)


def whole(spark, rows):
    return answers(corpus.refused_calls(table(spark, rows), limits(spark)).withColumn("retry_after", corpus.retry_after(F.col("ts"), F.col("refused"))))


def test_minute_and_day_limits(spark):
    rows = [("b", at("2026-09-17 10:31:07"))] * 3 + [("b", at("2026-09-17 10:31:59")), ("b", at("2026-09-17 10:32:00")), ("zero", at("2026-09-17 00:00:00")), ("day0", at("2026-09-17 23:59:58.500000")), ("odd", at("2026-09-17 01:00:00"))]
    assert whole(spark, rows) == sorted([
        ("b", "2026-09-17 10:31:07", None, None), ("b", "2026-09-17 10:31:07", None, None), ("b", "2026-09-17 10:31:07", "minute", 53), ("b", "2026-09-17 10:31:59", "minute", 1),
        ("b", "2026-09-17 10:32:00", None, None), ("zero", "2026-09-17 00:00:00", "minute", 60), ("day0", "2026-09-17 23:59:58.5", "day", 2), ("odd", "2026-09-17 01:00:00", None, None)], key=repr)


def test_calls_over_the_minute_do_not_spend_the_day(spark):
    rows = [("a", at("2026-09-17 10:00:00") + timedelta(seconds=10 * k)) for k in range(40)]
    found = [r[2] for r in whole(spark, rows)]
    assert found.count(None) == 10 and found.count("day") == 11 and found[:6] == [None] * 3 + ["minute"] * 3


def stream(spark, folder, batches, stop_after=None):
    """The answers after one micro-batch for each list of calls, and after a restart behind each."""
    schema, out = "token string, ts timestamp", str(folder / "out")
    for k, rows in enumerate(batches):
        table(spark, rows).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        calls = spark.readStream.schema(schema).parquet(str(folder / "in"))
        q = quota.refuse_calls(calls, limits(spark)).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(folder / "state")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    return answers(spark.read.parquet(out))


@pytest.fixture
def own_state(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    yield
    spark.conf.set(key, before)


def test_stream_refuses_what_the_table_refuses(spark, tmp_path, own_state):
    start = at("2026-09-17 23:58:00")
    rows = [(t, start + timedelta(seconds=4 * k + i)) for i, t in enumerate(("a", "b", "zero", "odd")) for k in range(60)]
    rows.sort(key=lambda r: r[1])
    cut = [r for r in rows if r[1] < start + timedelta(seconds=30)], [r for r in rows if timedelta(seconds=30) <= r[1] - start < timedelta(seconds=150)], [r for r in rows if r[1] >= start + timedelta(seconds=150)]
    assert stream(spark, tmp_path, cut) == whole(spark, rows)


def test_a_day_that_is_over_leaves_no_state(spark, tmp_path, own_state):
    days = [[("a", at("2026-09-17 10:00:00"))], [("a", at("2026-09-19 10:00:00"))], [("a", at("2026-09-21 10:00:00"))]]
    assert len(stream(spark, tmp_path, days)) == 3
    left = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "passed").load()
    assert [str(r.key.day) for r in left.select("key").collect()] == ["2026-09-21"]
