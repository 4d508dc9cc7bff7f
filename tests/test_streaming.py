"""Streaming jobs over files, run to the end of the input."""

from vigil.streaming import jobs


def test_daily_entries_and_lookup(spark, tmp_path):
    rows = [("2024-01-05 21:00:00", "http://a.example.com/1?utm_source=x", "s"), ("2024-01-05 23:00:00", "http://a.example.com/2", "s"), ("2024-01-05 23:30:00", "http://a.example.com/2#x", "s")]
    spark.createDataFrame(rows, "p string, url string, source string").selectExpr("CAST(p AS timestamp) AS published_at", "url", "source").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("published_at timestamp, url string, source string").parquet(str(tmp_path / "in"))
    q = jobs.daily_entries(stream).writeStream.format("memory").queryName("daily").outputMode("update").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((str(r["slot"]["start"]), r["n_entries"]) for r in spark.table("daily").collect()) == [("2024-01-04 22:00:00", 1), ("2024-01-05 22:00:00", 1)]
    known = spark.createDataFrame([("a.example.com", "block")], "value_lc string, action string")
    asked = stream.selectExpr("url AS value")
    q = jobs.live_lookup(asked, known).writeStream.format("memory").queryName("live").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r["action"] for r in spark.table("live").collect()} == {"block"} and spark.table("live").count() == 3
