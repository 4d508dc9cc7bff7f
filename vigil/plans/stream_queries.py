"""Registered queries that run as streams over the supplied tables, each beside the SQL of the same result over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import corpus
from vigil.plans import report_queries as reports
from vigil.plans.materialize import scratch
from vigil.plans.registry import ORACLES, query
from vigil.sources.tables import read_table
from vigil.sources.versions import Store
from vigil.streaming import jobs, quota

_CALLS_SQL = """
WITH calls AS (SELECT 'u' || (user_id % 3) AS token, ts FROM events),
minutes AS (
  SELECT *, row_number() OVER (PARTITION BY token, date_trunc('minute', ts) ORDER BY ts) > 1 AS over FROM calls),
days AS (
  SELECT *, count(*) FILTER (WHERE NOT over) OVER (PARTITION BY token, CAST(ts AS DATE) ORDER BY ts, over ROWS UNBOUNDED PRECEDING) AS passed FROM minutes),
judged AS (SELECT token, ts, CASE WHEN over THEN 'minute' WHEN passed > CASE token WHEN 'u2' THEN 5000 ELSE 60 END THEN 'day' END AS refused FROM days)
SELECT token, epoch_us(ts) AS micros, refused,
  CAST(CASE refused WHEN 'minute' THEN 60 - extract(second FROM ts)
    WHEN 'day' THEN greatest(1, ceil((epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_us(ts)) / 1000000)) END AS INTEGER) AS retry_after
FROM judged"""


def _limits(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('u0', 1, 60), ('u1', 1, 60), ('u2', 1, -1) AS t(token, per_minute, per_day)")


def _calls(events: DataFrame) -> DataFrame:
    return events.select(F.concat(F.lit("u"), F.col("user_id") % 3).alias("token"), F.col("ts").cast("timestamp").alias("ts"))


@query(_CALLS_SQL)
def call_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = corpus.refused_calls(_calls(read_table(spark, sf_dir, "events")), _limits(spark))
    return judged.select("token", F.unix_micros("ts").alias("micros"), "refused", corpus.retry_after(F.col("ts"), F.col("refused")).alias("retry_after"))


@query(_CALLS_SQL)
def stream_call_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream over the table's files, which keeps each token's day in state."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before, folder = spark.conf.get(provider), scratch(spark, "stream")
    events = read_table(spark, sf_dir, "events")
    source = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/event[s].parquet")  # a pattern, as the table may be one file
    judged = quota.refuse_calls(_calls(source), _limits(spark))
    running = judged.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    spark.conf.set(provider, before)
    return spark.read.schema(judged.schema).parquet(f"{folder}/out").select("token", F.unix_micros("ts").alias("micros"), "refused", "retry_after")


@query(ORACLES["validate_mixed"])
def stream_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observables of ``validate_mixed`` as a stream of three batches against a committed corpus."""
    folder = scratch(spark, "stream")
    store = Store(spark, f"{folder}/store")
    values, excluded = reports._corpus_tables(spark, sf_dir)
    # the columns that are matched on; days and publishers of each value would cost more than the rest of the commit
    store.commit({"values": values.select("value_lc", "indicator_type", "benign_basis"), "excluded": excluded.select("value_lc")})
    asked = reports._asked(spark, sf_dir)
    asked.repartition(3, "input_index").write.parquet(f"{folder}/asked")
    stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/asked")
    told = stream.writeStream.foreachBatch(jobs.live_verdicts(store, reports._refs(spark, sf_dir)[2]))
    told.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return store.read("verdicts").select("input_index", "type_used", "status", "match_method", "matched_value")
