"""Structured Streaming jobs over entries, calls and observables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import urls
from vigil.operators import state
from vigil.operators.corpus import is_stale
from vigil.operators.extract import extract_evidence
from vigil.operators.matching import corpus_sides, match_sides, parse_observables
from vigil.plans.materialize import discard, materialize
from vigil.sources.versions import Store, update

#: A report day starts at 06:00 in Taipei, which is 22:00 UTC.
SLOT_OFFSET = "22 hours"


def daily_entries(entries: DataFrame, late: str = "7 days") -> DataFrame:
    """Entries (published_at timestamp, url, source) counted by report day and source; an entry counts once, up to ``late`` after its day."""
    unique = entries.withColumn("canonical", urls.canonical_url(F.col("url"))).withWatermark("published_at", late).dropDuplicatesWithinWatermark(["canonical"])
    return unique.groupBy(F.window("published_at", "1 day", "1 day", SLOT_OFFSET).alias("slot"), "source").agg(F.count(F.lit(1)).alias("n_entries"))


def late_counts(entries: DataFrame, late: str = "7 days") -> DataFrame:
    """Entries of each source and arrival day that are older than the arrival's slot. ``entries`` also has arrived_at."""
    slot = F.date_trunc("day", F.col("arrived_at") + F.expr("INTERVAL 2 HOURS")) - F.expr("INTERVAL 2 HOURS")
    marked = entries.withWatermark("arrived_at", late).withColumn("late", F.col("published_at") < slot)
    return marked.groupBy(F.window("arrived_at", "1 day", "1 day", SLOT_OFFSET).alias("slot"), "source").agg(F.count_if(F.col("late")).alias("n_late"), F.count(F.lit(1)).alias("n"))


def quota(calls: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Calls (ts timestamp, token) of each token and UTC minute."""
    return calls.withWatermark("ts", delay).groupBy(F.window("ts", "1 minute").alias("minute"), "token").agg(F.count(F.lit(1)).alias("n_calls"))


def stream_evidence(articles: DataFrame, tlds: tuple[str, ...]) -> DataFrame:
    """Evidence of arriving articles (url, body, publisher_hosts). Extraction works row by row, so the stream keeps no state."""
    return extract_evidence(articles, tlds)


def stream_samples(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Finished sample jobs as files arrive under ``path``; the checkpoint's file log is the high-water mark."""
    return spark.readStream.schema(schema).json(path)


def upsert_samples(store: Store, iocs_of: Callable[[DataFrame], DataFrame], name: str = "samples") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: a batch's samples and the indicators that ``iocs_of`` has of them replace the stored ones, and the high-water row moves, in one commit.

    Of a sample's rows the last finished counts. ``name`` is the stream's; a batch that is delivered again changes nothing.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c != "sha256"]
        last = batch.groupBy("sha256").agg(F.max_by(F.struct(*rest), "finished_at").alias("r")).select("sha256", "r.*").select(batch.columns)
        state.advance_samples(store, last, iocs_of(last), (name, batch_id))

    return merge


def staleness(sides: DataFrame, now: Callable[[], Column], alarm: Callable[[DataFrame], None], hours: int = 26) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over ticks: hands over the sides (side, exported_at) whose last export is older than ``hours``."""
    return lambda batch, batch_id: alarm(sides.where(is_stale(F.col("exported_at"), now(), hours)))


def live_lookup(observables: DataFrame, corpus: DataFrame) -> DataFrame:
    """Each arriving observable (value) with the corpus row that it equals; stream to static join on the lookup key."""
    keyed = observables.withColumn("value_lc", urls.normalize_observable(F.col("value"), urls.detect_type(F.col("value"))))
    return keyed.join(corpus, "value_lc", "left")


def live_verdicts(store: Store, psl: DataFrame, name: str = "verdicts") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the verdicts of ``match_observables`` on arriving observables (input_index, value, type_supplied), by all relations.

    Each batch is matched with the tables ``values`` and ``excluded`` of the store's newest version, which it is told with
    (corpus_version), so a refreshed corpus counts from the next batch on, whole. No state is kept; verdicts go to the table ``name``,
    one part a batch, and a batch that is delivered again changes nothing. What depends on the values alone is made once for all batches
    that find the same values.
    """
    held: dict = {}

    def sides(version: int) -> tuple[DataFrame, DataFrame]:
        parts = store.manifest(version)["tables"]["values"]["parts"]
        if held.get("parts") != parts:
            for old in held.get("sides", ()):
                discard(old)
            made = corpus_sides(store.read("values", version), psl)
            held.update(parts=parts, sides=tuple(materialize(df, "sides") for df in made))
        return held["sides"]

    def match(batch: DataFrame, batch_id: int) -> None:
        version = store.version()
        # a batch may come as one short file, which one task would parse
        dealt = batch.repartition(2 * store.spark.sparkContext.defaultParallelism, "input_index")
        found = match_sides(parse_observables(dealt, psl, urls.judge_skip), *sides(version), store.read("excluded", version))
        told = found.withColumns({"corpus_version": F.lit(version), "batch": F.lit(batch_id).cast("long")})
        update(store, lambda _: {name: told}, (name, batch_id), by_part={name: "batch"})

    return match


def maintain_feed(store: Store, ok_sources: DataFrame, now: Callable[[], Column], name: str = "feed") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: a batch of listed rows makes the next state of the blocklist table; one delivered again changes nothing."""
    return lambda batch, batch_id: state.advance_feed(store, batch, ok_sources, now(), (name, batch_id))


def replace_days(store: Store, name: str = "days") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: a batch replaces the report days that it holds; one delivered again changes nothing."""
    return lambda batch, batch_id: state.replace_days(store, batch, (name, batch_id))
