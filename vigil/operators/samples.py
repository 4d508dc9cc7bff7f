"""Analysed malware samples: their table, their indicators, and how new readings join the stored ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import urls as U
from vigil.functions.addresses import is_public_address
from vigil.plans.materialize import spread

# Types served under their own name, and those that are taken as they were found.
ARTEFACTS = ("mutex", "path", "email", "registry")
PASSED = ("ip", "domain", "url", *ARTEFACTS)
MAX_CHARS = 512


def _text(name: str) -> Column:
    return F.nullif(F.trim(name), F.lit(""))


def sample_table(jobs: DataFrame, summaries: DataFrame, records: DataFrame, techniques: DataFrame) -> DataFrame:
    """One row a sample: the job's columns with its summary, file record and ATT&CK ids in the order found. A missing summary or record never drops a sample.

    jobs: sha256, job_id, sample_id, submitted_at, finished_at, file_type, size_bytes. summaries: job_id, verdict_label, verdict_score, family,
    family_confidence, ioc_total. records: sample_id, md5, sha1, mime, uploaded_at. techniques: job_id, technique_id, pos. Of several jobs of a sample the one finished last counts.
    """
    rest = [c for c in jobs.columns if c != "sha256"]
    last = jobs.where(_text("sha256").isNotNull() & _text("job_id").isNotNull()).groupBy(F.lower(F.trim("sha256")).alias("sha256")).agg(F.max_by(F.struct(*rest), F.struct(F.coalesce("finished_at", F.lit("")).alias("f"), F.col("job_id").alias("j"))).alias("j")).select("sha256", "j.*")
    first = techniques.where(_text("technique_id").isNotNull()).groupBy("job_id", F.trim("technique_id").alias("id")).agg(F.min("pos").alias("p"))
    ids = first.groupBy("job_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "id"))), lambda x: x["id"]).alias("attack_techniques"))
    out = last.join(summaries, "job_id", "left").join(records, "sample_id", "left").join(ids, "job_id", "left")
    return out.select(
        "sha256", "job_id", F.lower(_text("md5")).alias("md5"), F.lower(_text("sha1")).alias("sha1"), "size_bytes", F.coalesce(_text("file_type"), _text("mime")).alias("file_type"),
        F.coalesce(_text("submitted_at"), _text("uploaded_at")).alias("submitted_at"), _text("finished_at").alias("finished_at"), _text("verdict_label").alias("verdict"), "verdict_score", _text("family").alias("family"),
        "family_confidence", F.coalesce("attack_techniques", F.array().cast("array<string>")).alias("attack_techniques"), "ioc_total")


def sample_rows(iocs: DataFrame) -> DataFrame:
    """Indicators as they are served: hashes under their kind, artefacts as found, the rest in comparable form; the most confident reading of each value of a sample, the first of equal ones (of several at one place the largest integration, then date).

    iocs: sha256, ioc_type, value, confidence, source_integration_id, first_seen_at and pos.
    """
    # readings that are written alike meet first, as the comparable form takes long expressions
    reading = F.struct(F.coalesce(F.expr("try_cast(confidence AS int)"), F.lit(0)).alias("confidence"), (-F.col("pos")).alias("p"), _text("source_integration_id").alias("integration"), F.coalesce(_text("first_seen_at"), F.lit("")).alias("first_seen_at"))
    written = spread(iocs.groupBy("sha256", "ioc_type", "value").agg(F.max(reading).alias("r")))
    raw, kind = F.trim("value"), F.trim("ioc_type")
    served = F.when(kind == "hash", U.hash_type(raw)).when(kind.isin(*PASSED), kind)
    rows = written.withColumn("indicator_type", served).where("indicator_type IS NOT NULL")
    value = F.when(F.col("indicator_type").isin(*ARTEFACTS), raw).otherwise(U.normalize_indicator(raw, F.col("indicator_type")))
    rows = rows.select(F.lower(F.trim("sha256")).alias("sha256"), "indicator_type", value.alias("value"), "r")
    fits = (F.length("value") > 0) & (F.length("value") <= MAX_CHARS) & ((F.col("indicator_type") != "ip") | F.coalesce(is_public_address(F.col("value")), F.lit(False)))
    best = rows.where(fits).groupBy("sha256", "indicator_type", F.lower("value").alias("_v")).agg(F.max(F.struct("r", "value")).alias("b"))
    return best.select("sha256", "indicator_type", "b.value", "b.r.confidence", "b.r.integration", "b.r.first_seen_at")


def merge_samples(stored: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = ("sha256",)) -> DataFrame:
    """Upsert by key: an incoming row replaces the stored one, all others stay. Repeating it changes nothing."""
    kept = stored.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(incoming.dropDuplicates(list(keys)))


def new_since(jobs: DataFrame, mark: DataFrame) -> DataFrame:
    """Jobs finished after the high-water mark (one row, high_water; null reads all)."""
    limit = F.broadcast(mark.select("high_water", F.lit(1).alias("_k")))
    return jobs.withColumn("_k", F.lit(1)).join(limit, "_k").where(F.col("high_water").isNull() | (F.col("finished_at") > F.col("high_water"))).drop("_k", "high_water")


def high_water(samples: DataFrame, previous: DataFrame) -> DataFrame:
    """One row, the newest finished_at consumed so far."""
    return samples.select(F.col("finished_at").alias("t")).unionByName(previous.select(F.col("high_water").alias("t"))).agg(F.max("t").alias("high_water"))


def integration_share(indicators: DataFrame) -> DataFrame:
    """Indicators by the integration that extracted them, and their share of all (four places)."""
    counts = indicators.groupBy(F.coalesce("integration", F.lit("unknown")).alias("integration")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"), F.lit(1).alias("_k"))
    return counts.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").select("integration", "n", F.round(F.col("n") / F.col("_t"), 4).alias("share"))
