"""Blocklist rows as lists publish them: filters, the latest sighting of each value, the outcome of each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import urls as U
from vigil.functions.addresses import is_public_address
from vigil.operators.matching import public_suffix_depth, registrable
from vigil.plans.materialize import materialize

# Types taken, least confidence, longest value, most rows of the list without dates.
TYPES = ("ip", "domain", "url", "md5", "sha1", "sha256")
MIN_CONFIDENCE, MAX_CHARS, MAX_ADDRESSES = 75, 512, 20_000


def feed_stamp(text: Column) -> Column:
    """Timestamp of a list's text, UTC where it names no zone; a date without a time is null."""
    plain = F.regexp_replace(F.trim(text), r" UTC$", "")
    return F.coalesce(*(F.try_to_timestamp(plain, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss")))


def feed_rows(items: DataFrame, psl: DataFrame, seen_at: Column) -> DataFrame:
    """Rows worth keeping of a watch-list, one a source, type and value, with the registrable domain of each domain.

    items: source, ioc_type, value, port, threat_type, malware, first_seen, last_seen (texts), ioc_id, confidence and pos (the place in the
    list). threatfox: known types of enough confidence, the latest sighting of a value (the first of equal ones). feodo: addresses, the last
    row listed. et_compromised: IPv4 addresses, first seen now (``seen_at``). Hashes need the length of their type, addresses must be public.
    """
    source = F.col("source")
    confidence = F.expr("coalesce(try_cast(confidence AS int), 0)")
    kind = F.col("ioc_type")
    raw = F.trim("value")
    is_hash = kind.isin("md5", "sha1", "sha256")
    value = F.when(is_hash, F.lower(raw)).otherwise(U.normalize_indicator(raw, kind))
    first = F.when(source == "et_compromised", seen_at).otherwise(feed_stamp(F.col("first_seen")))
    last = F.when(source != "et_compromised", feed_stamp(F.col("last_seen")))
    taken = F.when(source == "threatfox", kind.isin(*TYPES) & (confidence >= MIN_CONFIDENCE)).when(source == "feodo", kind == "ip").when(source == "et_compromised", (kind == "ip") & U.ipv4_to_long(raw).isNotNull()).otherwise(False)
    rows = items.where(taken & (raw != "")).select(
        "source", kind.alias("indicator_type"), value.alias("value"), F.when(source == "feodo", "botnet_cc").when(source == "et_compromised", "compromised").otherwise(F.col("threat_type")).alias("threat_type"),
        F.when(source != "et_compromised", F.nullif(F.trim("malware"), F.lit(""))).alias("malware"), F.when(source == "threatfox", confidence).alias("confidence"),
        F.when(source != "et_compromised", F.col("port")).alias("port"), first.alias("first_seen"), last.alias("last_seen"), "ioc_id", "pos")
    fits = F.when(F.col("indicator_type").isin("md5", "sha1", "sha256"), F.coalesce(U.hash_type(F.col("value")) == F.col("indicator_type"), F.lit(False))).when(
        F.col("indicator_type") == "ip", F.coalesce(is_public_address(F.col("value")), F.lit(False))).otherwise(True)
    rows = rows.where(fits & F.col("first_seen").isNotNull() & (F.length("value") <= MAX_CHARS))
    # the greatest order wins: the latest sighting and of equal ones the first row, or the last row listed
    latest = F.when(F.col("source") == "threatfox", F.unix_micros(F.coalesce("last_seen", "first_seen"))).otherwise(F.lit(0).cast("long"))
    place = F.when(F.col("source") == "threatfox", -F.col("pos")).otherwise(F.col("pos"))
    rest = [c for c in rows.columns if c not in ("source", "indicator_type")]
    best = rows.groupBy("source", "indicator_type", F.lower("value").alias("_v")).agg(F.max_by(F.struct(*rest), F.struct(latest.alias("t"), place.alias("p"))).alias("r")).select("source", "indicator_type", "r.*").drop("pos")
    # written once: the suffix rules read it twice, and its values took long expressions
    name = F.when(F.col("indicator_type") == "domain", F.lower("value"))
    known = public_suffix_depth(materialize(best.withColumn("_name", name), "feed"), "_name", psl)
    return known.withColumn("registrable", F.nullif(registrable(F.col("_name"), F.col("suffix_labels")), F.lit(""))).drop("_name", "suffix_labels")


def feed_summary(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Per source: whether it answered, rows it listed, rows kept, its error; and whether any source answered.

    rows: as ``feed_rows``. state: source, ok, listed_now, error. A list of addresses beyond its bound is an error of its source.
    """
    kept = rows.groupBy("source").agg(F.count(F.lit(1)).alias("kept"))
    out = state.join(kept, "source", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
    over = (F.col("source") == "et_compromised") & (F.col("kept") > MAX_ADDRESSES)
    ok = F.coalesce("ok", F.lit(False)) & ~over
    out = out.select("source", ok.alias("ok"), F.when(ok, F.coalesce(F.col("listed_now").cast("long"), F.col("kept"))).otherwise(0).alias("listed"), F.when(ok, F.col("kept")).otherwise(0).alias("kept"),
                     F.when(over, "more addresses than the list can hold").when(~ok, F.coalesce("error", F.lit("unknown error"))).alias("error"))
    any_ok = out.agg(F.bool_or("ok").alias("any_ok"), F.lit(1).alias("_k"))
    return out.withColumn("_k", F.lit(1)).join(any_ok, "_k").drop("_k")  # one row a source
