"""Batch lookup and enrichment of observables over three sides: published values, analysed samples, blocklists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.functions import urls as U
from vigil.operators.matching import match_parsed, parents, parse_observables, registrable
from vigil.plans.materialize import materialize

#: Relations that count as headline hits.
HEADLINE = ("exact", "same_host", "parent_domain")


def latest_cve(cve_intel: DataFrame) -> DataFrame:
    """The record of the newest report day of each CVE (report_date, cve_id and record columns), with that day as observed_on."""
    rest = [c for c in cve_intel.columns if c not in ("report_date", "cve_id")]
    newest = cve_intel.groupBy(F.upper("cve_id").alias("cve_id")).agg(F.max_by(F.struct(*rest), "report_date").alias("r"), F.max("report_date").alias("observed_on"))
    return newest.select("cve_id", "r.*", "observed_on")


def citations(rows: DataFrame, detail: str = "compact") -> DataFrame:
    """Citations of each value, unique by publisher and article, numbered from 1 in order of report day and place: the first (compact) or all (full).

    rows: value_lc, publisher, article_title, article_url, published_at, report_date, seq.
    """
    once = rows.groupBy("value_lc", "publisher", "article_url").agg(F.min_by(F.struct("report_date", "seq", "article_title", "published_at"), F.struct("report_date", "seq")).alias("c"))
    flat = once.select("value_lc", "publisher", "article_url", "c.*")
    if detail == "compact":
        first = flat.groupBy("value_lc").agg(F.count(F.lit(1)).alias("citation_count"), F.min(F.struct("report_date", "seq", "publisher", "article_title", "article_url", "published_at")).alias("c"))
        return first.select("value_lc", F.lit(1).alias("rank"), "citation_count", "c.*")
    order = Window.partitionBy("value_lc").orderBy("report_date", "seq", "publisher", "article_url")
    return flat.withColumns({"rank": F.row_number().over(order), "citation_count": F.count(F.lit(1)).over(Window.partitionBy("value_lc"))})


def _service_skip(guard: Column, kind: Column) -> Column:
    """Why the service does not look a value up; an unknown type comes after the guard."""
    return F.coalesce(guard, F.when(kind.isin("unknown", "empty"), "unsupported_type"))


def lookup_batch(observables: DataFrame, indicators: DataFrame, psl: DataFrame, since: Column | None = None) -> DataFrame:
    """Every input once: found, the candidate that matched (the most specific one), whether exactly, and the days it was seen on.

    observables: input_index, value. indicators: report_date, value, benign_basis. A hash or CVE is looked up as it is, a host with its
    ancestors down to the registrable domain, a URL whole and then its host. A value that is held back matches only exactly. Indicators
    are folded to one row a value (a set of days) before they meet the candidates. ``status`` is found, absent or skipped.
    """
    if since is not None:
        indicators = indicators.where(F.col("report_date") >= since)
    known = indicators.groupBy(F.lower("value").alias("candidate")).agg(
        F.array_sort(F.collect_set("report_date")).alias("seen_on"), F.count(F.lit(1)).alias("n_hits"), F.max(F.col("benign_basis").isNotNull()).alias("held"))
    rows = parse_observables(observables, psl, _service_skip)
    asked = rows.where("skip IS NULL")
    host_like = F.col("type_used").isin("domain", "url")
    ladder = F.when(host_like, F.concat(F.array("whole", "key"), parents(F.col("key"), F.col("suffix_labels")))).otherwise(F.array(F.when(F.col("type_used") == "ip", F.col("key")).otherwise(F.col("whole"))))
    tried = asked.select("input_index", "whole", "key", "type_used", F.posexplode(F.array_distinct(ladder)).alias("depth", "candidate"))
    own = F.col("candidate") == F.when(F.col("type_used") == "ip", F.col("key")).otherwise(F.col("whole"))
    met = tried.join(known, "candidate").where(own | ~F.col("held")).withColumn("exact", own)
    best = met.groupBy("input_index").agg(F.min_by(F.struct("candidate", "exact", "seen_on", "n_hits"), "depth").alias("m"))
    status = F.when(F.col("skip").isNotNull(), "skipped").when(F.col("m").isNotNull(), "found").otherwise("absent")
    return rows.join(best, "input_index", "left").select(
        "input_index", "value", status.alias("status"), F.col("skip").alias("reason"), F.col("m.candidate").alias("matched_on"), F.coalesce("m.exact", F.lit(False)).alias("exact"),
        F.get("m.seen_on", F.lit(0)).alias("first_seen"), F.try_element_at("m.seen_on", F.lit(-1)).alias("last_seen"), F.coalesce("m.seen_on", F.array().cast("array<date>")).alias("seen_on"), F.coalesce("m.n_hits", F.lit(0).cast("long")).alias("n_hits"))


def lookup_counts(verdicts: DataFrame) -> DataFrame:
    """Requested, processed, skipped, failed and found of a batch, and whether it is complete, partial or failed. Skips alone never make it partial."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    out = verdicts.agg(F.count(F.lit(1)).alias("requested"), n("found", "absent").alias("processed"), n("skipped").alias("skipped"), n("error").alias("failed"), n("found").alias("found"))
    return out.withColumn("status", F.when(F.col("failed") == 0, "complete").when(F.col("processed") == 0, "failed").otherwise("partial"))


def samples_by_hash(asked: DataFrame, analyses: DataFrame) -> DataFrame:
    """(input_index, sha256) of the samples that a hash names, by any of their three hashes. asked: input_index, key, type_used; one equi-join a hash."""
    one = lambda c: asked.where(F.col("type_used") == c).select("input_index", F.col("key").alias(c)).join(analyses.select(c, *({"sha256"} - {c})), c).select("input_index", "sha256")
    return reduce(DataFrame.unionByName, map(one, ("sha256", "md5", "sha1"))).distinct()


def sample_hits(asked: DataFrame, indicators: DataFrame, analyses: DataFrame, k: int = 5) -> DataFrame:
    """Per input: the number of analysed samples that hold the value (exactly, or the URL but for a slash), the ``k`` strongest, and the sample that a hash names.

    asked: input_index, key, whole, type_used. indicators: sha256, value, confidence, first_seen_at. analyses: sha256, md5, sha1.
    """
    held = indicators.select(U.whole_url_key(F.col("value")).alias("whole"), "sha256", "confidence", "first_seen_at").join(analyses.select("sha256").distinct(), "sha256", "left_semi")
    values = asked.select("input_index", F.when(F.col("type_used") == "ip", F.col("key")).otherwise(F.col("whole")).alias("whole")).distinct()
    wanted = materialize(held.join(values.select("whole").distinct(), "whole", "left_semi"), "wanted")  # counted and ranked
    counts = wanted.groupBy("whole").agg(F.countDistinct("sha256").alias("sample_count"))
    order = Window.partitionBy("whole").orderBy(F.desc("confidence"), F.desc("first_seen_at"), "sha256")
    top = wanted.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).groupBy("whole").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "sha256"))), lambda x: x["sha256"]).alias("samples"))
    inside = values.join(counts, "whole").join(top, "whole").select("input_index", "sample_count", "samples")
    named = samples_by_hash(asked, analyses).groupBy("input_index").agg(F.min("sha256").alias("resolved_sha256"))
    return inside.join(named, "input_index", "full")


def feed_entries(asked: DataFrame, feeds: DataFrame, k: int = 5) -> DataFrame:
    """Per input: how a blocklist holds it (exact, same_host, or parent_domain for its registrable domain alone), the value, its sources and the ``k`` latest entries.

    asked: input_index, key, whole, type_used, suffix_labels. feeds: source, value, first_seen, last_seen. Entries are folded to one row a value.
    """
    rows = feeds.withColumn("listed", U.whole_url_key(F.col("value")))
    order = Window.partitionBy("listed").orderBy(F.coalesce("last_seen", "first_seen").desc(), "source")
    folded = rows.withColumn("r", F.row_number().over(order)).groupBy("listed").agg(
        F.count(F.lit(1)).alias("entry_count"), F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.collect_list(F.when(F.col("r") <= k, F.struct("r", "source")))).alias("top"))
    folded = folded.withColumn("entries", F.transform("top", lambda x: x["source"])).drop("top")
    is_name = F.col("type_used").isin("domain", "url")
    apex = registrable(F.col("key"), F.col("suffix_labels"))
    ladder = F.array_compact(F.array(
        F.struct(F.lit(1).alias("rank"), F.lit("exact").alias("feed_match"), F.when(F.col("type_used") == "ip", F.col("key")).otherwise(F.col("whole")).alias("listed")),
        F.when(F.col("type_used") == "url", F.struct(F.lit(2).alias("rank"), F.lit("same_host").alias("feed_match"), F.col("key").alias("listed"))),
        F.when(is_name & (apex != "") & (apex != F.col("key")), F.struct(F.lit(3).alias("rank"), F.lit("parent_domain").alias("feed_match"), apex.alias("listed")))))
    met = asked.select("input_index", F.inline(ladder)).join(folded, "listed")
    best = met.groupBy("input_index").agg(F.min_by(F.struct("feed_match", F.col("listed").alias("feed_value"), "entry_count", "sources", "entries"), "rank").alias("m"))
    return best.select("input_index", "m.*")


def enrich_observables(observables: DataFrame, values: DataFrame, excluded: DataFrame, cites: DataFrame, cve_intel: DataFrame, sample_indicators: DataFrame, analyses: DataFrame, feeds: DataFrame,
                       psl: DataFrame, corpus_end: Column) -> DataFrame:
    """One row for every input, in exactly one bucket: hit, excluded, side_only (a sample or a list holds it), unseen, skipped or error.

    observables: input_index, value and, where given, type_supplied. values: value_lc, indicator_type, benign_basis, first_seen, last_seen,
    report_count, source_count, publishers, action, priority. excluded: value_lc, reason_codes. cites: as ``citations`` takes.
    cve_intel: report_date, cve_id, kev, cvss_score, cvss_severity, epss_score. Samples and feeds as ``sample_hits`` and ``feed_entries`` take.
    A match that no citation backs is an error. Days since the last sighting count to ``corpus_end``, so they depend on the corpus alone.
    """
    asked = parse_observables(observables, psl, _service_skip)
    news = match_parsed(asked, values.select("value_lc", "indicator_type", "benign_basis"), excluded.select("value_lc"), psl).select("input_index", "status", "match_method", "matched_value")
    news = materialize(news, "news")
    live = asked.where("skip IS NULL").select("input_index", "key", "whole", "type_used", "suffix_labels")
    rows = asked.select("input_index", "value", "type_used", "skip", "key").join(news, "input_index", "left")
    rows = rows.join(values.withColumnsRenamed({"value_lc": "matched_value", "indicator_type": "matched_type"}), "matched_value", "left")
    first = citations(cites).select(F.col("value_lc").alias("matched_value"), "citation_count", F.col("publisher").alias("cited_publisher"), F.col("article_url").alias("cited_url"))
    rows = rows.join(first, "matched_value", "left")
    rows = rows.join(excluded.select(F.col("value_lc").alias("matched_value"), F.col("reason_codes").alias("excluded_reasons")), "matched_value", "left")
    cve = latest_cve(cve_intel).select(F.lower("cve_id").alias("matched_value"), "kev", "cvss_score", "cvss_severity", "epss_score", "observed_on")
    rows = rows.join(cve, "matched_value", "left")
    rows = rows.join(materialize(sample_hits(live, sample_indicators, analyses), "sample-hits"), "input_index", "left").join(materialize(feed_entries(live, feeds), "feed-hits"), "input_index", "left")
    hit, side = F.col("status") == "hit", F.col("sample_count").isNotNull() | F.col("resolved_sha256").isNotNull() | F.col("feed_match").isNotNull()
    bucket = (F.when(F.col("skip").isNotNull(), "skipped").when(hit & F.col("citation_count").isNull(), "error").when(hit, "hit").when(F.col("status") == "excluded", "excluded").when(side, "side_only").otherwise("unseen"))
    rows = rows.withColumn("bucket", bucket)
    of_hit = lambda c: F.when(F.col("bucket") == "hit", c)
    is_cve = F.col("matched_type") == "cve"
    code = F.coalesce("benign_basis", F.when(is_cve, F.when(F.col("kev"), "kev_listed").when(F.col("cvss_score").isNotNull(), F.concat(F.lit("cvss_"), F.lower("cvss_severity"))).otherwise("cve_reported")), F.lit("publisher_indicator"))
    shown = ["first_seen", "last_seen", "report_count", "source_count", "publishers", "action", "priority", "benign_basis", "citation_count", "cited_publisher", "cited_url"]
    return rows.select(
        "input_index", "value", F.col("type_used").alias("type"), "bucket", F.coalesce("skip", F.when(F.col("bucket") == "error", "missing_citation")).alias("reason"),
        F.when(F.col("bucket").isin("hit", "excluded"), F.col("match_method")).alias("match"), F.when(F.col("bucket").isin("hit", "excluded"), F.col("matched_value")).alias("matched_value"),
        of_hit(F.col("match_method").isin(*HEADLINE)).alias("headline"), of_hit(F.when(F.col("benign_basis").isNotNull(), "benign_listed").otherwise("source_reported")).alias("verdict"),
        of_hit(F.when(F.col("match_method") == "same_host", "host").when(F.col("match_method").isin("parent_domain", "child_domain"), "registrable_domain")).alias("match_boundary"),
        *(of_hit(F.col(c)).alias(c) for c in shown), of_hit(F.datediff(corpus_end, "last_seen")).alias("days_since_last_seen"), of_hit(code).alias("reason_code"),
        *(F.when((F.col("bucket") == "hit") & is_cve, F.col(c)).alias(c) for c in ("kev", "cvss_score", "epss_score", "observed_on")),
        F.when(F.col("bucket") == "excluded", F.col("excluded_reasons")).alias("excluded_reasons"), "sample_count", "samples", "resolved_sha256", "feed_match", "feed_value", "entry_count", "sources", "entries")


def enrich_counts(enriched: DataFrame) -> DataFrame:
    """Counts of an enrichment: requested, processed, hits, headline hits, excluded, sample and feed hits, unseen, skipped, failed, and the status of the batch."""
    n = lambda *s: F.count_if(F.col("bucket").isin(*s))
    held = F.col("sample_count").isNotNull() | F.col("resolved_sha256").isNotNull()
    out = enriched.agg(
        F.count(F.lit(1)).alias("requested"), n("hit", "excluded", "side_only", "unseen").alias("processed"), n("hit").alias("hits"), F.count_if(F.coalesce("headline", F.lit(False))).alias("headline_hits"), n("excluded").alias("excluded"),
        F.count_if(held).alias("sample_hits"), F.count_if(F.col("feed_match").isNotNull()).alias("feed_hits"), n("unseen").alias("unseen"), n("skipped").alias("skipped"), n("error").alias("failed"))
    return out.withColumn("status", F.when(F.col("failed") == 0, "complete").when(F.col("processed") == 0, "failed").otherwise("partial"))
