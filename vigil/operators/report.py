"""The daily report: which articles it holds, its actions and counts, its place among other days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.functions import text as T
from vigil.functions import urls as U
from vigil.operators.analyst import ACTIONABLE, COUNTED, order_articles
from vigil.operators.corpus import unbroken_chain


def dedupe_articles(articles: DataFrame) -> DataFrame:
    """First article of each canonical URL and report day, by the source's place in the registry (``source_pos``), then the feed's order (``entry_pos``)."""
    order = F.struct("source_pos", "entry_pos", "url")
    rest = [c for c in articles.columns if c != "report_date"]
    first = articles.groupBy("report_date", U.canonical_url(F.col("url")).alias("_c")).agg(F.min_by(F.struct(*rest), order).alias("a"))
    return first.select("report_date", "a.*").select(articles.columns)


def mark_relevant(articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Add ``relevant``: an article with a confirmed finding, or whose title or summary is on the topic. articles: url, title, summary."""
    named = evidence.where("status = 'confirmed'").select("url").distinct().withColumn("_named", F.lit(True))
    return articles.join(named, "url", "left").withColumn("relevant", F.coalesce("_named", T.is_topic_relevant(F.col("title"), F.col("summary")), F.lit(False))).drop("_named")


def dedupe_indicators(rows: DataFrame) -> DataFrame:
    """First row (by ``seq``) of each report day, type, value (case aside) and article."""
    rest = [c for c in rows.columns if c not in ("report_date", "indicator_type", "article_url")]
    first = rows.groupBy("report_date", "indicator_type", F.lower("value").alias("_v"), "article_url").agg(F.min_by(F.struct(*rest), "seq").alias("r"))
    return first.select("report_date", "indicator_type", "article_url", "r.*").select(rows.columns)


def join_actions(evidence: DataFrame, actions: DataFrame) -> DataFrame:
    """Confirmed evidence with the action of its day for its type and value, else for its value under any type; the first action (``seq``) of a key counts.

    evidence: report_date, indicator_type, value. actions: report_date, target_type, target, action, priority, seq.
    """
    rows = actions.select("report_date", "target_type", F.lower("target").alias("_v"), "action", "priority", "seq")
    first = lambda keys, name: rows.groupBy(*keys).agg(F.min_by(F.struct("action", "priority"), "seq").alias(name))
    typed = first(["report_date", "target_type", "_v"], "_t").withColumnRenamed("target_type", "indicator_type")
    plain = first(["report_date", "_v"], "_p")
    found = evidence.where("status = 'confirmed'").withColumn("_v", F.lower("value")).join(typed, ["report_date", "indicator_type", "_v"], "left").join(plain, ["report_date", "_v"], "left")
    best = F.coalesce("_t", "_p")
    return found.withColumns({"action": best["action"], "priority": best["priority"]}).select(*evidence.columns, "action", "priority")


def number_actions(actions: DataFrame, articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Actions with report_date and ``seq``, their place in their day: articles by CVEs, indicators and newest, then the order in the article.

    articles: url, report_date, published_at. A window holds one day's actions.
    """
    placed = order_articles(articles.select("url", "report_date", "published_at"), evidence)
    day = Window.partitionBy("report_date").orderBy(F.desc("n_cves"), F.desc("n_iocs"), F.desc_nulls_last("published_at"), "url", "pos", "target_type", "target")
    return actions.join(placed, "url").withColumn("seq", F.row_number().over(day)).drop("n_cves", "n_iocs", "published_at")


def mark_new(actions: DataFrame, evidence: DataFrame, days: DataFrame) -> DataFrame:
    """Add ``is_new``: the target was not confirmed in the report of the day before; null for other actions and where that day has no report.

    actions: report_date, action, target_type, target. evidence: report_date, indicator_type, normalized_value, status. days: report_date.
    """
    next_day = F.date_add("report_date", 1).alias("report_date")
    before = evidence.where((F.col("status") == "confirmed") & F.col("indicator_type").isin(*COUNTED)).select(
        next_day, F.col("indicator_type").alias("target_type"), F.col("normalized_value").alias("target")).distinct().withColumn("_was", F.lit(True))
    had = days.select(next_day).distinct().withColumn("_had", F.lit(True))
    rows = actions.join(before, ["report_date", "target_type", "target"], "left").join(had, "report_date", "left")
    return rows.withColumn("is_new", F.when(F.col("_had") & F.col("action").isin(*ACTIONABLE), F.col("_was").isNull())).drop("_was", "_had")


def headline(actions: DataFrame) -> DataFrame:
    """(report_date, focus_action, focus_target) of each day: the first exploited patch, else the first of high priority, else the first to act on. actions as numbered."""
    rank = F.when((F.col("action") == "patch") & F.col("kev"), 0).when(F.col("priority") == "high", 1).otherwise(2)
    best = actions.where(F.col("action").isin(*ACTIONABLE)).groupBy("report_date").agg(F.min_by(F.struct("action", "target"), F.struct(rank, "seq")).alias("f"))
    return best.select("report_date", F.col("f.action").alias("focus_action"), F.col("f.target").alias("focus_target"))


def target_counts(actions: DataFrame) -> DataFrame:
    """Distinct targets of each day to patch, block and hunt, exploited CVEs, and distinct articles to monitor (or observe) and to review.

    Rows are made distinct first, so that no row is multiplied by the number of counts.
    """
    targets = actions.where(F.col("action").isin(*ACTIONABLE)).groupBy("report_date", "action", "target_type", "target").agg(F.max(F.coalesce("kev", F.lit(False))).alias("kev"))
    by = lambda a: F.count_if(F.col("action") == a).alias(f"{a}_count")
    acted = targets.groupBy("report_date").agg(by("patch"), by("block"), by("hunt"), F.count_if(F.col("kev") & (F.col("action") == "patch")).alias("kev_count"))
    kind = F.when(F.col("action").isin("monitor", "observe"), "monitor").when(F.col("action") == "review", "review")
    articles = actions.select("report_date", kind.alias("kind"), "url").where("kind IS NOT NULL").distinct()
    told = articles.groupBy("report_date").agg(F.count_if(F.col("kind") == "monitor").alias("monitor_count"), F.count_if(F.col("kind") == "review").alias("unavailable_count"))
    return acted.join(told, "report_date", "full").fillna(0)


def unique_confirmed(evidence: DataFrame) -> DataFrame:
    """Distinct confirmed indicators, filenames and claims of each day."""
    kind = F.when(F.col("indicator_type").isin(*COUNTED), "ioc").when(F.col("indicator_type") == "filename", "filename").when(F.col("indicator_type").isin("malware_family", "attack_technique"), "claim")
    once = evidence.where("status = 'confirmed'").select("report_date", kind.alias("kind"), "indicator_type", "normalized_value").distinct()
    return once.groupBy("report_date").agg(*(F.count_if(F.col("kind") == k).alias(f"confirmed_{k}_count") for k in ("ioc", "filename", "claim")))


def daily_brief(articles: DataFrame, evidence: DataFrame, actions: DataFrame, kev_loaded: DataFrame | None = None) -> DataFrame:
    """One row a report day: articles collected, kept and excluded, active sources, confirmed counts, action counts, new / repeated / gone indicators and the focus.

    articles: report_date, url, source, relevant. evidence: report_date, url, indicator_type, normalized_value, status. actions: as numbered.
    Findings of articles that are not relevant don't count. Where ``kev_loaded`` (report_date) is given, other days have a null kev_count:
    nobody looked, which is not the same as none.
    """
    kept = articles.where("relevant").select("report_date", "url")
    own = evidence.join(kept, ["report_date", "url"], "left_semi")
    read = articles.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("collected_article_count"), F.count_if("relevant").alias("article_count"), F.count_if(~F.col("relevant")).alias("excluded_article_count"), F.count_distinct("source").alias("active_source_count"))
    iocs = own.where((F.col("status") == "confirmed") & F.col("indicator_type").isin(*COUNTED)).select("report_date", "indicator_type", "normalized_value").distinct()
    before = iocs.select(F.date_add("report_date", 1).alias("report_date"), "indicator_type", "normalized_value", F.lit(1).alias("was"))
    both = iocs.withColumn("is", F.lit(1)).join(before, ["report_date", "indicator_type", "normalized_value"], "full")
    sets = both.groupBy("report_date").agg(F.count_if(F.expr("is = 1 AND was IS NULL")).alias("new_ioc_count"), F.count_if(F.expr("is = 1 AND was = 1")).alias("repeat_ioc_count"), F.count_if(F.col("is").isNull()).alias("gone_ioc_count"))
    had = read.select(F.date_add("report_date", 1).alias("report_date"), F.lit(True).alias("had"))
    out = read.join(unique_confirmed(own), "report_date", "left").join(target_counts(actions), "report_date", "left").join(sets, "report_date", "left").join(had, "report_date", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    counts = ["confirmed_ioc_count", "confirmed_filename_count", "confirmed_claim_count", "patch_count", "block_count", "hunt_count", "kev_count", "monitor_count", "unavailable_count"]
    compared = ["new_ioc_count", "repeat_ioc_count", "gone_ioc_count"]
    out = out.select("report_date", *(c for c in read.columns if c != "report_date"), *map(zero, counts), *(F.when(F.col("had"), F.coalesce(c, F.lit(0).cast("long"))).alias(c) for c in compared)).join(headline(actions), "report_date", "left")
    if kev_loaded is not None:
        looked = kev_loaded.select("report_date", F.lit(True).alias("_looked")).distinct()
        out = out.join(looked, "report_date", "left").withColumn("kev_count", F.when(F.col("_looked"), F.col("kev_count"))).drop("_looked")
    return out


def split_articles(articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Add ``detailed``: an article with a confirmed finding, or whose body is missing, has a section of its own; others are listed. articles: url, body."""
    named = evidence.where("status = 'confirmed'").select("url").distinct().withColumn("_named", F.lit(True))
    return articles.join(named, "url", "left").withColumn("detailed", F.coalesce("_named", F.lit(False)) | (F.trim(F.coalesce("body", F.lit(""))) == "")).drop("_named")


def source_stats(entries: DataFrame, articles: DataFrame, registry: DataFrame) -> DataFrame:
    """Per report day and source of the registry: entries, the newest, those in the window, those late, and articles kept and excluded.

    entries: report_date, source, published_at, late (null where it was not taken). articles: report_date, source, relevant. registry: source.
    """
    read = entries.groupBy("report_date", "source").agg(
        F.count(F.lit(1)).alias("feed_entries"), F.max("published_at").alias("newest_entry_at"), F.count_if(~F.col("late")).alias("in_window"), F.count_if(F.col("late")).alias("late"))
    kept = articles.groupBy("report_date", "source").agg(F.count_if("relevant").alias("kept"), F.count_if(~F.col("relevant")).alias("excluded"))
    known = registry.select("source").distinct()
    return read.join(known, "source", "left_semi").join(kept, ["report_date", "source"], "left").fillna(0, ["kept", "excluded"])


def late_entries(entries: DataFrame, stored: DataFrame, windows: DataFrame, since: Column, days: int = 7) -> DataFrame:
    """Entries dated before ``since`` that no earlier report holds, as far back as an unbroken chain of report windows shows what was collected.

    entries: url, published_at. stored: report_date, url (kept and excluded articles). windows: report_date, window_start, window_end.
    Without a window that ends at ``since`` nothing is taken.
    """
    chain = unbroken_chain(windows, since, days)
    reach = chain.agg(F.min("window_start").alias("_from"))
    floor = since - F.expr(f"INTERVAL {days} DAYS")
    held = stored.join(chain.select("report_date").distinct(), "report_date", "left_semi").select(U.canonical_url(F.col("url")).alias("_c")).distinct()
    before = entries.where(F.col("published_at") < since).withColumn("_c", U.canonical_url(F.col("url")))
    # the chain's reach is one row; joined on a constant key it is a broadcast of one row
    dated = before.withColumn("_k", F.lit(1)).join(F.broadcast(reach.withColumn("_k", F.lit(1))), "_k").where(F.col("_from").isNotNull() & (F.col("published_at") >= F.greatest("_from", floor)))
    return dated.join(held, "_c", "left_anti").select(entries.columns)


def list_reports(reports: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` reports with their counts, newest first."""
    return reports.orderBy(F.desc("report_date")).limit(n)


def search_iocs(indicators: DataFrame, query: str = "", action: str | None = None, indicator_type: str | None = None, date: str | None = None, since: str | None = None, limit: int = 50) -> DataFrame:
    """Confirmed indicators whose value, source, title or reason holds ``query`` (case aside), newest first, with ``truncated`` if there are more than ``limit``.

    One row more than the limit is fetched, so only limit + 1 rows are ordered at the end.
    """
    rows = indicators.where("status = 'confirmed'")
    for column, wanted in (("action", action), ("indicator_type", indicator_type)):
        if wanted:
            rows = rows.where(F.col(column) == wanted)
    if date:
        rows = rows.where(F.col("report_date") == F.lit(date).cast("date"))
    if since:
        rows = rows.where(F.col("report_date") >= F.lit(since).cast("date"))
    if query:
        told = [c for c in ("value", "source", "article_title", "reason") if c in rows.columns]
        rows = rows.where(F.contains(F.lower(F.concat_ws(" ", *told)), F.lit(query.lower())))
    order = [F.desc("report_date"), F.asc("seq")]
    more = rows.orderBy(*order).limit(limit + 1).withColumn("_k", F.row_number().over(Window.orderBy(*order)))
    return more.withColumn("truncated", F.max("_k").over(Window.partitionBy()) > limit).where(F.col("_k") <= limit).drop("_k")


def lookup_indicator(indicators: DataFrame, value: str) -> DataFrame:
    """Rows whose normalized or raw value is ``value``, case aside, newest first."""
    wanted = value.strip().lower()
    return indicators.where((F.lower("value") == wanted) | (F.lower("raw_value") == wanted)).orderBy(F.desc("report_date"), "seq")


def coverage(reports: DataFrame, failures: DataFrame) -> DataFrame:
    """Each report day with the sources that failed on it, sorted. reports: report_date, one row a day; failures: report_date, source_key."""
    failed = failures.where("source_key != ''").groupBy("report_date").agg(F.array_sort(F.collect_set("source_key")).alias("sources_failed"))
    return reports.join(failed, "report_date", "left").withColumn("sources_failed", F.coalesce("sources_failed", F.array().cast("array<string>")))


def corpus_state(values: DataFrame, excluded: DataFrame, cves: DataFrame, days: DataFrame) -> DataFrame:
    """One row: days held, the first and last, values confirmed and excluded, CVE records, distinct publishers. values: value_lc, publishers."""
    held = days.agg(F.count_distinct("report_date").alias("days"), F.min("report_date").alias("first_date"), F.max("report_date").alias("last_date"), F.lit(1).alias("_k"))
    told = values.select(F.explode("publishers").alias("p")).agg(F.count_distinct("p").alias("publisher_count"), F.lit(1).alias("_k"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name), F.lit(1).alias("_k"))
    out = held
    for part in (count(values, "confirmed_values"), count(excluded, "excluded_values"), count(cves, "cve_records"), told):  # one row each
        out = out.join(part, "_k")
    return out.drop("_k")


def reported_version(state: DataFrame, reports: DataFrame) -> DataFrame:
    """The corpus version, withheld (null, with a note) unless the stored days are those that it was computed from. state: corpus_version, days, first_date, last_date."""
    held = reports.agg(F.count_distinct("report_date").alias("_n"), F.min("report_date").alias("_a"), F.max("report_date").alias("_b"), F.lit(1).alias("_k"))
    same = (F.col("days") == F.col("_n")) & F.col("first_date").eqNullSafe(F.col("_a")) & F.col("last_date").eqNullSafe(F.col("_b"))
    out = state.withColumn("_k", F.lit(1)).join(held, "_k")
    return out.select(F.when(same, F.col("corpus_version")).alias("corpus_version"), F.when(~same, "stored days differ from those of the version").alias("version_note"))


def findings_digest(articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """(report_date, url, digest) of what was found in each article: whether it was read, and its sorted findings; not of the bytes of its body.

    articles: report_date, url, body. evidence: url, status, indicator_type, normalized_value.
    """
    rows = evidence.groupBy("url").agg(F.array_sort(F.collect_list(F.concat_ws("\t", "status", "indicator_type", "normalized_value"))).alias("rows"))
    missing = F.when(F.trim(F.coalesce("body", F.lit(""))) == "", "True").otherwise("False")
    joined = articles.join(rows, "url", "left")
    return joined.select("report_date", "url", F.sha2(F.array_join(F.concat(F.array(missing), F.coalesce("rows", F.array().cast("array<string>"))), "\n"), 256).alias("digest"))


def report_id(digests: DataFrame) -> DataFrame:
    """Identity of each day's report: the same findings give the same id, whatever the order of rows or the time of the run."""
    return digests.groupBy("report_date").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("\t", "url", "digest"))), "\n"), 256).alias("report_id"))


def guard_replace(stored: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """Days of ``new`` (report_date, article_count, ioc_count) with ``accepted``: not with fewer articles or indicators than the stored day, unless forced."""
    was = stored.select("report_date", F.col("article_count").alias("_a"), F.col("ioc_count").alias("_i"))
    shrinks = (F.col("article_count") < F.col("_a")) | (F.col("ioc_count") < F.col("_i"))
    return new.join(was, "report_date", "left").withColumn("accepted", F.lit(force) | ~F.coalesce(shrinks, F.lit(False))).drop("_a", "_i")


def compare_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per report day: indicators stored, found now, in both, only in each, and the share lost. Both: report_date, indicator_type, value."""
    keys = ["report_date", "indicator_type", "v"]
    side = lambda df, name: df.select("report_date", "indicator_type", F.lower("value").alias("v")).distinct().withColumn(name, F.lit(1))
    both = side(old, "o").join(side(new, "n"), keys, "full")
    out = both.groupBy("report_date").agg(F.count("o").alias("stored"), F.count("n").alias("found"), F.count_if(F.expr("o = 1 AND n = 1")).alias("both"), F.count_if(F.expr("n IS NULL")).alias("lost"), F.count_if(F.expr("o IS NULL")).alias("gained"))
    return out.withColumn("loss_rate", F.round(F.col("lost") / F.nullif(F.col("stored"), F.lit(0)), 4))


def with_provenance(day: DataFrame, original: DataFrame) -> DataFrame:
    """Provenance of a rebuilt day (report_date, url, parser_version, digest) beside the original: revisions used, articles changed, and a digest of both."""
    rows = day.join(original.select("report_date", "url", F.col("parser_version").alias("_p"), F.col("digest").alias("_d")), ["report_date", "url"], "full")
    return rows.groupBy("report_date").agg(
        F.array_sort(F.collect_set("parser_version")).alias("revisions"), F.array_sort(F.collect_set("_p")).alias("original_revisions"), F.count("digest").alias("articles"), F.count("_d").alias("original_articles"),
        F.count_if(~F.col("digest").eqNullSafe(F.col("_d"))).alias("changed"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("\t", "url", "digest", "_d"))), "\n"), 256).alias("provenance"))


def order_merged(merged: DataFrame) -> DataFrame:
    """Merged corpus rows, latest seen first, then by value downwards."""
    return merged.orderBy(F.desc("last_seen"), F.desc("value_lc"))


def side_counts(merged: DataFrame) -> DataFrame:
    """How many values each side holds, how many stand on several, and the newest day of each."""
    on = lambda c: F.col(c).isNotNull()
    several = on("news_last").cast("int") + on("sample_last").cast("int") + on("feed_last").cast("int") > 1
    return merged.agg(
        F.count(F.lit(1)).alias("n_values"), F.count("news_last").alias("n_news"), F.count("sample_last").alias("n_samples"), F.count("feed_last").alias("n_feeds"), F.count_if(several).alias("n_shared"),
        F.max("news_last").alias("newest_news"), F.max("sample_last").alias("newest_sample"), F.max("feed_last").alias("newest_feed"))


def public_document(merged: DataFrame) -> DataFrame:
    """Columns of the merged corpus that may be published: no context, body or raw value."""
    private = {"context", "body", "canonical_body", "raw_value", "window"}
    return order_merged(merged.select([c for c in merged.columns if c not in private]))


def missed_sources(entries: DataFrame, articles: DataFrame) -> DataFrame:
    """Per source: the newest entry of its feed, the newest collected article, and whether the feed has newer ones. entries, articles: source, published_at."""
    feed = entries.groupBy("source").agg(F.max("published_at").alias("newest_entry"))
    held = articles.groupBy("source").agg(F.max("published_at").alias("newest_collected"))
    return feed.join(held, "source", "left").withColumn("missed", F.col("newest_collected").isNull() | (F.col("newest_entry") > F.col("newest_collected")))


def failing_summary(streaks: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: sources whose streak reaches the newest day, of how many, the longest, and how many are due a notice. streaks: as ``failure_streaks``; registry: source."""
    total = registry.agg(F.count_distinct("source").alias("n_sources"), F.lit(1).alias("_k"))
    failing = streaks.agg(F.count(F.lit(1)).alias("n_failing"), F.max("streak_days").alias("longest"), F.count_if("notify").alias("n_due"), F.lit(1).alias("_k"))
    return total.join(failing, "_k").drop("_k")


def kev_confirmed(evidence: DataFrame, kev: DataFrame) -> DataFrame:
    """Distinct confirmed CVE ids of each day that the catalogue of exploited ones lists. evidence: report_date, indicator_type, normalized_value, status."""
    cves = evidence.where("status = 'confirmed' AND indicator_type = 'cve'").select("report_date", F.upper("normalized_value").alias("cve_id")).distinct()
    return cves.join(kev.select("cve_id").distinct(), "cve_id", "left_semi")


def refresh_plan(intel: DataFrame, now: Column, refresh: bool = True) -> DataFrame:
    """Add ``plan`` to cached CVE rows (cached_at, cvss_score): fresh, refresh, or stale where refreshing is off; missing where nothing is cached.

    A scored record is good for seven days, one without a score for 20 hours.
    """
    age = now - F.expr("INTERVAL 20 HOURS"), now - F.expr("INTERVAL 7 DAYS")
    fresh = F.col("cached_at") >= F.when(F.col("cvss_score").isNotNull(), age[1]).otherwise(age[0])
    return intel.withColumn("plan", F.when(F.col("cached_at").isNull(), "missing").when(fresh, "fresh").otherwise("refresh" if refresh else "stale"))


def enrichment_summary(intel: DataFrame) -> DataFrame:
    """One row over the requested CVEs: how many have a record, are exploited, have a CVSS and an EPSS score, and were served stale or not at all. intel: kev, cvss_score, epss_score, provenance, plan."""
    known = F.size("provenance") > 0
    return intel.agg(
        F.count(F.lit(1)).alias("requested"), F.count_if(known).alias("enriched"), F.count_if(F.coalesce("kev", F.lit(False))).alias("kev_count"), F.count("cvss_score").alias("cvss_count"), F.count("epss_score").alias("epss_count"),
        F.count_if(F.col("plan") == "stale").alias("stale"), F.count_if(F.col("plan") == "missing").alias("skipped"))


def enrichment_note(runs: DataFrame) -> DataFrame:
    """Per run (report_date, enabled, catalogue_version, kev_count, requested, scored, skipped, stale, errors): the counts to show. kev_count is null unless the catalogue was read."""
    looked = F.col("enabled") & F.col("catalogue_version").isNotNull()
    off = ~F.col("enabled")
    failed = F.greatest(F.size("errors") - F.when((F.col("skipped") > 0) | (F.col("stale") > 0), 1).otherwise(0), F.lit(0))
    return runs.select("report_date", F.when(looked, F.col("kev_count")).alias("kev_count"), F.when(off, "disabled").when(F.col("requested") == 0, "nothing requested").otherwise("enriched").alias("state"),
                       F.when(~off, F.col("scored")).alias("scored"), F.when(~off, F.col("skipped")).alias("skipped"), F.when(~off, F.col("stale")).alias("stale"), F.when(~off, failed).alias("failed"))
