"""Corpus tables, day comparisons, rankings and rates over sightings.

A sighting has report_date, indicator_type, value, status, publisher, article_url,
seen_at, seq (its place in the day's order) and further columns named where used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rate(num: Column, den: Column, places: int = 4) -> Column:
    """Rounded share; null over nothing."""
    return F.round(num / F.nullif(den, F.lit(0)), places)


def ordered_unique(df: DataFrame, key: list[str], value: str, order: str, name: str) -> DataFrame:
    """Distinct values of each key in the order of first appearance."""
    first = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.min(order).alias("_o"))
    return first.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", value))), lambda x: x[value]).alias(name))


#: Types that the corpus of values holds; filenames and claims stay outside it.
VALUE_TYPES = ("md5", "sha1", "sha256", "ip", "domain", "url", "cve")


def corpus_values(sightings: DataFrame, types: tuple[str, ...] = VALUE_TYPES) -> DataFrame:
    """One row a value: dates, publishers in first-seen order, citation count, first and last day, latest action."""
    key = F.lower("value")
    rows = sightings.where((F.col("status") == "confirmed") & F.col("indicator_type").isin(*types)).withColumn("value_lc", key)
    core = rows.groupBy("value_lc").agg(
        F.min_by("indicator_type", F.struct("report_date", "seq")).alias("indicator_type"), F.countDistinct("report_date").alias("report_count"),
        F.countDistinct("publisher").alias("source_count"), F.countDistinct("publisher", "article_url").alias("citation_count"),
        F.min("report_date").alias("first_seen"), F.max("report_date").alias("last_seen"), F.max_by("action", F.struct("report_date", "seq")).alias("action"))
    return core.join(ordered_unique(rows, ["value_lc"], "publisher", "seq", "publishers"), "value_lc")


def corpus_excluded(sightings: DataFrame) -> DataFrame:
    """Rejected values of every type with their reasons in first-seen order; where a column ``kept`` tells, those of kept articles alone."""
    rows = sightings.where("status = 'rejected'").withColumn("value_lc", F.lower("value"))
    if "kept" in rows.columns:
        rows = rows.where("kept")
    days = rows.groupBy("value_lc").agg(F.countDistinct("report_date").alias("n_days"), F.min("report_date").alias("first_day"))
    return days.join(ordered_unique(rows, ["value_lc"], "reason", "seq", "reason_codes"), "value_lc")


def daily_sets(sightings: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """New, repeated and gone confirmed values of each report day against the day before; null where that day has no report.

    ``days`` (report_date) are the days with a report, by default those of any sighting.
    """
    rows = sightings.where("status = 'confirmed'").select("report_date", "indicator_type", F.lower("value").alias("v")).distinct()
    days = (sightings if days is None else days).select("report_date").distinct()
    before = rows.select(F.date_add("report_date", 1).alias("report_date"), "indicator_type", "v", F.lit(1).alias("was"))
    both = rows.withColumn("is", F.lit(1)).join(before, ["report_date", "indicator_type", "v"], "full")
    counts = both.groupBy("report_date").agg(F.count_if(F.expr("is = 1 AND was IS NULL")).alias("n_new"), F.count_if(F.expr("is = 1 AND was = 1")).alias("n_repeat"), F.count_if(F.col("is").isNull()).alias("n_gone"))
    had = days.select(F.date_add("report_date", 1).alias("report_date"), F.lit(True).alias("had"))
    return days.join(counts, "report_date", "left").join(had, "report_date", "left").select(
        "report_date", *[F.when(F.col("had"), F.coalesce(c, F.lit(0).cast("long"))).alias(c) for c in ("n_new", "n_repeat", "n_gone")])


def recurrence(sightings: DataFrame) -> DataFrame:
    """Share of values that were seen on two days or more, by type."""
    per = sightings.where("status = 'confirmed'").groupBy("indicator_type", F.lower("value").alias("v")).agg(F.countDistinct("report_date").alias("d"))
    return per.groupBy("indicator_type").agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("d") >= 2).alias("n_recurring")).withColumn(
        "recurrence_rate", rate(F.col("n_recurring"), F.col("n_values"), 5))


def day_summary(sightings: DataFrame) -> DataFrame:
    """Counts of each day: articles, publishers, distinct confirmed values, targets by action.

    Values are made distinct first, once for all counts, so that no row is multiplied by the number of counts.
    """
    seen = sightings.groupBy("report_date").agg(F.countDistinct("article_url").alias("n_articles"), F.countDistinct("publisher").alias("n_publishers"))
    flag = lambda a: F.max((F.col("action") == a).cast("int")).alias(f"n_{a}")
    values = sightings.where("status = 'confirmed'").groupBy("report_date", "indicator_type", "value").agg(*map(flag, ("patch", "block", "hunt")))
    counts = values.groupBy("report_date").agg(F.count(F.lit(1)).alias("n_confirmed"), *(F.sum(f"n_{a}").alias(f"n_{a}") for a in ("patch", "block", "hunt")))
    return seen.join(counts, "report_date", "left").select(
        "report_date", "n_articles", "n_publishers", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_confirmed", "n_patch", "n_block", "n_hunt")))


def latest_sighting(rows: DataFrame, keys: list[str], time: str, seq: str, later_wins: bool = False) -> DataFrame:
    """Latest row of each key; on equal times the first in ``seq`` (or the last)."""
    order = Window.partitionBy(*keys).orderBy(F.desc(time), F.desc(seq) if later_wins else F.asc(seq))
    return rows.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def failure_streaks(failures: DataFrame, days: DataFrame, threshold: int = 2) -> DataFrame:
    """Unbroken run of failed days that reaches the newest day, by source; notify at threshold times a power of two.

    ``newest_error`` is the newest one that says something; null if none does.
    """
    newest_first = days.select("report_date").distinct().withColumn("i", F.row_number().over(Window.orderBy(F.desc("report_date"))))  # one row a day
    failed = failures.groupBy("source", "report_date").agg(F.max(F.when(F.trim("error") != "", F.col("error"))).alias("error")).join(F.broadcast(newest_first), "report_date")
    run = failed.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("i"))).where("i = k")
    out = run.groupBy("source").agg(F.count(F.lit(1)).alias("streak_days"), F.min("report_date").alias("since"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("i"))).alias("newest_error"))
    ratio = F.expr(f"streak_days DIV {threshold}")
    return out.withColumn("notify", (F.col("streak_days") % threshold == 0) & (F.bit_count(ratio) == 1))


def unbroken_chain(windows: DataFrame, since: Column, days: int = 7) -> DataFrame:
    """Report windows that join up, going back from the one that ends at ``since``, while they end within ``days`` before it.

    windows: window_start, window_end. The bound on days comes first, so that the one task that walks the chain gets a week of windows.
    """
    order = Window.orderBy(F.desc("window_end"))
    near = windows.where((F.col("window_end") <= since) & (F.col("window_end") > since - F.expr(f"INTERVAL {days} DAYS")))
    linked = F.coalesce(F.lag("window_start").over(order), since) == F.col("window_end")
    return near.withColumn("_ok", linked.cast("int")).withColumn("_all", F.min("_ok").over(order.rowsBetween(Window.unboundedPreceding, 0))).where("_all = 1").drop("_ok", "_all")


def rank_patches(actions: DataFrame) -> DataFrame:
    """Patch rows change places among the places that patch rows have, KEV first; only if the day has a KEV row.

    ``actions`` has report_date, seq, action, kev, priority, cvss, epss, due_date and target. Adds ``place``.
    """
    day = Window.partitionBy("report_date")
    some_kev = F.max(F.when(F.col("action") == "patch", F.col("kev").cast("int"))).over(day) == 1
    level = F.when(F.col("priority") == "high", 0).when(F.col("priority") == "medium", 1).otherwise(2)
    wanted = day.orderBy(F.desc("kev"), level, F.coalesce(F.col("cvss"), F.lit(0.0)).desc(), F.coalesce(F.col("epss"), F.lit(0.0)).desc(),
                         F.coalesce(F.col("due_date"), F.lit("9999-99-99")), "target", "seq")
    rows = actions.withColumn("_sort", some_kev)
    patches = rows.where("action = 'patch'").withColumns({"_rank": F.row_number().over(wanted), "_slot": F.row_number().over(day.orderBy("seq"))})
    slots = patches.select("report_date", F.col("_slot").alias("_rank"), F.col("seq").alias("place"))
    placed = patches.join(slots, ["report_date", "_rank"]).withColumn("place", F.when(F.col("_sort"), F.col("place")).otherwise(F.col("seq"))).drop("_rank", "_slot", "_sort")
    return placed.unionByName(rows.where("action != 'patch' OR action IS NULL").withColumn("place", F.col("seq")).drop("_sort"))


def cvss_ties(intel: DataFrame) -> DataFrame:
    """Share of scored CVEs whose score another one has, and how many EPSS values tell them apart."""
    per = intel.where("cvss IS NOT NULL").groupBy("cvss").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("epss").alias("e"))
    return per.agg(F.sum("n").alias("n_scored"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_tied"), F.sum(F.when(F.col("n") > 1, F.col("e")).otherwise(0)).alias("n_epss_in_ties"))


def join_intel(cves: DataFrame, kev: DataFrame, nvd: DataFrame, epss: DataFrame) -> DataFrame:
    """CVEs with KEV, NVD and EPSS columns; what no source knows stays null. Each source has one row a CVE."""
    out = cves.join(kev.withColumn("_k", F.lit("kev")), "cve_id", "left").join(nvd.withColumn("_n", F.lit("nvd")), "cve_id", "left").join(epss.withColumn("_e", F.lit("epss")), "cve_id", "left")
    return out.withColumns({"kev": F.col("_k").isNotNull(), "provenance": F.array_compact(F.array("_k", "_n", "_e"))}).drop("_k", "_n", "_e")


def cve_priority(kev: Column, score: Column, high_impact: Column) -> Column:
    """high for exploited, scored 9 or more, or of high impact; else medium."""
    return F.when(kev | (score >= 9) | high_impact, "high").otherwise("medium")


def priority(score: Column, high_impact: Column, any_impact: Column) -> Column:
    return F.when((score >= 9) | high_impact, "high").when(score >= 7, "medium").when(any_impact, "medium").otherwise("low")


def effective_cvss(nvd: Column, article: Column) -> Column:
    return F.greatest(nvd, article)


def merge_sides(news: DataFrame, samples: DataFrame, feeds: DataFrame) -> DataFrame:
    """Full join of the three corpora on (indicator_type, value_lc); each side is folded to one row a key first.

    news: report_date, seq, action, publisher; samples: sha256, integration, first_seen_at; feeds: source, threat_type, last_seen.
    """
    keys = ["indicator_type", "value_lc"]
    n = news.groupBy(*keys).agg(F.max_by("action", F.struct("report_date", "seq")).alias("action"), F.slice(F.array_sort(F.collect_set("publisher")), 1, 8).alias("publishers"),
                                F.min("report_date").alias("news_first"), F.max("report_date").alias("news_last"))
    s = samples.groupBy(*keys).agg(F.countDistinct("sha256").alias("n_samples"), F.slice(F.array_sort(F.collect_set("integration")), 1, 6).alias("integrations"), F.min("sha256").alias("least_sha256"),
                                   F.to_date(F.max("first_seen_at")).alias("sample_last"))
    f = feeds.groupBy(*keys).agg(F.countDistinct("source", "threat_type").alias("n_listings"), F.to_date(F.max("last_seen")).alias("feed_last"))
    return n.join(s, keys, "full").join(f, keys, "full").withColumn("last_seen", F.greatest("news_last", "sample_last", "feed_last"))


#: How each list is kept: whether rows that it no longer lists go, even when it lists nothing; whether a listed row is never rewritten; whether rows expire by age.
FEED_RULES = {"threatfox": ("stays", False, True), "feodo": ("mirror", False, False), "et_compromised": ("mirror unless empty", True, False)}
TRACKED = ("last_seen", "malware", "confidence", "threat_type", "port")


def merge_feed(current: DataFrame, incoming: DataFrame, ok_sources: DataFrame, now: Column, keep_days: int = 30, rules: dict[str, tuple[str, bool, bool]] = FEED_RULES) -> DataFrame:
    """Next state of a blocklist table, with ``change``: insert, update or keep.

    Keys: source, indicator_type, value. A source missing from ``ok_sources`` keeps its rows and adds none. A stored row is rewritten
    when one of TRACKED changed; ``rules`` say by source which rows that are not listed any more go, which sources keep their first row,
    and which expire ``keep_days`` after the last sighting. Expiry runs whether or not the source answered.
    """
    keys = ["source", "indicator_type", "value"]
    rule = lambda test: F.col("source").isin(*[k for k, v in rules.items() if test(v)])
    columns = [c for c in current.columns if c not in keys]
    listed = incoming.join(ok_sources.select("source").distinct(), "source", "left_semi").select(*keys, F.struct(*columns).alias("i"))
    stored = current.select(*keys, F.struct(*columns).alias("c"))
    answered = ok_sources.select("source").distinct().join(listed.select("source").distinct().withColumn("_some", F.lit(True)), "source", "left").withColumn("_ok", F.lit(True))
    both = stored.join(listed, keys, "full").join(answered, "source", "left")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{c}").eqNullSafe(F.col(f"i.{c}")) for c in TRACKED if c in columns])
    gone = F.col("_ok") & (rule(lambda r: r[0] == "mirror") | rule(lambda r: r[0] == "mirror unless empty") & F.col("_some"))
    change = F.when(F.col("c").isNull(), "insert").when(F.col("i").isNull(), F.when(gone, "delist").otherwise("keep")).when(same | rule(lambda r: r[1]), "keep").otherwise("update")
    out = both.withColumn("change", change).where("change != 'delist'")
    row = F.when(F.col("change").isin("insert", "update"), F.col("i")).otherwise(F.col("c"))
    out = out.withColumn("row", row).select(*keys, *(F.col(f"row.{c}").alias(c) for c in columns), "change").select(*current.columns, "change")
    return out.where(~rule(lambda r: r[2]) | (F.coalesce("last_seen", "first_seen") >= now - F.expr(f"INTERVAL {keep_days} DAYS")))


def strongest_reading(rows: DataFrame) -> DataFrame:
    """Highest confidence of each (sha256, indicator_type, lower value); the first row on ties."""
    order = Window.partitionBy("sha256", "indicator_type", F.lower("value")).orderBy(F.desc("confidence"), "seq")
    return rows.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def top_k(rows: DataFrame, key: str, order: list[Column], k: int = 5) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


#: Calls of a token that pass in a UTC minute and day where its row in the limits says nothing usable.
PER_MINUTE, PER_DAY = 60, 5000


def known_limits(calls: DataFrame, limits: DataFrame, per_minute: int = PER_MINUTE, per_day: int = PER_DAY) -> DataFrame:
    """``calls`` with per_minute and per_day of their token; a missing or negative limit is the default. limits: token, per_minute, per_day, one row a token."""
    usable = lambda c, default: F.coalesce(F.when(F.col(c) >= 0, F.col(c)), F.lit(default)).cast("long").alias(c)
    rest = [c for c in calls.columns if c not in ("per_minute", "per_day")]
    return calls.select(*rest).join(limits, "token", "left").select(*rest, usable("per_minute", per_minute), usable("per_day", per_day))


def retry_after(ts: Column, refused: Column) -> Column:
    """Seconds until a refused call may be tried again: to the next UTC minute or day; null for a call that passed."""
    ts = ts.cast("timestamp")
    day_left = F.unix_micros(F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")) - F.unix_micros(ts)
    return F.when(refused == "minute", 60 - F.second(ts)).when(refused == "day", F.greatest(F.lit(1), F.ceil(day_left / 1_000_000)).cast("int"))


def refused_calls(calls: DataFrame, limits: DataFrame, per_minute: int = PER_MINUTE, per_day: int = PER_DAY) -> DataFrame:
    """``calls`` (ts, token) with ``refused``: minute, day or null. The first calls of a UTC minute, then of a UTC day, pass; a limit of 0 refuses all.

    Calls over the minute's limit don't count for the day. Windows are a token's minutes and days, so no task gets more than a token's calls of one day.
    """
    known = known_limits(calls, limits, per_minute, per_day)
    minute = Window.partitionBy("token", F.date_trunc("minute", "ts")).orderBy("ts")
    known = known.withColumn("_over", F.row_number().over(minute) > F.col("per_minute"))
    day = Window.partitionBy("token", F.to_date("ts")).orderBy("ts", "_over").rowsBetween(Window.unboundedPreceding, 0)
    passed = F.count_if(~F.col("_over")).over(day)
    refused = F.when(F.col("_over"), "minute").when(passed > F.col("per_day"), "day")
    return known.withColumn("refused", refused).drop("_over", "per_minute", "per_day")


def call_usage(calls: DataFrame, limits: DataFrame, per_minute: int = PER_MINUTE, per_day: int = PER_DAY) -> DataFrame:
    """Calls of each token and UTC day: made, refused by the minute's or the day's limit, and whether 80 % of the day's limit is reached.

    Counted by minutes first, so that rows are folded before they travel. limits: token, per_minute, per_day, one row a token.
    """
    minutes = calls.groupBy("token", F.date_trunc("minute", "ts").alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    known = known_limits(minutes, limits, per_minute, per_day).withColumnsRenamed({"per_minute": "pm", "per_day": "pd"})
    days = known.groupBy("token", F.to_date("minute").alias("day")).agg(
        F.sum("n").alias("n_calls"), F.sum(F.greatest(F.col("n") - F.col("pm"), F.lit(0))).alias("over_minute"), F.max("pd").alias("pd"))
    passed = F.col("n_calls") - F.col("over_minute")
    return days.select("token", "day", "n_calls", (F.col("over_minute") + F.greatest(passed - F.col("pd"), F.lit(0))).alias("n_refused"), (F.col("n_calls") >= 0.8 * F.col("pd")).alias("alert"))


def freshness(reports: DataFrame, today: Column) -> DataFrame:
    """current, behind or empty, with the days behind; unreadable where days are stored but none can be read as a date.

    reports: report_date, one row a stored day.
    """
    state = reports.agg(F.max("report_date").alias("newest"), F.count(F.lit(1)).alias("total"))
    late = F.datediff(today, "newest")
    return state.select("newest", "total", late.alias("days_behind"), F.when(F.col("total") == 0, "empty").when(F.col("newest").isNull(), "unreadable").when(late <= 0, "current").otherwise("behind").alias("state"))


def is_stale(exported_at: Column, now: Column, hours: int = 26) -> Column:
    """A side whose last export is missing or older than ``hours``."""
    return F.coalesce(exported_at < now - F.expr(f"INTERVAL {hours} HOURS"), F.lit(True))


def content_version(df: DataFrame, columns: list[str]) -> DataFrame:
    """One digest of a table's content, whatever the row order; folded in two levels so that no task gets all rows."""
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    part = df.select(row.alias("h")).groupBy(F.substring("h", 1, 4).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("d"))
    return part.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("p", "d"))), ""), 256).alias("version"))
