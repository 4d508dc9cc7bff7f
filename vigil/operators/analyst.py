"""Action board rules over confirmed evidence, and the backtest of observables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import text as T
from vigil.functions import urls as U
from vigil.functions.addresses import canonical_ip, ipv6_hex
from vigil.operators.corpus import cve_priority, effective_cvss, priority
from vigil.operators.extract import local_windows
from vigil.operators.matching import each_parent, public_suffix_depth
from vigil.plans.materialize import materialize

# Impacts that make a finding urgent, types counted as indicators, and the wording of reasons.
HIGH_IMPACTS = ("remote_code_execution", "authentication_bypass", "ransomware", "command_and_control")
ACTIONABLE = ("patch", "block", "hunt")
COUNTED = ("md5", "sha1", "sha256", "ip", "domain", "url", "cve")
NETWORK, HOST_SIDE = ("ip", "domain", "url"), ("md5", "sha1", "sha256", "filename")
KEV_NOTE, DUE_NOTE, RANSOMWARE_NOTE, NO_SCORE = "KEV 已知遭利用", "，CISA 修補期限 ", "，已用於勒索攻擊", "未寫 CVSS"


def host_suffix_semi(df: DataFrame, column: str, hosts: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: the host in ``column`` equals a listed host or lies under one. Hosts meet the list by equi-join on their suffixes."""
    distinct = df.select(F.col(column).alias("_h")).where("_h IS NOT NULL").distinct()
    met = distinct.select("_h", F.explode(U.host_suffixes(F.col("_h"))).alias("host")).join(hosts.select("host").distinct(), "host").select("_h").distinct().withColumn(flag, F.lit(True))
    return df.join(met, F.col(column) == F.col("_h"), "left").drop("_h").withColumn(flag, F.coalesce(flag, F.lit(False)))


def network_host(kind: Column, value: Column) -> Column:
    """The host that a domain or URL finding names; null for other kinds."""
    return F.lower(F.when(kind == "url", U.url_host(value)).when(kind == "domain", value))


def bare_target(host: Column, value: Column) -> Column:
    """What a value is compared by: its host without www, or its address in short form."""
    return F.regexp_replace(F.coalesce(host, canonical_ip(value), F.lower(value)), r"^www\.", "")


def short_parents(evidence: DataFrame) -> DataFrame:
    """(url, value) of confirmed two-label hosts with a first label of at most three characters and a confirmed host beneath them in the same article; hosts are those of domains and URLs."""
    host = network_host(F.col("indicator_type"), F.col("normalized_value"))
    hosts = evidence.where("status = 'confirmed' AND indicator_type IN ('domain', 'url')").select("url", host.alias("value")).where("value != ''").distinct()
    labels = F.split("value", r"\.")
    short = hosts.where((F.size(labels) == 2) & (F.length(F.get(labels, F.lit(0))) <= 3))
    under = hosts.where(F.size(labels) > 2).select("url", F.substring_index("value", ".", -2).alias("value")).distinct()
    return short.join(under, ["url", "value"])


def source_for_url(df: DataFrame, host: str, registry: DataFrame) -> DataFrame:
    """Add ``source_key``: the first source in registry order (``pos``) one of whose hosts is the host or a parent of it."""
    distinct = df.select(F.col(host).alias("_h")).where("_h != ''").distinct()
    met = distinct.select("_h", F.explode(U.host_suffixes(F.col("_h"))).alias("host")).join(registry, "host")
    first = met.groupBy("_h").agg(F.min_by("source_key", "pos").alias("source_key"))
    return df.join(first, F.col(host) == F.col("_h"), "left").drop("_h")


def cve_reason(row: dict[str, Column]) -> Column:
    """Why a CVE is on the board: exploitation, then the best score known (the catalogue's before the article's), else its state there."""
    score = lambda c: F.regexp_replace(c.cast("string"), r"\.0$", "")
    known = F.when(row["kev"], F.concat(F.lit(KEV_NOTE), F.coalesce(F.concat(F.lit(DUE_NOTE), row["kev_due_date"]), F.lit("")), F.when(row["known_ransomware"], RANSOMWARE_NOTE).otherwise("")))
    rated = F.concat(F.concat_ws(" ", F.concat(F.lit("CVSS "), score(row["cvss_score"])), row["cvss_severity"]), F.lit("（NVD）"))
    told = F.concat(F.lit("CVSS "), score(row["article_cvss"]), F.lit("（原文）"))
    state = F.when(row["nvd_status"] != "Unknown", F.concat(F.lit("NVD "), row["nvd_status"]))
    return F.concat_ws("；", known, F.coalesce(rated, told, state, F.lit(NO_SCORE)))


INTEL = {"kev": "boolean", "kev_due_date": "string", "known_ransomware": "boolean", "cvss_score": "double", "cvss_severity": "string", "nvd_status": "string", "epss_score": "double", "epss_percentile": "double"}


def confirmed_first(evidence: DataFrame) -> DataFrame:
    """First confirmed occurrence of each (article, type, value)."""
    key = F.struct("line_number", "column_start")
    rest = [c for c in evidence.columns if c not in ("url", "indicator_type", "normalized_value")]
    first = evidence.where("status = 'confirmed'").groupBy("url", "indicator_type", "normalized_value").agg(F.min_by(F.struct(*rest), key).alias("first"))
    return first.select("url", "indicator_type", "normalized_value", "first.*")


def build_actions(articles: DataFrame, evidence: DataFrame, intel: DataFrame, resolvers: DataFrame, brands: DataFrame, psl: DataFrame) -> DataFrame:
    """One action for each distinct confirmed value of an article, or one for the article itself.

    articles: url, title, body and, where known, summary and warnings; one row a url. evidence: as extracted, best read from a written
    table, as it is used twice. intel: cve_id and any of INTEL. resolvers: value (addresses and hosts). brands: host. psl: rule, kind.

    A CVE is patched. A network value is blocked, but hunted at low priority where a rule holds it back: a public resolver, a vendor's
    own host, a public suffix, or a short parent of another host in the article. A file or hash is hunted. Impacts and scores come from
    the words next to the value. An article whose body is missing is reviewed; one without such a value is monitored or observed if its
    headline reports an event, and has no row otherwise. ``pos`` orders the actions of an article.
    """
    for name, kind in (("summary", "string"), ("warnings", "array<string>")):
        if name not in articles.columns:
            articles = articles.withColumn(name, F.lit(None).cast(kind))
    intel = intel.select(F.upper("cve_id").alias("value"), *((F.col(c) if c in intel.columns else F.lit(None)).cast(t).alias(c) for c, t in INTEL.items()))
    body = F.coalesce(F.col("body"), F.lit(""))
    read = articles.select("url", "title", "summary", "warnings", (F.trim(body) == "").alias("missing"))
    near = local_windows(confirmed_first(evidence), articles)
    found = near.join(read.where("NOT missing").select("url", "title", "summary"), "url").withColumnRenamed("normalized_value", "value")
    is_cve = F.col("indicator_type") == "cve"
    said = F.when(is_cve, F.col("window")).otherwise(F.concat_ws("\n", "title", "summary", "window"))
    found = found.select("url", "indicator_type", "value", "line_number", "column_start", T.impacts(said).alias("impacts"), T.cvss_in(F.col("window")).alias("article_cvss"))
    host = network_host(F.col("indicator_type"), F.col("value"))
    # written once: the joins below read it several times each, and the words next to each value take long expressions
    found = materialize(found.withColumns({"host": host, "bare": bare_target(host, F.col("value"))}), "confirmed")
    found = found.join(intel, (found["indicator_type"] == "cve") & (F.upper(found["value"]) == intel["value"]), "left").drop(intel["value"])
    found = host_suffix_semi(found, "bare", resolvers.select(bare_target(F.lit(None).cast("string"), F.col("value")).alias("host")), "resolver")
    found = host_suffix_semi(found, "host", brands, "brand")
    found = public_suffix_depth(found, "host", psl)
    found = found.join(short_parents(evidence).select("url", F.col("value").alias("host")).withColumn("short", F.lit(True)), ["url", "host"], "left")
    network = F.col("indicator_type").isin(*NETWORK)
    boundary = (F.size(F.split("host", r"\.")) <= F.col("suffix_labels")) | F.col("short")
    basis = F.when(network, F.when(F.col("resolver"), "public_resolver_registry").when(F.col("brand"), "vendor_brand_apex").when(boundary, "domain_boundary_rule"))
    found = found.withColumns({"benign_basis": basis, "score": effective_cvss(F.col("cvss_score"), F.col("article_cvss"))})
    high, any_ = F.arrays_overlap("impacts", F.array(*map(F.lit, HIGH_IMPACTS))), F.size("impacts") > 0
    level = priority(F.col("article_cvss"), high, any_)
    action = F.when(is_cve, "patch").when(network & F.col("benign_basis").isNull(), "block").when(network | F.col("indicator_type").isin(*HOST_SIDE), "hunt")
    urgency = F.when(is_cve, cve_priority(F.coalesce("kev", F.lit(False)), F.col("score"), high)).when(F.col("benign_basis").isNotNull(), "low").when(level == "low", "medium").otherwise(level)
    severity = F.lower(F.coalesce("cvss_severity", F.when(F.col("cvss_score") >= 9, "critical").when(F.col("cvss_score") >= 7, "high").when(F.col("cvss_score") >= 4, "medium").when(F.col("cvss_score") > 0, "low").otherwise("none")))
    code = F.coalesce("benign_basis", F.when(is_cve, F.when(F.col("kev"), "kev_listed").when(F.col("cvss_score").isNotNull(), F.concat(F.lit("cvss_"), severity)).otherwise("cve_reported")), F.lit("publisher_indicator"))
    rows = found.withColumn("action", action).where("action IS NOT NULL").select(
        "url", "action", urgency.alias("priority"), F.col("indicator_type").alias("target_type"), F.col("value").alias("target"), code.alias("reason_code"),
        F.when(is_cve, cve_reason({c: F.col(c) for c in (*INTEL, "article_cvss")})).alias("reason"), "benign_basis", *(c for c in INTEL if c not in ("known_ransomware", "nvd_status")),
        F.col("article_cvss").alias("article_cvss_score"), F.struct("line_number", "column_start").alias("pos"))
    rest = read.join(rows.select("url").distinct(), "url", "left_anti").withColumn("events", T.headline_events(F.concat_ws("\n", "title", "summary")))
    event = lambda k: F.array_contains("events", k)
    quiet = F.when(F.col("missing"), "review").when(event("data_breach"), "monitor").when(event("phishing") | event("ransomware"), "observe")
    whole = rest.withColumn("action", quiet).where("action IS NOT NULL").select(
        "url", "action", F.when(F.col("action") == "observe", "low").otherwise("medium").alias("priority"), F.lit("article").alias("target_type"), F.col("title").alias("target"),
        F.when(F.col("missing"), T.unavailable_reason(F.coalesce("warnings", F.array().cast("array<string>")))).when(event("data_breach"), "data_breach").when(event("phishing"), "phishing").otherwise("ransomware").alias("reason_code"))
    return rows.unionByName(whole, allowMissingColumns=True)


def order_articles(articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Add n_cves, n_iocs of each article, in the order CVEs, indicators, newest."""
    counts = evidence.where("status = 'confirmed'").groupBy("url").agg(
        F.countDistinct(F.when(F.col("indicator_type") == "cve", F.col("normalized_value"))).alias("n_cves"),
        F.countDistinct(F.when(F.col("indicator_type").isin("md5", "sha1", "sha256", "ip", "domain", "url"), F.struct("indicator_type", "normalized_value"))).alias("n_iocs"))
    return articles.join(counts, "url", "left").fillna(0, ["n_cves", "n_iocs"]).orderBy(F.desc("n_cves"), F.desc("n_iocs"), F.desc_nulls_last("published_at"), "url")


def backtest_corpus(evidence: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(confirmed, excluded, candidates) of all days, one row a value in lower case.

    evidence: report_date, source, article_title, article_url, indicator_type, normalized_value, status, reason_codes and seq (its place).
    actions: report_date, target_type, target and further columns, of which the first by day counts.
    """
    rows = evidence.withColumn("value_lc", F.lower("normalized_value")).where("value_lc != '' AND indicator_type != ''")
    order = F.struct("report_date", "seq")
    found = rows.where("status = 'confirmed'").groupBy("value_lc").agg(
        F.min_by("indicator_type", order).alias("indicator_type"), F.count_distinct("report_date").alias("report_count"), F.count_distinct("source").alias("source_count"),
        F.min("report_date").alias("first_seen"), F.max("report_date").alias("last_seen"), F.min_by(F.struct(F.col("article_title").alias("title"), F.col("article_url").alias("url"), F.col("report_date").alias("date")), order).alias("citation"))
    rest = [c for c in actions.columns if c not in ("target_type", "target")]
    first = actions.groupBy(F.col("target_type").alias("indicator_type"), F.lower("target").alias("value_lc")).agg(F.min_by(F.struct(*rest), "report_date").alias("act"))
    excluded = rows.where("status = 'rejected'").groupBy("value_lc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("reason_codes")))).alias("reason_codes"))
    return found.join(first, ["indicator_type", "value_lc"], "left"), excluded, rows.where("status = 'candidate'").select("value_lc").distinct()


def backtest_observables(observables: DataFrame, confirmed: DataFrame, excluded: DataFrame, candidates: DataFrame, psl: DataFrame) -> DataFrame:
    """Status and relation of each observable (value) in the backtest's own order: exclusions come before confirmations.

    Tables: value_lc, as ``backtest_corpus`` gives them. A value that is not confirmed itself matches, under its registrable domain, the
    shortest confirmed name (or URL's host) that stands above or beneath it. One of skipped, excluded, hit, candidate or unseen.
    """
    # parsed column by column, so that each long expression is made once a row, and written; the joins below read the result
    rows = observables.where(F.trim("value") != "").withColumn("_v", F.trim("value"))
    rows = rows.withColumns({"value_lc": F.lower("_v"), "_plain": U.undefang(F.col("_v")), "_detected": U.detect_type(F.col("_v"))})
    rows = rows.withColumns({"_guarded": U.looked_up_host(F.col("_plain")), "host": F.when(F.col("_detected").isin("url", "domain"), U.looked_up_host(F.col("_v")))})
    rows = rows.withColumns({"_v4": U.ipv4_to_long(F.col("_guarded")), "_v6": F.when(F.col("_guarded").contains(":"), ipv6_hex(F.col("_guarded")))})
    guard = U.judge_guard(*map(F.col, ("_v", "_plain", "_guarded", "_v4", "_v6")))
    skip = F.when(F.col("_detected") == "unknown", "unsupported_type").otherwise(guard)
    keyed = materialize(rows.select(*observables.columns, "value_lc", skip.alias("skip"), "host"), "backtest")
    # one row a known value, written before names are read out of it: the patterns then meet each value once and not each of its findings
    sides = [df.select("value_lc", F.lit(name).alias("side")) for name, df in (("x", excluded), ("c", confirmed), ("d", candidates))]
    flags = [F.bool_or(F.col("side") == name).alias(f"_{name}") for name in ("x", "c", "d")]
    known = materialize(sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("value_lc").agg(*flags), "known")
    names = known.where("_c").select("value_lc", F.when(F.col("value_lc").rlike("^https?://"), U.url_host(F.col("value_lc"))).otherwise(F.col("value_lc")).alias("name"))
    named = materialize(names.where(F.col("name").rlike(r"^[a-z0-9_.-]*[a-z_-][a-z0-9_.-]*\.[a-z0-9-]+$") & F.col("name").rlike(r"\.([a-z]{2,63}|xn--[a-z0-9-]+)$")), "names")
    shortest = lambda df: df.groupBy("host").agg(F.min(F.struct(F.length("value_lc").alias("n"), "value_lc", "match_method")).alias("m"))
    # a name above: the host's own ancestors down to its registrable domain meet the names; a name beneath: its ancestors meet the hosts
    hosts = materialize(public_suffix_depth(keyed.where("skip IS NULL AND host IS NOT NULL").select("host").distinct(), "host", psl), "hosts")
    above = each_parent(hosts, "host", "name", "host").join(named, "name").select("host", "value_lc", F.lit("parent_domain").alias("match_method"))
    lower = public_suffix_depth(named, "name", psl)
    least = each_parent(lower, "name", "host", "value_lc").groupBy("host").agg(F.min_by("value_lc", F.struct(F.length("value_lc"), "value_lc")).alias("value_lc"))
    beneath = hosts.select("host").join(least, "host").select("host", "value_lc", F.lit("child_domain").alias("match_method"))
    related = shortest(above.unionByName(beneath)).withColumnRenamed("host", "_at")
    # a row without a host is dealt by its value, which no host equals with a blank before it
    out = keyed.join(known, "value_lc", "left").join(related, F.coalesce("host", F.concat(F.lit(" "), "value_lc")) == F.col("_at"), "left")
    status = F.when(F.col("skip").isNotNull(), "skipped").when(F.col("_x"), "excluded").when(F.col("_c") | F.col("m").isNotNull(), "hit").when(F.col("_d"), "candidate").otherwise("unseen")
    method = F.when(status == "hit", F.when(F.col("_c"), "exact").otherwise(F.col("m.match_method")))
    return out.select(*observables.columns, status.alias("status"), method.alias("match_method"), F.when(status == "hit", F.when(F.col("_c"), F.col("value_lc")).otherwise(F.col("m.value_lc"))).alias("matched_on"))


def observable_rates(verdicts: DataFrame) -> DataFrame:
    """Submitted, processed, hits (by relation too) and the hit rate (five places) of a backtest. A value that is only a candidate counts as unseen."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    by = lambda m: F.count_if(F.coalesce(F.col("match_method") == m, F.lit(False)))
    out = verdicts.agg(F.count(F.lit(1)).alias("submitted"), n("skipped").alias("skipped"), n("hit").alias("hits"), by("exact").alias("by_exact"), by("parent_domain").alias("by_parent"), by("child_domain").alias("by_child"),
                       n("excluded").alias("excluded"), n("candidate").alias("candidates"), n("unseen", "candidate").alias("unseen"))
    return out.withColumn("processed", F.col("submitted") - F.col("skipped")).withColumn("hit_rate", F.round(F.col("hits") / F.nullif(F.col("processed"), F.lit(0)), 5))


def cve_rates(cves: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Backtest of CVE ids (value): malformed, hits, and how many hits are exploited, scored, ranked or named by two publishers.

    confirmed: value_lc, source_count, and act with kev, cvss_score and epss_score of the first action.
    """
    asked = cves.where(F.trim("value") != "").select(F.upper(F.trim("value")).alias("cve"))
    valid = F.col("cve").rlike(r"^CVE-\d{4}-\d{4,7}$")
    met = asked.withColumn("value_lc", F.when(valid, F.lower("cve"))).join(confirmed, "value_lc", "left")
    hit = F.col("source_count").isNotNull()
    count = lambda c: F.count_if(hit & F.coalesce(c, F.lit(False)))
    out = met.agg(
        F.count(F.lit(1)).alias("submitted"), F.count_if(~valid).alias("malformed"), F.count_if(hit).alias("hits"), count(F.col("act.kev")).alias("kev"), count(F.col("act.cvss_score").isNotNull()).alias("with_cvss"),
        count(F.col("act.epss_score").isNotNull()).alias("with_epss"),
        count(F.coalesce("act.kev", F.lit(False)) | (F.coalesce("act.cvss_score", F.lit(0.0)) != 0) | (F.coalesce("act.epss_score", F.lit(0.0)) != 0)).alias("with_any_signal"), count(F.col("source_count") > 1).alias("corroborated"))
    return out.withColumn("hit_rate", F.round(F.col("hits") / F.nullif(F.col("submitted") - F.col("malformed"), F.lit(0)), 5))
