"""Readers of the reporting inputs: dated archives, vulnerability catalogues, blocklists, observables, rule lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EVIDENCE = "array<struct<indicator_type string, raw_value string, normalized_value string, status string, reason_codes array<string>, section string, context string>>"
ARTICLE = f"struct<source string, article_title string, article_url string, published_at string, canonical_body string, extraction_method string, evidence {EVIDENCE}>"
ACTION = "struct<action string, priority string, target_type string, target string, reason string, kev boolean, kev_due_date string, cvss_score double, cvss_severity string, epss_score double, epss_percentile double, benign_basis string>"
ARCHIVE = (
    f"window_start string, window_end string, sources_checked array<string>, source_failures array<struct<source_key string, source_name string, error string>>, "
    f"source_stats array<struct<source_key string, source_name string, feed_entries int, newest_entry_at string, in_window int, kept int, excluded int, late int>>, "
    f"articles array<{ARTICLE}>, excluded_articles array<{ARTICLE}>, analyst_brief struct<actions array<{ACTION}>>, _bad string")


def read_archive(spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
    """Daily documents ``root/YYYY-MM-DD/daily-evidence.json``; other folders, unreadable and non-object days are left out."""
    days = spark.read.schema(ARCHIVE).options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad").json(f"{root}/*/daily-evidence.json")
    day = F.expr("try_to_date(regexp_extract(_metadata.file_path, '([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]*$', 1), 'yyyy-MM-dd')")
    out = days.withColumn("report_date", day).where("report_date IS NOT NULL AND _bad IS NULL AND (window_start IS NOT NULL OR articles IS NOT NULL)").drop("_bad")
    return out.where(F.col("report_date") >= F.lit(since).cast("date")) if since else out


def load_report(archive: DataFrame, date: str | None = None) -> DataFrame:
    """One day, the newest when none is named."""
    if date:
        return archive.where(F.col("report_date") == F.lit(date).cast("date"))
    newest = archive.agg(F.max("report_date").alias("report_date"))
    return archive.join(F.broadcast(newest), "report_date", "left_semi")


def explode_evidence(archive: DataFrame) -> DataFrame:
    """One row an occurrence, with its article's columns and its place in the day."""
    articles = archive.select("report_date", F.posexplode("articles").alias("article_pos", "a"))
    return articles.select("report_date", "article_pos", "a.source", "a.article_title", "a.article_url", "a.published_at", F.posexplode("a.evidence").alias("evidence_pos", "e")).select(
        "*", "e.*").drop("e")


def stored_articles(archive: DataFrame) -> DataFrame:
    """Kept and excluded articles of each day."""
    kept = archive.select("report_date", F.lit(True).alias("kept"), F.inline("articles"))
    return kept.unionByName(archive.select("report_date", F.lit(False).alias("kept"), F.inline("excluded_articles")))


def read_kev(spark: SparkSession, path: str) -> DataFrame:
    """cve_id, date_added, due_date, known_ransomware; of a repeated id the last entry stays."""
    doc = spark.read.option("multiLine", True).schema("vulnerabilities array<struct<cveID string, dateAdded string, dueDate string, knownRansomwareCampaignUse string>>").json(path)
    rows = doc.select(F.posexplode("vulnerabilities").alias("i", "v")).withColumn("cve_id", F.upper(F.trim("v.cveID"))).where(F.col("cve_id").rlike(r"^CVE-\d{4}-\d{4,7}$"))
    last = rows.withColumn("_k", F.row_number().over(Window.partitionBy("cve_id").orderBy(F.desc("i")))).where("_k = 1")
    used = F.lower(F.trim("v.knownRansomwareCampaignUse"))
    return last.select("cve_id", F.col("v.dateAdded").alias("date_added"), F.col("v.dueDate").alias("due_date"), F.when(used != "", used == "known").alias("known_ransomware"))


def read_nvd(spark: SparkSession, path: str) -> DataFrame:
    """Best CVSS of each CVE: 4.0 before 3.1, 3.0 and 2.0; the primary entry of a version, else its first."""
    metric = "array<struct<type string, baseSeverity string, cvssData struct<version string, baseScore string, baseSeverity string, vectorString string>>>"
    schema = f"vulnerabilities array<struct<cve struct<id string, vulnStatus string, metrics struct<cvssMetricV40 {metric}, cvssMetricV31 {metric}, cvssMetricV30 {metric}, cvssMetricV2 {metric}>>>>"
    rows = spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("vulnerabilities.cve").alias("c"))

    def best(name: str):
        all_ = F.col(f"c.metrics.{name}")
        primary = F.filter(all_, lambda m: m["type"] == "Primary")
        one = F.coalesce(F.get(primary, F.lit(0)), F.get(all_, F.lit(0)))
        score = one["cvssData"]["baseScore"].try_cast("double")
        return F.when(score.isNotNull(), F.struct(score.alias("cvss_score"), F.coalesce(one["cvssData"]["baseSeverity"], one["baseSeverity"]).alias("cvss_severity"),
                                                  one["cvssData"]["version"].alias("cvss_version"), one["cvssData"]["vectorString"].alias("cvss_vector")))

    found = F.coalesce(*[best(n) for n in ("cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2")])
    return rows.select(F.upper("c.id").alias("cve_id"), F.col("c.vulnStatus").alias("nvd_status"), found.alias("b")).select("cve_id", "nvd_status", "b.*")


def read_epss(spark: SparkSession, path: str) -> DataFrame:
    """cve_id, epss_score, epss_percentile, epss_date; rows without numbers are dropped."""
    rows = spark.read.option("multiLine", True).schema("data array<struct<cve string, epss string, percentile string, date string>>").json(path).select(F.inline("data"))
    out = rows.select(F.upper("cve").alias("cve_id"), F.expr("try_cast(epss AS double)").alias("epss_score"), F.expr("try_cast(percentile AS double)").alias("epss_percentile"), F.col("date").alias("epss_date"))
    return out.where("epss_score IS NOT NULL AND epss_percentile IS NOT NULL")


def read_watchlist(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, one state a source) of a blocklist document; a source that did not answer has no rows."""
    schema = ("items array<struct<source string, ioc_type string, value string, port int, threat_type string, malware string, first_seen string, last_seen string, ioc_id int, confidence string>>, "
              "sources map<string, struct<ok boolean, listed_now int, error string>>")
    doc = spark.read.option("multiLine", True).schema(schema).json(path)
    state = doc.select(F.explode("sources").alias("source", "s")).select("source", "s.*")
    rows = doc.select(F.inline("items")).withColumn("confidence", F.coalesce(F.expr("try_cast(confidence AS int)"), F.lit(0)))
    return rows.join(state.where("ok").select("source"), "source", "left_semi"), state


def read_observables(spark: SparkSession, path: str) -> DataFrame:
    """input_index, value, type_supplied, sample_id of one value a line or CSV with the header value[,type][,sample_id]; comments and blanks are skipped.

    Rows are numbered from 0 in the order of the lines (files by path). Every task numbers the lines of a split of a file, and a split's
    numbers start where the counts of those before it end, so a file may be of any size.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    lines = lines.withColumn("text", F.regexp_replace("value", "^\\ufeff|\r$", ""))
    parts = F.split("text", ",")
    header = F.lower(F.trim(F.get(parts, F.lit(0)))) == "value"
    rows = lines.where(~F.trim("text").startswith("#") & (F.trim("text") != "") & ~header)
    counts = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))  # one row a split
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
    out = rows.withColumn("k", inside).join(starts, ["file", "block"]).withColumn("input_index", (F.col("start") + F.col("k") - 1).cast("long"))
    cell = lambda k: F.nullif(F.trim(F.get(parts, F.lit(k))), F.lit(""))
    return out.select("input_index", F.trim(F.get(parts, F.lit(0))).alias("value"), cell(1).alias("type_supplied"), F.coalesce(cell(2), F.concat(F.lit("row-"), F.col("input_index") + 1)).alias("sample_id"))


def read_psl(spark: SparkSession, path: str, min_rules: int = 1000) -> DataFrame:
    """(rule, kind) of a public-suffix list; fails under ``min_rules`` rules."""
    lines = spark.read.text(path).select(F.lower(F.regexp_extract("value", r"^\s*(\S*)", 1)).alias("r")).where("r != '' AND NOT startswith(r, '//')")
    kind = F.when(F.col("r").startswith("!"), "exception").when(F.col("r").startswith("*."), "wildcard").otherwise("normal")
    rules = lines.select(F.regexp_replace("r", r"^(!|\*\.)", "").alias("rule"), kind.alias("kind")).distinct()
    n = rules.count()
    if n < min_rules:
        raise ValueError(f"{n} public-suffix rules, fewer than {min_rules}")
    return rules


def read_tlds(spark: SparkSession, path: str) -> DataFrame:
    """Delegated top-level domains, and the special-use ones that name real hosts (onion, i2p, bit)."""
    listed = spark.read.text(path).select(F.lower(F.trim("value")).alias("tld")).where("tld != '' AND NOT startswith(tld, '#')")
    return listed.unionByName(spark.createDataFrame([("onion",), ("i2p",), ("bit",)], "tld string")).distinct()


def previous_iocs(evidence: DataFrame, date: str) -> DataFrame:
    """Distinct confirmed (indicator_type, normalized_value) of the day before ``date``."""
    return evidence.where((F.col("report_date") == F.date_sub(F.lit(date).cast("date"), 1)) & (F.col("status") == "confirmed")).select("indicator_type", "normalized_value").distinct()


def write_day(df: DataFrame, path: str) -> None:
    """Replace the report days that ``df`` holds and leave the others; repeating it changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date").parquet(path)


CSV_COLUMNS = ("action", "priority", "is_new", "indicator_type", "normalized_value", "article_title", "article_url", "reason", "kev", "kev_due_date", "cvss_score", "cvss_severity", "epss_score", "epss_percentile")


def to_action_csv(actions: DataFrame) -> DataFrame:
    """Text columns of the actionable rows (patch, block, hunt): what is missing is blank, not zero; EPSS has five decimals, its percentile three."""
    def text(name: str) -> Column:
        source = {"indicator_type": "target_type", "normalized_value": "target", "article_url": "url"}.get(name, name)
        if source not in actions.columns:
            return F.lit("")
        value = F.col(source)
        form = {"cvss_score": "%.1f", "epss_score": "%.5f", "epss_percentile": "%.3f"}.get(name)
        shown = F.format_string(form, value) if form else value.cast("string")
        return F.when(value.isNull(), "").otherwise(shown)

    return actions.where(F.col("action").isin("patch", "block", "hunt")).select(*(text(c).alias(c) for c in CSV_COLUMNS))


def write_validation(verdicts: DataFrame, summary: DataFrame, path: str) -> None:
    """Verdicts as CSV with a header under ``path``/results, their rates as JSON under ``path``/summary."""
    flat = [F.array_join(c, " ").alias(c) if t.startswith("array") else F.col(c) for c, t in verdicts.dtypes]
    verdicts.select(*flat).write.mode("overwrite").option("header", True).csv(f"{path}/results")
    summary.write.mode("overwrite").json(f"{path}/summary")


def pack_json(value: Column) -> Column:
    """JSON text of an array, struct or map; null for null."""
    return F.to_json(value)


def unpack_json(text: Column, schema: str) -> Column:
    """The value of a JSON text; null where it can't be read."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def rules_version(rules: DataFrame, columns: tuple[str, ...] = ("rule", "kind")) -> DataFrame:
    """One digest of a rule table, whatever its order; rule lists have some thousand rows."""
    row = F.concat_ws("\t", *columns)
    return rules.agg(F.sha2(F.array_join(F.array_sort(F.collect_set(row)), "\n"), 256).alias("version"))
