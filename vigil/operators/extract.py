"""Indicator extraction over an articles table (url, body, publisher_hosts)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.functions import addresses as A
from vigil.functions import scan
from vigil.functions import text as T
from vigil.functions import urls as U

# Indicator patterns, in order of precedence.
PATTERNS = (
    ("cve", r"(?iU)\bCVE-\d{4}-\d{4,7}\b"),
    ("hash", r"(?i)(?<![0-9a-f])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})(?![0-9a-f])"),
    ("url", r"(?iU)\b(?:hxxps?|https?)://[^\s<>\"']+"),
    ("ip", r"(?<!\d)(?:\d{1,3}(?:\.|\[\.\]|\(\.\))){3}\d{1,3}(?!\d)"),
    ("ip", r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{0,4}:){2,7}[0-9a-f]{0,4}(?![0-9a-f:])"),
    ("filename", r"(?iU)(?<![\w.-])[\w@+-][\w@().+-]*\.(?:exe|dll|sys|ps1|bat|cmd|vbs|js|jar|py|zip|rar|7z|hta|msi|scr|elf|bin|dat|pem|lnk|iso|img|doc|docx|xls|xlsx|ppt|pptx|pdf|"
                 r"tmp|enc|dmp|bak|log|apk|jse|wsf|pif|mov)(?![\w-]|\.[a-z0-9])"),
    ("domain", r"(?iU)(?<![\w@.-])(?:[a-z0-9-]{1,63}(?:\.|\[\.\]|\(\.\))){1,}(?:[a-z]{2,63}|xn--[a-z0-9-]{2,59}|i2p)(?![\w-]|\.[a-z0-9])"),
)
# Words before a match that make it a version number, or a file's name.
VERSION_BEFORE = r"(?i)(?:versions?\s+up\s+to(?:\s*,\s*and\s+including)?|\band\s+including|\bversions?\b)\s*,?\s*$"
FILE_BEFORE = r"(?i)\b(?:file\s*names?(?:\(s\))?|attachments?|documents?|payloads?|files?)\s*(?:is|are|named|called)?\s*[:=]?\s*$"
# How a text names a malware family (group 1: named, 2: named by a verb, 3: stands before its kind, 4: Chinese) and a technique.
FAMILY = (
    r"""(?U)(?:(?i:malware(?:\s+family)?|ransomware(?:\s+family)?|backdoor|trojan|botnet|wiper|stealer|rat|implant|loader|toolset|threat\s+(?:group|actor)|apt(?:\s+group)?)"""
    r"""\s+(?i:family\s+)?(?i:known\s+as|named|called|tracked\s+as|dubbed)\s+["']?([A-Z][A-Za-z0-9][\w+.-]{2,40}))"""
    r"""|(?:(?i:known|tracked|dubbed|named|called)\s+(?:(?i:the|this|a|an)\s+)?(?i:malware|ransomware|backdoor|trojan|botnet|wiper|stealer|rat|implant|loader|toolset|campaign|family)\s+"""
    r"""(?i:as|to\s+be)\s+["']?([A-Z][A-Za-z0-9][\w+.-]{2,40}))"""
    r"""|(?:["']?([A-Z][A-Za-z0-9][\w+.-]{2,40})["']?\s+(?i:ransomware|backdoor|stealer|wiper|botnet)\b)"""
    r"""|(?:(?:惡意程式|勒索軟體|後門|木馬|間諜軟體|攻擊組織)\s*(?:家族)?(?:稱為|名為|即)\s*["']?([A-Za-z0-9][\w+.-]{2,40}))""")
TECHNIQUE = r"(?iU)(?:(?:MITRE\s+)?ATT(?:&|＆)CK|MITRE)\s+(?:technique\s+)?(?:ID\s*)?(T\d{4}(?:\.\d{3})?)|(T\d{4}(?:\.\d{3})?)\s*(?:(?:MITRE\s+)?ATT(?:&|＆)CK)"
DESCRIPTOR = r"(?i)-(?:based|delivered|powered|themed|style|linked|related|driven)$"
GENERIC_NAMES = (
    "after", "against", "alleged", "another", "android", "attackers", "before", "claims", "confirms", "custom", "cyber", "during", "element", "encrypted", "following", "generic", "group", "hackers",
    "incident", "into", "java", "known", "latest", "linux", "macos", "major", "malicious", "new", "node.js", "python", "recent", "related", "researchers", "suspected", "that", "their", "these", "this",
    "those", "unknown", "when", "where", "which", "while", "windows", "with")
NETWORK = ("ip", "domain", "url")
#: A line that none of the patterns can match has none of these signs: pieces of its lower-case form, and patterns. Each alone scans a line
#: many times faster than one alternation of all.
_INDICATOR_SIGN = (("://", "cve-"), (r"[.\])][A-Za-z0-9\[(@_+-]", r":[0-9A-Fa-f]*:", r"[0-9A-Fa-f]{32}"))
_CLAIM_SIGN = (("malware", "ransomware", "backdoor", "trojan", "botnet", "wiper", "stealer", "implant", "loader", "toolset", "threat", "campaign", "family", *"惡勒後木間攻"),
               (r"[Tt]\d{4}",))
_SHORT_SIGN = (("rat", "apt"), (r"(?i)\b(?:rat|apt)\b",))


def lines_of(articles: DataFrame) -> DataFrame:
    """One row a line with its section and zone, which the last heading before it decides, and its context.

    The array of lines is cut at its headings, each piece takes its heading along, and the pieces are exploded: every line is copied
    once, whatever their number. Works without a shuffle, so that it serves streams too.
    """
    others = [c for c in ("publisher_hosts",) if c in articles.columns]
    kind = lambda x: F.when(T.heading_kind(x) == "ioc", "ioc").when(T.heading_kind(x) == "excluded", "excluded").otherwise("general")
    start = F.struct(F.lit(0).alias("i"), F.lit("article body").alias("section"), F.lit("general").alias("zone"), F.lit(False).alias("head"))

    def head(x: Column, i: Column) -> Column:
        return F.when(T.is_heading(x), F.struct(i.alias("i"), F.trim(x).alias("section"), kind(x).alias("zone"), F.lit(True).alias("head")))

    def pieces(lines: Column) -> Column:
        before = F.concat(F.array(F.lit("")), lines)
        after = F.concat(F.slice(lines, F.lit(2), F.size(lines)), F.array(F.lit("")))
        rows = F.zip_with(F.arrays_zip(lines.alias("line"), before.alias("before")), after, lambda x, y: F.struct(x["line"].alias("line"), x["before"].alias("before"), y.alias("after")))
        heads = F.concat(F.array(start), F.array_compact(F.transform(lines, head)))
        return U.let(rows, lambda rows: U.let(heads, lambda heads: F.transform(heads, lambda h, k: F.struct(
            h["section"].alias("section"), h["zone"].alias("zone"), h["head"].alias("head"), h["i"].alias("first"),
            F.slice(rows, h["i"] + 1, F.coalesce(F.get(heads, k + 1)["i"], F.size(lines)) - h["i"]).alias("part")))))

    rows = articles.select("url", *others, F.sha2(F.coalesce("body", F.lit("")), 256).alias("body_sha256"), U.let(T.body_lines(F.col("body")), pieces).alias("pieces"))
    # exploded outer, as for plain ones the optimizer would test the arrays' sizes first, by all their expressions again
    rows = rows.select("url", *others, "body_sha256", F.inline_outer("pieces"))
    rows = rows.select("url", *others, "body_sha256", "section", "zone", "head", "first", F.posexplode_outer("part").alias("k", "l")).where("k IS NOT NULL")
    near = F.filter(F.array(F.trim("l.before"), F.trim("l.line"), F.trim("l.after")), lambda x: x != "")
    zone = F.when(F.col("l.line").rlike(T.RELATED_LINE), "excluded").otherwise(F.col("zone"))
    return rows.select("url", *others, "body_sha256", (F.col("first") + F.col("k")).alias("ln"), F.col("l.line").alias("line"), (F.col("head") & (F.col("k") == 0)).alias("is_heading"),
                       "section", zone.alias("zone"), F.array_join(near, "\n").alias("context"))


_MATCH = scan.MATCH
_INDICATORS = tuple((prio, kind, pattern) for prio, (kind, pattern) in enumerate(PATTERNS))
_CLAIMS = ((90, "malware_family", FAMILY), (91, "attack_technique", TECHNIQUE))


def line_matches(lines: DataFrame) -> DataFrame:
    """Add ``found``, the matches of all indicator patterns, and ``claims``, those of the claim patterns; headings are not read, nor lines without a sign of either."""
    read = lines.where("NOT is_heading").withColumn("low", F.lower("line"))
    says = lambda words: reduce(or_, [F.col("low").contains(w) for w in words])
    fits = lambda patterns: reduce(or_, [F.col("line").rlike(p) for p in patterns])
    signed = lambda sign: F.when(sign, F.col("line"))
    indicator = says(_INDICATOR_SIGN[0]) | fits(_INDICATOR_SIGN[1])
    claim = says(_CLAIM_SIGN[0]) | fits(_CLAIM_SIGN[1]) | (says(_SHORT_SIGN[0]) & fits(_SHORT_SIGN[1]))
    return read.withColumns({"found": scan.found_in(signed(indicator), _INDICATORS), "claims": scan.found_in(signed(claim), _CLAIMS)}).drop("low")


def _judged(m: Column, tlds: tuple[str, ...]) -> Column:
    """The match under its final kind; null if it is no indicator. A name that the line introduces as a file is one, whatever its ending."""
    as_file = (m["kind"] == "domain") & F.right(m["before"], F.lit(80)).rlike(FILE_BEFORE)
    normal = U.normalize_indicator(m["raw"], m["kind"])
    labels = F.split(normal, r"\.")
    host = F.element_at(labels, -1).isin(*tlds) & F.forall(labels, lambda x: (x != "") & (F.length(x) <= 63) & ~x.startswith("-") & ~x.endswith("-"))
    good = (F.when(m["kind"] == "ip", (U.ipv4_to_long(normal).isNotNull() | A.ipv6_hex(normal).isNotNull()) & ~m["before"].rlike(VERSION_BEFORE))
            .when(m["kind"] == "domain", ~m["before"].rlike(r"[/\\]$") & (as_file | host)).otherwise(True))
    kind = F.when(as_file, "filename").when(m["kind"] == "hash", U.hash_type(m["raw"])).otherwise(m["kind"])
    return F.when(good, F.struct(m["prio"].alias("prio"), m["start"].alias("start"), m["end"].alias("end"), kind.alias("kind"), m["raw"].alias("raw")))


def _claimed(m: Column) -> Column:
    """The claim with the name it makes in ``raw``; null for generic names and for words that describe."""
    groups = [F.nullif(F.regexp_extract(m["raw"], FAMILY, g), F.lit("")) for g in range(1, 5)]
    family = F.regexp_replace(F.coalesce(*groups), r"[.,;:]+$", "")
    technique = F.coalesce(*[F.nullif(F.regexp_extract(m["raw"], TECHNIQUE, g), F.lit("")) for g in (1, 2)])
    weak = (m["kind"] == "malware_family") & groups[0].isNull() & groups[1].isNull() & groups[2].isNotNull()
    good = F.when(m["kind"] == "malware_family", ~F.lower(family).isin(*GENERIC_NAMES) & ~family.rlike(DESCRIPTOR)).otherwise(True)
    name = F.when(m["kind"] == "malware_family", family).otherwise(technique)
    return F.when(good, F.struct(F.when(weak, 92).otherwise(m["prio"]).alias("prio"), m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"), name.alias("raw")))


def resolve_overlaps(matches: DataFrame, tlds: tuple[str, ...]) -> DataFrame:
    """Valid matches by precedence, then from the left; one that overlaps an accepted one is dropped, an invalid one takes no space. Claims overlap nothing."""
    valid = F.coalesce(F.array_compact(F.transform("found", lambda m: _judged(m, tlds))), F.array().cast(_MATCH))
    claims = F.coalesce(F.array_compact(F.transform("claims", _claimed)).cast(_MATCH), F.array().cast(_MATCH))
    # the judged matches become a column of their own before Python gets them, by an array of one; the planner would leave the call among Spark's expressions otherwise
    judged = matches.select("*", F.explode_outer(F.array(valid)).alias("valid"))
    rows = judged.withColumn("all", F.concat(scan.without_overlaps(F.col("valid")), claims))
    kept = [c for c in matches.columns if c not in ("line", "found", "claims")]
    # exploded outer: for a plain one the optimizer would test the array's size first, by all its expressions again
    return rows.select(*kept, F.inline_outer("all")).where("kind IS NOT NULL")


def classify(found: DataFrame) -> DataFrame:
    """Status, kind of assertion and reason: excluded zone, publisher, unreadable URL, non-public address, CVE, claim, indicator section, else candidate."""
    value = U.normalize_indicator(F.col("raw"), F.col("kind"))
    bare = lambda h: F.regexp_replace(h, r"^www\.", "")
    host = bare(F.when(F.col("kind") == "url", U.url_host(value)).when(F.col("kind") == "domain", value))
    ours = F.exists("publisher_hosts", lambda h: (h != "") & ((host == bare(h)) | host.endswith(F.concat(F.lit("."), bare(h)))))
    readable = U.url_host(value).rlike(r"^[a-z0-9._-]+$|^[0-9a-f:.]*:[0-9a-f:.]*$")
    reason = (
        F.when(F.col("zone") == "excluded", "excluded_editorial_section").when(ours, "publisher_domain")
        .when((F.col("kind") == "url") & ~readable, "unreadable_url").when((F.col("kind") == "ip") & ~F.coalesce(A.is_public_address(value), F.lit(False)), "non_public_ip")
        .when(F.col("kind") == "cve", "explicit_cve_identifier").when(F.col("prio") == 92, "apposition_requires_human_review")
        .when(F.col("kind").isin("malware_family", "attack_technique"), "explicit_source_label")
        .when(F.col("zone") == "ioc", "explicit_ioc_section").otherwise("context_requires_human_review"))
    rows = found.withColumns({"normalized_value": value, "reason": reason})
    confirmed = F.col("reason").isin("explicit_cve_identifier", "explicit_source_label", "explicit_ioc_section")
    candidate = F.col("reason").isin("context_requires_human_review", "apposition_requires_human_review")
    pick = lambda a, b, c: F.when(confirmed, a).when(candidate, b).otherwise(c)
    return rows.select("url", "body_sha256", F.col("kind").alias("indicator_type"), F.col("raw").alias("raw_value"), "normalized_value", (F.col("ln") + 1).alias("line_number"),
                       (F.col("start") + 1).alias("column_start"), (F.col("end") + 1).alias("column_end"), "section", "context", pick("confirmed", "candidate", "rejected").alias("status"),
                       pick("source_explicit", "machine_candidate", "machine_rejected").alias("assertion_kind"), F.array("reason").alias("reason_codes"))


def extract_evidence(articles: DataFrame, tlds: tuple[str, ...]) -> DataFrame:
    """Evidence rows of all articles (url, body, publisher_hosts), with a stable id. Row by row, without a shuffle: batch and stream alike."""
    found = classify(resolve_overlaps(line_matches(lines_of(articles)), tlds))
    key = F.concat_ws("\n", "body_sha256", "url", "line_number", F.col("column_start") - 1, F.col("column_end") - 1, "indicator_type", "normalized_value")
    return found.withColumn("evidence_id", F.substring(F.sha2(key, 256), 1, 20)).drop("body_sha256")


def local_windows(evidence: DataFrame, articles: DataFrame) -> DataFrame:
    """Add ``window``: the words next to each value. For a CVE its line and up to four more, until a blank line or another CVE; else its line, and the next if that names a score and no other CVE.

    Lines are those of ``impact_lines``; a value that only stands elsewhere has the lines of its context that name it. articles: url, body,
    one row a url. All values of an article meet its lines in one row, which one pass over the lines serves; they are no more than its text holds.
    """
    found = evidence.groupBy("url").agg(F.collect_list(F.struct(*[c for c in evidence.columns if c != "url"])).alias("_e"))
    rows = found.join(articles.select("url", T.impact_lines(F.coalesce("body", F.lit(""))).alias("_ls")), "url", "left")
    lower = lambda field: F.transform("_e", lambda e: F.lower(e[field]))
    places = scan.first_lines(F.transform("_ls", F.lower), F.concat(lower("normalized_value"), lower("raw_value")))
    rows = rows.withColumn("_at", places)
    first = lambda i: F.least(F.get("_at", i), F.get("_at", i + F.size("_e")))

    def window(e: Column, p: Column) -> Column:
        value = F.lower(e["normalized_value"])
        names = lambda x: F.lower(x).contains(value) | F.lower(x).contains(F.lower(e["raw_value"]))
        other = lambda x: F.exists(F.regexp_extract_all(x, F.lit(T.CVE), F.lit(0)), lambda c: F.upper(c) != F.upper(e["normalized_value"]))
        after = F.slice("_ls", p + 1, 4)
        stop = F.array_position(F.transform(after, lambda x: (x == "") | other(x)), F.lit(True))
        cve = F.slice(after, F.lit(1), F.when(stop > 0, stop.cast("int") - 1).otherwise(4))
        score = F.filter(F.slice("_ls", p + 1, 1), lambda x: x.rlike(T.CVSS) & ~other(x))
        own = F.concat(F.slice("_ls", p, 1), F.when(e["indicator_type"] == "cve", cve).otherwise(score))
        return F.when(p > 0, F.array_join(own, "\n")).otherwise(F.array_join(F.filter(F.split(e["context"], "\n"), names), "\n"))

    at = lambda i: F.coalesce(F.least(F.get("_at", i), F.get("_at", i + F.size("_e"))) + 1, F.lit(0))
    made = F.transform("_e", lambda e, i: F.struct(e.alias("e"), U.let(at(i), lambda p: window(e, p)).alias("window")))
    return rows.select("url", F.explode(made).alias("_x")).select("url", "_x.e.*", "_x.window")


def first_per_article(evidence: DataFrame) -> DataFrame:
    """First occurrence of each (article, type, value, status)."""
    order = Window.partitionBy("url", "indicator_type", "normalized_value", "status").orderBy("line_number", "column_start")
    return evidence.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def counts_by_status_type(evidence: DataFrame) -> DataFrame:
    """Distinct (type, value) by status, and by status and type; the type of a status total is null."""
    distinct = evidence.select("status", "indicator_type", "normalized_value").distinct()
    return distinct.groupingSets([["status"], ["status", "indicator_type"]], "status", "indicator_type").agg(F.count(F.lit(1)).alias("n"))
