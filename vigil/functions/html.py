"""Bodies of web pages and feed entries: quality and choice, as columns over the texts that ``markup`` finds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.dates import parse_ts
from vigil.functions.markup import body_texts, clean_text, page_candidates

# Marks of pages that are no article, words of a title that say nothing, weights of the ways to find a body.
BLOCK_PAGE_MARKS = ("performing security verification", "enable javascript and cookies to continue", "checking your browser before accessing", "access denied")
TITLE_STOPS = ("with", "from", "that", "this", "your")
METHOD_WEIGHTS = {"json-ld": 30, "site-selector": 25, "semantic-selector": 10}
COMPLETE = 1200
FEW_BLOCKS, NO_TITLE, BLOCKED, TOO_SHORT = "body has unusually few text blocks", "article title terms are absent from extracted body", "anti-bot or access-denied page detected", "body too short (%d characters)"
NO_CANDIDATES, NO_ZONE = "no extraction candidates", "publication date lacked a timezone and was treated as UTC"


def title_terms(title: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit("[a-z0-9]{4,}"), F.lit(0)))


def body_quality(text: Column, title: Column, least: Column) -> Column:
    """struct(valid, warnings): whether a text can be an article's body, and what is odd about it.

    Two marks of a blocking page in its first 1,500 characters, or "access denied" as its first words, are none; nor is a text under
    ``least`` characters. Few blocks, and a title of which no word stands in the first 4,000 characters, are warnings. (The program that this
    follows compares whole words with single characters there, and so warns of every title; the sensible reading is taken.)
    """
    opening = F.lower(F.substring(text, 1, 1500))
    marks = sum((opening.contains(m).cast("int") for m in BLOCK_PAGE_MARKS), F.lit(0))
    blocked = (marks >= 2) | F.ltrim(opening).startswith("access denied")
    terms = F.filter(title_terms(title), lambda t: ~t.isin(*TITLE_STOPS))
    sample = F.lower(F.substring(text, 1, 4000))
    warnings = F.array_compact(F.array(
        F.when(F.length(text) - F.length(F.replace(text, F.lit("\n"))) < 3, FEW_BLOCKS),
        F.when((F.size(terms) > 0) & ~F.exists(terms, lambda t: sample.contains(t)), NO_TITLE)))
    judged = (F.when(blocked, F.struct(F.lit(False).alias("valid"), F.array(F.lit(BLOCKED)).alias("warnings")))
              .when(F.length(text) < least, F.struct(F.lit(False).alias("valid"), F.array(F.format_string(TOO_SHORT, F.length(text))).alias("warnings")))
              .otherwise(F.struct(F.lit(True).alias("valid"), warnings.alias("warnings"))))
    return judged


def body_score(text: Column, title: Column, method: Column) -> Column:
    """Weight of the method, 40 times the share of title words found, and a point for each 1,000 characters up to 20."""
    terms = title_terms(title)
    sample = F.lower(F.substring(text, 1, 4000))
    found = F.size(F.filter(terms, lambda t: sample.contains(t)))
    weight = F.lit(0)
    for name, points in METHOD_WEIGHTS.items():
        weight = F.when(method.startswith(name), points).otherwise(weight)
    return weight + 40 * found / F.greatest(F.size(terms), F.lit(1)) + F.least(F.length(text), F.lit(20_000)) / 1000


def choose_body(pages: DataFrame, least: int = 500) -> DataFrame:
    """``pages`` (html, title and others) with method, body, warnings and failures: the valid candidate of the greatest score, the first of equal ones.

    Candidates are the elements that the column article_selectors names, embedded data, and the article and main elements, each without
    the usual furniture and what exclude_selectors name (both arrays of CSS selectors; one that can't be read is passed over). Without a
    valid one, method is ``failed``, the body empty, and failures say why. A column min_body_characters sets the length by page.
    """
    listed = lambda c: F.col(c) if c in pages.columns else F.array().cast("array<string>")
    floor = F.coalesce(F.col("min_body_characters"), F.lit(least)) if "min_body_characters" in pages.columns else F.lit(least)
    # a column of its own, by an array of one: the planner would leave the call among Spark's expressions otherwise
    pages = pages.withColumn("_found", page_candidates(F.col("html"), listed("article_selectors"), listed("exclude_selectors")))
    pages = pages.select("*", F.explode_outer(F.array("_found")).alias("_made")).drop("_found")
    judged = F.transform("_made", lambda c: F.struct(
        c["method"].alias("method"), c["text"].alias("text"), body_quality(c["text"], F.col("title"), floor).alias("q"), body_score(c["text"], F.col("title"), c["method"]).alias("score")))
    rows = pages.withColumn("_c", judged)
    good = F.filter("_c", lambda c: c["q"]["valid"])
    best = F.aggregate(good, F.get(good, F.lit(0)), lambda a, c: F.when(c["score"] > a["score"], c).otherwise(a))
    failures = F.transform(F.filter("_c", lambda c: ~c["q"]["valid"]), lambda c: F.concat(c["method"], F.lit(": "), F.array_join(c["q"]["warnings"], ", ")))
    rows = rows.withColumns({"_best": best, "failures": F.when(F.size("_c") == 0, F.array(F.lit(NO_CANDIDATES))).otherwise(failures)})
    return rows.withColumns({"method": F.coalesce("_best.method", F.lit("failed")), "body": F.coalesce("_best.text", F.lit("")), "warnings": F.coalesce("_best.q.warnings", F.array().cast("array<string>"))}).drop("_made", "_c", "_best")


def normalize_feed_entries(entries: DataFrame) -> DataFrame:
    """Feed entries with title, url, published_at, summary and ``problem``: why an entry can't be used (null: it can), or what was assumed of its date.

    entries: title, link, published_raw, updated_raw, summary. Texts are cleaned; a date without a zone counts as UTC and is said so.
    """
    raw = F.coalesce("published_raw", "updated_raw")
    at = F.coalesce(parse_ts(F.col("published_raw")), parse_ts(F.col("updated_raw")))
    zoned = raw.rlike(r"(?:[zZ]|[+-]\d{2}:?\d{2}|\b[A-Z]{2,4})\s*$")
    title = F.trim(clean_text(F.coalesce("title", F.lit(""))))
    url = F.trim(F.coalesce("link", F.lit("")))
    problem = (F.when(at.isNull(), "missing or invalid publication date").when((title == "") | (url == ""), "missing title or URL").when(~url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^\[\]/?#\s]+"), "unreadable URL"))
    return entries.withColumns({"title": title, "url": url, "published_at": at, "summary": F.nullif(clean_text(F.coalesce("summary", F.lit(""))), F.lit("")), "problem": problem,
                                "note": F.when(problem.isNull() & ~zoned, NO_ZONE)})


def choose_entry_body(entries: DataFrame, pages: DataFrame, least: int = 500) -> DataFrame:
    """Entries (url, title, content array, summary_html) with method and body: the longest valid feed text of COMPLETE characters, else the page's body, else the longest valid feed text as partial, else failed.

    pages: url, page_method, page_body (``failed`` where there is none), one row a url.
    """
    given = F.filter(F.concat(F.coalesce("content", F.array().cast("array<string>")), F.array("summary_html")), lambda f: F.coalesce(f, F.lit("")) != "")
    from_content = F.size(F.filter(F.coalesce("content", F.array().cast("array<string>")), lambda f: F.coalesce(f, F.lit("")) != ""))
    rows = entries.withColumns({"_texts": body_texts(given), "_n": from_content})
    made = F.transform("_texts", lambda x, i: F.struct(F.when(i < F.col("_n"), "feed:content").otherwise("feed:summary").alias("method"), x.alias("text")))
    rows = rows.select("*", F.explode_outer(F.array(made)).alias("_c")).drop("_texts", "_n").join(pages, "url", "left")
    valid = F.filter("_c", lambda c: body_quality(c["text"], F.col("title"), F.lit(least))["valid"])
    longest = lambda a: F.aggregate(a, F.get(a, F.lit(0)), lambda best, c: F.when(F.length(c["text"]) > F.length(best["text"]), c).otherwise(best))
    whole, part = longest(F.filter(valid, lambda c: F.length(c["text"]) >= COMPLETE)), longest(valid)
    rows = rows.withColumns({"_whole": whole, "_part": part})
    page = F.col("page_method").isNotNull() & (F.col("page_method") != "failed")
    method = F.when(F.col("_whole").isNotNull(), F.col("_whole.method")).when(page, F.col("page_method")).when(F.col("_part").isNotNull(), F.concat("_part.method", F.lit(":partial"))).otherwise("failed")
    body = F.when(F.col("_whole").isNotNull(), F.col("_whole.text")).when(page, F.col("page_body")).when(F.col("_part").isNotNull(), F.col("_part.text")).otherwise("")
    return rows.withColumns({"method": method, "body": body}).drop("_c", "_whole", "_part", "page_method", "page_body")
