"""Observables against a corpus: exact, same host, parent and child domain, exclusions, verdicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.functions import urls as U
from vigil.functions.addresses import canonical_ipv6, ipv6_hex
from vigil.plans.materialize import materialize


#: Added to an exception's labels so that it is the largest; no host has as many.
_EXCEPTION = 1 << 32


def public_suffix_depth(hosts: DataFrame, host: str, psl: DataFrame) -> DataFrame:
    """Add ``suffix_labels``: labels of the longest matching public-suffix rule (an exception beats a wildcard beats a plain rule; an unlisted TLD counts one).

    psl: rule, kind (normal, wildcard or exception). Distinct hosts are joined on every tail, once for all kinds, so no rule list is scanned.
    """
    distinct = hosts.select(F.col(host).alias("_host")).where("_host != ''").distinct().withColumn("_n", F.size(F.split("_host", r"\.")))
    tails = distinct.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n")))).withColumn("_tail", F.call_function("substring_index", F.col("_host"), F.lit("."), -F.col("_k")))
    met = tails.join(psl.select(F.col("rule").alias("_tail"), "kind"), "_tail")
    depth = F.when(F.col("kind") == "normal", F.col("_k")).when((F.col("kind") == "wildcard") & (F.col("_k") < F.col("_n")), F.col("_k") + 1).when(F.col("kind") == "exception", F.col("_k") - 1 + F.lit(_EXCEPTION))
    best = met.groupBy("_host").agg(F.max(depth.cast("long")).alias("_d"))
    return hosts.join(best, F.col(host) == F.col("_host"), "left").withColumn("suffix_labels", F.coalesce((F.col("_d") % _EXCEPTION).cast("int"), F.lit(1))).drop("_host", "_d")


def registrable(host: Column, suffix_labels: Column) -> Column:
    """The suffix and one label; '' where the host is a suffix itself."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) > suffix_labels, F.array_join(F.slice(labels, F.size(labels) - suffix_labels, suffix_labels + 1), ".")).otherwise("")


def parents(host: Column, suffix_labels: Column) -> Column:
    """Ancestors of a host down to the registrable domain, nearest first."""
    labels = F.split(host, r"\.")
    spare = F.size(labels) - suffix_labels - 1
    return F.when(spare > 0, F.transform(F.sequence(F.lit(2), spare + 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).otherwise(F.array().cast("array<string>"))


def each_parent(df: DataFrame, host: str, name: str, *kept: str) -> DataFrame:
    """One row for each of ``parents``: ``kept``, depth (from 0, nearest first) and the ancestor as ``name``. df also has suffix_labels.

    Places are dealt out first and each ancestor is cut from its place, so a row's labels are not split again for every one.
    """
    counted = df.select(*kept, F.col(host).alias("_host"), F.size(F.split(host, r"\.")).alias("_n"), "suffix_labels")
    placed = counted.where("_n - suffix_labels > 1").select(*kept, "_host", "_n", F.explode(F.sequence(F.lit(1), F.col("_n") - F.col("suffix_labels") - 1)).alias("_i"))
    return placed.select(*kept, (F.col("_i") - 1).alias("depth"), F.call_function("substring_index", F.col("_host"), F.lit("."), F.col("_i") - F.col("_n")).alias(name))


def parse_observables(observables: DataFrame, psl: DataFrame, skip: Callable[[Column, Column], Column]) -> DataFrame:
    """input_index, value, type_used, skip, whole (the text or URL as compared), key (a URL's host, an address's short form) and suffix_labels, written once.

    Parsing is long expressions, made column by column; the joins that follow read the written result. ``skip`` takes (guard's reason, type used).
    """
    if "type_supplied" not in observables.columns:
        observables = observables.withColumn("type_supplied", F.lit(None).cast("string"))
    rows = observables.select("input_index", "value", F.nullif("type_supplied", F.lit("")).alias("type_supplied"), F.trim(F.coalesce("value", F.lit(""))).alias("v"))
    rows = materialize(rows.withColumn("plain", U.undefang(F.col("v"))), "restored")
    rows = rows.withColumns({"host": U.looked_up_host(F.col("plain")), "type_used": F.coalesce("type_supplied", U.detect_type(F.col("plain")))})
    rows = rows.withColumns({"v4": U.ipv4_to_long(F.col("host")), "v6": F.when(F.col("host").contains(":"), ipv6_hex(F.col("host")))})
    guard = U.judge_guard(F.col("v"), F.col("plain"), F.col("host"), F.col("v4"), F.col("v6"))
    named = F.when(F.col("type_used") == "url", F.coalesce(F.nullif("host", F.lit("")), F.lit(""))).otherwise(F.lower("plain"))
    key = F.when(F.col("v6").isNotNull(), canonical_ipv6(F.col("v6"))).otherwise(named)
    whole = F.when(F.col("type_used") == "ip", key).otherwise(U.whole_url_key(F.col("plain")))
    parsed = materialize(rows.select("input_index", "value", "type_used", skip(guard, F.col("type_used")).alias("skip"), whole.alias("whole"), key.alias("key")), "parsed")
    return materialize(public_suffix_depth(parsed, "key", psl), "asked")


def match_observables(observables: DataFrame, corpus: DataFrame, excluded: DataFrame, psl: DataFrame) -> DataFrame:
    """One verdict for every observable (input_index, value and, where given, type_supplied), with the offline skip rules. See ``match_parsed``."""
    return match_parsed(parse_observables(observables, psl, U.judge_skip), corpus, excluded, psl)


def match_parsed(rows: DataFrame, corpus: DataFrame, excluded: DataFrame, psl: DataFrame) -> DataFrame:
    """One verdict for every row of ``parse_observables``.

    corpus: value_lc, benign_basis (null or why the value matches only exactly) and, where known, indicator_type. excluded: value_lc.
    Precedence: exact match, whole exclusion, same host, host exclusion, nearest parent, smallest child. Every relation is an equi-join.
    """
    return match_sides(rows, *corpus_sides(corpus, psl), excluded)


def corpus_sides(corpus: DataFrame, psl: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, under): the corpus by value, and the smallest of its free names beneath each host. They depend on the corpus alone.

    Of the names beneath a host only the smallest travels, so a domain with very many names costs no pairs. A value that the corpus has
    twice is held back if one of its rows says so, by the smallest reason.
    """
    kind = F.min("indicator_type") if "indicator_type" in corpus.columns else F.lit(None).cast("string")
    known = corpus.groupBy("value_lc").agg(F.min("benign_basis").alias("benign_basis"), kind.alias("kind"))
    # each name's ancestors down to its registrable domain; the smallest name of each meets the hosts
    free = known.where("benign_basis IS NULL").where(F.when(F.col("kind").isNotNull(), F.col("kind")).otherwise(U.detect_type(F.col("value_lc"))) == "domain")
    named = public_suffix_depth(free.select("value_lc"), "value_lc", psl)
    under = each_parent(named, "value_lc", "key", "value_lc").groupBy("key").agg(F.min("value_lc").alias("value_lc"))
    return known, under


def match_sides(rows: DataFrame, known: DataFrame, under: DataFrame, excluded: DataFrame) -> DataFrame:
    """``match_parsed`` with the two tables of ``corpus_sides``."""
    asked = rows.where("skip IS NULL").select("input_index", "type_used", "whole", "key", "suffix_labels")
    is_name = F.col("type_used").isin("domain", "url") & (F.col("key").rlike("[^0-9.]") | U.ipv4_to_long(F.col("key")).isNull()) & ~F.col("key").contains(":")

    def hit(df: DataFrame, rank: int, method: str, depth: Column | None = None) -> DataFrame:
        return df.select("input_index", F.lit(rank).alias("rank"), (depth if depth is not None else F.lit(0)).alias("depth"), F.col("value_lc").alias("matched_value"), F.lit(method).alias("match_method"))

    free = known.where("benign_basis IS NULL")
    exact = hit(asked.join(known, asked["whole"] == known["value_lc"]), 1, "exact")
    whole_out = hit(asked.join(excluded, asked["whole"] == excluded["value_lc"]), 2, "excluded")
    host = hit(asked.where("type_used = 'url'").join(free, F.col("key") == F.col("value_lc")), 3, "same_host")
    host_out = hit(asked.where("type_used = 'url'").join(excluded, F.col("key") == F.col("value_lc")), 4, "excluded_host")
    up = each_parent(asked.where(is_name), "key", "value_lc", "input_index")
    parent = hit(up.join(free, "value_lc"), 5, "parent_domain", F.col("depth"))
    child = hit(asked.where(is_name).join(under, "key"), 6, "child_domain")
    found = exact
    for more in (whole_out, host, host_out, parent, child):
        found = found.unionByName(more)
    best = found.groupBy("input_index").agg(F.min(F.struct("rank", "depth", "matched_value", "match_method")).alias("m"))
    status = F.when(F.col("skip").isNotNull(), "skipped").when(F.col("m.rank").isin(2, 4), "excluded").when(F.col("m.rank").isNotNull(), "hit").otherwise("miss")
    return rows.join(best, "input_index", "left").select(
        "input_index", "value", "type_used", status.alias("status"), F.col("skip").alias("reason"), F.col("m.match_method").alias("match_method"), F.col("m.matched_value").alias("matched_value"))


def validation_summary(verdicts: DataFrame) -> DataFrame:
    """Counts and hit rates by type; headline hits leave out child domains, and rates leave out what was skipped."""
    hit = F.col("status") == "hit"
    out = verdicts.groupBy("type_used").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "skipped").alias("n_skipped"), F.count_if(hit).alias("n_hits"),
        F.count_if(hit & (F.col("match_method") != "child_domain")).alias("n_headline"), F.count_if(F.col("status") == "excluded").alias("n_excluded"), F.count_if(F.col("status") == "miss").alias("n_unseen"))
    return out.withColumn("headline_rate", F.round(F.col("n_headline") / F.nullif(F.col("n") - F.col("n_skipped"), F.lit(0)), 4))


def feed_hits(hosts: DataFrame, feeds: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` latest feed rows of each host: listed itself, or by its registrable domain. hosts: input_index, key, apex; feeds: value_lc, source, last_seen."""
    direct = hosts.join(feeds, hosts["key"] == feeds["value_lc"]).select("input_index", "source", "last_seen", F.lit("exact").alias("relation"))
    wide = hosts.where("apex != key").join(feeds, F.col("apex") == F.col("value_lc")).select("input_index", "source", "last_seen", F.lit("registrable_domain").alias("relation"))
    order = Window.partitionBy("input_index").orderBy("relation", F.desc("last_seen"), "source")
    return direct.unionByName(wide).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
