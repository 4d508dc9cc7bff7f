"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

A rule is (host, path, verdict). It fits its host and all subdomains of it when the
url's path starts with the rule's path; of the rules that fit, the longest text
(host plus path) wins, then the longer host. The rules' canonical keys are listed in
a blocked Bloom filter (one 64-bit word a block, four bits a key). Each url yields one
candidate key for every host suffix and path prefix of a size that some rule has; the
filter drops nearly all that no rule lists, and an equi-join on the whole key removes
the false positives. All of it is Spark SQL functions and joins.

Edge cases: a url that is null or has no ``://`` has an empty host and path and fits no
rule; repeated rows are judged one by one; an empty rule table leaves every url with the
default verdict; other columns of ``pages`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_WORD = 64
KEYS_PER_BLOCK = 5
#: A Bloom table or rule table of more rows than this is joined by shuffle instead of broadcast (16 to about 100 bytes a row).
BROADCAST_ROWS = 500_000


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _word_mask(key: Column) -> Column:
    """Four of 64 bits that a key sets in its block's word."""
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    mask = F.lit(0).cast("long")
    for k in range(4):
        bit = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, bit))
    return mask


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_table(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, word): the blocked Bloom filter of ``keys[key]``."""
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(F.bit_or(_word_mask(F.col(key))).alias("word"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Return (id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has host, path and verdict. The distinct label counts and path lengths of the rules (not the rules) go to the
    driver; both are bounded by the longest rule.
    """
    listed = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.concat("host", "path").alias("key"), F.length("host").alias("host_chars"), "verdict"
    ).groupBy("key", "host_chars").agg(F.min("verdict").alias("verdict"))
    shape = listed.agg(
        F.count(F.lit(1)),
        F.collect_set(F.size(F.split(F.expr("substr(key, 1, host_chars)"), r"\."))),
        F.collect_set(F.length("key") - F.col("host_chars")),
    ).first()
    n_rules, label_counts, path_lengths = shape[0], sorted(shape[1]), sorted(shape[2])
    out = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if not n_rules:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    small = n_rules <= BROADCAST_ROWS
    blocks = max(1, -(-n_rules // KEYS_PER_BLOCK))
    hint = F.broadcast if small else (lambda df: df)
    suffix = [F.substring_index("host", ".", -n) for n in label_counts]
    fits_host = [F.size(F.split("host", r"\.")) >= n for n in label_counts]
    candidates = F.array_compact(F.array(*[
        F.when(ok & (F.length("path") >= m), F.struct(F.concat(s, F.substring("path", 1, m)).alias("key"), F.length(s).alias("host_chars")))
        for s, ok in zip(suffix, fits_host, strict=True) for m in path_lengths
    ]))
    probes = out.where("host != ''").select("host", "path", F.inline(candidates))
    possible = probes.withColumns({"block": _block(F.col("key"), blocks), "want": _word_mask(F.col("key"))}).join(
        hint(bloom_table(listed, "key", blocks)), "block"
    ).where(F.col("word").bitwiseAND(F.col("want")) == F.col("want"))
    hits = possible.join(hint(listed), ["key", "host_chars"]).groupBy("host", "path").agg(
        F.max(F.struct(F.length("key").alias("n"), "host_chars", "key", "verdict")).alias("best")
    )
    # rows without a host fit no rule; kept out of the join, where they would all have one key
    judged = out.where("host != ''").join(hits, ["host", "path"], "left").unionByName(out.where("host = ''"), allowMissingColumns=True)
    return judged.select(id_col, "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
