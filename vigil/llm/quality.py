"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Base rules count code points, symbols, repeated lines and words in repeated 3-word
windows. The verdict is a likelihood ratio between two multinomials over hashed word
unigrams and bigrams: one of a bounded set of trusted documents, one of the raw corpus, of
which every document is counted. A document's score is its summed log ratio divided
by its number of n-grams; it is kept if the score reaches the threshold. Ratios are
whole micro-nats, so that the sums, and with them the verdicts, don't depend on the
order of additions.

Everything is Spark SQL. The only thing sent to the driver and back is one number for
each of BUCKETS hash buckets. Scoring needs no shuffle: each row is judged in its task.

Edge cases: a null or empty text has no words and fails the base rule; texts of any
length are read whole; repeated rows are judged one by one; with no trusted document
(or none at all) all ratios are 0 and the base rules decide; columns besides doc_id and
text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
#: Mean log ratio (nats an n-gram) from which a document is kept.
THRESHOLD = -0.07
SMOOTHING = 1.0
#: Documents of the trusted set that the target model is fitted on; the raw model counts every document.
TARGET_ROWS = 20_000
#: Documents of fewer words, or with a larger share of words in repeated windows (percent), fail the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WHITESPACE = " \t\n\x0b\x0c\r"
#: Positions in a packed (hash, position) number.
POS_BITS = 20


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c))
    return text


def words_of(text: Column) -> Column:
    """Maximal runs of non-whitespace as an array."""
    for c in WHITESPACE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _ngram_buckets(words: str) -> Column:
    one = F.expr(f"transform({words}, x -> cast(pmod(xxhash64(x), {BUCKETS}) as int))")
    two = F.expr(f"transform(slice({words}, 2, greatest(size({words}) - 1, 0)), (x, i) -> cast(pmod(xxhash64({words}[i], x), {BUCKETS}) as int))")
    return F.concat(one, two)


def fit_ratios(docs: DataFrame, trusted_ids: DataFrame) -> list[int]:
    """Micro-nats log(p target / p raw) for each bucket; both are counted in one pass over all documents.

    The target is the TARGET_ROWS documents of ``trusted_ids`` with the smallest hashes of doc_id, so its ids are broadcast.
    """
    target = trusted_ids.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS).withColumn("target", F.lit(1))
    known = docs.select("doc_id", "text").join(F.broadcast(target), "doc_id", "left")
    grams = known.select("target", words_of(F.coalesce("text", F.lit(""))).alias("w")).select("target", F.explode_outer(_ngram_buckets("w")).alias("b"))
    rows = grams.where("b IS NOT NULL").groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.count("target").alias("t")).collect()
    n_target = sum(r["t"] for r in rows)
    if not n_target:
        return [0] * BUCKETS
    of_bucket = {r["b"]: r for r in rows}
    all_raw, all_target = sum(r["n"] for r in rows) + SMOOTHING * BUCKETS, n_target + SMOOTHING * BUCKETS
    ratio = lambda r: math.log(((r["t"] if r else 0) + SMOOTHING) / all_target * all_raw / ((r["n"] if r else 0) + SMOOTHING))
    return [round(1e6 * ratio(of_bucket.get(b))) for b in range(BUCKETS)]


def _dup_lines() -> Column:
    lines = "filter(split(t, '\\n'), x -> length(trim(BOTH ' \\t\\x0b\\x0c\\r' FROM x)) > 0)".replace("\\x0b", "\x0b").replace("\\x0c", "\x0c")
    return F.expr(f"CASE WHEN instr(t, '\\n') = 0 THEN 0 ELSE size({lines}) - size(array_distinct({lines})) END")


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words from the words ``w``: words in 3-word windows whose text occurs twice or more.

    Windows are 64-bit hashes ``h``. Hash and position packed in one number sort fast; where the shorter hash would merge
    windows that ``h`` keeps apart, or there are too many positions, (h, position) pairs are sorted instead.
    """
    df = df.withColumn("h", F.expr("slice(transform(w, (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2))), 1, greatest(size(w) - 2, 0))"))
    df = df.withColumn("n_h", F.expr("size(array_distinct(h))"))
    packed = f"transform(h, (x, i) -> shiftleft(x, {POS_BITS}) + i)"
    short = f"size(array_distinct(transform(h, x -> shiftleft(x, {POS_BITS}))))"
    df = df.withColumn("s", F.expr(f"CASE WHEN n_h < size(h) AND size(h) < {1 << POS_BITS} AND {short} = n_h THEN array_sort({packed}) END"))
    df = df.withColumn("slow", F.expr("CASE WHEN n_h < size(h) AND s IS NULL THEN array_sort(transform(h, (x, i) -> struct(x AS x, i AS i))) END"))
    same = f"shiftright(x, {POS_BITS}) = shiftright(get(s, i %s), {POS_BITS})"
    fast_at = f"transform(filter(s, (x, i) -> coalesce({same % '- 1'}, false) OR coalesce({same % '+ 1'}, false)), x -> cast(x & {(1 << POS_BITS) - 1} as int))"
    slow_at = "transform(filter(slow, (x, i) -> coalesce(x.x = get(slow, i - 1).x, false) OR coalesce(x.x = get(slow, i + 1).x, false)), x -> x.i)"
    df = df.withColumn("f", F.expr(f"CASE WHEN s IS NOT NULL THEN array_sort({fast_at}) WHEN slow IS NOT NULL THEN array_sort({slow_at}) END"))
    covered = "aggregate(transform(f, (x, i) -> least(3, coalesce(get(f, i + 1) - x, 3))), 0, (a, x) -> a + x)"
    return df.withColumn("n_repeat_words", F.expr(f"coalesce(CASE WHEN size(f) > 0 THEN {covered} END, 0)").cast("long"))


def judge_quality(docs: DataFrame, ratios: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, score and verdict for every row of ``docs``."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    df = df.withColumn("w", words_of(F.col("t")))
    df = df.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.length(_without(F.col("t"), WHITESPACE)).cast("long").alias("word_chars"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        _dup_lines().cast("long").alias("n_dup_lines"), "w")
    df = _with_repeat_words(df)
    table = F.from_json(F.lit("[" + ",".join(map(str, ratios)) + "]"), "array<bigint>")
    df = df.withColumn("b", _ngram_buckets("w"))
    total = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + F.get(table, x))
    score = F.when(F.size("b") > 0, total / F.size("b") / 1e6).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), score.alias("score")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def filter_quality(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``judge_quality`` with ratios of the documents listed in ``trusted_ids`` against all documents."""
    return judge_quality(docs, fit_ratios(docs, trusted_ids), threshold)
