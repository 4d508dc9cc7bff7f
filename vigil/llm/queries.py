"""The numbered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, jaccard_join, language, manifest, packing, quality, search, sharding, simhash, suffix_dedup, token_counts, toxicity, url_filter
from vigil.sources.tables import read_table

#: (host, path, verdict) of the url rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
CAPACITY = 4096


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1")
    return quality.filter_quality(read_table(spark, sf_dir, "documents"), trusted)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), CAPACITY)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), CAPACITY)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.held_out(1, 3)
    found = language.identify_language(read_table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flag_contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 16)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULES_SQL} AS rules(host, path, verdict)")
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), rules)


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest.manifest(docs, claims={"n_chars": F.col("n_chars") + 1}, claimed_by=tampered)
    proof_sha256 = F.sha2(F.array_join(manifest.siblings(F.col("proof")), ""), 256)
    rows = rows.withColumns({"proof_sha256": proof_sha256, "folded_root": manifest.folded(F.col("claimed"), F.col("proof"))})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline  # noqa: F401  an absent pipeline is an error here

    ops = (op1_toxicity, op2_suffix_dedup, op3_quality, op4_token_counts, op5_simhash, op6_packing, op7_language, op8_decontamination, op9_sharding, op10_url_filter, op11_jaccard_join, op12_manifest, op13_search, pipeline)
    return {f.__name__: f for f in ops}


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


#: crc32 of a short text, bit by bit (-1: shift).
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN string_split({0}, '')])),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""


def _leaf_sql(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    parts = [f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')" for c in fields]
    return f"sha256({' || '.join(parts)})"


_MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS claimed
  FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes AS (
  SELECT g, 0 AS lvl, place, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT g, lvl + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY g, lvl, place // 2),
subroots AS MATERIALIZED (SELECT g, lvl AS levels, h, row_number() OVER (ORDER BY g) - 1 AS place FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, place, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY lvl, place // 2),
root AS (SELECT h FROM tops WHERE n = 1),
steps AS MATERIALIZED (
  SELECT p.doc_id, p.g, p.place AS leaf_place, m.lvl, (p.place >> m.lvl) % 2 AS right_one, s.h
  FROM placed p JOIN (SELECT DISTINCT g, lvl FROM nodes WHERE n > 1) m USING (g)
  LEFT JOIN nodes s ON s.g = p.g AND s.lvl = m.lvl AND s.place = xor(p.place >> m.lvl, 1)
  UNION ALL
  SELECT p.doc_id, p.g, p.place, r.levels + m.lvl, (r.place >> m.lvl) % 2, s.h
  FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) m
  LEFT JOIN tops s ON s.lvl = m.lvl AND s.place = xor(r.place >> m.lvl, 1)),
proofs AS (SELECT g, leaf_place, sha256(coalesce(string_agg(h, '' ORDER BY lvl), '')) AS proof_sha256 FROM steps GROUP BY g, leaf_place),
folds AS (
  SELECT g, place, 0 AS lvl, claimed AS h FROM placed
  UNION ALL
  SELECT f.g, f.place, f.lvl + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.right_one = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM folds f JOIN steps s ON s.g = f.g AND s.leaf_place = f.place AND s.lvl = f.lvl)
SELECT p.doc_id, p.leaf, r.h AS subroot, root.h AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM placed p JOIN subroots r USING (g) CROSS JOIN root
LEFT JOIN proofs q ON q.g = p.g AND q.leaf_place = p.place
JOIN (SELECT g, place, arg_max(h, lvl) AS h FROM folds GROUP BY g, place) f ON f.g = p.g AND f.place = p.place"""


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS_SQL = rf"unnest(regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
_SEARCH_SQL = f"""
WITH terms AS (SELECT r, doc_id, {_TERMS_SQL} AS term FROM (SELECT *, row_number() OVER () AS r FROM documents)),
sizes AS (SELECT r, doc_id, count(*) AS n FROM terms GROUP BY r, doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
tfs AS (SELECT r, term, count(*) AS tf FROM terms GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, totals GROUP BY term),
lengths AS (SELECT r, doc_id, 10 + (90 * n * docs) // total AS m FROM sizes, totals),
items AS (SELECT DISTINCT q, item_id, {_TERMS_SQL} AS term FROM (SELECT *, row_number() OVER () AS q FROM benchmark)),
scores AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (r) GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op13_search": _SEARCH_SQL, "op12_manifest": _MANIFEST_SQL, "op10_url_filter": rf"""
WITH parts AS (
  SELECT page_id, url, row_number() OVER () AS rn,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, v) AS (VALUES {_RULES_SQL}),
hits AS (
  SELECT rn, h || p AS rule, v, row_number() OVER (PARTITION BY rn ORDER BY length(h || p) DESC, length(h) DESC) AS k
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM hits WHERE k = 1) USING (rn)"""}
