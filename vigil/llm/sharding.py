"""Sharding by histogram sort: exact byte counts below probes refine the splitters, then one exchange.

Documents are ordered by (xxhash64 of the text, xxhash64 of doc_id). Each round counts
the exact bytes between the probes of every splitter's open interval, across all
partitions, and keeps the sub-interval in which the splitter's target falls. A splitter
is settled when an edge of its interval is within the tolerance of the target, or when
the interval holds one key. Equal texts have one first key, so a group of copies is cut
only where the tolerance cannot be met otherwise; then the second key splits it. That is
at most one group a splitter, and only one of more bytes than the tolerance; ``cut_groups``
counts them. Rows travel once, with the number that they have in their shard.

Only SQL functions are used. A round sends shards times probes rows to the driver,
whatever the input's size. Edge cases: a null text has size 1; repeated rows share both
keys and stay together; an empty table gives no rows; columns besides doc_id and text
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.numbering import number_in_group
from vigil.plans.materialize import materialize

KEY_BITS = 63
#: log2 of the probes in an open interval, a round.
FAN_BITS = 8
#: Rows that one numbering task gets, about.
ROWS_PER_BUCKET = 10_000


def _key(*cols: Column) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << KEY_BITS) - 1))


def _counts(keys: DataFrame, open_: list[tuple], level: int) -> dict:
    """Bytes and rows by (interval, sub-interval) of the open intervals, counted over every row."""
    which = sub = None
    for i, (first, lo, bits) in enumerate(open_):
        key = F.col("k1") if level == 0 else F.col("k2")
        hit = (key >= F.lit(lo)) & (key <= F.lit(lo + (1 << bits) - 1))
        if level:
            hit = hit & (F.col("k1") == F.lit(first))
        part = F.call_function("shiftright", key - F.lit(lo), F.lit(max(0, bits - FAN_BITS)).cast("int"))
        which = F.when(hit, F.lit(i)) if which is None else which.when(hit, F.lit(i))
        sub = F.when(hit, part) if sub is None else sub.when(hit, part)
    rows = keys.select(which.alias("i"), sub.alias("sub"), "size").where("i IS NOT NULL").groupBy("i", "sub").agg(
        F.sum("size").alias("b")).collect()
    out: dict = {}
    for r in rows:
        out.setdefault(r["i"], {})[r["sub"]] = r["b"]
    return out


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """The first (k1, k2) of shards 1 to shards - 1; ``keys`` has k1, k2 and size."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [((1 << KEY_BITS), 0)] * (shards - 1)
    slack = total / shards * tolerance
    done: dict[int, tuple[int, int]] = {}
    # splitter -> [level, first key, interval start, interval bits, bytes below the interval]
    state = {s: [0, 0, 0, KEY_BITS, 0] for s in range(1, shards)}
    while state:
        for level in (0, 1):
            group = {s: v for s, v in state.items() if v[0] == level}
            if not group:
                continue
            open_ = sorted({(v[1], v[2], v[3]) for v in group.values()})
            found = _counts(keys, open_, level)
            for s, (_, first, lo, bits, below) in group.items():
                counts, target = found.get(open_.index((first, lo, bits)), {}), total * s / shards
                step = max(0, bits - FAN_BITS)
                for sub in range(1 << min(bits, FAN_BITS)):
                    n = counts.get(sub, 0)
                    if below + n >= target or sub == (1 << min(bits, FAN_BITS)) - 1:
                        break
                    below += n
                start = lo + (sub << step)
                edges = [(abs(below - target), start), (abs(below + n - target), start + (1 << step))]
                off, edge = min(edges)
                if off <= slack or level == 1 and step == 0:
                    done[s] = (edge, 0) if level == 0 else (first, edge)
                    state.pop(s)
                elif step == 0:
                    state[s] = [1, start, 0, KEY_BITS, below]
                else:
                    state[s] = [level, first, start, step, below]
    return [done[s] for s in range(1, shards)]


def sort_keys(docs: DataFrame) -> tuple[Column, Column, Column]:
    """(size, first key, second key) of a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (F.octet_length(text) + 1).cast("long"), _key(text), _key(F.col("doc_id"), F.lit(7))


def shard_of(k1: Column, k2: Column, splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below a document's keys."""
    shard = F.lit(0)
    for first, second in splitters:
        if first >= 1 << KEY_BITS:
            continue
        after = (k1 > F.lit(first)) | ((k1 == F.lit(first)) & (k2 >= F.lit(second))) if second else k1 >= F.lit(first)
        shard = shard + after.cast("int")
    return shard


def shard_documents(docs: DataFrame, shards: int = 16, tolerance: float = 0.01) -> DataFrame:
    """Return doc_id, size, text_crc32, law (``bytes``), shard, slot and grown_shard (null under this law)."""
    size, k1, k2 = sort_keys(docs)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    keys = materialize(docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), k1.alias("k1"), k2.alias("k2")), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    buckets = max(1, keys.count() // shards // ROWS_PER_BUCKET)
    placed = keys.withColumn("shard", shard_of(F.col("k1"), F.col("k2"), splitters))
    # by both keys: rows without a doc_id share the second one
    return number_in_group(placed, "shard", F.xxhash64("k1", "k2"), buckets, ["k2", "k1", "doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def cut_groups(sharded: DataFrame) -> DataFrame:
    """One row: groups of equal texts (by size and checksum) with members in more than one shard, and all groups of more than one."""
    groups = sharded.groupBy("size", "text_crc32").agg(F.count(F.lit(1)).alias("n"), F.min("shard").alias("a"), F.max("shard").alias("b"))
    return groups.agg(F.count_if(F.col("a") != F.col("b")).alias("cut"), F.count_if(F.col("n") > 1).alias("groups"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, tolerance: float = 0.01, files_per_shard: int = 1) -> None:
    """Write whole documents, one folder a shard: the rows travel once, to ``files_per_shard`` tasks a shard."""
    size, k1, k2 = sort_keys(docs)
    splitters = find_splitters(docs.select(size.alias("size"), k1.alias("k1"), k2.alias("k2")), shards, tolerance)
    placed = docs.withColumn("shard", shard_of(k1, k2, splitters))
    placed.repartition(shards * files_per_shard, "shard", F.pmod(k2, F.lit(files_per_shard))).write.partitionBy("shard").parquet(path)
