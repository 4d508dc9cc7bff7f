"""Merkle manifest of a table, one tree a group and one over the groups, without sorting the rows.

Bitmap-rank indexing gives every leaf its place. The ids of a group are the set bits of a
compressed bitmap: 64-bit words, of which only those with a bit are kept, merged by OR
before and after the shuffle. A popcount directory over them holds how many ids stand before
each word; it is built level by level, STEP bits of the id at a time, so that no window
looks at more than 2 ** STEP rows. A leaf's place is its word's count and the popcount of
the lower bits in the word: one equi-join and no sort of rows.

Places key the slot arrays: BITS levels of a tree at a time, the nodes of a block of
2 ** BITS places meet in one row, are put into an array by their place and reduced to the
block's digest, and the blocks are the nodes of the next round. On the way back each block
hands its proof down to its members, so a leaf gets the siblings of all levels.

H is the lowercase hex SHA-256 of its inputs concatenated, digests as hex text. A leaf is H
of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. In a group
leaves ascend by id; every 2 consecutive nodes (the last run may be one) become their H until
one remains, and the groups' roots (null group first, then by UTF-8 bytes) likewise.

Edge cases: rows with a null id stand first in their group; rows with the same id stand by
their leaf digest, and equal rows are interchangeable, each a leaf of its own. Places of
such rows come from counts over at most 4,096 ranges of digests, equal rows being one row
with a count until the end, so an id may hold any share of all rows. An empty table has an
empty manifest. Columns that are not fields play no part. Ids are integers. The groups (one
row each) are numbered in one task; rows never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.plans.materialize import discard, materialize

#: Levels that a block of nodes is reduced by at once; bits of the id that a directory level covers.
BITS, STEP = 8, 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Words are numbered from 1, that of the least integer; null ids have word 0.
_FIRST_WORD = (1 << 57) + 1
#: A level of a proof: its side and the sibling's 32 bytes.
NONE, LEFT, RIGHT, ENTRY = 0, 1, 2, 33


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, in hex."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def _before(*group: Column | str) -> Window:
    return Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(n: str, over: Window) -> Column:
    return F.coalesce(F.sum(n).over(over), F.lit(0))


def popcount_directory(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For words (g, word, bits, n): the same with ``base``, the rows of the group before the word; and the rows of each group (g, n)."""
    level, bases = words.select("g", F.col("word").alias("k"), "n"), []
    while True:
        over = _before("g", F.shiftright("k", STEP)).orderBy("k")
        bases.append(level.select("g", "k", _sum_before("n", over).alias("base")))
        level = materialize(level.groupBy("g", F.shiftright("k", STEP).alias("k")).agg(F.sum("n").alias("n")), "directory")
        if level.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").isEmpty():
            break
    above = bases.pop()
    while bases:
        above = above.select("g", F.col("k").alias("up"), F.col("base").alias("up_base"))
        lower = bases.pop().withColumn("up", F.shiftright("k", STEP)).join(above, ["g", "up"])
        above = lower.select("g", "k", (F.col("base") + F.col("up_base")).alias("base"))
    return words.join(above.withColumnRenamed("k", "word"), ["g", "word"]), level.select("g", "n")


def _tied_places(rows: DataFrame) -> DataFrame:
    """``place`` for the rows of words in which an id stands twice or more."""
    same = rows.groupBy("g", "word", "base", "key", F.coalesce("key", F.lit(0)).alias("id"), "leaf", "claimed").agg(F.count(F.lit(1)).alias("c"))
    same = materialize(same.withColumn("range", F.substring(F.hex("leaf"), 1, 3)), "tied")
    ids = same.groupBy("g", "word", "id").agg(F.sum("c").alias("n"))
    ids = ids.select("g", "word", "id", _sum_before("n", _before("g", "word").orderBy("id")).alias("of_id"))
    ranges = same.groupBy("g", "word", "id", "range").agg(F.sum("c").alias("n"))
    ranges = ranges.select("g", "word", "id", "range", _sum_before("n", _before("g", "word", "id").orderBy("range")).alias("of_range"))
    of_leaf = _sum_before("c", _before("g", "word", "id", "range").orderBy("leaf"))
    first = same.withColumn("of_leaf", of_leaf).join(ids, ["g", "word", "id"]).join(ranges, ["g", "word", "id", "range"])
    first = first.select("g", "key", "leaf", "claimed", "c", (F.col("base") + F.col("of_id") + F.col("of_range") + F.col("of_leaf")).alias("place"))
    # equal rows part again in two steps, so that no task holds an array of all of them
    some = first.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(4096).cast("long"))).alias("at")).repartition("g", "place", "at")
    rest = F.sequence(F.col("at"), F.least(F.col("at") + 4095, F.col("c") - 1))
    return some.select("g", "key", "leaf", "claimed", "place", F.explode(rest).alias("more")).withColumn("place", F.col("place") + F.col("more")).drop("more")


def leaf_places(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (g, key, leaf, claimed) with ``place`` in their group, and the size of each group (g, n)."""
    bit = "CAST(coalesce(key & 63L, 0L) AS int)"
    keyed = leaves.withColumns({"word": F.coalesce(F.shiftright("key", 6) + _FIRST_WORD, F.lit(0)), "bit": F.expr(bit)})
    bitmap = F.bit_or(F.expr("shiftleft(1L, bit)"))
    words = materialize(keyed.groupBy("g", "word").agg(bitmap.alias("bits"), F.count(F.lit(1)).alias("n")), "words")
    indexed, sizes = popcount_directory(words)
    ranked = keyed.join(materialize(indexed, "index"), ["g", "word"])
    place = F.col("base") + F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    columns = ["g", "key", "leaf", "claimed"]
    placed = ranked.where("n = bit_count(bits)").select(*columns, place.alias("place"))
    if not words.where("n > bit_count(bits)").isEmpty():
        placed = placed.unionByName(_tied_places(ranked.where("n > bit_count(bits)")))
    return placed, sizes


def _slot_levels(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of each level from ``digests`` up."""
    out = [digests]
    for _ in range(levels):
        text = [d.hex() for d in out[-1]]
        out.append([hashlib.sha256("".join(text[i : i + 2]).encode()).digest() for i in range(0, len(text), 2)])
    return out


def _levels_left(n: int, done: int) -> int:
    return max(0, min(BITS, (n - 1).bit_length() - BITS * done))


def _kids(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], pa.StructArray]]:
    """(row, digests by place, members by place) of every block."""
    kids = batch.column("kids")
    for row in range(len(kids)):
        members = kids[row].values
        order = pc.array_sort_indices(members.field("place"))
        members = members.take(order)
        yield row, members.field("digest").to_pylist(), members


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """Nodes (g, place, digest, n) by blocks of 2 ** BITS places: (g, place, n, kids)."""
    kid = F.struct((F.col("place").bitwiseAND((1 << BITS) - 1)).cast("int").alias("place"), "digest", *carried)
    block = F.shiftright("place", BITS).alias("place")
    return nodes.groupBy("g", block).agg(F.first("n").alias("n"), F.collect_list(kid).alias("kids"))


def _reduced(blocks: DataFrame, done: int) -> DataFrame:
    """The node that each block becomes; ``done`` rounds came before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_pylist()
            tops = [_slot_levels(digests, _levels_left(n[row], done))[-1][0] for row, digests, _ in _kids(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("place"), pa.array(tops, pa.binary()), batch.column("n")], ["g", "place", "digest", "n"])

    return blocks.mapInArrow(run, "g string, place long, digest binary, n long")


def _handed_down(blocks: DataFrame, proofs: DataFrame, done: int, carried: str) -> DataFrame:
    """The proof of every member of the blocks: its siblings in the block, then the block's ``proof``. ``carried``: further fields of members, as a schema."""
    names = [c.split()[0] for c in carried.split(", ") if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, above, first = batch.column("n").to_pylist(), batch.column("proof").to_pylist(), batch.column("place").to_pylist()
            for row, digests, members in _kids(batch):
                levels = _slot_levels(digests, _levels_left(n[row], done))[:-1]
                proofs = []
                for i in range(len(digests)):
                    proof = []
                    for k, nodes in enumerate(levels):
                        j = (i >> k) ^ 1
                        proof.append(bytes([LEFT if j < i >> k else RIGHT]) + nodes[j] if j < len(nodes) else bytes(ENTRY))
                    proofs.append(b"".join(proof) + above[row])
                place = pa.array([(first[row] << BITS) + i for i in range(len(digests))], pa.int64())
                g = pa.array([batch.column("g")[row].as_py()] * len(digests), pa.string())
                yield pa.RecordBatch.from_arrays([g, place, pa.array(proofs, pa.binary()), *(members.field(c) for c in names)], ["g", "place", "proof", *names])

    schema = "g string, place long, proof binary" + (f", {carried}" if carried else "")
    return blocks.join(proofs, ["g", "place"]).mapInArrow(run, schema)


def _tree(nodes: DataFrame, most: int, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round over ``nodes``, and the root of each group; ``most``: size of the largest group."""
    rounds, done = [], 0
    while done == 0 or (most - 1) >> BITS * done:
        rounds.append(materialize(_blocks(nodes, *(carried if done == 0 else ())), "slots"))
        nodes = _reduced(rounds[-1], done)
        done += 1
    return rounds, nodes


def _proofs(rounds: list[DataFrame], top: DataFrame, carried: str) -> DataFrame:
    """Proofs (g, place, proof and the carried fields) of the first round's members; ``top``: those of the groups' roots."""
    proofs, written = top, None
    for done in range(len(rounds) - 1, 0, -1):
        proofs = materialize(_handed_down(rounds[done], proofs, done, ""), "proofs")
        for old in (written, rounds[done]):
            if old is not None:
                discard(old)
        written = proofs
    return _handed_down(rounds[0], proofs, 0, carried)


def folded(leaf: Column, proof: Column) -> Column:
    """The root, in hex, that a leaf (hex) and its proof lead to."""
    at = lambda i: F.substring(proof, ENTRY * i + 2, F.lit(32))
    side = lambda i: F.hex(F.substring(proof, ENTRY * i + 1, F.lit(1)))

    def step(h: Column, i: Column) -> Column:
        other = F.lower(F.hex(at(i)))
        return F.sha2(F.when(side(i) == "01", F.concat(other, h)).when(side(i) == "02", F.concat(h, other)).otherwise(h), 256)

    return F.aggregate(proof_levels(proof), leaf, step)


def proof_levels(proof: Column) -> Column:
    """0, 1, ... for the levels of a proof."""
    levels = F.floor(F.octet_length(proof) / ENTRY).cast("int")
    return F.when(levels > 0, F.sequence(F.lit(0), levels - 1)).otherwise(F.array().cast("array<int>"))


def siblings(proof: Column) -> Column:
    """The siblings in a proof, as hex digests from the leaf to the root."""
    hexes = F.transform(proof_levels(proof), lambda i: F.substring(F.lower(F.hex(proof)), 2 * ENTRY * i + 1, F.lit(2 * ENTRY)))
    return F.transform(F.filter(hexes, lambda x: ~x.startswith("00")), lambda x: F.substring(x, 3, 64))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang", claims: dict[str, Column] | None = None, claimed_by: Column | None = None) -> DataFrame:
    """(key, group, place, leaf, subroot, root, proof, claimed) for every row; digests in hex.

    ``claimed`` is the leaf that somebody shows for the row: where ``claimed_by`` holds, that of the row with the columns
    ``claims`` in place of its own; else the true one. ``folded(claimed, proof)`` equals ``root`` if and only if the leaf is true.
    """
    claims, wrong = claims or {}, F.lit(False) if claimed_by is None else F.coalesce(claimed_by, F.lit(False))
    leaf = leaf_digest([F.col(c) for c in fields])
    other = F.when(wrong, F.unhex(leaf_digest([claims.get(c, F.col(c)) for c in fields])))
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = materialize(docs.select(g.alias("g"), F.col(key).cast("long").alias("key"), F.unhex(leaf).alias("leaf"), other.alias("claimed")), "leaves")
    placed, sizes = leaf_places(leaves)
    sizes = materialize(sizes, "sizes")
    most, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    nodes = placed.join(F.broadcast(sizes) if groups < 100_000 else sizes, "g").withColumnRenamed("leaf", "digest")
    rounds, roots = _tree(nodes, most or 1, "key", "claimed")
    discard(leaves)
    order = Window.orderBy("g")
    subroots = materialize(roots.select(F.lit("").alias("g"), (F.row_number().over(order) - 1).cast("long").alias("place"), "digest",
                                        F.lit(groups).cast("long").alias("n"), F.col("g").alias("name"), F.col("digest").alias("subroot")), "subroots")
    top_rounds, root = _tree(subroots, max(groups, 1), "name", "subroot")
    empty = F.lit(b"").alias("proof")
    tops = _proofs(top_rounds, root.select("g", "place", empty), "name string, subroot binary")
    tops = materialize(tops.crossJoin(F.broadcast(root.select(F.col("digest").alias("root")))).select(F.col("name").alias("g"), "proof", "subroot", "root"), "tops")
    proofs = _proofs(rounds, tops.select("g", F.lit(0).cast("long").alias("place"), "proof"), "digest binary, key long, claimed binary")
    low = lambda c: F.lower(F.hex(c))
    return proofs.join(F.broadcast(tops.drop("proof")) if groups < 100_000 else tops.drop("proof"), "g").select(
        F.col("key").cast(docs.schema[key].dataType).alias(key), F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias(group), "place",
        low("digest").alias("leaf"), low("subroot").alias("subroot"), low("root").alias("root"), "proof", low(F.coalesce("claimed", "digest")).alias("claimed"))
