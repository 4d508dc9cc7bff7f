"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint bit is the majority over XXH64 values of the text's 3-word shingles. The
index is built over the distinct fingerprints. Its upper nodes are masked bit patterns:
two fingerprints that differ in at most two bits agree on at least one third of the
bits, so each fingerprint hangs below the three patterns that it shows there, and links
lie within a node. A node with more than NODE_ROWS fingerprints is divided again by the
thirds of its free bits (twice at most; below that a node can hold 2 ** 19). Inside a
node fingerprints are sorted by Gray rank and halved down to single ones; every range
keeps the bits that all its members share. Pairs of ranges are descended together: the
shared bits in which they differ add up on the way down, and beyond two the whole pair
of ranges is pruned.

Components come from star contractions over the links, written to the shared folder
round by round. Nothing of the corpus reaches the driver.

Edge cases: a null or blank text has the fingerprint 0 and links like any other; equal
fingerprints are one vertex, however many rows have them; repeated rows get one result
each; null ids don't lend their name to a component; columns besides doc_id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.graph import connected_components
from vigil.plans.materialize import materialize

SEED, SHINGLE, BITS, DISTANCE = 42, 3, 64, 2
NODE_ROWS = 20_000
_ONE = np.uint64(1)


def simhash(words: list[bytes], hasher) -> int:
    """Majority bits of the shingles' hashes."""
    if not words:
        return 0
    n = len(words)
    line = b" ".join(words)
    if n <= SHINGLE:
        return hasher(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, n) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)[: n - SHINGLE]])
    ends = np.cumsum(sizes)[SHINGLE - 1 :] - 1
    hashes = np.array([hasher(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and fp, the 64 bits as a signed long."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            fp = [simhash((t or "").encode().lower().split(), xxh64_intdigest) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.array(fp, np.uint64).view(np.int64))], [*keep, "fp"])

    return docs.select(*keep, *(["text"] if "text" not in keep else [])).mapInArrow(run, f"{schema}, fp long")


def _thirds(bits: list[int]) -> list[list[int]]:
    n = len(bits)
    cut = [0, -(-n // 3), -(-2 * n // 3), n]
    return [bits[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _nodes(parents: list[list[int]]) -> list[list[int]]:
    """Masks (as bit lists) one level down: each parent's bits with a third of its free bits."""
    return [p + third for p in parents for third in _thirds([b for b in range(BITS) if b not in set(p)])]


def _hang(df: DataFrame, masks: list[list[int]], of_parent: bool) -> DataFrame:
    """A row (node, pattern, fp) for each mask, or for the three masks below the row's own node."""
    table = [(i, m) for i, m in enumerate(map(_mask, masks))]
    if not of_parent:
        below = F.array(*[F.struct(F.lit(i).alias("node"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern")) for i, m in table])
        return df.select("fp", F.inline(below)).select("node", "pattern", "fp")
    cases: Column | None = None
    for parent in range(len(masks) // 3):
        below = F.array(*[F.struct(F.lit(i).alias("node"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern")) for i, m in table[3 * parent : 3 * parent + 3]])
        cases = F.when(F.col("node") == parent, below) if cases is None else cases.when(F.col("node") == parent, below)
    return df.select("fp", cases.alias("below")).select("fp", F.inline("below")).select("node", "pattern", "fp")


def _gray_rank() -> Column:
    r = F.col("fp")
    for k in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, k))
    return r


def range_links(fp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a < b) within DISTANCE. fp: nodes one after another, in Gray order; starts: where each node begins."""
    lo, hi = starts.astype(np.int64), np.append(starts[1:], len(fp)).astype(np.int64)
    levels = []
    while True:  # ranges level by level: bits that all have, bits that none has, first child
        levels.append((np.bitwise_and.reduceat(fp, lo), ~np.bitwise_or.reduceat(fp, lo), hi - lo > 1, lo))
        many = hi - lo > 1
        if not many.any():
            break
        mid = (lo + hi) // 2
        child = np.cumsum(1 + many) - (1 + many)
        levels[-1] += (child,)
        nlo, nhi = np.empty(len(lo) + many.sum(), np.int64), np.empty(len(lo) + many.sum(), np.int64)
        nlo[child], nhi[child] = lo, np.where(many, mid, hi)
        nlo[child[many] + 1], nhi[child[many] + 1] = mid[many], hi[many]
        lo, hi = nlo, nhi
    found: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(0, np.arange(len(starts)), np.arange(len(starts)))]
    while stack:
        depth, a, b = stack.pop()
        if len(a) > 1 << 18:  # deep first, so that open pairs stay few
            half = len(a) // 2
            stack += [(depth, a[half:], b[half:]), (depth, a[:half], b[:half])]
            continue
        has, lacks, many, first, *rest = levels[depth]
        differ = (has[a] & lacks[b]) | (lacks[a] & has[b])
        near = (np.bitwise_count(differ) <= DISTANCE) & ((a != b) | many[a])
        a, b = a[near], b[near]
        if not len(a):
            continue
        if not rest:
            found.append((first[a], first[b]))
            continue
        child = rest[0]
        ca, cb, ma, mb = child[a], child[b], many[a], many[b]
        same = a == b
        nxt = [(ca, cb)]
        if (ma & mb).any():
            nxt.append((ca[ma & mb] + 1, cb[ma & mb] + 1))
        nxt.append((ca[mb], cb[mb] + 1))
        left = ma & ~same
        nxt.append((ca[left] + 1, cb[left]))
        stack.append((depth + 1, np.concatenate([x for x, _ in nxt]), np.concatenate([y for _, y in nxt])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _links_in(rows: DataFrame) -> DataFrame:
    """(u, v) of the fingerprints within DISTANCE in each (node, pattern)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(node: np.ndarray, pattern: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1])]))
            a, b = range_links(fp.view(np.uint64), new)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(fp[a], fp[b])), pa.array(np.maximum(fp[a], fp[b]))], ["u", "v"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "pattern", "fp")]
            part = part if held is None else [np.concatenate(x) for x in zip(held, part, strict=True)]
            last = np.flatnonzero((part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1]))
            if len(last):  # all but the last node, which may go on
                yield links(*(x[: last[-1] + 1] for x in part))
                part = [x[last[-1] + 1 :] for x in part]
            held = part
        if held is not None and len(held[0]):
            yield links(*held)

    dealt = rows.repartition("node", "pattern").withColumn("gray", _gray_rank()).sortWithinPartitions("node", "pattern", "gray")
    return dealt.select("node", "pattern", "fp").mapInArrow(run, "u long, v long")


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (u < v) between fingerprints of ``distinct`` (fp) at DISTANCE or fewer differing bits."""
    masks = _nodes([[]])
    rows, links = _hang(distinct, masks, False), None
    for level in range(3):
        sizes = rows.groupBy("node", "pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        large = level < 2 and (sizes.agg(F.max("n")).first()[0] or 0) > NODE_ROWS
        fit = rows.join(sizes.where(F.col("n") <= NODE_ROWS) if large else sizes, ["node", "pattern"], "left_semi")
        links = _links_in(fit) if links is None else links.unionByName(_links_in(fit))
        if not large:
            break
        masks = _nodes(masks)
        rows = materialize(_hang(rows.join(sizes.where(F.col("n") > NODE_ROWS), ["node", "pattern"], "left_semi"), masks, True), "nodes")
    return links


def _components(vertices: DataFrame) -> DataFrame:
    """``vertices`` (one row a fp) with the component of each."""
    members = connected_components(near_links(vertices.select("fp")))
    return vertices.join(members.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component: the smallest doc_id (null last), then the smallest hash of the text, then the first of rows that are alike.

    Rows are told apart by a number that is written with them, so a doc_id that is null or repeated stands for no other row.
    """
    numbered = docs.withColumns({"_row": F.monotonically_increasing_id(), "_text": F.xxhash64("text")})
    rows = materialize(fingerprints(numbered, tuple(numbered.columns)), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text", "_row")
    named = _components(rows.groupBy("fp").agg(F.min(order).alias("least")))
    kept = named.groupBy("component").agg(F.min("least").alias("least")).select("least._row")
    return rows.join(kept, "_row", "left_semi").select(docs.columns)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Return doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``."""
    prints = materialize(fingerprints(docs), "fingerprints")
    named = _components(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
