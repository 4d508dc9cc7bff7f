"""Similarity self-join of texts on word n-grams: links at a Jaccard similarity of PERCENT or more, and their components.

Rare-first prefix filtering. A text's set holds its distinct WORDS-word shingles as 64-bit
hashes. All texts put their shingles in one global order: first by the size class (power of
two) of the counter that a shingle falls into, of SLOTS counters that count the shingles of
all texts, then by hash; so common shingles come last. If two sets are alike by t, the first
n - ceil(t n) + 1 shingles of the larger and the first n - ceil(2t n / (1 + t)) + 1 of the
smaller one share a shingle. Texts with the same set are one vertex. Every vertex is joined
with the others on its prefix shingles (nodes); those that no other vertex has drop out.

A pair in a node must pass, before it leaves the node,

* the length filter: t times the larger size is at most the smaller;
* the positional filter: what stands after the two places can still reach the overlap needed;
* the suffix filter: the hash range is cut into PARTS parts; where the two sets have an even
  and an odd number of shingles in a part they differ by one at least, so sets that differ
  in more parts than the needed overlap leaves room for are no link. This holds for any
  sets, unlike a sampled sketch;
* and the shared shingle must be the pair's first: if the shingles that stand before it in
  the two prefixes (of those that are in nodes at all) are the same, the pair was looked at
  under that one.

No filter loses a link. Outside the nodes the suffix filter is applied again with as many parts as a set has shingles, and
pairs that still remain are verified once, on the whole sets.

Groups of thousands of near copies do not meet in all pairs. In a node of over STAR_ROWS
rows a few vertices (leaders) are compared with all others, and those rays are verified
first; what holds together is a group. Then each two groups verify their nearest pair, and
are one if it holds. At last every pair of different groups that passes the filters and was
not looked at yet is verified, so a link is never lost to a nearest pair that fails. Nodes of
over NODE_ROWS rows are cut into blocks, each two of which are a node of their own.

Words are those between ASCII white space, A-Z lower-cased. Edge cases: a text of fewer
words than WORDS has one shingle of all of them; null and blank texts have the empty set and
are linked with nothing; a null doc_id names no component unless its component has no
other; repeated rows are linked, as their sets are equal. Further columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.arrow_text import byte_slices, mix, text_bytes
from vigil.llm.near_copies import bounded, checked_links, shingles
from vigil.operators.graph import connected_components
from vigil.plans.materialize import discard, materialize

WORDS, PERCENT = 3, 90
#: Counters of the global order (a task's stop at 255, so that each is a byte), sent in pieces of PIECE; parts of the suffix filter in the nodes.
SLOTS, PIECE, PARTS = 1 << 22, 1 << 13, 512
NODE_ROWS, STAR_ROWS, STAR_TRIES, SMALL = 20_000, 64, 32, 64
_WORDS64 = PARTS // 64


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of n and m elements that are alike by ``percent``."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_lengths(n: int, percent: int) -> tuple[int, int]:
    """Elements of a set of n to look at against smaller sets, and against larger ones."""
    return n - -(-percent * n // 100) + 1, n - -(-2 * percent * n // (100 + percent)) + 1


def _with_sets(docs: DataFrame, words: int) -> DataFrame:
    """A row a document (row, doc_id, text, n, two hashes s1 and s2 of its set), and a row for each piece of a task's counters (part, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(SLOTS, np.uint8), ["row", "doc_id", "text", "n", "s1", "s2", "part", "counts"]
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            rows = []
            for i, j in byte_slices(off):
                sets = list(shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], words))
                slots, more = np.unique(np.concatenate(sets) & np.uint64(SLOTS - 1), return_counts=True)
                counts[slots] = np.minimum(counts[slots] + more, 255)
                rows += [(len(h), mix(h + np.uint64(1)).sum(), mix(h + np.uint64(2)).sum()) for h in sets]
            made = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (zip(*rows, strict=True) if rows else [[]] * 3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made, pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.binary())], names)
        for part in range(SLOTS // PIECE):
            piece = counts[part * PIECE : (part + 1) * PIECE]
            if piece.any():
                none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*none, pa.array([part], pa.int32()), pa.array([piece.tobytes()], pa.binary())], names)

    return docs.mapInArrow(run, "row long, doc_id long, text string, n long, s1 long, s2 long, part int, counts binary")


def shingle_classes(pieces: DataFrame, tasks: int) -> np.ndarray:
    """Size class of each of the SLOTS counters, summed over all tasks in two steps; ``pieces``: part and counts (bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, piece in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                total = sums.setdefault(part, np.zeros(PIECE, np.float64))
                raw = piece.as_buffer()
                total += np.frombuffer(raw, np.uint8 if len(raw) == PIECE else np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

    dealt = pieces.repartition(max(1, round(tasks**0.5)), "part", F.rand(1)).mapInArrow(run, "part int, counts binary")
    out = np.zeros(SLOTS, np.float64)
    for r in dealt.repartition("part").mapInArrow(run, "part int, counts binary").collect():
        out[r.part * PIECE : (r.part + 1) * PIECE] += np.frombuffer(r.counts, np.float64)
    return np.minimum(np.log2(np.maximum(out, 1)), 63).astype(np.uint8)


def _prefixes(texts: DataFrame, classes: np.ndarray, words: int, percent: int) -> DataFrame:
    """(id, n, prefix, sketch, wide): the shingles to join on, rarest first, and the parities of the suffix filter, in PARTS parts and in about n."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value.astype(np.uint64) << np.uint64(58)
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            size, tokens, sketch, wide = [], [], [], []
            for i, j in byte_slices(off):
                for h in shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], words):
                    p = prefix_lengths(len(h), percent)[0] if len(h) else 0
                    key = classes[h & np.uint64(SLOTS - 1)] | (mix(h) >> np.uint64(6))
                    first = np.partition(key, p - 1)[:p] if p else key
                    size.append(len(h))
                    tokens.append(np.sort(first).view(np.int64))
                    odd = np.bincount((h >> np.uint64(30)) & np.uint64(PARTS - 1), minlength=PARTS) & 1
                    sketch.append(np.packbits(odd.astype(bool)).tobytes())
                    parts = 64 << max(0, (len(h) - 1) // 64).bit_length()
                    odd = np.bincount((h >> np.uint64(30)) & np.uint64(parts - 1), minlength=parts) & 1
                    wide.append(np.packbits(odd.astype(bool), bitorder="little").view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size, pa.int64()), _lists(tokens), pa.array(sketch, pa.binary()), _lists(wide)], ["id", "n", "prefix", "sketch", "wide"])

    return texts.select("id", "text").mapInArrow(run, "id long, n long, prefix array<long>, sketch binary, wide array<long>").where("n > 0")


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in rows])), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *rows])))


def _with_room(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs`` (u, v and others) for which the wide parities of ``sketches`` (id, n, wide) leave room, with ``d``, in how many parts they differ."""
    for end in ("u", "v"):
        pairs = pairs.join(sketches.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("wide").alias(f"wide_{end}")), end)
    fold = lambda x, m: F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.get(x, i).bitwiseXOR(F.get(x, i + m)))
    a, b = F.col("wide_u"), F.col("wide_v")
    x = F.when(F.size(a) == 2 * F.size(b), fold(a, F.size(b))).otherwise(a)
    y = F.when(F.size(b) == 2 * F.size(a), fold(b, F.size(a))).otherwise(b)
    d = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)
    apart = F.greatest(F.size(a), F.size(b)) > 2 * F.least(F.size(a), F.size(b))  # far larger sets, where the limit is that low
    total = F.col("n_u") + F.col("n_v")
    room = total - 2 * F.ceil(percent * total / (100 + percent))
    rest = [c for c in pairs.columns if not c.startswith(("n_", "wide_"))]
    return pairs.withColumn("d", F.when(apart, 0).otherwise(d)).where(F.col("d") <= room).select(*rest, "d")


def _nodes(prefixes: DataFrame, percent: int) -> DataFrame:
    """A row for each vertex (id, n, sketch) that shares a shingle of its prefix: ``at`` lists them as (node, pos, prev)."""
    first = F.expr(f"n - CAST(ceil({2 * percent} * n / {100 + percent}) AS long) + 1")
    places = prefixes.select("id", first.alias("few"), F.posexplode("prefix").alias("pos", "node"))
    shared = places.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.max(F.col("pos") < F.col("few")).alias("any")).where("m > 1 AND any").select("node")
    kept = places.select("id", "pos", "node").join(shared, "node", "left_semi")
    lists = kept.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("s"))
    at = F.transform("s", lambda x, i: F.struct(x["node"].alias("node"), x["pos"].alias("pos"), F.get("s", i - 1)["node"].alias("prev")))
    return prefixes.select("id", "n", "sketch").join(lists.select("id", at.alias("at")), "id")


class _Part:
    """Rows of whole nodes, sorted by node, then size."""

    def __init__(self, rows: list[np.ndarray], percent: int) -> None:
        self.node, self.id, self.n, self.pos, self.prev, self.g, self.side, sketch = rows
        self.sketch, self.percent = sketch.reshape(-1, _WORDS64), percent
        self.few = self.n - -(-2 * percent * self.n // (100 + percent)) + 1

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places (i < j) and parts that differ of those pairs that pass all filters."""
        n, m = self.n[i], self.n[j]
        most = np.minimum(n - self.pos[i], m - self.pos[j])
        good = (self.pos[i] < self.few[i]) & (self.percent * m <= 100 * n) & (most >= needed(n, m, self.percent)) & (self.g[i] != self.g[j])
        good &= (self.prev[i] != self.prev[j]) | (self.prev[i] == -1)
        good &= (self.side[i] != self.side[j]) | (self.side[i] < 0)
        i, j = i[good], j[good]
        d = np.bitwise_count(self.sketch[i] ^ self.sketch[j]).sum(1, dtype=np.int64)
        good = d <= self.n[i] + self.n[j] - 2 * needed(self.n[i], self.n[j], self.percent)
        return i[good], j[good], d[good]

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.append(True, self.node[1:] != self.node[:-1]))
        return starts, np.append(starts[1:], len(self.node))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, ends = self.bounds()
        out = [(np.zeros(0, np.int64),) * 3]
        small = ends - starts <= SMALL
        last = np.repeat(np.where(small, ends, 0), ends - starts)  # end of each row's node, if small
        at = np.arange(len(self.node))
        for gap in range(1, SMALL):
            at = at[at + gap < last[at]]
            if not len(at):
                break
            out.append(self.near(at, at + gap))
        for a, b in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
            for x in range(a, b, 256):
                y = min(x + 256, b)
                stop = a + int(np.searchsorted(self.n[a:b], 100 * self.n[y - 1] // self.percent, "right"))
                for z in range(x, stop, 2048):
                    i, j = np.meshgrid(np.arange(x, y), np.arange(z, min(z + 2048, stop)), indexing="ij")
                    over = i < j
                    out.append(self.near(i[over], j[over]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def rays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a leader and what is near it, in nodes of over STAR_ROWS."""
        out = [(np.zeros(0, np.int64),) * 3]
        for a, b in zip(*self.bounds(), strict=True):
            free, misses = np.arange(a, b), 0
            if b - a <= STAR_ROWS:
                continue
            for k in free[np.argsort(mix(self.id[free].view(np.uint64)))].tolist():  # the same leaders in all nodes
                if misses >= STAR_TRIES or len(free) <= STAR_ROWS:
                    break
                if k not in free:
                    continue
                n, m = np.minimum(self.n[free], self.n[k]), np.maximum(self.n[free], self.n[k])
                d = np.bitwise_count(self.sketch[free] ^ self.sketch[k]).sum(1, dtype=np.int64)
                near = (self.percent * m <= 100 * n) & (d <= n + m - 2 * needed(n, m, self.percent)) & (free != k)
                misses = 0 if near.sum() * STAR_TRIES > len(free) else misses + 1
                out.append((np.full(near.sum(), k), free[near], d[near]))
                free = free[~near & (free != k)]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pairs_in(rows: DataFrame, percent: int, find: Callable[[_Part], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """(u, v, gu, gv), u < v, that ``find`` names in the nodes of ``rows`` (node, id, n, pos, prev, g, side, sketch)."""
    names = ["node", "id", "n", "pos", "prev", "g", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[np.ndarray]) -> pa.RecordBatch:
            part = _Part(rows, percent)
            i, j, _ = find(part)
            swap = part.id[i] > part.id[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (part.id[i], part.id[j], part.g[i], part.g[j])], ["u", "v", "gu", "gv"])

        held = None
        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            rows.append(text_bytes(batch.column("sketch"))[0].view(np.uint64).reshape(-1, _WORDS64))
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            last = np.flatnonzero(rows[0][1:] != rows[0][:-1])
            if len(last):  # all but the last node, which may go on
                yield found([x[: last[-1] + 1] for x in rows])
                rows = [x[last[-1] + 1 :] for x in rows]
            held = rows
        if held is not None and len(held[0]):
            yield found(held)

    dealt = rows.select(*names, "sketch").repartition("node").sortWithinPartitions("node", "n")
    return dealt.mapInArrow(run, "u long, v long, gu long, gv long").distinct()


def _placed(nodes: DataFrame, groups: DataFrame | None) -> DataFrame:
    """One row for each vertex and node, with the vertex's group."""
    at = F.explode("at").alias("x")
    rows = nodes.withColumn("g", F.col("id")) if groups is None else nodes.join(groups, "id", "left").withColumn("g", F.coalesce("g", "id"))
    return rows.select("id", "n", "g", "sketch", at).select("id", "n", "g", "sketch", "x.node", F.col("x.pos").cast("long").alias("pos"), F.coalesce("x.prev", F.lit(-1)).alias("prev"), F.lit(-1).alias("side"))


def _in_blocks(rows: DataFrame, large: DataFrame, each_two: bool) -> DataFrame:
    """``rows`` with the nodes of ``large`` (node, blocks) cut into blocks; ``each_two``: into a node for each two blocks."""
    small = rows.join(large.select("node"), "node", "left_anti")
    cut = rows.join(large, "node").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    if not each_two:
        return small.unionByName(cut.withColumn("node", F.xxhash64("node", "block")).drop("block", "blocks"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    lone = F.col("other") == F.col("block")
    cut = cut.withColumns({"side": F.when(lone, -1).otherwise(F.col("block")).cast("int"), "node": F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other"))})
    return small.unionByName(cut.drop("block", "blocks", "other"))


def _merged(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, g) of all vertices in a group after ``links`` (u, v)."""
    if groups is None:
        return materialize(connected_components(links.select("u", "v")).withColumnRenamed("component", "g"), "groups")
    for end in ("u", "v"):
        links = links.join(groups.withColumnRenamed("id", end), end, "left").withColumn(end, F.coalesce("g", end)).drop("g")
    joined = connected_components(links.select("u", "v"))
    first = groups.unionByName(joined.select("id", F.col("id").alias("g"))).distinct()
    return materialize(first.join(joined.withColumnRenamed("id", "g"), "g", "left").select("id", F.coalesce("component", "g").alias("g")), "groups")


def linked_groups(nodes: DataFrame, sketches: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, g) of the vertices with a link; g is the same for what links join. ``sketches``: id, n and wide; ``texts``: id and text."""
    sizes = materialize(_placed(nodes, None).groupBy("node").agg(F.count(F.lit(1)).alias("m")).where(f"m > {STAR_ROWS}"), "sizes")
    large = sizes.where(f"m > {NODE_ROWS}").select("node", F.ceil(F.col("m") / NODE_ROWS).alias("blocks"))
    cut, groups = not large.isEmpty(), None
    if not sizes.isEmpty():
        rows = _placed(nodes, None).join(sizes.select("node"), "node", "left_semi")
        rays = _pairs_in(_in_blocks(rows, large, False) if cut else rows, percent, _Part.rays)
        groups = _merged(None, checked_links(materialize(_with_room(rays.select("u", "v"), sketches, percent).select("u", "v"), "rays"), texts, words, percent))

    def candidates() -> DataFrame:
        rows = _placed(nodes, groups)
        return _with_room(_pairs_in(_in_blocks(rows, large, True) if cut else rows, percent, _Part.pairs), sketches, percent)

    between = candidates().groupBy(F.least("gu", "gv").alias("gu"), F.greatest("gu", "gv").alias("gv")).agg(F.min(F.struct("d", "u", "v")).alias("p"), F.count(F.lit(1)).alias("m"))
    nearest = materialize(between.select("p.u", "p.v", "m"), "nearest")
    groups = _merged(groups, checked_links(nearest.select("u", "v"), texts, words, percent))
    if not nearest.where("m > 1").isEmpty():
        rest = materialize(candidates().select("u", "v").join(nearest.select("u", "v"), ["u", "v"], "left_anti"), "rest")
        groups = _merged(groups, checked_links(rest, texts, words, percent))
    discard(sizes)
    return groups


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = materialize(_with_sets(rows, words), "sets")
    rows = made.where("part IS NULL")
    vertices = rows.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("row").alias("id"), F.min("doc_id").alias("least"))
    vertices = materialize(vertices, "vertices")
    pieces = made.where("part IS NOT NULL").select("part", "counts")
    classes = shingle_classes(pieces, pieces.count() // (SLOTS // PIECE))
    copies = bounded(rows.where("n > 0").select("row").join(vertices.select(F.col("id").alias("row")), "row", "left_anti"))
    texts = rows.where("n > 0").join(copies, "row", "left_anti").select(F.col("row").alias("id"), "text")
    prefixes = materialize(_prefixes(texts, classes, words, percent), "prefixes")
    nodes = materialize(_nodes(prefixes, percent), "nodes")
    groups = linked_groups(nodes, prefixes.select("id", "n", "wide"), texts, words, percent)
    discard(nodes)
    discard(prefixes)
    named = vertices.join(groups, "id", "left").withColumn("g", F.coalesce("g", "id"))
    least = named.groupBy("g").agg(F.min("least").alias("component_id"))
    named = named.join(least, "g").select("s1", "s2", "n", "component_id")
    kind = docs.schema[doc_id].dataType
    found = rows.where("n > 0").select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2", "n"])
    found = found.select("doc_id", "n", "component_id").unionByName(rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return found.select(F.col("doc_id").cast(kind).alias(doc_id), F.col("n").alias("n_shingles"), F.col("component_id").cast(kind).alias("component_id"))
