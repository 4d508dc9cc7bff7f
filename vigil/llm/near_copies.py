"""Near copies by SimHash: texts whose sets of WORDS-word shingles have a Jaccard similarity of SIMILARITY or more.

The operator of ``simhash``, for similarities instead of a few bits. A fingerprint has 128
bits, the majority over the hashes of a text's distinct shingles; two texts of similarity
0.8 differ in about 15 % of them. Texts with the same set of shingles are one vertex.

The index is built over the vertices. Its upper nodes are masked bit patterns: MASKS masks
of MASK_BITS bits, and each fingerprint hangs below the pattern that it shows under each. A
node of more than NODE_ROWS prints is divided again by SUB_MASKS masks of SUB_BITS further
bits, so no task gets a group of unbounded size. Inside a node prints are sorted by size
class and Gray rank and halved into ranges; every range keeps the bits that all its members
share and its least and largest size. Pairs of ranges are descended together and pruned as
a whole when their sizes are too different, when the shared bits in which they differ pass
DISTANCE, or when both lie in one group.

Groups keep thousands of near copies from meeting in all pairs. In a first pass over
STAR_MASKS of the masks, a print in a node of over STAR_ROWS takes in all that are within
STRONG bits of it (about the distance at a similarity of 0.8); these rays are checked, and the components of those that hold are the
groups. In the second pass, over all masks, every pair of prints of different groups is
looked at, and a node names the NEAREST pairs for each two groups (most groups are one
print). Before a pair leaves a node, the parities of the two sets must leave room for the
similarity: a bit for each part of the hash range says whether a set has an odd number of
shingles in it, and two sets differ by one at least where their bits do. Every pair named, rays included, is checked by the exact Jaccard similarity of the
two sets, so nothing is linked that should not be. A link can be missed if the two prints
differ in more than DISTANCE bits or share no mask's pattern; by the binomial law that is
4 % of the pairs at a similarity of exactly 0.8, 1 % at 0.85 and under 0.1 % at 0.9, and
0.1 % more where parities of a sample decide (sets of over SAMPLED shingles). None is missed
for the NEAREST pairs: where a node named as many and the groups are still apart after the
check, a third pass names every pair of theirs that is left.

Words are those between ASCII white space, A-Z lower-cased. Edge cases: a text of fewer than
WORDS words has one shingle of all of them; null and blank texts have the empty set and are
copies of each other; a null or repeated doc_id stands for no other row; columns besides
doc_id and text are carried along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.arrow_text import byte_slices, frugal, mix, text_bytes
from vigil.llm.names import free_names
from vigil.operators.graph import connected_components
from vigil.plans.materialize import discard, materialize

WORDS, SIMILARITY = 5, 0.8
BITS, DISTANCE, STRONG = 128, 28, 20
MASKS, MASK_BITS, SUB_MASKS, SUB_BITS, DEPTH = 24, 12, 12, 8, 3
NODE_ROWS, STAR_MASKS, STAR_ROWS, STAR_TRIES, LEAF, NEAREST = 20_000, 8, 64, 32, 16, 3
#: Words of 64 bits that hold the parities of a set; sets of more than SAMPLED shingles give a share of 1 / 2, 1 / 4, ... of them.
PARITY_WORDS, SAMPLED = 4, 256
PARITIES = tuple(f"p{k}" for k in range(PARITY_WORDS))
#: Bytes of a text that are hashed at once.
PIECE = 4 << 20
#: A list of at most so many row numbers (8 bytes each, some 100 MB as a hash table) is broadcast, so that texts stay where they are; beyond, the join shuffles.
BROADCAST_IDS = 4_000_000
#: Pairs of one text that a task checks; a text with more is dealt over several.
PAIRS_PER_TASK = 500

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_VALUE = mix(_FOLD.astype(np.uint64) + np.uint64(1))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = mix(np.arange(101, 117, dtype=np.uint64)) | np.uint64(1)
#: Ones in each bit of a byte.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the word that begins at each of ``starts``; worked in pieces of PIECE bytes, as it takes many bytes for each."""
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
        piece = data[starts[i] : starts[j] if j < len(starts) else len(data)]
        at = starts[i:j] - starts[i]
        value = np.where(_SPACE[piece], np.uint64(0), _VALUE[piece] * _powers(_BASE, len(piece)))
        out.append(mix(np.add.reduceat(value, at) * _powers(_INVERSE, len(piece))[at]))
        i = j
    return np.concatenate(out)


def shingles(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The distinct hashes, ascending, of the shingles of ``words`` words (at most 16) of every text in ``data``."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = off[:-1][off[:-1] < off[1:]]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    word = word_hashes(data, starts)
    at = np.searchsorted(starts, off)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        w = word[a:b]
        if len(w) <= words:
            yield mix((w * _PLACES[: len(w)]).sum(keepdims=True) + np.uint64(len(w))) if len(w) else w
            continue
        n = len(w) - words + 1
        yield np.unique(mix(sum(w[k : k + n] * _PLACES[k] for k in range(words)) + np.uint64(words)))


def majority(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of distinct shingle hashes, as two 64-bit words."""
    if not len(hashes):
        return np.zeros(2, np.uint64)
    raw = np.stack([hashes, mix(hashes ^ np.uint64(0x5851F42D4C957F2D))], 1).view(np.uint8).reshape(len(hashes), 16)
    if len(raw) < 100:
        ones = np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        ones = (np.bincount((raw + np.arange(0, 4096, 256)).ravel(), minlength=4096).reshape(16, 256) @ _BYTE_BITS).ravel()
    return np.packbits(2 * ones > len(raw), bitorder="little").view(np.uint64)


def _level(size: np.ndarray) -> np.ndarray:
    """How often a set of ``size`` shingles is halved for its parities."""
    return np.ceil(np.log2(np.maximum(size, 1) / SAMPLED)).clip(0).astype(np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each part of the hash range whether the set has an odd number of shingles in it, as PARITY_WORDS words."""
    hashes = mix(hashes ^ np.uint64(0x2545F4914F6CDD1D))
    hashes = hashes[hashes & np.uint64((1 << int(_level(np.array(len(hashes))))) - 1) == 0]
    odd = np.bincount((hashes >> np.uint64(40)) & np.uint64(64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def _can_link(fp: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the parities of pairs (columns from the third on) leave room for the SIMILARITY.

    Two sets differ by one shingle at least in each part where one has an even and the other an odd number. That is exact for sets
    of up to SAMPLED shingles; samples of larger ones may exceed their mean by three standard deviations. Sets halved unequally often pass.
    """
    n, m = size[i], size[j]
    most = (n + m) * (1 - SIMILARITY) / (1 + SIMILARITY)
    level = _level(n)
    mean = most / 2.0**level
    limit = np.where(level == 0, most, mean + 3 * np.sqrt(mean) + 1)
    return (level != _level(m)) | (_bit_count(fp[i, 2:] ^ fp[j, 2:]) <= limit)


def _signed(rows: list, dtype=np.uint64) -> pa.Array:
    return pa.array(np.array(rows, dtype).view(np.int64))


def with_fingerprints(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` and, under ``names``: fingerprint words a and b, number of shingles, two hashes of their set and, if named too, its PARITIES."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", " + ", ".join(f"`{n}` long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            rows = []
            for i, j in byte_slices(off):
                for h in shingles(data[off[i] : off[j]], off[i : j + 1] - off[i]):
                    a, b = majority(h)
                    more = parities(h) if len(names) > 5 else ()
                    rows.append((a, b, len(h), mix(h + np.uint64(1)).sum(), mix(h + np.uint64(2)).sum(), *more))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(_signed, columns)], [*batch.schema.names, *names])

    return docs.mapInArrow(frugal(run), schema)


def _masks() -> tuple[list[list[int]], list[list[int]]]:
    """Bit numbers of the upper masks, and of those that divide a large node; fixed by a seed."""
    rng = np.random.default_rng(20)
    draw = lambda k, n: [sorted(rng.permutation(BITS)[:n].tolist()) for _ in range(k)]
    return draw(MASKS, MASK_BITS), draw(SUB_MASKS * DEPTH, SUB_BITS)


def _under(bits: list[int], salt: int, *more: Column) -> Column:
    """Hash of a print's pattern under the mask of ``bits``."""
    def word(k: int) -> int:
        m = sum(1 << (b - 64 * k) for b in bits if b // 64 == k)
        return m - (1 << 64) if m >> 63 else m

    return F.xxhash64(F.lit(salt), F.col("a").bitwiseAND(F.lit(word(0))), F.col("b").bitwiseAND(F.lit(word(1))), *more)


def _gray_rank(word: str) -> Column:
    r = F.col(word)
    for k in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, k))
    return r


def _bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(-1, dtype=np.int64)


def _alike(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sets of n and m elements can be SIMILARITY alike."""
    return (n >= SIMILARITY * m) & (m >= SIMILARITY * n)


def stars(fp: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Leader of each print of a node (its own place where it has none)."""
    leader, free = np.arange(len(fp)), np.arange(len(fp))
    order = np.random.default_rng(len(fp)).permutation(len(fp))
    misses = 0
    taken = np.zeros(len(fp), bool)
    for k in order.tolist():
        if misses >= STAR_TRIES or len(free) <= STAR_ROWS:
            break
        if taken[k]:
            continue
        near = free[(_bit_count(fp[free, :2] ^ fp[k, :2]) <= STRONG) & _alike(size[free], size[k])]
        near = near[_can_link(fp, size, near, np.full(len(near), k))]
        misses = 0 if len(near) * STAR_TRIES > len(free) else misses + 1
        if len(near) > 1:
            leader[near] = k
            taken[near] = True
            free = free[~taken[free]]
    return leader


def range_pairs(fp: np.ndarray, size: np.ndarray, group: np.ndarray, starts: np.ndarray, named: int | None = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (i, j) of the ``named`` nearest pairs of prints of each two groups of a node, if within DISTANCE bits and of like size, and whether there may be more of theirs.

    Where ``named`` is None all such pairs, a block of ranges at a time. fp: (prints, 2) words and, behind them, any parities, nodes one after another; starts: where each node begins. Groups have numbers that no other node uses.
    """
    lo, hi = starts.astype(np.int64), np.append(starts[1:], len(fp)).astype(np.int64)
    levels = []
    while True:  # ranges level by level: shared ones, shared zeros, sizes, the group if there is but one, first child
        least, most = np.minimum.reduceat(group, lo), np.maximum.reduceat(group, lo)
        level = [np.bitwise_and.reduceat(fp[:, :2], lo), ~np.bitwise_or.reduceat(fp[:, :2], lo), np.minimum.reduceat(size, lo), np.maximum.reduceat(size, lo), np.where(least == most, least, -1), lo, hi]
        levels.append(level)
        many = hi - lo > LEAF
        if not many.any():
            break
        mid = (lo + hi) // 2
        child = np.cumsum(1 + many) - (1 + many)
        level += [many, child]
        nlo, nhi = np.empty(len(lo) + many.sum(), np.int64), np.empty(len(lo) + many.sum(), np.int64)
        nlo[child], nhi[child] = lo, np.where(many, mid, hi)
        nlo[child[many] + 1], nhi[child[many] + 1] = mid[many], hi[many]
        lo, hi = nlo, nhi
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]

    def compare(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """All pairs of prints of the small ranges ``a`` and ``b``."""
        _, _, _, _, _, lo, hi = levels[-1]
        step = np.arange(LEAF)
        for k in range(0, len(a), 2048):
            p, q = a[k : k + 2048], b[k : k + 2048]
            i, j = lo[p][:, None, None] + step[:, None], lo[q][:, None, None] + step
            pair = (i < hi[p][:, None, None]) & (j < hi[q][:, None, None]) & ((p != q)[:, None, None] | (i < j))
            i, j = np.broadcast_to(i, pair.shape)[pair], np.broadcast_to(j, pair.shape)[pair]
            near = (group[i] != group[j]) & _alike(size[i], size[j])
            i, j = i[near], j[near]
            d = _bit_count(fp[i, :2] ^ fp[j, :2])
            near = d <= DISTANCE
            near[near] = _can_link(fp, size, i[near], j[near])
            i, j = i[near], j[near]
            if named is None:
                yield i, j, np.zeros(len(i), bool)
            else:
                out.append(nearest(i, j, _bit_count(fp[i] ^ fp[j]))[:3])

    def nearest(i: np.ndarray, j: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
        """The pairs of least distance for each two groups, and whether those have as many as are named."""
        g, h = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
        order = np.lexsort([j, i, d, h, g])
        i, j, d, g, h = (x[order] for x in (i, j, d, g, h))
        apart = lambda k: np.concatenate([np.ones(min(k, len(g)), bool), (g[k:] != g[:-k]) | (h[k:] != h[:-k])])
        new, many = apart(named), np.diff(np.append(np.flatnonzero(apart(1)), len(g)))
        return i[new], j[new], d[new], np.repeat(many >= named, many)[new]

    stack = [(0, np.arange(len(starts)), np.arange(len(starts)))]
    while stack:
        depth, a, b = stack.pop()
        if len(a) > 1 << 16:  # deep first, so that open pairs stay few
            half = len(a) // 2
            stack += [(depth, a[half:], b[half:]), (depth, a[:half], b[:half])]
            continue
        has, lacks, least, most, one, _, _, *rest = levels[depth]
        near = (most[b] >= SIMILARITY * least[a]) & (most[a] >= SIMILARITY * least[b]) & ((one[a] != one[b]) | (one[a] < 0))
        near[near] = _bit_count((has[a[near]] & lacks[b[near]]) | (lacks[a[near]] & has[b[near]])) <= DISTANCE
        a, b = a[near], b[near]
        if not len(a):
            continue
        if not rest:
            yield from compare(a, b)
            continue
        many, child = rest
        ca, cb, ma, mb, same = child[a], child[b], many[a], many[b], a == b
        both, left, right = ma & mb, ma & ~same, mb
        stack.append((depth + 1, np.concatenate([ca, ca[both] + 1, ca[right], ca[left] + 1]), np.concatenate([cb, cb[both] + 1, cb[right] + 1, cb[left]])))
    if named is not None:
        i, j, _, more = nearest(*(np.concatenate(x) for x in zip(*out, strict=True)))
        yield i, j, more


def star_rays(node: np.ndarray, ids: np.ndarray, fp: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids (u < v) of the rays of the stars in the nodes of over STAR_ROWS prints."""
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    leader = np.arange(len(node))
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(node)).tolist(), strict=True):
        if b - a > STAR_ROWS:
            leader[a:b] = a + stars(fp[a:b], size[a:b])
    rays = np.flatnonzero(leader != np.arange(len(node)))
    return np.minimum(ids[rays], ids[leader[rays]]), np.maximum(ids[rays], ids[leader[rays]])


def named_pairs(node: np.ndarray, ids: np.ndarray, fp: np.ndarray, size: np.ndarray, group: np.ndarray, named: int | None = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids (u < v) of the ``named`` nearest pairs of near prints of each two groups in each node (None: all), and whether there may be more of theirs."""
    new = np.concatenate([[True], node[1:] != node[:-1]])
    # a group's prints in a node take the number of their first place and stand together there, so that whole ranges of them are pruned
    by = np.lexsort([group, node])
    first = np.concatenate([[True], (node[by][1:] != node[by][:-1]) | (group[by][1:] != group[by][:-1])])
    number = np.empty(len(node), np.int64)
    number[by] = np.minimum.reduceat(by, np.flatnonzero(first))[np.cumsum(first) - 1]
    order = np.lexsort([number, np.cumsum(new)])
    for i, j, more in range_pairs(fp[order], size[order], number[order], np.flatnonzero(new), named):
        u, v = ids[order[i]], ids[order[j]]
        yield np.minimum(u, v), np.maximum(u, v), more


def node_pairs(node: np.ndarray, ids: np.ndarray, fp: np.ndarray, size: np.ndarray, group: np.ndarray, named: int | None = 1) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``named_pairs`` at once."""
    none = np.zeros(0, np.int64)
    u, v, _ = zip((none, none, none), *named_pairs(node, ids, fp, size, group, named), strict=True)
    return np.concatenate(u), np.concatenate(v)


def _rays(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    u, v = star_rays(*columns)
    yield u, v, np.zeros(len(u), bool)


def _prints(rows: DataFrame) -> list[str]:
    return ["a", "b", *(c for c in PARITIES if c in rows.columns)]


_Find = Callable[..., Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _pairs_in(rows: DataFrame, find: _Find) -> DataFrame:
    """(u, v, more) that ``find`` names in each node of ``rows`` (node, id, a, b, n, g and any PARITIES)."""
    columns = ["node", "id", "n", "g", *_prints(rows)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            node, ids, n, g, *prints = part
            for found in find(node, ids, np.stack(prints, 1).view(np.uint64), n, g):
                yield pa.RecordBatch.from_arrays([*map(pa.array, found)], ["u", "v", "more"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            part = part if held is None else [np.concatenate(x) for x in zip(held, part, strict=True)]
            last = np.flatnonzero(part[0][1:] != part[0][:-1])
            if len(last):  # all but the last node, which may go on
                yield from pairs([x[: last[-1] + 1] for x in part])
                part = [x[last[-1] + 1 :] for x in part]
            held = part
        if held is not None and len(held[0]):
            yield from pairs(held)

    dealt = rows.repartition("node").sortWithinPartitions("node", F.floor(F.log(F.col("n")) / F.log(F.lit(1 / SIMILARITY))), _gray_rank("a"), _gray_rank("b"))
    return dealt.select(columns).mapInArrow(frugal(run), "u long, v long, more boolean")


def _divided(rows: DataFrame, find: _Find, sub_masks: int) -> DataFrame:
    """Distinct pairs (and whether there may be more of their groups in any node) that ``find`` names in the nodes of ``rows``; nodes of over NODE_ROWS are divided by ``sub_masks`` masks each time."""
    lower, pairs = _masks()[1], None
    for depth in range(DEPTH + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("m")).where(f"m > {NODE_ROWS}")
        large = depth < DEPTH and not sizes.isEmpty()
        found = _pairs_in(rows.join(sizes, "node", "left_anti") if large else rows, find)
        pairs = found if pairs is None else pairs.unionByName(found)
        if not large:
            break
        masks = lower[SUB_MASKS * depth : SUB_MASKS * depth + sub_masks]
        hung = F.explode(F.array(*[_under(bits, 1000 * (depth + 1) + k, F.col("node")) for k, bits in enumerate(masks)]))
        rows = materialize(rows.join(sizes, "node", "left_semi").select("id", "n", "g", *_prints(rows), hung.alias("node")), "nodes")
    return pairs.groupBy("u", "v").agg(F.max("more").alias("more"))


def _hung(vertices: DataFrame, masks: int) -> DataFrame:
    hung = F.explode(F.array(*[_under(bits, k) for k, bits in enumerate(_masks()[0][:masks])]))
    return vertices.select("id", "n", "g", *_prints(vertices), hung.alias("node"))


def ray_pairs(vertices: DataFrame) -> DataFrame:
    """Rays (u < v) of the stars among ``vertices`` (id, a, b, n)."""
    rows = _hung(vertices.withColumn("g", F.col("id")), STAR_MASKS)
    large = rows.groupBy("node").agg(F.count(F.lit(1)).alias("m")).where(f"m > {STAR_ROWS}").select("node")
    return _divided(rows.join(large, "node", "left_semi"), _rays, 1).select("u", "v")


def candidate_pairs(vertices: DataFrame, named: int | None = NEAREST) -> DataFrame:
    """Pairs (u < v) to check among ``vertices`` (id, a, b, n and the group g), ``named`` for each two groups of a node (None: all), and whether there may be more of these groups."""
    return _divided(_hung(vertices, MASKS), partial(named_pairs, named=named), SUB_MASKS)


def bounded(ids: DataFrame) -> DataFrame:
    """``ids``, written, with a broadcast hint if they are few enough."""
    ids = materialize(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def checked_links(pairs: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = round(100 * SIMILARITY)) -> DataFrame:
    """The pairs (u, v) whose sets of shingles are alike by ``percent`` or more; ``texts`` has id and text. A text with many pairs is dealt over several tasks."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for i, j in byte_slices(off):
                found = list(shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], words))
                ends = np.append(0, np.cumsum([len(h) for h in found]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), lists], ["id", "set"])

    used = bounded(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    found = materialize(texts.join(used, "id", "left_semi").select("id", "text").mapInArrow(frugal(sets), "id long, set array<long>"), "sets")
    # u is the smaller id; each of the two may have many pairs, so both sides are dealt
    parts = lambda c: pairs.groupBy(c).agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).alias(f"parts_{c}"))
    rows = pairs
    for c, other in (("u", "v"), ("v", "u")):
        spread = found.withColumnsRenamed({"id": c, "set": f"set_{c}"}).join(parts(c), c).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"parts_{c}") - 1)))
        rows = rows.join(parts(c), c).withColumn("part", F.pmod(F.xxhash64(other), F.col(f"parts_{c}"))).drop(f"parts_{c}").join(spread.drop(f"parts_{c}"), [c, "part"]).drop("part")
    # compared by Spark itself: two sets a row would make large batches for Python
    both = F.size(F.array_intersect("set_u", "set_v"))
    return rows.where(100 * both >= percent * (F.size("set_u") + F.size("set_v") - both)).select("u", "v")


def _grouped(rows: DataFrame, groups: DataFrame, of: str, g: str) -> DataFrame:
    """Add ``g``, the group of the id in ``of`` by ``groups`` (id, component); a vertex that is linked to none is its own."""
    known = groups.select(F.col("id").alias(of), F.col("component").alias(g))
    return rows.join(known, of, "left").withColumn(g, F.coalesce(g, of))


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (id, component) with those joined that ``links`` (u, v) link."""
    ends = _grouped(_grouped(links, groups, "u", "gu"), groups, "v", "gv").select(F.col("gu").alias("u"), F.col("gv").alias("v"))
    merged = connected_components(ends)
    first = groups.unionByName(merged.select("id", F.col("id").alias("component"))).distinct()
    return first.join(merged.select(F.col("id").alias("component"), F.col("component").alias("_to")), "component", "left").select("id", F.coalesce("_to", "component").alias("component"))


def pairs_left(vertices: DataFrame, pairs: DataFrame, groups: DataFrame) -> DataFrame | None:
    """The pairs of groups (id, component) that are apart though ``pairs`` (u, v, more), which are checked, name not all of theirs; None if there are no such groups."""
    ends = lambda df: _grouped(_grouped(df, groups, "u", "gu"), groups, "v", "gv").withColumns({"g": F.least("gu", "gv"), "h": F.greatest("gu", "gv")})
    apart = materialize(ends(pairs.where("more")).where("g != h").select("g", "h").distinct(), "apart")
    if apart.isEmpty():
        return None
    met = apart.select(F.explode(F.array("g", "h")).alias("g")).distinct()
    every = candidate_pairs(_grouped(vertices, groups, "id", "g").join(met, "g", "left_semi"), named=None).select("u", "v")
    return ends(every.join(pairs, ["u", "v"], "left_anti")).join(apart, ["g", "h"], "left_semi").select("u", "v")


def components(vertices: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, component) of the vertices (id, a, b, n and any PARITIES) that are linked to another; ``texts`` has id and text."""
    rays = materialize(ray_pairs(vertices), "rays")
    groups = materialize(connected_components(checked_links(rays, texts)), "groups")
    pairs = materialize(candidate_pairs(_grouped(vertices, groups, "id", "g")), "pairs")
    groups = materialize(_merged(groups, checked_links(pairs.select("u", "v"), texts)), "groups")
    left = pairs_left(vertices, pairs, groups)
    return groups if left is None else _merged(groups, checked_links(materialize(left, "left"), texts))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component: the smallest doc_id (null last), then the smallest hash of the text, then the first of rows that are alike."""
    row, a, b, n, s1, s2, *odd = free_names(docs, "_row", "_a", "_b", "_n", "_s1", "_s2", *(f"_{p}" for p in PARITIES))
    rows = materialize(with_fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), [a, b, n, s1, s2, *odd]), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("text"), F.col(row).alias("row"))
    vertices = materialize(rows.groupBy(s1, s2, n).agg(F.min(row).alias("id"), F.first(a).alias("a"), F.first(b).alias("b"), *(F.first(c).alias(p) for c, p in zip(odd, PARITIES, strict=True)), F.min(order).alias("least")).withColumnRenamed(n, "n"), "vertices")
    members = components(vertices.where("n > 0").drop("least", s1, s2), rows.select(F.col(row).alias("id"), "text"))
    named = vertices.select("id", "least").join(members, "id", "left").withColumn("component", F.coalesce("component", "id"))
    kept = materialize(named.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias(row)), "kept")
    gone = bounded(rows.select(row).join(kept, row, "left_anti"))
    discard(vertices)
    return rows.join(gone, row, "left_anti").select(docs.columns)
