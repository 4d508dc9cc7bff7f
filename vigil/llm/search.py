"""Ranked lexical search of a set of items over all documents, by branch and bound on document tries.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z
lower-cased. Only the terms of the items matter: a pass over the whole texts keeps of each
document its number of terms n and its term vector restricted to them, and the collection's
counts follow (N documents with a term, L terms in all, df documents with a given term).
A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), and a document scores the sum over
the item's terms of w * ((10^9 tf) div (1000 tf + 8 m)) with m = 10 + (90 n N) div L.

Each task makes an FP-tree of TREE_ROWS documents at a time: the terms of a vector are put
in order of falling df, so that vectors share the paths of their frequent terms, and a
subtree of over LEAF documents is divided by its next term. Every subtree keeps for each
term the largest tf and the smallest m below it, hence the most that the term can add. For
each item the tree is walked depth first after its most promising leaf; a subtree whose
terms cannot add up to the item's k-th best score so far is passed over, and so is one that
can only equal it with larger ids. The k best of the tasks meet in two steps.

Items are worked in blocks of about BLOCK_TERMS terms (one pass over the documents each), so
that the dictionary which tasks get does not grow with the number of items.

Edge cases: a null text, or one without a term, is no document of the collection. Every row
of either table counts by itself, so repeated rows are found repeatedly; equal scores go by
ascending doc_id, null last. An item without a term, or with terms that no document has,
has no rows. Texts are read in pieces cut between terms. Further columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.plans.materialize import discard, materialize

BLOCK_TERMS, TREE_ROWS, TREE_ENTRIES, LEAF = 500_000, 50_000, 4_000_000, 32
#: Bytes of a text whose terms are held at once.
PIECE = 4 << 20
#: Lists of the best that meet in one task are dealt over so many first.
MERGES = 64
_LAST = np.int64(2**63 - 1)

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = cut.end() if cut else len(text)
        yield text[at:end].translate(_FOLD).split()
        at = end


def _item_terms(items: DataFrame, item_id: str) -> DataFrame:
    """(row, item, terms) of all items that have a term; ``item`` is the id in the column ``item_id``."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({t for piece in terms_of(x.as_buffer().to_pybytes() if x.is_valid else b"") for t in piece}) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(terms, pa.list_(pa.binary()))], ["row", "item", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).alias("item"), "text")
    return rows.mapInArrow(run, f"row long, item {kind}, terms array<binary>").where("size(terms) > 0")


def restricted_vectors(docs: DataFrame, doc_id: str, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of all documents with a term: those of ``terms`` by number, and how often each occurs."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {t: k for k, t in enumerate(known.value)}
        for batch in batches:
            sizes, found, tfs = [], [], []
            for x in batch.column("text"):
                counts, n = Counter(), 0
                for piece in terms_of(x.as_buffer().to_pybytes() if x.is_valid else b""):
                    counts.update(map(numbers.get, piece))
                    n += len(piece)
                counts.pop(None, None)
                sizes.append(n)
                found.append(list(counts.keys()))
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>").where("n > 0")


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Trie:
    """FP-tree of restricted vectors, nodes in preorder.

    ids, m: one a document; ptr, term, tf: its vector (terms numbered by falling df); weight: of each term.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, ptr: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray) -> None:
        doc = np.repeat(np.arange(len(ids)), np.diff(ptr))
        by = np.lexsort([term, doc])
        term, tf = term[by], tf[by]
        keys = term.astype(">u4").tobytes()
        order = np.array(sorted(range(len(ids)), key=lambda d: keys[4 * ptr[d] : 4 * ptr[d + 1]]), np.int64)
        size = np.diff(ptr)[order]
        self.ptr = np.append(0, np.cumsum(size))
        take = np.arange(self.ptr[-1]) + np.repeat(ptr[:-1][order] - self.ptr[:-1], size)
        self.ids, self.m, self.term, tf = ids[order], m[order], term[take], tf[take]
        self.value = weight[self.term] * _gain(tf, np.repeat(self.m, size))
        self._grow(size)
        self._bound(tf, weight)

    def _grow(self, size: np.ndarray) -> None:
        """Nodes: documents lo to hi, depth in the tree, and the node after the subtree."""
        lo, hi, level, leaf = [], [], [], []
        stack = [(0, len(size), 0, 0)]  # documents, number of shared terms, depth in the tree
        while stack:
            a, b, shared, deep = stack.pop()
            while b - a > LEAF and size[a] > shared and self.term[self.ptr[a] + shared] == self.term[self.ptr[b - 1] + shared]:
                shared += 1
            lo.append(a), hi.append(b), level.append(deep)
            ended = a + int(np.searchsorted(size[a:b] > shared, True)) if b - a > LEAF else b
            leaf.append(ended == b)
            if ended == b:
                continue
            next_term = self.term[self.ptr[ended:b] + shared]
            cuts = [ended, *(ended + 1 + np.flatnonzero(next_term[1:] != next_term[:-1])).tolist(), b]
            parts = [(a, ended)] if ended > a else []
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):  # small neighbours share a leaf
                if parts and y - parts[-1][0] <= LEAF and parts[-1][0] >= ended:
                    parts[-1] = (parts[-1][0], y)
                else:
                    parts.append((x, y))
            stack += [(x, y, shared, deep + 1) for x, y in reversed(parts)]
        self.lo, self.hi, self.level, self.leaf = np.array(lo), np.array(hi), np.array(level), np.array(leaf)
        self.after, open_nodes = np.full(len(lo), len(lo)), []
        for k, deep in enumerate(level):
            while open_nodes and level[open_nodes[-1]] >= deep:
                self.after[open_nodes.pop()] = k
            open_nodes.append(k)

    def _bound(self, tf: np.ndarray, weight: np.ndarray) -> None:
        """The most that each term can add below each node, by term."""
        n = len(self.lo)
        self.least_m = np.array([self.m[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)])
        self.least_id = np.array([self.ids[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)])
        parent, path = np.zeros(n, np.int64), {}
        for k, deep in enumerate(self.level.tolist()):
            parent[k], path[deep] = path.get(deep - 1, -1), k
        leaves = np.flatnonzero(self.leaf)
        entries = self.ptr[self.hi[leaves]] - self.ptr[self.lo[leaves]]
        node, term = np.repeat(leaves, entries), self.term
        nodes, terms, tops = [], [], []
        carried = (np.zeros(0, np.int64), np.zeros(0, term.dtype), np.zeros(0, tf.dtype))
        for deep in range(int(self.level.max()), -1, -1):
            own = self.level[node] == deep
            a, b, c = (np.concatenate(x) for x in zip((node[own], term[own], tf[own]), carried, strict=True))
            by = np.lexsort([b, a])
            a, b, c = a[by], b[by], c[by]
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            a, b, c = a[first], b[first], np.maximum.reduceat(c, first)
            nodes.append(a), terms.append(b), tops.append(c)
            carried = (parent[a], b, c)
        node, term, top = np.concatenate(nodes), np.concatenate(terms), np.concatenate(tops)
        by = np.argsort(term, kind="stable")
        self.node_of, self.most = node[by], (weight[term] * _gain(top, self.least_m[node]))[by]
        self.from_term = np.searchsorted(term[by], np.arange(len(weight) + 1))

    def search(self, terms: np.ndarray, mine: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores, ids) of an item with what the tree holds; ``mine``: which terms are the item's."""
        bound = np.zeros(len(self.lo), np.int64)
        for t in terms.tolist():
            a, b = self.from_term[t], self.from_term[t + 1]
            bound[self.node_of[a:b]] += self.most[a:b]

        def full(node: int) -> bool:
            """The node cannot change the best."""
            if not bound[node] or len(best[0]) < k:
                return not bound[node]
            return bound[node] < best[0][-1] or (bound[node] == best[0][-1] and self.least_id[node] > best[1][-1])

        def with_leaf(node: int) -> tuple[np.ndarray, np.ndarray]:
            a, b = self.lo[node], self.hi[node]
            x, y = self.ptr[a], self.ptr[b]
            score = np.add.reduceat(np.where(mine[self.term[x:y]], self.value[x:y], 0), self.ptr[a:b] - x)
            worth = np.flatnonzero(score >= (best[0][-1] if len(best[0]) == k else 1))
            scores, ids = np.append(best[0], score[worth]), np.append(best[1], self.ids[a:b][worth])
            by = np.lexsort([ids, -scores])[:k]
            return scores[by], ids[by]

        first = int(np.argmax(np.where(self.leaf, bound, -1)))
        if not full(first):
            best = with_leaf(first)
        node, n = 0, len(self.lo)
        while node < n:
            if full(node):
                node = int(self.after[node])
                continue
            if self.leaf[node] and node != first:
                best = with_leaf(node)
            node += 1
        return best


def _best_of_tasks(vectors: DataFrame, items: list[tuple[int, list[int]]], weight: np.ndarray, number: np.ndarray, docs: int, total: int, k: int) -> DataFrame:
    """(row, doc_id, score): each task's k best of every item. ``number``: place of each term by falling df, for which ``weight`` stands."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, weight, number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, number = shared.value
        wanted = [(row, np.sort(number[np.array(terms)])) for row, terms in items]
        nothing = np.zeros(0, np.int64)
        best, mine = [(nothing, nothing)] * len(items), np.zeros(len(weight), bool)

        def add(parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts).combine_chunks()
            n = table["n"].to_numpy()
            m = 10 + np.array([90 * x * docs // total for x in n.tolist()], np.int64)
            terms = table["terms"].combine_chunks()
            ptr = terms.offsets.to_numpy().astype(np.int64)
            tf = table["tfs"].combine_chunks().flatten().to_numpy()
            trie = Trie(table["doc_id"].fill_null(_LAST).to_numpy(), m, ptr - ptr[0], number[terms.flatten().to_numpy()], tf, weight)
            for at, (_, terms) in enumerate(wanted):
                mine[terms] = True
                best[at] = trie.search(terms, mine, best[at], k)
                mine[terms] = False

        held, rows, entries = [], 0, 0
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                held.append(part)
                rows, entries = rows + len(part), entries + len(part.column("terms").flatten())
                if rows >= TREE_ROWS or entries >= TREE_ENTRIES:
                    add(held)
                    held, rows, entries = [], 0, 0
        if rows:
            add(held)
        for (row, _), (scores, ids) in zip(wanted, best, strict=True):
            if len(scores):
                found = pa.array(ids, mask=ids == _LAST)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row)), found, pa.array(scores)], ["row", "doc_id", "score"])

    return vectors.where("size(terms) > 0").select("doc_id", "n", "terms", "tfs").mapInArrow(run, "row long, doc_id long, score long")


def _ranked(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item, those with a score above 0."""
    asked = materialize(_item_terms(items, item_id), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_TERMS))
    tops = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "terms").collect()
        terms = sorted({bytes(t) for r in mine for t in r.terms})
        vectors = materialize(restricted_vectors(docs, doc_id, terms), "vectors")
        n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(terms), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect():
            df[term] = n
        number = np.empty(len(terms), np.int64)
        number[np.argsort(-df, kind="stable")] = np.arange(len(terms))
        weight = np.zeros(len(terms), np.int64)
        weight[number] = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()]
        place = {t: i for i, t in enumerate(terms)}
        wanted = [(r.row, [place[bytes(t)] for t in r.terms]) for r in mine]
        found = materialize(_best_of_tasks(vectors, wanted, weight, number, n_docs, n_terms or 1, k), "best")
        discard(vectors)
        tops = found if tops is None else tops.unionByName(found)
    few = _ranked(tops.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGES))), k, "row", "part").drop("part", "rank")
    best = _ranked(few, k, "row").join(asked.select("row", "item"), "row")
    return best.select(F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("doc_id").cast(docs.schema[doc_id].dataType).alias(doc_id), "score")
