"""Near copies by five-word shingles against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import near_copies as N
from vigil.operators.graph import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = "heron river stone mill bridge town field cloud lamp road leaf sand".split()


def brute_set(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    """Component number of each text: equal sets, and sets of Jaccard similarity 0.8 or more, are linked."""
    sets = [brute_set(t) for t in texts]
    of: dict = {}
    distinct = [of.setdefault(frozenset(s), len(of)) for s in sets]
    kinds = list(of)
    where = defaultdict(list)
    for k, s in enumerate(kinds):
        for x in s:
            where[x].append(k)
    root = list(range(len(kinds)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in enumerate(kinds):
        for other, both in Counter(o for x in s for o in where[x] if o < k).items():
            if both >= 0.8 * len(s | kinds[other]):
                root[find(k)] = find(other)
    return [find(d) for d in distinct]


def words(rng, n):
    return " ".join(rng.choice(VOCAB) + str(rng.randint(0, 99)) for _ in range(n))


def altered(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("piece", [4 << 20, 10])
def test_shingles(piece, monkeypatch):
    monkeypatch.setattr(N, "PIECE", piece)
    rng = random.Random(1)
    texts = ["", "a", "A b", "a b c d e", "A B C D E", "a b c d e f", " x\ty\x0bz ", "ab", "ba", "é É", "w" * 300 + " q", "a b c d e a b c d e a b", "end", "start"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = [set(h.tolist()) for h in N.shingles(np.frombuffer(b"".join(raw), np.uint8), off)]
    name: dict = {}
    for g, t in zip(got, texts, strict=True):
        want = brute_set(t)
        assert len(g) == len(want)
        for other, o in zip(got, texts, strict=True):
            assert len(g & other) == len(want & brute_set(o))
    assert not name


def test_majority():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 99, 100, 5000):
        h = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        a, _ = N.majority(h).tolist()
        assert a == sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h.tolist()) > n)


@pytest.mark.parametrize("grouped", [False, True])
def test_node_pairs(grouped):
    rng = np.random.default_rng(3)
    fp, size, family = [], [], []
    for k in range(40):
        base = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
        for _ in range(rng.integers(1, 30)):
            flip = np.zeros(128, np.uint8)
            flip[rng.permutation(128)[: rng.integers(0, 24)]] = 1
            fp.append(base ^ np.packbits(flip, bitorder="little").view(np.uint64))
            size.append(100 + int(rng.integers(0, 40)))
            family.append(1000 + k // 2 * 3 + int(rng.integers(0, 3)))
    fp, size = np.array(fp), np.array(size, np.int64)
    node = np.sort(rng.integers(0, 5, len(fp)))
    ids = rng.permutation(len(fp))
    group = np.array(family) if grouped else ids + 5000
    u, v = N.node_pairs(node, ids, fp, size, group)
    at = np.argsort(ids)
    got: dict = {}
    for a, b in zip(at[u].tolist(), at[v].tolist(), strict=True):
        key = (node[a], min(group[a], group[b]), max(group[a], group[b]))
        assert node[a] == node[b] and key not in got
        got[key] = int(np.bitwise_count(fp[a] ^ fp[b]).sum())
    want: dict = {}
    for i in range(len(fp)):
        for j in range(i):
            d = int(np.bitwise_count(fp[i] ^ fp[j]).sum())
            if node[i] == node[j] and group[i] != group[j] and d <= N.DISTANCE and min(size[i], size[j]) >= 0.8 * max(size[i], size[j]):
                key = (node[i], min(group[i], group[j]), max(group[i], group[j]))
                want[key] = min(d, want.get(key, 999))
    assert got == want and len(want) > 50


def test_stars():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
    near = [base ^ np.array([1 << int(rng.integers(0, 60)), 1 << int(rng.integers(0, 60))], np.uint64) for _ in range(200)]
    fp = np.array([*near, *rng.integers(0, 1 << 63, (200, 2), dtype=np.uint64)])
    leader = N.stars(fp, np.full(400, 50))
    assert len(set(leader[:200].tolist())) == 1 and (leader[200:] == np.arange(200, 400)).all()
    u, v = N.star_rays(np.zeros(400, np.int64), np.arange(400), fp, np.full(400, 50), np.arange(400))
    assert len(u) == 199 and max(v) < 200


def kept_components(spark, rows, schema="doc_id long, text string"):
    docs = spark.createDataFrame(rows, schema).repartition(4)
    return [(r["doc_id"], r["text"]) for r in N.drop_near_copies(docs).collect()]


@pytest.mark.parametrize("node_rows", [20_000, 8])
def test_planted_groups(spark, node_rows, monkeypatch):
    """Every component keeps one row; small nodes are divided again."""
    monkeypatch.setattr(N, "NODE_ROWS", node_rows)
    monkeypatch.setattr(N, "STAR_ROWS", 6)
    monkeypatch.setattr(N, "PAIRS_PER_TASK", 3)
    rng = random.Random(4)
    rows = []
    for k in range(30):
        base = words(rng, rng.randint(60, 400))
        rows.append(base)
        rows += [altered(rng, base, rng.choice([1, 1, 2])) for _ in range(rng.choice([0, 1, 2, 25]))]
    rows += [words(rng, 60) for _ in range(60)]
    rng.shuffle(rows)
    kept = kept_components(spark, [*enumerate(rows)])
    comp = brute_components(rows)
    found = Counter(comp[i] for i, _ in kept)
    assert set(found) == set(comp)
    assert sum(found.values()) <= len(set(comp)) + 1  # two prints can be too far apart by chance


def test_edges(spark):
    rng = random.Random(5)
    a, b = words(rng, 300), words(rng, 300)
    rows = [(3, a), (7, altered(rng, a, 1)), (7, b), (9, altered(rng, b, 1)), (None, a + " x"), (None, None), (5, ""), (6, " \n"), (11, "two words"), (12, "Two  WORDS"), (13, "other words"), (3, a)]
    extra = [(i, t, 0.5, 1, "q") for i, t in rows]
    docs = spark.createDataFrame(extra, "doc_id long, text string, n double, id long, _row string").repartition(3)
    out = N.drop_near_copies(docs)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert got == Counter([(3, a), (7, b), (5, ""), (11, "two words"), (13, "other words")])
    assert {(r["n"], r["id"], r["_row"]) for r in out.collect()} == {(0.5, 1, "q")}
    assert N.drop_near_copies(docs.limit(0)).count() == 0


def test_recall_on_table(spark):
    """Pairs of similarity 0.8 or more in the supplied table: links found among all that there are."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    comp = dict(zip((i for i, _ in rows), brute_components([t for _, t in rows]), strict=True))
    kept = Counter(comp[r["doc_id"]] for r in N.drop_near_copies(docs).select("doc_id").collect())
    assert set(kept) == set(comp.values()) and sum(kept.values()) <= len(set(comp.values())) * 1.02


def test_components_of_a_large_group(spark):
    """A hot group in one node: stars keep the pairs far below all pairs, and one row stays."""
    rng = random.Random(6)
    base = words(rng, 300)
    rows = [base] + [altered(rng, base, 1) for _ in range(600)]
    docs = spark.createDataFrame([*enumerate(rows)], "doc_id long, text string").repartition(4)
    prints = N.with_fingerprints(docs, ["a", "b", "n", "s1", "s2"]).select(F.col("doc_id").alias("id"), "a", "b", "n").cache()
    rays = N.ray_pairs(prints)
    assert rays.count() < 601 * 10
    groups = connected_components(N.checked_links(rays, docs.withColumnRenamed("doc_id", "id"))).withColumnRenamed("component", "g")
    grouped = prints.join(groups, "id", "left").withColumn("g", F.coalesce("g", "id"))
    assert N.candidate_pairs(grouped).count() < 601 * 20
    assert [i for i, _ in kept_components(spark, [*enumerate(rows)])] == [0]


def test_recall_of_links_between_groups(spark):
    """Two drifting lines of copies each, linked where they meet alone: the share of such links that the components hold."""
    rng = random.Random(21)
    rows, pairs = [], 60
    for _ in range(pairs):
        bridge = words(rng, 150)
        for line in (bridge, altered(rng, bridge, 2)):
            for _ in range(12):
                rows.append(line)
                line = altered(rng, line, 1)
    comp = brute_components(rows)
    kept = len(kept_components(spark, [*enumerate(rows)]))
    wanted = len(set(comp))
    assert wanted <= pairs + 3 and kept - wanted <= 0.05 * pairs


def test_no_pair_of_two_groups_is_left(spark):
    """Two groups whose nearest pairs fail in all nodes, and that one text links whose print is farther off."""
    w, n = words(random.Random(31), 300).split(), N.STAR_ROWS + 6
    text = lambda *at: " ".join(f"new{k}" if k in at else x for k, x in enumerate(w))
    texts = [text(), *(text(5 + k) for k in range(n)), *(text(85 + k, 200, 210, 220, 230, 240) for k in range(n))]
    assert len(set(brute_components(texts))) == 1 and len(set(brute_components(texts[1:]))) == 2
    free = [b for b in range(N.BITS) if b not in N._masks()[0][0]]

    def flipped(n):
        bits = np.zeros(N.BITS, np.uint8)
        bits[free[:n]] = 1
        return np.packbits(bits, bitorder="little").view(np.int64).tolist()

    a, b, far = flipped(0), flipped(24), (np.array(flipped(27)) ^ np.array(flipped(24))).tolist()
    rows = [(k, *(far if k == 0 else a if k <= n else b), 296) for k in range(2 * n + 1)]
    vertices = spark.createDataFrame(rows, "id long, a long, b long, n long")
    found = N.components(vertices, spark.createDataFrame([*enumerate(texts)], "id long, text string")).collect()
    assert {r["id"]: r["component"] for r in found} == dict.fromkeys(range(2 * n + 1), 0)
