"""Ranked search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np

from vigil.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k=10):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in counted:
            m = 10 + 90 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text)) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def words(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(n))


def ran(spark, docs, items, k=10):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, row int, terms string").repartition(3)
    items = spark.createDataFrame([(i, t, 0.5, "y") for i, t in items], "item_id long, text string, score double, item string")
    return sorted(map(tuple, S.search(docs, items, k).collect()), key=repr)


def test_scores_and_ties_against_all_documents(spark, monkeypatch):
    rng = random.Random(3)
    docs = [(i, words(rng, rng.choice([1, 3, 20, 200]))) for i in range(1500)]
    docs += [(2000 + i, docs[7][1]) for i in range(120)] + [(i, docs[8][1]) for i in range(3)] + [(None, docs[9][1])] * 2
    docs += [(3000, None), (3001, ""), (3002, " .,;\x00\x7f"), (3003, "ÀÉ w1 w2 W1 Straße_x-1"), (3004, words(rng, 60_000))]
    items = [(i, docs[rng.randrange(1500)][1][:300] + " nowhere") for i in range(40)] + [(41, docs[7][1]), (41, docs[7][1]), (42, None), (43, "..."), (44, "nowhere"), (45, "àé ÀÉ"), (None, docs[9][1])]
    want = plain(docs, items)
    assert ran(spark, docs, items) == want
    monkeypatch.setattr(S, "BLOCK_TERMS", 300)
    assert ran(spark, docs, items) == want


def test_empty_tables(spark):
    assert ran(spark, [], [(1, "a b")]) == [] and ran(spark, [(1, "a b")], []) == [] and ran(spark, [(1, None)], [(1, "a")]) == []


def test_pieces_hold_whole_terms(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 7)
    text = "Alpha beta-Gamma, " + "x" * 40 + " été\n1 2 3"
    assert [t.decode() for piece in S.terms_of(text.encode()) for t in piece] == plain_terms(text)


def test_trie_finds_the_best_of_all_its_documents():
    rng = np.random.default_rng(1)
    n, n_terms = 4000, 60
    rows = [np.flatnonzero(rng.random(n_terms) < 0.9 / (1 + np.arange(n_terms)) ** 0.5) for _ in range(n)]
    rows = [r if len(r) else np.array([0]) for r in rows]
    ptr, term = np.append(0, np.cumsum([len(r) for r in rows])), np.concatenate(rows)
    tf, m, weight = rng.integers(1, 9, len(term)), rng.integers(10, 400, n), np.arange(1, n_terms + 1) * 100
    trie = S.Trie(np.arange(n), m, ptr, term, tf, weight)
    assert trie.hi[0] == n and sorted(np.concatenate([trie.ids[a:b] for a, b in zip(trie.lo[trie.leaf], trie.hi[trie.leaf], strict=True)]).tolist()) == list(range(n))
    terms = np.array([1, 30, 50, 59])
    mine = np.zeros(n_terms, bool)
    mine[terms] = True
    value = weight[term] * ((10**9 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(ptr))))
    score = np.add.reduceat(np.where(mine[term], value, 0), ptr[:-1])
    by = np.lexsort([np.arange(n), -score])[:10]
    scores, ids = trie.search(terms, mine, (np.zeros(0, np.int64), np.zeros(0, np.int64)), 10)
    assert scores.tolist() == score[by].tolist() and ids.tolist() == by.tolist()
