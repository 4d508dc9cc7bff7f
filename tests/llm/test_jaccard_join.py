"""The similarity join against counting the common shingles of all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from vigil.llm import jaccard_join as J


def plain(docs, words=3, percent=90):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
        sets.append(frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    parent, holders, first = list(range(len(sets))), defaultdict(list), {}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        if s and s in first:
            parent[top(i)] = top(first[s])
        if not s or s in first:
            continue
        first[s], common = i, defaultdict(int)
        for g in s:
            for j in holders[g]:
                common[j] += 1
            holders[g].append(i)
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least.setdefault(top(i), []).append(doc)
    return sorted(((doc, len(sets[i]), min((d for d in least[top(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(docs)), key=repr)


def changed(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def planted():
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    base, other, passage = fresh(130), fresh(90), fresh(40)
    texts = [" ".join(changed(rng, base, rng.choice([1, 2, 3]))) for _ in range(220)]  # many pairs just under the limit, the base itself absent
    chain = other
    for _ in range(60):
        chain = changed(rng, chain, 1)
        texts.append(" ".join(chain))
    texts += [" ".join(passage + fresh(rng.choice([2, 3, 4, 5, 30]))) for _ in range(150)]
    texts += [" ".join(fresh(rng.choice([1, 2, 3, 4, 10, 60]))) for _ in range(300)]
    for n in (20, 21, 22, 40, 62, 200):  # at the limit: a set and the same with some shingles more
        words = fresh(n)
        texts += [" ".join(words), " ".join(words + fresh(n // 10)), " ".join(words + fresh(n // 9))]
    texts += [texts[5]] * 90 + [texts[6].upper(), texts[7].replace(" ", " \n\t")]
    docs = list(enumerate(texts, 1000)) + [(1, None), (2, ""), (3, " \n "), (None, texts[8]), (None, "alone in the world"), (7, texts[9]), (7, texts[9]), (8, "One"), (9, "one"), (10, "one two"), (11, "two one")]
    docs += [(12, " ".join(fresh(60_000)))]
    rng.shuffle(docs)
    return docs


def ran(spark, docs, **more):
    rows = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in docs], "doc_id long, text string, n long, row string, component_id string").repartition(3)
    return sorted(map(tuple, J.jaccard_components(rows, **more).collect()), key=repr)


@pytest.mark.parametrize("block", [20_000, 60])
def test_components_of_planted_groups(spark, monkeypatch, block):
    monkeypatch.setattr(J, "NODE_ROWS", block)
    docs = planted()
    assert ran(spark, docs) == plain(docs)


def test_other_words_and_limit_and_empty_tables(spark):
    docs = [d for d in planted() if d[0] is None or d[0] < 1350]
    assert ran(spark, docs, words=2, percent=70) == plain(docs, 2, 70)
    assert ran(spark, []) == [] and ran(spark, [(1, None)]) == [(1, 0, 1)]


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        x = rng.permutation(200)[:n]
        y = np.unique(np.append(x[: n - int(rng.integers(0, 1 + n // 10))], rng.permutation(200)[: int(rng.integers(0, 2 + n // 10))]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 90 * (len(np.union1d(x, y))):
            continue
        small, large = sorted((np.sort(x), np.sort(y)), key=len)
        assert both >= J.needed(len(x), len(y), 90)
        assert np.intersect1d(small[: J.prefix_lengths(len(small), 90)[1]], large[: J.prefix_lengths(len(large), 90)[0]]).size
