"""The manifest against a plain tree over sorted rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vigil.llm import manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, place int, _g string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row[:5]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """(root, siblings of every leaf) of nodes in order."""
    nodes, at, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for k, i in enumerate(at):
            if i ^ 1 < len(nodes):
                paths[k].append(nodes[i ^ 1])
        nodes, at = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {g: tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, tops = tree([below[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        for place, ((has, key, leaf), path) in enumerate(zip(sorted(groups[g]), below[g][1], strict=True)):
            out.append((key if has else None, g, place, leaf, below[g][0], root, path + top))
    return sorted(out, key=repr)


def ran(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = M.manifest(docs)
    return sorted(((r.doc_id, r.lang, r.place, r.leaf, r.subroot, r.root, r.siblings) for r in found.withColumn("siblings", M.siblings(F.col("proof"))).collect()), key=repr)


def test_ids_of_any_kind_against_a_plain_tree(spark):
    rng = random.Random(5)
    ids = rng.sample(range(-40_000, 40_000), 700) + [2**63 - 1, -(2**63), 2**40, 2**40 + 1, -1, 0] + list(range(100_000, 100_300))
    rows = [(i, f"text {i} é", rng.choice(["en", "en", "en", "de", None, "", "zz"]), None if i % 5 == 0 else f"s{i % 3}", None if i % 7 == 0 else i) for i in ids]
    rows += [(None, f"n{k}", "en", "s", 3) for k in range(40)] + [(77, "same", "de", "s", 4)] * 30 + [(77, f"other {k}", "de", "s", 4) for k in range(9)]
    rows += [(None, None, None, None, None)] * 3 + [(5, "x" * 300_000, "fr", "s", 300_000)]
    assert ran(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 257])
def test_sizes_about_a_block(spark, n):
    rows = [(k * 3, f"t{k}", "en", "s", k) for k in range(n)]
    assert ran(spark, rows) == (plain(rows) if n else [])


def test_a_changed_row_no_longer_leads_to_the_root(spark):
    rows = [(k, f"t{k}", "en" if k % 3 else "de", "s", None if k % 4 == 0 else k) for k in range(50)]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = M.manifest(docs, claims={"n_chars": F.col("n_chars") + 1}, claimed_by=F.col("doc_id") % 2 == 0)
    true = {r.doc_id: r.true for r in found.select("doc_id", (M.folded(F.col("claimed"), F.col("proof")) == F.col("root")).alias("true")).collect()}
    assert true == {k: k % 2 == 1 or k % 4 == 0 for k in range(50)}
