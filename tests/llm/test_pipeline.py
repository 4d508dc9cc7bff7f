"""Every stage of the pipeline on the smallest tables, against brute force on what the stage before kept."""

import hashlib
import random
import re

from corpus_pipeline import CAPACITY, STAGES, run
from tests.llm.test_near_copies import altered, brute_components, words
from tests.llm.test_ops import brute_repeats, check_packing
from vigil.llm import decontaminate, toxicity
from vigil.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    stage = dict(STAGES)
    assert [k for k, _ in STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "packing"]

    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    one = stage["toxicity"](spark, docs, SF).cache()
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(i for i, p in scores.items() if not p)

    # one row of each component of five-word Jaccard 0.8 or more, the smallest id
    rows = sorted((r["doc_id"], r["text"]) for r in one.collect())
    least: dict[int, int] = {}
    for (i, _), c in zip(rows, brute_components([t for _, t in rows]), strict=True):
        least.setdefault(c, i)
    two = stage["near_duplicates"](spark, one, SF).cache()
    assert two.columns == docs.columns and sorted(r["doc_id"] for r in two.collect()) == sorted(least.values())

    rows = [(r["doc_id"], r["text"]) for r in two.collect()]
    want = {i: (gone, sha) for i, size, gone, _, sha in brute_repeats(rows, 200) if not gone or gone < size}
    three = stage["repeated_passages"](spark, two, SF).cache()
    got = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == docs.columns and got.keys() == want.keys()
    for i, (gone, sha) in want.items():
        assert gone or hashlib.sha256(got[i]["text"].encode()).hexdigest() == sha
        assert got[i]["n_chars"] == len(got[i]["text"])

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    four = stage["decontamination"](spark, three, SF).cache()
    flagged = {r["doc_id"] for r in decontaminate.flag_contaminated(three, bench).where("contaminated").collect()}
    assert four.columns == docs.columns and {r["doc_id"] for r in four.collect()} == got.keys() - flagged
    squeeze = lambda t: re.sub(r"\s+", " ", t)
    items = [squeeze(r["text"]) for r in bench.collect()]
    assert not [i for i in flagged if not any(x[:40] in squeeze(got[i]["text"]) or x[-40:] in squeeze(got[i]["text"]) for x in items)]

    used, floor = check_packing(stage["packing"](spark, four, SF).collect(), four, vocabulary("word_bpe_49k.json"), CAPACITY)
    assert used <= floor + 1


def test_empty_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in STAGES:
        out = f(spark, docs, SF)
        assert out.count() == 0
    assert run(spark, SF).count() > 0


def test_near_copies_by_row(spark):
    rng = random.Random(11)
    a, b, c, d, e = (words(rng, 120) for _ in range(5))
    near = lambda t: altered(rng, t, 1)
    data = [(3, a), (7, near(a)), (7, b), (9, near(b)), (None, near(a)), (None, c), (None, c + " x"), (None, d), (12, e), (12, e)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    kept = sorted(((r["doc_id"], r["text"]) for r in dict(STAGES)["near_duplicates"](spark, docs, SF).collect()), key=str)
    assert [r for r in kept if r[1] not in (c, c + " x")] == sorted([(3, a), (7, b), (None, d), (12, e)], key=str)
    assert len(kept) == 5  # and one of the copies of c


def test_clashing_columns(spark):
    """Stages carry columns of any name, with nulls in each of them."""
    names = ["score", "k1", "k2", "spans", "n_removed", "n_bytes", "kept_text", "_text", "_row", "_null", "others", "h", "fp", "n", "id", "g", "node", "bitmap", "w", "rank", "length"]
    rng = random.Random(13)
    texts = [words(rng, 90) for _ in range(6)] + [None, "", "one"]
    passage = words(rng, 60)
    texts += [f"{words(rng, 30)} {passage}", f"{passage} {words(rng, 30)}"]
    rows = [(i, t, *(None if i % 4 == 0 else f"{n} {i}" for n in names), len(t or "")) for i, t in enumerate(texts)] + [(None,) * (len(names) + 3)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}, n_chars long").repartition(3)
    held = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) >= 8, name
        for r in got:
            was = held[r["doc_id"]]
            assert all(r[n] == was[n] for n in names), name
            assert r["text"] == was["text"] or name == "repeated_passages" and len(r["text"]) == r["n_chars"] < was["n_chars"]
    assert STAGES[4][1](spark, docs, SF).count() == len(rows)
