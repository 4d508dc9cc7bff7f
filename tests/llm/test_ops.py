"""The ten operators against brute force, on small tables with every edge case."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vigil.llm import decontaminate, language, packing, quality, sharding, simhash, suffix_dedup, token_counts, toxicity, url_filter
from vigil.llm.queries import URL_RULES, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank long, h long, k1 long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def make_texts():
    rng = random.Random(7)
    vocab = ["the", "of", "and", "a", "heron", "river", "Stone", "é", "naïve", "x1", "1,200", "kg", "#tag", "&", "end.", "世界"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", "", str(rng.randint(0, 999))]) for _ in range(n))
    base, passage = text(120), text(60)
    out = [text(rng.randint(1, 90)) for _ in range(30)]
    out += [base, base, base + " more", "lead " + base, base.replace("heron", "egret", 2)]
    out += [text(30) + "\n" + passage + "\n" + text(30) for _ in range(4)]
    out += ["", None, "  ", "\n\n", "word", "two words", "a b c", "a\tb\x0bc\x0cd\re", "x" * 700, "ab" * 450, "spam " * 300, "12 34", "...", text(5000)]
    out += ["line one\nline two\nline one\n\n\nline two\n", "a  b   c ", " lead", "trail ", "▁x ▁", "<s> </s> <|endoftext|> x", "\x1cfs sep\x1dgs"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 0.5, 1, 2, 3) for i, t in enumerate(make_texts())]
    rows += [rows[3], rows[32], (None, "no id " * 60, None, None, None, None, None, None, None), (None, None) + (None,) * 7]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def as_bag(rows):
    return Counter(tuple(r) for r in rows)


def test_toxicity(spark, docs, empty):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    data, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        w = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        if bad:
            w.insert(rng.randint(0, len(w)), rng.choice(["Scum", "moron,", "IDIOT"]))
        data.append((i, " ".join(w)))
        marks.append((i, int(bad)))
    table, labels = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = toxicity.score_toxicity(table, labels).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 600 and {r["held_out"] for r in found} == {True, False}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert sum(r["predicted"] == dict(marks)[r["doc_id"]] for r in held) / len(held) > 0.98
    scored = toxicity.score_toxicity(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("score != 0").count() == 0
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_toxicity_giant_first_text(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_BYTES", 40_000)
    monkeypatch.setattr(toxicity, "TEXT_CHARS", 30_000, raising=False)
    ids = [r["id"] for r in spark.range(200).orderBy(F.xxhash64("id")).collect()]
    text = {i: f"word{i % 7} moron here" if k % 2 else f"word{i % 7} good here" for k, i in enumerate(ids)}
    text[ids[0]], text[ids[3]] = "long " * 10_000, "long " * 9_000
    table = spark.createDataFrame([*text.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    sample, shift = toxicity.training_sample(table, labels, F.lit(True))
    rows = {r["text"]: r["toxic"] for r in sample.collect()}
    assert sample.count() == 199 and sample.where("toxic = 1").count() == 99 and ("long " * 10_000)[:30_000] in rows
    assert shift == pytest.approx(math.log(100 / 100) - math.log(99 / 100))
    found = {r["doc_id"]: r["score"] for r in toxicity.score_texts(table, toxicity.fit(table, labels, F.lit(True))).collect()}
    assert all((found[i] > 0.5) == k % 2 for k, i in enumerate(ids) if k not in (0, 3))


def test_toxicity_features():
    texts = ["Ab c-d", "", "é x", "Ab", "end", "start"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    doc, bucket = toxicity.features(np.frombuffer(b"".join(raw), np.uint8), off)
    for k, r in enumerate(raw):
        alone = toxicity.features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[1]
        assert sorted(bucket[doc == k]) == sorted(alone)
        n = len(re.findall(rb"[A-Za-z0-9\x80-\xff]+", r))
        assert len(alone) == n + max(0, n - 1) + max(0, n - 2)


def brute_features(text):
    """Distinct buckets by plain integers, from words cut by a pattern."""
    full = (1 << 64) - 1

    def mix(h):
        h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 & full
        h = (h ^ h >> 29) * 0xA0761D6478BD642F & full
        return h ^ h >> 32

    step = 0x9E3779B97F4A7C15
    words = [mix(sum(mix(b + (32 if 65 <= b <= 90 else 0) + 1) * pow(step, min(i, 63) + 1, 1 << 64) for i, b in enumerate(w)) & full) for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", text.encode())]
    pairs = [mix((a * 0xC2B2AE3D27D4EB4F + b) & full) for a, b in zip(words, words[1:])]
    skips = [mix((a * 0x165667B19E3779F9 + b) & full) for a, b in zip(words, words[2:])]
    return sorted({h >> 64 - toxicity.BUCKET_BITS for h in words + pairs + skips})


def brute_ftrl(rows, marks):
    """Weights by bucket and bias, one coordinate at a time."""
    texts = Counter(b for r in rows for b in r)
    z, n, bias = defaultdict(float), defaultdict(float), "bias"

    def weight(k):
        if abs(z[k]) <= toxicity.L1:
            return 0.0
        return (math.copysign(toxicity.L1, z[k]) - z[k]) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for r, y in zip(rows, marks, strict=True):
            keys = [b for b in r if texts[b] >= toxicity.MIN_TEXTS] + [bias]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for k in keys:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * w[k]
                n[k] += g * g
    return {k: weight(k) for k in z if k != bias and weight(k)}, weight(bias)


def test_toxicity_against_plain_ftrl(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["é", "Ünder", "a" * 80]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + rng.choice([" scum", " fine, fine", ""]) for _ in range(300)]
    marks = [int("scum" in t or rng.random() < 0.05) for t in texts]
    rows = [brute_features(t) for t in texts]
    table = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: np.frombuffer(r["features"], "<i4").tolist() for r in toxicity.distinct_features(table).collect()}
    assert [found[i] for i in range(300)] == rows
    model = toxicity.train([np.array(r, np.int32) for r in rows], marks, 0.25)
    want, bias = brute_ftrl(rows, marks)
    assert dict(zip(model.buckets.tolist(), model.weights)) == pytest.approx(want) and len(want) > 5 and model.bias == pytest.approx(bias + 0.25)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(table, model).collect()}
    for i, r in enumerate(rows):
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-bias - 0.25 - sum(want.get(b, 0.0) for b in r))), abs=1e-5)


def brute_repeats(rows, length):
    windows = Counter()
    raws = [(t or "").encode() for _, t in rows]
    for raw in raws:
        windows.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    for (doc_id, _), raw in zip(rows, raws, strict=True):
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if windows[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        yield doc_id, len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("hot, piece", [(3000, 4 << 20), (1, 700)])
def test_suffix_dedup(spark, docs, empty, hot, piece, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_RUNS", hot)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    found = suffix_dedup.remove_repeats(docs, keep=("lang", "score"))
    want = as_bag(brute_repeats(rows_of(docs), 200))
    assert as_bag((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()) == want
    assert sum(k[2] for k in want) > 2000
    kept = Counter((r["doc_id"], r["lang"], r["score"]) for r in docs.collect())
    assert Counter((r["doc_id"], r["lang"], r["score"]) for r in suffix_dedup.remove_repeats(docs, keep=("lang", "score")).collect()) == kept
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_random_bytes(spark):
    rng = random.Random(11)
    parts = ["".join(rng.choice("ab ") for _ in range(rng.randint(150, 420))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts)[rng.randint(0, 90) :] + rng.choice(["", "é", "x"]) for _ in range(rng.randint(1, 5)))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert as_bag(r[:5] for r in suffix_dedup.remove_repeats(table).collect()) == as_bag(brute_repeats(rows, 200))


def test_repeated_starts():
    rng = random.Random(2)
    for n in (1, 5, 40):
        raw = [rng.choice([0, 1, 2]) for _ in range(400)]
        want = Counter(tuple(raw[i : i + n]) for i in range(len(raw) - n + 1))
        want = [i for i in range(len(raw) - n + 1) if 0 not in raw[i : i + n] and want[tuple(raw[i : i + n])] > 1]
        assert suffix_dedup.repeated_starts(np.array(raw, np.int64), n).tolist() == want


def brute_quality(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


@pytest.mark.parametrize("bits", [20, 60])
def test_quality(spark, docs, empty, bits, monkeypatch):
    monkeypatch.setattr(quality, "POS_BITS", bits)
    if bits == 60:  # hashes of four bits collide, so the pairs are sorted
        monkeypatch.setattr(quality, "POS_BITS", 60)
    trusted = docs.select("doc_id").where("doc_id % 2 = 0")
    found = quality.filter_quality(docs, trusted).collect()
    want = as_bag((i, *brute_quality(t)) for i, t in rows_of(docs))
    assert as_bag(r[:6] for r in found) == want
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)
    assert quality.filter_quality(empty, trusted).count() == 0
    assert {r["score"] for r in quality.filter_quality(docs, trusted.limit(0)).collect()} == {0.0}


def test_quality_ratio_against_plain_counts(spark):
    """Bucket counts, ratios, scores and verdicts from dictionaries."""
    rng = random.Random(17)
    good, bad = "river stone mill heron field".split(), "buy now cheap win cash".split()
    texts = {i: " ".join(rng.choice(good if i % 3 else bad) + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 90))) for i in range(80)}
    trusted = {i for i in texts if i % 3 and i % 2} | {999}

    def buckets(t):
        w = [x.encode() for x in WORD.findall(t)]
        hashed = [xxh64_intdigest(x, seed=42) for x in w] + [xxh64_intdigest(b, seed=xxh64_intdigest(a, seed=42)) for a, b in zip(w, w[1:])]
        return [h % quality.BUCKETS for h in hashed]  # the number of buckets is a power of two, so the sign does not matter

    raw, target = Counter(), Counter()
    for i, t in texts.items():
        raw.update(buckets(t))
        target.update(buckets(t) if i in trusted else [])
    all_raw, all_target = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    ratio = lambda b: round(1e6 * math.log((target[b] + 1) / all_target * all_raw / (raw[b] + 1)))
    found = quality.filter_quality(spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3), spark.createDataFrame([(i,) for i in trusted], "doc_id long"), threshold=-1.0).collect()
    assert len(found) == 80 and {r["kept"] for r in found if not r["base_failed"]} == {True, False}
    for r in found:
        b = buckets(texts[r["doc_id"]])
        want = sum(map(ratio, b)) / len(b) / 1e6 if b else 0.0
        assert r["score"] == pytest.approx(want, abs=2e-6) and r["kept"] == (not r["base_failed"] and r["score"] >= -1.0)


def test_token_counts(docs, empty):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = as_bag((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 40) for i, t in rows_of(docs))
    assert as_bag(token_counts.count_tokens(docs, path, 40).collect()) == want
    assert token_counts.count_tokens(empty, path).count() == 0


def test_token_counts_random():
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    table, model = token_counts.shortcut(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert table.cuts and len(table.proven) > 10_000
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "▁", "世", "x́", ".", "<s>", "!!", "   ", "\r"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(5000)]
    assert table.counts(texts) == [len(x) for x in model.encode(texts)]


def brute_simhash(text):
    words = [w.encode() for w in WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids = sorted(set(prints))
    parent = {p: p for p in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {p: root(p) for p in ids}


def check_simhash(table):
    rows = rows_of(table)
    prints = [brute_simhash(t) for _, t in rows]
    roots = brute_components(prints)
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints, strict=True):
        least[roots[p]].append(i)
    want = as_bag((i, f"{p:016x}", min((x for x in least[roots[p]] if x is not None), default=None)) for (i, _), p in zip(rows, prints, strict=True))
    assert as_bag(simhash.near_duplicates(table).collect()) == want
    return want


def test_simhash(spark, docs, empty):
    check_simhash(docs)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("node_rows", [20_000, 3])
def test_simhash_links(spark, node_rows, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = set(seeds)
    for s in seeds[:12]:
        for _ in range(30):
            prints.add(s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.3) * (1 << rng.randrange(64)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    got = {frozenset((r["u"], r["v"])) for r in found}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want and len(want) > 100


def check_packing(found, docs, path, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows_of(docs):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert as_bag(r[:5] for r in found) == want
    at = defaultdict(list)
    for r in found:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in at.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= capacity
    total = sum(r["length"] for r in found)
    return len(at), -(-total // capacity)


@pytest.mark.parametrize("capacity", [4096, 128, 7])
def test_packing(docs, empty, capacity):
    path = vocabulary("word_bpe_49k.json")
    used, least = check_packing(packing.pack_documents(docs, path, capacity).collect(), docs, path, capacity)
    assert used <= least + 1
    assert packing.pack_documents(empty, path, capacity).count() == 0


def test_packing_plan():
    rng = random.Random(9)
    for _ in range(30):
        cap = rng.randint(1, 60)
        counts = dict(Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 200))))
        plan = packing.plan_packing(counts, cap)
        used = Counter()
        for use, times in plan:
            assert times > 0 and sum(k * n for k, n in use.items()) <= cap
            used.update({k: n * times for k, n in use.items()})
        assert used == Counter(counts)


def brute_best_fit(pieces, capacity):
    """Sequences that best-fit decreasing opens, piece by piece."""
    gaps = []
    for p in sorted(pieces, reverse=True):
        fits = [g for g in gaps if g >= p]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - p)
        else:
            gaps.append(capacity - p)
    return len(gaps)


def test_packing_plan_is_never_longer_than_best_fit():
    rng = random.Random(10)
    for k in range(60):
        cap = rng.choice([7, 30, 64, 100])
        pieces = [rng.randint(1, cap) for _ in range(rng.randint(0, 150))] if k % 2 else [x for x in range(1, cap + 1) for _ in range(rng.randint(1, 3))]
        used = sum(times for _, times in packing.plan_packing(dict(Counter(pieces)), cap))
        assert -(-sum(pieces) // cap) <= used <= brute_best_fit(pieces, cap)


def test_packing_sum_index():
    rng = random.Random(12)
    for _ in range(200):
        cap = rng.randint(3, 40)
        index = packing.SumIndex(dict(Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 12)))), cap)
        for _ in range(8):
            index.set(rng.randint(1, cap), rng.randint(0, 2))
            left = [x for x in range(1, cap + 1) for _ in range(int(index.avail[x]))]
            kinds = Counter(a + b for a, b in set(itertools.combinations(left, 2)))
            assert index.pairs.tolist() == [kinds[s] for s in range(cap + 1)]
            gap = rng.randint(1, cap)
            for most in (1, 2, 3):
                found = index.complement(gap, most)
                sizes = [k for k in range(1, most + 1) if any(sum(c) == gap for c in itertools.combinations(left, k))]
                assert (len(found) if found else None) == min(sizes, default=None)
                assert not found or (sum(found) == gap and not Counter(found) - Counter(left))


def test_packing_words():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    table, tok = packing.WordIds(path), Tokenizer.from_file(path)
    rng = random.Random(14)
    parts = ["the", "The,", "é", "É!", "İ", "ŉ", "ß", "naïve.", "l'été", "it's", "x1", "12", "...", "世界", "e\u0301", "\x00", "\u00a0", "<|endoftext|>", "a" * 90, "ǅ", "ȺȾ", "fi", "\x85"]
    texts = [rng.choice([" ", "", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    got = table.encode(texts)
    for t, raw in zip(texts, got, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_packing_column():
    """A column's texts as the tokenizer has them, by stems and runs of marks; words of one stem share an entry."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    table, tok = packing.WordIds(path), Tokenizer.from_file(path)
    texts = ["", " \t", "\x0bHeron$$$ heron, HERON,### heron", "a.b c$$$$$ '$ Éclair&&& ǅ* İ! <|endoftext|>, $$$ ŉ.,;:", "x" * 70, "heron heron"] * 3
    for kind in (pa.string(), pa.large_string()):
        ids, off = table.encode_column(pa.array(["left out", *texts], kind).slice(1))
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert "heron" in table and not {"Heron$$$", "heron,", "HERON,###"} & table.keys() and "x" * 70 not in table
    ids, off = table.encode_column(pa.array([], pa.string()))
    assert len(ids) == 0 and off.tolist() == [0]


def test_language(spark, docs, empty):
    rng = random.Random(4)
    stems = {"en": ["the", "thing", "water", "and"], "de": ["schön", "und", "ich", "zeit"], "fr": ["être", "la", "vous", "où"]}
    data = [(i, " ".join(rng.choice(stems[k]) + rng.choice(["", "s", "e"]) for _ in range(12)), k) for i, k in ((i, rng.choice([*stems])) for i in range(300))]
    data += [(1000, "1234 ...", "en"), (1001, None, "en"), (1002, "", None), (None, "the water and", None)]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in language.identify_language(table, ~toxicity.held_out(1, 3)).collect()}
    assert all(found[i]["lang_pred"] == k and 0 < found[i]["score"] <= 1 for i, _, k in data[:300])
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and found[1000]["score"] == 0 and found[None]["lang_pred"] == "en"
    assert language.identify_language(empty, ~toxicity.held_out(1, 3)).count() == 0
    assert {r["lang_pred"] for r in language.identify_language(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {"und"}
    assert language.identify_language(docs, F.lit(True)).count() == docs.count()


def test_language_giant_text_and_many_languages(spark):
    data = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 40, f"l{i:02d}") for i in range(70)]
    first = min((r["id"] for r in spark.range(100, 200).orderBy(F.xxhash64("id", F.lit(3))).limit(1).collect()))
    data += [(i, "plain text in one tongue " * (200_000 if i == first else 2), "plain") for i in range(100, 200)]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(4)
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify_language(table, F.lit(True)).collect()}
    assert found == {i: lang for i, _, lang in data}


def brute_ppm(samples, text):
    """Code length of a text under the trees of ``samples``, by recursion over dictionaries."""
    fold = lambda t: bytes(language.ORDER) + bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
    counts = [defaultdict(Counter) for _ in range(language.ORDER + 1)]
    for t in map(fold, samples):
        for i in range(language.ORDER, len(t)):
            for k in range(language.ORDER + 1):
                counts[k][t[i - k : i]][t[i]] += 1

    def p(context, byte):
        order = len(context)
        shorter = (lambda b: p(context[1:], b)) if order else (lambda b: 1 / 256)
        here = counts[order].get(context)
        if not here or order >= language.LONG and sum(here.values()) < 2:
            return shorter(byte)
        total, distinct = sum(here.values()), len(here)
        if byte in here:
            return here[byte] / (total + distinct)
        return distinct / (total + distinct) * shorter(byte) / (1 - sum(map(shorter, here)))

    t = fold(text)
    whole = [p(t[-language.ORDER :], b) for b in range(256)]
    assert sum(whole) == pytest.approx(1)
    return -sum(math.log(p(t[i - language.ORDER : i], t[i])) for i in range(language.ORDER, len(t)))


@pytest.mark.parametrize("slice_bytes", [2 << 20, 16])
def test_language_code_lengths(spark, slice_bytes, monkeypatch):
    monkeypatch.setattr(language, "SLICE_BYTES", slice_bytes)
    rng = random.Random(15)
    samples = {"a": ["abcabcabd", "xyz", "Ab" * 9], "b": ["zzz", ""], "c": ["".join(rng.choice("ab é\x00") for _ in range(200)) for _ in range(5)], "d": [""]}
    rows = spark.createDataFrame([(k, t) for k, v in samples.items() for t in v], "lang string, text string").repartition(3)
    model = language.Model(language.count_windows(rows))
    texts = ["abc", "", "zq", "ABcabd", "\x00a", "é b", "".join(rng.choice("abz é") for _ in range(90))]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = model.lengths(np.frombuffer(b"".join(raw), np.uint8), off)
    assert model.languages == [*samples]
    assert got == pytest.approx(np.array([[brute_ppm(v, t) if t else 0.0 for v in samples.values()] for t in texts]))


def brute_contaminated(rows, items):
    """Items of which at least 0.8 of the five-word windows stand in a text, literally."""
    for i, t in rows:
        words = [w.strip(".,;:!?()[]{}\"'«»").lower() for w in WORD.findall(t or "")]
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        hit = False
        for item in items:
            w = [x.strip(".,;:!?()[]{}\"'«»").lower() for x in WORD.findall(item)]
            g = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
            hit |= bool(g) and sum(x in grams for x in g) >= 0.8 * len(g)
        yield i, hit


def test_decontamination(spark, docs, empty):
    q1 = "if a farmer called Tom sells 12 kg of apples to Anna for 30 dollars what is the price of 1 kg of apples"
    q2 = "the river runs past seven mills before it meets the old stone bridge near town"
    bench = spark.createDataFrame([(1, q1), (2, q2), (3, ""), (4, None), (5, q2), (None, q1)], "item_id long, text string")
    filler = "some clean words that nobody asked about in any question at all today. "
    again = q1.replace("Tom", "Bob").replace("Anna", "Mia").replace("12", "45").replace("30", "99").replace("kg", "lb")
    clash = q1.replace("12 kg", "45 lb").replace("1 kg", "3 oz")
    data = [(0, filler + q1 + ". " + filler), (1, filler + again + " " + filler), (2, filler * 5), (3, filler + clash), (4, None), (5, ""), (6, filler + q2.upper()),
            (7, "the river runs past seven mills and nothing else"), (8, q2 + " and " + q2), (0, filler + q1 + ". " + filler), (None, q2)]
    table = spark.createDataFrame(data, "doc_id long, text string")
    for limit in (10, 0):  # broadcast and shuffle
        decontaminate.BROADCAST_ROWS = limit and 200_000
        found = decontaminate.flag_contaminated(table, bench).collect()
        assert len(found) == len(data)
        flagged = Counter(r["doc_id"] for r in found if r["contaminated"])
        assert flagged[0] == 2 and flagged[1] == 1 and flagged[8] == 1 and flagged[None] == 1 and 2 not in flagged and 7 not in flagged and 3 not in flagged
    decontaminate.BROADCAST_ROWS = 200_000
    assert decontaminate.drop_contaminated(table, bench).count() == sum(not r["contaminated"] for r in found)
    assert decontaminate.flag_contaminated(empty, bench).count() == 0
    assert decontaminate.flag_contaminated(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = dict(brute_contaminated(rows_of(docs), [r["text"] for r in bench.collect()]))
    found = {r["doc_id"]: r["contaminated"] for r in decontaminate.flag_contaminated(docs, bench).collect()}
    assert {i for i, hit in want.items() if hit} <= {i for i, hit in found.items() if hit}
    assert sum(found.values()) <= sum(want.values()) + 1


@pytest.mark.parametrize("shards", [16, 3, 1])
def test_sharding(spark, docs, empty, shards):
    found = sharding.shard_documents(docs, shards).collect()
    want = as_bag((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(docs))
    assert as_bag(r[:3] for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and 0 <= r["shard"] < shards and r["grown_shard"] is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(empty, shards).count() == 0


def test_sharding_balance(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, "same text " * 30 if i % 3 == 0 else "x" * rng.randint(0, 400)) for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = sharding.shard_documents(table, 16)
    sizes = [r["b"] for r in found.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 0.04 * sum(sizes) / 16 + 800  # each edge is off by the tolerance at most
    assert sharding.cut_groups(found).first()["cut"] <= 15
    cut = found.groupBy("size", "text_crc32").agg(F.countDistinct("shard").alias("s"), F.sum("size").alias("b")).where("s > 1").collect()
    assert all(r["b"] > 0.01 * sum(sizes) / 16 for r in cut)  # only groups of more bytes than the tolerance
    sharding.write_shards(table, str(tmp_path / "out"), 16)
    assert as_bag(spark.read.parquet(str(tmp_path / "out")).select("doc_id", "text").collect()) == as_bag(rows)


def test_sharding_string_ids(spark):
    table = spark.createDataFrame([(f"id{i}", "text " * (i % 5)) for i in range(200)] + [(None, None)], "doc_id string, text string")
    found = sharding.shard_documents(table, 4).collect()
    assert len(found) == 201 and {r["shard"] for r in found} == {0, 1, 2, 3}


def brute_url(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_url_filter(spark, broadcast, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", broadcast)
    urls = ["http://a.example.com/en/1", "https://WWW.Example.com/en/", "https://www.example.com/en/2?x=/en/", "http://x.net/fr/9#t", "http://x.net/frx", "http://net/es/",
            "http://example.com", "http://example.com?x", "http://example.com/EN/", None, "", "no url", "://h.com/a", "a://b://c.com/", "http://notexample.com/en/", "http://x.org/\n/y",
            "http://com/", "http://.com/a", "http://example.com/en", "http://a..example.com/en/x", "http://x.net/es/" + "y" * 5000]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[3], "h")], "page_id long, url string, host string")
    rules = spark.createDataFrame([*URL_RULES, (None, "/", "block"), ("net", "/es/", "block")], "host string, path string, verdict string")
    want = as_bag((r["page_id"], *brute_url(r["url"], URL_RULES)) for r in pages.collect())
    assert as_bag(url_filter.filter_urls(pages, rules).collect()) == want
    assert url_filter.filter_urls(pages, rules.limit(0)).where("verdict != 'allow'").count() == 0
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
