"""Copies of benchmark items that are short, in capitals, or inside a sentence."""

import random
import re

import pytest

from vigil.llm import decontaminate

ITEMS = [(1, "Who wrote Hamlet?"), (2, "Name the longest river in Africa"), (3, "the river runs past seven mills before it meets the old stone bridge near town"), (4, "42"), (5, "How many legs does Anna have")]
FILL = "some clean words that nobody asked about at all "
TEXTS = {
    "short": (FILL + "and Who wrote Hamlet? " + FILL, {1}), "short alone": ("Who wrote Hamlet?", {1}), "short capitals": (FILL + "WHO WROTE HAMLET " + FILL, {1}), "other short": (FILL + "Tom wrote plays", set()),
    "six words": (FILL + "so Name the longest river in Africa " + FILL, {2}), "six words title": (FILL + "Name The Longest River In Africa", {2}), "capitals": (FILL + ITEMS[2][1].upper(), {3}),
    "title": (FILL + ITEMS[2][1].title() + " " + FILL, {3}), "other number": (FILL + "17 " + FILL, set()), "number": (FILL + "42 " + FILL, {4}), "renamed": (FILL + "How many legs does Bob have " + FILL, {5}), "clean": (FILL * 3, set()), "none": (None, set())}


@pytest.mark.parametrize("limit", [200_000, 0])
def test_copies(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = decontaminate.with_row_keys(spark.createDataFrame([(k, t) for k, (t, _) in TEXTS.items()], "doc_id string, text string"))
    found = {k: set() for k in TEXTS}
    for r in docs.join(decontaminate.contaminations(docs, bench), ["k1", "k2"]).collect():
        found[r["doc_id"]].add(r["item_id"])
    assert found == {k: want for k, (_, want) in TEXTS.items()}


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_form(text):
    """(template word, value) of each word; names are 3, numbers 1, units 2."""
    raw = [w.strip(decontaminate._OUTER) for w in WORDS.findall(text or "")]
    number = lambda x: ("0" <= x[:1] <= "9") or x.lower().split("-")[0] in decontaminate.SPELLED
    out = []
    for i, x in enumerate(raw):
        if number(x):
            out.append((1, x.lower()))
        elif x.lower() in decontaminate.UNITS and i and number(raw[i - 1]):
            out.append((2, x.lower()))
        elif len(x) > 1 and x[0] != x[0].lower() and x[1:] == x[1:].lower():
            out.append((3, x.lower()))
        else:
            out.append((x.lower(), x.lower()))
    return out


def brute_coverage(doc, item, window=5):
    """Share of the item's windows in the text at alignments whose slot values stand for each other one to one."""
    d, t = brute_form(doc), brute_form(item)
    n = min(window, len(t))
    if not n or len(d) < n:
        return 0.0
    found = set()
    for shift in range(-len(t), len(d)):
        at, pairs = set(), set()
        for i in range(len(t) - n + 1):
            if not 0 <= i + shift <= len(d) - n:
                continue
            item_words, doc_words = t[i : i + n], d[i + shift : i + shift + n]
            for plain in (False, True):  # the document's names as slots, or as words
                seen = [(v if c == 3 and plain else c, v) for c, v in doc_words]
                slots = all(c in (1, 2, 3) for c, _ in seen)
                good = all((a == b if b in (1, 2) or a in (1, 2) else b in (a, v) if a == 3 else a == b) for (a, v), (b, _) in zip(item_words, seen, strict=True))
                if good and (not slots or [v for _, v in item_words] == [v for _, v in seen]):
                    at.add(i)
                    pairs |= {(v, w) for (_, v), (b, w) in zip(item_words, seen, strict=True) if b in (1, 2, 3)}
        if len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}):
            found |= at
    return len(found) / (len(t) - n + 1)


def test_against_brute_force(spark):
    """Random templates asked again with other values, clashing values, in other cases, and cut short."""
    rng = random.Random(21)
    names, units, plain = ["Tom", "Anna", "Élodie", "Bob", "Kim"], ["kg", "miles", "hours"], "the a of farm sells apples train leaves how many does cost if and then each NASA McKay o'clock".split()
    number = lambda: rng.choice([str(rng.randint(2, 99)), f"${rng.randint(2, 9)}", f"-{rng.randint(2, 9)}", "three", "twenty-one", "5%", "3rd"])

    def word():
        return rng.choice([number, lambda: f"{number()} {rng.choice(units)}", lambda: rng.choice(names), *[lambda: rng.choice(plain)] * 4])()

    items = [" ".join(word() for _ in range(rng.randint(2, 14))) for _ in range(30)] + ["Tom Anna Bob Kim Tom", "7 8 9"]

    def again(t):
        w = t.split()
        for k, x in enumerate(w):
            if rng.random() < 0.4:
                w[k] = number() if brute_form(x)[0][0] == 1 else rng.choice(names) if x in names else rng.choice(units) if x in units else x if rng.random() < 0.9 else rng.choice(plain)
        return " ".join(w)

    docs = []
    for _ in range(120):
        t = rng.choice(items)
        t = rng.choice([again, again, again, str.upper, str.lower, str.title, lambda x: x, lambda x: x[: len(x) // 2]])(t)
        docs.append(f"{' '.join(word() for _ in range(rng.randint(0, 6)))} {t} {' '.join(word() for _ in range(rng.randint(0, 6)))}")
    bench = spark.createDataFrame([(f"q{k:02d}", t) for k, t in enumerate(items)], "item_id string, text string")
    table = decontaminate.with_row_keys(spark.createDataFrame([*enumerate(docs)], "doc_id long, text string"))
    first: dict = {}
    for k, t in enumerate(items):  # an item whose words are repeated counts once
        first.setdefault(tuple(WORDS.findall(t)), k)
    want = {(i, f"q{k:02d}"): c for i, d in enumerate(docs) for k in first.values() if (c := brute_coverage(d, items[k])) >= 0.8}
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in table.join(decontaminate.contaminations(table, bench), ["k1", "k2"]).collect()}
    assert got == pytest.approx(want) and len(want) > 40


def test_signs_currency_and_ids(spark):
    items = [("a", "A pen costs $5 and a book costs $7 so what do both cost"), ("b", "It was -3 degrees at dawn and three degrees warmer at noon so how warm was noon")]
    texts = ["A pen costs $8 and a book costs $9 so what do both cost", "it was +2 degrees at dawn and nine degrees warmer at noon so how warm was noon", "A pen costs $8 and a book costs $8 so what do both cost"]
    found = decontaminate.flag_contaminated(spark.createDataFrame([*zip("xyz", texts, strict=True)], "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert {r["doc_id"]: r["item_id"] for r in found} == {"x": "a", "y": "b", "z": None}  # z asks with one value for two
