"""Benchmark decontamination by template canonicalisation.

Words lose their outer punctuation, signs and currency marks. Numbers (digits in front, or
spelled out) turn into a number slot, a unit after a number into a unit slot, and a word with a
capital in front and small letters behind into a name slot; all else is lower-cased. Windows of
WINDOW such words of the documents are hash-joined with those of the benchmark items.

Whether a capital means a name can't be told at the start of a sentence or in a title, so an item's
window is listed in every form in which each of its names is a slot or a plain word, and a
document's window is looked up with its names as slots and with all of them plain. Copies in
capitals, in title case, in small letters or in the middle of a sentence are the item's too.
A window of slots alone counts only as it is written.

A window brings the values of its slots along. At one alignment (document position minus item
position) the values must stand for each other one to one: an item's value always for the same
value of the document, and no two for one; else the alignment doesn't count. A document holds an
item if at least SIMILARITY of the item's windows are in it, at alignments that are consistent. So
a question asked again with other numbers, names or units is caught, and a chance mix of matching
windows with clashing values is not.

Only SQL functions and joins are used. A bitmap of the items' window hashes, at most 2 **
MOST_BITS bits, drops most other windows where they are made; the join decides. The benchmark's windows
are broadcast while they are fewer than BROADCAST_ROWS; beyond, the join shuffles.

Edge cases: a null text or one without a word holds nothing; an item of fewer words than
a window is one window of all its words, which the documents' windows of as many words meet;
items without a word are ignored; repeated rows are judged alike; an empty benchmark leaves
all documents clean; ids may be of any type; columns besides doc_id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.names import free_names
from vigil.plans.materialize import materialize

WINDOW, SIMILARITY = 5, 0.8
BROADCAST_ROWS = 200_000
#: log2 of the bits of the bitmap: for few windows, and at most; between them there are 16 bits or more a window.
LEAST_BITS, MOST_BITS = 14, 20
#: Words taken for units when a number stands before them.
UNITS = ("%", "cm", "m", "km", "mm", "g", "kg", "mg", "t", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "hour", "minutes", "days", "day", "weeks",
         "months", "years", "year", "miles", "mile", "feet", "foot", "ft", "inches", "inch", "usd", "eur", "dollars", "euros", "cents", "°c", "°f", "k", "hz", "khz", "mhz", "w", "kw", "v", "kb", "mb", "gb")
#: Spelled-out numbers; joined ones (twenty-one) are known by their first part.
SPELLED = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen",
           "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion")
#: Characters that don't count at either end of a word: punctuation, signs, currency marks.
_OUTER = ".,;:!?()[]{}\"'«»$€£¥+-−~#"
#: Template words of slots; other words have their 64-bit hash.
_NUM, _UNIT, _NAME = 1, 2, 3


def _words(text: Column) -> Column:
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def with_templates(df: DataFrame) -> DataFrame:
    """From the words ``w`` add ``raw`` (without outer marks), ``lw`` (hashes of them in small letters), ``wt`` (template words) and ``wl`` (those with names as plain words).

    Tests that most words fail stand first, as these expressions run for every word of the corpus.
    """
    quoted = _OUTER.replace("'", "\\'")
    hashed = lambda words: ", ".join(f"xxhash64('{x}')" for x in words)
    df = df.withColumn("raw", F.expr(f"transform(w, x -> trim(BOTH '{quoted}' FROM x))"))
    df = df.withColumn("lw", F.expr("transform(raw, x -> xxhash64(lower(x)))"))
    number = lambda x, h: f"({x} >= '0' AND {x} < ':' OR {h} IN ({hashed(SPELLED)}) OR contains({x}, '-') AND xxhash64(lower(substring_index({x}, '-', 1))) IN ({hashed(SPELLED)}))"
    capital = "(x >= 'A' AND x < '[' OR x > '~' AND substr(x, 1, 1) != lower(substr(x, 1, 1)))"
    df = df.withColumn("wt", F.expr(
        f"transform(raw, (x, i) -> CASE WHEN {number('x', 'get(lw, i)')} THEN {_NUM}L WHEN get(lw, i) IN ({hashed(UNITS)}) AND {number('get(raw, i - 1)', 'get(lw, i - 1)')} THEN {_UNIT}L "
        f"WHEN {capital} AND char_length(x) > 1 AND substr(x, 2) = lower(substr(x, 2)) THEN {_NAME}L ELSE get(lw, i) END)"))
    return df.withColumn("wl", F.expr(f"CASE WHEN array_contains(wt, {_NAME}L) THEN transform(wt, (h, i) -> CASE WHEN h = {_NAME} THEN get(lw, i) ELSE h END) END"))


def _with_window_hashes(df: DataFrame, words: str, lengths: list[int], name: str) -> DataFrame:
    """Add name1, name2, ...: by position the hash of the window of so many ``words``, made of those of its parts. Windows that don't fit have some hash too."""
    step = {1: (1, 0), 2: (1, 1), 3: (2, 2), 4: (2, 2), 5: (4, 4)}  # length: that of the first part, where the second begins
    second = {2: 1, 3: 1, 4: 2, 5: 1}
    needed = {1, *lengths} | {2 for n in lengths if n > 2} | {4 for n in lengths if n > 4}
    df = df.withColumn(f"{name}1", F.col(words))
    for n in sorted(needed - {1}):
        first, at = step[n]
        df = df.withColumn(f"{name}{n}", F.expr(f"transform({name}{first}, (h, i) -> xxhash64(h, get({name}{second[n]}, i + {at})))"))
    return df


def _slots_only(cells: list[str]) -> str:
    return " AND ".join(f"{c} BETWEEN 1 AND 3" for c in cells)


def _written(plain: list[str]) -> str:
    """SQL of the hash of a window of slots alone: of its words as written."""
    return f"xxhash64(0L, {', '.join(plain)})"


def _slots(cells: list[str], values: list[str]) -> str:
    return f"lower(concat_ws('\\u0001', {', '.join(f'CASE WHEN {c} BETWEEN 1 AND 3 THEN {v} END' for c, v in zip(cells, values, strict=True))}))"


def _cells(array: str, i: str, n: int) -> list[str]:
    return [f"get({array}, {i} + {k})" for k in range(n)]


def _known(h: str, bits: int) -> str:
    """SQL: the bit of the hash ``h`` is set in ``bitmap``."""
    return f"(get(bitmap, cast(shiftrightunsigned({h}, {70 - bits}) AS int)) & shiftleft(1L, cast(shiftrightunsigned({h}, {64 - bits}) & 63L AS int))) != 0L"


def _document_windows(n: int, bits: int) -> str:
    """SQL of an array of (h, pos, slots): the windows of ``n`` words with names as slots, and with plain ones, that the bitmap lets through."""
    parts = []
    for name, array, differs in (("a", "wt", "true"), ("b", "wl", f"h != get(a{n}, i)")):
        places = f"array_compact(transform({name}{n}, (h, i) -> CASE WHEN {differs} AND {_known('h', bits)} AND i <= size(wt) - {n} THEN i END))"
        cells = _cells(array, "p", n)
        h = f"CASE WHEN {_slots_only(cells)} THEN {_written(_cells('lw', 'p', n))} ELSE get({name}{n}, p) END"
        parts.append(f"coalesce(transform({places}, p -> struct({h} AS h, p AS pos, {_slots(cells, _cells('raw', 'p', n))} AS slots)), array())")
    return f"concat({', '.join(parts)})"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, item_windows, words, shape, h, item_pos, item_slots), one row a window and form of it; ``shape`` is the hash of its template words, ``h`` what it is joined on."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", _words(F.col("text")).alias("w")).where("size(w) > 0")
    # an item text that is repeated counts once
    items = with_templates(items.groupBy("w").agg(F.min("item_id").alias("item_id"))).withColumn("wl", F.coalesce("wl", "wt"))

    def cut(n: int) -> DataFrame:
        rows = items.where(F.size("w") >= n) if n == window else items.where(F.size("w") == n)
        rows = rows.withColumn("i", F.explode(F.expr(f"sequence(0, size(w) - {n})"))).withColumn("form", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
        names_alone = " AND ".join(f"((form & {1 << k}) = 0 OR {c} = {_NAME})" for k, c in enumerate(_cells("wt", "i", n)))
        cells = [f"CASE WHEN (form & {1 << k}) != 0 THEN {_NAME}L ELSE {c} END" for k, c in enumerate(_cells("wl", "i", n))]
        rows = rows.where(names_alone).withColumn("cells", F.expr(f"array({', '.join(cells)})"))
        rows = _with_window_hashes(rows, "cells", [n], "a")
        own = _cells("cells", "0", n)
        return rows.select(
            "item_id", (F.size("w") - n + 1).alias("item_windows"), F.lit(n).alias("words"), F.expr(f"get(a{n}, 0)").alias("shape"),
            F.expr(f"CASE WHEN {_slots_only(own)} THEN {_written(_cells('lw', 'i', n))} ELSE get(a{n}, 0) END").alias("h"), F.col("i").alias("item_pos"), F.expr(_slots(own, _cells("raw", "i", n))).alias("item_slots"))

    return reduce(DataFrame.unionByName, map(cut, range(1, window + 1))).distinct()


def contaminations(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(k1, k2, item_id, coverage): the rows (by hashes of doc_id and text) that hold a benchmark item. ``docs`` has k1, k2 and text."""
    wanted = materialize(benchmark_windows(benchmark, window), "items")
    sizes = wanted.groupBy("words").count().collect()
    n, lengths = sum(r["count"] for r in sizes), sorted({window, *(r["words"] for r in sizes)})
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    # one row a word of the bitmap: bounded whatever the benchmark's size
    place = F.shiftrightunsigned("shape", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    bitmap = [0] * (1 << bits - 6)
    for r in wanted.groupBy(F.shiftrightunsigned(place, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).collect():
        bitmap[r["at"]] = r["bits"]
    wanted = wanted.drop("words", "shape").distinct()
    side = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted
    words = docs.select("k1", "k2", _words(F.coalesce("text", F.lit(""))).alias("w"))
    words = with_templates(words).withColumn("bitmap", F.from_json(F.lit(str(bitmap)), "array<bigint>"))
    words = _with_window_hashes(_with_window_hashes(words, "wt", lengths, "a"), "wl", lengths, "b")
    # exploded outer: for ``inline`` the optimizer would test the array's size first, by all its expressions again
    win = F.expr(f"concat({', '.join(_document_windows(k, bits) for k in lengths)})")
    grams = words.withColumn("win", win).select("k1", "k2", F.inline_outer("win"))
    met = grams.join(side, "h").select(
        "k1", "k2", "item_id", "item_windows", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos",
        F.when(F.col("slots") != "", F.arrays_zip(F.split("item_slots", "\x01").alias("a"), F.split("slots", "\x01").alias("b"))).alias("pairs"))
    aligned = met.groupBy("k1", "k2", "item_id", "item_windows", "shift").agg(
        F.collect_set("item_pos").alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    one_to_one = " AND ".join(f"size(array_distinct(pairs.{side})) = size(pairs)" for side in ("a", "b"))
    per_item = aligned.where(one_to_one).groupBy("k1", "k2", "item_id", "item_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n"))
    return per_item.select("k1", "k2", "item_id", (F.col("n") / F.col("item_windows")).alias("coverage")).where(F.col("coverage") >= similarity)


def row_keys() -> tuple[Column, Column]:
    """Two hashes that name a row by doc_id and text; repeated rows share them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64("doc_id", text), F.xxhash64(F.lit(5), text, F.octet_length(text))


def with_row_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row's keys k1 and k2."""
    k1, k2 = row_keys()
    return docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2"))


def flag_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Return doc_id, contaminated, n_items, item_id (of the fullest match, the smallest on ties) and coverage for every row."""
    keyed = with_row_keys(docs)
    found = contaminations(keyed, benchmark).groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_items"), F.min(F.struct((-F.col("coverage")).alias("minus"), "item_id")).alias("best"))
    return keyed.select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.col("best.item_id").alias("item_id"), (-F.col("best.minus")).alias("coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    names = free_names(docs, "_k1", "_k2")
    found = contaminations(with_row_keys(docs), benchmark).select(*(F.col(k).alias(n) for k, n in zip(("k1", "k2"), names, strict=True))).distinct()
    return docs.withColumns(dict(zip(names, row_keys(), strict=True))).join(found, names, "left_anti").select(docs.columns)
