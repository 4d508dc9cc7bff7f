"""Pattern matches with their places, by Arrow batches: linear in a text, however many matches it has.

Spark's own functions give matches without their places; places made of the lengths before each match cost the square of
their number. Only lines that can hold a match come here, and what matches mean is judged by columns again.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

# types as objects, since tasks import this module without a session that could read their names
_PLACE = StructType().add("prio", IntegerType()).add("start", IntegerType()).add("end", IntegerType())
MATCH = ArrayType(_PLACE.add("kind", StringType()).add("raw", StringType()))
FOUND = ArrayType(StructType([*MATCH.elementType.fields]).add("before", StringType()))
#: Characters before a match that tell a version number or a file's name.
BEFORE = 200


def python_pattern(pattern: str) -> re.Pattern:
    """A pattern written for Spark: (?U) means Unicode classes, without it classes are ASCII."""
    flags = re.match(r"\(\?([iU]+)\)", pattern)
    letters = flags[1] if flags else ""
    return re.compile(pattern[flags.end() if flags else 0 :], (re.I if "i" in letters else 0) | (0 if "U" in letters else re.A))


def _lists(counts: list[int], valid: list[bool], fields: dict[str, pa.Array]) -> pa.Array:
    ends = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(list(fields.values()), list(fields)), mask=pa.array([not v for v in valid], pa.bool_()))


def matches(patterns: tuple[tuple[int, str, str], ...]):
    """Function of a text column: array of FOUND for all matches of the patterns (precedence, kind, pattern), pattern by pattern; null for null. Places are 0-based."""
    @arrow_udf(FOUND)
    def run(text: pa.Array) -> pa.Array:
        compiled = [(prio, kind, python_pattern(p)) for prio, kind, p in patterns]
        counts, valid, rows = [], [], []
        for line in text.to_pylist():
            before = len(rows)
            if line is not None:
                for prio, kind, pattern in compiled:
                    for m in pattern.finditer(line):
                        start, end = m.span()
                        rows.append((prio, start, end, kind, m[0], line[max(0, start - BEFORE) : start]))
            counts.append(len(rows) - before)
            valid.append(line is not None)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
        return _lists(counts, valid, {n: pa.array(c, t) for n, c, t in zip(("prio", "start", "end", "kind", "raw", "before"), columns, types, strict=True)})

    return run


@arrow_udf(MATCH)
def without_overlaps(found: pa.Array) -> pa.Array:
    """Of matches in order of precedence those that overlap none taken before them; the taken ones are kept by place, so each looks at its neighbours alone."""
    values, offsets = found.values, found.offsets.to_numpy()
    start, end = values.field("start").to_numpy(), values.field("end").to_numpy()
    keep, counts = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        starts, ends, n = [], [], len(keep)
        for k in range(a, b):
            at = bisect_left(starts, start[k])
            if (at == 0 or ends[at - 1] <= start[k]) and (at == len(starts) or starts[at] >= end[k]):
                starts.insert(at, start[k])
                ends.insert(at, end[k])
                keep.append(k)
        counts.append(len(keep) - n)
    taken = values.take(pa.array(keep, pa.int64()))
    return _lists(counts, found.is_valid().to_pylist(), {n: taken.field(n) for n in ("prio", "start", "end", "kind", "raw")})


@arrow_udf(ArrayType(IntegerType()))
def first_lines(lines: pa.Array, needles: pa.Array) -> pa.Array:
    """For each of a row's needles the first of its lines that contains it (0-based; null: none), all needles in one pass over the lines."""
    out = []
    for text, wanted in zip(lines.to_pylist(), needles.to_pylist(), strict=True):
        first: dict[str, int] = {"": 0} if text else {}
        words = {w for w in wanted or [] if w}
        if words and text:
            automaton = ahocorasick.Automaton()
            for w in words:
                automaton.add_word(w, w)
            automaton.make_automaton()
            for k, line in enumerate(text):
                for _, w in automaton.iter(line or ""):
                    first.setdefault(w, k)
        out.append([None if w is None else first.get(w) for w in wanted or []])
    return pa.array(out, pa.list_(pa.int32()))


def found_in(text: Column, patterns: tuple[tuple[int, str, str], ...]) -> Column:
    return matches(patterns)(text)
