"""Exact substring removal: threshold-bounded interval expansion on Burrows-Wheeler transforms.

Every byte covered by a string of ``length`` bytes that starts anywhere else too is
removed. Steps:

1. Each window of ``length`` bytes is named after its anchor, the 32-byte string in it
   with the smallest hash (leftmost on ties). The anchor depends on the window's bytes
   alone, so equal windows have equal anchors. Windows in a row with one anchor form a
   run; a run travels as (anchor hash, content hash, place), not as text.
2. Anchors that occur once can't repeat and go. Runs with equal content are repeated as
   a whole; they need no text, and thousands of copies collapse in map-side sums.
3. One run of each content is kept for anchors with several contents. Their texts are
   joined in blocks of whole anchors, and each block gets a suffix order and its
   Burrows-Wheeler transform. The intervals of repeated strings, from the longest that
   the suffix order gives for nothing, are extended backwards breadth-first, one byte a
   round, so common prefixes appear by increasing length; at ``length`` the expansion
   stops, and what is left are the repeated windows. An anchor with more than ANCHOR_RUNS contents would not fit a
   block; its windows are counted one by one, by 128-bit hashes, in a shuffle.
4. The removed spans join the texts once.

Rows are known by two hashes of (doc_id, text) and of the text. Equal hashes (of 128
bits or more) count as equal strings.

Edge cases: a null or empty text keeps nothing (no bytes); texts under ``length`` bytes
are kept whole; repeated rows are copies of each other and lose what they share; other
columns than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.arrow_text import byte_slices, frugal, mix, text_bytes
from vigil.plans.materialize import materialize

LENGTH, ANCHOR = 200, 32
#: Contents of one anchor that a block may hold, and bytes from which a block is closed.
ANCHOR_RUNS, BLOCK_BYTES = 3000, 1 << 18
#: Windows of a very long text that are worked at once, and tasks over which a window found very often is dealt.
PIECE, SALTS = 4 << 20, 16
_PLACE_BITS = 28
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def runs_of(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor hash) of the runs of all texts, in ``data``."""
    n_windows = len(data) - length + 1
    if n_windows <= 0 or not (np.diff(off) >= length).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = _VALUE[data]
    for k, step in enumerate(_STEP):
        s = 1 << k
        h = h[:-s] * step + h[s:]
    h = mix(h)
    place = np.uint64((1 << _PLACE_BITS) - 1)
    low = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, length - ANCHOR + 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: n_windows], low[width - span : width - span + n_windows])
    anchor = (low & place).astype(np.int64)
    inside = np.zeros(n_windows + 1, np.int8)
    long = np.diff(off) >= length
    np.add.at(inside, off[:-1][long], 1)
    np.add.at(inside, off[1:][long] - length + 1, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new)
    ends = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    return starts, ends - starts + 1, h[anchor[starts]]


def pieces(data: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, place in it, bytes, offsets) of runs of whole texts, and of a very long text in pieces that share length - 1 bytes, so that each window is in one."""
    for i, j in byte_slices(off):
        part = data[off[i] : off[j]]
        if j > i + 1 or len(part) <= PIECE:
            yield i, 0, part, off[i : j + 1] - off[i]
            continue
        for at in range(0, len(part) - length + 1, PIECE):
            piece = part[at : at + PIECE + length - 1]
            yield i, at, piece, np.array([0, len(piece)])


def _runs(keyed: DataFrame, length: int) -> DataFrame:
    """(h, fh, k1, k2, s, n): anchor hash, content hash, row, first window, windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            for i, begin, part, cut in pieces(data, off, length):
                s, n, h = runs_of(part, cut, length)
                if not len(s):
                    continue
                view = memoryview(np.ascontiguousarray(part))
                fh = np.array([xxh3_64_intdigest(view[a:b]) for a, b in zip(s.tolist(), (s + n + length - 1).tolist(), strict=True)], np.uint64)
                doc = np.searchsorted(cut, s, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(fh.view(np.int64)), pa.array(k1[i + doc]), pa.array(k2[i + doc]),
                     pa.array((begin + s - cut[doc]).astype(np.int32)), pa.array(n.astype(np.int32))], ["h", "fh", "k1", "k2", "s", "n"])

    return keyed.select("k1", "k2", "text").mapInArrow(frugal(run), "h long, fh long, k1 long, k2 long, s int, n int")


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """Positions whose next ``length`` symbols also stand elsewhere. Symbol 0 separates strings and is never matched."""
    n = len(symbols)
    # suffix order by doubling, from seven symbols (of 9 bits) up to at least ``length``
    known = min(7, length)
    rank = np.zeros(n, np.int64)
    for k in range(known):
        rank <<= 9
        rank[: n - k] |= symbols[k:]
    start, interval_of = 0, rank
    while True:
        order = np.argsort(rank)
        value = rank[order]
        dense = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = dense
        if known <= length:
            start, interval_of = known, rank  # the longest prefixes under the threshold whose intervals the order gives for nothing
        if known >= length or dense[-1] == n - 1:
            break
        second = np.zeros(n, np.int64)
        second[: n - known] = rank[known:] + 1
        rank = rank * (n + 1) + second
        known *= 2
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    ends = np.flatnonzero(symbols == 0)
    room = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))  # where each position's string ends
    whole = np.zeros(n, bool)
    whole[: len(room)] = room - np.arange(len(room)) >= start
    if len(room) < n:
        whole[len(room) :] = n - np.arange(len(room), n) >= start
    rows = np.flatnonzero(whole[order]).astype(np.int32)
    interval = interval_of[order[rows]]
    at = np.zeros(n, np.int64)
    depth = start
    while len(rows):
        new = np.concatenate([[True], interval[1:] != interval[:-1]])
        single = new & np.concatenate([new[1:], [True]])
        rows, number = rows[~single], np.cumsum(new)[~single]
        if depth == length:
            return np.sort(order[rows])
        spot = order[rows] - 1
        symbol = symbols[spot]  # the transform: the symbol in front of each suffix
        open_ = (symbol != 0) & (spot >= 0)
        rows = place[spot[open_]]  # where the suffix that starts one earlier stands
        at[rows] = number[open_] << 9 | symbol[open_]
        rows = np.sort(rows)
        interval = at[rows]
        depth += 1
    return np.zeros(0, np.int64)


def _repeated_in_blocks(segments: DataFrame, length: int) -> DataFrame:
    """Spans (k1, k2, s, e) of the repeated windows in the runs that stand alone; ``segments`` has the runs' bytes."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        out: list[list[int]] = [[], [], [], []]
        sizes = np.array([len(r[1]) + 1 for r in rows], np.int64)
        begin = np.cumsum(sizes) - sizes
        symbols = np.frombuffer(b"\0".join(r[1] for r in rows) + b"\0", np.uint8).astype(np.int64) + 1
        symbols[begin + sizes - 1] = 0
        starts = repeated_starts(symbols, length)
        owner = np.searchsorted(begin, starts, "right") - 1
        new = np.flatnonzero(np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(owner) != 0)])) if len(starts) else starts
        for a, b in zip(new.tolist(), np.append(new[1:], len(starts)).tolist(), strict=True):
            _, _, alone, k1, k2, s = rows[owner[a]]
            if alone:
                at = int(starts[a] - begin[owner[a]])
                for column, x in zip(out, (k1, k2, s + at, s + at + b - a - 1 + length), strict=True):
                    column.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["k1", "k2", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "bytes", "alone", "k1", "k2", "s")), strict=True):
                if size > BLOCK_BYTES and held[-1][0] != row[0]:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield block(held)

    dealt = segments.repartition("h").sortWithinPartitions("h")
    return dealt.select("h", "bytes", "alone", "k1", "k2", "s").mapInArrow(frugal(run), "k1 long, k2 long, s long, e long")


def _repeated_by_count(segments: DataFrame, length: int) -> DataFrame:
    """As ``_repeated_in_blocks``, for anchors with too many contents: windows are counted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for raw, alone, k1, k2, s in zip(*(batch.column(c).to_pylist() for c in ("bytes", "alone", "k1", "k2", "s")), strict=True):
                n = len(raw) - length + 1
                w = np.frombuffer(b"".join(xxh3_128_digest(raw[i : i + length]) for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[:, 0]), pa.array(w[:, 1]), pa.array([alone] * n), pa.array([k1] * n), pa.array([k2] * n), pa.array(np.arange(s, s + n))],
                    ["w1", "w2", "alone", "k1", "k2", "s"])

    windows = segments.select("bytes", "alone", "k1", "k2", "s").mapInArrow(frugal(run), "w1 long, w2 long, alone boolean, k1 long, k2 long, s long")
    # a passage that very many texts share has as many equal windows; they are dealt over SALTS tasks, the list of windows goes to each
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("w1", "w2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = windows.where("alone").withColumn("salt", F.pmod(F.xxhash64("k1", "s"), F.lit(SALTS)).cast("int"))
    return dealt.join(often, ["w1", "w2", "salt"], "left_semi").select("k1", "k2", "s", (F.col("s") + length).alias("e"))


def _with_keys(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"text": text, "k1": F.xxhash64("doc_id", text), "k2": F.xxhash64(F.lit(5), text, F.octet_length(text))})


def repeated_spans(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, s, e): bytes s to e - 1 of a row are covered by a repeated string; spans may overlap. ``keyed`` has doc_id, text, k1, k2."""
    runs = _runs(keyed, length)
    anchors = runs.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("fh").alias("f1"), F.max("fh").alias("f2")).where("c > 1")
    # written, so that the join below has an exchange of its own and its hot anchors can be split
    anchors = materialize(anchors.select("h", (F.col("f1") == F.col("f2")).alias("one")), "anchors")
    kept = materialize(runs.join(anchors, "h"), "runs")
    span = ["k1", "k2", F.col("s").cast("long").alias("s"), (F.col("s") + F.col("n") + length - 1).cast("long").alias("e")]
    several = kept.where("NOT one")
    # written for the same reason: thousands of copies share a content
    contents = materialize(several.groupBy("h", "fh").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("k1", "k2", "s", "n")).alias("r")), "contents")
    # where every content occurs twice, all is known
    spread = contents.groupBy("h").agg(F.count(F.lit(1)).alias("contents"), F.min("c").alias("least")).where("least = 1")
    chosen = contents.join(spread, "h").select("h", (F.col("c") == 1).alias("alone"), (F.col("contents") > ANCHOR_RUNS).alias("hot"), "r.*")
    wanted = chosen.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "alone", "hot", "s", "n")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "alone", "hot", "s", "bytes", "k1", "k2"]
        for batch in batches:
            out = []
            for text, runs_, k1, k2 in zip(*(batch.column(c).to_pylist() for c in ("text", "runs", "k1", "k2")), strict=True):
                raw = text.encode()
                out += [(r["h"], r["alone"], r["hot"], r["s"], raw[r["s"] : r["s"] + r["n"] + length - 1], k1, k2) for r in runs_]
            kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    texts = keyed.join(wanted, ["k1", "k2"]).select("doc_id", "text", "k1", "k2", "runs").dropDuplicates(["k1", "k2"])
    segments = materialize(texts.mapInArrow(frugal(cut), "h long, alone boolean, hot boolean, s long, bytes binary, k1 long, k2 long"), "segments")
    whole = kept.where("one").select(*span).unionByName(
        several.join(contents.where("c > 1").select("h", "fh"), ["h", "fh"], "left_semi").select(*span))
    return whole.unionByName(_repeated_in_blocks(segments.where("NOT hot"), length)).unionByName(_repeated_by_count(segments.where("hot"), length))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: tuple[str, ...] = ()) -> DataFrame:
    """Return doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text and the columns ``keep`` of every row.

    kept_text holds the remaining bytes as text; parts of characters that a cut left over are dropped from it (not from
    kept_sha256). It is null where the text was.
    """
    keyed = _with_keys(docs.select("doc_id", "text", *keep).withColumn("_null", F.col("text").isNull()))
    spans = repeated_spans(keyed.select("doc_id", "text", "k1", "k2"), length)
    spans = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    columns = [f for f in docs.schema if f.name == "doc_id" or f.name in keep]
    names = [f.name for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, null, found in zip(*(batch.column(c).to_pylist() for c in ("text", "_null", "spans")), strict=True):
                raw = text.encode()
                gone = _merged(found or [])
                edges = [0, *(x for g in gone for x in g), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(raw), len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest(), None if null else left.decode(errors="ignore")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))],
                [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    return keyed.join(spans, ["k1", "k2"], "left").select(*names, "text", "_null", "spans").mapInArrow(
        frugal(run), f"{schema}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
