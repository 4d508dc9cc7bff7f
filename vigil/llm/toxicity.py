"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hash buckets of its lower-cased words, word pairs
and pairs with one word between. Training passes over a bounded sample of labelled rows
with a learning rate for every coordinate; the L1 term leaves few weights, which travel
to the tasks as two short arrays. Scoring reads every text whole and needs no shuffle.

The sample holds the MAX_TOXIC toxic and MAX_CLEAN other labelled rows with the smallest
hashes of doc_id, so that it is the same on every run. Of a longer text the model learns
from the first TEXT_CHARS characters; a doc_id whose texts would pass MAX_BYTES together
with those before is left out, and the sample goes on with the next. As the sample holds
more toxic rows than the labels do, the bias is moved by the difference in log odds, so
that a score of 0.5 means even odds among all labelled rows.

Edge cases: a null or empty text has the bias alone as its score; without labels all
scores are 0; repeated rows are scored one by one; columns besides doc_id and text are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.arrow_text import byte_slices, frugal, give_back, mix, text_bytes

BUCKET_BITS = 22
MAX_TOXIC, MAX_CLEAN, MAX_BYTES, TEXT_CHARS = 4000, 6000, 48 << 20, 250_000
EPOCHS, ALPHA, BETA, L1, L2, MIN_TEXTS = 6, 2.0, 1.0, 6.0, 0.01, 6

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_VALUE = mix(_FOLD.astype(np.uint64) + np.uint64(1))
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


@dataclass
class Model:
    """Non-zero weights by bucket, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every word, pair and skip pair; repeats included."""
    inside = _WORD_BYTE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False)) if len(data) else np.zeros(0, np.int64)
    starts_at = edge[inside[edge]] if len(edge) else edge
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]] if len(cuts) else cuts  # words of two texts that touch
    starts = np.union1d(starts_at, cuts) if len(cuts) else starts_at
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.minimum(np.arange(starts[0], len(data)) - np.repeat(starts, lengths), 63)
    value = np.where(inside[starts[0] :], _VALUE[data[starts[0] :]] * _POWER[place], np.uint64(0))
    word = mix(np.add.reduceat(value, starts - starts[0]))
    doc = np.searchsorted(off, starts, "right") - 1
    out_doc, out_bucket = [doc], [word]
    for gap, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        if same.any():
            out_doc.append(doc[gap:][same])
            out_bucket.append(mix(word[:-gap][same] * np.uint64(salt) + word[gap:][same]))
    bucket = (np.concatenate(out_bucket) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    return np.concatenate(out_doc), bucket


def train(rows: list[np.ndarray], labels: list[int], shift: float = 0.0) -> Model:
    """FTRL-proximal over rows of distinct buckets in the order given, EPOCHS times; ``shift`` is added to the learned bias."""
    texts_with = np.zeros(1 << BUCKET_BITS, np.int32)
    for r in rows:
        texts_with[r] += 1
    kept = texts_with >= MIN_TEXTS  # what fewer texts have can only be learned by heart
    used = np.flatnonzero(kept)
    place = np.cumsum(kept, dtype=np.int32)
    rows = [np.append(place[r[kept[r]]] - 1, len(used)).astype(np.int32) for r in rows]  # the last coordinate is the bias
    z, n = np.zeros(len(used) + 1), np.zeros(len(used) + 1)

    def weights(zi: np.ndarray, root: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + root) / ALPHA + L2))

    for _ in range(EPOCHS):
        for r, y in zip(rows, labels, strict=True):
            zr, nr = z[r], n[r]
            root = np.sqrt(nr)
            w = weights(zr, root)
            g = 1 / (1 + np.exp(-min(35.0, max(-35.0, w.sum())))) - y
            n[r] = nr + g * g
            z[r] = zr + g - (np.sqrt(nr + g * g) - root) / ALPHA * w
    w = weights(z, np.sqrt(n))
    keep = np.flatnonzero(w[:-1])
    return Model(used[keep], w[keep], float(w[-1]) + shift)


def distinct_features(rows: DataFrame) -> DataFrame:
    """``rows`` with the distinct buckets of text, as little-endian 32-bit numbers, in place of text."""
    others = [f for f in rows.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            packed: list[bytes] = []
            for i, j in byte_slices(off):
                doc, bucket = features(data[off[i] : off[j]], off[i : j + 1] - off[i])
                pairs = np.unique(doc << BUCKET_BITS | bucket)
                ends = np.searchsorted(pairs, np.arange(j - i + 1) << BUCKET_BITS)
                low = (pairs & ((1 << BUCKET_BITS) - 1)).astype("<i4")
                packed += [low[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), pa.array(packed, pa.binary())], [*(f.name for f in others), "features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.select(*(f.name for f in others), "text").mapInArrow(frugal(run), f"{schema}, features binary")


def training_sample(docs: DataFrame, labels: DataFrame, allowed: Column) -> tuple[DataFrame | None, float]:
    """(rows of _order, _text, toxic and text of the bounded sample, log odds of toxic in all labels less those in the sample).

    ``allowed`` is a condition on doc_id. Without a row of both kinds the sample is None.
    """
    known = labels.where(allowed & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("_order", F.xxhash64("doc_id"))
    picked = known.where("toxic = 1").orderBy("_order", "doc_id").limit(MAX_TOXIC).unionByName(known.where("toxic != 1").orderBy("_order", "doc_id").limit(MAX_CLEAN))
    found = docs.select("doc_id", F.left(F.coalesce("text", F.lit("")), F.lit(TEXT_CHARS)).alias("text")).join(F.broadcast(picked), "doc_id").withColumn("_text", F.xxhash64("text"))
    sizes = found.groupBy("_order", "toxic").agg(F.sum(F.octet_length("text")).alias("n")).orderBy("_order").collect()  # at most MAX_TOXIC + MAX_CLEAN rows
    total, over, used = 0, [], {True: 0, False: 0}
    for r in sizes:
        if total + r["n"] > MAX_BYTES:
            over.append(r["_order"])
        else:
            total += r["n"]
            used[r["toxic"] == 1] += 1
    if not all(used.values()):
        return None, 0.0
    natural = known.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") != 1).alias("c")).first()
    shift = math.log(natural["t"] / natural["c"]) - math.log(used[True] / used[False])
    return found.where(~F.col("_order").isin(over)).select("_order", "_text", "toxic", "text"), shift


def score_texts(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """Add the score, as column ``name``, to the columns ``keep`` of every row; without a model it is 0."""
    columns = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BUCKET_BITS, np.float32)
        if model is not None:
            table[model.buckets] = model.weights
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            total = np.full(batch.num_rows, model.bias if model is not None else 0.0)
            for i, j in byte_slices(off):
                doc, bucket = features(data[off[i] : off[j]], off[i : j + 1] - off[i])
                weight = table[bucket]
                hit = np.flatnonzero(weight)
                pairs = np.unique(doc[hit] << BUCKET_BITS | bucket[hit])
                total[i:j] += np.bincount(pairs >> BUCKET_BITS, table[pairs & ((1 << BUCKET_BITS) - 1)], j - i)
            score = 1 / (1 + np.exp(-np.clip(total, -700, 700))) if model is not None else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score)], [*keep, name])

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns)
    return docs.select(*keep, *(["text"] if "text" not in keep else [])).mapInArrow(frugal(run), f"{schema}, `{name}` double")


def fit(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model | None:
    """Features are taken in the tasks; the driver gets their numbers alone and needs a few bytes for each."""
    sample, shift = training_sample(docs, labels, allowed)
    if sample is None:
        return None
    table = distinct_features(sample).toArrow()
    order = np.lexsort([table.column("_text").to_numpy(), table.column("_order").to_numpy()])
    rows = [np.frombuffer(table.column("features")[int(k)].as_buffer(), "<i4") for k in order]
    toxic = table.column("toxic").to_numpy()[order] == 1
    model = train(rows, toxic.astype(int).tolist(), shift)
    del rows, table
    give_back()
    return model


def held_out(remainder: int = 0, of: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of == remainder


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Return doc_id, held_out, score and predicted; rows held out are never learned from."""
    scored = score_texts(docs, fit(docs, labels, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
