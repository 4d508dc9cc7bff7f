"""Language ID by prediction by partial matching.

Each language has a tree of byte contexts of up to ORDER bytes, counted on a bounded sample
of its labelled texts and then frozen. A text is coded byte by byte, as if ORDER zero bytes
stood in front of it (A-Z count as a-z). A byte that the longest known context has seen n
times gets n / (total + distinct); one that it has not seen is coded by an escape
(distinct / (total + distinct), method C) and the next shorter context, with the bytes that
the longer one knows excluded; below the empty context all 256 bytes are alike. As nothing
is updated, every (context, byte) has one exact code length. The language with the shortest
code of the whole text is predicted.

The trees are kept as sorted arrays, one pair an order: (context, byte) with its code length,
and context with the length of its escape. A task takes the distinct windows of ORDER + 1
bytes of some megabytes of text, shortens them order by order, and looks each up once.

The sample: SAMPLE_BYTES of text in all languages together, an equal share for each; where a
language has more, the rows whose hash of doc_id and text is smallest. Of a longer text the
first TEXT_CHARS characters are learned from. Contexts of three bytes or more that occur
once are left out. So the trees have at most SAMPLE_BYTES * (ORDER + 1) entries of 16 bytes,
however many languages or documents there are, and every language has a tree.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; without any
labelled row all texts are ``und``; equal code lengths give the first language by name;
a language whose labelled texts are all empty codes every byte at eight bits; texts of any
length are read whole; repeated rows are judged one by one; columns besides doc_id, text
and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.arrow_text import byte_slices, text_bytes

ORDER = 4
SAMPLE_BYTES, TEXT_CHARS = 8 << 20, 16_384
#: Contexts of at least so many bytes are kept only if they occur twice.
LONG = 3
SLICE_BYTES = 2 << 20
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)


def windows(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """At every byte the ORDER bytes before it and the byte itself as one number; texts are preceded by zeros."""
    byte = _FOLD[data]
    out = byte.copy()
    start = np.zeros(len(data), np.int64)
    begins = off[:-1][off[:-1] < off[1:]]
    start[begins[1:]] = np.diff(begins)
    place = np.arange(len(data)) - (np.cumsum(start) + (begins[0] if len(begins) else 0))
    for k in range(1, ORDER + 1):
        before = np.zeros(len(data), np.uint64)
        before[k:] = byte[:-k]
        before[place < k] = 0
        out |= before << np.uint64(8 * k)
    return out


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 8 * (order + 1)) - 1)


class Tree:
    """Frozen statistics of one language: by order, ``seen`` (context and byte, nats) and ``escape`` (context, nats)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """keys: distinct windows in ascending order."""
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []
        self.escape: list[tuple[np.ndarray, np.ndarray]] = []
        lower = None
        for order in range(ORDER + 1):
            key, of = np.unique(keys & _mask(order), return_inverse=True)
            n = np.bincount(of, counts, len(key))
            if order >= LONG:
                _, of, total = self._contexts(key, n)
                key, n = key[total[of] > 1], n[total[of] > 1]
            context, of, total = self._contexts(key, n)
            distinct = np.bincount(of, minlength=len(context))
            p = n / (total + np.where(distinct < 256, distinct, 0))[of]
            shorter = 1 / 256 if lower is None else lower[1][np.searchsorted(lower[0], key & _mask(order - 1))]
            rest = 1 - np.bincount(of, np.broadcast_to(shorter, len(key)), len(context))  # what the shorter context leaves to other bytes
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(distinct < 256, -np.log(distinct / (total + distinct) / rest), 0.0)
            self.seen.append((key, -np.log(p)))
            self.escape.append((context, escape))
            lower = key, p

    @staticmethod
    def _contexts(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        context, of = np.unique(key >> np.uint64(8), return_inverse=True)
        return context, of, np.bincount(of, n, len(context))

    def nats(self, keys: list[np.ndarray], parent: list[np.ndarray]) -> np.ndarray:
        """Code lengths of ``keys[ORDER]``; ``keys[k]`` are distinct windows of order k, ``parent[k]`` their places in ``keys[k - 1]``."""
        out = np.full(1, np.log(256))
        for order in range(ORDER + 1):
            context, nats = self.escape[order]
            out = out[parent[order]]
            if not len(context):
                continue
            mine = keys[order] >> np.uint64(8)
            at = np.minimum(np.searchsorted(context, mine), len(context) - 1)
            out += np.where(context[at] == mine, nats[at], 0.0)
            seen, nats = self.seen[order]
            at = np.minimum(np.searchsorted(seen, keys[order]), len(seen) - 1)
            out = np.where(seen[at] == keys[order], nats[at], out)
        return out

    def nbytes(self) -> int:
        return sum(x.nbytes for pair in self.seen + self.escape for x in pair)


class Model:
    """A tree for each language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        self.trees = [Tree(*counts[name]) for name in self.languages]

    def lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length in nats of every text (rows) under every language."""
        out = np.zeros((len(off) - 1, len(self.languages)))
        for i, j in byte_slices(off, SLICE_BYTES):
            cut = off[i : j + 1] - off[i]
            full = np.flatnonzero(np.diff(cut))
            if not len(full):
                continue
            key, of = np.unique(windows(data[off[i] : off[j]], cut), return_inverse=True)
            keys, parent = [key], []
            for order in range(ORDER - 1, -1, -1):
                shorter, place = np.unique(keys[0] & _mask(order), return_inverse=True)
                keys.insert(0, shorter)
                parent.insert(0, place)
            parent.insert(0, np.zeros(len(keys[0]), np.int64))
            for k, tree in enumerate(self.trees):
                out[i + full, k] = np.add.reduceat(tree.nats(keys, parent)[of], cut[full])
        return out


def count_windows(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By language (``rows`` has lang and text) the distinct windows in ascending order and their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            of = lang.indices.to_numpy(zero_copy_only=False)
            for k, name in enumerate(lang.dictionary.to_pylist()):
                data, off = text_bytes(batch.column("text").take(pa.array(np.flatnonzero(of == k))))
                for i, j in byte_slices(off, SLICE_BYTES):
                    w, n = np.unique(windows(data[off[i] : off[j]], off[i : j + 1] - off[i]), return_counts=True)
                    w, n = np.append(w.astype(np.int64), -1), np.append(n, 0)  # -1: the language has a text
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(w), pa.string()), pa.array(w), pa.array(n.astype(np.int64))], ["lang", "w", "n"])

    table = rows.mapInArrow(run, "lang string, w long, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")).toArrow()
    lang = table.column("lang").combine_chunks().dictionary_encode()
    of, w, n = lang.indices.to_numpy(zero_copy_only=False), table.column("w").to_numpy(), table.column("n").to_numpy()
    out = {}
    for k, name in enumerate(lang.dictionary.to_pylist()):
        mine = np.flatnonzero((of == k) & (w >= 0))
        mine = mine[np.argsort(w[mine])]
        out[name] = w[mine].astype(np.uint64), n[mine]
    return out


def training_sample(docs: DataFrame, allowed: Column) -> DataFrame:
    """(lang, text) of the sample that the module's text describes; ``allowed`` is a condition on doc_id."""
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.left("text", F.lit(TEXT_CHARS)).alias("text"), F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).alias("_h"))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("_bytes"), F.min("_h").alias("_least"))
    languages = sizes.count()
    share = F.least(F.lit(1.0), F.lit(SAMPLE_BYTES / max(1, languages)) / F.greatest(F.col("_bytes"), F.lit(1)))
    limit = sizes.select("lang", F.greatest((share * F.lit(float(1 << 62))).cast("long"), "_least").alias("_limit"))
    return rows.join(limit, "lang").where("_h <= _limit").select("lang", "text")


def fit(docs: DataFrame, allowed: Column) -> Model | None:
    """Trees of the labelled rows; ``allowed`` is a condition on doc_id."""
    counts = count_windows(training_sample(docs, allowed))
    return Model(counts) if counts else None


def predict_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """Return doc_id, lang_pred and score (posterior of the best language under equal priors) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            text = batch.column("text")
            lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in text.to_pylist()], bool)
            if model is None:
                lettered[:] = False
                names, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                nats = model.lengths(*text_bytes(text))
                best = nats.argmin(1)
                odds = np.exp(-np.minimum(nats - nats.min(1, keepdims=True), 700)).sum(1)
                names = [model.languages[k] if ok else "und" for k, ok in zip(best, lettered, strict=True)]
                score = np.where(lettered, 1 / odds, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify_language(docs: DataFrame, allowed: Column) -> DataFrame:
    """Fit on the rows that ``allowed`` (a condition on doc_id) admits and predict every row."""
    return predict_language(docs, fit(docs, allowed))
