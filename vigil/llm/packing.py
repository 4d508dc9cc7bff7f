"""Best-fit packing with exact complements.

The plan depends on the lengths alone, so it is made on their histogram, which has at
most ``capacity`` entries however many documents there are. For the longest length left,
the gap is looked up in an index of single lengths, pair sums and triple sums that are
available; what fills it exactly is consumed as often as the availability counts allow,
and the index follows the counts. What has no exact complement is packed best-fit
decreasing. Where shorter complements, or none, give fewer sequences, that plan is taken,
so no plan is longer than best-fit decreasing. The plan is a list of patterns with multiplicities; a piece finds its pattern
from its number among the pieces of its length, so hot lengths are numbered in buckets.

Edge cases: a null or empty text is one piece that holds the end id; a longer document
is cut into pieces of the capacity, the last of which may be shorter; repeated rows are
packed one by one; an empty table gives no rows; columns besides doc_id and text are not
read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.arrow_text import byte_slices, frugal, give_back, text_bytes
from vigil.llm.numbering import number_in_group
from vigil.plans.materialize import materialize

END_ID = 1
ROWS_PER_BUCKET = 1000
#: Encoded words that a task keeps, and the longest one kept.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 64
#: Bytes of texts that are encoded at once.
SLICE = 2 << 20
#: Latin letters that keep their number of characters in lower case (all but the dotted capital I), and marks that make no special string.
_LATIN = r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"
LETTERS = re.compile(_LATIN).fullmatch
WORD = rf"^(?P<stem>{_LATIN})(?P<marks>[.,;:!?#$%&*]{{0,4}})$"


def _gather(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` at ``begin`` behind each other, and the len + 1 offsets of them."""
    ends = np.append(0, np.cumsum(size))
    return ids[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])], ends


class WordIds(dict):
    """Word between ASCII white space -> its ids as little-endian bytes.

    The tokenizer drops white space before it merges, so words are independent of each other. It also cuts between letters
    and punctuation and ignores case, so a word of Latin letters with a few marks behind is looked up as lower-case stem and marks.
    A word of letters alone is merged as one piece, whose last id is the only one that ends a word; so new ones are encoded
    many in a line and cut apart at those ids. Arrow cuts texts and parts words, so that Python sees each stem of a column once.
    """

    def __init__(self, tokenizer_file: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        super().__init__()

    def _encode(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_letters(self, stems: list[str]) -> list[bytes]:
        """As ``_encode``, for words that LETTERS matches."""
        out: list[bytes] = []
        for i in range(0, len(stems), 4096):
            part = stems[i : i + 4096]
            ids = np.frombuffer(self._encode([" ".join(part)])[0], "<u4")
            cuts = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(cuts) != len(part) or cuts[-1] != 4 * len(ids):  # another kind of vocabulary
                out += self._encode(part)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]
        return out

    def _ids_of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the different words of ``column``, and for each row where its word's begin and how many there are."""
        coded = column.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self) > CACHE_ENTRIES:
            self.clear()
        new = [w for w in words if w not in self]
        letters = [w for w in new if LETTERS(w)]
        self.update(zip(letters, self._encode_letters(letters), strict=True))
        whole = [w for w in new if w not in self]
        self.update(zip(whole, self._encode(whole), strict=True))
        found = [*map(self.__getitem__, words)]
        for w in new:
            if len(w) > CACHE_CHARS:
                self.pop(w, None)
        size, at = np.fromiter(map(len, found), np.int64, len(found)) >> 2, coded.indices.to_numpy()
        return np.frombuffer(b"".join(found), "<u4"), (np.cumsum(size) - size)[at], size[at]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, len + 1 offsets)."""
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        parts = pc.extract_regex(words, WORD)
        stems, stem_at, stem_size = self._ids_of(pc.if_else(parts.is_valid(), pc.utf8_lower(pc.struct_field(parts, "stem")), words))
        marks, mark_at, mark_size = self._ids_of(pc.if_else(parts.is_valid(), pc.struct_field(parts, "marks"), ""))
        pieces = np.stack([stem_at, mark_at + len(stems)], 1).ravel(), np.stack([stem_size, mark_size], 1).ravel()
        ids, ends = _gather(np.concatenate([stems, marks]), *pieces)
        ends = ends[::2]
        ids, ends = _gather(ids, ends[:-1][at], np.diff(ends)[at])
        return ids, ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, off = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


_tables: dict[str, WordIds] = {}


def word_ids(tokenizer_file: str) -> WordIds:
    """One table a worker process."""
    if tokenizer_file not in _tables:
        _tables[tokenizer_file] = WordIds(tokenizer_file)
    return _tables[tokenizer_file]


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int) -> DataFrame:
    """Cut every document's ids (with the end id) into pieces: doc_id, piece, start, length, ids_crc32."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end = word_ids(tokenizer_file), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            rows = []
            for i, j in byte_slices(text_bytes(texts)[1], SLICE):
                ids, off = table.encode_column(texts.slice(i, j - i))
                for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True), i):
                    last = b - a - (b - a) % capacity  # the piece that takes the end id
                    for piece, at in enumerate(range(0, last + 1, capacity)):
                        part = ids[a + at : min(a + at + capacity, b)].tobytes() + (end if at == last else b"")
                        rows.append((k, piece, at, len(part) // 4, zlib.crc32(part)))
                del ids, off
                give_back()  # slices differ in size, and what the pool keeps of each adds up
            of, *rest = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of)), pa.array(rest[0].astype(np.int32)), *map(pa.array, rest[1:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
        table.clear()

    return docs.select("doc_id", "text").mapInArrow(frugal(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class SumIndex:
    """Lengths that are left, with their numbers, and the sums that two of them make.

    ``pairs[s]`` is the number of different pairs of lengths that are available and sum to ``s``; it follows every change of
    the availability counts. A triple sum is a length and a pair sum.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.avail, self.pairs = capacity, np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.set(length, n)

    def set(self, length: int, n: int) -> None:
        was = int(self.avail[length])
        self.avail[length] = n
        if (was > 0) != (n > 0):
            others = np.flatnonzero(self.avail[: self.capacity - length + 1])
            self.pairs[length + others[others != length]] += 1 if n > 0 else -1
        if 2 * length <= self.capacity and (was > 1) != (n > 1):
            self.pairs[2 * length] += 1 if n > 1 else -1

    def _pairs_of(self, total: int) -> np.ndarray:
        """The larger lengths of the available pairs that sum to ``total``."""
        larger = np.arange((total + 1) // 2, total)
        larger = larger[(self.avail[larger] > 0) & (self.avail[total - larger] > 0)]
        return larger[(2 * larger != total) | (self.avail[larger] > 1)]

    def complement(self, gap: int, most: int) -> tuple[int, ...] | None:
        """At most ``most`` (up to three) available lengths that sum to ``gap``; fewer before more, then those with the longest."""
        if most > 0 and self.avail[gap]:
            return (gap,)
        if most > 1 and self.pairs[gap]:
            x = int(self._pairs_of(gap)[-1])
            return x, gap - x
        if most > 2:
            third = np.flatnonzero(self.avail[:gap])
            for z in third[self.pairs[gap - third] > 0][::-1].tolist():
                for x in self._pairs_of(gap - z)[::-1].tolist():
                    found = (z, x, gap - z - x)
                    if all(found.count(k) <= self.avail[k] for k in found):
                        return found
        return None


def _best_fit(avail: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing: each piece, longest first, goes where the least is left over."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}
    has = np.zeros(capacity + 1, bool)
    done: list[tuple[dict[int, int], int]] = []

    def leave(use: dict[int, int], n: int, gap: int) -> None:
        if gap:
            open_.setdefault(gap, []).append((use, n))
            has[gap] = True
        else:
            done.append((use, n))

    for length in np.flatnonzero(avail)[::-1].tolist():
        left = int(avail[length])
        while left:
            gaps = np.flatnonzero(has[length:])
            if not len(gaps):
                each = min(capacity // length, left)
                leave({length: each}, left // each, capacity - each * length)
                left %= each
                continue
            gap = length + int(gaps[0])
            use, n = open_[gap].pop()
            has[gap] = bool(open_[gap])
            each = min(gap // length, left)
            take = min(n, left // each)
            leave(use | {length: use.get(length, 0) + each}, take, gap - each * length)
            if n > take:
                leave(use, n - take, gap)
            left -= take * each
    return done + [x for rows in open_.values() for x in rows]


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[dict[int, int], int]]:
    """Exact complements of up to ``most`` lengths first, best fit for what has none."""
    index = SumIndex(counts, capacity)
    plan: list[tuple[dict[int, int], int]] = []
    for length in sorted(counts, reverse=True):
        while (n := int(index.avail[length])) and (most or length == capacity):
            index.set(length, n - 1)
            found = index.complement(capacity - length, most) if length < capacity else ()
            index.set(length, n)
            if found is None:
                break
            use = dict(Counter((length, *found)))
            times = int(min(index.avail[x] // k for x, k in use.items()))
            for x, k in use.items():
                index.set(x, int(index.avail[x]) - k * times)
            plan.append((use, times))
    return plan + _best_fit(index.avail, capacity)


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(lengths with their numbers in one sequence, sequences of this pattern)] for a histogram of lengths.

    Complements of many lengths can use up what other lengths need, so plans with complements of up to three, two, one and no
    lengths are made, and the first of those with the fewest sequences is taken.
    """
    counts = {x: n for x, n in counts.items() if n}
    floor = -(-sum(x * n for x, n in counts.items()) // capacity)
    best: tuple[int, list] | None = None
    for most in (3, 2, 1, 0):
        plan = _plan(counts, capacity, most)
        used = sum(times for _, times in plan)
        if best is None or used < best[0]:
            best = used, plan
        if used == floor:
            break
    return best[1]


def _slots(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first number, copies in a sequence, first sequence, first offset) sorted by length and number."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for use, times in plan:
        offset = 0
        for length, n in use.items():
            rows.append((length, taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 4096) -> DataFrame:
    """Return doc_id, piece, start, length, ids_crc32, sequence_id and offset for every piece of every document."""
    pieces = materialize(token_pieces(docs, tokenizer_file, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan_packing(counts, capacity))
    first = slots[:, 0] << 40 | slots[:, 1] if len(slots) else np.zeros(0, np.int64)
    # lengths that many pieces have are numbered in buckets; the list of bucket numbers by length has capacity + 1 entries
    buckets = F.from_json(F.lit(str([max(1, counts.get(x, 0) // ROWS_PER_BUCKET) for x in range(capacity + 1)])), "array<int>")
    salt = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    ranked = number_in_group(pieces, "length", salt, F.get(buckets, F.col("length").cast("int")), ["doc_id", "piece", "start", "ids_crc32"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            _, start, copies, sequence, offset = slots[np.searchsorted(first, length << 40 | rank, "right") - 1].T
            here = rank - start
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence + here // copies), pa.array(offset + here % copies * length)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.select(*columns, "rank").mapInArrow(frugal(place), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
