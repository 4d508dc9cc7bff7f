"""Token counts with a whole-token shortcut.

A text is cut into pre-tokens that no merge of the vocabulary can cross: before every
run of spaces and before every newline. ``Shortcut`` proves that from the vocabulary
itself (no piece has a space after another character, none holds a newline), and
proves by encoding every vocabulary string alone which of them are one token. A
pre-token that is such a string counts as one; only the others are merged by the
library, and their counts are kept in a bounded cache. If the vocabulary does not allow
the cuts, whole texts are encoded.

Edge cases: a null text counts as empty (0 tokens); texts of any length are counted
whole; repeated rows are counted one by one; columns besides doc_id and text are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Merged pre-tokens that a worker keeps, and the longest one kept.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48
DOCS_AT_ONCE = 256
SPACE = "▁"


class Shortcut(dict):
    """Pre-token -> tokens. Keys are words after one space, or words after a newline with the newline in front."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        probe = self.model.encode(" a  b\nc ", out_type=str)
        self.cuts = all(SPACE not in p.lstrip(SPACE) and "\n" not in p for p in pieces) and "".join(probe) == f"{SPACE}{SPACE}a{SPACE}{SPACE}b<0x0A>c{SPACE}"
        alone = [p[1:] for p in pieces if p[0] == SPACE and len(p) > 1 and p[1] != SPACE]
        encoded = self.model.encode(alone, num_threads=1)
        super().__init__({w: 1 for w, ids in zip(alone, encoded, strict=True) if len(ids) == 1})
        self[SPACE] = 1  # a single space with no word after it
        self.proven = dict(self)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the words that are not in the table yet are merged by the library in one call."""
        if not self.cuts:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        if len(self) > CACHE_ENTRIES:
            self.clear()
            self.update(self.proven)
        words = [_pre_tokens(t.replace(SPACE, " ")) for t in texts]
        new = [w for w in set().union(*words) if w not in self]
        if new:
            self.update((w, len(x) - (w[:1] == "\n")) for w, x in zip(new, self.model.encode(new, num_threads=1), strict=True))
        out = [sum(map(self.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > CACHE_CHARS:
                del self[w]
        return out


def _pre_tokens(text: str) -> list[str]:
    """Cut before runs of spaces and before newlines; the first space of a run is left out, as the library puts one in front of a text.

    A run of spaces that no word follows becomes that many spaces less one, or the lone-space piece.
    """
    if not text:
        return []
    if "  " not in text and " \n" not in text and text[0] not in " \n" and text[-1] != " ":
        return text.replace("\n", " \n").split(" ")
    parts = re.findall(r" +[^ \n]*|\n[^ \n]*", " " + text)
    return [p if p[0] == "\n" else p[1:] if len(p) > 1 else SPACE for p in parts]


_shortcuts: dict[str, Shortcut] = {}


def shortcut(model_file: str) -> Shortcut:
    """One table a worker process."""
    if model_file not in _shortcuts:
        _shortcuts[model_file] = Shortcut(model_file)
    return _shortcuts[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """Return doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for every row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shortcut(model_file).counts
        for batch in batches:
            text = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(text.cast(pa.large_binary())), 0).cast(pa.int64())
            texts = [t or "" for t in text.to_pylist()]
            tokens = pa.array([n for i in range(0, len(texts), DOCS_AT_ONCE) for n in count(texts[i : i + DOCS_AT_ONCE])], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens, pc.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n_bytes long, n_tokens long, over_limit boolean")
