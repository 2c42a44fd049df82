"""Encoding of a corpus with a public byte-level BPE vocabulary, by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of its
encoding. ``PrefixEncoder`` stores these last tokens: a token that ends at byte i
is the last one there if it is compatible with the last token before it, that is
if the two, encoded together, stay as they are. Appending bytes extends the table
without touching it, and an edit re-encodes only from the edit until the table
agrees with the old one again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern published with the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces whose ids a worker remembers; when full, the memory is emptied.
MEMORY = 400_000
#: Ids in one Arrow batch of the output.
BATCH_IDS = 1_000_000


class Vocabulary:
    """Ranks of a vocabulary with the lookups that prefix programming needs."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tails = {t[i:] for t in self.rank for i in range(len(t))}
        self.width = max(map(len, self.rank))
        self.fits: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, text: bytes) -> list[bytes]:
        """Plain pair merging, lowest rank first; only used on two joined tokens."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.rank.get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
            low = min(ranks)
            if low == 1 << 60:
                break
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, a: bytes, b: bytes) -> bool:
        key = (a, b)
        if (got := self.fits.get(key)) is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            got = self.fits[key] = self.merge(a + b) == [a, b]
        return got


class PrefixEncoder:
    """Appendable encoding of one byte string (a piece between split points)."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.v, self.text, self.last = vocabulary, bytearray(), [b""]
        self.append(text)

    def _step(self, text: bytes, last: list[bytes]) -> bytes:
        """The unique valid last token of the prefix that ends where ``last`` ends."""
        i, tails, rank, fits = len(last), self.v.tails, self.v.rank, self.v.compatible
        found, low = b"", max(0, i - self.v.width)
        for j in range(i - 1, low - 1, -1):
            t = text[j:i]
            if t not in tails:
                break
            if t in rank and (j == 0 or fits(last[j], t)):
                found = t
        return found

    def append(self, more: bytes) -> None:
        """Extend the string; nothing that is stored changes."""
        self.text += more
        text = bytes(self.text)
        while len(self.last) <= len(text):
            self.last.append(self._step(text, self.last))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes ``start:end``; gives the number of prefixes computed anew.

        Prefixes up to ``start`` keep their last token. Behind the edit, once as
        many successive last tokens as the longest token has bytes are the old
        ones, all later ones are, too.
        """
        old, shift = self.last, len(new) - (end - start)
        self.text[start:end] = new
        text, last, same, work = bytes(self.text), old[: start + 1], 0, 0
        while len(last) <= len(text):
            i = len(last)
            last.append(self._step(text, last))
            work += 1
            same = same + 1 if i - len(last[i]) >= start + len(new) and old[i - shift] == last[i] else 0
            if same >= self.v.width:
                last += old[i - shift + 1 :]
                break
        self.last = last
        return work

    def ids(self) -> list[int]:
        out, i = [], len(self.last) - 1
        while i:
            t = self.last[i]
            out.append(self.v.rank[t])
            i -= len(t)
        return out[::-1]


_LOADED: dict[str, tuple[Vocabulary, dict[str, bytes]]] = {}


def _loaded(path: str) -> tuple[Vocabulary, dict[str, bytes]]:
    if path not in _LOADED:
        _LOADED[path] = (Vocabulary(path), {})
    return _LOADED[path]


def encode_text(text: str | None, path: str = VOCABULARY) -> bytes:
    """Ids of one text as little-endian 32-bit integers; nothing for NULL and empty texts."""
    if not text:
        return b""
    vocabulary, memory = _loaded(path)
    if len(memory) > MEMORY:
        memory.clear()
    pieces = regex.findall(SPLIT, text)
    try:
        return b"".join([memory[p] for p in pieces])
    except KeyError:
        for p in pieces:
            if p not in memory:
                memory[p] = np.array(PrefixEncoder(vocabulary, p.encode("utf-8", "surrogatepass")).ids(), "<i4").tobytes()
        return b"".join([memory[p] for p in pieces])


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``key, ids``: the token ids of every text, without special tokens.

    The strings of special tokens are ordinary text. NULL and empty texts give an
    empty list. Whole texts are encoded, however long; a map without shuffle.
    ``path`` is the vocabulary file, which every executor must be able to read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, got, size, at = batch.column(0), [], 0, 0
            for k, t in enumerate(batch.column(1)):
                got.append(encode_text(t.as_py(), path))
                size += len(got[-1])
                if size >= 4 * BATCH_IDS or k + 1 == batch.num_rows:
                    ends = np.cumsum([0, *(len(x) // 4 for x in got)], dtype=np.int32)
                    values = pa.array(np.frombuffer(b"".join(got), "<i4"), pa.int32())
                    yield pa.RecordBatch.from_arrays([keys.slice(at, len(got)), pa.ListArray.from_arrays(pa.array(ends), values)], names=[key, "ids"])
                    at, got, size = k + 1, [], 0

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
