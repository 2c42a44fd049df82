"""Evaluation texts inside training texts: BM25 over test items with block-max WAND.

Test items are indexed by character n-grams of their reduced text. Each passage of
a document is a query of its n-grams at every ``STRIDE``-th place. The threshold of
an item is the least score that any of its 50-character runs can have at any
offset, so that retrieval loses nothing; what is retrieved is then verified, and the
item's answer is looked for behind the passage.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = 50
GRAM, STRIDE = 12, 6
#: Characters of a passage and of its overlap with the next.
PASSAGE, OVERLAP = 600, 54
#: Characters of items in one index (about 300 bytes of index each, on every worker); more are searched in as many
#: passes over the documents.
INDEX_CHARS = 500_000
#: Characters behind a passage in which the item's answer counts as given.
ANSWER_SPAN = 200
BLOCK, K1, B = 16, 1.2, 0.75
_DROP = re.compile(r"[\W_]+")
_WORDS = re.compile(r"[^\W_]+")
_END = 1 << 60


def _plain(text: str) -> str:
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()


def reduced(text: str) -> str:
    """NFKC, lower case, letters and digits only."""
    return _DROP.sub("", _plain(text))


class Postings:
    """Items of one n-gram in order, with their weights; per block its last item, largest weight and least threshold."""

    __slots__ = ("docs", "weights", "last", "best", "least", "top")

    def __init__(self, entries: list[tuple[int, float]], least: list[float]):
        self.docs, self.weights = [d for d, _ in entries], [w for _, w in entries]
        cuts = range(0, len(entries), BLOCK)
        self.last = [self.docs[min(k + BLOCK, len(entries)) - 1] for k in cuts]
        self.best = [max(self.weights[k : k + BLOCK]) for k in cuts]
        self.least = [min(least[d] for d in self.docs[k : k + BLOCK]) for k in cuts]
        self.top = max(self.best)


class ItemIndex:
    """Inverted index of items (id, text, answer) with BM25 weights and an own threshold for each item."""

    def __init__(self, items: list[tuple[int, str, str | None]]):
        self.ids, self.texts = [x[0] for x in items], [reduced(x[1]) for x in items]
        self.answers = [_WORDS.findall(_plain(x[2] or "")) for x in items]
        n = max(1, len(items))
        mean = max(1.0, sum(map(len, self.texts)) / n)
        entries: dict[str, list[tuple[int, float]]] = defaultdict(list)
        counts = [Counter(t[p : p + GRAM] for p in range(len(t) - GRAM + 1)) for t in self.texts]
        df = Counter(g for c in counts for g in c)
        weight = [
            {g: math.log(1 + (n - df[g] + 0.5) / (df[g] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(t) / mean)) for g, f in c.items()}
            for t, c in zip(self.texts, counts, strict=True)
        ]
        for i, w in enumerate(weight):
            for g, x in w.items():
                entries[g].append((i, x))
        self.least = [self._least(t, w) for t, w in zip(self.texts, weight, strict=True)]
        self.floor = min(self.least, default=math.inf)
        self.postings = {g: Postings(e, self.least) for g, e in entries.items()}
        #: Postings that searches scored, and that they passed over unread.
        self.scored = self.skipped = 0

    @staticmethod
    def _least(text: str, weight: dict[str, float]) -> float:
        """Least score of any run of RUN characters, whatever its place in a document."""
        best, take = math.inf, (RUN - GRAM + 1) // STRIDE
        for s in range(len(text) - RUN + 1):
            for r in range(STRIDE):
                if r + (take - 1) * STRIDE > RUN - GRAM:
                    break
                grams = {text[s + r + k * STRIDE : s + r + k * STRIDE + GRAM] for k in range(take)}
                best = min(best, sum(weight[g] for g in grams))
        return best - 1e-9

    def search(self, grams: set[str]) -> list[int]:
        """Items whose score for the query reaches their threshold, by block-max WAND.

        The pivot is the first item up to which the lists' largest weights reach the
        least threshold of all. If the largest weights of the blocks that hold it stay
        below the least threshold of these blocks, no item up to the first block's end
        can do: the lists jump behind it without a look at what lies between.
        """
        lists = [self.postings[g] for g in grams]
        if sum(p.top for p in lists) < self.floor:
            return []
        at, doc, out = [0] * len(lists), [p.docs[0] for p in lists], []

        def seek(k: int, to: int) -> None:
            docs = lists[k].docs
            n = bisect_left(docs, to, at[k])
            self.skipped += n - at[k]
            at[k], doc[k] = n, docs[n] if n < len(docs) else _END

        while True:
            order = sorted(range(len(lists)), key=doc.__getitem__)
            total, upto = 0.0, -1
            for n, k in enumerate(order):
                if doc[k] == _END:
                    break
                total += lists[k].top
                if total >= self.floor:
                    upto = n
                    break
            if upto < 0:
                return out
            pivot = doc[order[upto]]
            while upto + 1 < len(order) and doc[order[upto + 1]] == pivot:
                upto += 1
            mine = order[: upto + 1]
            bound, need, end = 0.0, math.inf, _END
            for k in mine:  # the block of each list in which the pivot would stand
                p = lists[k]
                b = bisect_left(p.last, pivot, at[k] // BLOCK)
                if b < len(p.last):
                    bound += p.best[b]
                    need = min(need, p.least[b])
                    end = min(end, p.last[b] + 1)
            if bound < need:
                beyond = doc[order[upto + 1]] if upto + 1 < len(order) else _END
                to = max(min(end, beyond), pivot + 1)
                for k in mine:
                    seek(k, to)
            elif doc[mine[0]] == pivot:
                self.scored += len(mine)
                if sum(lists[k].weights[at[k]] for k in mine) >= self.least[pivot]:
                    out.append(pivot)
                for k in mine:
                    at[k] += 1
                    doc[k] = lists[k].docs[at[k]] if at[k] < len(lists[k].docs) else _END
            else:
                for k in mine:
                    if doc[k] < pivot:
                        seek(k, pivot)

    def leaks(self, text: str) -> dict[int, bool]:
        """Item ids of which the text holds RUN consecutive characters, both reduced, and whether the answer follows."""
        t, vocabulary = reduced(text), self.postings
        if len(t) < RUN:
            return {}
        hits = [p for p in range(0, len(t) - GRAM + 1, STRIDE) if t[p : p + GRAM] in vocabulary]
        if not hits:
            return {}
        found: dict[int, list[int]] = {}
        step = PASSAGE - OVERLAP
        for start in range(0, max(1, len(t) - OVERLAP), step):
            grams = {t[p : p + GRAM] for p in hits if start <= p <= start + PASSAGE - GRAM}
            if not grams:
                continue
            passage = t[start : start + PASSAGE]
            for i in self.search(grams):
                runs = (k for k in range(len(passage) - RUN + 1) if passage[k : k + RUN] in self.texts[i])
                if (k := next(runs, None)) is not None:
                    found.setdefault(i, []).append(start + k)
        if not found:
            return {}
        plain = _plain(text)
        place = [k for k, c in enumerate(plain) if c.isalnum()]
        return {self.ids[i]: any(self._answered(i, t, s, plain, place) for s in starts) for i, starts in found.items()}

    def _answered(self, i: int, t: str, start: int, plain: str, place: list[int]) -> bool:
        """Whether the words of the item's answer stand within ``ANSWER_SPAN`` characters behind the longest passage from ``start``."""
        answer, end = self.answers[i], start + RUN
        while end < len(t) and t[start : end + 1] in self.texts[i]:
            end += 1
        if not answer or len(place) != len(t):
            return False
        behind = place[end - 1] + 1
        words = _WORDS.findall(plain[behind : behind + ANSWER_SPAN])
        return any(words[k : k + len(answer)] == answer for k in range(len(words) - len(answer) + 1))


@lru_cache(maxsize=2)
def _index(items: tuple[tuple[int, str, str | None], ...]) -> ItemIndex:
    """The index of a pass, built once by each worker."""
    return ItemIndex(list(items))


def _passes(items: DataFrame) -> Iterator[tuple]:
    part, size = [], 0
    for r in items.select("item_id", "text", "answer").where("item_id is not null and text is not null").toLocalIterator():
        if part and size + len(r["text"]) > INDEX_CHARS:
            yield tuple(part)
            part, size = [], 0
        part.append((r["item_id"], r["text"], r["answer"]))
        size += len(r["text"])
    yield tuple(part)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, answered``: every document with the items of which it holds a passage.

    The items are the query set: their texts go to the workers, which index them, in
    passes of at most ``INDEX_CHARS`` characters, and each pass is one map over all
    documents without shuffle. NULL, empty and short texts leak nothing; items that are
    shorter than a passage can't be found. Repeated items and documents come out
    under each of their ids, each pair once. ``answered`` tells whether the item's answer
    stands behind the passage; an item without answer has none.
    """
    context, out = docs.sparkSession.sparkContext, None
    for part in _passes(items):
        shared = context.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value)
            for batch in batches:
                at, got = [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    for pair in index.leaks(text).items() if text else ():
                        at.append(k)
                        got.append(pair)
                columns = [pa.array([i for i, _ in got], pa.int64()), pa.array([a for _, a in got], pa.bool_())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *columns], names=["doc_id", "item_id", "answered"])

        one = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, item_id bigint, answered boolean")
        out = one if out is None else out.unionByName(one)
    return out


def found_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id`` of ``leaks``: the text alone decides, whatever the answer."""
    return leaks(docs, items).select("doc_id", "item_id")


def leaked_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, task, n_documents, n_answered`` of every item that some document holds."""
    rows = leaks(docs, items).groupBy("item_id", "doc_id").agg(F.max("answered").alias("a"))
    counts = rows.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.count_if("a").alias("n_answered"))
    return items.select("item_id", "task").join(counts, "item_id")
