"""TF-IDF similarity, greedy leaders, SimHash, merging of groups, canonical election."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pa_fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import normalize_title, uni_and_bigrams, word_tokens
from gleaner.session import counted, discard, materialize, sized_join


#: Rows of a block of term vectors, of which a task holds a few at a time, and sparse products that it sums at once.
BLOCK_ROWS = 2_000
PRODUCTS = 4_000_000
#: Products of a term in a pair of blocks from which on it goes into the dense product.
DENSE = 3_000
#: Blocks of open rows in which one task chooses leaders; blocks of a side of a tile.
OPEN_BLOCKS = 8
TILE = 16
#: Sketches: terms that become axes, axes, buckets of the other common terms, most common terms, and the share of rows that makes a term common.
FREQUENT, AXES, BUCKETS, COMMON, SHARE = 750, 384, 384, 6_000, 0.006
#: Pairs of a row that a bound leaves open from which on the row is multiplied in full with the rows that any such row is open with.
OPEN_PAIRS = 12
#: Blocks of rows that a task holds against leaders.
GROUP = 10
#: Rows of a block of prints, rows of it that are held against another block at once, and blocks of a side of a tile.
PRINT_ROWS, PRINT_SLICE, PRINT_TILE = 8_000, 64, 8
#: Pairs up to which greedy leaders are chosen in one task.
PAIRS = 1_000_000


def _raw_weights(df: DataFrame, pos: str, text: str) -> DataFrame:
    """``pos, term, df, x``: smooth idf times raw counts, not normalised."""
    terms = df.select(F.col(pos).alias("pos"), F.explode(uni_and_bigrams(word_tokens(F.col(text)))).alias("term"))
    tf = materialize(terms.groupBy("pos", "term").agg(F.count("*").alias("tf")), "tf")
    n = df.count()
    freq = tf.groupBy("term").agg(F.count("*").alias("df"))
    return tf.join(freq, "term").withColumn("x", F.col("tf") * (F.log((F.lit(1.0) + n) / (1 + F.col("df"))) + 1))


def tfidf(df: DataFrame, pos: str, text: str) -> DataFrame:
    """``pos, term, df, w``: smooth idf, raw counts, L2-normalised; texts without tokens have no rows."""
    raw = _raw_weights(df, pos, text)
    norm = raw.groupBy("pos").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return raw.join(norm, "pos").select("pos", "term", "df", (F.col("x") / F.col("norm")).alias("w"))


def _rows(path: str, columns: list[str] | None = None) -> pa.Table | None:
    """A written table, or one block of it, read within a task in the order of its files; None if it has no rows."""
    files, root = pa_fs.FileSystem.from_uri(path)
    found = sorted(f.path for f in files.get_file_info(pa_fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet"))
    tables = [pq.read_table(f, columns=columns, filesystem=files, partitioning=None) for f in found]
    out = pa.concat_tables(tables).combine_chunks() if tables else None
    return out if out is not None and out.num_rows else None


@lru_cache(2)
def _idf(path: str, n: int) -> np.ndarray:
    """Smooth idf of the terms of a table ``id, df``, in its order."""
    t = _rows(path, ["df"])
    return np.log((1.0 + n) / (1 + (np.asarray(t["df"].chunk(0)) if t is not None else np.zeros(0)))) + 1


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many as its count."""
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def _terms(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of hashed tokens: the different ids of single tokens and neighbours, sorted, and for each term of a row its place there, the row and the count."""
    h, count = np.asarray(lists.flatten()).view(np.uint64), np.diff(np.asarray(lists.offsets))
    row = np.repeat(np.arange(len(count)), count)
    pair = row[1:] == row[:-1]
    x = h[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + h[1:][pair] + np.uint64(0x632BE59BD9B4E019)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    ids, row = np.concatenate([h, x ^ (x >> np.uint64(29))]).view(np.int64), np.concatenate([row, row[1:][pair]])
    order = np.argsort(ids)
    ids = ids[order]
    first = np.append(True, ids[1:] != ids[:-1])[: len(ids)]
    key = np.sort(row[order] * max(1, int(first.sum())) + np.cumsum(first) - 1)
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    at, g = np.divmod(key[start], max(1, int(first.sum())))
    return ids[first], g, at, np.diff(np.append(start, len(key)))


class _Inverted:
    """Weights in single precision, by term."""

    def __init__(self, t: np.ndarray, row: np.ndarray, w: np.ndarray):
        self.t, self.row, self.w = t, row, w
        self.start = np.flatnonzero(np.append(True, t[1:] != t[:-1])) if len(t) else np.zeros(0, np.int64)
        self.terms, self.count = t[self.start], np.diff(np.append(self.start, len(t)))

    @classmethod
    def of(cls, row: np.ndarray, term: np.ndarray, w: np.ndarray, rows: int) -> _Inverted:
        order = np.argsort(term.astype(np.int64) * rows + row)
        return cls(term[order], row[order], w[order].astype(np.float32))

    def columns(self, terms: np.ndarray, rows: int) -> np.ndarray:
        out = np.zeros((rows, len(terms)), np.float32)
        e = _ranges(self.start[terms], self.count[terms])
        out[self.row[e], np.repeat(np.arange(len(terms)), self.count[terms])] = self.w[e]
        return out

    def multiply(self, a: np.ndarray, other: _Inverted, b: np.ndarray, flat: np.ndarray, m: int, products: int) -> None:
        """Add the products of the terms ``a`` here and ``b`` there to sums with ``m`` columns, so many at once as ``products``."""
        done = np.cumsum(self.count[a] * other.count[b])
        at = 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + products, "right")))
            own = self.count[a[at:to]]
            e, c = _ranges(self.start[a[at:to]], own), np.repeat(other.count[b[at:to]], own)
            k = _ranges(np.repeat(other.start[b[at:to]], own), c)
            np.add.at(flat, np.repeat(self.row[e] * m, c) + other.row[k], np.repeat(self.w[e], c) * other.w[k])
            at = to


class _Packed:
    """A block of vectors as flat arrays: rows, class sizes, and weights by row and by term."""

    def __init__(self, pos: np.ndarray, n: np.ndarray, row: np.ndarray, term: np.ndarray, w: np.ndarray):
        self.pos, self.n, self.row, self.term, self.w = pos, n, row, term, w
        self.size = np.bincount(row, minlength=len(pos))
        self.at = np.concatenate([[0], np.cumsum(self.size)])

    @cached_property
    def by_term(self) -> _Inverted:
        return _Inverted.of(self.row, self.term, self.w, len(self.pos))

    @classmethod
    def of(cls, t: pa.Table, idf: np.ndarray) -> _Packed:
        ids, tf, norm = t["ids"].combine_chunks(), t["tf"].combine_chunks(), np.asarray(t["norm"].combine_chunks())
        row = np.repeat(np.arange(t.num_rows), np.diff(np.asarray(ids.offsets)))
        term = np.asarray(ids.flatten())
        return cls(np.asarray(t["pos"].combine_chunks()), np.asarray(t["n"].combine_chunks()), row, term, np.asarray(tf.flatten()) * idf[term] / norm[row])

    @classmethod
    def joined(cls, parts: list[_Packed]) -> _Packed:
        if len(parts) == 1:
            return parts[0]
        before = np.cumsum([0, *[len(x.pos) for x in parts]])
        row = np.concatenate([x.row + k for x, k in zip(parts, before, strict=False)])
        return cls(*[np.concatenate([getattr(x, c) for x in parts]) for c in ("pos", "n")], row, *[np.concatenate([getattr(x, c) for x in parts]) for c in ("term", "w")])

    def take(self, kept: np.ndarray) -> _Packed:
        """The rows of a mask."""
        if kept.all():
            return self
        to, r = np.cumsum(kept) - 1, kept[self.row]
        out = _Packed(self.pos[kept], self.n[kept], to[self.row[r]], self.term[r], self.w[r])
        if "by_term" in self.__dict__:
            x = self.by_term
            t = kept[x.row]
            out.by_term = _Inverted(x.t[t], to[x.row[t]], x.w[t])
        return out


class _Sketch:
    """A block of vectors with rows whose products are never less than those of the vectors in their common terms.

    The weights of the most frequent terms are replaced by their places on a few axes
    and the length of what lies off these, those of other common terms by their length
    in each bucket of terms (Cauchy-Schwarz). Rare terms are kept by term.
    """

    def __init__(self, p: _Packed, basis: tuple[np.ndarray, np.ndarray, int, int], bound: np.ndarray | None = None):
        place, axes, self.width, buckets = self.basis = basis
        self.p, self.pos, self.n, self.size = p, p.pos, p.n, p.size
        rows, k, at = len(p.pos), len(axes), place[p.term]
        common, rare, w = np.flatnonzero(at >= 0), np.flatnonzero(at < 0), p.w.astype(np.float32)
        self.row, self.column, self.w = p.row[common], at[common], w[common]
        self.common = np.bincount(self.row, minlength=rows)
        self.start = np.cumsum(self.common) - self.common
        self.rare = _Inverted.of(p.row[rare], p.term[rare], w[rare], rows)
        if bound is None:
            often, rest = np.flatnonzero(self.column < k), np.flatnonzero(self.column >= k)
            n, square = axes.shape[1], self.w * self.w
            x = np.zeros((rows, k), np.float32)
            x.reshape(-1)[self.row[often] * k + self.column[often]] = self.w[often]
            bound = np.empty((rows, n + 1 + buckets), np.float32)
            bound[:, :n] = on = x @ axes
            off = np.bincount(self.row[often], square[often], rows) - (on * on).sum(1)
            bound[:, n] = np.sqrt(np.maximum(off, 0) + 2e-6)  # more than single precision loses
            b = np.bincount(self.row[rest] * buckets + (self.column[rest] - k) % buckets, square[rest], rows * buckets)
            bound[:, n + 1 :] = np.sqrt(b.astype(np.float32)).reshape(rows, buckets)
        self.bound = bound

    @cached_property
    def table(self) -> np.ndarray:
        out = np.zeros((len(self.pos), self.width), np.float32)
        out[self.row, self.column] = self.w
        return out

    def lines(self, rows: np.ndarray) -> np.ndarray:
        """Some rows of ``table``."""
        count, out = self.common[rows], np.zeros((len(rows), self.width), np.float32)
        e = _ranges(self.start[rows], count)
        out[np.repeat(np.arange(len(rows)), count), self.column[e]] = self.w[e]
        return out

    def take(self, kept: np.ndarray) -> _Sketch:
        return self if kept.all() else _Sketch(self.p.take(kept), self.basis, self.bound[kept])

    @classmethod
    def joined(cls, parts: list[_Sketch]) -> _Sketch:
        return cls(_Packed.joined([x.p for x in parts]), parts[0].basis, np.concatenate([x.bound for x in parts]))


def _least_error(left: _Packed | _Sketch, right: _Packed | _Sketch, least: float) -> float:
    """What single precision can lose of a sum of about ``least``."""
    return least * 6.6e-8 * (min(left.size.max(initial=0), right.size.max(initial=0)) + 8) + 1e-9


def _decide(left: _Packed, right: _Packed, i: np.ndarray, j: np.ndarray, sums: np.ndarray, least: float, error: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of cosine at least ``least``; those within ``error`` of it in double precision."""
    kept = sums >= least - error
    for x in np.flatnonzero(kept & (sums <= least + error)):
        p, q = slice(left.at[i[x]], left.at[i[x] + 1]), slice(right.at[j[x]], right.at[j[x] + 1])
        _, u, v = np.intersect1d(left.term[p], right.term[q], assume_unique=True, return_indices=True)
        kept[x] = np.round(left.w[p][u] @ right.w[q][v], 9) >= least
    return (i, j) if kept.all() else (i[kept], j[kept])


def _near(left: _Packed | _Sketch, right: _Packed | _Sketch, least: float, dense: int, products: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs of cosine at least ``least``, in the order of ``left`` and then of ``right``.

    Terms that many rows of both blocks have are multiplied as dense columns, the
    others product by product, both in single precision; pairs that lie within its
    error of ``least`` are decided in double precision. Of sketches, only the pairs
    whose bound reaches ``least`` are multiplied, and all of rows that have many such pairs.
    """
    if isinstance(left, _Sketch):
        return _near_bounded(left, right, least, dense, products)
    m, x, y = len(right.pos), left.by_term, right.by_term
    _, a, b = np.intersect1d(x.terms, y.terms, assume_unique=True, return_indices=True)
    full = x.count[a] * y.count[b] >= dense
    sums = x.columns(a[full], len(left.pos)) @ y.columns(b[full], m).T
    flat = sums.reshape(-1)
    x.multiply(a[~full], y, b[~full], flat, m, products)
    error = _least_error(left, right, least)
    hit = np.flatnonzero(flat >= least - error)
    i, j = np.divmod(hit, max(m, 1))
    return _decide(left, right, i, j, flat[hit], least, error)


def _near_bounded(left: _Sketch, right: _Sketch, least: float, dense: int, products: int, most_open: int = OPEN_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    m, error = len(right.pos), _least_error(left, right, least)
    _, a, b = np.intersect1d(left.rare.terms, right.rare.terms, assume_unique=True, return_indices=True)
    rare = np.zeros(len(left.pos) * m, np.float32)
    left.rare.multiply(a, right.rare, b, rare, m, products)
    most = (left.bound @ right.bound.T).reshape(-1)
    most += rare
    hit = np.flatnonzero(most >= least - 5e-4)  # more than single precision loses in so many columns
    i, j = np.divmod(hit, max(m, 1))
    many = np.bincount(i, minlength=len(left.pos)) > most_open
    if many.any():
        at, rows = many[i], np.zeros(m, bool)
        rows[j[at]] = True
        if many.sum() * rows.sum() > len(most) // 2:  # the bound tells too little here
            return _near(left.p, right.p, least, dense, products)
        u, v = np.flatnonzero(many), np.flatnonzero(rows)
        whole = left.lines(u) @ right.table[v].T
        whole += rare.reshape(-1, m)[np.ix_(u, v)]
        x, y = np.divmod(np.flatnonzero(whole >= least - 2 * error), len(v))
        x, y = _decide(left.p, right.p, u[x], v[y], whole[x, y], least, 2 * error)
        whole = x * m + y
        hit, i, j = hit[~at], i[~at], j[~at]
    count = left.common[i]
    e = _ranges(left.start[i], count)
    parts = left.w[e] * right.table[np.repeat(j, count), left.column[e]]
    sums = rare[hit] + np.bincount(np.repeat(np.arange(len(hit)), count), parts, len(hit))
    i, j = _decide(left.p, right.p, i, j, sums, least, 2 * error)
    return np.divmod(np.sort(np.append(whole, i * m + j)), max(m, 1)) if many.any() else (i, j)


@lru_cache(2)
def _basis(path: str, n_terms: int, buckets: int) -> tuple[np.ndarray, np.ndarray, int, int] | None:
    """Of a written basis: the column of each common term (else -1), the axes, the number of columns and of buckets; None without rows."""
    t = _rows(path)
    if t is None:
        return None
    term, axes = np.asarray(t["term"].chunk(0)), t["axes"].chunk(0)
    place = np.full(n_terms, -1, np.int32)
    place[term] = np.arange(len(term), dtype=np.int32)
    k = int((np.diff(np.asarray(axes.offsets)) > 0).sum())
    return place, np.asarray(axes.flatten()).reshape(k, -1), len(term), buckets


class _Shelf:
    """TF-IDF vectors of class representatives in blocks by ``pos``, as files in the shared folder that tasks read themselves.

    A pair of blocks so costs no copy on disk. Weights are kept as counts and norms;
    terms of one row only are in the norms, not in the lists.
    """

    def __init__(self, df: DataFrame, pos: str, text: str, member: DataFrame, n_rows: int, least: float):
        """``text``: a column of texts, or of the hashes of their tokens."""
        self.spark, self.least, self.tables = df.sparkSession, least, []
        reps, seen = counted(member.where("pos = rep and c").select("pos", "n"), "reps")
        hashes = F.col(text) if df.schema[text].dataType.typeName() == "array" else F.transform(word_tokens(F.col(text)), lambda t: F.xxhash64(t))
        hashed = sized_join(df.select(F.col(pos).cast("bigint").alias("pos"), hashes.alias("h")), reps, ["pos"]).select("pos", "n", "h")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, g, row, _ = _terms(batch.column(1))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.bincount(g, np.asarray(batch.column(0))[row], len(ids)).astype(np.int64))], names=["id", "n"])

        freq = hashed.select("n", "h").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("df")).where("df > 1")
        freq = self._keep(materialize(freq.orderBy("id"), "freq"))
        n_blocks = max(1, math.ceil(seen["n"] / BLOCK_ROWS))
        shares = [k / n_blocks for k in range(1, n_blocks)]
        cuts = np.unique(reps.agg(F.percentile_approx("pos", F.array(*map(F.lit, shares)), max(10_000, 20 * n_blocks))).first()[0] or []) if shares else np.zeros(0)
        path = freq._gleaner_path

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, known = _idf(path, n_rows), _rows(path, ["id"])
            known = np.asarray(known["id"].chunk(0)) if known is not None else np.zeros(0, np.int64)
            for batch in batches:
                where, n, lists = (batch.column(c) for c in range(3))
                ids, g, row, tf = _terms(lists)
                at = np.searchsorted(known, ids)
                found = known[np.minimum(at, len(known) - 1)] == ids if len(known) else np.zeros(len(ids), bool)
                weight = np.where(found, idf[np.minimum(at, len(known) - 1)] if len(known) else 0.0, math.log((1.0 + n_rows) / 2) + 1)
                norm = np.sqrt(np.bincount(row, (tf * weight[g]) ** 2, len(where)))
                at, found = at[g], found[g]
                size = np.bincount(row[found], minlength=len(where))
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                parts = [where, n, pa.ListArray.from_arrays(offsets, pa.array(at[found], pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tf[found], pa.int32())), pa.array(norm), pa.array(np.searchsorted(cuts, np.asarray(where), "left"), pa.int32())]
                yield pa.RecordBatch.from_arrays(parts, names=["pos", "n", "ids", "tf", "norm", "b"]).filter(pa.array(size > 0))

        rows = hashed.mapInArrow(pack, f"{self.ROW}, b int").repartition(min(n_blocks, 200), "b").sortWithinPartitions("b", "pos")
        vectors = self._keep(materialize(rows, "vectors", "b"))
        self.path, self.idf = vectors._gleaner_path, (path, n_rows)
        self.sizes = self._sizes(vectors)
        self.basis = None

    ROW = "pos bigint, n bigint, ids array<int>, tf array<int>, norm double"

    def _keep(self, table: DataFrame) -> DataFrame:
        self.tables.append(table)
        return table

    @staticmethod
    def _sizes(table: DataFrame) -> dict[int, int]:
        return {r.b: r["count"] for r in table.groupBy("b").count().collect()}

    def discard(self) -> None:
        discard(*self.tables)

    def _each(self, jobs: list, run: Callable, schema: str) -> DataFrame:
        """``run(job)`` gives tables; one task a job."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    for out in run(jobs[k]):
                        yield from out.to_batches()

        return self.spark.range(0, len(jobs), 1, max(1, len(jobs))).mapInArrow(task, schema)

    def _groups(self, sizes: dict[int, int], each: int) -> list[list[int]]:
        """Blocks dealt to groups of like numbers of rows: ``each`` a core, or a multiple where these would have above ``GROUP`` blocks of rows."""
        n = each * self.spark.sparkContext.defaultParallelism
        n = min(len(sizes), n * max(1, math.ceil(sum(sizes.values()) / (n * GROUP * BLOCK_ROWS))))
        while True:
            out, rows = [[] for _ in range(n)], [0] * n
            for b in sorted(sizes, key=lambda b: (-sizes[b], b)):
                k = rows.index(min(rows))
                out[k].append(b)
                rows[k] += sizes[b]
            if n == len(sizes) or max(rows) <= GROUP * BLOCK_ROWS:
                return [sorted(x) for x in out]
            n += 1

    def heads(self) -> list[str]:
        """Paths of the vectors of the greedy leaders in ``pos`` order, in parts.

        One task chooses leaders among the first open rows; all later rows then meet
        these leaders, block by block, and those like one of them drop out, as nothing
        but leaders can keep a row from leading. So rows meet leaders only.
        """
        path, idf, least, dense, products, block = self.path, self.idf, self.least, DENSE, PRODUCTS, BLOCK_ROWS
        near = lambda x, y: _near(x, y, least, dense, products)
        sizes, rest, out, load = self.sizes, None, [], self._load()

        def away(x: _Packed, y: _Packed) -> np.ndarray:
            free = np.ones(len(x.pos), bool)
            free[near(x, y)[0]] = False
            return free

        while sizes:
            first, n = [], 0
            for b in sorted(sizes):
                if first and n + sizes[b] > OPEN_BLOCKS * block:
                    break
                first, n = [*first, b], n + sizes[b]

            def rows(b: int, rest: str | None) -> pa.Table:
                t = _rows(f"{path}/b={b}")
                return t if rest is None else t.filter(pc.is_in(t["pos"], _rows(f"{rest}/b={b}")["pos"].combine_chunks()))

            def greedy(job: list[int], rest: str | None = rest, load: Callable = load) -> Iterator[pa.Table]:
                chosen: list[_Packed | _Sketch] = []
                whole = pa.concat_tables([rows(b, rest).sort_by("pos") for b in job]).combine_chunks()
                for k in range(0, whole.num_rows, block):
                    t = whole.slice(k, block)
                    x, at, free = load(t), np.arange(t.num_rows), np.ones(t.num_rows, bool)
                    for y in chosen:
                        free &= away(x, y)
                        if free.mean() < 0.8:  # else a smaller copy costs more than it saves
                            x, at, free = x.take(free), at[free], np.ones(int(free.sum()), bool)
                    x, at = x.take(free), at[free]
                    i, j = near(x, x)
                    cut, free = np.searchsorted(i, np.arange(len(at) + 1)), np.ones(len(at), bool)
                    for k in range(len(at)):
                        if free[k]:
                            free[j[cut[k] : cut[k + 1]]] = False
                            free[k] = True
                    chosen.append(x.take(free))
                    yield t.take(pa.array(at[free])).select(["pos", "n", "ids", "tf", "norm"])

            new = self._keep(materialize(self._each([first], greedy, self.ROW), "heads"))._gleaner_path
            out.append(new)
            later = {b: sizes[b] for b in sorted(set(sizes) - set(first))}
            if not later:
                break
            if len(out) == 1:
                self.basis = self._keep(materialize(self._axes(new), "basis"))._gleaner_path
                load = self._load()

            def open_rows(job: list[int], rest: str | None = rest, new: str = new, load: Callable = load) -> Iterator[pa.Table]:
                tables = [rows(b, rest) for b in job]
                of = np.repeat(np.array(job, np.int32), [t.num_rows for t in tables])
                whole = pa.concat_tables(tables).combine_chunks()
                open_ = [load(whole.slice(k, block)) for k in range(0, whole.num_rows, block)]
                free = [np.ones(len(x.pos), bool) for x in open_]
                t, block_of = _rows(new), dict(zip(whole["pos"].to_pylist(), of.tolist(), strict=True))
                for k in range(0, t.num_rows, block):
                    y = load(t.slice(k, block))
                    for at, x in enumerate(open_):
                        free[at] &= away(x, y)
                        if free[at].mean() < 0.8:  # else a smaller copy costs more than it saves
                            open_[at], free[at] = x.take(free[at]), np.ones(int(free[at].sum()), bool)
                for x, f in zip(open_, free, strict=True):
                    yield pa.table({"pos": x.pos[f], "b": pa.array([block_of[p] for p in x.pos[f].tolist()], pa.int32())})

            table = self._keep(materialize(self._each(self._groups(later, 1), open_rows, "pos bigint, b int"), "open", "b"))
            sizes, rest = self._sizes(table), table._gleaner_path
        return out

    def _load(self) -> Callable[[pa.Table], _Packed | _Sketch]:
        """What makes a block of rows of a task's table; a sketch once there is a basis that pays."""
        idf, path, buckets = self.idf, self.basis, BUCKETS

        def load(t: pa.Table | _Packed) -> _Packed | _Sketch:
            x = t if isinstance(t, _Packed) else _Packed.of(t, _idf(*idf))
            basis = _basis(path, len(_idf(*idf)), buckets) if path else None
            return x if basis is None else _Sketch(x, basis)

        return load

    def _axes(self, heads: str) -> DataFrame:
        """``term, axes``: common terms, most frequent first, and the axes of the first ones, along which the first leaders spread most.

        Any axes give right bounds; these give close ones. No rows where sketches are not expected to halve the work.
        """
        idf, block, dense, products = self.idf, BLOCK_ROWS, DENSE, PRODUCTS
        frequent, axes, buckets, most, share = FREQUENT, AXES, BUCKETS, COMMON, SHARE

        def run(job: str) -> Iterator[pa.Table]:
            df = _rows(idf[0], ["df"])
            df = np.asarray(df["df"].chunk(0)) if df is not None else np.zeros(0)
            order = np.argsort(-df, kind="stable")[:most]
            order = order[df[order] >= share * idf[1]]
            work = np.minimum((df / idf[1] * block) ** 2, dense)
            if len(order) < frequent or work.sum() < 2 * (work.sum() - work[order].sum() + dense * (axes + buckets)):
                return
            x = _Packed.of(_rows(job).slice(0, OPEN_BLOCKS * block), _idf(*idf))
            place = np.full(len(df), -1)
            place[order[:frequent]] = np.arange(frequent)
            at = place[x.term]
            d = np.zeros((len(x.pos), frequent), np.float32)
            d[x.row[at >= 0], at[at >= 0]] = x.w[at >= 0]
            v = np.linalg.eigh((d.T @ d).astype(np.float64))[1][:, ::-1][:, :axes]
            lists = [*v.astype(np.float32).tolist(), *[[]] * (len(order) - frequent)]
            yield pa.table({"term": pa.array(order, pa.int32()), "axes": pa.array(lists, pa.list_(pa.float32()))})

        return self._each([heads], run, "term int, axes array<float>")

    def last(self, heads: list[str]) -> DataFrame:
        """``rep, head``: the last leader up to each row; for a class of several rows all leaders, as its rows lie apart.

        Leaders are read from the last part on until all rows of a group of blocks have theirs.
        """
        path, idf, least, dense, products, block = self.path, self.idf, self.least, DENSE, PRODUCTS, BLOCK_ROWS
        load = self._load()

        def run(job: list[int]) -> Iterator[pa.Table]:
            lead = np.concatenate([np.asarray(_rows(part, ["pos"])["pos"].chunk(0)) for part in heads])
            many, rest = [], []
            for b in job:
                x = _Packed.of(_rows(f"{path}/b={b}").sort_by("pos"), _idf(*idf))
                leads = np.isin(x.pos, lead)
                yield pa.table({"rep": x.pos[leads], "head": x.pos[leads]})
                many.append(x.take(x.n > 1))
                x = x.take((x.n == 1) & ~leads)
                if rest and len(rest[-1].pos) + len(x.pos) <= block:
                    rest[-1] = _Packed.joined([rest[-1], x])
                else:
                    rest.append(x)
            many = load(_Packed.joined(many))
            single = [(load(x), np.ones(len(x.pos), bool)) for x in rest if len(x.pos)]
            for part in reversed(heads):
                if not single and not len(many.pos):
                    return
                t = _rows(part).sort_by("pos")
                for k in reversed(range(0, t.num_rows, block)):
                    if not len(many.pos) and not any(t["pos"][k].as_py() <= x.pos[-1] for x, _ in single):
                        continue
                    y = load(t.slice(k, block))
                    if len(many.pos):
                        i, j = _near(many, y, least, dense, products)
                        yield pa.table({"rep": many.pos[i], "head": y.pos[j]})
                    left = []
                    for x, free in single:
                        if y.pos[0] <= x.pos[-1]:
                            i, j = _near(x, y, least, dense, products)
                            before = (y.pos[j] <= x.pos[i]) & free[i]
                            i, j = i[before], j[before]
                            end = np.append(i[1:] != i[:-1], True)[: len(i)]
                            yield pa.table({"rep": x.pos[i[end]], "head": y.pos[j[end]]})
                            free[i] = False
                            if free.mean() < 0.8:
                                x, free = x.take(free), np.ones(int(free.sum()), bool)
                        if not len(x.pos):
                            continue
                        if left and len(left[-1][0].pos) + len(x.pos) <= block:
                            left[-1] = type(x).joined([left[-1][0], x]), np.append(left[-1][1], free)  # few rows are left of each
                        else:
                            left.append((x, free))
                    single = left

        return self._each(self._groups(self.sizes, 1), run, "rep bigint, head bigint")

    def links(self) -> DataFrame:
        """``rep, m``: rows of other classes that each class is similar to, in parts; each pair of blocks is met once."""
        path, idf, least, dense, products = self.path, self.idf, self.least, DENSE, PRODUCTS
        blocks = sorted(self.sizes)
        side = max(1, min(TILE, len(blocks) // 8))
        strips = [blocks[k : k + side] for k in range(0, len(blocks), side)]

        def run(tile: tuple[list[int], list[int]]) -> Iterator[pa.Table]:
            load = lambda b: _Packed.of(_rows(f"{path}/b={b}"), _idf(*idf))
            lefts = {b: load(b) for b in tile[0]}
            sums = {b: np.zeros(len(lefts[b].pos)) for b in lefts}
            for c in tile[1]:
                y = lefts[c] if c in lefts else load(c)
                back = np.zeros(len(y.pos))
                for b, x in lefts.items():
                    if b > c:
                        continue
                    i, j = _near(x, y, least, dense, products)
                    if b == c:
                        i, j = i[i != j], j[i != j]
                    sums[b] += np.bincount(i, y.n[j], len(x.pos))
                    if b != c:
                        back += np.bincount(j, x.n[i], len(y.pos))
                yield pa.table({"rep": y.pos, "m": back.astype(np.int64)})
            for b, x in lefts.items():
                yield pa.table({"rep": x.pos, "m": sums[b].astype(np.int64)})

        return self._each([(strips[i], strips[j]) for i in range(len(strips)) for j in range(i, len(strips))], run, "rep bigint, m bigint")


def leaders(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``pos, leader``: greedy leaders in ``pos`` order; a member goes to its last adjacent leader.

    ``edges`` (i < j). The greedy choice is the lexicographically first maximal
    independent set: in rounds, every open row without open earlier neighbour
    becomes a leader, and its later neighbours are closed.
    """
    edges = materialize(edges.select("i", "j"), "edges")
    state = materialize(nodes.select("pos", F.lit(0).alias("s")), "state")  # 0 open, 1 leader, 2 member
    while True:
        open_ = state.where("s = 0").select("pos")
        inner = edges.join(open_.withColumnRenamed("pos", "i"), "i", "left_semi")
        held = inner.select(F.col("j").alias("pos")).distinct()
        fresh = materialize(open_.join(held, "pos", "left_anti"), "leaders")
        if not fresh.limit(1).count():
            break
        closed = edges.join(fresh.withColumnRenamed("pos", "i"), "i", "left_semi").select(F.col("j").alias("pos")).distinct()
        marks = fresh.select("pos", F.lit(1).alias("m")).unionByName(closed.select("pos", F.lit(2).alias("m"))).groupBy("pos").agg(F.min("m").alias("m"))
        state = materialize(state.join(marks, "pos", "left").select("pos", F.when((F.col("s") == 0) & F.col("m").isNotNull(), F.col("m")).otherwise(F.col("s")).alias("s")), "state")
    heads = state.where("s = 1").select(F.col("pos").alias("i"))
    last = edges.join(heads, "i", "left_semi").groupBy(F.col("j").alias("pos")).agg(F.max("i").alias("head"))
    return state.join(last, "pos", "left").select("pos", F.when(F.col("s") == 1, F.col("pos")).otherwise(F.col("head")).alias("leader"))


def leader_groups(df: DataFrame, pos: str, text: str, least: float, links: bool = True) -> DataFrame:
    """``pos, leader``, with ``links`` also ``n_links``: TF-IDF leader grouping and the number of rows each row is similar to.

    Rows with equal token lists are one class and compared once; a leader is always
    the first row of its class, and a member goes to the last leader before it that
    is adjacent to its class. A text without tokens (NULL, empty, marks only) is
    alone. ``pos`` must be a unique number. Grouping holds rows against leaders only; counting
    links holds all representatives against all, in blocks, and counts where they meet.
    """
    kind = df.schema[pos].dataType.simpleString()
    cut = df.select(F.col(pos).cast("bigint").alias("pos"), word_tokens(F.col(text)).alias("t"))
    rows, seen = counted(cut.select("pos", F.transform("t", lambda t: F.xxhash64(t)).alias("h"), F.when(F.size("t") > 0, F.md5(F.array_join("t", " "))).alias("c")), "rows")
    classes = materialize(rows.where("c is not null").groupBy("c").agg(F.min("pos").alias("rep"), F.count("*").alias("n")), "classes")
    member = sized_join(rows.select("pos", "c"), classes, ["c"], "left").select("pos", F.coalesce("rep", "pos").alias("rep"), F.coalesce("n", F.lit(1)).alias("n"), F.col("c").isNotNull().alias("c"))
    member = materialize(member, "member")
    discard(classes)
    shelf = _Shelf(rows, "pos", "h", member, seen["n"], least)
    discard(rows)
    near = materialize(shelf.last(shelf.heads()), "near")
    met = materialize(shelf.links().groupBy("rep").agg(F.sum("m").alias("m")), "met") if links else None
    shelf.discard()
    placed = member.select("pos", "rep").join(near, "rep").where("head <= pos").groupBy("pos").agg(F.max("head").alias("leader"))
    out = member.join(placed, "pos", "left").select(F.col("pos").cast(kind), "rep", "n", F.coalesce("leader", "pos").cast(kind).alias("leader"))
    if not links:
        return out.select("pos", "leader")
    return out.join(met, "rep", "left").select("pos", "leader", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"))


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pos, root``: smallest ``pos`` of each connected component; star contraction with pointer jumping."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    up = materialize(nodes.select("pos", F.col("pos").alias("root")), "roots")
    while True:
        links = materialize(links, "links")
        if not links.limit(1).count():
            return up
        best = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).groupBy(F.col("x.a").alias("root")).agg(F.min("x.b").alias("low"))
        best = best.where("low < root")
        hop = best
        # follow the chosen pointers to their ends
        while True:
            hop = materialize(hop, "hop")
            far = hop.join(hop.select(F.col("root").alias("low"), F.col("low").alias("end")), "low", "left")
            if not far.where("end is not null").limit(1).count():
                break
            hop = far.select("root", F.coalesce("end", "low").alias("low"))
        up = materialize(up.join(hop, "root", "left").select("pos", F.coalesce("low", "root").alias("root")), "roots")
        move = lambda df, c: df.join(hop.select(F.col("root").alias(c), F.col("low").alias(f"{c}2")), c, "left").withColumn(c, F.coalesce(f"{c}2", c)).drop(f"{c}2")
        links = move(move(links, "a"), "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def or_merge(groups: DataFrame) -> DataFrame:
    """``pos, cluster_id``: rows that share ``title_id`` or ``body_id`` are one cluster, with chaining."""
    edges = groups.select(F.col("pos").alias("a"), F.col("title_id").alias("b")).unionByName(groups.select(F.col("pos").alias("a"), F.col("body_id").alias("b")))
    return components(edges, groups.select("pos")).withColumnRenamed("root", "cluster_id")


def and_merge(groups: DataFrame) -> DataFrame:
    """``pos, cluster_id``: equal ``(title_id, body_id)`` pairs, without chaining."""
    least = groups.groupBy("title_id", "body_id").agg(F.min("pos").alias("cluster_id"))
    return groups.join(least, ["title_id", "body_id"]).select("pos", "cluster_id")


def elect(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Add ``is_canon`` and ``replaced_by``: two or more agency rows: the newest of them; one: it; none: the oldest row.

    Unparsed times come last either way, ties go to the smallest ``pos``. All rows
    that carry an elected ``news_id`` are canonical. The winner is a map-side
    minimum per cluster, and hot clusters are joined by salt.
    """
    t = F.unix_micros("pub_ts")
    agency = F.coalesce("is_agency", F.lit(False))
    order = F.struct(F.when(agency, 0).otherwise(1).alias("g"), F.coalesce(F.when(agency, -t).otherwise(t), F.lit(1 << 62)).alias("t"), F.col("pos").alias("p"), F.col("news_id").alias("id"))
    won = materialize(df.groupBy(cluster).agg(F.min(order)["id"].alias("replaced_by")), "won")
    ids = won.select(F.col("replaced_by").alias("news_id")).distinct().withColumn("__c", F.lit(True))
    out = sized_join(df, won, [cluster]).join(ids, "news_id", "left")
    return out.withColumn("is_canon", F.coalesce("__c", F.lit(False))).drop("__c")


def _fingerprint(kept: str, size: int = 4) -> int:
    """Majority of the bits of all shingle hashes (last eight bytes of md5), as a signed number."""
    grams = [kept[i : i + size] for i in range(max(len(kept) - size + 1, 1))]
    tails = b"".join(hashlib.md5(g.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()[8:] for g in grams)
    ones = np.unpackbits(np.frombuffer(tails, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big", signed=True)


def simhash(df: DataFrame, pos: str, text: str, out: str) -> DataFrame:
    """``pos, out``: 64-bit SimHash over 4-character shingles, weights by multiplicity; NULL is ''.

    A bit is one if more than half of all shingles have it. A map without shuffle;
    the votes of a text are counted in one array.
    """
    kept = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]", "")
    kind = df.schema[pos].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_fingerprint(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["pos", out])

    return df.select(F.col(pos).alias("pos"), kept.alias("kept")).mapInArrow(run, f"pos {kind}, `{out}` bigint")


def simhash_pairs(prints: DataFrame, title_distance: int = 10, body_distance: int = 14) -> DataFrame:
    """``i, j`` (i < j) of classes of equal prints within both distances; exact.

    Rows with equal prints are one class, named by its smallest ``pos``. Every two
    classes are compared, in blocks that the tasks read from the shared folder; so
    nothing is shuffled and no join splits into many tasks.
    """
    kind = prints.schema["pos"].dataType.simpleString()
    reps = prints.groupBy("title_fp", "body_fp").agg(F.min("pos").alias("pos"))
    reps, seen = counted(reps, "prints")
    k = max(1, math.ceil(seen["n"] / PRINT_ROWS))
    shelf = materialize(reps.withColumn("b", F.pmod(F.xxhash64("pos"), F.lit(k)).cast("int")).repartition(min(k, 200), "b"), "shelf", "b")
    path, size = shelf._gleaner_path, PRINT_SLICE
    strips = [range(at, min(at + PRINT_TILE, k)) for at in range(0, k, PRINT_TILE)] if k > 16 * PRINT_TILE else [range(b, b + 1) for b in range(k)]
    tiles = [(strips[i], strips[j]) for i in range(len(strips)) for j in range(i, len(strips))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in (tiles[t] for t in batch.column(0).to_pylist()):
                blocks = {b: _rows(f"{path}/b={b}") for b in sorted({*left, *right})}
                parts = {b: (np.asarray(t["title_fp"].chunk(0)).view(np.uint64), np.asarray(t["body_fp"].chunk(0)).view(np.uint64), np.asarray(t["pos"].chunk(0))) for b, t in blocks.items() if t is not None}
                for t1, b1, p1, t2, b2, p2 in ((*parts[x], *parts[y]) for x in left for y in right if x <= y and x in parts and y in parts):
                    for at in range(0, len(p1), size):
                        near = np.bitwise_count(t1[at : at + size, None] ^ t2) <= title_distance
                        i, j = np.divmod(np.flatnonzero(near), len(p2))
                        close = np.bitwise_count(b1[at + i] ^ b2[j]) <= body_distance
                        x, y = p1[at + i[close]], p2[j[close]]
                        x, y = (x, y) if p1 is not p2 else (x[x < y], y[x < y])
                        if len(x):
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["i", "j"])

    return prints.sparkSession.range(0, len(tiles), 1, len(tiles)).mapInArrow(run, f"i {kind}, j {kind}")


def _linked_leaders(edges: DataFrame) -> DataFrame:
    """``pos, leader`` of the rows that stand in ``edges`` (i < j), chosen in one task; as ``leaders`` does."""
    kind = edges.schema["i"].dataType.simpleString()
    whole = pa.int64() if kind == "bigint" else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [(i, j) for batch in batches for i, j in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        head = {}  # the last leader before each row
        for i, j in sorted(pairs):
            if i not in head:
                head[j] = i
        nodes = sorted({x for pair in pairs for x in pair})
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()).cast(whole) for x in (nodes, [head.get(x, x) for x in nodes])], names=["pos", "leader"])

    return edges.select("i", "j").repartition(1).mapInArrow(run, f"pos {kind}, leader {kind}")


def simhash_dedup(df: DataFrame, pos: str, title_distance: int = 10, body_distance: int = 14) -> DataFrame:
    """``pos, removed_by``: NULL for kept rows, 'simhash' for rows near an earlier kept one."""
    prints = materialize(simhash(df, pos, "title", "title_fp").join(simhash(df, pos, "content", "body_fp"), "pos"), "fp")
    pairs, seen = counted(simhash_pairs(prints, title_distance, body_distance), "pairs")
    reps = prints.groupBy("title_fp", "body_fp").agg(F.min("pos").alias("rep"))
    named = materialize(prints.join(reps, ["title_fp", "body_fp"]).select("pos", "rep"), "reps")
    if seen["n"] <= PAIRS:
        chosen = materialize(_linked_leaders(pairs), "chosen")
    else:
        chosen = leaders(named.select(F.col("rep").alias("pos")).distinct(), pairs)
    gone = (F.col("pos") != F.col("rep")) | (F.col("leader") != F.col("rep"))
    out = sized_join(named, chosen.withColumnRenamed("pos", "rep"), ["rep"], "left")
    return out.select("pos", F.when(F.coalesce(gone, F.col("pos") != F.col("rep")), "simhash").alias("removed_by"))


def cluster_rows(df: DataFrame, title: float, body: float, mode: str = "or") -> DataFrame:
    """``pos, title_id, body_id, cluster_id`` of title and body leader groups, merged by ``mode``."""
    with ThreadPoolExecutor(2) as pool:  # two chains of jobs that don't depend on each other
        t = pool.submit(leader_groups, df, "pos", "title", title, False)
        b = pool.submit(leader_groups, df, "pos", "content", body, False)
        t, b = t.result().select("pos", F.col("leader").alias("title_id")), b.result().select("pos", F.col("leader").alias("body_id"))
    groups = materialize(t.join(b, "pos"), "groups")
    merged = or_merge(groups) if mode == "or" else and_merge(groups)
    return groups.join(merged, "pos")


def global_dedup(df: DataFrame, title: float = 0.20, body: float = 0.19) -> DataFrame:
    """Rows with cluster, ``is_canon`` and ``removed_by``: one row per cluster is kept."""
    return elect(df.join(cluster_rows(df, title, body), "pos")).withColumn("removed_by", F.when(~F.col("is_canon"), "global_similarity"))


def group_numbers(groups: DataFrame, leader: str = "leader") -> DataFrame:
    """``pos, group_id``: groups numbered from 0 in the order of their leaders."""
    heads = groups.select(leader).distinct()
    # leaders are ranked in ranges: the counts of lower ranges are few and are summed first
    part = F.shiftright(F.col(leader).cast("bigint"), 16)
    sizes = heads.groupBy(part.alias("p")).agg(F.count("*").alias("n"))
    before = sizes.select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("p").orderBy(leader))
    numbered = heads.withColumn("p", part).withColumn("k", rank).join(before, "p").select(leader, (F.col("before") + F.col("k") - 1).alias("group_id"))
    return groups.join(numbered, leader).select("pos", "group_id")


def label(prefix: str, c: Column) -> Column:
    """Group label such as ``C-7``; NULL stays NULL."""
    return F.concat(F.lit(f"{prefix}-"), c.cast("string"))


def consecutive_pairs(rows: DataFrame, groups: list[str], via: str) -> DataFrame:
    """``a, b, via``: each row of a group and the next one in ``pos`` order."""
    nxt = F.lead("pos").over(Window.partitionBy(*groups).orderBy("pos"))
    return rows.select(F.col("pos").alias("a"), nxt.alias("b"), F.lit(via).alias("via")).where("b is not null")


def probe(df: DataFrame, title: float = 0.20, body: float = 0.20, mode: str = "or") -> tuple[DataFrame, DataFrame]:
    """Candidates (rows of clusters of two or more, with ``global_sim_cluster``) and edges ``src, dst, via``; nothing is deleted.

    ``mode`` 'or' links neighbours in a title group and in a body group, 'and' those in
    both ('title+body'). Ends are given by ``news_id``.
    """
    if mode not in ("or", "and"):
        raise ValueError(f"unknown mode {mode!r}")
    merged = materialize(cluster_rows(df, title, body, mode), "probe")
    if mode == "or":
        pairs = consecutive_pairs(merged, ["title_id"], "title").unionByName(consecutive_pairs(merged, ["body_id"], "body"))
    else:
        pairs = consecutive_pairs(merged, ["title_id", "body_id"], "title+body")
    ids = df.select("pos", "news_id")
    edges = pairs.join(ids.withColumnsRenamed({"pos": "a", "news_id": "src"}), "a").join(ids.withColumnsRenamed({"pos": "b", "news_id": "dst"}), "b").select("src", "dst", "via")
    many = merged.groupBy("cluster_id").agg(F.count("*").alias("n")).where("n > 1").select("cluster_id")
    hit = merged.join(many, "cluster_id", "left_semi").select("pos", label("G", F.col("cluster_id")).alias("global_sim_cluster"))
    return df.join(hit, "pos"), edges


def group_counts(groups: DataFrame, group: str = "cluster_id") -> DataFrame:
    """``n_rows, n_groups, n_similar``: rows that share a group with an earlier one are similar."""
    n = F.count("*")
    return groups.agg(n.alias("n_rows"), F.count_distinct(group).alias("n_groups"), (n - F.count_distinct(group)).alias("n_similar"))


def repeated_ids(groups: DataFrame, group: str = "cluster_id", key: str = "news_id") -> DataFrame:
    """``group, n_rows, n_ids`` of clusters in which an id stands twice; NULL ids count as none."""
    counts = groups.groupBy(group).agg(F.count(key).alias("n_rows"), F.count_distinct(key).alias("n_ids"))
    return counts.where("n_rows > n_ids")


def arrival(df: DataFrame) -> list[Column]:
    """Order of arrival before SimHash: ``collected_at``, without that column ``pubdate``, as text; ties by ``pos``."""
    first = next((c for c in ("collected_at", "pubdate") if c in df.columns), None)
    return [*([F.col(first).asc_nulls_last()] if first else []), F.col("pos").asc()]


def keyword_cluster(df: DataFrame, title: float = 0.18, body: float = 0.17) -> tuple[DataFrame, DataFrame]:
    """Rows with ``cluster_id, title_id, body_id`` as labels, ``is_canon``, ``replaced_by``, and one row of counts.

    Titles are normalised before grouping, bodies are taken as they are, from
    ``content`` or, without it, ``body``.
    """
    rows = df.withColumn("__t", normalize_title(F.col("title")))
    text = "content" if "content" in df.columns else "body"
    cut = rows.select("pos", F.col("__t").alias("title"), F.col(text).alias("content"))
    chosen = elect(df.select("pos", "news_id", "pub_ts", "is_agency").join(cluster_rows(cut, title, body), "pos"))
    labels = [label(k, F.col(c)).alias(c) for k, c in (("C", "cluster_id"), ("T", "title_id"), ("B", "body_id"))]
    chosen = materialize(chosen.select("pos", *labels, "is_canon", "replaced_by"), "clustered")  # texts are joined again only if asked for
    stats = chosen.agg(F.count("*").alias("fetched"), F.count_distinct("cluster_id").alias("similar_groups"), F.count_if("is_canon").alias("canonical_count"))
    return df.join(chosen, "pos"), stats


def elect_by(df: DataFrame, policy: Callable[[pd.DataFrame], pd.Series], cluster: str = "cluster_id") -> DataFrame:
    """``cluster, replaced_by`` by any policy that picks one row of a cluster given as a pandas table.

    A cluster goes to one task whole; for the usual policy take ``elect``, which needs no such thing.
    """
    kind = df.schema[cluster].dataType.simpleString()
    pick = lambda pdf: pd.DataFrame({cluster: [pdf[cluster].iloc[0]], "replaced_by": [policy(pdf)["news_id"]]})
    return df.groupBy(cluster).applyInPandas(pick, f"{cluster} {kind}, replaced_by string")
