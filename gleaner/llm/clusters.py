"""Grouping vectors into similarity clusters: parallel pivot correlation clustering.

Vectors meet in buckets of random hyperplane signatures. In every bucket the
vectors are taken in the order of a hash of their id: the smallest is a local
minimum, those like it are its neighbours, the smallest of the rest is the next, and so
on. A round's pivots are the vectors that are a minimum in all of their buckets; only
neighbours of such pivots are absorbed, while those of a vector that is itself a
neighbour elsewhere stay. Absorbed vectors leave; all others go on to the next round
with new hyperplanes. At last every member is reassigned to the closest pivot, members
like none of them go into further rounds, and medoids are computed from cluster sums.
Buckets are read as streams against their minima, so neither all pairs of a bucket nor
the bucket itself is ever held.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import counted, discard, materialize, sized_join

SIMILAR = 0.88
DIMENSIONS = 64
#: Signatures per round, and how often a pair at the least cosine must meet in some signature.
TABLES, RECALL = 8, 0.999
#: Vectors that chance brings into one bucket, about.
BUCKET_MEAN = 64
#: Rows of a bucket that one task takes, about; larger buckets are split by a hash of the id, and what is left of their parts is held against each other.
BUCKET_ROWS = 20_000
_STEP = 512


def plan(n: int, least: float = SIMILAR) -> tuple[int, int]:
    """Bits of a signature for ``n`` vectors, and the rounds that hold the recall at the least cosine."""
    bits = max(4, math.ceil(math.log2(max(n, 2) / BUCKET_MEAN)))
    meet = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - meet) / TABLES)


def valid_vectors(items: DataFrame, dim: int = DIMENSIONS) -> DataFrame:
    """``item_id, pri, vec``: unit vectors of items whose vector is whole, finite and not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # NULL is NaN
            with np.errstate(all="ignore"):
                n = np.sqrt((x * x).sum(1))
                good = np.isfinite(x).all(1) & (np.abs(x) < 1e30).all(1) & (n > 0)
                unit = (x[good] / n[good, None]).astype(np.float32)
            ids = [c.filter(pa.array(good)) for c in batch.columns[:2]]
            ends = pa.array(np.arange(0, len(unit) * dim + 1, dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*ids, pa.ListArray.from_arrays(ends, pa.array(unit.ravel()))], names=["item_id", "pri", "vec"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.where("item_id is not null and embedding is not null").where(F.size("embedding") == dim)
    return rows.select("item_id", F.xxhash64("item_id").alias("pri"), F.col("embedding").cast("array<double>")).mapInArrow(run, f"item_id {kind}, pri bigint, vec array<float>")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, dim)


def _signatures(vectors: DataFrame, rnd: int, bits: int, dim: int) -> DataFrame:
    """``item_id, pri, vec, bucket``, one row per signature of the round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(7919 + rnd).standard_normal((dim, TABLES * bits)).astype(np.float32)
        weights = (1 << np.arange(bits, dtype=np.int64))[None, None, :]
        for batch in batches:
            x = _matrix(batch.column(2), dim)
            side = (x @ planes > 0).reshape(len(x), TABLES, bits)
            code = (side * weights).sum(-1) * TABLES + np.arange(TABLES)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * TABLES + 1, TABLES, dtype=np.int32)), pa.array(code.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["item_id", "pri", "vec", "buckets"])

    kind = vectors.schema["item_id"].dataType.simpleString()
    signed = vectors.mapInArrow(run, f"item_id {kind}, pri bigint, vec array<float>, buckets array<bigint>")
    return signed.select("item_id", "pri", "vec", F.explode("buckets").alias("bucket"))


def _absorb(least: float, dim: int):
    """Stream of rows sorted by bucket and hash -> ``item_id, pivot, sim``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pivots, ids = None, np.empty((0, dim), np.float32), np.empty(0, np.int64)
        for batch in batches:
            key = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))], 1)
            item, x = np.asarray(batch.column(2)), _matrix(batch.column(3), dim)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if b == a:
                    continue
                k = tuple(key[a])
                if k != now:
                    now, pivots, ids = k, np.empty((0, dim), np.float32), np.empty(0, np.int64)
                for lo in range(a, b, _STEP):
                    v, who = x[lo : min(b, lo + _STEP)], item[lo : min(b, lo + _STEP)]
                    if len(ids):
                        s = v @ pivots.T
                        best = s.argmax(1)
                        top = s[np.arange(len(v)), best]
                        hit = top >= least
                        if hit.any():
                            out.append((who[hit], ids[best[hit]], top[hit]))
                            v, who = v[~hit], who[~hit]
                    if len(v) > 1:
                        near = v @ v.T
                        free = np.ones(len(v), bool)
                        if (near >= least).sum() > len(v):
                            for i in range(len(v)):
                                if free[i]:
                                    mine = free & (near[i] >= least)
                                    mine[: i + 1] = False
                                    if mine.any():
                                        out.append((who[mine], np.full(mine.sum(), who[i]), near[i][mine]))
                                        free &= ~mine
                        v, who = v[free], who[free]
                    pivots, ids = (np.concatenate([pivots, v]), np.concatenate([ids, who])) if len(ids) else (v, who)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["item_id", "pivot", "sim"])

    return run


def _split(rows: DataFrame) -> DataFrame | None:
    """``bucket, n`` of the buckets above ``BUCKET_ROWS``; None if there are none."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS)
    large = materialize(sizes, "large")
    return large if large.limit(1).count() else None


def _absorbed(rows: DataFrame, least: float, dim: int) -> DataFrame:
    """``item_id, pivot, sim`` of the rows absorbed within their bucket and salt."""
    rows = rows.select("bucket", "salt", "item_id", "vec", "pri").repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "pri")
    return materialize(rows.select("bucket", "salt", "item_id", "vec").mapInArrow(_absorb(least, dim), "item_id bigint, pivot bigint, sim float").distinct(), "edges")


def _round(active: DataFrame, rnd: int, bits: int, n: int, least: float, dim: int) -> DataFrame:
    """``item_id, pivot, sim`` of a round: of two similar vectors in one bucket, one is absorbed.

    A bucket above ``BUCKET_ROWS`` is first absorbed part by part, which shrinks hot
    clusters to a pivot a part. What is left of it is then held against all the rest:
    if it is still above ``BUCKET_ROWS``, every two half-size parts are one task, so a
    dense region without similar vectors costs the square of its rows but loses none.
    """
    rows = _signatures(active, rnd, bits, dim)
    large = _split(rows) if n > BUCKET_ROWS else None
    if large is None:
        return _absorbed(rows.withColumn("salt", F.lit(0).cast("bigint")), least, dim)
    marked = sized_join(rows, large, ["bucket"], "left")
    part = F.pmod("pri", F.ceil(F.col("n") / BUCKET_ROWS))
    found = _absorbed(marked.withColumn("salt", F.coalesce(part, F.lit(0))), least, dim)

    left = active.join(found.select("item_id").distinct(), "item_id", "left_anti")
    rest = sized_join(_signatures(left, rnd, bits, dim), large.select("bucket"), ["bucket"], "left_semi")
    still = _split(rest)
    if still is None:
        rest = rest.withColumn("salt", F.lit(0).cast("bigint"))
    else:
        halves = still.select("bucket", F.ceil(2 * F.col("n") / BUCKET_ROWS).alias("parts"))
        rest = sized_join(rest, halves, ["bucket"], "left").withColumn("own", F.pmod("pri", "parts"))
        others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda k: k != F.col("own"))
        tasks = F.transform(others, lambda k: F.least("own", k) * F.col("parts") + F.greatest("own", k))
        rest = rest.withColumn("salt", F.explode(F.coalesce(tasks, F.array(F.lit(0).cast("bigint")))))
    return found.unionByName(_absorbed(rest, least, dim))


def _placed(active: DataFrame, loose: DataFrame, first: int, least: float, dim: int) -> tuple[DataFrame, DataFrame, int]:
    """Rounds from number ``first`` on over ``active`` (``item_id, pri, vec``), in which only ``loose`` items are absorbed.

    Returns ``item_id, pivot, sim`` of the absorbed items that are like a pivot that
    stays, ``item_id`` of those that are like none, and the number of the next round.
    A vector that some bucket absorbs is no pivot of its round, and what another bucket
    would have it absorb waits for the next. Rounds go on beyond the planned number
    while the last one left a vector waiting, as its recall would not be that of all rounds.
    """
    n = active.count()
    bits, rounds = plan(n, least)
    vectors, edges, rnd, waiting = active, None, first, 0
    while rnd < first + rounds or waiting:
        found = _round(active, rnd, bits, n, least, dim)
        found = found if loose is vectors else found.join(loose.select("item_id"), "item_id", "left_semi")
        below = found.select(F.col("item_id").alias("pivot")).distinct()
        true, seen = counted(found.join(below, "pivot", "left_anti").select("item_id", "pivot", "sim"), "absorbed")
        gone, all_ = true.select("item_id").distinct(), found.select("item_id").distinct()
        waiting = all_.join(gone, "item_id", "left_anti").count() if rnd + 1 >= first + rounds and seen["n"] else 0
        edges = true if edges is None else edges.unionByName(true)
        before, active = active, materialize(active.join(gone, "item_id", "left_anti"), "active") if seen["n"] else active
        if before is not active and before is not vectors:
            discard(before)
        rnd += 1
    # every edge leads to an id of smaller hash, so following them ends at a root
    up = materialize(edges.groupBy("item_id").agg(F.max_by("pivot", F.struct("sim", "pivot")).alias("up")), "up")
    while True:
        above = up.select(F.col("item_id").alias("up"), F.col("up").alias("top"))
        far = up.join(above, "up", "left").select("item_id", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved"))
        far = materialize(far, "up")
        up = far.select("item_id", "up")
        if not far.where("moved").limit(1).count():
            break
    roots = edges.join(up.withColumnsRenamed({"item_id": "pivot", "up": "root"}), "pivot", "left").select("item_id", F.coalesce("root", "pivot").alias("pivot")).distinct()
    heads = vectors.join(roots.select(F.col("pivot").alias("item_id")).distinct(), "item_id", "left_semi").select(F.col("item_id").alias("pivot"), F.col("vec").alias("head"))
    near = roots.join(heads, "pivot").join(vectors.select("item_id", "vec"), "item_id")
    dot = F.aggregate(F.zip_with("vec", "head", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, b: a + b)
    closest = near.select("item_id", "pivot", dot.alias("sim")).where(F.col("sim") >= least - 1e-6).groupBy("item_id").agg(F.max_by("pivot", F.struct("sim", "pivot")).alias("pivot"), F.max("sim").alias("sim"))
    closest = materialize(closest, "closest")
    return closest, materialize(up.select("item_id").join(closest, "item_id", "left_anti"), "lost"), rnd


def pivot_clusters(items: DataFrame, least: float = SIMILAR, dim: int = DIMENSIONS) -> DataFrame:
    """``item_id, pivot, sim`` of every valid item: its cluster's pivot and the cosine to it.

    An item that is like no other is its own pivot. Items whose vector is NULL,
    zero, of another length or not finite are left out. Equal vectors meet in
    every bucket. ``item_id`` must be a bigint without repeats; repeated rows of
    an item count once.

    Where similarity has chains, an item may be absorbed by one that goes to a pivot
    unlike it. Such items go into further rounds, behind all pivots that stay, until
    each is with a similar pivot or is one itself; every turn settles one at least.
    """
    vectors = materialize(valid_vectors(items, dim).dropDuplicates(["item_id"]), "vectors")
    closest, lost, rnd = _placed(vectors, vectors, 0, least, dim)
    while lost.limit(1).count():
        half = F.shiftright(F.xxhash64("item_id"), 1)
        loose = vectors.join(lost, "item_id", "left_semi").withColumn("pri", half + F.lit(1 << 62))
        stay = vectors.join(closest.select("item_id").unionByName(lost), "item_id", "left_anti").withColumn("pri", half - F.lit(1 << 62))
        more, lost, rnd = _placed(materialize(stay.unionByName(loose), "active"), lost, rnd, least, dim)
        closest = closest.unionByName(more)
    return vectors.select("item_id").join(closest, "item_id", "left").select("item_id", F.coalesce("pivot", "item_id").alias("pivot"), F.coalesce("sim", F.lit(1.0)).alias("sim"))


def found_clusters(items: DataFrame) -> DataFrame:
    """``item_id, issue_cluster_id``: items in clusters of two or more, with the smallest id of the cluster."""
    clusters = materialize(pivot_clusters(items), "clusters")
    names = clusters.groupBy("pivot").agg(F.min("item_id").alias("issue_cluster_id"), F.count("*").alias("cluster_size")).where("cluster_size >= 2")
    return clusters.join(names, "pivot").select("item_id", "issue_cluster_id")


def issue_rows(items: DataFrame, top: int = 5, dim: int = DIMENSIONS) -> DataFrame:
    """Issue rows: ``issue_cluster_id, cluster_size, medoid_item_id, representative_titles``.

    The medoid is the member with the largest sum of cosines to all members, which
    is its product with the cluster's vector sum; the titles are those of the ``top``
    members with a title closest to it, the same title once.
    """
    vectors = valid_vectors(items, dim).dropDuplicates(["item_id"]).select("item_id", "vec")
    member = materialize(found_clusters(items).join(vectors, "item_id"), "members")
    sums = member.groupBy("issue_cluster_id").agg(F.count("*").alias("cluster_size"), *[F.sum(F.get("vec", F.lit(i)).cast("double")).alias(f"s{i}") for i in range(dim)])
    sums = materialize(sums.select("issue_cluster_id", "cluster_size", F.array(*[f"s{i}" for i in range(dim)]).alias("total")), "sums")
    product = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda p, q: p + q)
    scored = sized_join(member, sums, ["issue_cluster_id"])
    rank = F.struct(F.round(product("vec", "total"), 9).alias("s"), (-F.col("item_id")).alias("i"))
    medoid = scored.groupBy("issue_cluster_id", "cluster_size").agg(F.max(rank).alias("m")).select("issue_cluster_id", "cluster_size", (-F.col("m.i")).alias("medoid_item_id"))
    heads = member.select(F.col("item_id").alias("medoid_item_id"), F.col("vec").alias("head"))
    medoid = materialize(medoid.join(heads, "medoid_item_id"), "medoids")
    titles = items.where("title is not null").groupBy("item_id").agg(F.min("title").alias("title"))
    close = sized_join(member.select("item_id", "issue_cluster_id", "vec"), medoid.select("issue_cluster_id", "head"), ["issue_cluster_id"])
    close = close.select("item_id", "issue_cluster_id", F.round(product("vec", "head"), 9).alias("sim")).join(titles, "item_id")
    once = close.groupBy("issue_cluster_id", "title").agg(F.max("sim").alias("sim"), F.min("item_id").alias("first"))
    # ten salts keep the best of their share, then the best of those are merged
    from pyspark.sql import Window

    part = F.pmod(F.xxhash64("title"), F.lit(10))
    order = [F.desc("sim"), "first"]
    best = once.withColumn("part", part).withColumn("k", F.row_number().over(Window.partitionBy("issue_cluster_id", "part").orderBy(*order))).where(F.col("k") <= top)
    best = best.withColumn("k", F.row_number().over(Window.partitionBy("issue_cluster_id").orderBy(*order))).where(F.col("k") <= top)
    lists = best.groupBy("issue_cluster_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "title"))), lambda x: x["title"]).alias("representative_titles"))
    return medoid.drop("head").join(lists, "issue_cluster_id", "left").withColumn("representative_titles", F.coalesce("representative_titles", F.array().cast("array<string>")))
