"""Vector operators: cosine search, centroids, representatives, cluster quality, density clustering."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.session import materialize, sized_join

#: Rows that one density clustering takes; it is meant for one short window of rows.
WINDOW_ROWS = 20_000
#: Queries that one pass of the vector search holds against all rows.
QUERY_ROWS = 2_000
#: Clusters whose vector sums go to the workers at once.
CLUSTER_ROWS = 16_384


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; zero if either is a zero vector, NULL if either is NULL."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(F.when(n.isNotNull(), F.lit(0.0)))


def topk(corpus: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, sim``: the ``k`` corpus vectors closest to each query.

    The queries are held against all rows in blocks of ``QUERY_ROWS``, one pass a
    block; each batch keeps its best ``k`` per query before the shuffle. Where there
    is more than one block, each block's result is written, so the driver holds one
    block at a time. Vectors that are NULL or of another length have no rank.
    """
    whole = queries.where("embedding is not null").select("query_id", "embedding")
    blocks = itertools.batched(whole.toLocalIterator(), QUERY_ROWS)
    block, ahead = next(blocks, ()), next(blocks, None)
    out = _topk_block(corpus, block, k)
    if ahead is None:
        return out
    out = materialize(out, "topk")
    for block in itertools.chain([ahead], blocks):
        out = out.unionByName(materialize(_topk_block(corpus, block, k), "topk"))
    return out


def _topk_block(corpus: DataFrame, block: tuple, k: int) -> DataFrame:
    """``topk`` for one block of query rows."""
    ids = np.array([r["query_id"] for r in block], np.int64)
    q = np.array([r["embedding"] for r in block], np.float64) if len(ids) else np.empty((0, 0))
    q /= np.where((n := np.linalg.norm(q, axis=1, keepdims=True)) > 0, n, 1) if len(ids) else 1
    dim = q.shape[1]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(ids) or not batch.num_rows:
                continue
            vec = np.asarray(batch.column(0), np.int64)
            x = np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, dim)
            sims = np.round(x @ q.T / np.where((m := np.linalg.norm(x, axis=1, keepdims=True)) > 0, m, 1), 9)
            top = np.stack([np.lexsort((vec, -sims[:, j]))[:k] for j in range(len(ids))])
            at = np.arange(len(ids))[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, top.shape[1])), pa.array(vec[top].ravel()), pa.array(sims[top, at].ravel())], names=["query_id", "vec_id", "sim"])

    whole = F.col("embedding").isNotNull() & (F.size("embedding") == dim)
    found = corpus.where(whole).select("vec_id", "embedding").mapInArrow(best, "query_id bigint, vec_id bigint, sim double")
    order = [F.col("sim").desc(), F.col("vec_id")]
    part = W.partitionBy("query_id", F.pmod("vec_id", F.lit(64))).orderBy(*order)
    first = found.withColumn("r", F.row_number().over(part)).where(F.col("r") <= k)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "sim")


def centroids(df: DataFrame, label: str = "label", dim: int = 64) -> DataFrame:
    """``label, size, centroid``: plain mean per label, not normalised; one partial aggregate."""
    means = [F.avg(F.get("embedding", F.lit(i)).cast("double")).alias(f"m{i}") for i in range(dim)]
    return df.groupBy(label).agg(F.count("*").alias("size"), *means).select(label, "size", F.array(*[f"m{i}" for i in range(dim)]).alias("centroid"))


def representatives(df: DataFrame, label: str = "label", k: int = 5, dim: int = 64) -> DataFrame:
    """``label, rank, vec_id, sim``: the ``k`` members closest to each centroid."""
    centres = materialize(centroids(df, label, dim).select(label, "centroid"), "centres")
    sims = sized_join(df, centres, [label]).select(label, "vec_id", F.round(cosine(F.col("embedding"), F.col("centroid")), 9).alias("sim"))
    order = [F.col("sim").desc(), F.col("vec_id")]
    part = W.partitionBy(label, F.pmod("vec_id", F.lit(64))).orderBy(*order)
    best = sims.withColumn("r", F.row_number().over(part)).where(F.col("r") <= k)
    return best.withColumn("rank", F.row_number().over(W.partitionBy(label).orderBy(*order))).where(F.col("rank") <= k).select(label, "rank", "vec_id", "sim")


def silhouette(df: DataFrame, label: str = "label", dim: int = 64) -> DataFrame:
    """``silhouette``: mean cosine silhouette; 0 with fewer than two labels or rows.

    Mean distances to a cluster follow from the cluster's vector sum, so no pair of
    rows is ever formed; sums go to the workers in blocks of ``CLUSTER_ROWS``, each one
    more map over the rows. Rows of a cluster of one count as 0; NULL labels are no cluster.
    """
    norm = F.sqrt(dot(F.col("embedding"), F.col("embedding")))
    unit = df.where("embedding is not null").where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.get(F.transform(F.array(norm), lambda n: F.transform("embedding", lambda x: x / n)), F.lit(0)).alias("u"))
    sums = [F.sum(F.get("u", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    clusters = materialize(unit.groupBy("label").agg(F.count("*").alias("n"), *sums).select("label", "n", F.array(*[f"s{i}" for i in range(dim)]).alias("total")), "sums")
    rows = unit.select("label", "u", F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"), F.lit(None).cast("bigint").alias("n"))
    for block in itertools.batched(clusters.toLocalIterator(), CLUSTER_ROWS):
        rows = _with_distances(rows, block)
    s = F.when(F.col("n") > 1, (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0)
    return rows.agg(F.round(F.coalesce(F.avg(F.when(F.col("b").isNull(), 0.0).otherwise(s)), F.lit(0.0)), 6).alias("silhouette"))


def _with_distances(rows: DataFrame, block: tuple) -> DataFrame:
    """Rows whose least mean distance ``b`` to another cluster, and ``a``, ``n`` of their own, take in one more block of clusters."""
    labels = np.array([r["label"] for r in block])
    n, total = np.array([r["n"] for r in block], np.float64), np.array([r["total"] for r in block], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, u = batch.column(0).to_numpy(zero_copy_only=False), np.asarray(batch.column(1).flatten(), np.float64).reshape(batch.num_rows, -1)
            a, b = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in (2, 3))
            size = batch.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
            for lo in range(0, len(u), 1024):
                part = slice(lo, lo + 1024)
                d, mine = 1 - u[part] @ total.T / n, own[part, None] == labels[None, :]
                b[part] = np.fmin(b[part], np.where(mine, np.inf, d).min(1))
                row, at = np.nonzero(mine)
                a[lo + row] = d[row, at] * n[at] / np.maximum(n[at] - 1, 1)
                size[lo + row] = n[at]
            b[np.isinf(b)] = np.nan
            none = lambda x: pa.array(x, pa.float64(), mask=np.isnan(x))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], none(a), none(b), none(size).cast(pa.int64())], names=["label", "u", "a", "b", "n"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"label {kind}, u array<double>, a double, b double, n bigint")


def cluster_quality(df: DataFrame, label: str = "label") -> DataFrame:
    """``n_clusters, n_noise, n_rows, noise_pct`` of labels, -1 being noise."""
    noise = F.count_if(F.col(label) == -1)
    return df.agg(
        F.countDistinct(F.when(F.col(label) != -1, F.col(label))).alias("n_clusters"), noise.alias("n_noise"), F.count("*").alias("n_rows"),
        F.bround(F.when(F.count("*") > 0, noise * 100.0 / F.count("*")).otherwise(0.0), 2).alias("noise_pct"),
    )


def density_labels(x: np.ndarray, min_size: int, min_samples: int) -> np.ndarray:
    """Hierarchical density clustering of unit vectors: mutual reachability tree, condensed, by excess of mass."""
    n = len(x)
    if n < max(2, min_size):
        return np.full(n, -1)
    core = np.empty(n)
    k = min(min_samples, n) - 1
    for lo in range(0, n, 1024):
        d = np.clip(1 - x[lo : lo + 1024] @ x.T, 0, 2)
        core[lo : lo + 1024] = np.partition(d, k, axis=1)[:, k]
    inside, best, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    at, edges = 0, []
    for _ in range(n - 1):  # one row of distances at a time
        inside[at] = True
        reach = np.maximum(np.maximum(core, core[at]), np.clip(1 - x @ x[at], 0, 2))
        closer = ~inside & (reach < best)
        best[closer], link[closer] = reach[closer], at
        nxt = int(np.argmin(np.where(inside, np.inf, best)))
        edges.append((best[nxt], min(nxt, link[nxt]), max(nxt, link[nxt])))
        at = nxt
    edges.sort()
    parent, size, children, height = list(range(2 * n - 1)), [1] * n, {}, {}

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for i, (w, a, b) in enumerate(edges):
        ra, rb, new = root(a), root(b), n + i
        children[new], height[new] = (ra, rb), w
        size.append(size[ra] + size[rb])
        parent[ra] = parent[rb] = new
    # condense: a split counts if both sides have min_size members
    stability, kids, born, label_of = {0: 0.0}, {0: []}, {0: 0.0}, np.full(n, 0)
    stack = [(2 * n - 2, 0)]
    count = 1
    while stack:
        node, c = stack.pop()
        if node < n:
            label_of[node] = c
            continue
        lam = 1 / max(height[node], 1e-12)
        sides = children[node]
        large = [s for s in sides if size[s] >= min_size]
        if len(large) == 2:
            for s in sides:
                stability[c] += (lam - born[c]) * size[s]
                kids[c].append(count)
                stability[count], kids[count], born[count] = 0.0, [], lam
                stack.append((s, count))
                count += 1
        else:
            for s in sides:
                if size[s] < min_size:
                    stability[c] += (lam - born[c]) * size[s]
                    todo = [s]
                    while todo:
                        v = todo.pop()
                        if v < n:
                            label_of[v] = c
                        else:
                            todo += children[v]
                else:
                    stack.append((s, c))
    chosen, value = {}, {}
    for c in range(count - 1, -1, -1):
        below = sum(value[k] for k in kids[c])
        take = c != 0 and (not kids[c] or stability[c] >= below)
        chosen[c], value[c] = take, stability[c] if take else below
    final, over = {0: -1}, {0: None}
    names: dict[int, int] = {}
    for c in range(count):
        for kchild in kids[c]:
            over[kchild] = over[c] if over[c] is not None else (c if chosen[c] else None)
    for c in range(count):
        top = over.get(c)
        pick = top if top is not None else (c if chosen[c] else None)
        final[c] = -1 if pick is None else names.setdefault(pick, len(names))
    raw = np.array([final[c] for c in label_of])
    order = {}
    return np.array([-1 if v < 0 else order.setdefault(v, len(order)) for v in raw])


def density_clusters(df: DataFrame, min_size: int = 3, min_samples: int = 4) -> DataFrame:
    """``vec_id, cluster_id`` (-1: noise) of one window of vectors.

    The operator is for a short time window; its size is checked against
    ``WINDOW_ROWS`` and a larger one is refused rather than cut.
    """
    rows = df.where("embedding is not null").select("vec_id", "embedding")
    if rows.limit(WINDOW_ROWS + 1).count() > WINDOW_ROWS:
        raise ValueError(f"more than {WINDOW_ROWS} rows in the window: narrow it")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x = np.stack(pdf["embedding"]).astype(np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return pd.DataFrame({"vec_id": pdf["vec_id"], "cluster_id": density_labels(x, min_size, min_samples)})

    return rows.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(run, "vec_id bigint, cluster_id int")


def issue_board(items: DataFrame, labels: DataFrame, k: int = 5) -> DataFrame:
    """``issue_cluster_id, issue_label, cluster_size, representative_titles`` of labelled items, noise left out."""
    rows = items.select("vec_id", "embedding").join(labels, "vec_id").where("cluster_id <> -1").withColumnRenamed("cluster_id", "label")
    top = representatives(rows.select("label", "vec_id", "embedding"), "label", k).join(items.select("vec_id", "title"), "vec_id")
    titles = top.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("representative_titles"))
    sizes = rows.groupBy("label").agg(F.count("*").cast("int").alias("cluster_size"))
    return sizes.join(titles, "label").select(F.col("label").alias("issue_cluster_id"), F.concat(F.lit("issue_"), "label").alias("issue_label"), "cluster_size", "representative_titles")


def visible_issues(meta: DataFrame, refused: str = "[불가]", shown: int = 3) -> DataFrame:
    """Issues whose label isn't refused, with a fallback label and the first titles."""
    label = F.coalesce(F.when(F.length(F.trim("issue_label")).between(3, 30), F.trim("issue_label")), F.concat(F.lit("issue_"), "issue_cluster_id"))
    kept = meta.where(F.coalesce(F.col("issue_label") != refused, F.lit(True)))
    return kept.select("issue_cluster_id", label.alias("issue_label"), "cluster_size", F.slice(F.coalesce("representative_titles", F.array().cast("array<string>")), 1, shown).alias("representative_titles"))
