"""Similarity, grouping, election and vector operators against plain Python."""

import math
import random
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest

from gleaner.operators import similarity, vectors
from gleaner.plans import catalog


def tfidf_sims(texts):
    docs = []
    for t in texts:
        w = re.findall(r"\w{2,}", (t or "").lower())
        docs.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]))
    df = Counter(x for d in docs for x in d)
    vs = []
    for d in docs:
        v = {x: c * (math.log((1 + len(docs)) / (1 + df[x])) + 1) for x, c in d.items()}
        n = math.sqrt(sum(y * y for y in v.values()))
        vs.append({x: y / n for x, y in v.items()} if n else {})
    return [[sum(y * b.get(x, 0) for x, y in a.items()) for b in vs] for a in vs]


def sequential_leaders(n, near):
    lead, out = [], []
    for j in range(n):
        mine = [i for i in lead if near(i, j)]
        if not mine:
            lead.append(j)
        out.append(mine[-1] if mine else j)
    return out


def texts_of(rnd, n):
    words = [f"w{k}" for k in range(30)]
    out = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 9))) for _ in range(n)]
    return out + [None, "", "!", "!"] + out[:6]


def test_leader_groups_equal_the_loop(spark, monkeypatch):
    rnd = random.Random(2)
    for products, rows in ((4_000_000, 1_000), (50, 10), (1, 2)):  # one block; several; leaders in rounds over pairs
        monkeypatch.setattr(similarity, "PRODUCTS", products)
        monkeypatch.setattr(similarity, "BLOCK_ROWS", rows)
        texts = texts_of(rnd, 40)
        sims = tfidf_sims(texts)
        df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "pos bigint, title string, df int")
        got = sorted(map(tuple, similarity.leader_groups(df, "pos", "title", 0.3).collect()))
        near = lambda i, j: round(sims[i][j], 9) >= 0.3  # noqa: E731, B023
        want = sequential_leaders(len(texts), near)
        links = [sum(near(i, j) for j in range(len(texts)) if j != i) for i in range(len(texts))]
        assert got == [(i, want[i], links[i]) for i in range(len(texts))]


def test_leaders_steal_from_earlier_ones(spark):
    nodes = spark.createDataFrame([(0,), (1,), (2,)], "pos bigint")
    edges = spark.createDataFrame([(0, 2), (1, 2)], "i bigint, j bigint")
    assert sorted(map(tuple, similarity.leaders(nodes, edges).collect())) == [(0, 0), (1, 1), (2, 1)]


def test_merges(spark):
    g = spark.createDataFrame([(0, 0, 0), (1, 0, 1), (2, 2, 1), (3, 2, 3), (4, 4, 4), (5, 0, 0)], "pos bigint, title_id bigint, body_id bigint")
    assert sorted(map(tuple, similarity.or_merge(g).collect())) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 4), (5, 0)]
    assert sorted(map(tuple, similarity.and_merge(g).collect())) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 0)]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7)]
    nodes = spark.createDataFrame([(k,) for k in [*range(51), *range(100, 140), 999]], "pos bigint")
    got = dict(map(tuple, similarity.components(spark.createDataFrame(edges, "a bigint, b bigint"), nodes).collect()))
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 140)}, 999: 999}


def test_election_branches(spark):
    t = lambda d: datetime(2025, 1, d) if d else None
    rows = [
        (1, "a", 1, False, t(3)), (2, "b", 1, False, t(1)), (3, "c", 1, None, None), (4, "d", 2, True, t(1)), (5, "e", 2, False, t(9)),
        (6, "f", 3, True, t(1)), (7, "g", 3, True, t(5)), (8, "h", 3, True, None), (9, "i", 4, None, None), (10, "j", 4, None, None), (11, "b", 5, None, t(2)), (12, "k", 5, None, t(1)),
    ]
    df = spark.createDataFrame(rows, "pos bigint, news_id string, cluster_id int, is_agency boolean, pub_ts timestamp")
    got = {r.pos: (r.is_canon, r.replaced_by) for r in similarity.elect(df).collect()}
    assert {p: r for p, (_, r) in got.items()} == {1: "b", 2: "b", 3: "b", 4: "d", 5: "d", 6: "g", 7: "g", 8: "g", 9: "i", 10: "i", 11: "k", 12: "k"}
    assert sorted(p for p, (c, _) in got.items() if c) == [2, 4, 7, 9, 11, 12]  # a repeated id is canonical wherever it stands


def test_simhash_dedup_equals_the_loop(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(120)) for _ in range(12)]
    rows = []
    for i in range(60):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 3, 12])):
            t[rnd.randrange(len(t))] = rnd.choice("xyz")
        rows.append((i, "".join(t[:40]), "".join(t)))
    rows += [(60, None, None), (61, "", ""), (62, "!", None)]
    df = spark.createDataFrame(rows, "pos bigint, title string, content string")
    fp = {r.pos: (r.title_fp & (1 << 64) - 1, r.body_fp & (1 << 64) - 1) for r in similarity.simhash(df, "pos", "title", "title_fp").join(similarity.simhash(df, "pos", "content", "body_fp"), "pos").collect()}
    near = lambda i, j: (fp[i][0] ^ fp[j][0]).bit_count() <= 10 and (fp[i][1] ^ fp[j][1]).bit_count() <= 14
    want = sequential_leaders(len(rows), near)
    got = {r.pos: r.removed_by for r in similarity.simhash_dedup(df, "pos").collect()}
    assert got == {i: None if want[i] == i else "simhash" for i in range(len(rows))} and any(got.values())


def test_density_clusters():
    rnd = np.random.default_rng(4)
    centres = rnd.standard_normal((4, 64))
    x = np.concatenate([c + rnd.standard_normal((n, 64)) * 0.05 for c, n in zip(centres, (12, 9, 6, 20), strict=True)] + [rnd.standard_normal((15, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = vectors.density_labels(x, 3, 4)
    at = 0
    for n in (12, 9, 6, 20):
        assert len(set(got[at : at + n])) == 1 and got[at] != -1
        at += n
    assert len(set(got[:47])) == 4 and (got[47:] == -1).mean() > 0.5
    assert (vectors.density_labels(x[:2], 3, 4) == -1).all()


def test_vector_search_and_silhouette(spark):
    rnd = np.random.default_rng(5)
    x = rnd.standard_normal((80, 64))
    lab = rnd.integers(0, 3, 80)
    df = spark.createDataFrame([(i, [float(a) for a in v], int(y)) for i, (v, y) in enumerate(zip(x, lab, strict=True))], "vec_id bigint, embedding array<float>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = sorted(map(tuple, vectors.topk(df, df.where("vec_id = 3").selectExpr("vec_id as query_id", "embedding"), 4).collect()))
    assert [r[2] for r in got] == list(np.argsort(-(u @ u[3]))[:4])
    d, s = 1 - u @ u.T, []
    for i in range(80):
        own = [d[i, j] for j in range(80) if lab[j] == lab[i] and j != i]
        b = min(np.mean(d[i, lab == c]) for c in set(lab) - {lab[i]})
        s.append((b - np.mean(own)) / max(b, np.mean(own)))
    assert abs(vectors.silhouette(df).first()[0] - np.mean(s)) < 1e-5
    assert vectors.silhouette(df.limit(0)).first()[0] == 0.0


def test_topk_in_blocks_of_queries(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, 8))
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    queries = spark.range(10_050).selectExpr("id as query_id", "id % 40 as vec_id").join(df, "vec_id").select("query_id", "embedding")
    got = {(r.query_id, r.rank): r.vec_id for r in vectors.topk(df, queries, 2).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    best = np.argsort(-(u @ u.T), axis=1)[:, :2]
    assert got == {(i, k + 1): int(best[i % 40, k]) for i in range(10_050) for k in range(2)}


def test_keyword_cluster_query_normalises_titles(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    docs = [(1, "[속보] 첫째 소식", "w1 w2 w3", "a.example"), (2, "[속보] 둘째 사건", "w4 w5 w6", "a.example"), (3, "첫째 소식 (종합)", "w7 w8", None), (4, None, None, "b.example")]
    spark.createDataFrame(docs, "doc_id bigint, title string, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b.example", True)], "site string, is_agency boolean").coalesce(1).write.parquet(f"{tmp_path}/press_sites.parquet")
    got = sorted(map(tuple, catalog.QUERIES["keyword_cluster"](spark, str(tmp_path)).collect()))
    assert [(r[0], r[1], r[3]) for r in got] == [(1, 1, 1), (2, 2, 2), (3, 1, 1), (4, 4, 4)]  # the bracketed word alone joined 1 and 2
    con = duckdb.connect()
    for name in ("documents", "press_sites"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == sorted(con.sql(catalog.ORACLES["keyword_cluster"]).fetchall())


def test_keyword_cluster_writes_no_texts(spark, monkeypatch):
    written, write = {}, similarity.materialize
    monkeypatch.setattr(similarity, "materialize", lambda t, name="t", *by: [written.update({name: t.columns}), write(t, name, *by)][1])
    data = [(i, f"t{i // 2} x{i // 2}", f"w{i} v{i}", f"n{i}", False, None) for i in range(4)]
    df = spark.createDataFrame(data, "pos bigint, title string, content string, news_id string, is_agency boolean, pub_ts timestamp")
    out, stats = similarity.keyword_cluster(df)
    assert "clustered" in written and not {"title", "content"} & set(written["clustered"])
    assert sorted(map(tuple, out.select("pos", "content", "cluster_id", "title_id", "body_id", "is_canon", "replaced_by").collect())) == [
        (i, f"w{i} v{i}", f"C-{i - i % 2}", f"T-{i - i % 2}", f"B-{i}", i % 2 == 0, f"n{i - i % 2}") for i in range(4)
    ]
    assert tuple(stats.first()) == (4, 2, 2)


def test_blocks_of_vectors_are_not_copied(spark, monkeypatch):
    """Pairs of blocks are read from the folder, not made by a join of copies that would go through disk."""
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 4)
    df = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c{i % 3}") for i in range(30)], "pos bigint, title string")
    wrote, write = [], similarity.materialize
    monkeypatch.setattr(similarity, "materialize", lambda t, *a: wrote.append(a[0]) or write(t, *a))
    shelf = similarity._Shelf(df, "pos", "title", df.selectExpr("pos", "pos AS rep", "1L AS n", "true AS c"), 30, 0.3)
    plan = shelf.links()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and wrote == ["freq", "vectors"]


def test_simhash_leaders_in_one_task_and_in_rounds(spark, monkeypatch):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(90)) for _ in range(8)]
    rows = [(i, (t := rnd.choice(base))[:40], t[: 90 - i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "pos bigint, title string, content string")
    monkeypatch.setattr(similarity, "leaders", None)  # few pairs need no rounds of jobs on the driver
    monkeypatch.setattr(similarity, "PRINT_ROWS", 3)  # pairs of blocks
    few = sorted(map(tuple, similarity.simhash_dedup(df, "pos").collect()))
    monkeypatch.undo()
    monkeypatch.setattr(similarity, "PAIRS", 0)
    assert few == sorted(map(tuple, similarity.simhash_dedup(df, "pos").collect())) and any(r for _, r in few)


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    cuts, cut = [], similarity.word_tokens
    monkeypatch.setattr(similarity, "word_tokens", lambda c: cuts.append(1) or cut(c))
    df = spark.createDataFrame([(1, "a1 b1 c1"), (2, "a1 b1 c2"), (3, None), (4, "d1")], "pos bigint, title string")
    got = sorted(map(tuple, similarity.leader_groups(df, "pos", "title", 0.2).collect()))
    assert got == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0)] and len(cuts) == 1


def test_terms_of_token_lists():
    rnd = random.Random(11)
    lists = [[rnd.randrange(-3, 4) for _ in range(rnd.randrange(9))] for _ in range(50)] + [[], [5], [5, 5]]
    ids, g, row, tf = similarity._terms(pa.array(lists, pa.list_(pa.int64())))
    assert (np.diff(ids) > 0).all()
    want = [Counter(x + list(zip(x, x[1:], strict=False))) for x in lists]
    for k, terms in enumerate(want):
        assert sorted(tf[row == k]) == sorted(terms.values()) and (np.diff(g[row == k]) > 0).all()
        assert {ids[a]: n for a, n in zip(g[row == k], tf[row == k], strict=True) if ids[a] in terms} == {x: n for x, n in terms.items() if not isinstance(x, tuple)}
    assert len(ids) == len({x for terms in want for x in terms})  # the order of neighbours counts
    assert all(len(x) == 0 for x in similarity._terms(pa.array([[], []], pa.list_(pa.int64()))))


def test_groups_of_blocks_hold_against_leaders_read_once(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 4)
    df = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c{i % 3}") for i in range(400)], "pos bigint, title string")
    shelf = similarity._Shelf(df, "pos", "title", df.selectExpr("pos", "pos AS rep", "1L AS n", "true AS c"), 400, 0.3)
    groups = shelf._groups(shelf.sizes, 1)
    assert sorted(b for g in groups for b in g) == sorted(shelf.sizes) and len(groups) < len(shelf.sizes)
    assert max(sum(shelf.sizes[b] for b in g) for g in groups) <= similarity.GROUP * similarity.BLOCK_ROWS
    shelf.discard()


def blocks_of(rnd, n_rows, n_terms):
    """A packed block of random unit vectors, frequent terms first."""
    rows = [sorted({min(int(rnd.expovariate(0.08)), n_terms - 1) for _ in range(rnd.randrange(0, 14))}) for _ in range(n_rows)]
    weights = [np.array([rnd.random() + t / n_terms for t in r]) for r in rows]
    row = np.repeat(np.arange(n_rows), [len(r) for r in rows])
    w = np.concatenate([x / np.linalg.norm(x) if len(x) else x for x in weights])
    return similarity._Packed(np.arange(n_rows), np.ones(n_rows, np.int64), row, np.array([t for r in rows for t in r], np.int32), w)


@pytest.mark.parametrize("most_open", [0, 3, 1000])
def test_sketches_find_the_pairs_of_all_products(most_open):
    rnd = random.Random(5)
    x, y = blocks_of(rnd, 90, 120), blocks_of(rnd, 70, 120)
    k = 10
    dense = np.zeros((70, k), np.float32)
    dense[y.row[y.term < k], y.term[y.term < k]] = y.w[y.term < k]
    axes = np.ascontiguousarray(np.linalg.eigh((dense.T @ dense).astype(float))[1][:, ::-1][:, :4].astype(np.float32))
    place = np.where(np.arange(120) < 40, np.arange(120), -1).astype(np.int32)
    basis = (place, axes, 40, 6)
    a, b = similarity._Sketch(x, basis), similarity._Sketch(y, basis)
    assert a.bound.shape == (90, 4 + 1 + 6)
    for least in (0.05, 0.2, 0.5, 0.9):
        want = similarity._near(x, y, least, 3, 50)
        got = similarity._near_bounded(a, b, least, 3, 50, most_open)
        assert [v.tolist() for v in got] == [v.tolist() for v in want] and len(want[0])
        kept = np.array([rnd.random() < 0.6 for _ in range(90)])
        got, want = similarity._near(a.take(kept), b, least, 3, 50), similarity._near(x.take(kept), y, least, 3, 50)
        assert [v.tolist() for v in got] == [v.tolist() for v in want]


def sketches(x, y, common=40, k=10):
    dense = np.zeros((len(y.pos), k), np.float32)
    dense[y.row[y.term < k], y.term[y.term < k]] = y.w[y.term < k]
    axes = np.ascontiguousarray(np.linalg.eigh((dense.T @ dense).astype(float))[1][:, ::-1][:, :4].astype(np.float32))
    basis = (np.where(np.arange(120) < common, np.arange(120), -1).astype(np.int32), axes, common, 6)
    return similarity._Sketch(x, basis), similarity._Sketch(y, basis)


def test_rows_with_many_open_pairs_use_what_the_sketch_has(monkeypatch):
    rnd = random.Random(6)
    x, y = blocks_of(rnd, 90, 120), blocks_of(rnd, 70, 120)
    a, b = sketches(x, y)
    want = similarity._near(x, y, 0.8, 3, 50)
    open_ = similarity._near_bounded(a, b, 0.8, 3, 50, 1000)
    monkeypatch.setattr(similarity, "_near", None)  # packing rows by term again
    for most_open in (1, 3):
        got = similarity._near_bounded(a, b, 0.8, 3, 50, most_open)
        assert [v.tolist() for v in got] == [v.tolist() for v in want] == [v.tolist() for v in open_] and len(want[0])


def test_joined_sketches_keep_their_bounds():
    rnd = random.Random(7)
    x, y = blocks_of(rnd, 90, 120), blocks_of(rnd, 70, 120)
    a, b = sketches(x, y)
    kept = np.arange(90) % 3 > 0
    both = similarity._Sketch.joined([a.take(kept), a.take(~kept)])
    assert np.array_equal(both.bound, np.concatenate([a.bound[kept], a.bound[~kept]]))
    whole = similarity._Packed.joined([x.take(kept), x.take(~kept)])
    for least in (0.2, 0.5):
        got, want = similarity._near(both, b, least, 3, 50), similarity._near(whole, y, least, 3, 50)
        assert [v.tolist() for v in got] == [v.tolist() for v in want] and len(want[0])


def test_leader_groups_by_sketches_equal_the_loop(spark, monkeypatch):
    rnd = random.Random(23)
    texts = [" ".join(f"w{min(int(rnd.expovariate(0.06)), 90):02d}" for _ in range(rnd.randrange(1, 12))) for _ in range(160)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, title string")
    sims = tfidf_sims(texts)
    want = sequential_leaders(len(texts), lambda i, j: round(sims[i][j], 9) >= 0.2)
    for name, value in (("BLOCK_ROWS", 10), ("OPEN_BLOCKS", 2), ("DENSE", 0), ("FREQUENT", 12), ("AXES", 5), ("BUCKETS", 4), ("SHARE", 0.02)):
        monkeypatch.setattr(similarity, name, value)
    bases, write = [], similarity.materialize
    monkeypatch.setattr(similarity, "materialize", lambda t, *a: [w := write(t, *a), bases.append(w.count()) if a[0] == "basis" else None][0])
    got = {r.pos: r.leader for r in similarity.leader_groups(df, "pos", "title", 0.2, False).collect()}
    assert got == dict(enumerate(want)) and bases and bases[0] > 12  # frequent and other common terms


def test_blocks_are_dealt_evenly(spark):
    shelf = similarity._Shelf.__new__(similarity._Shelf)
    shelf.spark = spark
    cores = spark.sparkContext.defaultParallelism
    sizes = {b: similarity.BLOCK_ROWS - b for b in range(4 * cores + 1)}
    groups = shelf._groups(sizes, 1)
    assert len(groups) == cores and max(map(len, groups)) - min(map(len, groups)) <= 1  # each group reads all leaders: no more groups than cores
