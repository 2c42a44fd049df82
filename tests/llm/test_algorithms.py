"""Clusters, groups of pairs, survivors and incremental deduplication against plain Python."""

import collections
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm import clusters, components, history, survivors

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


# ---- 2


def vectors(rnd, groups=12, noise=150):
    out = []
    for size in [90, 40, *(int(rnd.integers(1, 6)) for _ in range(groups))]:
        c = rnd.standard_normal(64)
        c /= np.linalg.norm(c)
        for _ in range(size):
            v = c + rnd.standard_normal(64) * 0.02
            out.append(v * rnd.uniform(0.1, 5))
    out += list(rnd.standard_normal((noise, 64)))
    return out


def test_clusters_equal_all_pairs(spark):
    rnd = np.random.default_rng(1)
    x = vectors(rnd)
    rows = [(i, "n", f"t{i % 7}" if i % 5 else None, [float(a) for a in v], "clash") for i, v in enumerate(x)]
    bad = [None, [], [0.0] * 64, [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63]
    rows += [(1000 + i, "n", "t", b, "clash") for i, b in enumerate(bad)] + rows[:3]
    df = spark.createDataFrame(rows, "item_id bigint, news_id string, title string, embedding array<float>, vec string")
    u = np.stack(x)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = u @ u.T >= 0.88
    want = sorted((i, int(np.flatnonzero(near[i])[0])) for i in range(len(x)) if near[i].sum() > 1)
    assert rows_of(clusters.found_clusters(df)) == want
    board = {r.issue_cluster_id: r for r in clusters.issue_rows(df).collect()}
    assert {c: r.cluster_size for c, r in board.items()} == {c: sum(y == c for _, y in want) for _, c in want}
    for c, r in board.items():
        m = [i for i, y in want if y == c]
        assert r.medoid_item_id == max(m, key=lambda i: (round(float(u[i] @ u[m].sum(0)), 4), -i)) or len(m) < 4
        assert len(r.representative_titles) <= 5 and len(set(r.representative_titles)) == len(r.representative_titles)
    assert clusters.found_clusters(df.limit(0)).count() == 0


def test_hot_bucket_is_split(spark, monkeypatch):
    monkeypatch.setattr(clusters, "BUCKET_ROWS", 50)
    rnd = np.random.default_rng(2)
    c = rnd.standard_normal(64)
    rows = [(i, [float(a) for a in c + rnd.standard_normal(64) * 0.02]) for i in range(400)]
    df = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    assert rows_of(clusters.found_clusters(df)) == [(i, 0) for i in range(400)]


def test_dense_bucket_loses_no_pair(spark, monkeypatch):
    """Twins in a region whose vectors are else below the least cosine, in buckets far above the limit."""
    monkeypatch.setattr(clusters, "BUCKET_ROWS", 4)
    rnd = np.random.default_rng(3)
    c = rnd.standard_normal(64)
    x = c / np.linalg.norm(c) + rnd.standard_normal((100, 64)) * 0.75 / 8
    u = x / np.linalg.norm(x, axis=1)[:, None]
    assert 0.6 < (u @ u.T)[np.triu_indices(100, 1)].max() < 0.88
    rows = [(i, [float(a) for a in x[i % 100] * (1 + i // 100)]) for i in range(200)]
    df = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    assert rows_of(clusters.found_clusters(df)) == [(i, i % 100) for i in range(200)]


def test_chains_leave_no_similar_items_alone(spark):
    """Many chains p - q - i of which only neighbours are similar, each end doubled."""
    rnd = np.random.default_rng(4)
    rows = []
    for k in range(40):
        a, b = np.linalg.qr(rnd.standard_normal((64, 2)))[0].T
        turns = [0.0, 0.45, 0.9, 0.9, 1.35, 1.35]
        rows += [(k * 6 + j, [float(v) for v in np.cos(t) * a + np.sin(t) * b]) for j, t in enumerate(turns)]
    df = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    got = {r.item_id: r for r in clusters.pivot_clusters(df).collect()}
    u = np.stack([v for _, v in rows])
    near = u @ u.T >= 0.88
    pivots = {i for i in got if got[i].pivot == i}
    assert {r.pivot for r in got.values()} <= pivots
    assert all(near[i, got[i].pivot] for i in got)
    assert not any(near[i, j] for i in pivots for j in pivots if i < j)


def test_only_true_pivots_absorb(spark):
    """Vectors at 0, 25, 50 and 52 degrees in hash order: the second goes to the first, so the last must go to the third."""
    ids = spark.range(60 * 4 * 30).selectExpr("id", "xxhash64(id) AS h").orderBy("h").limit(240).collect()
    rnd, rows = np.random.default_rng(5), []
    for k in range(60):
        a, b = np.linalg.qr(rnd.standard_normal((64, 2)))[0].T
        rows += [(r.id, [float(v) for v in np.cos(t) * a + np.sin(t) * b]) for r, t in zip(ids[4 * k : 4 * k + 4], np.radians([0, 25, 50, 52]), strict=True)]
    df = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    got = {r.item_id: r.pivot for r in clusters.pivot_clusters(df).collect()}
    for k in range(60):
        w, x, y, z = (r[0] for r in rows[4 * k : 4 * k + 4])
        assert got[w] == w == got[x] and got[y] == y == got[z], k


# ---- 6


def union_find(pairs):
    up = {}

    def root(v):
        while up.setdefault(v, v) != v:
            v = up[v]
        return v

    for a, b in pairs:
        a, b = (x.strip().lower() if x else None for x in (a, b))
        if a and b and a != b:
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    return sorted((v, root(v)) for v in up)


PAIRS = "src string, dst string, via string, score double, v string"


@pytest.mark.parametrize("every", [1, 3])
def test_groups_equal_union_find(spark, monkeypatch, every):
    monkeypatch.setattr(components, "LEAVE_EVERY", every)
    rnd = random.Random(4)
    pairs = [(f"A{rnd.randrange(80):03}", f" a{rnd.randrange(80):03} ") for _ in range(60)]
    pairs += [(f"c{k:03}", f"c{k + 1:03}") for k in range(40)] + [("s000", f"s{k:03}") for k in range(1, 60)]
    pairs += [(None, "x"), ("y", ""), (" ", "z"), ("self", "SELF"), ("u", "\xa0u2\xa0"), ("u2", "u")] + pairs[:9]
    df = spark.createDataFrame([(*p, None, None, "clash") for p in pairs], PAIRS)
    assert rows_of(components.group_pairs(df)) == union_find(pairs)
    assert components.group_pairs(df.limit(0)).count() == 0


# ---- 5


def test_survivors(spark):
    sites = spark.createDataFrame([("a.example", "A", "Asia/Seoul", False)], "site string, press_name string, time_zone string, is_agency boolean")
    rows = [
        (1, "x", "k1", "2025-09-01 10:00:00", "2025-09-01 00:00:00", "First title of the council", "d", "The council met in the harbor town."),
        (2, "x", "k2", "2025-09-01 12:00:00", "no time", "{{title}}", None, "Access Denied. You don't have permission to view /read/1 on this server."),
        (3, "x", "k1", "2025-09-01 11:00:00", "2025-09-01T00:00:00Z", "Second title of the council", " \xa0", ""),
        (5, "x", "k3", "2025-09-01 11:00:00", None, "Third title of the council", "e", None),
        (4, "x", "k3", "2025-09-01 11:00:00", None, "Third title of the council", "e", None),
        (6, "y", "k1", "junk", None, None, None, None), (7, "y", "k2", None, None, "", "late", None), (8, "y", "k2", None, None, "", "late", None),
        (9, "alone", "k1", "2025-09-01 11:00:00", None, "t", "d", "c"), (10, None, "k1", "2025-09-01 11:00:00", None, "t", "d", "c"), (11, None, "k1", "2025-09-01 11:00:00", None, "t", "d", "c"),
    ]
    df = spark.createDataFrame([(*r, "", "clash") for r in rows], "row_id bigint, news_id string, search_keyword string, collected_at string, pubdate string, title string, description string, content string, originallink string, site string")
    got = rows_of(survivors.found_sources(df, sites))
    assert got == [("x", "content", 1), ("x", "description", 4), ("x", "pubdate", 3), ("x", "title", 3), ("y", "description", 7)]
    built = {r.news_id: r for r in survivors.survivors(df, sites).collect()}
    assert built["y"].description_values == ["late"] and built["y"].title_values == []
    assert built["x"].title == "Second title of the council" and built["x"].content_row_id == 1 and built["y"].title is None
    assert survivors.found_sources(df.limit(0), sites).count() == 0


def test_quality_model_finds_the_poor_source(spark):
    rnd, rows = random.Random(6), []
    for i in range(300):
        for s, good in (("a", 0.95), ("b", 0.9), ("c", 0.9), ("bad", 0.3)):
            if rnd.random() < 0.9:
                rows.append((f"n{i}", s, f"true {i}" if rnd.random() < good else f"wrong {i} {rnd.randrange(3)}"))
    rows += [("n0", "a", None), ("n0", "b", " "), (None, "a", "x")] + rows[:5]
    df = spark.createDataFrame([(*r, None) for r in rows], "news_id string, search_keyword string, title string, originallink string")
    judged, quality = survivors.judged_values(df, ("title",))
    judged = {(r.news_id, r.value): r.p_true for r in judged.collect()}
    right = [(p > 0.5) == v.startswith("true") for (_, v), p in judged.items()]
    assert sum(right) / len(right) > 0.9
    by = {q.src: (q.sensitivity, q.specificity) for q in quality.collect()}
    assert by["title||bad"][0] < 0.6 < 0.8 < by["title||a"][0]

    # the same model in plain Python, with denials written out
    claims = {(n, v, s) for n, s, v in rows if n and v and v.strip()}
    active = collections.defaultdict(set)
    for n, _, s in claims:
        active[n].add(s)
    values = {(n, v) for n, v, _ in claims}
    q = {s: (0.8, 0.8) for s in "a b c bad".split()}
    while True:
        p = {}
        for n, v in values:
            odds = sum(math.log(q[s][0] / (1 - q[s][1])) if (n, v, s) in claims else math.log((1 - q[s][0]) / q[s][1]) for s in active[n])
            p[n, v] = 1 / (1 + math.exp(-odds))
        new = {}
        for s in q:
            met = [(p[n, v], (n, v, s) in claims) for n, v in values if s in active[n]]
            new[s] = ((sum(x for x, c in met if c) + 8) / (sum(x for x, _ in met) + 10), (sum(1 - x for x, c in met if not c) + 8) / (sum(1 - x for x, _ in met) + 10))
        moved, q = max(abs(a - b) for s in q for a, b in zip(q[s], new[s], strict=True)), new
        if moved < survivors.MOVED:
            break
    assert judged.keys() == p.keys() and all(abs(judged[k] - p[k]) < 1e-9 for k in p)
    assert all(abs(x - y) < 1e-9 for s in q for x, y in zip(q[s], by[f"title||{s}"], strict=True))
    assert survivors.judged_fields(df.limit(0), ("title",)).count() == 0


def test_quality_model_judges_all_fields(spark, tmp_path):
    from gleaner.llm.queries import QUERIES

    rows = [(f"n{i}", f"k{j}", f"t{i}", f"d{i}", f"c{i}" if j else f"bad{i}", f"p{i}", None) for i in range(12) for j in range(4)]
    articles = spark.createDataFrame(rows, "news_id string, search_keyword string, title string, description string, content string, pubdate string, originallink string")
    articles.write.parquet(f"{tmp_path}/raw_articles.parquet")
    got = {(r.news_id, r.field_name, r.value): r.is_true for r in QUERIES["p5_values"](spark, str(tmp_path)).collect()}
    want = {(f"n{i}", f, f"{f[0]}{i}"): True for i in range(12) for f in survivors.FIELDS}
    assert got == want | {(f"n{i}", "content", f"bad{i}"): False for i in range(12)}


# ---- 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.lists(st.integers(0, 6), max_size=40))
def test_common_words_is_the_longest_common_subsequence(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert history.common_words(a, b) == t[len(a)][len(b)]


def test_depth_holds_the_recall_target():
    d, s = history.widest_depth(), history.least_jaccard()
    assert 1 - (1 - s**d) ** history.TREES >= history.RECALL


COLS = "row_id bigint, news_id string, link string, originallink string, content string, ord string, key string"


@pytest.mark.parametrize("room", [None, 0])
def test_repeats_equal_brute_force(spark, monkeypatch, room):
    if room == 0:  # nothing fits a broadcast
        monkeypatch.setattr(history, "BROADCAST_BYTES", room)
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7)))
    link = lambda: rnd.choice([None, "", f"https://n.P.example:8{rnd.randrange(2)}/a/{rnd.randrange(400)}{rnd.choice(['', '/', '?x=1', '#c'])}"])
    raw, inc = [], []
    for i in range(150):
        text = " ".join(word() for _ in range(rnd.randrange(0, 120)))
        raw.append((i, f"n{i}", link(), rnd.choice(["http://s.example/1", None]), rnd.choice([text, text, text, None, " \n"])))
    for i in range(200):
        old = (rnd.choice(raw + inc)[4] or "").split(" ")
        for _ in range(rnd.choice([0, 0, 1, 3, len(old) // 9, len(old) // 4])):
            old[rnd.randrange(len(old))] = word()
        text = rnd.choice([" ", "\n"]).join(old[: rnd.choice([len(old), len(old), len(old) // 2])])
        inc.append((5000 + i, f"m{i}", link(), "http://s.example/1", rnd.choice([text, text.upper() + "!", " ".join(word() for _ in range(50)), None, ""])))
    from gleaner.functions.sites import link_key  # noqa: F401

    def key(u):
        import re

        m = re.match(r"\w+://([^/?#:]+)[^/?#]*([^?#]*)", u or "")
        return m and (m[1].lower(), m[2].rstrip("/"))

    seen, want = [], []
    for r in raw + inc:
        w = history.text_words(r[4])
        k = key(r[2])
        if r[0] >= 5000 and any((k and k == k2) or (w and history.nearly_same(w, w2)) for k2, w2 in seen):
            want.append((r[0],))
        seen.append((k, w))
    frame = lambda rows: spark.createDataFrame([(*r, "clash", "clash") for r in rows], COLS)
    assert want and rows_of(history.found_repeats(frame(raw), frame(inc))) == want
    assert history.found_repeats(frame(raw), frame(inc).limit(0)).count() == 0
    assert history.found_repeats(frame(raw).limit(0), frame(inc[:1])).count() == 0


def test_blocks_of_ranges_give_the_pairs_of_one_block(spark, monkeypatch):
    rnd = random.Random(14)
    key = lambda: (rnd.choice([1, 1, 1, *range(256)]) << 56 | rnd.randrange(4)) - (1 << 63)
    runs = spark.createDataFrame([(rnd.randrange(24), key(), i, 10, 0, 0, 0) for i in range(3000)], history.KEYS)
    asked = spark.createDataFrame([(rnd.randrange(24), key(), 5000 + i, 10, 0, 0, 1) for i in range(400)], history.KEYS)
    want = rows_of(history._in_range(runs, asked, 400, 1))
    assert want
    for room, many in ((8_000, 64), (400, 64), (8_000, 2)):  # blocks, also of one range that doesn't fit; more blocks than are broadcast
        monkeypatch.setattr(history, "BROADCAST_BYTES", room)
        monkeypatch.setattr(history, "MANY_BLOCKS", many)
        assert rows_of(history._in_range(runs, asked, 400, 1)) == want


def test_history_is_signed_once_and_runs_merge(spark, tmp_path, monkeypatch):
    """Three batches and a merge: every text is signed once, and batches find rows of raw, of each other and of merged runs."""
    signed = []
    real = history._signed_rows
    monkeypatch.setattr(history, "_signed_rows", lambda rows, known: signed.append(rows.count()) or real(rows, known))
    monkeypatch.setattr(history, "MANY_RUNS", 3)
    rnd = random.Random(12)
    text = lambda: " ".join(str(rnd.randrange(10**6)) for _ in range(60))
    raw = [(i, f"n{i}", f"http://p.example/{i}", None, text()) for i in range(40)]
    first = [(100 + i, "m", f"http://p.example/{100 + i}", None, raw[i][4] + " more" if i < 5 else text()) for i in range(10)]
    second = [(200 + i, "m", None, None, first[i][4] if i > 7 else text()) for i in range(10)]
    third = [(300, "m", None, None, raw[7][4].replace(" ", "\n")), (301, "m", "https://www.p.example/105?x#y", None, None), (302, "m", None, None, second[3][4] + " end"), (303, "m", None, None, text())]
    frame = lambda rows: spark.createDataFrame([(*r, "clash", "clash") for r in rows], COLS)
    path = f"file://{tmp_path}/index"
    history.build(frame(raw), path)
    assert rows_of(history.accept(frame(first), path)) == [(100 + i,) for i in range(5)]
    assert rows_of(history.accept(frame(second), path)) == [(208,), (209,)]
    assert len(history._manifest(spark, path)["runs"]) == 1
    assert rows_of(history.accept(frame(third), path)) == [(300,), (301,), (302,)]
    assert history.accept(frame(third).limit(0), path).count() == 0
    assert signed == [40, 10, 10, 4, 0]
    keys = history._read(spark, path, history._manifest(spark, path)["runs"], "keys", history.KEYS)
    assert keys.select("ord").distinct().count() == 40 + 10 + 8 + 2  # copies and texts without words have no keys
    with pytest.raises(FileNotFoundError):
        history.accept(frame(third), f"file://{tmp_path}/none")


def test_lines_of_the_other_site_are_left_aside(spark):
    """A copy without site still holds the lines of the site it is from."""
    own = "\n".join(f"This line stands below all articles of the site {k}" for k in range(3))
    body = lambda i: " ".join(f"word{(i * 7919 + k * 104729) % 10007}" for k in range(60))
    raw = [(i, f"n{i}", None, "http://a.example/1" if i else None, body(i) + "\n" + own) for i in range(14)]
    new = [(50, "m", None, "http://a.example/9", body(0) + "\n" + own), (51, "m", None, "http://b.example/9", body(0)), (52, "m", None, None, body(20) + "\n" + own)]
    frame = lambda rows: spark.createDataFrame([(*r, "", "") for r in rows], COLS)
    assert rows_of(history.found_repeats(frame(raw), frame(new))) == [(50,), (51,)]


def test_arrivals_keep_the_order_of_batches(spark):
    rows = [(i, b) for b, n in ((1, 3), (2, 4), (3, 9), (None, 2)) for i in range((b or 9) * 10, (b or 9) * 10 + n)]
    df = spark.createDataFrame(rows, "row_id bigint, batch_id int")
    assert [sorted({r.batch_id for r in part.collect()}, key=str) for part in history.arrivals(df, 7)] == [[1, 2], [3], [None]]
