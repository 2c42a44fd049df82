"""Row operators, text functions, sources and streams on small fixtures."""

import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from gleaner.functions import text
from gleaner.operators import rows
from gleaner.sources import archives, pages
from gleaner.streaming import events

ART = "pos bigint, search_keyword string, news_id string, title string, description string, link string, originallink string, content string, pub_ts timestamp"


def art(pos, title="A title", description="d" * 30, link="https://news.portal.example/1", originallink="https://p.example/1", content="c" * 300, ts=None, keyword="k"):
    return (pos, keyword, f"n{pos}", title, description, link, originallink, content, ts)


def frame(spark, data):
    return spark.createDataFrame(data, ART)


def test_pre_filter_edges(spark):
    kw = spark.createDataFrame([("k", False, 1), ("K2", True, 1)], "keyword string, is_required boolean, fetch_count int")
    data = [
        art(1), art(2), art(3, link=None), art(4, title="[사진] x"), art(5, description="d" * 19), art(6, description="d" * 20, title="b"),
        art(7, description=None, title="c"), art(8, title=None, originallink=None), art(9, title=None, originallink=None),
        art(10, keyword="K2", title="about k2"), art(11, keyword="K2", title="other"), art(12, keyword="K2", title=None),
    ]
    got = {r.pos: r.reject_reason for r in rows.pre_filter(frame(spark, data), kw, r"news\.portal", ["[사진]"]).collect()}
    assert got == {1: None, 2: "repeated_title", 3: "link", 4: "title", 5: "snippet", 6: None, 7: None, 8: None, 9: "repeated_title", 10: None, 11: "keyword", 12: "keyword"}


def test_post_filter_edges(spark):
    data = [art(i, content=c) for i, c in enumerate([None, " \n", "\xa0　", "x" * 199, "x" * 200, "x" * 5000, "x" * 5001])]
    got = [r.reject_reason for r in rows.post_filter(frame(spark, data)).orderBy("pos").collect()]
    assert got == ["empty", "empty", "empty", "short", None, None, "long"]


def test_titles_and_tokens(spark):
    df = spark.createDataFrame([(1, "[a](b)<c>【d】 x \xa0", "Ab_c 한글날 1 22 é"), (2, "[a\nb]", None), (3, None, "가나")], "i int, t string, s string")
    got = df.orderBy("i").select(text.normalize_title(F.col("t")).alias("t"), text.word_tokens(F.col("s")).alias("w"), text.uni_and_bigrams(text.word_tokens(F.col("s"))).alias("g"), text.char_shingles(F.col("s")).alias("c")).collect()
    assert [r.t for r in got] == ["x", "[a\nb]", ""]
    assert got[0].w == ["ab_c", "한글날", "22"] and got[0].g[3:] == ["ab_c 한글날", "한글날 22"] and got[1].w == [] == got[1].g
    assert got[0].c[0] == "ab_c" and got[2].c == ["가나"] and got[1].c == [""]
    html = df.limit(1).select(text.normalize_html(F.lit(" &lt;b&gt;x</b> &quot;y&quot;")).alias("h"), text.normalize_html(F.lit(None).cast("string")).alias("n")).first()
    assert html.h == 'x "y"' and html.n is None
    guard = spark.createDataFrame([(x,) for x in ("ab", "abc", "x" * 30, "x" * 31, None)], "l string").select(text.guarded_label(F.col("l")).alias("g")).collect()
    assert [r.g for r in guard] == ["", "abc", "x" * 30, "", ""]


def test_archive_steps(spark, tmp_path):
    t = lambda d: datetime(2025, 1, d)
    old = frame(spark, [art(i, link=f"l{i}", ts=t(i)) for i in range(1, 6)] + [art(6, link=None)])
    batch = frame(spark, [art(10, link="l5"), art(11, link="l1"), art(12, link="new"), art(13, link="new"), art(14, link=None)])
    assert sorted(r.pos for r in rows.new_rows(batch, old).collect()) == [12, 13]
    near = rows.lookback(old, 2)
    assert sorted(r.pos for r in near.collect()) == [4, 5]
    assert sorted(r.pos for r in rows.new_rows(batch, near).collect()) == [11, 12, 13, 14]
    assert rows.upsert(old, batch).count() == 8
    assert [r.pos for r in rows.archive_order(old).collect()] == [5, 4, 3, 2, 1, 6]
    path = str(tmp_path / "a")
    assert archives.read_archive(spark, path, ART).count() == 0
    archives.replace(old, path)
    archives.replace(rows.upsert(spark.read.parquet(path), batch), path)  # replaces the table it reads
    assert spark.read.parquet(path).count() == 8
    assert {r.n_rows for r in rows.all_duplicates(spark.read.parquet(path), "link").collect()} == {2}
    checks = {r.check_name: (r.status, r.n_bad) for r in rows.validate(spark.read.parquet(path), ["title", "gone"]).collect()}
    assert checks == {"required_columns": ("fail", 1), "unique_key": ("fail", 2)}


def test_csv_round_trip_and_state(spark, tmp_path):
    data = [("k", "n", None, None, 'a "q", b', "line\nbreak", "l", "", "c")]
    df = spark.createDataFrame(data, archives.SCHEMA)
    archives.replace(df, str(tmp_path / "csv"), "csv", header=True, escape='"', quoteAll=True)
    got = archives.read_csv(spark, str(tmp_path / "csv")).first()
    assert got.title == 'a "q", b' and got.description == "line\nbreak"
    assert archives.read_csv(spark, str(tmp_path / "none")).count() == 0 and archives.read_state(spark, str(tmp_path / "s.json")) == {}
    (tmp_path / "s.json").write_text(json.dumps({"k": "2025-01-01 00:00:00"}))
    assert archives.read_state(spark, str(tmp_path / "s.json")) == {"k": "2025-01-01 00:00:00"}
    for run in ("20250101_0000", "20250102_0000"):
        archives.replace(df, str(tmp_path / "runs" / run))
    assert archives.latest_run(spark, str(tmp_path / "runs")) == "20250102_0000"
    rejects = df.withColumn("reject_reason", F.lit("link"))
    archives.append_rejects(rejects, str(tmp_path / "rej"))
    archives.append_rejects(rejects, str(tmp_path / "rej"))
    assert spark.read.parquet(str(tmp_path / "rej")).where("reject_reason = 'link'").count() == 2


def test_run_log_totals(spark):
    log = [("2026-02-12 16:15:00", i, f"k{i}", a, b) for i, (a, b) in enumerate([("49", "18"), ("23", "12"), ("10", "1"), ("0", "0"), (" ", None)])]
    df = spark.createDataFrame(log, "execute_at string, seq int, keyword string, new_raw string, final_added string").withColumn("execute_at", F.to_timestamp("execute_at"))
    got = [(r.tot_new_raw, r.tot_final_added, r.e_ratio) for r in rows.run_totals(df).orderBy("seq").collect()]
    assert got == [(49, 18, 0.367), (72, 30, 0.522), (82, 31, 0.1), (82, 31, 0.0), (82, 31, 0.0)]


def test_due_and_recent(spark):
    now = datetime(2025, 1, 1, 12)
    state = spark.createDataFrame([("a", datetime(2025, 1, 1, 9)), ("b", datetime(2025, 1, 1, 9, 0, 1))], "keyword string, last_executed timestamp")
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "keyword string")
    assert sorted(r.keyword for r in rows.due(keys, state, F.lit(now)).collect()) == ["a", "c"]
    ts = spark.createDataFrame([(now,), (datetime(2025, 1, 1, 0),), (datetime(2024, 12, 31, 23, 59, 59),), (None,)], "ts timestamp")
    assert rows.recent(ts, "ts").count() == 2


def test_pages(spark, tmp_path):
    page = '<html><div id="newsct_article">Old<div>deep</div></div><article id="dic_area">One <em>no</em><script>x()</script><br>two &amp; <span>no</span>three</article></html>'
    assert pages.extract_body(page) == "One two & three"
    assert pages.extract_body("<p>none</p>") == "" == pages.extract_body(None)
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    assert [r.content for r in pages.html_extract(df).orderBy("page_id").collect()] == ["One two & three", "", ""]
    (tmp_path / "k").mkdir()
    for start in (1, 5):  # the page at 3 is missing
        items = [{"title": f"t{start + j}", "link": f"l{start + j}"} for j in range(2)]
        (tmp_path / "k" / f"{start}.json").write_text(json.dumps({"items": items}))
    spark.dataSource.register(pages.SearchPages)
    got = spark.read.format("search_pages").options(path=str(tmp_path), keyword="k", total=5, display=2).load()
    assert sorted(r.pos for r in got.collect()) == [1, 2, 5]


def test_streams(spark, tmp_path):
    base = datetime(2025, 1, 1)
    data = [(i, base.replace(minute=i), f"l{i % 3}", 1.0) for i in range(9)]
    spark.createDataFrame(data, "i int, ts timestamp, link string, value double").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("i int, ts timestamp, link string, value double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert sorted(r.link for r in events.run_to_table(events.dedup_stream(stream(), "link", "ts")).collect()) == ["l0", "l1", "l2"]
    counts = events.run_to_table(events.windowed_counts(stream(), "ts", "link", "1 hour", "1 hour"), "complete")
    assert sorted((r.link, r.n) for r in counts.collect()) == [("l0", 3), ("l1", 3), ("l2", 3)]
    events.upsert_stream(stream(), str(tmp_path / "archive"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.link for r in spark.read.parquet(str(tmp_path / "archive")).collect()) == ["l0", "l1", "l2"]


def test_keep_first_equals_window_on_random_rows(spark):
    rnd = random.Random(1)
    data = [art(i, title=rnd.choice(["a", "b", None]), originallink=rnd.choice(["https://p.example/1", None])) for i in range(60)]
    got = sorted(r.pos for r in rows.keep_first(frame(spark, data), ["title", "originallink"], ["pos"]).collect())
    first = {}
    for r in data:
        first.setdefault((r[3], r[6]), r[0])
    assert got == sorted(first.values())
