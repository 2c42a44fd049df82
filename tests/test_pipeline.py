"""The assembled pipeline, providers, state and logs on small fixtures."""

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import providers, rows, similarity
from gleaner.plans import pipeline
from gleaner.session import counted, discard, table_bytes
from gleaner.sources import archives
from gleaner.streaming import events

FETCHED = "pos bigint, search_keyword string, news_id string, pubdate string, collected_at string, title string, description string, link string, originallink string"
TOPICS = ["harbor budget vote delayed again by council", "school meal plan wins wide support", "night bus routes return in spring", "solar farm permit goes to court"]


def parse(c):
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))


def fetched(spark, keyword, first, n, hour):
    out = []
    for i in range(first, first + n):
        t = TOPICS[i % 4]
        out.append((i, keyword, f"n{i}", f"2025-09-01 {hour:02}:{i % 60:02}:00", "2025-09-02 00:00:00", f"[{i}] {t} {i // 4}", "d" * 30, f"https://n.example/{i}", f"https://p{i}.example/{i}"))
    return spark.createDataFrame(out, FETCHED)


def content(df):
    body = F.concat_ws(" ", *[F.concat(F.lit(f"word{k}"), (F.col("pos") % 4).cast("string")) for k in range(40)], F.concat(F.lit("own"), "pos"))
    return df.withColumn("content", F.when(F.col("pos") % 7 != 6, body).otherwise("short"))


def test_pipeline_from_rows_to_boards(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    s = pipeline.Settings(root, [("a", False, 10), ("b", False, 10), ("broken", False, 10)], "n.example", ["nothing"], ["p1.example"])
    given = {"a": fetched(spark, "a", 0, 12, 1), "b": fetched(spark, "b", 8, 12, 2), "broken": fetched(spark, "broken", 0, 3, 3)}

    def run(keyword, required, count):
        def fetch(df):
            if keyword == "broken":
                raise OSError("no route")
            return content(df)

        return pipeline.run_keyword(spark, s, keyword, required, given[keyword].limit(100), fetch, parse)

    done = pipeline.run_due(spark, s, datetime(2025, 9, 2, 12), run)
    assert [(d["keyword"], d["new_raw"], d["status"].split(":")[0]) for d in done] == [("a", 12, "success"), ("b", 12, "success"), ("broken", 3, "fail")]
    assert all(1 <= d["final_added"] < 12 for d in done[:2]) and done[2]["final_added"] == 0
    selected = spark.read.parquet(f"{root}/a/selected")
    assert selected.count() == done[0]["final_added"] and selected.where("is_canon").count() == selected.count()
    assert {r.cluster_id[:2] for r in selected.collect()} == {"C-"}
    assert spark.read.parquet(f"{root}/a/rejects").where("reject_reason = 'short'").count() >= 1
    assert spark.read.parquet(f"{root}/a/similarity_log").columns[:3] == ["news_id", "pubdate", "collected_at"]
    steps = archives.read_state(spark, f"{root}/broken/steps.json")
    assert steps["steps"][-1]["status"] == "failed" and steps["steps"][-1]["error_message"] == "no route"

    # an hour later nothing but the failed keyword is due; three hours after that all are, but nothing is new
    assert [d["keyword"] for d in pipeline.run_due(spark, s, datetime(2025, 9, 2, 13), run)] == ["broken"]
    again = pipeline.run_due(spark, s, datetime(2025, 9, 2, 16), run)
    assert [(d["keyword"], d["new_raw"], d["final_added"]) for d in again] == [("a", 0, 0), ("b", 0, 0), ("broken", 0, 0)]
    log = spark.read.parquet(f"{root}/execution_log").orderBy("execute_at", "tot_new_raw").collect()
    assert log[-1].tot_new_raw == 27 and log[-1].tot_final_added == done[0]["final_added"] + done[1]["final_added"]
    assert len(list((tmp_path / "out/state_history").iterdir())) >= 1

    totals = pipeline.aggregate(spark, s, parse)
    kept = spark.read.parquet(f"{root}/canonical_archive")
    assert totals["n_kept"] == kept.count() == kept.select("news_id").distinct().count() and totals["n_ids"] == totals["n_kept"] + totals["n_removed"]
    assert spark.read.parquet(f"{root}/canonical_summary").columns == ["news_id", "pubdate", "title", "description"]


def test_issue_outputs_and_report(spark, tmp_path):
    root = f"file://{tmp_path}/issues"
    items = spark.createDataFrame([(i, f"n{i}", f"title {i}", [float(v) for v in np.eye(64)[i % 2] + 0.01 * i]) for i in range(8)], "vec_id bigint, news_id string, title string, embedding array<float>")
    labels = spark.createDataFrame([(i, -1 if i == 7 else i % 2) for i in range(8)], "vec_id bigint, cluster_id int")
    name = lambda meta: providers.label_issues(meta, {"x": lambda ask: "a label" if "title 0" in ask else ""}, "x", "{titles}")
    pipeline.issue_outputs(spark, root, "20250901_00", items, labels, name)
    meta = archives.read_json(spark, f"{root}/current/meta").orderBy("issue_cluster_id").collect()
    assert [(m.issue_cluster_id, m.issue_label, m.cluster_size) for m in meta] == [(0, "a label", 4), (1, "issue_1", 3)]
    assert len(spark.read.json(f"{root}/20250901_00/centers").first().issue_center_embedding) == 64
    assert spark.read.option("header", True).csv(f"{root}/20250901_00/article_map").where("issue_cluster_id = -1").count() == 1
    assert archives.latest_run(spark, root) == "current"
    report = [r.text for r in pipeline.issue_report(archives.read_json(spark, f"{root}/current/meta")).collect()]
    assert report[0].startswith("[0] a label (4)\n  - title") and len(report) == 2
    line = pipeline.experiment_line(items, labels, "t", "b", "m", 3, 4).first()
    assert (line.n_rows, line.n_clusters, line.n_noise) == (8, 2, 1) and line.silhouette > 0.9


def test_providers(spark, tmp_path):
    calls = []
    meta = spark.createDataFrame([(1, 2, ["t1"]), (2, 2, []), (3, 2, None), (4, 2, ["boom"]), (5, 2, ["long" * 20])], "issue_cluster_id int, cluster_size int, representative_titles array<string>")

    def call(ask):
        if "boom" in ask:
            raise RuntimeError
        return ask.removeprefix("- ") + " ok"

    got = {r.issue_cluster_id: r.issue_label for r in providers.label_issues(meta, {"p": call}, "p", "{titles}").collect()}
    assert got == {1: "t1 ok", 2: "issue_2", 3: "issue_3", 4: "issue_4", 5: "issue_5"}
    with pytest.raises(ValueError):
        providers.label_issues(meta, {"p": call}, "q", "{titles}")
    encode = lambda texts: np.array([[len(t), 0.0] for t in texts])
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "")], "id bigint, t string")
    assert {r.id: r.embedding for r in providers.embed(df, "id", F.col("t"), encode).collect()} == {1: [1.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}
    path = f"file://{tmp_path}/vectors"
    known = df.where("t is not null")
    for table, n in ((known, 2), (known, 2), (known.withColumn("t", F.concat("t", F.lit("x"))), 4)):
        assert providers.cached_embeddings(table, "id", F.col("t"), encode, path, "m").count() == 2
        assert spark.read.parquet(path).count() == n
    assert not calls


def test_state_loops_and_checks(spark, tmp_path):
    path, old = f"file://{tmp_path}/state.json", f"file://{tmp_path}/old"
    for k in range(3):
        archives.write_state(spark, path, {"a": k, "ㄱ": "x"}, old)
    assert archives.read_state(spark, path) == {"a": 2, "ㄱ": "x"}
    assert sorted(json.loads(p.read_text())["a"] for p in (tmp_path / "old").iterdir() if p.suffix == ".json") == [0, 1]
    waits, turns = [], iter([None, ValueError, None])

    def job():
        if (e := next(turns)) is not None:
            raise e

    assert pipeline.every(3600, job, waits.append, turns=3) == 1 and waits == [3600, 5.0, 3600]
    assert pipeline.writable(spark, f"file://{tmp_path}/new") and not pipeline.writable(spark, "file:///proc/none")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "link string, pos bigint")
    assert rows.check_codes(None, []) == [("unique_key", 1)] and rows.check_codes(df, []) == [("unique_key", 2)]
    assert rows.check_codes(df.where("pos > 1"), ["link", "title"]) == [("unique_key", 0), ("required_columns", 1)]
    assert [r.pos for r in rows.duplicate_dump(df, top=10).collect()] == [1, 2]
    with pytest.raises(ValueError, match="title"):
        rows.require_columns(df, ["link", "title"])
    assert archives.read_template(spark, f"file://{tmp_path}/none.txt", "{titles}") == "{titles}"
    (tmp_path / "x.xml").write_text("<r><i><t>a</t></i><i><t>b</t></i></r>")
    assert {r.t for r in archives.read_xml(spark, f"file://{tmp_path}/x.xml", "i").collect()} == {"a", "b"}
    archives.write_csv(df.withColumn("title", F.lit('say "x",\nline')), f"file://{tmp_path}/c")
    assert {tuple(r) for r in archives.read_csv(spark, f"file://{tmp_path}/c", "title string, link string, pos bigint").collect()} == {('say "x",\nline', r.link, r.pos) for r in df.collect()}


def test_probe_modes(spark):
    text = ["alpha beta gamma delta", "alpha beta gamma delta", "omega psi chi", None]
    df = spark.createDataFrame([(i, f"n{i}", t, t if i != 1 else "another body with other words") for i, t in enumerate(text)], "pos bigint, news_id string, title string, content string")
    for mode, edges, n in (("or", [("n0", "n1", "title")], 2), ("and", [], 0)):
        hit, got = similarity.probe(df, mode=mode)
        assert sorted(map(tuple, got.collect())) == edges and hit.count() == n
    with pytest.raises(ValueError):
        similarity.probe(df, mode="xor")


def test_elect_by_any_policy(spark):
    df = spark.createDataFrame([("c", "n1", 3), ("c", "n2", 9), ("d", "n3", 1)], "cluster_id string, news_id string, size int")
    assert {tuple(r) for r in similarity.elect_by(df, lambda pdf: pdf.loc[pdf["size"].idxmax()]).collect()} == {("c", "n2"), ("d", "n3")}


def test_repeated_batches_replace_themselves(spark, tmp_path):
    spark.range(10).selectExpr("id", "timestamp_seconds(id) AS ts").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id bigint, ts timestamp").parquet(f"{tmp_path}/in")
    assert sorted(r.id for r in events.run_to_table(stream).collect()) == list(range(10))


def test_measured_bytes_and_discarded_tables(spark, tmp_path):
    t, seen = counted(spark.createDataFrame([("a" * 100, [1, 2]), (None, None)], "s string, x array<int>"), "t")
    assert seen["n"] == 2 and 100 < table_bytes(t) < 400
    discard(t, None)
    assert not archives.exists(spark, t._gleaner_path)
