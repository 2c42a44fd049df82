"""The assembled pipeline: one keyword, all keywords that are due, the global archive, the issue board.

Every stage is an operator of this library; here they are chained, isolated from
each other's failures, and logged.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.functions.text import zoned_stamp
from gleaner.operators import rows, similarity, vectors
from gleaner.session import counted, hadoop_path, materialize
from gleaner.sources import archives

STAMP = "%Y-%m-%d %H:%M:%S"
LOG = "execute_at string, keyword string, new_raw bigint, final_added bigint, status string, e_ratio double, tot_new_raw bigint, tot_final_added bigint"


@dataclass
class Settings:
    """What a run needs to know; ``sample`` takes the first ``sample`` keywords only."""

    root: str
    keywords: list[tuple[str, bool, int]]
    link_pattern: str = ".*"
    excluded: list[str] = field(default_factory=list)
    agency_domains: list[str] = field(default_factory=list)
    title: float = 0.18
    body: float = 0.17
    lookback: int = 2000
    hours: float = 3.0
    sample: int | None = None

    def table(self) -> list[tuple[str, bool, int]]:
        return self.keywords if self.sample is None else self.keywords[: self.sample]


class StepLog:
    """Steps of a run with times, metadata, metrics and errors, kept as one JSON file."""

    def __init__(self, module: str):
        self.module, self.started, self.steps = module, datetime.now().strftime(STAMP), []

    def start(self, name: str, **metadata) -> None:
        self.steps.append({"step_number": len(self.steps) + 1, "step_name": name, "start_time": datetime.now().strftime(STAMP), "began": time.monotonic(), "status": "running", "metadata": metadata, "metrics": {}, "error_message": None})

    def end(self, error: str | None = None, **metrics) -> None:
        if self.steps and self.steps[-1]["status"] == "running":
            step = self.steps[-1]
            step |= {"end_time": datetime.now().strftime(STAMP), "elapsed_seconds": round(time.monotonic() - step.pop("began"), 3), "status": "failed" if error else "success", "metrics": metrics, "error_message": error}

    def save(self, spark: SparkSession, path: str) -> None:
        archives.write_state(spark, path, {"module": self.module, "timestamp": self.started, "total_steps": len(self.steps), "steps": [{k: v for k, v in s.items() if k != "began"} for s in self.steps]})


def _with_time(df: DataFrame, parse) -> DataFrame:
    return df.withColumn("pub_ts", parse(F.col("pubdate")))


def run_keyword(spark: SparkSession, s: Settings, keyword: str, required: bool, fetched: DataFrame, fetch: Callable[[DataFrame], DataFrame], parse) -> dict:
    """One keyword from fetched rows to its selected archive; a failure becomes the status and stops no other keyword.

    ``fetched``: article columns and ``pos``; ``fetch`` adds ``content`` to the rows that pass
    the first filter; ``parse`` turns ``pubdate`` into an instant. Rejected rows, rows that
    SimHash removes and the similarity log are written beside the archive.
    """
    stats = {"keyword": keyword, "new_raw": 0, "final_added": 0, "status": "initialized"}
    log, home = StepLog(f"pipeline_{keyword}"), f"{s.root}/{keyword}"
    try:
        log.start("collect")
        raw = archives.read_archive(spark, f"{home}/raw", StructType(fetched.schema.fields))
        seen = rows.lookback(_with_time(raw, parse), s.lookback)
        new, n = counted(rows.new_rows(fetched, seen.select("link")), "new")
        stats["new_raw"] = n["n"]
        log.end(fetched=n["n"])
        if n["n"]:
            archives.replace(rows.archive_order(_with_time(raw.unionByName(new, allowMissingColumns=True), parse)).drop("pub_ts"), f"{home}/raw")
            archives.replace(archives.summary(new), f"{home}/raw_summary")

            log.start("filter")
            words = spark.createDataFrame([(keyword, required)], "keyword string, is_required boolean")
            first = materialize(rows.pre_filter(new, words, s.link_pattern, s.excluded), "first")
            archives.append_rejects(first, f"{home}/rejects")
            whole = rows.post_filter(fetch(first.where("reject_reason is null").drop("reject_reason")))
            whole = materialize(whole, "second")
            archives.append_rejects(whole, f"{home}/rejects")
            kept = whole.where("reject_reason is null").drop("reject_reason")
            log.end()

            log.start("deduplicate")
            ordered = kept.withColumn("__pos", F.col("pos"))
            marked = materialize(ordered.join(similarity.simhash_dedup(ordered, "pos"), "pos"), "marked")
            removed = marked.where("removed_by is not null").drop("__pos")
            if removed.limit(1).count():
                removed.withColumn("run_ts", F.lit(log.started)).write.mode("append").parquet(f"{home}/simhash_removed")
            left = _with_time(marked.where("removed_by is null").drop("removed_by", "__pos"), parse)
            left = left.withColumn("is_agency", rows.is_agency(F.col("originallink"), s.agency_domains))
            clustered, counts = similarity.keyword_cluster(left, s.title, s.body)
            log.end(**counts.first().asDict())

            log.start("archive")
            if keyword != "test":
                similarity_log(clustered).withColumn("run_ts", F.lit(log.started)).write.mode("append").parquet(f"{home}/similarity_log")
            stats["final_added"] = merge_selected(spark, clustered.where("is_canon"), home, s.lookback)
            log.end(final_added=stats["final_added"])
        stats["status"] = "success"
    except Exception as e:  # noqa: BLE001  one keyword must not stop the others
        stats["status"] = f"fail: {e}"
        log.end(error=str(e))
    log.save(spark, f"{home}/steps.json")
    return stats


def similarity_log(clustered: DataFrame) -> DataFrame:
    """Columns of the similarity log in ``cluster_id`` order, with the publication time as text."""
    wanted = ["news_id", "pubdate", "collected_at", "is_canon", "cluster_id", "title_id", "body_id", "replaced_by", "title"]
    return clustered.select(*[c for c in wanted if c in clustered.columns], zoned_stamp(F.col("pub_ts")).alias("pubdate_str")).orderBy("cluster_id", "pos")


def merge_selected(spark: SparkSession, chosen: DataFrame, home: str, lookback: int) -> int:
    """Add chosen rows whose link the newest ``lookback`` rows of the selected archive lack; returns how many."""
    path = f"{home}/selected"
    old = archives.read_archive(spark, path, StructType(chosen.schema.fields))
    new, n = counted(rows.new_rows(chosen, rows.lookback(old, lookback).select("link")), "chosen")
    if n["n"]:
        both = rows.archive_order(old.unionByName(new, allowMissingColumns=True))
        archives.replace(archives.ordered(both), path)
        archives.replace(archives.summary(archives.read_archive(spark, path)), f"{path}_summary")
    return n["n"]


def append_run_log(spark: SparkSession, path: str, stats: list[dict], at: str) -> DataFrame:
    """Append a cycle to the run log; running totals go on from the log's sums, in which text that is no number counts nothing."""
    log = archives.read_archive(spark, path, LOG)
    total = log.agg(*[F.coalesce(F.sum(F.col(c).try_cast("bigint")), F.lit(0)).alias(c) for c in ("new_raw", "final_added")]).first()
    raw, final, out = total["new_raw"], total["final_added"], []
    for s in stats:
        raw, final = raw + s["new_raw"], final + s["final_added"]
        ratio = round(s["final_added"] / s["new_raw"], 3) if s["new_raw"] else 0.0
        out.append((at, s["keyword"], s["new_raw"], s["final_added"], s["status"], ratio, raw, final))
    new = spark.createDataFrame(out, LOG).coalesce(1)
    new.write.mode("append").parquet(path)
    return new


def run_due(spark: SparkSession, s: Settings, now: datetime, run: Callable[[str, bool, int], dict]) -> list[dict]:
    """Run the keywords that never ran or ran at least ``hours`` ago; log the cycle and keep when each last succeeded."""
    path, at = f"{s.root}/last_executed.json", now.strftime(STAMP)
    state, done = archives.read_state(spark, path), []
    last = spark.createDataFrame(list(state.items()), "keyword string, t string").select("keyword", F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss")).alias("last_executed"))
    keys = spark.createDataFrame([(k,) for k, _, _ in s.table()], "keyword string")
    ready = {r["keyword"] for r in rows.due(keys, last, F.lit(at).cast("timestamp"), s.hours).collect()}
    for keyword, required, count in s.table():
        if keyword in ready:
            stats = run(keyword, required, count)
            done.append(stats)
            if stats["status"] == "success":
                state[keyword] = at
    if done:
        append_run_log(spark, f"{s.root}/execution_log", done, at)
        archives.write_state(spark, path, state, f"{s.root}/state_history")
    return done


def every(seconds: float, job: Callable[[], object], sleep: Callable[[float], None] = time.sleep, retry: float = 5.0, turns: int | None = None) -> int:
    """Run a job again and again; one that fails is tried again after ``retry`` seconds. Returns the failures of ``turns`` turns."""
    failed, done = 0, 0
    while turns is None or done < turns:
        try:
            job()
            sleep(seconds)
        except Exception:  # noqa: BLE001  the loop outlives its jobs
            failed += 1
            sleep(retry)
        done += 1
    return failed


def writable(spark: SparkSession, folder: str) -> bool:
    """Whether a file can be made in the folder, which is made if need be."""
    fs, p = hadoop_path(spark, folder)
    _, probe = hadoop_path(spark, f"{folder}/.write-{uuid.uuid4().hex}")
    try:
        fs.mkdirs(p)
        fs.create(probe, True).close()
        return bool(fs.delete(probe, False))
    except Exception:  # noqa: BLE001  whatever the file system says: not writable
        return False


def aggregate(spark: SparkSession, s: Settings, parse, title: float = 0.20, body: float = 0.19) -> dict[str, int]:
    """Global archive of all keyword archives: newest row per id, then one row per similarity cluster; the rest is kept aside."""
    if not writable(spark, s.root):
        raise PermissionError(f"{s.root} is not writable")
    merged = _with_time(archives.read_keyword_archives(spark, s.root, [k for k, _, _ in s.table()], "selected"), parse)
    one, n = counted(rows.latest_per_link(merged.drop("cluster_id", "title_id", "body_id", "is_canon", "replaced_by")), "newest")
    marked = materialize(similarity.global_dedup(one.withColumn("is_agency", rows.is_agency(F.col("originallink"), s.agency_domains)), title, body), "global")
    kept = archives.ordered(marked.where("removed_by is null").drop("removed_by", "is_agency"))
    archives.replace(kept, f"{s.root}/canonical_archive")
    archives.replace(archives.summary(kept), f"{s.root}/canonical_summary")
    gone = marked.where("removed_by is not null")
    n_gone = gone.count()
    if n_gone:
        archives.replace(gone, f"{s.root}/excluded")
    return {"n_ids": n["n"], "n_kept": n["n"] - n_gone, "n_removed": n_gone}


def issue_outputs(spark: SparkSession, root: str, run_id: str, items: DataFrame, labels: DataFrame, name: Callable[[DataFrame], DataFrame] | None = None, k: int = 5) -> DataFrame:
    """Write centres, meta and article map of a run; ``current`` gets centres and meta. Returns the meta table.

    ``items``: vec_id, news_id, title, embedding; ``labels``: vec_id, cluster_id (-1: noise, kept
    in the map only). ``name`` may put better labels on the meta rows.
    """
    meta = vectors.issue_board(items, labels, k)
    meta = materialize(name(meta) if name else meta, "meta")
    inside = items.join(labels, "vec_id")
    centres = vectors.centroids(inside.where("cluster_id <> -1").select(F.col("cluster_id").alias("label"), "embedding"))
    centres = materialize(centres.select(F.col("label").alias("issue_cluster_id"), F.col("centroid").alias("issue_center_embedding")), "centres")
    for folder in (run_id, "current"):
        archives.replace(centres.orderBy("issue_cluster_id"), f"{root}/{folder}/centers", "json")
        archives.replace(meta.orderBy("issue_cluster_id"), f"{root}/{folder}/meta", "json")
    archives.replace(inside.select("news_id", F.col("cluster_id").alias("issue_cluster_id")), f"{root}/{run_id}/article_map", "csv", header=True)
    return meta


def experiment_line(items: DataFrame, labels: DataFrame, at: str, base: str, model: str, min_size: int, min_samples: int) -> DataFrame:
    """One row of parameters and cluster quality, to be appended to a metrics table."""
    inside = items.join(labels, "vec_id").withColumnRenamed("cluster_id", "label")
    quality = vectors.cluster_quality(inside)
    score = vectors.silhouette(inside.where("label <> -1"))
    return quality.crossJoin(score).select(F.lit(at).alias("run_at"), F.lit(base).alias("base_at"), F.lit(min_size).alias("min_size"), F.lit(min_samples).alias("min_samples"), "n_rows", "n_clusters", "n_noise", "noise_pct", F.round("silhouette", 4).alias("silhouette"), F.lit(model).alias("model"))


def issue_report(meta: DataFrame) -> DataFrame:
    """One text per issue as a console shows it: label, size, titles."""
    lines = F.array_join(F.transform("representative_titles", lambda t: F.concat(F.lit("  - "), t)), "\n")
    return meta.orderBy("issue_cluster_id").select(F.concat(F.lit("["), F.col("issue_cluster_id").cast("string"), F.lit("] "), "issue_label", F.lit(" ("), F.col("cluster_size").cast("string"), F.lit(")\n"), lines).alias("text"))
