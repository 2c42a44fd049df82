"""Row operators: filters with reasons, keep-first windows, incremental archives, checks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.text import press_piece, unicode_trim
from gleaner.session import sized_join


def first_reason(*cases: tuple[Column, str]) -> Column:
    """Name of the first case that holds, NULL if none does."""
    out = F.lit(None).cast("string")
    for hit, name in reversed(cases):
        out = F.when(F.coalesce(hit, F.lit(False)), name).otherwise(out)
    return out


def pre_filter(
    df: DataFrame, keywords: DataFrame, link_pattern: str, excluded: list[str], least_snippet: int = 20
) -> DataFrame:
    """Add ``reject_reason`` by link, required keyword, title words, snippet length, repeated title of a press.

    ``keywords`` (keyword, is_required) is a control table, broadcast if its bytes allow. A NULL link or, where required, a NULL title is rejected; a NULL
    description is kept. Of several rows with one press host and title (NULLs
    equal) the first by ``pos`` among rows that no earlier case rejects is kept.
    """
    kw = keywords.select(F.col("keyword").alias("search_keyword"), "is_required").dropDuplicates(["search_keyword"])
    words = [re.escape(w.strip()) for w in excluded if w.strip()]
    title = F.lower(F.col("title"))
    missing = F.coalesce("is_required", F.lit(False)) & ~F.coalesce(F.contains(title, F.lower("search_keyword")), F.lit(False))
    rows = sized_join(df, kw, ["search_keyword"], "left").withColumn(
        "__why",
        first_reason(
            (~F.coalesce(F.col("link").rlike(link_pattern), F.lit(False)), "link"),
            (missing, "keyword"),
            (F.col("title").rlike("(?iu)" + "|".join(words)) if words else F.lit(False), "title"),
            (F.length("description") < least_snippet, "snippet"),
        ),
    )
    rows = rows.withColumn("__press", press_piece(F.col("originallink")))
    # the first row of each press and title is a map-side minimum over the rows that are left
    first = rows.where("__why is null").groupBy(F.col("__press").alias("__p"), F.col("title").alias("__t")).agg(F.min("pos").alias("__first"))
    on = F.col("__why").isNull() & F.col("__press").eqNullSafe(F.col("__p")) & F.col("title").eqNullSafe(F.col("__t"))
    again = F.col("__why").isNull() & (F.col("pos") > F.col("__first"))
    out = rows.join(first, on, "left").withColumn("reject_reason", F.when(again, "repeated_title").otherwise(F.col("__why")))
    return out.drop("__why", "is_required", "__press", "__p", "__t", "__first")


def post_filter(df: DataFrame, least: int = 200, most: int = 5000) -> DataFrame:
    """Add ``reject_reason`` by content: empty (NULL or blank), short, long."""
    n = F.length("content")
    blank = F.col("content").isNull() | (unicode_trim(F.col("content")) == "")
    return df.withColumn("reject_reason", first_reason((blank, "empty"), (n < least, "short"), (n > most, "long")))


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """First row of each key in the given total order; NULL keys are one key.

    The narrow rank is a map-side minimum per key, so a hot key costs no window.
    """
    rank = F.struct(*[F.col(o).alias(o) if isinstance(o, str) else o for o in order])
    named = [(k if isinstance(k, Column) else F.col(k)).alias(f"__k{i}") for i, k in enumerate(keys)]
    marked = df.select("*", *named, rank.alias("__rank"))
    best = marked.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(F.min("__rank").alias("__best"))
    on = [marked[f"__k{i}"].eqNullSafe(best[f"__k{i}"]) for i in range(len(keys))]
    kept = marked.join(best, [*on, F.col("__rank") == F.col("__best")], "left_semi")
    return kept.select(*df.columns)


def latest_per_link(df: DataFrame, key: str = "news_id") -> DataFrame:
    """Newest row per key, unparsed times last, ties by ``pos``."""
    return keep_first(df, [key], [(-F.coalesce(F.unix_micros("pub_ts"), F.lit(-(1 << 62)))).alias("t"), F.col("pos").alias("pos")])


def all_duplicates(df: DataFrame, key: str) -> DataFrame:
    """All rows of keys that occur more than once, with ``n_rows``; NULL is no key."""
    many = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    return df.join(many, key)


def lookback(df: DataFrame, rows: int, by: str | None = None) -> DataFrame:
    """Newest ``rows`` rows (per ``by``) in archive order; the window is the feature."""
    if by is None:
        return df.orderBy(F.col("pub_ts").desc_nulls_last(), "pos").limit(rows)
    order = W.partitionBy(by).orderBy(F.col("pub_ts").desc_nulls_last(), "pos")
    return df.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= rows).drop("__n")


def new_rows(batch: DataFrame, seen: DataFrame, key: str = "link") -> DataFrame:
    """Rows of the batch whose key the archive lacks; NULL equals NULL.

    Rows are not compared within the batch.
    """
    keys = seen.select(F.coalesce(key, F.lit("\0")).alias("__k")).distinct()
    return batch.withColumn("__k", F.coalesce(key, F.lit("\0"))).join(keys, "__k", "left_anti").drop("__k")


def upsert(archive: DataFrame, batch: DataFrame, key: str = "link", rows: int | None = None) -> DataFrame:
    """Archive with the batch's new rows; columns either side lacks are NULL."""
    seen = archive if rows is None else lookback(archive, rows)
    return archive.unionByName(new_rows(batch, seen, key), allowMissingColumns=True)


def archive_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("pub_ts").desc_nulls_last(), "pos")


def merge_archives(archives: list[DataFrame]) -> DataFrame:
    """All archives one under the other, by name."""
    out = archives[0]
    for a in archives[1:]:
        out = out.unionByName(a, allowMissingColumns=True)
    return out


def entity_slice(df: DataFrame, word: str) -> DataFrame:
    """Rows whose title or content contains the word; NULL contains nothing."""
    hit = F.coalesce(F.contains("title", F.lit(word)), F.lit(False)) | F.coalesce(F.contains("content", F.lit(word)), F.lit(False))
    return df.where(hit).select("news_id", "title", "content", "pubdate")


def recent(df: DataFrame, ts: str, hours: int = 12) -> DataFrame:
    """Rows within the last ``hours`` before the newest one, both ends included; NULL times are out."""
    base = df.agg(F.max(ts).alias("__base"))
    return df.crossJoin(F.broadcast(base)).where(F.col(ts).between(F.col("__base") - F.expr(f"INTERVAL {hours} HOURS"), F.col("__base"))).drop("__base")


def due(keys: DataFrame, state: DataFrame, now: Column, hours: float = 3.0) -> DataFrame:
    """Keys that never ran or last ran at least ``hours`` ago: ``keyword, elapsed_hours``."""
    j = keys.select("keyword").join(state, "keyword", "left")
    elapsed = (F.unix_micros(now) - F.unix_micros("last_executed")) / F.lit(3.6e9)
    return j.select("keyword", elapsed.alias("elapsed_hours")).where(F.coalesce(F.col("elapsed_hours") >= hours, F.lit(True)))


def run_totals(log: DataFrame) -> DataFrame:
    """Running totals and yield of a run log (execute_at, seq, new_raw, final_added as text or numbers).

    Values that are no numbers, as of separator lines, count nothing. Per-day sums
    are windowed first, so that no task gets more than the days or one day's rows.
    """
    num = lambda c: F.coalesce(F.col(c).try_cast("bigint"), F.lit(0))
    rows = log.select("execute_at", "seq", "keyword", num("new_raw").alias("new_raw"), num("final_added").alias("final_added"), F.to_date("execute_at").alias("day"))
    days = rows.groupBy("day").agg(F.sum("new_raw").alias("r"), F.sum("final_added").alias("f"))
    before = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    days = days.select("day", F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"), F.coalesce(F.sum("f").over(before), F.lit(0)).alias("f0"))
    inner = W.partitionBy("day").orderBy("execute_at", "seq").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("r", F.sum("new_raw").over(inner)).withColumn("f", F.sum("final_added").over(inner)).join(days, "day")
    ratio = F.when(F.col("new_raw") > 0, F.bround(F.col("final_added") / F.col("new_raw"), 3)).otherwise(0.0)
    return rows.select("execute_at", "seq", "keyword", "new_raw", "final_added", ratio.alias("e_ratio"), (F.col("r") + F.col("r0")).alias("tot_new_raw"), (F.col("f") + F.col("f0")).alias("tot_final_added"))


def check_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that the table lacks, in order."""
    return [c for c in required if c not in df.columns]


def validate(df: DataFrame, required: list[str], key: str = "link") -> DataFrame:
    """One row per check: ``check_name, status, n_bad``; the key check is skipped if its column is missing."""
    spark, missing = df.sparkSession, check_columns(df, required)
    rows = spark.createDataFrame([("required_columns", "fail" if missing else "pass", len(missing))], "check_name string, status string, n_bad bigint")
    if key in df.columns:
        bad = all_duplicates(df, key).agg(F.count("*").alias("n_bad"))
        rows = rows.unionByName(bad.select(F.lit("unique_key").alias("check_name"), F.when(F.col("n_bad") > 0, "fail").otherwise("pass").alias("status"), "n_bad"))
    return rows


def duplicate_dump(df: DataFrame, key: str = "link", top: int | None = None) -> DataFrame:
    """All rows of repeated keys in key order; ``top`` rows for a console report."""
    out = all_duplicates(df, key).orderBy(key, *(["pos"] if "pos" in df.columns else []))
    return out if top is None else out.limit(top)


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """The table itself; ValueError names the columns it lacks."""
    if missing := check_columns(df, required):
        raise ValueError(f"missing columns: {missing}")
    return df


def check_codes(df: DataFrame | None, required: list[str], key: str = "link") -> list[tuple[str, int]]:
    """Exit codes of the checks, in order, up to the first that fails: 0 pass, 1 no table or column, 2 repeated keys."""
    if df is None or key not in df.columns:
        return [("unique_key", 1)]
    codes = [("unique_key", 2 if all_duplicates(df, key).limit(1).count() else 0)]
    return codes if codes[0][1] else [*codes, ("required_columns", 1 if check_columns(df, required) else 0)]


def is_agency(url: Column, domains: list[str]) -> Column:
    """Whether the link contains one of the domains; NULL contains none."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.contains(url, F.lit(d)) for d in domains], F.lit(False)), F.lit(False))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that the table lacks, filled with constants."""
    return df.select("*", *[F.lit(v).alias(c) for c, v in defaults.items() if c not in df.columns])
