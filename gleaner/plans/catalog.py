"""Queries of the core and their SQL: name -> callable(spark, sf_dir) / DuckDB SQL."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions import instants, text
from gleaner.functions.sites import host_of
from gleaner.operators import providers, rows, similarity, vectors
from gleaner.session import sized_join, table
from gleaner.sources import archives, pages
from gleaner.streaming import events as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LINKS = r"news\.portal"
# Words in titles that are not collected.
EXCLUDED = ["포토", "헤드라인", "[사진]", "[영상]", "[화보]", "[그래픽]", "톱뉴스", "[오늘의 주요일정]", "[투데이 라인업]", "[프로필]", "[부고]"]
# Hosts of news agencies.
AGENCIES = ["newsis.com", "yna.co.kr", "news1.kr"]
COLUMNS = ["search_keyword", "news_id", "pubdate", "collected_at", "title", "description", "link", "originallink", "content"]
TEMPLATE = "제목 목록:\n{titles}\n공통 이슈를 한 줄로."


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, the SQL that must give the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def articles(spark: SparkSession, d: str, name: str = "raw_articles") -> DataFrame:
    """Article rows with the order key ``pos`` and a synthetic ``pub_ts`` that SQL can form alike."""
    minutes = F.pmod(F.col("row_id") * 7919, F.lit(100003))
    return table(spark, d, name).withColumn("pos", F.col("row_id")).withColumn("pub_ts", F.timestamp_seconds(F.lit(1704067200) + minutes * 60))


_TS = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(((row_id * 7919) % 100003)::BIGINT)"
_A = f"a AS (SELECT *, row_id AS pos, {_TS} AS pub_ts FROM raw_articles)"
_TRIM = r"regexp_replace({}, '^[\s\x{{00a0}}\x{{3000}}\x{{2000}}-\x{{200a}}]+|[\s\x{{00a0}}\x{{3000}}\x{{2000}}-\x{{200a}}]+$', '', 'g')"
_PRESS = "string_split(originallink, '/')[3]"


# ---- timestamps


@query("p3_found")
def p3_found(spark, d):
    return instants.found_instants(table(spark, d, "raw_articles"), table(spark, d, "press_sites"))


@query("p3_incoming")
def p3_incoming(spark, d):
    return instants.found_instants(table(spark, d, "incoming_articles"), table(spark, d, "press_sites"))


# ---- projections and text


@query(
    "article_view",
    f"WITH {_A} SELECT pos, substr(md5(link), 1, 12) AS id, {_PRESS} AS press, length(content) AS n_content, "
    "md5(concat_ws(' ', title, substr(content, 1, 300))) AS input_md5 FROM a",
)
def article_view(spark, d):
    a = articles(spark, d)
    return a.select("pos", text.news_id(F.col("link")).alias("id"), text.press_piece(F.col("originallink")).alias("press"), F.length("content").cast("bigint").alias("n_content"), F.md5(text.embedding_input(F.col("title"), F.col("content"))).alias("input_md5"))


_NT = "title"
for _p in (r"\[[^\n]*?\]", r"\([^\n]*?\)", r"<[^\n]*?>", r"【[^\n]*?】"):
    _NT = f"regexp_replace({_NT}, '{_p}', '', 'g')"
_NT = f"coalesce({_TRIM.format(_NT)}, '')"


@query("normalize_title", f"WITH {_A} SELECT pos, {_NT} AS title FROM a")
def normalize_title(spark, d):
    return articles(spark, d).select("pos", text.normalize_title(F.col("title")).alias("title"))


@query("normalize_html")
def normalize_html(spark, d):
    return articles(spark, d).select("pos", text.normalize_html(F.col("title")).alias("title"), text.normalize_html(F.col("description")).alias("description"))


@query("site_host", r"SELECT row_id, nullif(regexp_replace(lower(regexp_extract(originallink, '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([^/?#:\s]+)', 1)), '^(?:(?:www|m)\.)+', ''), '') AS site FROM raw_articles")
def site_host(spark, d):
    return table(spark, d, "raw_articles").select("row_id", host_of(F.col("originallink")).alias("site"))


@query("shingle_counts", r"SELECT doc_id, greatest(length(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}_]', '', 'g')) - 3, 1) AS n FROM documents")
def shingle_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(text.char_shingles(F.col("text"))).cast("bigint").alias("n"))


# ---- filters and windows

_WHY = f"""CASE WHEN NOT coalesce(regexp_matches(link, '{LINKS}'), false) THEN 'link'
  WHEN coalesce(is_required, false) AND NOT coalesce(contains(lower(title), lower(search_keyword)), false) THEN 'keyword'
  WHEN coalesce(regexp_matches(title, '(?i){"|".join(re.escape(w) for w in EXCLUDED)}'), false) THEN 'title'
  WHEN coalesce(length(description) < 20, false) THEN 'snippet' END"""
_PRE = f"""{_A}, w AS (SELECT a.*, {_WHY} AS why FROM a LEFT JOIN keyword_config k ON k.keyword = a.search_keyword),
 pre AS (SELECT *, CASE WHEN why IS NULL AND row_number() OVER (PARTITION BY why, {_PRESS}, title ORDER BY pos) > 1 THEN 'repeated_title' ELSE why END AS reject_reason FROM w)"""


@query("pre_filter_rejects", f"WITH {_PRE} SELECT pos, reject_reason FROM pre")
def pre_filter_rejects(spark, d):
    kw = table(spark, d, "keyword_config")
    return rows.pre_filter(articles(spark, d), kw, LINKS, EXCLUDED).select("pos", "reject_reason")


@query("post_filter", f"WITH {_A} SELECT pos, CASE WHEN content IS NULL OR {_TRIM.format('content')} = '' THEN 'empty' WHEN length(content) < 200 THEN 'short' WHEN length(content) > 5000 THEN 'long' END AS reject_reason FROM a")
def post_filter(spark, d):
    return rows.post_filter(articles(spark, d)).select("pos", "reject_reason")


@query("reject_counts", f"WITH {_PRE} SELECT reject_reason, count(*) AS n FROM pre GROUP BY reject_reason")
def reject_counts(spark, d):
    return pre_filter_rejects(spark, d).groupBy("reject_reason").agg(F.count("*").alias("n"))


@query("keep_first_press_title", f"WITH {_A} SELECT pos FROM a QUALIFY row_number() OVER (PARTITION BY {_PRESS}, title ORDER BY pos) = 1")
def keep_first_press_title(spark, d):
    return rows.keep_first(articles(spark, d), [text.press_piece(F.col("originallink")), "title"], ["pos"]).select("pos")


@query("link_dedup_latest", f"WITH {_A} SELECT news_id, pos FROM a QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY pub_ts DESC NULLS LAST, pos) = 1")
def link_dedup_latest(spark, d):
    return rows.latest_per_link(articles(spark, d)).select("news_id", "pos")


@query("all_duplicates", f"WITH {_A} SELECT pos, n_rows FROM (SELECT pos, link, count(*) OVER (PARTITION BY link) AS n_rows FROM a WHERE link IS NOT NULL) WHERE n_rows > 1")
def all_duplicates(spark, d):
    return rows.all_duplicates(articles(spark, d), "link").select("pos", "n_rows")


@query("entity_slice", "SELECT news_id, title, md5(content) AS content_md5, pubdate FROM raw_articles WHERE coalesce(contains(title, '예산'), false) OR coalesce(contains(content, '예산'), false)")
def entity_slice(spark, d):
    return rows.entity_slice(table(spark, d, "raw_articles"), "예산").select("news_id", "title", F.md5("content").alias("content_md5"), "pubdate")


# ---- archives

_INC = f"b AS (SELECT *, row_id AS pos, {_TS} AS pub_ts FROM incoming_articles)"
_SEEN = "seen AS (SELECT link FROM a ORDER BY pub_ts DESC NULLS LAST, pos LIMIT 2000)"
_NEW = "SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM {} s WHERE s.link IS NOT DISTINCT FROM b.link)"


@query("incremental_new_rows", f"WITH {_A}, {_INC}, {_SEEN} SELECT pos, link FROM ({_NEW.format('seen')})")
def incremental_new_rows(spark, d):
    seen = rows.lookback(articles(spark, d), 2000)
    return rows.new_rows(articles(spark, d, "incoming_articles"), seen).select("pos", "link")


@query("archive_upsert", f"WITH {_A}, {_INC} SELECT pos, NULL::INT AS batch_id, link FROM a UNION ALL SELECT pos, batch_id, link FROM ({_NEW.format('a')})")
def archive_upsert(spark, d):
    return rows.upsert(articles(spark, d), articles(spark, d, "incoming_articles")).select("pos", "batch_id", "link")


@query("merge_keyword_archives", "SELECT search_keyword, count(*) AS n, count(DISTINCT news_id) AS n_ids FROM raw_articles WHERE search_keyword IN (SELECT keyword FROM keyword_config) GROUP BY search_keyword")
def merge_keyword_archives(spark, d):
    a = table(spark, d, "raw_articles")
    kept = sized_join(a, table(spark, d, "keyword_config").select(F.col("keyword").alias("search_keyword")).distinct(), ["search_keyword"], "left_semi")
    return rows.merge_archives([kept.where("row_id % 2 = 0"), kept.where("row_id % 2 = 1")]).groupBy("search_keyword").agg(F.count("*").alias("n"), F.countDistinct("news_id").alias("n_ids"))


@query("validate", "SELECT 'required_columns' AS check_name, 'pass' AS status, 0::BIGINT AS n_bad UNION ALL SELECT 'unique_key', CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END, n FROM (SELECT coalesce(sum(c), 0)::BIGINT AS n FROM (SELECT count(*) AS c FROM raw_articles WHERE link IS NOT NULL GROUP BY link HAVING count(*) > 1))")
def validate(spark, d):
    return rows.validate(table(spark, d, "raw_articles"), COLUMNS)


# ---- TF-IDF, leaders, components


def _tfidf_sql(column: str) -> str:
    word = r"[\p{L}\p{N}_]{2,}"
    return rf"""tok AS (SELECT doc_id AS pos, regexp_extract_all(lower(coalesce({column}, '')), '{word}') AS t FROM documents),
 term AS (SELECT pos, unnest(t || list_transform(range(1, greatest(len(t), 1)), lambda k: t[k] || ' ' || t[k + 1])) AS term FROM tok),
 tf AS (SELECT pos, term, count(*) AS tf FROM term GROUP BY ALL),
 df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
 x AS (SELECT pos, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS x FROM tf JOIN df USING (term)),
 w AS (SELECT pos, term, x / sqrt(sum(x * x) OVER (PARTITION BY pos)) AS w FROM x)"""


def _leader_sql(column: str, least: float) -> str:
    return rf"""WITH RECURSIVE {_tfidf_sql(column)},
 e AS (SELECT a.pos AS i, b.pos AS j FROM w a JOIN w b ON a.term = b.term AND a.pos < b.pos GROUP BY 1, 2 HAVING round(sum(a.w * b.w), 9) >= {least}),
 n AS (SELECT pos, row_number() OVER (ORDER BY pos) AS k, coalesce(nb, []) AS nb FROM (SELECT doc_id AS pos FROM documents) LEFT JOIN (SELECT j AS pos, list(i) AS nb FROM e GROUP BY j) USING (pos)),
 r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS heads UNION ALL SELECT n.k, CASE WHEN list_has_any(heads, nb) THEN heads ELSE list_append(heads, pos) END FROM r JOIN n ON n.k = r.k + 1),
 h AS (SELECT unnest(heads) AS head FROM r WHERE k = (SELECT max(k) FROM r)),
 m AS (SELECT j AS pos, max(i) AS leader FROM e WHERE i IN (SELECT head FROM h) GROUP BY j),
 c AS (SELECT pos, count(*) AS n_links FROM (SELECT i AS pos FROM e UNION ALL SELECT j FROM e) GROUP BY pos)
 SELECT n.pos, CASE WHEN h.head IS NOT NULL THEN n.pos ELSE m.leader END AS leader, coalesce(n_links, 0) AS n_links
 FROM n LEFT JOIN h ON h.head = n.pos LEFT JOIN m ON m.pos = n.pos LEFT JOIN c ON c.pos = n.pos"""


@query("doc_freq", f"WITH {_tfidf_sql('title')} SELECT term, df FROM df")
def doc_freq(spark, d):
    w = similarity.tfidf(table(spark, d, "documents"), "doc_id", "title")
    return w.groupBy("term").agg(F.max("df").alias("df"))


@query("tfidf_weights", f"WITH {_tfidf_sql('title')} SELECT pos, term, round(w, 6) AS w FROM w")
def tfidf_weights(spark, d):
    return similarity.tfidf(table(spark, d, "documents"), "doc_id", "title").select("pos", "term", F.round("w", 6).alias("w"))


@query("leader_groups_title", _leader_sql("title", 0.18))
def leader_groups_title(spark, d):
    return similarity.leader_groups(table(spark, d, "documents"), "doc_id", "title", 0.18)


@query("leader_groups_body", _leader_sql("text", 0.17))
def leader_groups_body(spark, d):
    return similarity.leader_groups(table(spark, d, "documents"), "doc_id", "text", 0.17)


def _groups(spark, d) -> DataFrame:
    a = articles(spark, d)
    own = F.concat(F.lit("#"), F.col("pos").cast("string"))
    keyed = a.select("pos", F.coalesce("title", own).alias("t"), F.coalesce(text.press_piece(F.col("originallink")), own).alias("p"), F.coalesce(F.md5("content"), own).alias("b"))
    t = keyed.groupBy("t", "p").agg(F.min("pos").alias("title_id"))
    b = keyed.groupBy("b").agg(F.min("pos").alias("body_id"))
    return keyed.join(t, ["t", "p"]).join(b, "b").select("pos", "title_id", "body_id")


_G = f"""{_A}, key AS (SELECT pos, coalesce(title, '#' || pos) AS t, coalesce({_PRESS}, '#' || pos) AS p, coalesce(md5(content), '#' || pos) AS b FROM a),
 g AS (SELECT pos, min(pos) OVER (PARTITION BY t, p) AS title_id, min(pos) OVER (PARTITION BY b) AS body_id FROM key)"""


@query(
    "or_components",
    f"WITH RECURSIVE {_G}, e AS (SELECT pos AS a, title_id AS b FROM g UNION SELECT title_id, pos FROM g UNION SELECT pos, body_id FROM g UNION SELECT body_id, pos FROM g), "
    "c(v, low) USING KEY (v) AS (SELECT pos, pos FROM g UNION SELECT e.b, min(c.low) FROM c JOIN e ON e.a = c.v JOIN recurring.c AS o ON o.v = e.b WHERE c.low < o.low GROUP BY e.b) "
    "SELECT v AS pos, low AS cluster_id FROM c",
)
def or_components(spark, d):
    return similarity.or_merge(_groups(spark, d))


@query("and_groups", f"WITH {_G} SELECT pos, min(pos) OVER (PARTITION BY title_id, body_id) AS cluster_id FROM g")
def and_groups(spark, d):
    return similarity.and_merge(_groups(spark, d))


def _electable(spark, d) -> DataFrame:
    sites = table(spark, d, "press_sites").select("site", "is_agency")
    a = sized_join(articles(spark, d).withColumn("site", host_of(F.col("originallink"))), sites, ["site"], "left")
    return a.withColumn("cluster_id", F.coalesce("title", "news_id"))


_HOST = r"nullif(regexp_replace(lower(regexp_extract(originallink, '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([^/?#:\s]+)', 1)), '^(?:(?:www|m)\.)+', ''), '')"
_E = f"""{_A}, s AS (SELECT pos, news_id, pub_ts, coalesce(is_agency, false) AS ag, coalesce(title, news_id) AS cid FROM a LEFT JOIN press_sites p ON p.site = {_HOST}),
 won AS (SELECT cid, news_id AS replaced_by FROM s QUALIFY row_number() OVER (PARTITION BY cid ORDER BY ag DESC, CASE WHEN ag THEN -epoch_us(pub_ts) ELSE epoch_us(pub_ts) END, pos) = 1)"""


@query("canonical_mark", f"WITH {_E} SELECT pos, news_id IN (SELECT replaced_by FROM won) AS is_canon, replaced_by FROM s JOIN won USING (cid)")
def canonical_mark(spark, d):
    return similarity.elect(_electable(spark, d)).select("pos", "is_canon", "replaced_by")


@query("canonical_election", f"WITH {_E} SELECT md5(cid) AS cluster_md5, replaced_by FROM won")
def canonical_election(spark, d):
    return similarity.elect(_electable(spark, d)).select(F.md5("cluster_id").alias("cluster_md5"), "replaced_by").distinct()


def _shingle_sql(column: str) -> str:
    return rf"""SELECT doc_id AS pos, unnest(list_transform(range(1, greatest(length(s) - 3, 1) + 1), lambda k: substr(s, k, 4))) AS g
 FROM (SELECT doc_id, regexp_replace(lower(coalesce({column}, '')), '[^\p{{L}}\p{{N}}_]', '', 'g') AS s FROM documents)"""


def _simhash_sql(name: str, column: str) -> str:
    return f"""{name} AS (SELECT pos, sum(CASE WHEN 2 * ones > n THEN 1::HUGEINT << b ELSE 0 END)::UBIGINT AS fp FROM (
  SELECT pos, b, count(*) AS n, sum((h >> b) & 1) AS ones FROM (SELECT pos, ('0x' || substr(md5(g), 17, 16))::UBIGINT AS h FROM ({_shingle_sql(column)})),
  (SELECT unnest(range(0, 64))::UBIGINT AS b) GROUP BY pos, b) GROUP BY pos)"""


@query("simhash_fp", f"WITH {_simhash_sql('f', 'title')} SELECT pos, lpad(lower(to_hex(fp)), 16, '0') AS fp FROM f")
def simhash_fp(spark, d):
    return similarity.simhash(table(spark, d, "documents"), "doc_id", "title", "fp").select("pos", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fp"))


_SD = f"""WITH RECURSIVE {_simhash_sql('t', 'title')}, {_simhash_sql('b', 'text')},
 f AS (SELECT pos, t.fp AS x, b.fp AS y FROM t JOIN b USING (pos)),
 e AS (SELECT p.pos AS i, q.pos AS j FROM f p JOIN f q ON p.pos < q.pos AND bit_count(xor(p.x, q.x)::BIT) <= 10 AND bit_count(xor(p.y, q.y)::BIT) <= 14),
 n AS (SELECT pos, row_number() OVER (ORDER BY pos) AS k, coalesce(nb, []) AS nb FROM f LEFT JOIN (SELECT j AS pos, list(i) AS nb FROM e GROUP BY j) USING (pos)),
 r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS heads UNION ALL SELECT n.k, CASE WHEN list_has_any(heads, nb) THEN heads ELSE list_append(heads, pos) END FROM r JOIN n ON n.k = r.k + 1),
 h AS (SELECT unnest(heads) AS head FROM r WHERE k = (SELECT max(k) FROM r))
 SELECT pos, CASE WHEN pos IN (SELECT head FROM h) THEN NULL ELSE 'simhash' END AS removed_by FROM f"""


@query("simhash_dedup", _SD)
def simhash_dedup(spark, d):
    docs = table(spark, d, "documents").withColumn("content", F.col("text"))
    return similarity.simhash_dedup(docs, "doc_id")


def _doc_articles(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    sites = table(spark, d, "press_sites").select(F.col("site").alias("source"), "is_agency")
    ids = docs.select(F.col("doc_id").alias("pos"), "title", F.col("text").alias("content"), "source", F.md5(F.col("doc_id").cast("string")).substr(1, 12).alias("news_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("pub_ts"))
    return sized_join(ids, sites, ["source"], "left")


def _cluster_sql(title: float, body: float) -> str:
    return f"""WITH RECURSIVE t AS ({_leader_sql("title", title)}), b AS ({_leader_sql("text", body)}),
 g AS (SELECT pos, t.leader AS title_id, b.leader AS body_id FROM t JOIN b USING (pos)),
 e AS (SELECT pos AS a, title_id AS b FROM g UNION SELECT title_id, pos FROM g UNION SELECT pos, body_id FROM g UNION SELECT body_id, pos FROM g),
 c(v, low) USING KEY (v) AS (SELECT pos, pos FROM g UNION SELECT e.b, min(c.low) FROM c JOIN e ON e.a = c.v JOIN recurring.c AS o ON o.v = e.b WHERE c.low < o.low GROUP BY e.b),
 s AS (SELECT g.*, low AS cluster_id, substr(md5(pos::VARCHAR), 1, 12) AS news_id, coalesce(is_agency, false) AS ag FROM g JOIN c ON v = pos JOIN documents ON doc_id = pos LEFT JOIN press_sites p ON p.site = source),
 won AS (SELECT cluster_id, news_id AS replaced_by FROM s QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY ag DESC, CASE WHEN ag THEN -pos ELSE pos END, pos) = 1),
 m AS (SELECT s.*, replaced_by, news_id = replaced_by AS is_canon FROM s JOIN won USING (cluster_id))
 """


@query(
    "keyword_cluster",
    _cluster_sql(0.18, 0.17).replace("lower(coalesce(title, ''))", f"lower({_NT})") + "SELECT pos, title_id, body_id, cluster_id, is_canon, replaced_by FROM m",
)
def keyword_cluster(spark, d):
    docs = _doc_articles(spark, d)
    bare = docs.withColumn("title", text.normalize_title(F.col("title")))
    return similarity.elect(docs.join(similarity.cluster_rows(bare, 0.18, 0.17), "pos")).select("pos", "title_id", "body_id", "cluster_id", "is_canon", "replaced_by")


@query("global_dedup", _cluster_sql(0.20, 0.19) + "SELECT pos, cluster_id, is_canon, CASE WHEN NOT is_canon THEN 'global_similarity' END AS removed_by FROM m")
def global_dedup(spark, d):
    return similarity.global_dedup(_doc_articles(spark, d)).select("pos", "cluster_id", "is_canon", "removed_by")


@query(
    "probe_candidates",
    _cluster_sql(0.20, 0.20) + "SELECT * FROM (SELECT pos, min(pos) OVER (PARTITION BY title_id, body_id) AS cluster_id, count(*) OVER (PARTITION BY title_id, body_id) AS n, "
    "CASE WHEN title_id <> pos AND body_id <> pos THEN 'title+body' WHEN title_id <> pos THEN 'title' WHEN body_id <> pos THEN 'body' END AS via FROM g) WHERE n > 1",
)
def probe_candidates(spark, d):
    merged = similarity.cluster_rows(_doc_articles(spark, d), 0.20, 0.20, "and")
    big = merged.groupBy("cluster_id").agg(F.count("*").alias("n")).where("n > 1")
    via = F.when((F.col("title_id") != F.col("pos")) & (F.col("body_id") != F.col("pos")), "title+body").when(F.col("title_id") != F.col("pos"), "title").when(F.col("body_id") != F.col("pos"), "body")
    return merged.join(big, "cluster_id").select("pos", "cluster_id", "n", via.alias("via"))


@query(
    "probe_edges",
    _cluster_sql(0.20, 0.20) + "SELECT substr(md5(a::VARCHAR), 1, 12) AS src, substr(md5(b::VARCHAR), 1, 12) AS dst, via FROM (SELECT pos AS a, lead(pos) OVER (PARTITION BY title_id ORDER BY pos) AS b, 'title' AS via FROM g "
    "UNION ALL SELECT pos, lead(pos) OVER (PARTITION BY body_id ORDER BY pos), 'body' FROM g) WHERE b IS NOT NULL",
)
def probe_edges(spark, d):
    return similarity.probe(_doc_articles(spark, d), 0.20, 0.20, "or")[1]


@query(
    "normal_keyword_cluster",
    _cluster_sql(0.18, 0.17).replace("lower(coalesce(title, ''))", f"lower({_NT})")
    + "SELECT pos, 'C-' || cluster_id AS cluster_id, 'T-' || title_id AS title_id, 'B-' || body_id AS body_id, is_canon FROM m",
)
def normal_keyword_cluster(spark, d):
    return similarity.keyword_cluster(_doc_articles(spark, d))[0].select("pos", "cluster_id", "title_id", "body_id", "is_canon")


@query("group_numbers", f"WITH {_G} SELECT pos, dense_rank() OVER (ORDER BY title_id) - 1 AS group_id FROM g")
def group_numbers(spark, d):
    return similarity.group_numbers(_groups(spark, d), "title_id")


@query("similar_group_count", f"WITH {_G} SELECT count(*) AS n_rows, count(DISTINCT body_id) AS n_groups, count(*) - count(DISTINCT body_id) AS n_similar FROM g")
def similar_group_count(spark, d):
    return similarity.group_counts(_groups(spark, d), "body_id")


@query("repeated_ids", f"WITH {_G} SELECT body_id, count(news_id) AS n_rows, count(DISTINCT news_id) AS n_ids FROM g JOIN raw_articles ON row_id = pos GROUP BY body_id HAVING count(news_id) > count(DISTINCT news_id)")
def repeated_ids(spark, d):
    return similarity.repeated_ids(_groups(spark, d).join(articles(spark, d).select("pos", "news_id"), "pos"), "body_id")


@query("consecutive_pairs", f"WITH {_G} SELECT pos AS a, b, 'body' AS via FROM (SELECT pos, lead(pos) OVER (PARTITION BY body_id ORDER BY pos) AS b FROM g) WHERE b IS NOT NULL")
def consecutive_pairs(spark, d):
    return similarity.consecutive_pairs(_groups(spark, d), ["body_id"], "body")


@query("arrival_order", "SELECT row_id AS pos, lag(row_id) OVER (ORDER BY collected_at ASC NULLS LAST, row_id) AS before FROM raw_articles WHERE search_keyword = (SELECT min(keyword) FROM keyword_config)")
def arrival_order(spark, d):
    """Order before SimHash within one keyword's rows, shown by each row's predecessor."""
    first = table(spark, d, "keyword_config").agg(F.min("keyword").alias("search_keyword"))
    a = articles(spark, d).join(F.broadcast(first), "search_keyword", "left_semi")
    return a.select("pos", F.lag("pos").over(Window.partitionBy("search_keyword").orderBy(*similarity.arrival(a))).alias("before"))


# ---- small text and row functions


@query("strip_bold", f"SELECT row_id AS pos, {_TRIM.format("regexp_replace(title, '</?b>', '', 'g')")} AS title FROM raw_articles")
def strip_bold(spark, d):
    return articles(spark, d).select("pos", text.strip_bold(F.col("title")).alias("title"))


@query("url_quote", "SELECT row_id AS pos, url_encode(title) AS quoted, 'https://n.example/s/' || search_keyword || '/' || row_id AS url FROM raw_articles")
def url_quote(spark, d):
    return articles(spark, d).select("pos", text.url_quote(F.col("title")).alias("quoted"), text.build_url("https://n.example/s", "/", F.col("search_keyword"), F.col("pos")).alias("url"))


@query("passages", "SELECT row_id AS pos, md5('passage: ' || coalesce(title, '') || ' ' || coalesce(content, '')) AS passage_md5, 'query: ' || coalesce(title, '') AS query FROM raw_articles")
def passages(spark, d):
    return articles(spark, d).select("pos", F.md5(text.passage(F.col("title"), F.col("content"))).alias("passage_md5"), text.search_query(F.col("title")).alias("query"))


@query("stamps", f"WITH {_A} SELECT pos, strftime(pub_ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(pub_ts, '%Y-%m-%d %H:%M:%S') || '+0000' AS zoned FROM a")
def stamps(spark, d):
    a = articles(spark, d)
    return a.select("pos", text.stamp(F.col("pub_ts")).alias("stamp"), text.zoned_stamp(F.col("pub_ts")).alias("zoned"))


@query("polite_rows", "SELECT row_id AS pos FROM raw_articles WHERE coalesce(regexp_matches(content, '입니다|습니다'), false)")
def polite_rows(spark, d):
    return articles(spark, d).where(text.polite_style(F.col("content"))).select("pos")


@query("agency_rows", "SELECT row_id AS pos, coalesce(contains(originallink, 'newsis.com') OR contains(originallink, 'yna.co.kr') OR contains(originallink, 'news1.kr') OR contains(originallink, 'ilbo.example'), false) AS is_agency FROM raw_articles")
def agency_rows(spark, d):
    return articles(spark, d).select("pos", rows.is_agency(F.col("originallink"), [*AGENCIES, "ilbo.example"]).alias("is_agency"))


@query("summary_copy", "SELECT news_id, pubdate, title, description FROM raw_articles")
def summary_copy(spark, d):
    return archives.summary(table(spark, d, "raw_articles"))


@query("with_defaults", "SELECT row_id, '' AS body, 0 AS version FROM raw_articles")
def with_defaults(spark, d):
    return rows.with_defaults(table(spark, d, "raw_articles"), {"body": "", "version": 0, "title": "x"}).select("row_id", "body", "version")


_PAGE = r"regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g')"


@query("html_extract", f"SELECT doc_id, CASE WHEN {_PAGE} IS NULL THEN '' ELSE trim({_PAGE}) END AS content FROM documents")
def html_extract(spark, d):
    """Article bodies out of pages with scripts, advertisements and menus around each text's words."""
    words = F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")
    page = F.concat(F.lit("<html><body><ul><li>menu</ul><article id='dic_area'><script>var x = '<b>';</script>"), words, F.lit("<span>ad</span><em>more</em></article><article>other</article></body></html>"))
    return pages.html_extract(table(spark, d, "documents").select("doc_id", page.alias("html"))).select("doc_id", "content")


# ---- windows of time and runs


@query("recent_window", "SELECT event_id FROM events WHERE ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 12 HOUR AND (SELECT max(ts) FROM events)")
def recent_window(spark, d):
    return rows.recent(table(spark, d, "events"), "ts").select("event_id")


@query(
    "due_check",
    "WITH n AS (SELECT max(ts) AS now FROM events), k AS (SELECT user_id, epoch_us((SELECT now FROM n)) - epoch_us(max(ts) FILTER (WHERE event_type = 'purchase')) AS us FROM events GROUP BY user_id) "
    "SELECT user_id::VARCHAR AS keyword, round(us / 3.6e9, 6) AS elapsed_hours FROM k WHERE coalesce(us / 3.6e9 >= 24, true)",
)
def due_check(spark, d):
    """Users as keys; the state has those that ever purchased, so that keys that never ran take part."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    keys = e.select(F.col("user_id").cast("string").alias("keyword")).distinct()
    state = e.where("event_type = 'purchase'").groupBy(F.col("user_id").cast("string").alias("keyword")).agg(F.max("ts").alias("last_executed"))
    now = e.agg(F.max("ts").alias("now"))
    return rows.due(keys, state.crossJoin(F.broadcast(now)), F.col("now"), 24.0).select("keyword", F.round("elapsed_hours", 6).alias("elapsed_hours"))


@query(
    "run_log_totals",
    """WITH l AS (SELECT date_trunc('day', ts) AS t, event_type AS keyword, count(*) AS r, count(*) FILTER (WHERE value > 20) AS f FROM events GROUP BY ALL)
 SELECT strftime(t, '%Y-%m-%d') AS day, keyword, r AS new_raw, f AS final_added, round_even(CASE WHEN r > 0 THEN f / r ELSE 0 END, 3) AS e_ratio,
 sum(r) OVER (ORDER BY t, keyword)::BIGINT AS tot_new_raw, sum(f) OVER (ORDER BY t, keyword)::BIGINT AS tot_final_added FROM l""",
)
def run_log_totals(spark, d):
    e = table(spark, d, "events")
    log = e.groupBy(F.date_trunc("day", "ts").alias("execute_at"), F.col("event_type").alias("keyword")).agg(F.count("*").cast("string").alias("new_raw"), F.count_if(F.col("value") > 20).cast("string").alias("final_added")).withColumn("seq", F.col("keyword"))
    out = rows.run_totals(log)
    return out.select(F.date_format("execute_at", "yyyy-MM-dd").alias("day"), "keyword", "new_raw", "final_added", "e_ratio", "tot_new_raw", "tot_final_added")


# ---- vectors

_COS = "round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9)"


@query("vector_topk", f"SELECT query_id, rank, vec_id, sim FROM (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, {_COS} AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id)::INT AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0) WHERE rank <= 5")
def vector_topk(spark, d):
    e = table(spark, d, "embeddings")
    return vectors.topk(e, e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"))


_CENT = "c AS (SELECT label, k, avg(x) AS mean FROM (SELECT label, unnest(range(1, 65)) AS k, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL)"


@query("centroids", f"WITH {_CENT} SELECT label, k, round(mean, 6) AS mean FROM c")
def centroids(spark, d):
    c = vectors.centroids(table(spark, d, "embeddings"))
    return c.select("label", F.posexplode("centroid").alias("k", "mean")).select("label", (F.col("k") + 1).cast("bigint").alias("k"), F.round("mean", 6).alias("mean"))


@query("representatives", f"WITH {_CENT}, l AS (SELECT label, list(mean ORDER BY k) AS m FROM c GROUP BY label), s AS (SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], m), 9) AS sim FROM embeddings JOIN l USING (label)) SELECT label, vec_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id)::INT AS rank FROM s) WHERE rank <= 5")
def representatives(spark, d):
    return vectors.representatives(table(spark, d, "embeddings")).select("label", "vec_id", "rank")


@query(
    "silhouette",
    "WITH p AS (SELECT a.vec_id AS i, a.label AS l, b.label AS o, count(*) AS n, sum(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY ALL), "
    "q AS (SELECT i, max(s / n) FILTER (WHERE o = l) AS a, min(s / n) FILTER (WHERE o <> l) AS b FROM p GROUP BY i) SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM q",
)
def silhouette(spark, d):
    return vectors.silhouette(table(spark, d, "embeddings"))


@query("cluster_quality", "WITH e AS (SELECT CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS label FROM embeddings) SELECT count(DISTINCT label) FILTER (WHERE label <> -1) AS n_clusters, count(*) FILTER (WHERE label = -1) AS n_noise, count(*) AS n_rows, round_even(count(*) FILTER (WHERE label = -1) * 100.0 / count(*), 2) AS noise_pct FROM e")
def cluster_quality(spark, d):
    return vectors.cluster_quality(table(spark, d, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label"))))


@query("hdbscan_labels")
def hdbscan_labels(spark, d):
    return vectors.density_clusters(table(spark, d, "embeddings"))


@query("issue_board")
def issue_board(spark, d):
    items = table(spark, d, "embeddings").withColumn("title", F.concat(F.lit("item "), "vec_id"))
    return vectors.issue_board(items, vectors.density_clusters(items))


@query(
    "issue_meta_given_labels",
    f"WITH {_CENT}, l AS (SELECT label, list(mean ORDER BY k) AS m FROM c GROUP BY label), s AS (SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], m), 9) AS sim FROM embeddings JOIN l USING (label) WHERE label <> 0), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS rank, count(*) OVER (PARTITION BY label)::INT AS n FROM s) "
    "SELECT label AS issue_cluster_id, 'issue_' || label AS issue_label, n AS cluster_size, string_agg('item ' || vec_id, '|' ORDER BY rank) AS titles FROM r WHERE rank <= 5 GROUP BY label, n",
)
def issue_meta_given_labels(spark, d):
    """Issue rows of labelled vectors; label 0 plays the noise."""
    e = table(spark, d, "embeddings").withColumn("title", F.concat(F.lit("item "), "vec_id"))
    labels = e.select("vec_id", F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("cluster_id"))
    return vectors.issue_board(e, labels).select("issue_cluster_id", "issue_label", "cluster_size", F.array_join("representative_titles", "|").alias("titles"))


@query("label_dispatch", "SELECT issue_cluster_id, CASE WHEN len(coalesce(representative_titles, [])) = 0 THEN 'issue_' || issue_cluster_id ELSE CASE WHEN length(representative_titles[1]) BETWEEN 3 AND 30 AND representative_titles[1] IS NOT NULL THEN representative_titles[1] ELSE 'issue_' || issue_cluster_id END END AS issue_label FROM issue_meta")
def label_dispatch(spark, d):
    """Labels by a provider that answers with the prompt's first title."""
    first = lambda ask: next((x[2:] for x in ask.split("\n") if x.startswith("- ")), "")
    return providers.label_issues(table(spark, d, "issue_meta"), {"first": first}, "first", TEMPLATE).select("issue_cluster_id", "issue_label")


@query("unit_embeddings", "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings) SELECT vec_id, round(list_sum(list_transform(e, lambda x: x / n)), 4) AS total FROM v")
def unit_embeddings(spark, d):
    """Vectors of a provider that reads them from text, normalised by the batch operator."""
    e = table(spark, d, "embeddings").select("vec_id", F.array_join("embedding", " ").alias("t"))
    out = providers.embed(e, "vec_id", F.col("t"), lambda texts: np.array([[float(x) * 3 for x in t.split()] for t in texts]))
    return out.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


# ---- labels and prompts


@query("visible_issues", "SELECT issue_cluster_id, CASE WHEN length(trim(issue_label)) BETWEEN 3 AND 30 THEN trim(issue_label) ELSE 'issue_' || issue_cluster_id END AS issue_label, cluster_size, array_to_string(coalesce(representative_titles, [])[1:3], '|') AS titles FROM issue_meta WHERE coalesce(issue_label <> '[불가]', true)")
def visible_issues(spark, d):
    return vectors.visible_issues(table(spark, d, "issue_meta")).select("issue_cluster_id", "issue_label", "cluster_size", F.array_join("representative_titles", "|").alias("titles"))


@query("prompt_build", "SELECT issue_cluster_id, replace('제목 목록:' || chr(10) || '{titles}' || chr(10) || '공통 이슈를 한 줄로.', '{titles}', array_to_string(list_transform(representative_titles, lambda t: '- ' || t), chr(10))) AS prompt FROM issue_meta")
def prompt_build(spark, d):
    return table(spark, d, "issue_meta").select("issue_cluster_id", text.prompt(TEMPLATE, F.col("representative_titles")).alias("prompt"))


@query("label_guard", f"SELECT issue_cluster_id, CASE WHEN length({_TRIM.format('issue_label')}) BETWEEN 3 AND 30 THEN {_TRIM.format('issue_label')} ELSE '' END AS label FROM issue_meta")
def label_guard(spark, d):
    return table(spark, d, "issue_meta").select("issue_cluster_id", text.guarded_label(F.col("issue_label")).alias("label"))


# ---- streams


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    path = os.path.join(d, "events.parquet")
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 8)
    stream = reader.parquet(path) if archives.is_folder(spark, path) else reader.option("pathGlobFilter", "events.parquet").parquet(d)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_dedup", "SELECT DISTINCT user_id FROM events")
def stream_dedup(spark, d):
    return streams.run_to_table(streams.dedup_stream(_event_stream(spark, d), "user_id", "ts", "3650 days")).select("user_id")


@query("stream_window", "SELECT strftime(w, '%Y-%m-%d %H:%M') AS win_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, unnest(list_transform(range(0, 12), lambda k: date_trunc('hour', ts) - to_hours(k::BIGINT))) AS w FROM events) GROUP BY ALL")
def stream_window(spark, d):
    out = streams.run_to_table(streams.windowed_counts(_event_stream(spark, d), "ts", "event_type"), "complete")
    return out.select(F.date_format("win_start", "yyyy-MM-dd HH:mm").alias("win_start"), "event_type", "n", "total")
