"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.llm import bpe, clusters, components, history, leakage, residue, sentences, site_lines, survivors
from gleaner.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("p1_found")
def p1_found(spark, d):
    return site_lines.found_lines(table(spark, d, "raw_articles"))


@query("p1_cleaned")
def p1_cleaned(spark, d):
    raw = table(spark, d, "raw_articles")
    return site_lines.without_lines(raw, site_lines.found_lines(raw)).select("row_id", "content", "n_removed")


@query("p1_templates")
def p1_templates(spark, d):
    return site_lines.line_templates(table(spark, d, "raw_articles"))


_ID = r"lower(regexp_replace({}, '^[\s\x{{00a0}}\x{{3000}}]+|[\s\x{{00a0}}\x{{3000}}]+$', '', 'g'))"
_P6 = f"""
WITH RECURSIVE ends AS (SELECT nullif({_ID.format("src")}, '') AS a, nullif({_ID.format("dst")}, '') AS b FROM match_pairs),
e AS (SELECT a, b FROM ends WHERE a <> b UNION SELECT b, a FROM ends WHERE a <> b),
c AS (SELECT a AS v, a AS u FROM e UNION SELECT c.v, e.b FROM c JOIN e ON c.u = e.a)
SELECT v AS news_id, min(u) AS group_id FROM c GROUP BY v
"""


@query("p6_found", _P6)
def p6_found(spark, d):
    return components.group_pairs(table(spark, d, "match_pairs"))


@query("p8_ids")
def p8_ids(spark, d):
    return bpe.encode(table(spark, d, "documents"))


@query("p4_found")
def p4_found(spark, d):
    return residue.found_residue(table(spark, d, "raw_articles"))


@query("p4_kept")
def p4_kept(spark, d):
    marked = residue.with_residue(table(spark, d, "raw_articles").select("row_id", "news_id", "title", "content"))
    return marked.where("not (residue.title or residue.content)").select("row_id", "news_id")


@query("p5_found")
def p5_found(spark, d):
    return survivors.found_sources(table(spark, d, "raw_articles"), table(spark, d, "press_sites"))


_P2 = """
WITH v AS (SELECT item_id, embedding::DOUBLE[] AS e FROM issue_items WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.item_id AS i, b.item_id AS j FROM v a JOIN v b ON list_cosine_similarity(a.e, b.e) >= 0.88)
SELECT i AS item_id, min(j) AS issue_cluster_id FROM p GROUP BY i HAVING count(*) > 1
"""


@query("p2_found", _P2)
def p2_found(spark, d):
    return clusters.found_clusters(table(spark, d, "issue_items"))


_P2_ISSUES = """
WITH v AS (SELECT item_id, list_transform(e, lambda x: (x / n)::FLOAT::DOUBLE) AS e FROM (SELECT item_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n
  FROM issue_items WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0) WHERE n > 0),
p AS (SELECT a.item_id AS i, min(b.item_id) AS c, count(*) AS n, round(sum(list_inner_product(a.e, b.e)), 9) AS s FROM v a JOIN v b ON list_inner_product(a.e, b.e) >= 0.88 GROUP BY a.item_id HAVING count(*) > 1),
m AS (SELECT c, n, i AS medoid FROM p QUALIFY row_number() OVER (PARTITION BY c ORDER BY s DESC, i) = 1),
t AS (SELECT p.c, title, max(round(list_inner_product(a.e, b.e), 9)) AS s, min(p.i) AS f FROM p JOIN m USING (c) JOIN v a ON a.item_id = p.i JOIN v b ON b.item_id = m.medoid
  JOIN (SELECT item_id, min(title) AS title FROM issue_items WHERE title IS NOT NULL GROUP BY item_id) x ON x.item_id = p.i GROUP BY ALL),
r AS (SELECT c, title, row_number() OVER (PARTITION BY c ORDER BY s DESC, f) AS k FROM t QUALIFY k <= 5)
SELECT m.c AS issue_cluster_id, m.n AS cluster_size, m.medoid AS medoid_item_id, coalesce(string_agg(title, '|' ORDER BY k), '') AS titles FROM m LEFT JOIN r ON r.c = m.c GROUP BY ALL
"""


@query("p2_issues")
def p2_issues(spark, d):
    return clusters.issue_rows(table(spark, d, "issue_items"))


@query("p2_issue_titles", _P2_ISSUES)
def p2_issue_titles(spark, d):
    """The issue rows with their titles in one text, for the comparison with SQL."""
    rows = clusters.issue_rows(table(spark, d, "issue_items"))
    return rows.select("issue_cluster_id", "cluster_size", "medoid_item_id", F.array_join("representative_titles", "|").alias("titles"))


@query("p9_found")
def p9_found(spark, d):
    return leakage.found_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


@query("p9_items")
def p9_items(spark, d):
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


@query("p10_found")
def p10_found(spark, d):
    return sentences.boundaries(table(spark, d, "documents"))


@query("p7_found")
def p7_found(spark, d):
    return history.found_repeats(table(spark, d, "raw_articles"), table(spark, d, "incoming_articles"))


@query("p5_survivors")
def p5_survivors(spark, d):
    return survivors.survivors(table(spark, d, "raw_articles"), table(spark, d, "press_sites"))


@query("p5_values")
def p5_values(spark, d):
    return survivors.judged_fields(table(spark, d, "raw_articles"))


@query("p10_sentences")
def p10_sentences(spark, d):
    return sentences.sentences(table(spark, d, "documents"))
