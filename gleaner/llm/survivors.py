"""Best representative of each duplicate group, field by field.

``found_sources`` and ``survivors`` take, per field, the version collected last
whose field is usable. ``judged_values`` is the latent two-sided quality model:
expectation-maximisation over which channels claim which values gives every
channel a sensitivity and a specificity and every value a probability of being
true, so that a field may keep several values; ``survivors`` keeps those of its
multi-valued fields.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.instants import with_article_instants
from gleaner.functions.sites import host_of
from gleaner.llm.residue import with_residue
from gleaner.session import blank_to_null, discard, materialize, sized_join

FIELDS = ("title", "description", "content", "pubdate")
#: Fields that keep every value judged true.
MULTIPLE = ("title", "description")
#: Change of sensitivity or specificity below which expectation-maximisation has converged.
MOVED = 1e-3


def usable_fields(articles: DataFrame, press_sites: DataFrame) -> DataFrame:
    """``row_id, news_id, col_ms`` and one flag ``ok_<field>`` per field.

    Usable: not NULL or blank; title and content without residue; pubdate an instant.
    """
    narrow = articles.select("row_id", "news_id", "originallink", "collected_at", *FIELDS)
    rows = with_residue(with_article_instants(narrow, press_sites))
    filled = lambda c: blank_to_null(F.col(c)).isNotNull()
    return rows.select(
        "row_id", "news_id", "col_ms",
        (filled("title") & ~F.col("residue.title")).alias("ok_title"),
        filled("description").alias("ok_description"),
        (filled("content") & ~F.col("residue.content")).alias("ok_content"),
        F.col("pub_ms").isNotNull().alias("ok_pubdate"),
    )


def _last(ok: Column) -> Column:
    """Row of the latest instant (none sorts first), at ties the smallest ``row_id``."""
    best = F.max(F.when(ok, F.struct(F.coalesce("col_ms", F.lit(-(1 << 62))).alias("t"), (-F.col("row_id")).alias("r"))))
    return -best["r"]


def found_sources(articles: DataFrame, press_sites: DataFrame) -> DataFrame:
    """``news_id, field_name, row_id``: for groups of two or more rows, the row that supplies each field.

    Ranking is one partial aggregate per group, so a group that holds a third of
    all rows is reduced before any shuffle. A field without usable value gives no
    row. Rows without ``news_id`` belong to no group. Rows whose ``collected_at``
    is no instant come last; exact copies yield to the smallest ``row_id``.
    """
    rows = usable_fields(articles, press_sites).where("news_id is not null")
    picks = rows.groupBy("news_id").agg(F.count("*").alias("n"), *[_last(F.col(f"ok_{f}")).alias(f) for f in FIELDS]).where("n >= 2")
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("row_id")) for f in FIELDS])
    return picks.select("news_id", F.explode(each).alias("x")).select("news_id", "x.field_name", "x.row_id").where("row_id is not null")


def survivors(articles: DataFrame, press_sites: DataFrame) -> DataFrame:
    """One built record per ``news_id`` of two or more rows: each field's best value and where it is from.

    Fields of ``MULTIPLE`` also keep, as ``<field>_values``, every value that the quality model
    judges true, in order; a list is bounded by the claims of its article that differ.
    """
    sources = found_sources(articles, press_sites)
    values = articles.select("row_id", *[F.col(f).cast("string") for f in FIELDS])
    joined = sources.join(values, "row_id")
    agg = []
    for f in FIELDS:
        mine = F.col("field_name") == f
        agg += [F.max(F.when(mine, F.col(f))).alias(f), F.max(F.when(mine, F.col("row_id"))).alias(f"{f}_row_id")]
    judged = judged_fields(articles, MULTIPLE).where("is_true")
    lists = judged.groupBy("news_id").agg(*[F.sort_array(F.collect_set(F.when(F.col("field_name") == f, F.col("value")))).alias(f"{f}_values") for f in MULTIPLE])
    empty = F.array().cast("array<string>")
    out = joined.groupBy("news_id").agg(*agg).join(lists, "news_id", "left")
    return out.select(*[c for c in out.columns if not c.endswith("_values")], *[F.coalesce(f"{f}_values", empty).alias(f"{f}_values") for f in MULTIPLE])


def _odds(quality: DataFrame) -> DataFrame:
    """``src, no, more``: log odds that a denial gives a value, and what a claim gives on top of it."""
    no = F.log((1 - F.col("sensitivity")) / F.col("specificity"))
    return quality.select("src", no.alias("no"), (F.log(F.col("sensitivity") / (1 - F.col("specificity"))) - no).alias("more"))


def judged_values(articles: DataFrame, fields: tuple[str, ...] = FIELDS, prior: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """``news_id, field_name, value, n_claims, p_true`` of every claimed value, and ``src, sensitivity, specificity``.

    A source is a field of a collection channel: press site and search keyword. If it
    has a value of an article's field, it claims what it shows and denies what others
    show. Expectation gives each value the log odds of all who claim or deny it;
    maximisation counts, with Beta(8, 2) smoothing, how often a source claims what is
    held true (sensitivity) and denies what is held false (specificity). Denials are
    never written out: they are an article's sum over its sources, less the claims. Rounds
    go on until no quality moves by ``MOVED``. Neither sources nor claims go to the
    driver. NULL and blank values are no claims; rows without ``news_id`` have none.
    """
    site = F.coalesce(host_of(F.col("originallink")), F.lit(""))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), blank_to_null(F.col(f)).alias("value")) for f in fields]))
    rows = articles.where("news_id is not null").select("news_id", F.concat_ws("|", site, F.coalesce("search_keyword", F.lit(""))).alias("channel"), each.alias("x"))
    rows = rows.where("x.value is not null").select("news_id", F.col("x.f").alias("f"), "x.value", F.concat_ws("|", "x.f", "channel").alias("src"))
    keyed = rows.select(F.xxhash64("news_id", "f").alias("a"), F.xxhash64(F.lit(1), "news_id", "value").alias("b"), F.xxhash64("src").alias("src"), "news_id", "f", "value")
    facts = materialize(keyed.groupBy("a", "b").agg(F.min(F.struct("news_id", "f", "value")).alias("x")).select("a", "b", "x.*"), "facts")
    claims = materialize(keyed.select("a", "b", "src").distinct(), "claims")
    active = materialize(claims.select("a", "src").distinct(), "active")
    quality = materialize(active.select("src").distinct().select("src", F.lit(0.8).cast("double").alias("sensitivity"), F.lit(0.8).cast("double").alias("specificity")), "quality")
    votes = None
    while True:
        odds = materialize(_odds(quality), "odds")
        denied = sized_join(active, odds, ["src"]).groupBy("a").agg(F.sum("no").alias("d"))
        claimed = sized_join(claims, odds, ["src"]).groupBy("a", "b").agg(F.sum("more").alias("s"), F.count("*").alias("n_claims"))
        score = F.col("s") + F.col("d") + math.log(prior / (1 - prior))
        before, votes = votes, materialize(claimed.join(denied, "a").select("a", "b", "n_claims", (1 / (1 + F.exp(-score))).alias("p")), "votes")
        sums = votes.groupBy("a").agg(F.sum("p").alias("t"), F.sum(1 - F.col("p")).alias("f"))
        held = claims.join(votes, ["a", "b"]).groupBy("src").agg(F.sum("p").alias("tp"), F.sum(1 - F.col("p")).alias("fp"))
        faced = active.join(sums, "a").groupBy("src").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
        new = held.join(faced, "src").select("src", ((F.col("tp") + 8) / (F.col("t") + 10)).alias("sensitivity"), ((F.col("f") - F.col("fp") + 8) / (F.col("f") + 10)).alias("specificity"))
        # the two tables of a round are one value a source; their difference is one number
        new = materialize(new, "quality")
        apart = new.join(quality.withColumnsRenamed({"sensitivity": "s0", "specificity": "p0"}), "src")
        moved = apart.agg(F.max(F.greatest(F.abs(F.col("sensitivity") - F.col("s0")), F.abs(F.col("specificity") - F.col("p0"))))).first()[0] or 0.0
        discard(quality, odds, before)
        quality = new
        if moved < MOVED:
            break
    names = rows.select("src").distinct().withColumn("name", F.col("src")).withColumn("src", F.xxhash64("src"))
    judged = facts.join(votes, ["a", "b"]).select("news_id", F.col("f").alias("field_name"), "value", "n_claims", F.col("p").alias("p_true"))
    return judged, quality.join(names, "src").select(F.col("name").alias("src"), "sensitivity", "specificity")


def judged_fields(articles: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``news_id, field_name, value, n_claims, p_true, is_true`` of every claimed value; a field may keep several values."""
    judged, _ = judged_values(articles, fields)
    return judged.withColumn("p_true", F.round("p_true", 4)).withColumn("is_true", F.col("p_true") >= 0.5)
