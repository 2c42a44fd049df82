"""Consolidating pairwise matches into groups: hash-to-min over relational cluster sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import counted, discard, materialize

#: Rounds after which groups that can't change any more leave.
LEAVE_EVERY = 3


def clean_id(c):
    """Identifier in lower case without white space around; NULL if nothing is left."""
    bare = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(F.length(bare) > 0, bare)


def _minima(sets: DataFrame) -> DataFrame:
    return sets.groupBy("v").agg(F.min("u").alias("m"))


def _leave(sets: DataFrame) -> tuple[DataFrame, dict, DataFrame]:
    """The sets that may still change, their count, and ``v, m`` of the groups that can't.

    A group can't change if all of its vertices have one smallest member and no set
    holds a vertex of it together with one of another smallest member.
    """
    minima = materialize(_minima(sets), "minima")
    ends = sets.join(minima.hint("merge"), "v").join(minima.select(F.col("v").alias("u"), F.col("m").alias("mu")).hint("merge"), "u")
    ends = materialize(ends.select("v", "u", "m", "mu"), "ends")
    moving = materialize(ends.where("m <> mu").select(F.explode(F.array("m", "mu")).alias("m")).distinct(), "moving")
    active, seen = counted(ends.join(moving.hint("merge"), "m", "left_semi").select("v", "u"), "sets")
    settled = materialize(minima.join(moving.hint("merge"), "m", "left_anti").select("v", "m"), "settled")
    discard(minima, ends, moving)
    return active, seen, settled


def group_pairs(pairs: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``news_id, group_id``: every linked id with the smallest id of its group.

    Hash-to-min: each vertex v holds a cluster set C(v), kept as rows (v, u).
    In a round v sends C(v) to its smallest member and that member to all others;
    rounds go on until every set is stable. Sets are rows, never arrays, so the set of
    the smallest vertex of a huge group is spread over tasks: minima come from partial
    aggregation, and its join is split by the adaptive skew join. Every few rounds the
    groups that are stable leave, so that long chains alone go on. Nothing goes to the
    driver but counts; a round's table is deleted when the next one stands.

    Ids are compared in lower case and trimmed. Rows with a NULL or blank end,
    and pairs of an id with itself, link nothing. Repeated and reversed pairs
    change nothing. An empty table gives no rows. Other columns are ignored.
    """
    ends = pairs.select(clean_id(F.col(src)).alias("v"), clean_id(F.col(dst)).alias("u"))
    ends = ends.where("v is not null and u is not null and v <> u")
    ends = ends.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct()
    arrows = F.array(F.struct("v", "u"), F.struct(F.col("u").alias("v"), F.col("v").alias("u")), F.struct("v", F.col("v").alias("u")), F.struct(F.col("u").alias("v"), "u"))
    sets, seen = counted(ends.select(F.explode(arrows).alias("x")).select("x.v", "x.u").distinct(), "sets")
    done, turn = [], 0
    while seen["n"]:
        joined = sets.join(_minima(sets).hint("merge"), "v")
        sent = F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))
        before, sets = sets, materialize(joined.select(F.explode(sent).alias("x")).select("x.v", "x.u").distinct(), "sets")
        discard(before)
        turn += 1
        if turn % LEAVE_EVERY == 0:
            before = sets
            sets, seen, settled = _leave(sets)
            done.append(settled)
            discard(before)
    out = reduce(DataFrame.unionByName, done) if done else sets.select("v", F.col("u").alias("m"))
    return out.select(F.col("v").alias("news_id"), F.col("m").alias("group_id"))
