"""Deduplicating new batches against all history: a persisted prefix-tree hash forest.

Every text has one minhash signature per tree, packed into a 64-bit key whose
prefixes are the tree's levels. A run of the forest is a written table of such keys,
sorted within each tree by range; the index is a folder of runs and a manifest.
A batch is signed once, looked up in the stored runs by key range, at full depth
first, then with prefixes widened level by level until the recall target holds, and
appended as a run of its own; runs are merged when there are many. History is
signed once, when its run is built; later only its keys are read, and the words of
candidates, which the longest common subsequence verifies.
"""

from __future__ import annotations

import html
import math
import re
import uuid
from collections import Counter
from collections.abc import Collection, Container, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.sites import host_of, link_key
from gleaner.llm.site_lines import article_lines, line_hash, normal_lines, repeated_lines
from gleaner.session import BROADCAST_BYTES, counted, discard, hadoop_path, materialize, shared_dir, table_bytes
from gleaner.sources import archives

#: Least share of each text's words that stand in the other in the same order.
SHARE = 0.9
TREES, DEPTH = 24, 8
RECALL = 0.9995
#: Bits of the sketch of a text, and how many may differ in a pair: at the bound 11.6 do on average, more than 27 in
#: 1 of 100,000 pairs.
SKETCH, DIFFER = 128, 27
#: Runs from which an append merges them.
MANY_RUNS = 16
#: Rows that consecutive batches are taken together for in one arrival; a larger batch is an arrival of its own.
ARRIVAL_ROWS = 50_000
#: Blocks of a batch's keys that are broadcast one by one.
MANY_BLOCKS = 64
#: Bytes of a row of keys in memory.
KEY_BYTES = 80
_MARKS = re.compile(r"[\W_]+")
KEYS = "tree int, key bigint, ord bigint, n int, s1 bigint, s2 bigint, run int"
TEXTS = "ord bigint, l1 bigint, l2 bigint, h1 bigint, h2 bigint, n int, words array<int>, keys array<bigint>, s1 bigint, s2 bigint"


def least_jaccard(share: float = SHARE) -> float:
    """Jaccard index of word multisets that two such texts have at least."""
    return share / (2 - share)


def widest_depth(recall: float = RECALL, trees: int = TREES, share: float = SHARE) -> int:
    """Longest prefix at which a pair at the bound still meets in some tree as often as ``recall``."""
    s = least_jaccard(share)
    return next(d for d in range(DEPTH, 0, -1) if 1 - (1 - s**d) ** trees >= recall or d == 1)


def _tokens(content: str | None, gone: Collection[int] = (), known: Container[tuple] = (), site: str = "") -> list[str]:
    """Tokens between white space: entities resolved, NFKC, lower case.

    Lines numbered in ``gone``, or whose ``(site, hash, hash)`` is ``known``, are left aside.
    """
    if not content:
        return []
    lines = normal_lines(content)
    if gone:
        lines = [x for k, x in enumerate(lines, 1) if k not in gone]
    if known:
        lines = [x for x in lines if (site, *line_hash(x)) not in known]
    text = " ".join(lines)
    if "&" in text:
        text = " ".join(normal_lines(html.unescape(text)))
    return text.split()


def text_words(content: str | None) -> list[str]:
    """Words of a text: its tokens' letters and digits."""
    return [w for t in _tokens(content) if (w := _MARKS.sub("", t))]


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of positions at a time."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        if u := v & where.get(y, 0):
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def nearly_same(a: list[int], b: list[int], share: float = SHARE) -> bool:
    """At least ``share`` of the words of each stand in both in the same order."""
    need = math.ceil(share * max(len(a), len(b)) - 1e-9)
    if min(len(a), len(b)) < need or sum((Counter(a) & Counter(b)).values()) < need:
        return False
    return common_words(a, b) >= need


# ---- signing


def _signed_rows(rows: DataFrame, known: set[tuple[str, int, int]] | None) -> DataFrame:
    """``TEXTS`` of every row; ``rows``: ord, l1, l2, site, content, gone. Without words only ``ord, l1, l2`` are set."""
    shared = rows.sparkSession.sparkContext.broadcast(known or frozenset())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        site_lines, mul = shared.value, np.random.default_rng(104729).integers(1, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        shift = np.uint64(8) * np.arange(DEPTH - 1, -1, -1, dtype=np.uint64)
        memory: dict[str, int] = {}
        for batch in batches:
            h1, h2, ns, words, lows = [], [], [], [], []
            for site, content, gone in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                if len(memory) > 500_000:
                    memory.clear()
                seen: dict[int, int] = {}
                code, again = [], []
                for t in _tokens(content, gone or (), site_lines, site):
                    if (c := memory.get(t)) is None:  # a token is stripped and hashed once; 0: no word
                        w = _MARKS.sub("", t)
                        c = memory[t] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) if w else 0
                    if c:
                        k = seen.get(c, 0)
                        seen[c] = k + 1
                        code.append(c)
                        again.append(k)
                ns.append(len(code) or None)
                if not code:
                    h1.append(None)
                    h2.append(None)
                    continue
                arr = np.array(code, np.uint64)
                e = arr + np.array(again, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                e = (e ^ (e >> np.uint64(31))).astype(np.uint32)
                low = np.full(TREES * DEPTH, np.iinfo(np.uint32).max, np.uint32)
                for at in range(0, len(e), 512):
                    low = np.minimum(low, (e[at : at + 512, None] * mul[None, :]).min(0))
                lows.append(low)
                whole = xxhash.xxh3_128_intdigest(arr.tobytes())
                h1.append((whole >> 64) - (1 << 63))
                h2.append((whole & (1 << 64) - 1) - (1 << 63))
                words.append((arr & np.uint64(0x7FFFFFFF)).astype(np.int32))
            there = np.array([n is not None for n in ns], bool)
            low = np.array(lows, np.uint32).reshape(-1, TREES * DEPTH)
            for by, times in ((15, 0x85EBCA6B), (13, 0xC2B2AE35)):
                low ^= low >> np.uint32(by)
                low *= np.uint32(times)
            value = (low >> np.uint32(24)).astype(np.uint64).reshape(-1, TREES, DEPTH)
            keys = (value << shift).sum(2, dtype=np.uint64).astype(np.int64)
            bits = np.packbits(((low[:, :SKETCH] >> np.uint32(12)) & np.uint32(1)).astype(np.uint8), axis=1).reshape(-1).view(">i8").reshape(-1, 2)
            sketch = np.zeros((len(there), 2), np.int64)
            sketch[there] = bits

            def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
                ends = np.concatenate([[0], np.cumsum(np.where(there, sizes, 0))]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=pa.array(~there))

            n = np.array([x or 0 for x in ns], np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(ns, pa.int32()),
                    lists(np.concatenate(words) if words else np.empty(0, np.int32), n), lists(keys.ravel(), np.full(len(n), TREES)),
                    pa.array(sketch[:, 0], mask=~there), pa.array(sketch[:, 1], mask=~there),
                ],
                names=["ord", "l1", "l2", "h1", "h2", "n", "words", "keys", "s1", "s2"],
            )

    return rows.select("ord", "l1", "l2", "site", "content", "gone").mapInArrow(run, TEXTS)


def _signed(articles: DataFrame, site_lines: DataFrame, small: bool) -> DataFrame:
    """Articles signed without their sites' own lines; ``site_lines``: site, h1, h2.

    A text whose site is unknown is freed of the lines of every site: it may be a
    copy of one that has a site. A table of lines below ``BROADCAST_BYTES`` goes to
    the workers; a larger one is joined to the lines of the texts.
    """
    key = link_key(F.col("link"))
    rows = articles.select(
        F.col("row_id").alias("ord"), F.when(key.isNotNull(), F.xxhash64(key)).alias("l1"), F.when(key.isNotNull(), F.xxhash64(F.lit(7919), key)).alias("l2"),
        F.coalesce(host_of(F.col("originallink")), F.lit("")).alias("site"), "content",
    )
    none = F.lit(None).cast("array<int>")
    if small:
        return _signed_rows(rows.withColumn("gone", none), {tuple(r) for r in site_lines.toLocalIterator()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, keys = [], [], []
            for i, content in enumerate(batch.column(2).to_pylist()):
                for k, line in enumerate(normal_lines(content), 1):
                    if line:
                        at.append(i)
                        no.append(k)
                        keys.append(line_hash(line))
            ids = batch.take(pa.array(at, pa.int32()))
            h1, h2 = zip(*keys) if keys else ((), ())
            yield pa.RecordBatch.from_arrays([*ids.columns[:2], pa.array(no, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["ord", "site", "line_no", "h1", "h2"])

    lines = rows.select("ord", "site", "content").where("content is not null").mapInArrow(run, "ord bigint, site string, line_no int, h1 bigint, h2 bigint")
    hit = lines.join(site_lines.hint("merge"), ["site", "h1", "h2"], "left_semi")
    gone = hit.groupBy("ord").agg(F.collect_set("line_no").alias("gone"))
    return _signed_rows(rows.join(gone.hint("merge"), "ord", "left"), None)


# ---- the index


def _manifest(spark: SparkSession, path: str) -> dict:
    state = archives.read_state(spark, f"{path}/manifest.json")
    if not state:
        raise FileNotFoundError(f"no index in {path}")
    return state


def _read(spark: SparkSession, path: str, runs: list[str], part: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/{r}/{part}" for r in runs])


def _write_keys(keys: DataFrame, path: str) -> int:
    """Write keys in order of tree and key: files of disjoint ranges, which statistics of a range find. Returns their number."""
    seen = Observation()
    rows = keys.repartitionByRange("tree", "key").sortWithinPartitions("tree", "key").observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.option("compression", "zstd").parquet(path)
    return seen.get["n"]


def _class_firsts(texts: DataFrame) -> DataFrame:
    """Oldest row of every class of equal texts."""
    return texts.where("h1 is not null").groupBy("h1", "h2").agg(F.min("ord").alias("ord")).select("ord")


def _keys_of(texts: DataFrame, firsts: DataFrame, run: int) -> DataFrame:
    rows = texts.join(firsts, "ord", "left_semi")
    return rows.select(F.posexplode("keys").alias("tree", "key"), "ord", "n", "s1", "s2", F.lit(run).alias("run"))


def build(articles: DataFrame, path: str) -> None:
    """A new index at ``path`` (a folder that all executors share) with the articles as its first run.

    The lines that recur on a site are found over these articles, written beside
    the run and left aside in every later batch. Texts without words have no keys; equal
    texts are one class with the keys of its oldest row. An empty table gives an
    index that knows nothing.
    """
    spark = articles.sparkSession
    lines = materialize(article_lines(articles, ["row_id", "news_id"], trees=False), "lines")
    repeated = repeated_lines(lines)
    own = repeated.select("site", "h1", "h2")
    every = own.select(F.lit("").alias("site"), "h1", "h2").distinct()
    own.unionByName(every).write.parquet(f"{path}/site_lines")
    discard(lines, repeated)
    site_lines = spark.read.schema("site string, h1 bigint, h2 bigint").parquet(f"{path}/site_lines")
    size = table_bytes(site_lines)
    run = f"run-{uuid.uuid4().hex}"
    _signed(articles, site_lines, size <= BROADCAST_BYTES).write.option("compression", "zstd").parquet(f"{path}/{run}/texts")
    texts = spark.read.schema(TEXTS).parquet(f"{path}/{run}/texts")
    _write_keys(_keys_of(texts, _class_firsts(texts), 0), f"{path}/{run}/keys")
    archives.write_state(spark, f"{path}/manifest.json", {"runs": [run], "next": 1, "site_lines": size})


def merge_runs(spark: SparkSession, path: str) -> None:
    """One run in place of all: key tables are merged by range, text tables moved together.

    The manifest changes last, so a crash leaves the old runs in force.
    """
    state = _manifest(spark, path)
    if len(state["runs"]) < 2:
        return
    run = f"run-{uuid.uuid4().hex}"
    _write_keys(_read(spark, path, state["runs"], "keys", KEYS), f"{path}/{run}/keys")
    _read(spark, path, state["runs"], "texts", TEXTS).write.option("compression", "zstd").parquet(f"{path}/{run}/texts")
    archives.write_state(spark, f"{path}/manifest.json", {**state, "runs": [run]})
    for old in state["runs"]:
        fs, p = hadoop_path(spark, f"{path}/{old}")
        fs.delete(p, True)


def _seen_before(batch: DataFrame, texts: DataFrame, first: str, second: str) -> DataFrame:
    """``ord`` of batch rows whose pair of hashes an older text of the index or of the batch has.

    Only hashes of the batch are kept of the index, and only the oldest row of each.
    """
    asked = batch.where(f"{first} is not null").select(first, second, "ord")
    mine = asked.groupBy(first, second).agg(F.min("ord").alias("oldest"))
    ids = asked.select(first, second).distinct()
    old = texts.select(first, second).join(ids, [first, second], "left_semi").distinct().withColumn("known", F.lit(True))
    return asked.join(mine, [first, second]).join(old, [first, second], "left").where("known or ord > oldest").select("ord")


def _in_range(runs: DataFrame, asked: DataFrame, n_asked: int, depth: int) -> DataFrame:
    """``q, tree, c``: older texts ``c`` in the key range that the first ``depth`` levels of a batch key span.

    Pairs must also agree in length and in their sketches as the bound demands. The
    batch's keys are cut into blocks of consecutive ranges that each fit a broadcast;
    a block reads only the files of the runs that its range touches, so runs are
    searched where they lie and never shuffled. One range that doesn't fit a
    block alone, or a batch of more than ``MANY_BLOCKS`` blocks, which would touch all
    of every run anyway, is joined by sort and merge, split by the adaptive skew join.
    """
    cut = 8 * (DEPTH - depth)
    q = asked.select("tree", F.shiftright("key", cut).alias("p"), F.col("ord").alias("q"), F.col("n").alias("qn"), F.col("s1").alias("q1"), F.col("s2").alias("q2"), F.col("run").alias("qrun"), _cell("tree", "key").alias("cell"))
    near = F.bit_count(F.col("s1").bitwiseXOR(F.col("q1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("q2"))) <= DIFFER
    ratio = F.least("n", "qn") >= F.ceil(F.greatest("n", "qn") * SHARE - 1e-9)
    older = (F.col("run") < F.col("qrun")) | (F.col("ord") < F.col("q"))
    c = runs.select("tree", "key", "ord", "n", "s1", "s2", "run")

    def search(part: DataFrame, where: Column | None, hint: str) -> DataFrame:
        mine = c if where is None else c.where(where)
        mine = mine.select("tree", F.shiftright("key", cut).alias("p"), "ord", "n", "s1", "s2", "run")
        return mine.join(part.hint(hint), ["tree", "p"]).where(older & ratio & near).select("q", "tree", F.col("ord").alias("c"))

    if n_asked * KEY_BYTES <= BROADCAST_BYTES:
        return search(q, None, "broadcast")
    room, blocks, at, held = BROADCAST_BYTES // KEY_BYTES, [], 0, 0
    for cell, n in q.groupBy("cell").count().orderBy("cell").toLocalIterator():  # at most TREES * 256 rows
        if held and held + n > room:
            blocks.append((at, cell - 1, held))
            at, held = cell, 0
        held += n
    blocks.append((at, TREES * 256, held))
    if len(blocks) > MANY_BLOCKS:
        return search(q, None, "merge")
    found = []
    for lo, hi, n in blocks:
        span = (F.col("tree") >= lo // 256) & (F.col("tree") <= hi // 256)
        span &= (F.col("tree") > lo // 256) | (F.col("key") >= ((lo % 256) - 128) << 56)
        span &= (F.col("tree") < hi // 256) | (F.col("key") <= (((hi % 256) - 127) << 56) - 1)
        found.append(search(q.where(F.col("cell").between(lo, hi)), span, "broadcast" if n <= room else "merge"))
    return reduce(DataFrame.unionByName, found)


def _cell(tree: str, key: str) -> Column:
    """Number of a key's range when every tree is cut into 256 by its first level."""
    return (F.col(tree) * 256 + F.shiftright(key, 56) + 128).cast("int")


def _verified(pairs: DataFrame, n_pairs: int, texts: DataFrame) -> DataFrame:
    """``q`` of the pairs ``q, c`` whose texts are nearly the same."""
    asked = pairs.select(F.explode(F.array("q", "c")).alias("ord")).distinct()
    few = n_pairs * 2 * 24 <= BROADCAST_BYTES
    words = texts.select("ord", "words").join(asked.hint("broadcast" if few else "merge"), "ord", "left_semi")
    both = pairs.join(words.withColumnsRenamed({"ord": "c", "words": "wc"}), "c").join(words.withColumnsRenamed({"ord": "q", "words": "wq"}), "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, a, b = (c.to_pylist() for c in batch.columns)
            done: set[int] = set()
            for i in range(len(q)):
                if q[i] not in done and nearly_same(a[i], b[i]):
                    done.add(q[i])
            yield pa.RecordBatch.from_arrays([pa.array(sorted(done), pa.int64())], names=["q"])

    return both.select("q", "wq", "wc").mapInArrow(run, "q bigint").distinct()


def accept(batch: DataFrame, path: str) -> DataFrame:
    """``row_id`` of the batch's rows that bring nothing new; the batch then is history.

    Nothing new: a row accepted earlier, or a row of the batch with a smaller
    ``row_id``, has the same article link or nearly the same words in the same order,
    lines that recur on the site left aside. The batch is signed once and appended
    as a run, repeats included; from ``MANY_RUNS`` runs on they are merged. NULL and
    schemeless links and texts without words match nothing. An empty batch gives no rows.
    """
    spark, state = batch.sparkSession, _manifest(batch.sparkSession, path)
    number, run = state["next"], f"run-{uuid.uuid4().hex}"
    site_lines = spark.read.schema("site string, h1 bigint, h2 bigint").parquet(f"{path}/site_lines")
    _signed(batch, site_lines, state["site_lines"] <= BROADCAST_BYTES).write.option("compression", "zstd").parquet(f"{path}/{run}/texts")
    mine = spark.read.schema(TEXTS).parquet(f"{path}/{run}/texts")
    texts = _read(spark, path, state["runs"], "texts", TEXTS)
    same_text = _seen_before(mine, texts, "h1", "h2")
    same = same_text.withColumn("copy", F.lit(True)).unionByName(_seen_before(mine, texts, "l1", "l2").withColumn("copy", F.lit(False)))
    same = materialize(same.groupBy("ord").agg(F.max("copy").alias("copy")), "same")
    alone = mine.where("h1 is not null").join(same.where("copy"), "ord", "left_anti").select("ord")
    n_keys = _write_keys(_keys_of(mine, alone, number), f"{path}/{run}/keys")
    own = spark.read.schema(KEYS).parquet(f"{path}/{run}/keys")

    runs, words = _read(spark, path, [*state["runs"], run], "keys", KEYS), texts.unionByName(mine)
    found, tried = same.select("ord"), None
    for depth in range(DEPTH, widest_depth() - 1, -1):
        pairs = _in_range(runs, own.join(found, "ord", "left_anti"), n_keys, depth)
        if depth == DEPTH:  # the oldest text of each full key first: it settles most of a family
            pairs = pairs.groupBy("q", "tree").agg(F.min("c").alias("c"))
        pairs = pairs.select("q", "c").distinct()
        pairs, seen = counted(pairs if tried is None else pairs.join(tried, ["q", "c"], "left_anti"), "pairs")
        if seen["n"]:
            near = materialize(_verified(pairs, seen["n"], words), "near")
            found = found.unionByName(near.select(F.col("q").alias("ord")))
            tried = pairs if tried is None else tried.unionByName(pairs)
    archives.write_state(spark, f"{path}/manifest.json", {**state, "runs": [*state["runs"], run], "next": number + 1})
    if len(state["runs"]) + 1 >= MANY_RUNS:
        found = materialize(found, "found")
        merge_runs(spark, path)
    return found.select(F.col("ord").alias("row_id"))


def arrivals(incoming: DataFrame, rows: int = ARRIVAL_ROWS) -> list[DataFrame]:
    """Batches in order of their smallest ``row_id``, small ones together until they have ``rows`` rows."""
    if "batch_id" not in incoming.columns:
        return [incoming]
    order = incoming.groupBy("batch_id").agg(F.min("row_id").alias("first"), F.count("*").alias("n")).orderBy("first")
    out, part, held = [], None, 0
    for r in order.toLocalIterator():
        mine = F.col("batch_id").eqNullSafe(F.lit(r["batch_id"]))
        part, held = mine if part is None else part | mine, held + r["n"]
        if held >= rows:
            out.append(incoming.where(part))
            part, held = None, 0
    return out if part is None else [*out, incoming.where(part)]


def found_repeats(raw: DataFrame, incoming: DataFrame, path: str | None = None) -> DataFrame:
    """``row_id`` of every incoming row that brings nothing new, arrival by arrival.

    The index is built once from the raw rows, at ``path`` or for the session in the
    shared folder; each arrival (a ``batch_id``, or several small ones; NULL is one of
    its own) is then looked up and accepted. ``row_id`` must rise with the batch; inside
    an arrival it is the order. Without a ``batch_id`` all incoming rows are one
    arrival. Empty tables give no rows.
    """
    spark = raw.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/gleaner-forest-{uuid.uuid4().hex}"
        fs, p = hadoop_path(spark, path)
        fs.deleteOnExit(p)
    build(raw, path)
    found = [accept(batch, path) for batch in arrivals(incoming)]
    return reduce(DataFrame.unionByName, found) if found else incoming.limit(0).select("row_id")
