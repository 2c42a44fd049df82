"""Lines repeated across one site's documents: fixed-depth token trees with wildcard slots.

Each partition grows a tree: site, number of tokens, first tokens (a token with a
digit is a wildcard), and in the leaf templates, into which a line falls if at least
half of its tokens agree; slots in which the lines of a template differ become
wildcards. The trees of all partitions are merged leaf by leaf: templates that one
line could match are one. Only lines of merged templates that cover many documents
are counted one by one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.sites import host_of
from gleaner.session import discard, materialize, sized_join

#: Articles of one site in which a line must occur to be the site's own.
MIN_ARTICLES = 10
#: Tokens below the token count that the tree looks at, and the share of tokens that agree within a template.
DEPTH, ALIKE = 3, 0.5
#: Templates that a leaf holds in a partition, and that one leaf merges; a fuller leaf counts as one template, wild
#: behind its first tokens, which covers all of its lines.
LEAF_TEMPLATES, LEAF_MERGE = 64, 2_000
#: Templates that a partition holds before it hands over its tree and grows a new one.
TREE_TEMPLATES = 200_000
WILD = "<*>"
LINE_END = re.compile("\r\n|\n|\r")
_DIGIT = re.compile(r"\d")
_MEMORY = 200_000


def normal_lines(content: str) -> list[str]:
    """Lines (ends: CR LF, LF, CR) after NFKC, lower-casing, one space for white space, trimming."""
    if not content.isascii():
        content = "\n".join(unicodedata.normalize("NFKC", x) for x in LINE_END.split(content))
        return [" ".join(x.lower().split()) for x in content.split("\n")]
    return [" ".join(x.lower().split()) for x in LINE_END.split(content)]


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def line_hash(line: str) -> tuple[int, int]:
    """Two 64-bit hashes of a line."""
    whole = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return _signed(whole >> 64), _signed(whole & (1 << 64) - 1)


class TokenTree:
    """Templates of one partition's lines, by site, token count and first tokens."""

    def __init__(self) -> None:
        self.leaves: dict[tuple, list[list]] = {}
        self.size = 0

    def add(self, site: str, line: str, own: int) -> list:
        """The template that the line falls into: ``[path, founder, tokens, rows, last row]``.

        ``own``, the hash of the founding line, names the template while its wildcards grow.
        """
        tokens = line.split(" ")
        if _DIGIT.search(line):
            tokens = [WILD if _DIGIT.search(t) else t for t in tokens]
        head = tokens[:DEPTH]
        key = (site, len(tokens), *head)
        leaf = self.leaves.get(key)
        if leaf is None:
            leaf = self.leaves[key] = []
        best, score = None, ALIKE * len(tokens)
        for template in leaf:
            same = sum(map(str.__eq__, template[2], tokens))
            if same >= score and (best is None or same > score):
                best, score = template, same
        if best is None and len(leaf) >= LEAF_TEMPLATES:
            best = leaf[0]
            best[2] = [WILD] * len(tokens)
        if best is None:
            path = leaf[0][0] if leaf else _signed(xxhash.xxh3_64_intdigest(f"{len(tokens)} {' '.join(head)}".encode("utf-8", "surrogatepass")))
            best = [path, own, tokens, 0, -1]
            leaf.append(best)
            self.size += 1
        elif best[2] != tokens:
            best[2] = [a if a == b else WILD for a, b in zip(best[2], tokens, strict=True)]
        return best

    def rows(self) -> list[tuple]:
        """``site, path, founder, pattern, rows`` of every template."""
        return [(site, t[0], t[1], " ".join(t[2]), t[3]) for (site, *_), leaf in self.leaves.items() for t in leaf]


def article_lines(articles: DataFrame, id_columns: list[str], trees: bool = True) -> DataFrame:
    """Every line that isn't blank, as ``*id_columns, site, line_no, path, tpl, h1, h2``, and every partition's templates.

    Template rows have no ids and no ``line_no``, but ``pattern`` and ``n_rows``, the
    articles that fall into it there. Rows without site or content have no lines.
    Line numbers count blank lines, too. Without ``trees`` there are no templates.
    """
    rows = articles.select(*id_columns, host_of(F.col("originallink")).alias("site"), "content").where("site is not null and content is not null")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{kinds}, line_no int, path bigint, tpl bigint, h1 bigint, h2 bigint, pattern string, n_rows bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, memory, row, none = TokenTree(), {}, 0, [None, None, [], 0, -1]
        kinds: list[pa.DataType] = []

        def templates() -> pa.RecordBatch:
            got = tree.rows()
            site, path, tpl, pattern, n = zip(*got) if got else ((), (), (), (), ())
            none = [pa.nulls(len(got), k) for k in kinds]
            columns = [*none, pa.array(site, pa.string()), pa.nulls(len(got), pa.int32()), pa.array(path, pa.int64()), pa.array(tpl, pa.int64())]
            columns += [pa.nulls(len(got), pa.int64())] * 2 + [pa.array(pattern, pa.string()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        names: list[str] = []
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in range(batch.num_columns - 2)]
            names = [*batch.schema.names[:-1], "line_no", "path", "tpl", "h1", "h2", "pattern", "n_rows"]
            at, no, path, tpl, h1, h2 = [], [], [], [], [], []
            sites, contents = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for i, (site, content) in enumerate(zip(sites, contents, strict=True)):
                row += 1
                if len(memory) > _MEMORY:
                    memory.clear()
                if tree.size > TREE_TEMPLATES:
                    yield templates()
                    tree, memory = TokenTree(), {}
                for k, line in enumerate(normal_lines(content), 1):
                    if line:
                        if (got := memory.get((site, line))) is None:
                            h = line_hash(line)
                            got = memory[site, line] = (tree.add(site, line, h[0]) if trees else none, *h)
                        t = got[0]
                        if t[4] != row:
                            t[3] += 1
                            t[4] = row
                        at.append(i)
                        no.append(k)
                        path.append(t[0])
                        tpl.append(t[1])
                        h1.append(got[1])
                        h2.append(got[2])
            ids = batch.take(pa.array(at, pa.int32()))
            columns = [*ids.columns[:-1], pa.array(no, pa.int32()), *(pa.array(x, pa.int64()) for x in (path, tpl, h1, h2))]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.int64())], names=names)
        if names:
            yield templates()

    return rows.mapInArrow(run, schema)


def merged_templates(patterns: list[str]) -> np.ndarray:
    """Group number of each pattern: patterns of one length that some line could match both are in one group.

    A pattern joins every group that it is compatible with, and so unites them; as a
    group's pattern covers its members, two patterns that share a line never part.
    """
    tokens = [p.split(" ") for p in patterns]
    code: dict[str, int] = {WILD: 0}
    x = np.array([[code.setdefault(t, len(code)) for t in row] for row in tokens])
    group, rows = np.empty(len(x), np.int64), np.empty_like(x)
    live = np.zeros(len(x), bool)
    for i, t in enumerate(x):
        seen = rows[:i]
        fit = live[:i] & ((seen == t) | (seen == 0) | (t == 0)).all(1)
        rows[i], group[i], live[i] = t, i, True
        for g in np.flatnonzero(fit):
            rows[i] = np.where(rows[g] == rows[i], rows[i], 0)
            live[g] = False
            group[:i][group[:i] == g] = i
    return group


def covering_templates(lines: DataFrame, least: int = MIN_ARTICLES) -> DataFrame:
    """``site, path, tpl, template, n_rows``: partition templates whose merged template covers enough rows.

    ``n_rows`` is that of the merged template: at least the number of its articles, as
    an article counts once a partition. Leaves that can't reach ``least`` go first, in
    partial aggregates; a leaf of more than ``LEAF_MERGE`` templates is one template.
    """
    own = lines.where("pattern is not null").groupBy("site", "path", "tpl", "pattern").agg(F.sum("n_rows").alias("n"))
    leaves = own.groupBy("site", "path").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where(F.col("total") >= least)
    leaves = materialize(leaves, "leaves")
    rows = materialize(sized_join(own, leaves, ["site", "path"]), "templates")

    def merge(t: pa.Table) -> pa.Table:
        patterns, n = t["pattern"].to_pylist(), np.asarray(t["n"])
        group = merged_templates(patterns)
        total = np.bincount(group, n, len(group)).astype(np.int64)
        shape: dict[int, list[str]] = {}
        for g, p in zip(group, patterns, strict=True):
            words = p.split(" ")
            shape[g] = [a if a == b else WILD for a, b in zip(shape.get(g, words), words, strict=True)]
        out = t.select(["site", "path", "tpl"]).append_column("template", pa.array([" ".join(shape[g]) for g in group], pa.string()))
        return out.append_column("n_rows", pa.array(total[group])).filter(pa.array(total[group] >= least))

    schema = "site string, path bigint, tpl bigint, template string, n_rows bigint"
    fine = rows.where(F.col("kinds") <= LEAF_MERGE).groupBy("site", "path").applyInArrow(merge, schema)
    words = F.split("pattern", " ")
    wild = F.array_join(F.transform(words, lambda w, k: F.when((k < DEPTH) & ~w.rlike(r"\p{Nd}"), w).otherwise(WILD)), " ")
    whole = rows.where(F.col("kinds") > LEAF_MERGE).select("site", "path", "tpl", wild.alias("template"), F.col("total").alias("n_rows"))
    return fine.unionByName(whole)


def repeated_lines(lines: DataFrame, least: int = MIN_ARTICLES) -> DataFrame:
    """``site, h1, h2, n_articles``: lines in articles with at least ``least`` ids of one site.

    Candidates are the lines of covering templates; the count of different
    ``news_id`` is exact. A line in a third of all rows is first reduced to one row
    per ``news_id`` in map-side aggregates, so no task gets the whole of it. Lines
    parsed without trees are all candidates.
    """
    if not lines.where("line_no is null").limit(1).count():
        return materialize(_counted_lines(lines, least), "repeated")
    templates = materialize(covering_templates(lines, least).select("site", "path", "tpl").distinct(), "templates")
    candidates = sized_join(lines.where("line_no is not null"), templates, ["site", "path", "tpl"], "left_semi")
    out = materialize(_counted_lines(candidates, least), "repeated")
    discard(templates)
    return out


def _counted_lines(lines: DataFrame, least: int) -> DataFrame:
    once = lines.where("news_id is not null").select("site", "h1", "h2", "news_id").distinct()
    counts = once.groupBy("site", "h1", "h2").agg(F.count("*").alias("n_articles"))
    return counts.where(F.col("n_articles") >= least)


def found_lines(articles: DataFrame, least: int = MIN_ARTICLES) -> DataFrame:
    """``row_id, line_no`` of every repeated line of a site.

    NULL or blank content, rows without site and blank lines give nothing. Rows
    with NULL ``news_id`` count for no line but lose theirs. Exact copies of rows
    keep their own lines. An empty table gives no rows.
    """
    lines = materialize(article_lines(articles, ["row_id", "news_id"]), "lines")
    repeated = repeated_lines(lines, least)
    hit = sized_join(lines.where("line_no is not null"), repeated.select("site", "h1", "h2"), ["site", "h1", "h2"], "left_semi")
    return hit.select("row_id", "line_no")


def without_lines(articles: DataFrame, found: DataFrame) -> DataFrame:
    """All rows with ``content`` freed of the found lines; line ends become LF where a line went.

    ``found`` is reduced to one list of line numbers per row, bounded by its lines.
    Rows without found lines keep their content as it is, NULL included.
    """
    gone = found.groupBy("row_id").agg(F.collect_set("line_no").alias("__gone"))
    kept = F.filter(
        F.transform(F.split("content", "\r\n|\n|\r"), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i"))),
        lambda y: ~F.array_contains("__gone", y["i"]),
    )
    text = F.array_join(F.transform(kept, lambda y: y["x"]), "\n")
    rows = articles.join(gone, "row_id", "left")
    return rows.withColumn("content", F.when(F.col("__gone").isNull(), F.col("content")).otherwise(text)).withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0))).drop("__gone")


def line_templates(articles: DataFrame, least: int = MIN_ARTICLES) -> DataFrame:
    """``site, template, n_lines``: the covering templates in words, slots in which their lines differ as ``<*>``."""
    lines = materialize(article_lines(articles, ["row_id", "news_id"]), "lines")
    return covering_templates(lines, least).select("site", "template", F.col("n_rows").alias("n_lines")).distinct()
