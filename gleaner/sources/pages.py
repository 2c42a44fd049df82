"""Article text from HTML pages, and a paginated search source for offline pages."""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Where an article body stands, in order, and what is no text in it.
SELECTORS = [("article", "dic_area"), ("div", "newsct_article"), ("div", "articleBodyContents"), ("article", None)]
NOISE = {"script", "style", "iframe", "span", "em"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Body(HTMLParser):
    """Text of the first element of each selector, without noise elements."""

    def __init__(self, selectors):
        super().__init__(convert_charrefs=True)
        self.selectors, self.open, self.texts = selectors, [], {}

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        ident = dict(attrs).get("id")
        hit = next((s for s in self.selectors if s[0] == tag and (s[1] is None or s[1] == ident) and s not in self.texts), None)
        if hit:
            self.texts[hit] = []
        self.open.append((tag, hit))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        tags = [t for t, _ in self.open]
        for k, (_, hit) in enumerate(self.open):
            if hit and data.strip() and not NOISE & set(tags[k + 1 :]):
                self.texts[hit].append(data.strip())


def extract_body(page: str | None, selectors=SELECTORS) -> str:
    """Text of the first selector that the page has; '' without one or for NULL."""
    if not page:
        return ""
    parser = _Body(selectors)
    parser.feed(page)
    parser.close()
    return next((" ".join(parser.texts[s]) for s in selectors if s in parser.texts), "")


def html_extract(pages: DataFrame, column: str = "html", out: str = "content") -> DataFrame:
    """Add the article text of an HTML column, entities resolved twice as feeds need it."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: html.unescape(extract_body(x)).replace("<b>", "").replace("</b>", "").strip())

    return pages.withColumn(out, F.pandas_udf(run, "string")(column))


def fetch_pages(links: DataFrame, fetch: Callable[[str], str | None], partitions: int = 8) -> DataFrame:
    """``link, content`` by an injected fetcher; partitions bound the rate, failures give ''."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for link in pdf["link"]:
                try:
                    out.append(extract_body(fetch(link)))
                except Exception:  # noqa: BLE001  a page that fails is an empty page
                    out.append("")
            yield pd.DataFrame({"link": pdf["link"], "content": out})

    return links.select("link").repartition(partitions).mapInPandas(run, "link string, content string")


class _Page(InputPartition):
    def __init__(self, start: int):
        self.start = start


class SearchPages(DataSource):
    """``spark.read.format("search_pages")``: options path (folder of ``<keyword>/<start>.json`` that all executors see), keyword, total, display.

    One partition per page; a page that is missing or broken has no rows and
    doesn't stop the others. Rows carry ``pos``, by which the caller cuts to total.
    """

    @classmethod
    def name(cls) -> str:
        return "search_pages"

    def schema(self) -> str:
        return "search_keyword string, pos bigint, title string, description string, link string, originallink string, pubdate string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


class _SearchReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.keyword = options["path"], options["keyword"]
        self.total, self.display = int(options.get("total", "500")), int(options.get("display", "100"))

    def partitions(self):
        return [_Page(s) for s in range(1, self.total + 1, self.display)]

    def read(self, partition):
        try:
            items = json.loads(Path(self.root, self.keyword, f"{partition.start}.json").read_text(encoding="utf-8"))["items"]
        except (OSError, ValueError, KeyError):
            return
        for k, x in enumerate(items[: self.display]):
            pos = partition.start + k
            if pos <= self.total:
                yield (self.keyword, pos, x.get("title"), x.get("description"), x.get("link"), x.get("originallink"), x.get("pubDate"))
