"""Text expressions, Column -> Column, all inside Catalyst unless said otherwise."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Unicode word characters as one class that Java and RE2 read alike.
WORD = r"[\p{L}\p{N}_]"


def unicode_trim(c: Column) -> Column:
    """``strip()`` with all Unicode white space, U+00A0 included."""
    return F.regexp_replace(c, r"^[\s\x{00a0}\x{3000}\x{2000}-\x{200a}]+|[\s\x{00a0}\x{3000}\x{2000}-\x{200a}]+$", "")


@F.pandas_udf(StringType())
def unescape_entities(s: pd.Series) -> pd.Series:
    """HTML entities resolved as the standard library does; the one place that needs Python."""
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) and "&" in x else x)


def normalize_html(c: Column) -> Column:
    """Entities resolved, ``<b>`` tags removed, trimmed; NULL stays NULL."""
    return unicode_trim(F.regexp_replace(unescape_entities(c), r"</?b>", ""))


def normalize_title(c: Column) -> Column:
    """Without ``[...]``, ``(...)``, ``<...>``, ``【...】`` (shortest match, within a line), trimmed; NULL gives ''."""
    for pattern in (r"\[[^\n]*?\]", r"\([^\n]*?\)", r"<[^\n]*?>", r"【[^\n]*?】"):
        c = F.regexp_replace(c, pattern, "")
    return F.coalesce(unicode_trim(c), F.lit(""))


def news_id(link: Column) -> Column:
    """First twelve hexadecimal digits of the link's md5."""
    return F.substring(F.md5(link), 1, 12)


def press_piece(url: Column) -> Column:
    """Third ``/``-piece of a URL, NULL if there is none."""
    return F.get(F.split(url, "/"), F.lit(2))


def word_tokens(c: Column) -> Column:
    """Lower-case words of two or more word characters; NULL gives an empty list."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD + "{2,}"), F.lit(0))


def uni_and_bigrams(tokens: Column) -> Column:
    """Tokens followed by the pairs of neighbouring tokens."""
    pairs = F.when(
        F.size(tokens) >= 2,
        F.zip_with(F.slice(tokens, 1, F.size(tokens) - 1), F.slice(tokens, 2, F.size(tokens)), lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, pairs)


def char_shingles(c: Column, size: int = 4) -> Column:
    """Overlapping character shingles of the lower-case word characters; a shorter text is one shingle."""
    kept = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_]", "")
    chars = F.array(F.regexp_extract_all(kept, F.lit("(?s)."), F.lit(0)))
    # the lambda variable holds the characters, which are so made once a text
    windows = lambda cs: F.transform(F.sequence(F.lit(1), F.greatest(F.size(cs) - (size - 1), F.lit(1))), lambda i: F.array_join(F.slice(cs, i, size), ""))
    return F.get(F.transform(chars, windows), F.lit(0))


def embedding_input(title: Column, content: Column, size: int = 300) -> Column:
    """Title and the first ``size`` characters of the content; NULL parts are left out."""
    return F.concat_ws(" ", title, F.substring(content, 1, size))


def prompt(template: Column | str, titles: Column) -> Column:
    """Template with ``{titles}`` replaced by a bulleted list."""
    template = F.lit(template) if isinstance(template, str) else template
    return F.replace(template, F.lit("{titles}"), F.array_join(F.transform(titles, lambda t: F.concat(F.lit("- "), t)), "\n"))


def guarded_label(label: Column, least: int = 3, most: int = 30) -> Column:
    """Trimmed label, '' unless its length lies within bounds; NULL gives ''."""
    bare = unicode_trim(label)
    return F.when(F.length(bare).between(least, most), bare).otherwise("")


def strip_bold(c: Column) -> Column:
    """Without ``<b>`` and ``</b>``, trimmed."""
    return unicode_trim(F.regexp_replace(c, r"</?b>", ""))


def url_quote(c: Column) -> Column:
    """Percent-encoded UTF-8; letters, digits and ``-_.~`` stay."""
    out = F.url_encode(c)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def build_url(base: str, delimiter: str, *parts: Column) -> Column:
    """Base followed by delimiter and part, for each part; NULL parts are left out."""
    return F.concat(F.lit(base), *[F.coalesce(F.concat(F.lit(delimiter), p.cast("string")), F.lit("")) for p in parts])


def passage(title: Column, content: Column) -> Column:
    """Text of a document as retrieval encoders expect it."""
    return F.concat(F.lit("passage: "), F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def search_query(q: Column) -> Column:
    return F.concat(F.lit("query: "), F.coalesce(q, F.lit("")))


def stamp(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, as ``collected_at`` is written; give ``current_timestamp()`` for now."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def zoned_stamp(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss+hhmm`` in the session's zone; NULL for no time."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ssxx")


def polite_style(c: Column) -> Column:
    """Whether the text speaks in the polite style of announcements; NULL doesn't."""
    return F.coalesce(c.rlike("입니다|습니다"), F.lit(False))
