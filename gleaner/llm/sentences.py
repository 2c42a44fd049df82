"""Sentence boundaries across languages and scripts, in SQL expressions only.

Marks that end nothing (in numbers, dates, addresses, initials, abbreviations,
ellipses, quotes and brackets) are masked by private-use characters, one for one,
so that offsets stay what they are. Then a separator is put behind every boundary
that the marks of each script leave, and the pieces between separators give the
offsets; the text itself is restored from the original by offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks that end sentences, line breaks, closers, and abbreviations by kind.
MARKS = ".!?。！？｡．।॥"
BREAKS = "\n\r\u000b\u000c\u0085  "
WHITE = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
CLOSERS = "\"'”’」』）)\\]》〉】〕〗｣"
BEFORE_NAMES = "Dr Mr Mrs Ms Mx Prof Rep Reps Sen Sens Gov Gen Col Capt Lt Sgt Maj Cmdr Adm Rev Hon Pres Supt Insp Amb Msgr Fr St Mt Messrs".split()
BEFORE_NUMBERS = "No Nos Sec Secs Ver Vol Vols Fig Figs Eq Art Arts Ch Chap pp Para Pt Ref Tel Ext Rm".split()
NEVER_LAST = "vs cf e.g i.e viz approx ca incl est esp".split()
SOMETIMES_LAST = "a.m p.m A.M P.M Inc Ltd Co Corp Bros Jr Sr etc al Ph.D M.D B.A M.A U.S U.K U.N E.U D.C Ave Blvd Dept Univ Assn Jan Feb Mar Apr Jun Jul Aug Sept Sep Oct Nov Dec Mon Tue Wed Thu Fri Sat Sun".split()
HINDI = "डॉ श्री श्रीमती प्रो पं कु सु मो सं ई रु न".split()

_MASK, _FINAL, _BLANK, _CUT = "", "", "", ""
_BR = "".join(f"\\x{{{ord(c):x}}}" for c in BREAKS)


def _either(words: list[str]) -> str:
    return "(?:" + "|".join(w.replace(".", "\\.") for w in sorted(words, key=len, reverse=True)) + ")"


_PAIRS = [("“", "”"), ("‘", "’"), ("「", "」"), ("『", "』"), ("｢", "｣"), ("《", "》"), ("〈", "〉"), ("【", "】"), ("〔", "〕"), ("（", "）"), ('"', '"')]
#: Quoted and bracketed spans within a line, addresses, and what is between them.
SEGMENT = (
    "(?s)[^“‘「『｢《〈【〔（(\\[\"'hw]++"
    + "".join(f"|{a}[^{b}{_BR}]*+{b}" for a, b in _PAIRS)
    + rf"|\([^(){_BR}]*+(?:\([^(){_BR}]*+\)[^(){_BR}]*+)*+\)|\[[^\[\]{_BR}]*+\]"
    + rf"|'(?<![\p{{L}}\p{{N}}]')[^'{_BR}]*+'(?![A-Za-z])"
    + r"|(?:https?://|www\.)[\w./?=&%#:~+@-]*[\w/=]|."
)
_OPENERS = "“‘「『｢《〈【〔（\"(['"
#: Blanks and signs (emoji, joiners) that may stand before what follows.
_GAP = r"(?:[ \t\xa0]|[\p{So}\p{Cf}\p{Mn}])*+"
_WORD = r"(?<![\p{L}\p{N}.])"

#: One pass; every alternative starts at the mark, so that nothing is tried elsewhere.
#: The cases: ellipses, decimals and versions, dates, list numbers, initials,
#: abbreviations before names and numbers, dots within abbreviations, abbreviations
#: that never or here don't close a sentence, Hindi titles; query strings.
MASKS = (
    r"[…‥⋯]|。(?:(?=。)|(?<=。。))|[?](?=[A-Za-z0-9_]+=)|[.．](?:"
    r"(?=[.．])|(?<=[.．].)|(?<=[0-9０-９].)(?=[0-9０-９])"
    r"|(?<=[0-9].)(?:(?<=[0-9]{4}. {0,2}[0-9]{1,2}. {0,2}[0-9]{1,2}.)|(?<=[0-9]{4}.)(?= {0,2}[0-9]{1,2}\.)|(?<=[0-9]{4}. {0,2}[0-9]{1,2}.)(?= {0,2}[0-9]{1,2}))"
    rf"|(?<=[0-9].)(?<=(?:^|[{_BR}])[ \t\xa0]{{0,8}}[0-9]{{1,3}}.)(?=[ \t\xa0])"
    r"|(?<=[A-Za-z].)(?:(?<=(?<![\p{L}\p{N}])[A-Z].)(?=.)"
    rf"|(?<={_WORD}{_either(BEFORE_NAMES + BEFORE_NUMBERS + NEVER_LAST)}.)"
    r"|(?<=(?<![\p{L}\p{N}])[A-Za-z]{1,2}.)(?=[A-Za-z]\.)"
    rf"|(?<={_WORD}{_either(SOMETIMES_LAST)}.)(?={_GAP}[a-z0-9,;:—–(-]))"
    rf"|(?<=[ऀ-ॿ].)(?<=(?<![ऀ-ॿ])(?:{'|'.join(HINDI)}).))"
)
#: What follows a closed quote when its sentence goes on.
GOES_ON = rf"[\p{{IsHangul}}\p{{IsHiragana}},，、;；:：{MARKS}{_MASK}]|\s*\p{{Ll}}|[ \t\xa0]?(?:이?라[고며는]|하고 |고 |며 )"
BOUNDARY = (
    rf"{_FINAL}[{CLOSERS}]+(?!{GOES_ON})"
    rf"|[!?。！？｡।॥][{MARKS}]*[{CLOSERS}]*(?![,，、;；])"
    rf"|[.．][.．!?]*[{CLOSERS}]*(?![0-9A-Za-z_/@,;:，、；：-]|　*{_GAP}[a-z])"
    r"|\.(?<=[a-z].)(?=[A-Z][a-z ])"
    rf"|[ \t\xa0　](?<=[0-9฀-๿].)(?<=[฀-๿][0-9]{{0,12}}.)[ \t\xa0　]*+(?=[\p{{Lu}}\p{{Lo}}“‘「『\"'(\[])"
    rf"|[{_BR}]"
)
_BLOCK = 64


def masked(text: Column) -> Column:
    """The text with every mark masked that ends no sentence; as long as the text."""
    clean = F.regexp_replace(text, "[-]", "")
    segments = F.regexp_extract_all(clean, F.lit(SEGMENT), F.lit(0))
    inner = MARKS + "…‥⋯ \xa0　\t"
    swapped = lambda s: F.translate(s, inner, _MASK * (len(inner) - 4) + _BLANK * 4)
    last = lambda s: F.regexp_replace(s, rf"[{MARKS}](?=[{CLOSERS}]+$)", _FINAL)
    # a final mark survives the swap: it was replaced before it
    quoted = lambda s: (F.length(s) > 1) & F.substring(s, 1, 1).isin(*_OPENERS)
    address = lambda s: s.rlike(r"^(?:https?://|www\.)")
    joined = F.array_join(F.transform(segments, lambda s: F.when(quoted(s), swapped(last(s))).when(address(s), swapped(s)).otherwise(s)), "")
    return F.regexp_replace(joined, MASKS, _MASK)


def boundaries(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start_pos, end_pos``: every sentence as code point offsets, end exclusive.

    A line break always ends a sentence; quotes and brackets that don't close in
    their line count as plain text. NULL, empty and blank texts have no sentences.
    A text without any mark is one sentence a line. Sentences are trimmed of white
    space. Repeated rows come out as often as they went in.
    """
    rows = docs.select(key, F.col(text).alias("__t")).where("__t is not null")
    rows = rows.select(key, masked(F.col("__t")).alias("__m"))
    rows = rows.select(key, F.split(F.regexp_replace("__m", BOUNDARY, "$0" + _CUT), _CUT).alias("__p"))
    measure = F.transform(
        "__p",
        lambda p: F.struct(
            F.length(p).alias("n"),
            (F.length(p) - F.length(F.ltrim(p, F.lit(WHITE)))).alias("a"),
            (F.length(p) - F.length(F.rtrim(p, F.lit(WHITE)))).alias("z"),
        ),
    )
    rows = rows.select(key, measure.alias("__s"))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda acc, x: acc + x["n"])
    # prefix sums in two levels, blocks of the root of all sentences, so that a text of many stays cheap
    w = F.greatest(F.lit(_BLOCK), F.ceil(F.sqrt(F.size("__s")))).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("__s") - 1) / w).cast("int")),
        lambda b: F.struct(total(F.slice("__s", b * w + 1, w)).alias("n")),
    )
    rows = rows.select(key, "__s", w.alias("__w"), blocks.alias("__b"))
    w = F.col("__w")
    offset = lambda i: total(F.slice("__b", 1, F.floor(i / w).cast("int"))) + total(F.slice("__s", (F.floor(i / w) * w + 1).cast("int"), i % w))
    spans = F.transform("__s", lambda s, i: F.struct(offset(i).alias("o"), s.alias("s")))
    rows = rows.select(key, F.explode(spans).alias("__x"))
    rows = rows.select(key, (F.col("__x.o") + F.col("__x.s.a")).cast("int").alias("start_pos"), (F.col("__x.o") + F.col("__x.s.n") - F.col("__x.s.z")).cast("int").alias("end_pos"))
    return rows.where("end_pos > start_pos")


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start_pos, end_pos, sentence``, the sentence taken from the original text."""
    found = boundaries(docs.select(F.struct(key, text).alias("__k"), text), "__k", text)
    return found.select(F.col(f"__k.{key}").alias(key), "start_pos", "end_pos", F.substring(F.col(f"__k.{text}"), F.col("start_pos") + 1, F.col("end_pos") - F.col("start_pos")).alias("sentence"))
