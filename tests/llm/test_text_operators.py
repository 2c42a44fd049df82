"""Site lines, residue, encoding, leaks and sentences against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from gleaner.llm import bpe, leakage, residue, sentences, site_lines

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def host(url):
    m = re.match(r"\w+://([^/:?#]+)", url or "")
    return re.sub(r"^((www|m)\.)+", "", m[1].lower()) if m else None


# ---- 1


ARTICLE = "row_id bigint, news_id string, originallink string, content string, site string, path string"


def lines_of(rows, least):
    seen, out = collections.defaultdict(set), []
    for row_id, news_id, link, content in rows:
        if host(link) and content is not None:
            for k, line in enumerate(site_lines.normal_lines(content), 1):
                if line:
                    out.append((row_id, k, host(link), line))
                    if news_id is not None:
                        seen[host(link), line].add(news_id)
    return sorted((r, k) for r, k, h, line in out if len(seen[h, line]) >= least)


def test_found_lines(spark):
    random.seed(3)
    rows = []
    for i in range(60):
        site = random.choice(["https://www.A.example:80/x", "http://m.a.example/y", "https://b.example/z", None, ""])
        text = random.choice(["\r\n", "\n", "\r"]).join([f"story {i}", " Share  THIS ", "", "Ｓｈａｒｅ this", f"by desk {i % 3}", "page 12"][: random.randrange(0, 7)])
        rows.append((i, random.choice([f"n{i}", f"n{i // 2}", None]), site, random.choice([text, text, text, None, ""])))
    rows += rows[:5]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], ARTICLE)
    for least in (2, 10):
        assert rows_of(site_lines.found_lines(df, least)) == lines_of(rows, least)
    assert site_lines.found_lines(df.limit(0)).count() == 0


def test_real_rows(spark):
    df = spark.read.parquet(f"{SF}/raw_articles.parquet")
    rows = [tuple(r) for r in df.select("row_id", "news_id", "originallink", "content").collect()]
    found = site_lines.found_lines(df, 3)
    assert rows_of(found) == lines_of(rows, 3)
    cleaned = {r.row_id: r for r in site_lines.without_lines(df, found).collect()}
    gone = collections.Counter(r for r, _ in rows_of(found))
    for row_id, _, _, content in rows:
        assert cleaned[row_id].n_removed == gone[row_id]
        if not gone[row_id]:
            assert cleaned[row_id].content == content
    templates = site_lines.line_templates(df, 3).collect()
    assert any(site_lines.WILD in t.template for t in templates)
    shapes = collections.defaultdict(list)
    for t in templates:
        shapes[t.site].append(t.template.split(" "))
    hits = set(rows_of(found))
    for row_id, _, link, content in rows:  # every repeated line is of a template that covers enough rows
        for k, line in enumerate(site_lines.normal_lines(content or ""), 1):
            if (row_id, k) in hits:
                words = line.split(" ")
                assert any(len(s) == len(words) and all(a in (site_lines.WILD, b) for a, b in zip(s, words, strict=True)) for s in shapes[host(link)]), line


def test_trees_of_partitions_merge(spark, monkeypatch):
    """Lines that meet only after the merge, in small, full and handed-over trees: the counts stay exact."""
    rnd = random.Random(13)
    say = lambda: " ".join(rnd.choice(["a", "b", "c1", "d2"]) for _ in range(rnd.randrange(1, 6)))
    rows = [(i, f"n{i % 70}", "http://a.example/1", "\n".join(say() for _ in range(4))) for i in range(300)]
    want = lines_of(rows, 10)
    df = spark.createDataFrame([(*r, "", "") for r in rows], ARTICLE).repartition(8)
    for leaf, merge, tree in ((64, 2_000, 200_000), (2, 2_000, 200_000), (64, 3, 20), (1, 1, 1)):
        monkeypatch.setattr(site_lines, "LEAF_TEMPLATES", leaf)
        monkeypatch.setattr(site_lines, "LEAF_MERGE", merge)
        monkeypatch.setattr(site_lines, "TREE_TEMPLATES", tree)
        assert rows_of(site_lines.found_lines(df, 10)) == want


def test_merged_templates():
    w = site_lines.WILD
    got = site_lines.merged_templates([f"a {w} d", "x y z", f"a c {w}", "a b d", "x y q", f"x {w} q"])
    assert [len(set(got[[0, 2, 3]])), len(set(got[[4, 5]])), len(set(got))] == [1, 1, 3]


def test_long_line(spark):
    df = spark.createDataFrame([(i, f"n{i}", "http://a.example/", "x" * 300_000 + "\nend", "", "") for i in range(3)], ARTICLE)
    assert site_lines.found_lines(df, 3).count() == 6


# ---- 4


RESIDUE = [
    "{{title}}", "%TITLE% | %SITE%", "undefined", "null", "Untitled-3", "[제목을 입력하세요]", "404 - 페이지를 찾을 수 없음 (12)", "Just a moment...",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod", "서비스 점검 중입니다. 점검 시간 0:10~3:20 코드 ab12",
    "위원장은 회의에서 {% article.body %}", "회의는 예산을 다뤘다.\n글 undefined 기자 | 승인 NaN-NaN-NaN | 조회 12", "Please enable JavaScript and cookies to continue. Ray 12ab",
    "이 페이지를 보려면 자바스크립트를 켜 주십시오.\n글자 크기 조절", "502 Bad Gateway — upstream a1 did not answer in time",
]
PROSE = [
    "의원은 서식에 '여기에 본문을 입력하세요'라는 문구가 남은 채 청원이 접수됐다며 위원회를 꼬집었다.",
    "누리집에는 8시간 동안 '페이지를 찾을 수 없습니다'라는 안내만 떠 주민들의 항의가 466건 이어졌다.",
    "503·404 같은 오류가 12.3%까지 치솟자 위원회는 접수를 창구로 돌렸다.", "위원회는 자바스크립트를 켜야만 열리는 신청 화면을 9월까지 고치겠다고 했다.",
    "The council voted to delay the motion after a long debate about the harbor.", "지지율은 49.4%가 아니라 77.0%로 올랐다.", "그는 '{{title}}' 표시를 지웠다고 말했다.",
    None, "", "  \n",
]


def test_residue(spark):
    rows = [(i, t, None) for i, t in enumerate(RESIDUE)] + [(100 + i, None, t) for i, t in enumerate(RESIDUE)] + [(200 + i, t, t) for i, t in enumerate(PROSE)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "row_id bigint, title string, content string, t string")
    got = {r.row_id for r in residue.found_residue(df).collect()}
    assert got == {i for i, _, _ in rows if i < 200}, sorted(got ^ {i for i, _, _ in rows if i < 200})
    assert residue.found_residue(df.limit(0)).count() == 0


# Development set: none of these stands in the module, but scores and base prose were chosen with these in view.
UNSEEN_RESIDUE = [
    "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.",
    "Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim.",
    "Quis autem vel eum iure reprehenderit qui in ea voluptate velit esse quam nihil molestiae consequatur.",
    "Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.", "お探しのページが見つかりません。", "ページが見つかりませんでした", "请启用JavaScript后重试。",
    "SQLSTATE[HY000] [2002] No such file or directory", "HTTP Status 405 – Method Not Allowed", "ERR_TOO_MANY_REDIRECTS", "안녕하세요 {name} 님, {article.title} 안내입니다",
    "Oops! That page can't be found.", "The requested resource could not be found on this server.", "You don't have permission to view this directory.",
    "Please enable cookies to continue.", "You need to enable JavaScript to run this app.", "We're sorry but this site doesn't work properly without JavaScript enabled.",
    "Error 521: Web server is down", "nginx 504 Gateway Time-out", "Fatal error: Uncaught Error: Call to a member function on null in /srv/www/page.php:18",
    "java.lang.ArrayIndexOutOfBoundsException: 3 at org.example.View.render(View.java:77)", "TypeError: Cannot read property 'title' of undefined",
    "요청하신 페이지를 찾을 수 없습니다.", "존재하지 않는 페이지입니다.", "일시적인 서버 오류가 발생했습니다. 잠시 후 다시 시도해 주시기 바랍니다.", "접속 권한이 없는 페이지입니다.",
    "자바스크립트를 활성화해 주세요.", "브라우저에서 자바스크립트가 꺼져 있습니다.", "서비스 점검으로 이용할 수 없습니다.", "로그인이 필요한 페이지입니다.", "내용을 입력하세요", "여기에 제목을 입력하십시오",
    "더미 텍스트입니다. 더미 텍스트입니다.", "글 글 글 글 글 글", "%%TITLE%%", "<%= article.body %>", "작성 undefined | 수정 NaN-NaN-NaN", "{{ post.summary|truncate(120) }}",
]
UNSEEN_PROSE = [
    "회사 측은 서버 오류로 서비스가 두 시간 동안 중단됐다고 밝혔다.", "시는 누리집 접속 장애가 이어지자 예매를 이틀 미뤘다.", "개발자들은 자바스크립트 교육 과정을 늘려 달라고 요구했다.",
    "데이터베이스 이전 작업이 늦어져 민원 처리가 사흘째 밀렸다고 구청은 설명했다.", "경찰은 시스템에 비정상적으로 접근한 혐의로 40대를 조사하고 있다.", "페이지를 넘길 때마다 아이들은 그림을 오래 들여다보았다.",
    "The airline said that a server error had kept passengers from checking in for two hours.", "Officials removed the page after readers complained that it could not be found.",
    "The museum asked visitors to enable the guide on their phones before they enter the hall.", "She found no content in the box, only a note that had been written years before.",
    "He told the court that access to the building was denied to him twice that week.", "The bridge will be closed for maintenance on Sunday, the council said on Friday.",
    "A spokesman said the service would be unavailable on two nights in May while cables are laid.", "점검 결과 다리 난간 12곳에서 금이 발견돼 시가 통행을 막았다.", "그는 제목 없는 그림 석 점을 미술관에 기증했다.",
    "The word null comes from Latin and meant none to the lawyers of that time.", "시민들은 \"잠시 후 다시 시도해 주세요\"라는 말만 열 번 들었다고 했다.", "서비스 산업 예산은 접근성 개선에 12억원이 들어간다.",
]


def test_unseen_residue_and_prose_about_messages():
    counts = np.zeros((2, 1 << residue.BITS), np.int64)
    texts = [t for t in pq.read_table(f"{SF}/raw_articles.parquet")["content"].to_pylist() if t]
    table = residue.ratio_table(counts + residue.gram_counts([u for t in texts for u in residue._UNITS.split(residue._normal(t)) if u], residue._seed_counts().sum((0, 1)) > 0))
    hit, false = residue.flags(UNSEEN_RESIDUE, table), residue.flags(UNSEEN_PROSE, table)
    assert hit.mean() >= 0.9, [t for t, x in zip(UNSEEN_RESIDUE, hit, strict=True) if not x]
    assert not false.any(), [t for t, x in zip(UNSEEN_PROSE, false, strict=True) if x]
    known = {u for phrases in residue.SEEDS.values() for x in phrases for u in residue._UNITS.split(residue._normal(x))}
    assert not known & {residue._normal(t) for t in UNSEEN_RESIDUE}


def test_residue_counts_may_be_kept(spark):
    df = spark.read.parquet(f"{SF}/raw_articles.parquet").select("row_id", "title", "content")
    prose = residue.fit_prose(df)
    units = [u for c in ("title", "content") for t in df.toPandas()[c] if t for u in residue._UNITS.split(residue._normal(t)) if u and not residue.repeated_words(u)]
    assert (prose == residue.gram_counts(units, residue._seed_counts().sum((0, 1)) > 0)).all()
    kept = rows_of(residue.with_residue(df, prose=prose).where("residue.title or residue.content").select("row_id"))
    assert kept == rows_of(residue.found_residue(df)) != []


def test_residue_long_text(spark):
    assert not residue.flags(["가 나 다. " * 100_000], residue.ratio_table(np.zeros((2, 1 << residue.BITS), np.int64)))[0]


# ---- 8


TEXTS = ["", None, " ", "Hello  world's 12 <|endoftext|>\n\n", "한글 문장이다. 水道料金は……", "a" * 3000, " 　é é 👩‍⚖️", "ไทย ไม่มีช่องว่าง" * 20]


def test_encode_equals_public_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(bpe.VOCABULARY.replace(".tiktoken", ".json"))
    reference.encode_special_tokens = True
    texts = TEXTS + [x for x in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in bpe.encode(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (reference.encode(t, add_special_tokens=False).ids if t else []), t
    assert bpe.encode(df.limit(0)).count() == 0


def test_appends_and_edits_equal_encoding_anew():
    v = bpe.Vocabulary(bpe.VOCABULARY)
    rnd = random.Random(5)
    for _ in range(60):
        s = bytes(rnd.choice(b"abc the 12\xea\xb0\x80") for _ in range(rnd.randrange(1, 400)))
        cut = rnd.randrange(len(s))
        e = bpe.PrefixEncoder(v, s[:cut])
        e.append(s[cut:])
        assert e.ids() == [v.rank[t] for t in v.merge(s)]
        a = rnd.randrange(len(s))
        b, new = rnd.randrange(a, min(len(s), a + 9) + 1), bytes(rnd.choice(b"abc the") for _ in range(rnd.randrange(6)))
        e.replace(a, b, new)
        assert e.last == bpe.PrefixEncoder(v, s[:a] + new + s[b:]).last


# ---- 9


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcd가나다") for _ in range(rnd.randrange(1, 8)))
    items = [(i, "t", " ".join(word() for _ in range(rnd.choice([3, 30, 60]))), "A") for i in range(30)] + [(30, "t", "ab" * 80, "A"), (31, "t", None, "A"), (32, "t", "", "A")]
    docs = []
    for i in range(200):
        src = rnd.choice(items)[2] or ""
        r = leakage.reduced(src)
        a = rnd.randrange(max(1, len(r) - 40))
        piece = " · ".join(r[a : a + rnd.choice([45, 49, 50, 51, 70, 200])].upper())
        docs.append((i, rnd.choice([" ".join(word() for _ in range(rnd.randrange(300))) + piece + " ".join(word() for _ in range(40)), piece, None, ""])))
    runs = collections.defaultdict(set)
    for i, _, t, _ in items:
        r = leakage.reduced(t or "")
        for k in range(len(r) - 49):
            runs[r[k : k + 50]].add(i)
    want = sorted({(d, i) for d, t in docs if t for k in range(len(leakage.reduced(t)) - 49) for i in runs.get(leakage.reduced(t)[k : k + 50], ())})
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame(items, "item_id bigint, task string, text string, answer string")
    assert want and rows_of(leakage.found_leaks(d, it)) == want
    assert leakage.found_leaks(d.limit(0), it).count() == 0 == leakage.found_leaks(d, it.limit(0)).count()


def test_wand_skips_blocks_and_loses_nothing():
    rnd = random.Random(15)
    text = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    shared = text(30)
    index = leakage.ItemIndex([(i, text(rnd.randrange(50, 90)) + (shared if i % 2 else ""), None) for i in range(400)])
    grams = sorted(index.postings)
    for _ in range(300):
        own = index.texts[rnd.randrange(400)]
        query = {own[k : k + leakage.GRAM] for k in range(0, 40, leakage.STRIDE)} | set(rnd.sample(grams, 5)) | {g for g in (shared[k : k + leakage.GRAM] for k in range(0, 18, 6))}
        score = collections.defaultdict(float)
        for g in query:
            for d, w in zip(index.postings[g].docs, index.postings[g].weights, strict=True):
                score[d] += w
        want = sorted(d for d, x in score.items() if x >= index.least[d])
        assert sorted(index.search(query)) == want
    assert index.skipped > index.scored > 0


def test_answers_behind_the_passage(spark):
    text = "Which clause of the library fund motion lets the council defend a ruling that was issued 64 days earlier?"
    items = spark.createDataFrame([(1, "t", text, "B"), (2, "t", text + " x", "the harbor"), (3, "t", text, None)], "item_id bigint, task string, text string, answer string")
    docs = [(1, f"Intro. {text} Answer: (B)"), (2, f"{text} A, not the  Harbor."), (3, text), (4, f"B. {text} " + "word " * 50 + "B")]
    got = {(r.doc_id, r.item_id): r.answered for r in leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()}
    assert got == {(d, i): (d, i) in {(1, 1), (2, 2)} for d in (1, 2, 3, 4) for i in (1, 2, 3)}


# ---- 10


SENTENCES = [
    "의안 No. 31463은 끝났다. 2026. 2. 23. 회의에서 9.4%다.다음 문장이다!",
    "1. 첫째 항목 3.4% 조정\r\n2. 둘째",
    "그는 “꼼꼼히 보겠다. 늦출 수 없다.”라고 강조했다.¦ 대변인(3선. 본관)은 없다… 그렇다고 했다.",
    "Dr. A. B. Orlin said it at 2:27 a.m.¦ Holdings Inc. and 6 firms paused... then left.¦ “We must. Now,” said Mr. Xu.¦ “Choose by 24 May.”¦ About 263 came?!¦ See www.a.example/doc?v=5.62 now",
    "支持率は49.2％で、反対した。¦議員は「急がない。話す。」と述べた。¦続けたが……延びた！",
    "表示：“不必着急。商量。”¦审计处真的能等吗？¦还是推迟了3天。",
    "ชาวบ้าน120คนยื่นหนังสือ¦ กลุ่มฟ้าครามมี31.6เปอร์เซ็นต์",
    "डॉ. मृदुला ने कहा, “जल्दी में नहीं होगा। बात होगी।”¦ क्या होगा?",
    "   blank around 　",
    'Unclosed “quote. Still goes on.',
]


def test_sentences(spark):
    marked = [s.replace("끝났다. ", "끝났다.¦ ").replace("9.4%다.", "9.4%다.¦").replace("조정\r\n", "조정¦\r\n") for s in SENTENCES]
    texts = [s.replace("¦", "") for s in marked]
    want = []
    for i, s in enumerate(marked[:-1]):
        at = 0
        for piece in s.split("¦"):
            bare = piece.strip()
            want.append((i, at + piece.index(bare), at + piece.index(bare) + len(bare)))
            at += len(piece)
    extra = [None, "", " \n\t "]
    df = spark.createDataFrame(list(enumerate(texts[:-1] + extra)), "doc_id bigint, text string")
    assert rows_of(sentences.boundaries(df)) == sorted(want)
    for r in sentences.sentences(df).collect():
        assert texts[r.doc_id][r.start_pos : r.end_pos] == r.sentence
    assert sentences.boundaries(df.limit(0)).count() == 0


def test_masks_keep_length_and_long_texts_work(spark):
    long = "문장이다. " * 20_000 + "“" + "가" * 50_000
    texts = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() + SENTENCES + [" x.", "😀. 😀 “😀.” 끝"]
    df = spark.createDataFrame([(t,) for t in texts if t], "t string")
    from pyspark.sql import functions as F

    assert df.where(F.length("t") != F.length(sentences.masked(F.col("t")))).count() == 0
    assert sentences.boundaries(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).count() == 20_001
