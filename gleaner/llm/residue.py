"""Template residue, filler, error pages and script notices in place of text.

Three character n-gram models are fitted: filler and messages (errors, notices),
each on the public phrases below, and natural prose, counted over all texts at hand.
The log-likelihood ratio of the better residue model over prose, averaged over short
windows, localises residue; a unit (a line or sentence) is residue if such windows
cover most of it, so that prose which quotes or reports a message is not. A unit
that mostly repeats its own words is filler as well, whatever the words. Placeholders
and values that were never filled in are residue wherever they stand outside quotes.
"""

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 18
#: Characters in a window; mean log ratio from which it is residue; covered share from which a unit is.
WINDOW, RATIO, COVERAGE = 12, 0.6, 0.6
#: Grams that a unit must have to be judged.
LEAST_GRAMS = 4
#: Share of a unit's words that stood in it before, from which it is filler, and words it must have.
REPEATED, LEAST_WORDS = 0.55, 5
#: Share of grams known to the residue models from which a unit is no prose to learn from;
#: grams that prose counts as having at least.
FOREIGN, FLOOR = 0.75, 1_000_000
#: Characters that go through the arrays at once; more only if one text is longer.
CHUNK = 300_000
#: Scores of an n-gram that the residue models don't know, seen in prose or not, and bounds of all others.
UNKNOWN, UNSEEN, LOW, HIGH = -2.0, -1.1, -3.0, 3.0

# Training phrases of the residue models, by model: public filler text and the wordings that servers,
# browsers, languages and editors commonly show.
SEEDS = {
    "filler": [
        "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
        "Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam, eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo.",
        "Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt.",
        "Neque porro quisquam est, qui dolorem ipsum quia dolor sit amet, consectetur, adipisci velit, sed quia non numquam eius modi tempora incidunt.",
        "At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores et quas molestias excepturi sint occaecati cupiditate non provident.",
        "Temporibus autem quibusdam et aut officiis debitis aut rerum necessitatibus saepe eveniet ut et voluptates repudiandae sint et molestiae non recusandae.",
        "Gallia est omnis divisa in partes tres, quarum unam incolunt Belgae, aliam Aquitani, tertiam qui ipsorum lingua Celtae, nostra Galli appellantur.",
        "Vivamus sagittis lacus vel augue laoreet rutrum faucibus dolor auctor. Maecenas faucibus mollis interdum. Cras justo odio, dapibus ac facilisis in, egestas eget quam. Integer posuere erat a ante venenatis.",
        "Pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas. Vestibulum tortor quam, feugiat vitae, ultricies eget, tempor sit amet, ante.",
        "Type your text here. Enter text here. Your content goes here. Add a title. Add your heading here. Click to edit text. Put the article body here. Insert headline here. Insert a caption. Write something here.",
        "Placeholder text. Sample text. Example text. Dummy text. Filler text. Replace this text. To be replaced before publishing. Draft, do not publish. To be announced. Coming soon. TODO TBD FIXME",
        "This is a test. Test post, please ignore. testing testing 123. asdf asdf jkl; qwerty uiop. foo bar baz. xxx xxxx. blah blah blah",
        "Untitled. Untitled document. Untitled page. New document. No title. No content. No subject. Unnamed. Untitled 1. Untitled-1",
        "텍스트를 입력해 주세요. 여기에 텍스트를 추가하세요. 여기에 글을 작성하세요. 이곳에 내용을 입력하세요. 제목을 입력해 주세요. 본문을 입력해 주세요. 본문을 작성하세요. 부제목을 입력하세요. 설명을 입력하세요. [이름을 입력하세요] [날짜를 입력하세요]",
        "편집 전 확인 바람. 마감 전 교체 바랍니다. 원고 교체 바람. 이 자리에 글이 들어갑니다. 이곳은 본문이 들어가는 자리입니다. 설명이 들어갈 자리입니다. 자리를 채우는 글입니다. 글자 수를 맞추기 위한 글입니다. 분량을 채우기 위한 예시 문장입니다. 자리 표시자입니다. 자리 표시용 글. (자리 채움)",
        "임시 글입니다. 임시 제목입니다. 임시 본문입니다. 임시 저장. 임시 원고입니다. 발행 전에 교체하세요. 게시 전 바꿀 것. 교체 필요. 추후 입력. 추후 수정 예정. 작성 중인 글입니다. 초안입니다. 준비 중입니다.",
        "테스트 글입니다. 테스트입니다. 시험용 글입니다. 샘플입니다. 샘플 텍스트입니다. 예시 텍스트입니다. 더미 텍스트. 견본 문장입니다. 보기 문장",
        "제목 없는 문서. 제목 미정. 무제. 제목이 없습니다. 내용이 없습니다. 본문이 없습니다. 등록된 내용이 없습니다. 제목없음. 새 문서. 이름 없음",
        "○○○ 씨는 △△△ 회의에서 □□□를 발표했다. ○○○ △△△ □□□ ◇◇◇ ●●● ▲▲▲ ■■■ ××× [작성일] [제목] [이름] [날짜] [본문] [매체명]",
        "가나다라마바사아자차카타파하 가나다 abc 123 ㄱㄴㄷㄹ ㅁㄴㅇㄹ ㅂㅈㄷㄱ ㅋㅌㅊㅍ ㅏㅑㅓㅕ 아무 글자나 쓴 것",
        "ここにテキストを入力してください。タイトルを入力してください。サンプルテキストです。ダミーテキスト。本文がここに入ります。準備中です。 在此处输入文字。请输入标题。示例文本。占位文字。",
        "Hier steht ein Beispieltext. Hier Text eingeben. Überschrift eingeben. Dies ist ein Typoblindtext. Saisissez votre texte ici. Texte d'exemple. Ajoutez un titre. Escriba su texto aquí. Texto de ejemplo.",
        "undefined", "null", "NaN", "None", "[object Object]", "Invalid Date", "#N/A", "#REF!", "undefined undefined", "null null", "NaN NaN",
    ],
    "message": [
        "400 Bad Request. 401 Unauthorized. 402 Payment Required. 403 Forbidden. 404 Not Found. 406 Not Acceptable. 407 Proxy Authentication Required. 408 Request Timeout. 409 Conflict. 410 Gone. 413 Content Too Large. 415 Unsupported Media Type. 429 Too Many Requests.",
        "500 Internal Server Error. 501 Not Implemented. 502 Bad Gateway. 503 Service Unavailable. 504 Gateway Timeout. 505 HTTP Version Not Supported. 507 Insufficient Storage. HTTP Error 500. HTTP Status 400. Error code 403. Error 410. HTTP 451",
        "The requested URL was not found on this server. The server encountered an internal error or misconfiguration and was unable to complete your request. The server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later.",
        "Page not found. The page cannot be found. We can't find the page that you requested. Sorry, this page isn't available. This page does not exist. The link you followed may be broken, or the page may have been removed. The article could not be loaded. Go back to the home page.",
        "You are not authorized to view this page. You do not have permission to access this resource on this server. Access to this page is forbidden. Access is denied. Access blocked. Your IP address has been blocked. Your request was blocked by the firewall. Permission denied. Incident number. Reference number.",
        "Could not establish a connection to the database. Error while connecting to the database server. Unable to connect to the database. Database error. Too many connections. Query failed. Deadlock found. Connection reset by peer. Connection refused. The connection has timed out. The upstream server timed out. No healthy upstream. Upstream prematurely closed the connection. The host did not respond in time. No answer from the server in due time",
        "PHP Warning: require_once(config.php): failed to open stream: No such file or directory in /home/user/public_html/index.php on line 12. Fatal error: Call to undefined function in /var/www/site/view.php on line 4. Notice: Undefined index in template. Parse error: syntax error, unexpected end of file. Allowed memory size exhausted",
        "java.lang.IllegalStateException: null at com.example.app.Controller.show(Controller.java:41) at java.base/java.lang.Thread.run(Thread.java:833) Caused by: java.io.IOException: Broken pipe. Exception in thread main java.lang.RuntimeException. NullPointerException. java.lang.NullPointer. Servlet threw exception. org.apache.jasper.JasperException. Template.render(Template.java)",
        "Traceback (most recent call last): File \"app.py\", line 3, in render. KeyError: 'title'. ValueError: invalid literal. TypeError: Cannot read properties of null (reading 'length'). ReferenceError: x is not defined. Uncaught SyntaxError: Unexpected token. Segmentation fault (core dumped). Stack trace. Fatal error. Error near line. Warning: include() failed. Unhandled exception at line. Runtime error",
        "SQLSTATE[42S02]: Base table or view not found. SQL syntax error. ORA-00942: table or view does not exist. ERR_CONNECTION_REFUSED. ERR_NAME_NOT_RESOLVED. ERR_CERT_DATE_INVALID. DNS_PROBE_FINISHED_NXDOMAIN. net::ERR_ABORTED. This site can't be reached. This page isn't working. The page isn't redirecting properly. redirected you too many times.",
        "Enable JavaScript and reload the page. This site requires JavaScript to function properly. JavaScript appears to be turned off. JavaScript must be enabled in your browser. Please turn on JavaScript and cookies, then continue. You have to allow scripts in your browser to read the article. Scripts are disabled. Scripting is not supported by the browser. Turn on scripts to view the page. <noscript> JavaScript is required.",
        "Your browser is out of date. Please use a different browser. Your browser does not support this feature. Cookies are disabled. This website uses cookies, please enable them to continue. You need to sign in to view this page. Subscribe to continue reading. This content is not available in your region.",
        "Checking if the site connection is secure. Verify you are human by completing the action below. One moment, please... Just a second... Please wait a moment while we check your browser. Are you a robot? Unusual traffic from your network has been detected. Complete the captcha to continue. Performance and security. Ray ID. Loading, please wait... Redirecting...",
        "페이지를 표시할 수 없습니다. 요청한 페이지가 존재하지 않습니다. 찾으시는 페이지가 없습니다. 페이지를 찾지 못했습니다. 페이지 없음. 페이지를 찾을 수 없음. 주소를 다시 확인해 주세요. 입력하신 주소가 올바르지 않거나 변경되었습니다. 홈으로 돌아가기. 메인 화면으로 이동해 주십시오. 이전 페이지로 돌아가세요.",
        "해당 기사를 찾을 수 없습니다. 삭제된 게시물입니다. 존재하지 않는 게시물입니다. 삭제되었거나 없는 글입니다. 잘못된 번호입니다. 요청하신 기사가 삭제되었습니다. 이동되거나 사라진 화면입니다. 원하시는 글이 없습니다. 번호가 없거나 바뀐 글입니다. 죄송합니다만 볼 수 없는 글입니다.",
        "서버에 연결할 수 없습니다. 서버에서 응답이 없습니다. 서버의 응답을 받지 못했습니다. 내부 오류가 발생했습니다. 알 수 없는 오류가 발생했습니다. 오류로 인해 화면을 불러오지 못했습니다. 기사를 불러오지 못했습니다. 데이터를 가져오는 데 실패했습니다. 데이터베이스에 접속하지 못했습니다. DB 연결 실패. 네트워크 연결에 실패하였습니다. 데이터베이스 오류. 서버가 요청에 응답하지 않아 연결을 끝냅니다. 연결이 끊어졌습니다. 오류 번호. 오류 코드. 요청 시간이 초과되었습니다. 나중에 다시 시도하십시오. 잠시 뒤 다시 접속해 주십시오.",
        "세션이 종료되었습니다. 로그인 시간이 만료되었습니다. 다시 접속해 주세요. 권한이 없습니다. 로그인 후 이용하세요. 이용 권한이 없는 사용자입니다. 접속이 제한되었습니다. 접근이 거부되었습니다. 접근할 수 없는 화면입니다. 비정상적인 요청이 확인되어 접속을 제한합니다. 보안상 차단된 요청입니다. 고객센터로 문의하세요. 자동화된 접근이 감지되었습니다.",
        "시스템 점검으로 서비스를 이용할 수 없습니다. 정기 점검 안내. 지금은 점검 시간입니다. 점검 중이니 나중에 이용해 주세요. 점검 시간: 오전 2시부터. 서비스가 일시 중단되었습니다. 서비스를 준비하고 있습니다. 접속자가 많아 연결이 지연되고 있습니다.",
        "자바스크립트를 사용하도록 설정하세요. 자바스크립트 사용을 허용해 주십시오. 자바스크립트가 비활성화되어 있습니다. 자바스크립트를 켜야 화면을 볼 수 있습니다. 페이지를 보시려면 스크립트를 허용해 주세요. 사용 중인 브라우저에서 스크립트 실행이 차단되어 있습니다. 스크립트를 쓸 수 없는 브라우저입니다. 스크립트 기능을 켠 뒤 다시 여세요. 브라우저의 스크립트가 꺼져 있습니다. 꺼져 있어 내용을 표시할 수 없습니다. 이 브라우저는 지원되지 않습니다. 크롬이나 다른 브라우저로 접속해 주세요. 쿠키를 사용하도록 설정하십시오.",
        "로딩 중입니다. 로딩중... 불러오는 중입니다. 화면을 여는 중... 본문을 읽어 오는 중입니다. 잠시만 기다려 주십시오. 이동 중입니다. 사람인지 확인이 필요합니다. 로봇이 아님을 확인해 주세요.",
        "ページを表示できません。お探しのページは削除されたか移動しました。アクセスが拒否されました。サーバーエラーが発生しました。しばらくしてから再度お試しください。このサイトを利用するにはJavaScriptを有効にしてください。メンテナンス中です。 ページが存在しません。見つかりませんでした。",
        "页面不存在。您访问的页面已被删除。无法显示此网页。访问被拒绝。服务器内部错误。请稍后再试。请在浏览器中启用JavaScript。网络连接超时。系统维护中。抱歉，找不到您要的页面。",
        "Die angeforderte Seite wurde nicht gefunden. Zugriff verweigert. Interner Serverfehler. Diese Seite benötigt JavaScript. JavaScript ist in Ihrem Browser deaktiviert, bitte schalten Sie es ein. Bitte versuchen Sie es später erneut. Wartungsarbeiten. Aktivieren Sie Cookies, um fortzufahren.",
        "La page demandée est introuvable. Accès refusé. Erreur interne du serveur. Veuillez activer JavaScript dans votre navigateur. Veuillez réessayer plus tard. Página no encontrada. Acceso denegado. Error interno del servidor. Active JavaScript en su navegador para continuar. Inténtelo de nuevo más tarde.",
        "ไม่พบหน้าที่คุณต้องการ เกิดข้อผิดพลาดของเซิร์ฟเวอร์ กรุณาเปิดใช้งาน JavaScript กรุณาลองใหม่ภายหลัง पृष्ठ नहीं मिला। सर्वर में त्रुटि हुई। कृपया जावास्क्रिप्ट चालू करें। कृपया बाद में पुनः प्रयास करें।",
    ],
}

# Plain prose that the prose model always holds, whatever the texts.
PROSE = [
    "The committee voted to delay the motion after a long debate, and several members asked for more time to read the report.",
    "Residents near the harbor signed a petition against the new bus route, while shop owners said that the plan would help them.",
    "She told reporters that the budget would not change this year, because the figures were incomplete and the talks had stalled.",
    "According to the survey, about half of those asked support the bill; the minister answered that the government would review it.",
    "He paused, then the council chose to reject the draft. We must choose by May, said the chair of the panel. Can they really do it?",
    "Under the law the board may withdraw any permit within thirty days at the request of residents or without a formal vote.",
    "위원회는 오랜 논의 끝에 표결을 미루기로 했고 의원들은 자료를 더 살펴볼 시간을 달라고 요구했다.",
    "주민들은 새 노선에 반대하는 서명을 냈으며 상인들은 계획이 도움이 될 것이라고 말했다.",
    "The bank apologised on Tuesday after a fault in its servers left customers unable to reach their accounts for most of the day.",
    "Engineers traced the outage to a database that had run out of space, the company wrote in a report published last week.",
    "The ministry's website could not be reached for an hour because too many people had tried to open the page at once.",
    "Police were denied access to the archive until a judge signed the request, and the files were not found until the spring.",
    "The firm plans to enable scripts and cookies only for visitors who agree, a change that browser makers have asked for since 2019.",
    "A spokeswoman said that maintenance of the network would continue through the night and that services should be available by morning.",
    "Hackers blocked the hospital's system and demanded money; doctors wrote notes on paper until the connection was restored.",
    "Readers had complained that links on the old site led nowhere, so the editors removed them and wrote a new page for each story.",
    "Students learn to write programs in the course, and their teacher said that an error message is the best way to find out what went wrong.",
    "The library asks visitors to wait a moment at the gate while guards check their bags, and to return books before they travel.",
    "Nothing in the box was of value, but the title on the first page of the book had been written by hand in Latin.",
    "The museum will be closed to visitors on Sunday while workers repair the bridge, the city said, and the road is to open again in May.",
    "A note on the door said that the guide would come back, and the children went through the hall without permission to look for him.",
    "Trains did not run on two nights while cables were laid, and passengers who had found no seat were asked to travel later in the week.",
    "The term comes from the lawyers of that time, who used it for a contract that had been void for years before the court heard it.",
    "은행은 서버 장애로 고객들이 하루 내내 계좌를 열지 못했다며 사과했고, 원인을 조사하고 있다고 밝혔다.",
    "업체는 데이터베이스 용량이 부족해 오류가 발생했다고 설명했지만 이용자들은 보상을 요구했다.",
    "접속자가 한꺼번에 몰리면서 누리집이 한 시간 동안 열리지 않았고 예매를 하지 못한 시민들의 불만이 이어졌다.",
    "연구진은 자바스크립트로 만든 교재를 학교에 나눠 주고 교사 연수도 늘릴 계획이라고 말했다.",
    "해커가 병원 시스템에 몰래 접근해 자료를 지운 사실이 드러나자 경찰이 수사에 나섰다.",
    "시는 안전 점검 결과에 따라 다리 통행을 막고 보수 공사를 시작했으며 주민들은 우회로를 요구했다.",
    "서비스업 일자리가 줄어든 것으로 나타났고 정부는 지원 예산을 늘리는 방안을 검토하고 있다.",
    "그는 책의 첫 페이지에 제목 대신 짧은 글을 남겼고, 독자들은 그 문장을 오래 기억했다.",
    "브라우저를 만드는 회사들이 쿠키 정책을 바꾸면서 광고 시장이 흔들리고 있다는 분석이 나왔다.",
    "통신사는 점검 시간에 연결이 끊긴 가입자에게 요금을 돌려주기로 했고, 민원은 사흘째 이어졌다.",
    "법원은 자료 접근 권한이 없는 직원이 기록을 열람한 것은 잘못이라고 판단해 40대 남성에게 벌금을 물렸다.",
    "구청은 이전 작업이 늦어져 처리가 밀렸다고 설명했고, 개발자들은 교육 과정이 부족하다고 지적했다.",
    "박물관은 기증받은 그림 석 점을 전시하면서 작가의 이름이 알려지지 않았다고 소개했다.",
    "시스템을 비정상적으로 쓴 혐의로 조사를 받던 업체 대표는 잠시 뒤 다시 부르겠다는 말만 들었다고 전했다.",
]
# The ways in which template engines mark a slot.
SLOT = re.compile(
    r"\{\{\s*[^{}\n]+\}\}|\{%-?\s*[^{}\n]+%\}|<%[=-]?\s*[^<>\n]+%>|\$\{[^{}\n]+\}|#\{[^{}\n]+\}|\{\$[^{}\n]+\}|\{[a-z][a-z0-9]*(?:[_.][a-z0-9]+)*\}"
    r"|@@[\w.-]+@@|(?<!\w)__[^\W_][\w.]*__(?!\w)|\[\[[^\[\]\n]+\]\]|(?<![\d%\w])%%?[^\W\d][\w.]*%%?(?!\w)"
)
_SLOT_MARKS = ("{", "<%", "@@", "__", "[[", "%")
# What languages and spreadsheets write for a value that isn't there.
VALUE = re.compile(r"\[object object\]|invalid date|#n/a|#ref!|#value!|(?<![\w-])(?:undefined|null|nan|none)(?![\w])(?:-nan)*")
_VALUE_MARKS = ("undefined", "null", "nan", "none", "[object", "invalid d", "#n/a", "#ref", "#val")
_QUOTES = {"'": "'", '"': '"', "‘": "’", "“": "”", "「": "」", "『": "』", "《": "》", "`": "`"}
#: Numbers and mixed identifiers, which say nothing.
_IDS = re.compile(r"(?<![^\W_])[a-z]*[0-9][a-z0-9]*")
_UNITS = re.compile(r"[\r\n\x0b\x0c\x85\u2028\u2029]+|(?<=[.?!。])\s+")


def open_slot(text: str) -> bool:
    """Whether a slot that was never filled in stands in the text, outside quotes."""
    if not any(m in text for m in _SLOT_MARKS):
        return False
    for m in SLOT.finditer(text):
        a, b = text[: m.start()].rstrip(), text[m.end() :].lstrip()
        if not (a and b and _QUOTES.get(a[-1]) == b[0]):
            return True
    return False


def open_values(unit: str) -> bool:
    """Whether a unit is a value that was never filled in, or holds two or more outside quotes and not within Latin prose."""
    if VALUE.fullmatch(unit):
        return True
    n = 0
    for m in VALUE.finditer(unit):
        a, b = unit[: m.start()].rstrip(), unit[m.end() :].lstrip()
        if not (a and b and _QUOTES.get(a[-1]) == b[0]) and not (a[-1:].isascii() and a[-1:].isalpha()) and not (b[:1].isascii() and b[:1].isalpha()):
            n += 1
    return n > 1


def repeated_words(unit: str) -> bool:
    """Whether most words of a unit stood in it before."""
    words = unit.split()
    return len(words) >= LEAST_WORDS and len(words) - len(set(words)) >= REPEATED * len(words)


def _normal(text: str) -> str:
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()


class _Grams:
    """n-grams of many texts at once: hashes, script and the unit each belongs to.

    Five characters of plain Latin text, three of any other.
    """

    def __init__(self, units: list[str]):
        joined = _IDS.sub("0", "\n".join(units)) + "\n" * 5
        c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        digit, end, wide = (c >= 48) & (c <= 57), c == 10, c >= 128
        n = len(c) - 4
        view = lambda x, k: x[k : k + n]
        any_of = lambda x, m: np.logical_or.reduce([view(x, k) for k in range(m)])
        mix = view(c, 0) * np.uint32(2654435761) ^ (view(c, 1) * np.uint32(2246822519) << np.uint32(1)) ^ (view(c, 2) * np.uint32(3266489917) << np.uint32(2))
        more = mix ^ (view(c, 3) * np.uint32(668265263) << np.uint32(3)) ^ (view(c, 4) * np.uint32(374761393) << np.uint32(4)) ^ np.uint32(2166136261)
        self.latin = ~any_of(wide, 3)
        long = self.latin & ~any_of(end, 5) & ~any_of(digit, 5) & ~any_of(wide, 5)
        h = np.where(long, more, mix)
        self.hash = (h ^ (h >> np.uint32(15))) & np.uint32((1 << BITS) - 1)
        #: Grams over the end of a unit or with a digit say nothing.
        self.void = any_of(end, 3) | any_of(digit, 3)
        self.ends = np.flatnonzero(view(end, 0))[: len(units)]


def gram_counts(units: list[str], known: np.ndarray | None = None) -> np.ndarray:
    """Counts by script: row 0 plain Latin, row 1 any other.

    Units of which ``FOREIGN`` or more of the grams are ``known`` to the residue
    model don't count, so that an error page that makes up a large part of the
    texts doesn't come to be prose.
    """
    if not units:
        return np.zeros((2, 1 << BITS), np.int64)
    t = _Grams(units)
    use = ~t.void
    if known is not None:
        starts = np.concatenate([[0], t.ends[:-1] + 1])
        size = np.concatenate([[0], np.cumsum(use)])
        hits = np.concatenate([[0], np.cumsum(use & known[t.hash])])
        bad = hits[t.ends] - hits[starts] >= FOREIGN * np.maximum(size[t.ends] - size[starts], 1)
        drop = np.zeros(len(use), bool)
        span = t.ends - starts + 1
        drop[: span.sum()] = np.repeat(bad, span)
        use &= ~drop
    return np.stack([np.bincount(t.hash[use & (t.latin == k)], minlength=1 << BITS) for k in (True, False)])


@lru_cache(maxsize=1)
def _seed_counts() -> np.ndarray:
    """Counts of the two residue models, by model and script; a phrase more often said counts no more than four times."""
    return np.stack([np.minimum(gram_counts([u for x in phrases for u in _UNITS.split(_normal(x)) if u]), 4) for phrases in SEEDS.values()])


def ratio_table(prose: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of every n-gram, the better residue model over prose, each within its script."""
    prose = prose + 20 * gram_counts([_normal(x) for x in PROSE])
    best = np.full(1 << BITS, -np.inf)
    for model in _seed_counts():
        for seed, count in zip(model, prose, strict=True):
            p = (seed + 0.05) / (seed.sum() + 0.05 * max(1, np.count_nonzero(seed)))
            # few texts leave most of prose unseen: they count as part of FLOOR grams
            q = (count + 0.5) / (max(count.sum(), FLOOR) + 0.5 * max(1, np.count_nonzero(count)))
            best = np.where(seed > 0, np.maximum(best, np.clip(np.log(p / q), LOW, HIGH)), best)
    return np.where(np.isfinite(best), best, np.where(prose.sum(0) > 0, UNKNOWN, UNSEEN)).astype(np.float32)


def unit_coverage(units: list[str], table: np.ndarray) -> np.ndarray:
    """Share of each unit that windows of residue cover; nothing of units with too few grams to tell."""
    t = _Grams(units)
    s = np.where(t.void, 0, table[t.hash]).astype(np.float64)
    use = ~t.void
    cs, cu = np.concatenate([[0], np.cumsum(s)]), np.concatenate([[0], np.cumsum(use)])
    n = len(s)
    starts = np.concatenate([[0], t.ends[:-1] + 1])
    unit_end = np.repeat(t.ends, t.ends - starts + 1)  # end of the unit of each position
    unit_end = np.concatenate([unit_end, np.full(n - len(unit_end), n)])
    at = np.arange(n)
    unit_start = np.concatenate([np.repeat(starts, t.ends - starts + 1), np.full(n - len(np.repeat(starts, t.ends - starts + 1)), n)])
    stop = np.minimum(at + WINDOW, unit_end)
    begin = np.maximum(np.minimum(at, stop - WINDOW), unit_start)
    weight = np.maximum(cu[stop] - cu[begin], 1)
    hot = (cs[stop] - cs[begin] > RATIO * weight) & (cu[stop] > cu[begin])
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin[hot], 1)
    np.add.at(edge, stop[hot], -1)
    covered = (np.cumsum(edge[:-1]) > 0) & use
    cc = np.concatenate([[0], np.cumsum(covered)])
    total = cu[t.ends] - cu[starts]
    return np.where(total >= LEAST_GRAMS, (cc[t.ends] - cc[starts]) / np.maximum(total, 1), 0.0)


def flags(texts: list[str | None], table: np.ndarray) -> np.ndarray:
    """Whether each text holds residue; NULL, empty and blank texts do not."""
    out = np.zeros(len(texts), bool)
    units, owner, size = [], [], 0

    def settle() -> None:
        if units:
            out[np.array(owner)[unit_coverage(units, table) >= COVERAGE]] = True
        units.clear()
        owner.clear()

    for i, raw in enumerate(texts):
        if not raw or raw.isspace():
            continue
        text = _normal(raw)
        if open_slot(text):
            out[i] = True
            continue
        valued = any(m in text for m in _VALUE_MARKS)
        for u in _UNITS.split(text):
            u = u.strip()
            if u:
                if repeated_words(u) or (valued and open_values(u)):
                    out[i] = True
                    break
                units.append(u)
                owner.append(i)
                size += len(u)
        if size > CHUNK:
            settle()
            size = 0
    settle()
    return out


def fit_prose(articles: DataFrame, columns: tuple[str, ...] = ("title", "content")) -> np.ndarray:
    """n-gram counts over all texts, by script.

    Every task counts its texts in one table and hands over the grams it has seen, at
    most 2^19; these are summed in partial aggregates, and one table of sums, of fixed
    size, goes to the driver. The counts may be kept and given to ``with_residue``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros((2, 1 << BITS), np.int64), _seed_counts().sum((0, 1)) > 0
        for batch in batches:
            for c in batch.columns:
                units, size = [], 0
                for x in c.to_pylist():
                    units += [u for u in _UNITS.split(_normal(x)) if u and not repeated_words(u)] if x else []
                    size += len(x or "")
                    if size > CHUNK:
                        total += gram_counts(units, known)
                        units, size = [], 0
                total += gram_counts(units, known)
        flat = total.ravel()
        seen = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(flat[seen])], names=["slot", "n"])

    sums = articles.select(*columns).mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 << BITS, np.int64)
    total[np.asarray(sums["slot"])] = np.asarray(sums["n"])
    return total.reshape(2, -1)


def with_residue(articles: DataFrame, columns: tuple[str, ...] = ("title", "content"), prose: np.ndarray | None = None) -> DataFrame:
    """Add ``residue``: a struct with one flag per text column.

    ``prose`` holds counts of ``fit_prose``, of these texts or of others; without it they
    are taken over these texts. The flag is true if the field holds an open slot or value, filler, an error
    message or a notice that scripts or access are needed. NULL, empty and blank
    fields give false; prose that quotes such messages gives false. Rows come out
    as they came in, copies and NULL rows included; an empty table stays empty.
    """
    table = ratio_table(fit_prose(articles, columns) if prose is None else prose)
    shared = articles.sparkSession.sparkContext.broadcast(table)
    kind = T.StructType([T.StructField(c, T.BooleanType(), False) for c in columns])

    def run(*series: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({c: flags([x if isinstance(x, str) else None for x in s], shared.value) for c, s in zip(columns, series, strict=True)})

    return articles.withColumn("residue", F.pandas_udf(run, kind)(*map(F.col, columns)))


def found_residue(articles: DataFrame) -> DataFrame:
    """``row_id`` of every row whose title or content is residue."""
    return with_residue(articles).where("residue.title or residue.content").select("row_id")
