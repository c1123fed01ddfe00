"""Fixed values of the Korean exam profile: patterns, weights, expected counts.

Every value here has to be what it is for right results. Patterns are in
Spark's dialect behind functions.text.U, which makes them behave as Unicode
patterns with \\n line ends.
"""

from __future__ import annotations

# Patterns of elements.
END = r"^[\"'“”‘’]*끝[\"'“”‘’.]*\s*$"
ROMAN_I = r"^I\.\s+.{3,}"
ROMAN_BEYOND = r"^(?:II|III|IV|V|VI|VII|VIII|IX|X)\.\s"
MENTI = r"(?s)^문\s*제\s+(\d{1,2})\.\s+(.+)"
STD_NUM = r"^(\d{1,2})\.\s+(.{5,})"
SESSION = r"제?\s*(\d)\s*교시"
IGNORE_NUMBER = r"^\d+$"
IGNORE_WORDS = r"Copyright|FB\d{2}|주간모의|^※|^다음 문제|문제를 선택|누구나 ICT|cafe\.naver|All rights|기출풀이 의견"
COVER = r"국가기술자격|기술사\s*시험문제"
COVER_CAPTION = r"기술사.*제\s*\d+\s*회.*제\s*(\d)\s*교시"
NOISE = r"출제\s*빈도|출제\s*비율|도메인\s*별\s*출제|^\[참고\]|교시형\s*출제|출제\s*경향|감사의?\s*글|기출\s*풀이집"
TOPIC_END = r"^기출풀이\s*의견$"
STAR = r"★[★☆]{1,4}"
MARKER = r"^[□■◇◆●○▶►▷]\s*.{3,}"
SESSION_TOPIC = r"(\d)\s*교시\s*[:\s]*(\d+)\s*번"
QUESTION = r"설명하시오|논하시오|서술하시오|비교하시오|구분하시오|기술하시오|설명하고|논하고|비교하고|이다\.|하시오\.|있다\."
DAY = r"(\d+)\s*일차"
HEADER_KW = r"(?s)IT\s*trends\s+(.+?)(?:\s*\|\s*PM|\s+PM\s)"
KR_SUB = r"^([가나다라마바사아])\.\s+(.{5,})"
KR_ORDER = "가나다라마바사아"

# Patterns of the format ladder.
KPC_PROBLEM = r"^문\s*제$"
KPC_OPINION = r"기출\s*풀이\s*의견"
KPC_HEADER = r"KPC\s*기술사"
ITPE_END = r"^[“”\"']?끝[“”\"']?\s*$"
ITPE_META = r"도메인|난이도|출제자|출제배경|참고문헌|키워드"
ITPE_LABEL = r"^(?:도메인|난이도|키워드|출제배경|출제자|해설자|참고문헌)$"
INFOLEVER = r"관리\s*\d\s*교시"
AIRIPO_MOCK = r"실전\s*모의고사\s*문제"
AIRIPO_MORE = r"뒷\s*페이지\s*에?\s*계속"
BRACKET = r"^\[\d+-\d+\]"
FORMAT_COVER = r"국가기술자격|기술사\s*시험문제|시험시간|100\s*분|문제를?\s*선택하여|다음\s*문제\s*중"
ITPE_COVER = r"국가기술자격|기술사\s*시험문제|시험시간\s*:\s*100\s*분|문제를?\s*선택하여|다음\s*문제\s*중"
ITPE_SELECT = r"선택\s*문제"
KPC_NOISE = r"출제\s*빈도|출제\s*비율|도메인\s*별\s*출제|출제\s*경향|감사의?\s*글|기출\s*풀이집"
AIRIPO_SESSION = r"관리\s*[-‒–—]?\s*(\d)\s*교시"
STAR_START = r"^★[★☆]{1,4}"

# Titles of topics, and lines that are none.
NUMBER_HEADING = r"^\d+\s*번$"
QUESTION_META = r"^(?:도메인|난이도|키워드|출제배경|참고문헌|해설자)$"
JE_NUM = r"^제\s*(\d{1,2})\.\s*(.{3,})"
KPC_BRAND = r"누구나\s*ICT|cafe\.naver|정보처리기술사\s*기출풀이|ICT의\s*가치를?\s*이끄는|All\s*rights"
KPC_META = r"^(?:역|난이도|경|도|료)\s"
KPC_NUMBERS = 13
AIRIPO_BRAND = r"Copyright.*아이리포|아이리포\s*HR|아이리포\s*기술사회|SW\s+DB\s+CA|IT\s*trends|Big\s*&?\s*Up"
AIRIPO_BAR = r"SW\s+DB\s+CA|IT\s*trends|AI/Bigdata"
AIRIPO_LABEL = r"^(?:page|출제영역|핵심키워드|상/중/하)$"
AIRIPO_CONTINUED = r"뒷\s*페이지\s*에?\s*계속|앞\s*페이지\s*에서?\s*계속"

# Pieces of which every match of a pattern holds one. They are looked for before the pattern is: of most texts that is all there is to do. Those of patterns that are only looked for in texts without blanks (brands) have none.
NEEDS = {
    END: ("끝",),
    ROMAN_I: ("I.",),
    MENTI: ("문",),
    SESSION: ("교시",),
    IGNORE_WORDS: ("Copyright", "FB", "주간모의", "※", "다음 문제", "문제를 선택", "누구나 ICT", "cafe.naver", "All rights", "기출풀이 의견"),
    COVER: ("국가기술자격", "기술사"),
    COVER_CAPTION: ("기술사",),
    NOISE: ("출제", "[참고]", "감사", "기출"),
    TOPIC_END: ("기출풀이",),
    STAR: ("★",),
    SESSION_TOPIC: ("교시",),
    QUESTION: ("시오", "이다.", "있다.", "설명하고", "논하고", "비교하고"),
    DAY: ("일차",),
    HEADER_KW: ("trends",),
    KPC_PROBLEM: ("문",),
    KPC_OPINION: ("풀이",),
    KPC_HEADER: ("기술사",),
    ITPE_END: ("끝",),
    ITPE_META: ("도메인", "난이도", "출제", "참고문헌", "키워드"),
    ITPE_LABEL: ("도메인", "난이도", "키워드", "출제", "해설자", "참고문헌"),
    INFOLEVER: ("교시",),
    AIRIPO_MOCK: ("모의고사",),
    AIRIPO_MORE: ("계속",),
    FORMAT_COVER: ("국가기술자격", "기술사", "시험시간", "분", "선택하여", "다음"),
    ITPE_COVER: ("국가기술자격", "기술사", "시험시간", "선택하여", "다음"),
    ITPE_SELECT: ("선택",),
    KPC_NOISE: ("출제", "감사", "풀이집"),
    AIRIPO_SESSION: ("교시",),
    STAR_START: ("★",),
    NUMBER_HEADING: ("번",),
    QUESTION_META: ("도메인", "난이도", "키워드", "출제배경", "참고문헌", "해설자"),
    JE_NUM: ("제",),
    KPC_BRAND: ("누구나", "cafe.naver", "정보처리기술사", "가치", "Allrights"),
    AIRIPO_BRAND: ("아이리포", "SWDB", "ITtrends", "Big"),
    AIRIPO_BAR: ("SW", "trends", "Bigdata"),
    AIRIPO_LABEL: ("page", "출제영역", "핵심키워드", "상/중/하"),
    AIRIPO_CONTINUED: ("계속",),
}

# Patterns of lines.
NUM_ONLY = r"^(\d{1,2})\.?$"
NUM_TOPIC = r"^(?:제\s+)?(\d{1,2})\.\s+(.+)$"
NUM_BUN = r"^(\d{1,2})\s*번\.?$"
SESSION_LINE = r"^제\s*([1-4])\s*교시"
SESSION_SHORT = r"^([1-4])\s*교시$"
PROBLEM_LINE = r"^(?:문|제|문제|문\s+제)$"
DOMAIN_LINE = r"^(?:도메인|출제영역|난이도|키워드|출제배경|참고문헌|출제자)$|^출제영역\s+.+$"
DOMAIN_LABEL = r"^(?:도메인|출제영역|난이도|키워드|출제배경|참고문헌|출제자)$"
SELECT_LINE = r"\[\s*(?:관리|응용|정보관리|컴퓨터시스템응용)\s*(?:선택|기술사)\s*\]"
ROMAN_LINE = r"^[ⅠⅡⅢⅣⅤIVX]+\."
COPYRIGHT = r"(?i)Copyright\s*[ⓒ©c\*]"
PAGE_NUMBER = r"^[\-\s]*(?:\d{1,3}|PAGE(?:\s*\d*)?)[\-\s]*$"
PAPER_WORDS = r"시험시간|국가기술자격|수험"
BRAND = (
    r"(?i)누구나\s*ICT|cafe\.naver|youtube|tistory|ITPE\s*\(|Copyright\s*[ⓒ©*c]"
    r"|제\s*\d+\s*회.*?(?:해설집|해설|기출문제해설집|모의고사|기출풀이)|^제?\s*\d+\s*회$|제\s*\d+\s*회\s*정보\s*(?:관리|처리)?\s*기술사"
    r"|All\s*rights?\s*reserved|KPC\s*기술사.*?IMPACT|ITPE.*?실전\s*명품|기출\s*(?:문제|해설|풀이)\s*(?:집|해설집)?"
    r"|인포레버컨설팅|Big&Up|여울동기회|두드림동기회|그루터기동기회|ICT\s*의?\s*가치를?\s*이끄는|한국생산성본부"
    r"|^https?://|010-\d{4}-\d{4}|@[\w\.]+\."
)
BRAND_PIECE = r"^(?:kpc|ICT의|가치를|이끄는|사람|한국생산성본부)$"

NEEDS |= {DOMAIN_LINE: ("도메인", "출제", "난이도", "키워드", "참고문헌"), SELECT_LINE: ("[",), PAPER_WORDS: ("시험시간", "국가기술자격", "수험")}

# What the first five pages say of the publisher and the kind of exam, in the order it is looked for; what file names say.
HEAD_PAGES = 5
PUBLISHERS = (
    ("KPC", r"KPC\s*기술사.*?IMPACT|Korea\s*Productivity\s*Center|한국생산성본부"),
    ("ITPE", r"ITPE\s*\(?\s*Information Technology Professional Engineer|ITPE\s*실전\s*명품"),
    ("인포레버", r"인포레버컨설팅|Big&Up\s*기술사회|인포레버"),
    ("동기회", r"기출풀이집|여울동기회|동기회"),
)
NAMED = (("KPC", "(?i)kpc"), ("ITPE", "(?i)itpe"), ("인포레버", "인포레버|(?i:inforever)"), ("동기회", "동기회"))
ACTUAL = r"기출\s*(?:문제|풀이|해설)|국가기술자격기술사시험문제"
MOCK = r"실전\s*(?:명품\s*)?모의고사|IMPACT\s*실전\s*모의고사"
ITPE_MOCK = r"ITPE\s*실전\s*명품\s*모의고사"
KPC_MOCK = r"KPC.*?기술사.*?IMPACT.*?실전\s*모의고사"
SESSION_SAID = r"제\s*([1-4])\s*교시"

# Weights of line signals, and the scores of strong and weak candidates.
LINE_WEIGHTS = {"qnum_only": 1.0, "qnum_topic": 1.5, "qnum_bun": 1.5, "problem": 1.0, "domain": 0.6, "select": 1.5, "roman": 0.3, "session": 0.0}
STRONG, WEAK = 2.0, 1.0
LINES_SEEN, LINES_SCORED = 14, 10
NUMBER_CAP = {1: 16, 2: 8, 3: 8, 4: 8}

# Counts at which a calibrated weight is full.
FULL_COUNTS = {"end": 10, "topic_end": 8, "roman_i": 10, "menti": 8, "num_restart": 10, "font_heading": 10, "marker_heading": 10, "star_rating": 10, "session_topic": 10, "header_kw": 10}

# Expected topics by publisher, kind of exam and session.
EXPECTED = [
    *[(p, "actual", s, n) for p in ("ITPE", "KPC", "인포레버", "동기회") for s, n in ((1, 13), (2, 6), (3, 6), (4, 6))],
    *[("ITPE", "mock", s, n) for s, n in ((1, 14), (2, 7), (3, 7), (4, 7))],
    *[("KPC", "mock", s, n) for s, n in ((1, 16), (2, 8), (3, 8), (4, 8))],
]
