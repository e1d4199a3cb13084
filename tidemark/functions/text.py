"""Tokens, sections, labels and clean-up of text; whole texts throughout.

One token rule for every operator: lower case, split on runs of characters that are neither
letters nor digits, keep tokens of two or more characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_BREAK = r"[^\p{L}\p{N}]+"

# Stop words of the keyword jobs.
STOP_WORDS = ("것", "등", "및", "약", "또", "를", "을", "이", "가", "은", "는")

# Section patterns of regulation notices, tried in order, and the messages
# shown when none matches.
REASON_PATTERNS = (
    r"1\.\s*개정\s*이유\s*(.*?)\s*2\.",
    r"1\.\s*제정\s*이유\s*(.*?)\s*2\.",
    r"1\.\s*개정\s*이유\s*및\s*주요내용\s*(.*?)\s*2\.",
    r"1\.\s*제정\s*이유\s*및\s*주요내용\s*(.*?)\s*2\.",
)
CONTENT_PATTERNS = (
    r"2\.\s*주요\s*내용\s*(.*?)\s*3\.\s*의견제출",
    r"2\.\s*주요\s*내용\s*(.*?)\s*3\.",
)
NO_REASON = "개정이유를 찾을 수 없습니다."
NO_CONTENT = "주요내용을 찾을 수 없습니다."
PERIOD_LABEL = "예고기간"
NO_DATE = "날짜 정보 없음"
NO_BODY = "내용 없음"


def _column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def tokens(column, stop_words: Iterable[str] = (), category=None) -> Column:
    """All tokens in order, without stop words and without the row's own category name."""
    found = F.split(F.lower(_column(column)), TOKEN_BREAK)
    stop = [word.lower() for word in stop_words]
    kept = F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*stop) if stop else F.length(t) > 1)
    if category is not None:
        kept = F.filter(kept, lambda t: t != F.lower(_column(category)))
    return kept


def lead_keywords(column, stop_words: Iterable[str] = STOP_WORDS, count: int = 5) -> Column:
    """The first ``count`` tokens, then without repeats; a null text gives an empty array."""
    lead = F.array_distinct(F.slice(tokens(column, stop_words), 1, count))
    return F.coalesce(lead, F.array().cast("array<string>"))


def first_section(column, patterns: Iterable[str], default: str) -> Column:
    """Capture of the first pattern that matches anywhere, trimmed; ``.`` spans lines."""
    column = F.coalesce(_column(column), F.lit(""))
    result = F.lit(default)
    for pattern in reversed(list(patterns)):
        spanning = "(?s)" + pattern
        capture = F.regexp_replace(F.regexp_extract(column, spanning, 1), r"^\s+|\s+$", "")
        result = F.when(column.rlike(spanning), capture).otherwise(result)
    return result


def revision_reason(column) -> Column:
    return first_section(column, REASON_PATTERNS, NO_REASON)


def main_content(column) -> Column:
    return first_section(column, CONTENT_PATTERNS, NO_CONTENT)


def labelled_value(column, label: str, default: str = "N/A") -> Column:
    """Rest of the line after ``label:``; the default when the label does not occur."""
    column = F.coalesce(_column(column), F.lit(""))
    pattern = rf"{label}:\s*(.*)"
    return F.when(column.rlike(pattern), F.regexp_extract(column, pattern, 1)).otherwise(F.lit(default))


def compose_notice(title, start, end, body) -> Column:
    """Notice text with title, dates and body, or title and a marker when there is no body."""
    title, start, end, body = map(_column, (title, start, end, body))
    full = F.concat(F.lit("제목"), title, F.lit("\n시작날짜: "), start, F.lit(" 종료날짜: "), end,
                    F.lit("\n내용: "), F.trim(body))
    return F.when(body.isNotNull(), full).otherwise(F.concat(title, F.lit(NO_BODY)))


def period_bounds(column, label: str = PERIOD_LABEL, separator: str = " ~ ", default: str = NO_DATE) -> Column:
    """Struct ``start, end`` around the separator after the label.

    Both are the default when the label is absent; a missing separator leaves ``end`` null.
    """
    column = F.coalesce(_column(column), F.lit(""))
    after = F.trim(F.split_part(column, F.lit(label), F.lit(2)))
    parts = F.split(after, separator)
    present = F.contains(column, F.lit(label))
    return F.struct(
        F.when(present, F.try_element_at(parts, F.lit(1))).otherwise(F.lit(default)).alias("start"),
        F.when(present, F.try_element_at(parts, F.lit(2))).otherwise(F.lit(default)).alias("end"),
    )


def absolute_url(column, host: str) -> Column:
    """``./x`` and ``/x`` to ``host/x``; other links unchanged behind the host."""
    column = _column(column)
    link = F.when(column.startswith("./"), F.replace(column, F.lit("./"), F.lit("/"))).otherwise(column)
    return F.concat(F.lit(host), link)


def collapse_whitespace(column) -> Column:
    return F.trim(F.regexp_replace(_column(column), r"\s+", " "))


def lead_sentence(column) -> Column:
    """Text up to its first terminator, the whole text when it has none."""
    column = _column(column)
    pattern = r"(?s)^(.*?[.!?])"
    return F.when(column.rlike(pattern), F.regexp_extract(column, pattern, 1)).otherwise(column)


def join_tokens(column, default: str) -> Column:
    """Tokens joined by ``, ``; the default when there are none."""
    return F.coalesce(F.nullif(F.array_join(column, ", "), F.lit("")), F.lit(default))


def url_word(column) -> Column:
    """Percent-encoded word, a space as ``%20``."""
    return F.replace(F.url_encode(_column(column)), F.lit("+"), F.lit("%20"))


def labels_by_word(column, words: Mapping[str, Iterable[str]]) -> Column:
    """Every label with at least one word occurring in the text, in dictionary order."""
    column = _column(column)
    checks = []
    for label, entries in words.items():
        hit = F.lit(False)
        for word in entries:
            hit = hit | column.contains(word)
        checks.append(F.when(hit, F.lit(label)))
    return F.array_compact(F.array(*checks))


# Benefit categories and the words that mark them.
BENEFIT_WORDS = {
    "통신": ("통신", "전화", "휴대폰", "통신비", "요금제", "LTE", "5G"),
    "주유+차량정비": ("주유", "차량", "자동차", "정비", "세차", "주유소", "카센터", "차량정비"),
    "쇼핑": ("쇼핑", "백화점", "적립", "패션", "의류", "아울렛", "온라인쇼핑", "마켓", "상점", "스토어"),
    "항공마일리지": ("항공", "마일리지", "항공사", "적립", "포인트", "마일", "Mileage"),
    "공항라운지": ("공항", "라운지", "출국", "입국", "공항서비스", "Lounge"),
    "무실적+모든가맹점": ("모든 가맹점", "무실적", "제한없음", "조건없음", "No Limit", "All Stores"),
    "구독/스트리밍": ("구독", "스트리밍", "OTT", "넷플릭스", "유튜브", "음악", "멤버십", "Subscription", "Streaming"),
    "해외결제": ("해외", "결제", "외화", "달러", "유로", "국제결제", "FX", "USD", "EUR"),
    "배달앱+간편결제": ("배달", "앱", "간편결제", "배달의민족", "요기요", "페이", "전자결제", "Delivery", "Pay", "결제앱"),
    "교통+편의점": ("교통", "편의점", "버스", "지하철", "택시", "대중교통", "교통카드", "편의", "Transit"),
    "공과금": ("공과금", "세금", "수도", "전기", "가스", "요금", "세금납부"),
    "여행+바우처": ("여행", "호텔", "바우처", "숙박", "여행사", "관광", "투어", "Voucher"),
    "제휴/PLCC": ("제휴", "PLCC", "특화", "스타벅스", "파트너십", "제휴카드", "쿠팡", "배민", "이케아", "네이버", "아모레",
                "카카오뱅크", "무신사", "쏘카", "코스트코", "이마트", "SSG", "현대차", "기아차", "제네시스", "스마일카드",
                "위버스", "컬리", "크림", "이디야", "야놀자", "미래에셋"),
    "증권사CMA": ("증권사", "CMA", "금융", "자산관리", "증권", "Investment"),
    "레스토랑/음식": ("패밀리레스토랑", "식당", "레스토랑", "푸드", "외식", "레스토랑할인", "Dining", "Restaurant"),
    "놀이공원": ("놀이공원", "테마파크", "어드벤처", "놀이시설", "레저", "어트랙션", "Amusement Park", "Park"),
    "기타": ("기타", "Miscellaneous", "기타혜택", "기타서비스", "Other", "Extra"),
}
