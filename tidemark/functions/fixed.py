"""Fixed values of the business tables: column names, labels and orders the results are shown with."""

# Economic indicators: shown name, release schedule, importance.
INDICATORS = {
    "FFTR": ("연방기금금리", "FOMC 정례회의 후 (연 8회)", "★★★"),
    "GDP": ("국내총생산", "매달 마지막 주", "★★★"),
    "GDP Growth Rate": ("GDP 성장률", "GDP와 동시 발표", "★★★"),
    "PCE": ("개인소비지출", "매월 둘째 주 금요일", "★★★"),
    "Core PCE": ("근원 개인소비지출", "PCE와 동시 발표", "★★★"),
    "CPI": ("소비자물가지수", "매월 15일경", "★★★"),
    "Core CPI": ("근원 소비자물가지수", "CPI와 동시 발표", "★★★"),
    "Personal Income": ("개인소득", "매월 말경", "★★"),
    "Unemployment Rate": ("실업률", "매월 첫째 주 금요일", "★★★"),
    "ISM Manufacturing": ("제조업 고용", "매월 2~3일경", "★★"),
    "Durable Goods Orders": ("내구재 주문", "매월 마지막 주", "★★"),
    "Building Permits": ("건축허가", "매월 중순경", "★★"),
    "Retail Sales": ("소매판매", "매월 중순경", "★★"),
    "Consumer Sentiment": ("소비자심리지수", "매월 중순(잠정치)/말(확정치)", "★★"),
    "Nonfarm Payrolls": ("비농업부문 고용", "매월 첫째 주 금요일", "★★★"),
    "JOLTS Hires": ("신규채용", "매월 첫째주", "★★"),
}

# Card sales: key columns, issuer columns, and the eight rows of the issuer matrix. The domestic
# key value ends in a space.
CARD_KEYS = ("대분류", "카드 종류", "사용구분", "결제 방법")
CARD_MONTH = "년월"
CARD_ISSUERS = ("롯데카드", "비씨카드(자체)", "삼성카드", "신한카드", "우리카드", "하나카드", "현대카드", "KB국민카드")
CARD_ROWS = {
    "국내 신용(개인)": ("국내이용금액 ", "신용카드", "개인"),
    "국내 신용(법인)": ("국내이용금액 ", "신용카드", "법인"),
    "국내 체크(개인)": ("국내이용금액 ", "직불/체크카드", "개인"),
    "국내 체크(법인)": ("국내이용금액 ", "직불/체크카드", "법인"),
    "해외 신용(개인)": ("해외이용금액", "신용카드", "개인"),
    "해외 신용(법인)": ("해외이용금액", "신용카드", "법인"),
    "해외 체크(개인)": ("해외이용금액", "직불/체크카드", "개인"),
    "해외 체크(법인)": ("해외이용금액", "직불/체크카드", "법인"),
}

# Travel survey: answer column to region name.
SURVEY_REGIONS = {
    "CHINA_TOUR_INTRST_VALUE": "중국",
    "JP_TOUR_INTRST_VALUE": "일본",
    "HONGKONG_MACAU_TOUR_INTRST_VALUE": "홍콩마카오",
    "SEASIA_TOUR_INTRST_VALUE": "동남아시아",
    "MDLEST_SWASIA_TOUR_INTRST_VALUE": "중동서남아시아",
    "USA_CANADA_TOUR_INTRST_VALUE": "미국캐나다",
    "SAMRC_LAMRC_TOUR_INTRST_VALUE": "남미중남미",
    "WEURP_NEURP_TOUR_INTRST_VALUE": "서유럽북유럽",
    "EEURP_TOUR_INTRST_VALUE": "동유럽",
    "SEURP_TOUR_INTRST_VALUE": "남유럽",
    "SPCPC_TOUR_INTRST_VALUE": "남태평양",
    "AFRICA_TOUR_INTRST_VALUE": "아프리카",
}

# Spending category to the price category it is compared with.
PRICE_CATEGORIES = {
    "합계": "0 총지수",
    "식료품": "01 식료품 및 비주류음료",
    "의류/잡화": "03 의류 및 신발",
    "연료": "04 주택 수도 전기 및 연료",
    "가구/가전": "05 가정용품 및 가사 서비스",
    "의료/보건": "06 보건",
    "여행/교통": "07 교통",
    "오락/문화": "09 오락 및 문화",
    "교육": "10 교육",
    "숙박/음식": "11 음식 및 숙박",
    "공과금/개인 및 전문 서비스": "12 기타 상품 및 서비스",
}

# Forecast rows: source tag to its shown name.
SOURCE_NAMES = {"PREDICTION": "예측값", "REAL": "실제값", "FUTURE": "미래 예측값"}

# News categories: number to name and number to look-back days.
NEWS_CATEGORIES = {100: "정치", 101: "경제", 102: "사회", 103: "생활/문화", 104: "세계", 105: "IT/과학"}
NEWS_LAGS = {100: 129, 101: 167, 102: 40, 103: 158, 104: 29, 105: 175}

# Travel warnings: flag column, in order of severity, to the shown warning.
WARNINGS = (
    ("여행금지", "4단계 (여행금지)"),
    ("출국권고", "3단계 (출국권고)"),
    ("여행자제", "2단계 (여행자제)"),
    ("여행유의", "1단계 (여행유의)"),
    ("특별여행주의보", "특별여행주의보"),
)
NO_WARNING = "정보 없음"
