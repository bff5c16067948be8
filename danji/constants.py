"""Fixed values of the domain. They appear in results, so they are kept exactly."""

# Area bands in square metres; a band includes its upper edge.
AREA_BANDS = [(40, "초소형"), (60, "소형"), (85, "중소형"), (135, "중대형")]
AREA_BAND_LAST = "대형"

# Bands of the estimated pyeong; a band excludes its upper edge.
PYEONG_PER_M2 = 0.4
PYEONG_BANDS = [
    (10, "10평 미만"),
    (20, "10평대"),
    (30, "20평대"),
    (40, "30평대"),
    (50, "40평대"),
    (60, "50평대"),
]
PYEONG_BAND_LAST = "60평 이상"

# Building-age bands in years; a band excludes its upper edge.
AGE_BANDS = [(5, "5년 미만"), (10, "5~10년"), (20, "10~20년"), (30, "20~30년")]
AGE_BAND_LAST = "30년 이상"

# Short and full province names.
PROVINCE_FULL_NAMES = {
    "서울": "서울특별시",
    "부산": "부산광역시",
    "대구": "대구광역시",
    "인천": "인천광역시",
    "광주": "광주광역시",
    "대전": "대전광역시",
    "울산": "울산광역시",
    "세종": "세종특별자치시",
    "경기": "경기도",
    "강원": "강원특별자치도",
    "충북": "충청북도",
    "충남": "충청남도",
    "전북": "전북특별자치도",
    "전남": "전라남도",
    "경북": "경상북도",
    "경남": "경상남도",
    "제주": "제주특별자치도",
}

# The single-tier province and the district name used for it.
SEJONG = "세종특별자치시"
SEJONG_DISTRICT = "세종시"

# Contract attributes.
DIRECT_DEAL = "직거래"
DEPOSIT_LEASE = "전세"
NOT_CANCELLED_STRICT = ["", "None"]
NOT_CANCELLED_WIDE = ["", "None", "-"]

# Row kinds of the price-index tables.
INDEX_ASSET = "아파트"
INDEX_FREQ = "월간"
LEVEL_DISTRICT = "시군구"
LEVEL_PROVINCE = "시도"

# The four map indicators (how each is computed, and its unit).
INDICATORS = {
    "매매 전년동월대비 증감률": {"type": "yoy", "table": "sale_index", "unit": "%"},
    "전세 전년동월대비 증감률": {"type": "yoy", "table": "lease_index", "unit": "%"},
    "전세가율": {"type": "direct", "table": "lease_ratio", "unit": "%"},
    "매매 거래량": {"type": "count", "table": "sales", "unit": "건"},
}
