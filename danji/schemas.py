"""Table schemas and the Korean source names they are read from.

Spark rejects unquoted Korean identifiers, so tables are renamed at the scan.
"""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# table -> list of (source column, engine column, type); fixed values.
TABLES = {
    "sales": [
        ("시군구", "address", _S),
        ("단지명", "complex", _S),
        ("전용면적", "area_m2", _D),
        ("거래금액", "price", _L),
        ("계약년월", "ym", _I),
        ("계약일", "day", _I),
        ("층", "floor_no", _I),
        ("건축년도", "built_year", _I),
        ("도로명", "road", _S),
        ("해제사유발생일", "cancelled_on", _S),
        ("거래유형", "deal_type", _S),
    ],
    "rents": [
        ("시군구", "address", _S),
        ("단지명", "complex", _S),
        ("전월세구분", "rent_kind", _S),
        ("전용면적", "area_m2", _D),
        ("보증금", "deposit", _L),
        ("계약년월", "ym", _I),
        ("계약일", "day", _I),
        ("층", "floor_no", _I),
        ("건축년도", "built_year", _I),
        ("도로명", "road", _S),
    ],
    "coords": [
        ("도로명주소", "road_key", _S),
        ("경도", "lon", _D),
        ("위도", "lat", _D),
    ],
    "complexes": [
        ("주소", "lot_address", _S),
        ("단지명", "complex", _S),
        ("세대수", "households", _I),
        ("단지구분코드", "kind_code", _S),
    ],
    "sale_index": [
        ("월간주간구분", "freq", _S),
        ("매물종별구분", "asset_kind", _S),
        ("지역코드", "region_code", _S),
        ("지역명", "region_name", _S),
        ("날짜", "date", T.DateType()),
        ("가격지수", "index_value", _D),
    ],
    "lease_ratio": [
        ("날짜", "date", T.DateType()),
        ("매물종별구분", "asset_kind", _S),
        ("지역코드", "region_code", _S),
        ("지역명", "region_name", _S),
        ("전세가격비율", "ratio", _D),
    ],
    "sale_index_yoy": [
        ("날짜", "date", T.DateType()),
        ("지역코드", "region_code", _S),
        ("지역명", "region_name", _S),
        ("레벨", "level", _S),
        ("YoY증감률", "yoy_pct", _D),
    ],
    "targets": [
        ("시군구", "address", _S),
        ("단지명", "complex", _S),
        ("전용면적", "area_m2", _D),
    ],
}
TABLES["lease_index"] = TABLES["sale_index"]
TABLES["lease_index_yoy"] = TABLES["sale_index_yoy"]


def source_schema(table: str) -> T.StructType:
    """Schema with the source (Korean) names, as stored on disk."""
    return T.StructType([T.StructField(src, typ) for src, _, typ in TABLES[table]])


def engine_schema(table: str) -> T.StructType:
    """Schema with the engine (English) names, as used by every operator."""
    return T.StructType([T.StructField(eng, typ) for _, eng, typ in TABLES[table]])


def source_to_engine(table: str) -> dict[str, str]:
    return {src: eng for src, eng, _ in TABLES[table]}
