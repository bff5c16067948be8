import random

import pytest
from pyspark.sql import functions as F

from danji.functions import address as A, region as R, trade as T
from danji.functions.rounding import round1_half_even, round_half_up

# Three, four and five words, the province without districts, a doubled space, and too few words.
ADDRESSES = [
    ("울산광역시 남구 삼산동", "울산광역시", "남구", "삼산동"),
    ("인천광역시 연수구 동춘동", "인천광역시", "연수구", "동춘동"),
    ("경상남도 창원시 성산구 상남동", "경상남도", "창원시 성산구", "상남동"),
    ("전라남도 화순군 화순읍 광덕리", "전라남도", "화순군 화순읍", "광덕리"),
    ("충청북도 청주시 흥덕구 오송읍 연제리", "충청북도", "청주시 흥덕구", "오송읍"),
    ("세종특별자치시 나성동", "세종특별자치시", "세종시", "나성동"),
    ("세종특별자치시  금남면 용포리", "세종특별자치시", "세종시", "금남면"),
    ("세종특별자치시", "세종특별자치시", "세종시", ""),
    ("울산광역시 중구", "울산광역시", "중구", ""),
    ("\t인천광역시\n 연수구  송도동 ", "인천광역시", "연수구", "송도동"),
    ("강원", "강원", "", ""),
    ("", "", "", ""),
    (None, None, "", ""),
]


def test_address_parts_both_ways(spark):
    df = spark.createDataFrame([(a,) for a, *_ in ADDRESSES], "address string")
    one = df.select(
        "address", A.parse_sido(F.col("address")), A.parse_sigungu(F.col("address")),
        A.parse_emd(F.col("address")))
    whole = A.with_region_columns(df)
    expected = sorted(ADDRESSES, key=str)
    assert sorted([tuple(r) for r in one.collect()], key=str) == expected
    assert sorted([tuple(r) for r in whole.collect()], key=str) == expected


def test_lookup_keyword(spark):
    df = spark.createDataFrame([("경상북도 포항시 남구 효자동",), ("세종특별자치시 나성동",)], "a string")
    got = [r[0] for r in df.select(A.sigungu_keyword(F.col("a"))).collect()]
    assert got == ["포항시 남구", "세종특별자치시"]


@pytest.mark.parametrize("address, road, key", [
    ("울산광역시 남구 삼산동", "나래길 7", "울산광역시 남구 나래길 7"),
    ("경상남도 창원시 성산구 상남동", "구름길30번안길 4", "경상남도 창원시 구름길30번안길 4"),
    ("전라남도 화순군 화순읍 광덕리", "돌담길8번길 2", "전라남도 화순군 돌담길8번길 2"),
    ("세종특별자치시  금남면 용포리", "용포길 5", "세종특별자치시 세종시 용포길 5"),
    ("울산광역시 남구 삼산동", None, None),
    (" 울산광역시 남구", "길 1", " 울산광역시 길 1"),
    ("강원", "길 1", "강원  길 1"),
    ("강원 ", "길 1", "강원  길 1"),
    ("", "길 1", "  길 1"),
])
def test_road_key(spark, address, road, key):
    df = spark.createDataFrame([(address, road)], "address string, road string")
    assert df.select(A.road_address_key(F.col("address"), F.col("road"))).first()[0] == key
    assert A.with_road_key(df).first()["road_key"] == key


def test_may_lie_in_keeps_every_match(spark):
    df = A.with_region_columns(spark.createDataFrame([(a,) for a, *_ in ADDRESSES], "address string"))
    rows = [r for r in df.collect() if r["sido"]]
    for r in rows:
        kept = df.filter(A.may_lie_in(F.col("address"), r["sido"], [r["sigungu"]], [r["emd"]]))
        assert r["address"] in [k["address"] for k in kept.collect()]


def test_bands(spark):
    def one(f, x, kind="double"):
        return spark.createDataFrame([(x,)], f"x {kind}").select(f(F.col("x"))).first()[0]

    for x, band in [(18.0, "초소형"), (40.0, "초소형"), (40.5, "소형"), (60.0, "소형"), (60.5, "중소형"),
                    (85.0, "중소형"), (85.5, "중대형"), (135.0, "중대형"), (135.5, "대형"), (None, "대형")]:
        assert one(T.area_band, x) == band
    for x, band in [(11.0, "10평 미만"), (24.5, "10평 미만"), (25.0, "10평대"), (55.0, "20평대"),
                    (99.5, "30평대"), (149.0, "50평대"), (150.0, "60평 이상"), (400.0, "60평 이상"),
                    (None, "60평 이상")]:
        assert one(T.pyeong_band, x) == band
    for diff, age, band in [(4, 4, "5년 미만"), (9, 9, "5~10년"), (41, 41, "30년 이상"), (-2, 1, "5년 미만")]:
        assert one(lambda c: T.building_age(c, 2025), 2025 - diff, "int") == age
        assert one(lambda c: T.age_band(c, 2025), 2025 - diff, "int") == band
    assert one(lambda c: T.building_age(c, 2025), None, "int") == 1
    assert one(lambda c: T.building_age_or_null(c, 2025), None, "int") is None
    assert one(T.prev_month, 202501, "int") == 202412


def test_one_decimal_as_python_rounds(spark):
    rng = random.Random(5)
    values = [0.15, 0.25, 0.35, 1.25, 12.25, 2.675, 0.05, 1e6 + 0.45, 0.0, 33.349999999999994]
    values += [rng.randrange(-10**6, 10**6) / rng.choice([7, 20, 40, 80, 1000]) for _ in range(3000)]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").select(
        "i", round1_half_even(F.col("x")).alias("r")).collect()
    for row in got:
        assert row["r"] == round(values[row["i"]], 1), values[row["i"]]


def test_half_up_uses_the_stored_value(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()][0] == 1.0
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 0)).collect()][1:] == [3.0, -3.0]


def test_labels_and_provinces(spark):
    df = spark.createDataFrame([("북구 (울산광역시)",), ("연수구",)], "l string")
    got = df.select(R.label_name(F.col("l")), R.label_province(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [("북구", "울산광역시"), ("연수구", None)]
    names = spark.createDataFrame([("전북",), ("전북특별자치도",), ("해외",)], "n string")
    got = names.select(R.province_full_name(F.col("n")), R.province_short_name(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [
        ("전북특별자치도", "전북"), ("전북특별자치도", "전북"), ("해외", "해외")]
