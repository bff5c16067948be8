"""Column functions over whole trade tables, counted per distinct result."""

from pyspark.sql import DataFrame, functions as F

from checks.registry import query
from checks.views import AS_OF_YEAR
from checks.views_sql import AGE_BAND, AREA_BAND, EOK, PYEONG_BAND, python_round1
from danji.functions import address as A, region as R, trade as T


def tally(df: DataFrame, **columns) -> DataFrame:
    return df.groupBy(*[c.alias(n) for n, c in columns.items()]).agg(F.count("*").alias("n"))


@query("normalize_address", """SELECT address, trim(regexp_replace(address, '\\s+', ' ', 'g')) AS clean,
  count(*) AS n FROM sales GROUP BY 1, 2""", "sales")
def _(v):
    return tally(v.sales, address=F.col("address"), clean=A.normalize_address(F.col("address")))


@query("address_word_count", """SELECT address, CAST(len(w) AS INTEGER) AS words, count(*) AS n
  FROM sales_parts GROUP BY 1, 2""", "sales_parts")
def _(v):
    return tally(v.sales, address=F.col("address"), words=A.address_word_count(F.col("address")))


@query("parse_sido", "SELECT address, sido, count(*) AS n FROM sales_parts GROUP BY 1, 2", "sales_parts")
def _(v):
    return tally(v.sales, address=F.col("address"), sido=A.parse_sido(F.col("address")))


@query("parse_sigungu", "SELECT address, sigungu, count(*) AS n FROM sales_parts GROUP BY 1, 2",
       "sales_parts")
def _(v):
    return tally(v.sales, address=F.col("address"), sigungu=A.parse_sigungu(F.col("address")))


@query("parse_emd", "SELECT address, emd, count(*) AS n FROM sales_parts GROUP BY 1, 2", "sales_parts")
def _(v):
    return tally(v.sales, address=F.col("address"), emd=A.parse_emd(F.col("address")))


@query("sigungu_keyword", """SELECT address, CASE WHEN sido = '세종특별자치시' THEN sido ELSE sigungu END
  AS keyword, count(*) AS n FROM rents_parts GROUP BY 1, 2""", "rents_parts")
def _(v):
    return tally(v.rents, address=F.col("address"), keyword=A.sigungu_keyword(F.col("address")))


@query("road_address_key", """SELECT address, road, key_prefix || ' ' || road AS road_key, count(*) AS n
  FROM sales_parts GROUP BY 1, 2, 3""", "sales_parts")
def _(v):
    road = F.col("road")
    return tally(v.sales, address=F.col("address"), road=road, road_key=A.road_address_key(F.col("address"), road))


@query("area_band", f"SELECT area_m2, {AREA_BAND} AS area_band, count(*) AS n FROM sales GROUP BY 1, 2",
       "sales")
def _(v):
    return tally(v.sales, area_m2=F.col("area_m2"), area_band=T.area_band(F.col("area_m2")))


@query("pyeong_estimate", """SELECT area_m2, CAST(floor(area_m2 * 0.4) AS INTEGER) AS pyeong_floor,
  area_m2 * 0.4 AS pyeong_raw, CAST(round_even(area_m2 * 0.4, 0) AS INTEGER) AS pyeong_round,
  count(*) AS n FROM sales GROUP BY 1, 2, 3, 4""", "sales")
def _(v):
    return tally(v.sales, area_m2=F.col("area_m2"), pyeong_floor=T.pyeong_floor(F.col("area_m2")),
                 pyeong_raw=T.pyeong_raw(F.col("area_m2")), pyeong_round=T.pyeong_round(F.col("area_m2")))


@query("pyeong_band", f"""SELECT area_m2, {PYEONG_BAND} AS pyeong_band, count(*) AS n FROM sales
  GROUP BY 1, 2""", "sales")
def _(v):
    return tally(v.sales, area_m2=F.col("area_m2"), pyeong_band=T.pyeong_band(F.col("area_m2")))


@query("building_age", f"""SELECT built_year, greatest(1, {AS_OF_YEAR} - built_year) AS age,
  CASE WHEN built_year <> 0 THEN greatest(1, {AS_OF_YEAR} - built_year) END AS age_or_null,
  count(*) AS n FROM sales GROUP BY 1, 2, 3""", "sales")
def _(v):
    built = F.col("built_year")
    return tally(v.sales, built_year=built, age=T.building_age(built, AS_OF_YEAR),
                 age_or_null=T.building_age_or_null(built, AS_OF_YEAR))


@query("age_band", f"SELECT built_year, {AGE_BAND} AS age_band, count(*) AS n FROM sales GROUP BY 1, 2",
       "sales")
def _(v):
    built = F.col("built_year")
    return tally(v.sales, built_year=built, age_band=T.age_band(built, AS_OF_YEAR))


@query("contract_year", "SELECT ym, CAST(ym / 100 AS INTEGER) AS year, count(*) AS n FROM sales GROUP BY 1, 2",
       "sales")
def _(v):
    return tally(v.sales, ym=F.col("ym"), year=T.contract_year(F.col("ym")))


@query("price_in_eok", f"""SELECT {EOK.format('price')} AS price_eok, count(*) AS n FROM sales
  GROUP BY 1""", "sales")
def _(v):
    return tally(v.sales, price_eok=T.price_in_eok(F.col("price")))


@query("prev_month", """SELECT ym, CAST(strftime(make_date(ym // 100, ym % 100, 1) - INTERVAL 1 MONTH,
  '%Y%m') AS INTEGER) AS prev, count(*) AS n FROM sales GROUP BY 1, 2""", "sales")
def _(v):
    return tally(v.sales, ym=F.col("ym"), prev=T.prev_month(F.col("ym")))


@query("add_years", """SELECT ym, CAST(strftime(make_date(ym // 100, ym % 100, 1) + INTERVAL 2 YEAR,
  '%Y%m') AS INTEGER) AS later, count(*) AS n FROM sales GROUP BY 1, 2""", "sales")
def _(v):
    return tally(v.sales, ym=F.col("ym"), later=T.add_years(F.col("ym"), 2))


@query("month_distance", """SELECT ym, CAST(abs(datediff('month', make_date(1998, 7, 1),
  make_date(ym // 100, ym % 100, 1))) AS INTEGER) AS distance, count(*) AS n FROM sales GROUP BY 1, 2""",
       "sales")
def _(v):
    return tally(v.sales, ym=F.col("ym"), distance=T.month_distance(F.col("ym"), F.lit(199807)))


@query("ym_to_date", """SELECT ym, make_date(ym // 100, ym % 100, 15) AS mid,
  strftime(make_date(ym // 100, ym % 100, 1), '%Y-%m') AS label,
  (ym // 100) || '.' || (ym % 100) AS label_dot, count(*) AS n FROM rents GROUP BY ALL""", "rents")
def _(v):
    return tally(v.rents, ym=F.col("ym"), mid=T.ym_to_date(F.col("ym")), label=T.ym_label(F.col("ym")),
                 label_dot=T.ym_label_dot(F.col("ym")))


@query("region_code_parts", """SELECT DISTINCT region_code, CASE WHEN region_code LIKE '%00000000'
    THEN '시도' ELSE '시군구' END AS level, substr(region_code, 1, 5) AS sig_cd
  FROM sale_index""", "sale_index")
def _(v):
    code = F.col("region_code")
    return v.sale_index.select(
        "region_code", R.code_level(code).alias("level"), R.district_code(code).alias("sig_cd")
    ).distinct()


@query("lot_address_base", """SELECT lot_address, regexp_extract(lot_address, '^(.*) [0-9-]+$', 1) AS base,
  count(*) AS n FROM complexes GROUP BY 1, 2""", "complexes")
def _(v):
    lot = F.col("lot_address")
    return tally(v.complexes, lot_address=lot, base=A.lot_address_base(lot))


@query("complex_first_word", """SELECT complex, string_split(complex, ' ')[1] AS first_word, count(*) AS n
  FROM complexes GROUP BY 1, 2""", "complexes")
def _(v):
    return tally(v.complexes, complex=F.col("complex"),
                 first_word=A.complex_first_word(F.col("complex")))


@query("volume_region_name", """SELECT CASE sido WHEN '세종특별자치시' THEN sido ELSE sigungu END AS name,
  count(*) AS n FROM sales_parts GROUP BY 1""", "sales_parts")
def _(v):
    name = A.volume_region_name(F.col("sido"), F.col("sigungu"))
    return tally(A.with_region_columns(v.sales), name=name)


@query("province_names", """WITH names(short, full_name) AS (VALUES ('서울', '서울특별시'), ('경기', '경기도'),
    ('세종', '세종특별자치시'), ('부산', '부산광역시'), ('충남', '충청남도'))
  SELECT region_name, coalesce(a.full_name, region_name) AS full_name,
    coalesce(b.short, region_name) AS short_name, count(*) AS n
  FROM sale_index LEFT JOIN names a ON region_name = a.short
    LEFT JOIN names b ON region_name = b.full_name
  GROUP BY ALL""", "sale_index")
def _(v):
    name = F.col("region_name")
    return tally(v.sale_index, region_name=name, full_name=R.province_full_name(name),
                 short_name=R.province_short_name(name))


@query("fill_emd", """SELECT address, CASE WHEN emd = '' THEN sigungu ELSE emd END AS filled,
  count(*) AS n FROM sales_parts GROUP BY 1, 2""", "sales_parts")
def _(v):
    parsed = A.with_region_columns(v.sales)
    return tally(parsed, address=F.col("address"), filled=A.fill_emd(F.col("emd"), F.col("sigungu")))


@query("turnover_rate", """SELECT households, CASE WHEN households > 0
    THEN round(count(*) * 100.0::DOUBLE / households, 2) END AS turnover, count(*) AS n
  FROM complexes GROUP BY households""", "complexes")
def _(v):
    counted = v.complexes.groupBy("households").agg(F.count("*").alias("n"))
    return counted.select(
        "households", T.turnover_rate(F.col("n"), F.col("households")).alias("turnover"), "n"
    )


# The spreads of the tracking report, on the monthly extremes of each complex name.
_PAIRS = """WITH s AS (SELECT complex, ym, max(price) AS price, min(price) AS low FROM sales GROUP BY ALL),
  r AS (SELECT complex, ym, max(deposit) AS deposit, min(deposit) AS low_deposit FROM rents
    WHERE rent_kind = '전세' GROUP BY ALL),
  pairs AS (SELECT complex, ym, price, low, deposit, low_deposit FROM s LEFT JOIN r USING (complex, ym))"""


def _pairs(v):
    s = v.sales.groupBy("complex", "ym").agg(
        F.max("price").alias("price"), F.min("price").alias("low"))
    r = v.rents.filter("rent_kind = '전세'").groupBy("complex", "ym").agg(
        F.max("deposit").alias("deposit"), F.min("deposit").alias("low_deposit"))
    return s.join(r, ["complex", "ym"], "left")


@query("gap_and_ratio", _PAIRS + f""" SELECT complex, ym, price - deposit AS gap,
    low - low_deposit AS low_gap,
    {python_round1('deposit / price * 100')} AS ratio FROM pairs""", "sales rents")
def _(v):
    price, deposit = F.col("price"), F.col("deposit")
    return _pairs(v).select(
        "complex", "ym", T.difference(price, deposit).alias("gap"),
        T.difference(F.col("low"), F.col("low_deposit")).alias("low_gap"),
        T.lease_ratio_pct(deposit, price).alias("ratio"),
    )


@query("vs_peak_pct", _PAIRS + f""" SELECT complex, ym,
    {python_round1('(low / price - 1) * 100')} + 0.0 AS vs_peak FROM pairs""", "sales rents")
def _(v):
    return _pairs(v).select(
        "complex", "ym", T.vs_peak_pct(F.col("low"), F.col("price")).alias("vs_peak"))


@query("direct_deal_note", """SELECT deal_type, CASE WHEN deal_type = '직거래' THEN '직거래' END AS note,
  count(*) AS n FROM sales GROUP BY 1, 2""", "sales")
def _(v):
    deal = F.col("deal_type")
    return tally(v.sales, deal_type=deal, note=T.direct_deal_note(deal))


@query("cancel_status_bucket", """SELECT CASE WHEN cancelled_on IS NULL THEN 'NULL'
    WHEN cancelled_on IN ('None', '-', '') THEN cancelled_on ELSE '날짜값' END AS bucket, count(*) AS n
  FROM sales GROUP BY 1""", "sales")
def _(v):
    return tally(v.sales, bucket=T.cancel_status_bucket(F.col("cancelled_on")))


@query("numeric_cast", """SELECT cancelled_on, TRY_CAST(cancelled_on AS DOUBLE) AS as_double,
  TRY_CAST(cancelled_on AS INTEGER) AS as_int, count(*) AS n FROM sales GROUP BY 1, 2, 3""", "sales")
def _(v):
    text = F.col("cancelled_on")
    return tally(v.sales, cancelled_on=text, as_double=T.numeric_cast(text),
                 as_int=T.numeric_cast(text, "int"))
