"""Row conditions over whole trade tables."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import AS_OF_YEAR
from checks.views_sql import ACTIVE_STRICT, ACTIVE_WIDE, AREA_BAND, PYEONG_BAND
from danji.functions import filters as C
from danji.functions.address import with_region_columns
from danji.operators.skew import counted
from danji.plans.preprocess import derive_trade_columns

COUNTED = "count(*) AS n, CAST(sum(price) AS BIGINT) AS total"
RENT_COUNTED = "count(*) AS n, CAST(sum(deposit) AS BIGINT) AS total"


def per_month(df, amount="price"):
    return df.groupBy("ym").agg(F.count("*").alias("n"), F.sum(amount).alias("total"))


def _sales_filter(name, condition, sql):
    @query(name, f"SELECT ym, {COUNTED} FROM sales WHERE {sql} GROUP BY ym", "sales")
    def _(v):
        return per_month(v.sales.filter(condition()))


_sales_filter("active_sales_strict", C.active_sales_strict, ACTIVE_STRICT)
_sales_filter("active_sales_wide", C.active_sales_wide, ACTIVE_WIDE)
_sales_filter("exclude_direct_nulldrop", C.exclude_direct_nulldrop, "deal_type <> '직거래'")
_sales_filter("exclude_direct_nullkeep", C.exclude_direct_nullkeep,
              "deal_type IS DISTINCT FROM '직거래'")
_sales_filter("valid_trade_rows", C.valid_trade_rows,
              "address IS NOT NULL AND road <> '' AND built_year > 0")
_sales_filter("pyeong_band_predicate",
              lambda: C.pyeong_band_predicate(F.col("area_m2"), ["10평 미만", "20평대", "60평 이상"]),
              f"{PYEONG_BAND} IN ('10평 미만', '20평대', '60평 이상')")


@query("lease_only", f"SELECT ym, {RENT_COUNTED} FROM rents WHERE rent_kind = '전세' GROUP BY ym", "rents")
def _(v):
    return per_month(v.rents.filter(C.lease_only()), "deposit")


@query("trade_filter_region", f"""SELECT sido, sigungu, ym, count(*) AS n FROM
    (SELECT *, {AREA_BAND} AS area_band, {PYEONG_BAND} AS pyeong_band FROM rents_parts)
  WHERE road <> '' AND built_year > 0 AND sido IN ('서울특별시', '경기도') AND
    sigungu IN ('중구', '동구', '중시 중구') AND ym // 100 BETWEEN 1996 AND 1999
    AND area_band IN ('소형', '중소형', '대형') AND rent_kind = '전세'
  GROUP BY ALL""", "rents_parts")
def _(v):
    chosen = C.trade_filter_region(
        sido=["서울특별시", "경기도"], sigungu=["중구", "동구", "중시 중구"], year_from=1996, year_to=1999,
        area_bands=["소형", "중소형", "대형"], rent_kind="전세",
    )
    derived = derive_trade_columns(v.rents, AS_OF_YEAR).filter(chosen)
    return derived.groupBy("sido", "sigungu", "ym").agg(F.count("*").alias("n"))


@query("trade_filter_price", f"""SELECT complex, ym, count(*) AS n, CAST(sum(price) AS BIGINT) AS total
  FROM sales_parts WHERE sido = '서울특별시' AND sigungu = '중구' AND emd <> ''
    AND {PYEONG_BAND} IN ('10평대', '20평대', '30평대') AND ym BETWEEN 199601 AND 200012
  GROUP BY ALL""", "sales_parts")
def _(v):
    chosen = C.trade_filter_price(
        sido="서울특별시", sigungu="중구", emd=[f"제{i}동" for i in range(100)],
        pyeong_bands=["10평대", "20평대", "30평대"], ym_from=199601, ym_to=200012,
    )
    return v.sales.filter(chosen).groupBy("complex", "ym").agg(
        F.count("*").alias("n"), F.sum("price").alias("total"))


@query("region_level", """SELECT '시도' AS level, region_name, count(*) AS n FROM sale_index
    WHERE region_code LIKE '__00000000' AND region_name IN ('서울', '경기') GROUP BY ALL
  UNION ALL SELECT '시군구', region_name, count(*) FROM sale_index
    WHERE region_code NOT LIKE '__00000000' AND substr(region_code, 1, 5) IN ('11001', '12002', '14009')
    GROUP BY ALL""", "sale_index")
def _(v):
    def part(level, wanted):
        return v.sale_index.filter(C.region_level(level, wanted)).groupBy("region_name").agg(
            F.count("*").alias("n")).select(F.lit(level).alias("level"), "region_name", "n")

    return part("시도", ["서울", "경기"]).unionByName(part("시군구", ["11001", "12002", "14009"]))


@query("index_rows", """SELECT region_code, count(*) AS n FROM sale_index
  WHERE asset_kind = '아파트' AND freq = '월간' AND length(region_code) = 10 GROUP BY 1""", "sale_index")
def _(v):
    return v.sale_index.filter(C.index_rows()).groupBy("region_code").agg(F.count("*").alias("n"))


@query("year_between", """SELECT date, count(*) AS n FROM sale_index
  WHERE year(date) BETWEEN 1997 AND 1999 GROUP BY 1""", "sale_index")
def _(v):
    kept = v.sale_index.filter(C.year_between(F.col("date"), 1997, 1999))
    return kept.groupBy("date").agg(F.count("*").alias("n"))


@query("search_complex", """SELECT DISTINCT address, complex, area_m2 FROM sales
  WHERE complex LIKE '%ring%'""", "sales")
def _(v):
    return C.search_complex(v.sales, "ring")


@query("area_tolerance", """SELECT area_m2, count(*) AS n FROM sales WHERE abs(area_m2 - 84.5) < 1
  GROUP BY 1""", "sales")
def _(v):
    kept = v.sales.filter(C.area_tolerance(F.col("area_m2"), F.lit(84.5)))
    return kept.groupBy("area_m2").agg(F.count("*").alias("n"))


@query("household_range", """SELECT kind_code, count(*) AS n, count(households) AS known FROM complexes
  WHERE households IS NULL OR households BETWEEN 300 AND 900 GROUP BY 1""", "complexes")
def _(v):
    kept = v.complexes.filter(C.household_range(F.col("households"), 300, 900))
    return kept.groupBy("kind_code").agg(F.count("*").alias("n"), F.count("households").alias("known"))


@query("date_slice", """SELECT date, region_code, index_value FROM sale_index WHERE freq = '월간'
    AND asset_kind = '아파트' AND date IN (SELECT DISTINCT date FROM sale_index ORDER BY 1 DESC LIMIT 60)""",
       "sale_index")
def _(v):
    kept = C.date_slice(v.sale_index.filter(C.index_rows()))
    return kept.select("date", "region_code", "index_value")


@query("nonempty_region", """SELECT sido, sigungu, emd, count(*) AS n FROM sales_parts
  WHERE sido <> '' AND sigungu <> '' AND emd <> '' GROUP BY ALL""", "sales_parts")
def _(v):
    parsed = with_region_columns(counted(v.sales, "address")).filter(C.nonempty_region())
    return parsed.groupBy("sido", "sigungu", "emd").agg(F.sum("n").alias("n"))


@query("name_pattern", """SELECT region_name, count(*) AS n FROM sale_index
  WHERE region_name SIMILAR TO '.*(중구|서울|동시).*' GROUP BY 1""", "sale_index")
def _(v):
    kept = v.sale_index.filter(C.name_pattern(F.col("region_name"), "중구|서울|동시"))
    return kept.groupBy("region_name").agg(F.count("*").alias("n"))


@query("drop_null_metric", """SELECT kind_code, count(*) AS n FROM complexes WHERE households IS NOT NULL
  GROUP BY 1""", "complexes")
def _(v):
    kept = C.drop_null_metric(v.complexes, "households")
    return kept.groupBy("kind_code").agg(F.count("*").alias("n"))


@query("filter_regions_by_province", """SELECT sig_cd, full_nm FROM regions_geo
  WHERE full_nm LIKE '서울특별시%' OR full_nm LIKE '세종특별자치시%'""", "regions_geo")
def _(v):
    kept = v.regions_geo.filter(C.province_prefix(F.col("full_nm"), ["서울특별시", "세종특별자치시"]))
    return kept.select("sig_cd", "full_nm")


@query("named_regions_or_head", """WITH m AS (SELECT DISTINCT substr(region_code, 1, 5) AS sig_cd,
    region_name FROM sale_index WHERE region_code NOT LIKE '%00000000')
  SELECT 'named' AS kind, sig_cd, region_name FROM m WHERE region_name IN ('중구', '동시 동구')
  UNION ALL (SELECT 'head', sig_cd, region_name FROM m ORDER BY sig_cd LIMIT 5)""", "sale_index")
def _(v):
    from danji.operators.index import index_monthly

    regions = index_monthly(v.sale_index, "시군구").select(
        F.left("region_code", F.lit(5)).alias("sig_cd"), "region_name").distinct()
    named = C.named_regions_or_head(regions, ["중구", "동시 동구"])
    head = C.named_regions_or_head(regions, ["없는구"])
    return named.withColumn("kind", F.lit("named")).unionByName(
        head.withColumn("kind", F.lit("head")))
