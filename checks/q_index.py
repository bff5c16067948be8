"""Price-index queries."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views_sql import ACTIVE_WIDE
from danji.constants import INDICATORS
from danji.operators import index as X
from danji.plans import indicators as I

YEAR, MONTH = 1999, 5

_ROWS = """SELECT date, region_code, region_name, index_value AS v FROM {table}
  WHERE asset_kind = '아파트' AND freq = '월간' AND length(region_code) = 10 AND region_code {like} '%00000000'"""
_DISTRICT = _ROWS.format(table="{table}", like="NOT LIKE")
_PROVINCE = _ROWS.format(table="{table}", like="LIKE")


def _yoy(rows: str) -> str:
    return f"""SELECT c.date, c.region_code, c.region_name, round((c.v - p.v) / p.v * 100, 1) + 0.0 AS yoy_pct
  FROM ({rows}) c JOIN ({rows}) p ON c.region_code = p.region_code
    AND c.date = CAST(p.date + INTERVAL 1 YEAR AS DATE) WHERE p.v > 0"""


_SALE_YOY = _yoy(_DISTRICT.format(table="sale_index"))
_LEASE_YOY = _yoy(_DISTRICT.format(table="lease_index"))
_PROVINCE_YOY = _yoy(_PROVINCE.format(table="sale_index"))
_RATIO = """SELECT date, region_code, region_name, ratio FROM lease_ratio WHERE asset_kind = '아파트'
  AND region_code {like} '%00000000'"""
_VOLUME = f"""SELECT CASE sido WHEN '세종특별자치시' THEN sido ELSE sigungu END AS sig_kor_nm,
  count(*) AS volume FROM sales_parts WHERE ym = 199905 AND deal_type <> '직거래' AND {ACTIVE_WIDE}
  GROUP BY 1"""


@query("yoy_point_join", f"""SELECT substr(region_code, 1, 5) AS sig_cd, region_name, yoy_pct
  FROM ({_SALE_YOY}) WHERE date = DATE '1999-05-01'""", "sale_index")
def _(v):
    return X.yoy_point_join(v.sale_index, YEAR, MONTH)


@query("yoy_self_join", f"SELECT '시군구' AS level, * FROM ({_SALE_YOY}) UNION ALL "
       f"SELECT '시도', * FROM ({_PROVINCE_YOY})", "sale_index")
def yoy_self_join(v):
    return X.precomputed_yoy(v.sale_index).select(
        "level", "date", "region_code", "region_name", "yoy_pct")


@query("table_or_fallback", f"SELECT date, region_code, yoy_pct FROM ({_LEASE_YOY})", "lease_index")
def _(v):
    from danji.sources.tables import table_or_fallback

    rows = table_or_fallback(
        v.spark, "lease_index_yoy", lambda: X.yoy_self_join(v.lease_index, "시군구"))
    return rows.select("date", "region_code", "yoy_pct")


@query("district_trade_volume", _VOLUME, "sales_parts")
def _(v):
    return X.district_trade_volume(v.sales, YEAR * 100 + MONTH)


_BOUNDS = """CAST(year(min(date)) AS INTEGER) AS start_year, CAST(month(min(date)) AS INTEGER) AS start_month,
  CAST(year(max(date)) AS INTEGER) AS end_year, CAST(month(max(date)) AS INTEGER) AS end_month"""


@query("index_date_range", f"SELECT {_BOUNDS} FROM ({_DISTRICT.format(table='lease_index')})", "lease_index")
def _(v):
    return X.index_date_range(v.lease_index)


@query("yoy_date_range", f"SELECT {_BOUNDS} FROM ({_SALE_YOY})", "sale_index")
def _(v):
    return X.yoy_date_range(v.sale_index)


@query("month_axis", f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month FROM
  (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS d FROM ({_SALE_YOY}))""",
       "sale_index")
def _(v):
    return X.month_axis(X.yoy_date_range(v.sale_index))


@query("lease_ratio_map", f"""SELECT substr(region_code, 1, 5) AS sig_cd, region_name, ratio
  FROM ({_RATIO.format(like='NOT LIKE')}) WHERE date = DATE '1999-05-01'""", "lease_ratio")
def _(v):
    return X.lease_ratio_map(v.lease_ratio, YEAR, MONTH)


def maps(v):
    return I.indicator_map(v.sale_index, v.lease_index, v.lease_ratio, v.sales, YEAR, MONTH)


_NAMES = list(INDICATORS)


@query("indicator_map", f"""SELECT '{_NAMES[0]}' AS indicator, substr(region_code, 1, 5) AS key,
    yoy_pct AS value FROM ({_SALE_YOY}) WHERE date = DATE '1999-05-01'
  UNION ALL SELECT '{_NAMES[1]}', substr(region_code, 1, 5), yoy_pct FROM ({_LEASE_YOY})
    WHERE date = DATE '1999-05-01'
  UNION ALL SELECT '{_NAMES[2]}', substr(region_code, 1, 5), ratio
    FROM ({_RATIO.format(like='NOT LIKE')}) WHERE date = DATE '1999-05-01'
  UNION ALL SELECT '{_NAMES[3]}', sig_kor_nm, CAST(volume AS DOUBLE) FROM ({_VOLUME})""",
       "sale_index lease_index lease_ratio sales_parts")
def indicator_map(v):
    return I.indicator_long(maps(v))


_CODES = ["11001", "12002", "14009", "15025"]
_CODE_LIST = ", ".join(f"'{c}'" for c in _CODES)


@query("index_timeseries_district", f"""SELECT 'yoy' AS kind, date, substr(region_code, 1, 5) AS sig_cd,
    region_name, yoy_pct AS value FROM ({_SALE_YOY})
    WHERE substr(region_code, 1, 5) IN ({_CODE_LIST}) AND year(date) BETWEEN 1997 AND 2000
  UNION ALL SELECT 'direct', date, substr(region_code, 1, 5), region_name, ratio
    FROM ({_RATIO.format(like='NOT LIKE')})
    WHERE substr(region_code, 1, 5) IN ({_CODE_LIST}) AND year(date) BETWEEN 1997 AND 2000""",
       "sale_index lease_ratio")
def _(v):
    yoy = I.timeseries_district("yoy", v.sale_index, _CODES, 1997, 2000)
    ratio = I.timeseries_district("direct", v.lease_ratio, _CODES, 1997, 2000)
    return yoy.withColumn("kind", F.lit("yoy")).unionByName(ratio.withColumn("kind", F.lit("direct")))


@query("index_timeseries_province", f"""SELECT 'yoy' AS kind, date, '' AS sig_cd, region_name,
    yoy_pct AS value FROM ({_PROVINCE_YOY})
    WHERE region_name IN ('서울', '충남') AND year(date) BETWEEN 1996 AND 2001
  UNION ALL SELECT 'direct', date, '', region_name, ratio FROM ({_RATIO.format(like='LIKE')})
    WHERE region_name IN ('서울', '충남') AND year(date) BETWEEN 1996 AND 2001""",
       "sale_index lease_ratio")
def _(v):
    names = ["서울", "충남"]
    yoy = I.timeseries_province("yoy", v.sale_index, names, 1996, 2001)
    ratio = I.timeseries_province("direct", v.lease_ratio, names, 1996, 2001)
    return yoy.withColumn("kind", F.lit("yoy")).unionByName(ratio.withColumn("kind", F.lit("direct")))


def _made(v):
    return X.precomputed_yoy(v.sale_index)


@query("yoy_map_precomputed", f"""SELECT substr(region_code, 1, 5) AS sig_cd, region_name, yoy_pct
  FROM ({_SALE_YOY}) WHERE date = DATE '1999-05-01'""", "sale_index")
def _(v):
    return I.yoy_map(v.sale_index, YEAR, MONTH, _made(v))


@query("index_timeseries_precomputed", f"""SELECT 'district' AS kind, date, substr(region_code, 1, 5) AS sig_cd,
    region_name, yoy_pct AS value FROM ({_SALE_YOY})
    WHERE substr(region_code, 1, 5) IN ({_CODE_LIST}) AND year(date) BETWEEN 1997 AND 2000
  UNION ALL SELECT 'province', date, '', region_name, yoy_pct FROM ({_PROVINCE_YOY})
    WHERE region_name IN ('서울', '충남') AND year(date) BETWEEN 1996 AND 2001""", "sale_index")
def _(v):
    district = I.timeseries_district("yoy", v.sale_index, _CODES, 1997, 2000, _made(v))
    province = I.timeseries_province("yoy", v.sale_index, ["서울", "충남"], 1996, 2001, _made(v))
    return district.withColumn("kind", F.lit("district")).unionByName(
        province.withColumn("kind", F.lit("province")))


@query("yoy_date_range_precomputed", f"SELECT {_BOUNDS} FROM ({_SALE_YOY})", "sale_index")
def _(v):
    return X.yoy_date_range(v.sale_index, _made(v))


@query("table_or_fallback_table", f"SELECT date, region_code, yoy_pct FROM ({_SALE_YOY})", "sale_index")
def _(v):
    """The table is there, so what would be computed instead (nothing) is not."""
    from danji.sources.tables import table_or_fallback

    name = f"sale_index_yoy_{abs(hash(v.sf_dir))}"
    _made(v).createOrReplaceTempView(name)
    rows = table_or_fallback(v.spark, name, lambda: v.sale_index.limit(0))
    return rows.filter("level = '시군구'").select("date", "region_code", "yoy_pct")


_MONTHS = [f"{y}-{m:02d}" for y in range(1996, 2002) for m in range(1, 13)]


@query("heatmap_pivot", "SELECT region_name, " + ", ".join(
    f"""first(yoy_pct ORDER BY region_code) FILTER (WHERE strftime(date, '%Y-%m') = '{m}') AS "{m}" """
    for m in _MONTHS) + f" FROM ({_SALE_YOY}) GROUP BY region_name", "sale_index")
def _(v):
    series = I.timeseries_district("yoy", v.sale_index, None, 1996, 2001)
    return X.heatmap_pivot(series, _MONTHS)


@query("color_scale_bounds", f"""WITH a AS (SELECT yoy_pct AS x FROM ({_SALE_YOY})
    WHERE date = DATE '1999-05-01'), b AS (SELECT CAST(volume AS DOUBLE) AS x FROM ({_VOLUME})),
  s AS (SELECT 'yoy' AS kind, min(x) AS lo, max(x) AS hi, median(x) AS mid FROM a
    UNION ALL SELECT 'volume', min(x), max(x), median(x) FROM b),
  c AS (SELECT kind, lo, hi, CASE WHEN lo < 0 THEN 0 ELSE mid END AS center FROM s)
  SELECT kind, center, center - greatest(abs(lo - center), abs(hi - center)) AS vmin,
    center + greatest(abs(lo - center), abs(hi - center)) AS vmax FROM c""", "sale_index sales_parts")
def _(v):
    yoy = X.color_scale_bounds(X.yoy_point_join(v.sale_index, YEAR, MONTH), "yoy_pct")
    volume = X.color_scale_bounds(X.district_trade_volume(v.sales, YEAR * 100 + MONTH), "volume")
    return yoy.withColumn("kind", F.lit("yoy")).unionByName(
        volume.withColumn("kind", F.lit("volume")))
