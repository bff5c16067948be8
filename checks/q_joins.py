"""Row-level enrichment, the preprocessor, and the coordinate table's upkeep."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import AS_OF_YEAR
from checks.views_sql import AGE_BAND, AREA_BAND, PYEONG_BAND
from danji.operators import coords as K, enrich as E
from danji.operators.skew import counted
from danji.plans.preprocess import derive_trade_columns, preprocess_trades


@query("join_coords", """SELECT address, s.road, lat, lon, count(*) AS n,
    CAST(sum(price) AS BIGINT) AS total
  FROM sales_parts s LEFT JOIN coords ON key_prefix || ' ' || s.road = road_key GROUP BY ALL""",
       "sales_parts coords")
def _(v):
    joined = E.join_coords(v.sales, v.coords)
    return joined.groupBy("address", "road", "lat", "lon").agg(
        F.count("*").alias("n"), F.sum("price").alias("total"))


_HOUSEHOLDS = """SELECT complex, split_part(lot_address, ' ', 2) AS area_word,
    max(households) AS households FROM complexes GROUP BY 1, 2"""


@query("households_max", _HOUSEHOLDS, "complexes")
def _(v):
    return E.households_max(v.complexes)


@query("join_households_simple", f"""WITH h AS ({_HOUSEHOLDS})
  SELECT address, s.complex, h.households, count(*) AS n FROM sales s LEFT JOIN h
    ON s.complex = h.complex AND split_part(address, ' ', 2) = area_word GROUP BY ALL""",
       "sales complexes")
def _(v):
    joined = E.join_households_simple(v.sales, v.complexes)
    return joined.groupBy("address", "complex", "households").agg(F.count("*").alias("n"))


@query("preprocess_trades", f"""WITH h AS ({_HOUSEHOLDS})
  SELECT s.complex, address, sido, sigungu, emd, {AREA_BAND} AS area_band,
    CAST(floor(area_m2 * 0.4) AS INTEGER) AS pyeong, {PYEONG_BAND} AS pyeong_band,
    greatest(1, {AS_OF_YEAR} - built_year) AS age, {AGE_BAND} AS age_band, lat, lon, h.households,
    ym, day, price
  FROM sales_parts s LEFT JOIN coords ON key_prefix || ' ' || s.road = road_key
    LEFT JOIN h ON s.complex = h.complex AND split_part(address, ' ', 2) = area_word""",
       "sales_parts coords complexes")
def preprocess_all(v):
    done = preprocess_trades(
        v.sales, "all", as_of_year=AS_OF_YEAR, coords=v.coords, complexes=v.complexes)
    return done.select(
        "complex", "address", "sido", "sigungu", "emd", "area_band", "pyeong", "pyeong_band", "age",
        "age_band", "lat", "lon", "households", "ym", "day", "price")


DERIVED = f"""SELECT address, complex, area_m2, ym, built_year, road, sido, sigungu, emd,
    key_prefix || ' ' || road AS road_key, {AREA_BAND} AS area_band, area_m2 * 0.4 AS pyeong,
    {PYEONG_BAND} AS pyeong_band, ym // 100 AS contract_year,
    greatest({AS_OF_YEAR} - built_year, 1) AS age, {AGE_BAND} AS age_band
  FROM {{table}} WHERE road <> '' AND built_year > 0"""


@query("derive_trade_columns", DERIVED.format(table="sales_parts"), "sales_parts")
def _(v):
    return derive_trade_columns(v.sales, AS_OF_YEAR)


@query("coords_inner_by_filter", """SELECT address, s.road, lon, lat, count(*) AS n FROM sales_parts s
  JOIN coords ON key_prefix || ' ' || s.road = road_key GROUP BY ALL""", "sales_parts coords")
def _(v):
    joined = E.join_coords(counted(v.sales, "address", "road"), v.coords)
    return joined.filter("lon IS NOT NULL").select("address", "road", "lon", "lat", "n")


_KEYS = """keys AS (SELECT DISTINCT key_prefix || ' ' || road AS road_key, road FROM sales_parts
    WHERE road <> '' UNION SELECT key_prefix || ' ' || road, road FROM rents_parts WHERE road <> '')"""
_FOUND = f"""WITH {_KEYS}, single AS (SELECT road, any_value(road_key) AS full_key FROM keys GROUP BY road
    HAVING count(DISTINCT road_key) = 1),
  added AS (SELECT full_key AS road_key, lon, lat FROM coords JOIN single ON road_key = road
    WHERE full_key NOT IN (SELECT road_key FROM coords))"""


@query("addresses_to_geocode", f"""WITH {_KEYS} SELECT DISTINCT road_key FROM keys
  WHERE road_key NOT IN (SELECT road_key FROM coords)""", "sales_parts rents_parts coords")
def _(v):
    return K.addresses_to_geocode(v.coords, v.sales, v.rents)


@query("backfill_legacy_coords", f"""{_FOUND} SELECT road_key, lon, lat FROM coords
  UNION ALL SELECT road_key, lon, lat FROM added""", "sales_parts rents_parts coords")
def _(v):
    return K.backfill_legacy_coords(v.coords, v.sales, v.rents)


@query("coord_match_rate", """WITH keys AS (SELECT DISTINCT key_prefix || ' ' || road AS k FROM sales_parts
    WHERE road <> '')
  SELECT count(*) AS total_keys, count(road_key) AS matched,
    round(count(road_key) * 100.0::DOUBLE / count(*), 2) AS match_rate
  FROM keys LEFT JOIN coords ON k = road_key""", "sales_parts coords")
def _(v):
    return K.coord_match_rate(v.coords, v.sales)
