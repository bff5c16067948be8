"""Region labels, codes, boundaries and the map feed."""

from pyspark.sql import functions as F

from checks.q_index import MONTH, YEAR, maps
from checks.registry import query
from danji.constants import INDICATORS
from danji.functions import region as R
from danji.operators import index as X, ranking, regions as G
from danji.plans import feeds

_PLACES = """spots AS (SELECT DISTINCT sido AS province, sigungu AS name FROM sales_parts
  WHERE sido <> '' AND sigungu <> '' AND emd <> '')"""
_LABELLED = f"""{_PLACES}, counted AS (SELECT name, count(*) AS frequency FROM spots GROUP BY name),
  labelled AS (SELECT province, name, frequency, CASE WHEN frequency > 1
    THEN name || ' (' || province || ')' ELSE name END AS label FROM spots JOIN counted USING (name))"""


def places(v):
    return ranking.region_hierarchy(v.sales).select(
        F.col("sido").alias("province"), F.col("sigungu").alias("name")).distinct()


@query("disambiguate_region_label", f"WITH {_LABELLED} SELECT province, name, frequency, label FROM labelled",
       "sales_parts")
def _(v):
    return G.disambiguate_region_label(places(v))


@query("label_frequency", f"WITH {_LABELLED} SELECT DISTINCT name, frequency FROM labelled", "sales_parts")
def _(v):
    return G.label_frequency(places(v)).select("name", "frequency").distinct()


@query("parse_region_label", f"""WITH {_LABELLED} SELECT label, name,
  CASE WHEN frequency > 1 THEN province END AS province FROM labelled""", "sales_parts")
def _(v):
    label = F.col("label")
    labels = G.disambiguate_region_label(places(v)).select("label").distinct()
    return labels.select("label", R.label_name(label).alias("name"),
                         R.label_province(label).alias("province"))


_GEO_LABELS = """labels AS (SELECT DISTINCT full_nm, sig_kor_nm, province, CASE WHEN
    count(*) OVER (PARTITION BY sig_kor_nm) > 1 THEN sig_kor_nm || ' (' || province || ')'
    ELSE sig_kor_nm END AS label FROM regions_geo)"""


@query("region_code_lookup", f"""WITH {_GEO_LABELS},
  picked AS (SELECT max(g.sig_cd) AS sig_cd FROM labels l JOIN regions_geo g ON g.sig_kor_nm = l.sig_kor_nm
    AND (l.label NOT LIKE '% (%)' OR g.province = l.province) GROUP BY l.label)
  SELECT DISTINCT sig_cd FROM picked""", "regions_geo")
def _(v):
    named = v.regions_geo.select(
        F.split_part("full_nm", F.lit(" "), F.lit(1)).alias("province"),
        F.col("sig_kor_nm").alias("name"))
    labels = G.disambiguate_region_label(named).select(
        "label", F.lit(None).cast("string").alias("province"))
    return G.region_code_lookup(v.regions_geo, labels)


_CHOSEN = """('서울특별시'), ('경기도')"""


@query("resolve_region_selection", f"""WITH {_PLACES}, chosen(province) AS (VALUES {_CHOSEN}),
  picked(name, given) AS (VALUES ('중구', '부산광역시'), ('동구', NULL), ('북시 북구', NULL)),
  wide AS (SELECT given AS province FROM picked WHERE given IS NOT NULL UNION SELECT province FROM chosen)
  SELECT 'wide' AS mode, province, name FROM spots WHERE province IN (SELECT province FROM wide)
    AND name IN (SELECT name FROM picked)
  UNION ALL SELECT DISTINCT 'exact', p.province, p.name FROM spots p JOIN picked k ON p.name = k.name
    AND (p.province = k.given OR (k.given IS NULL AND p.province IN (SELECT province FROM chosen)))""",
       "sales_parts")
def _(v):
    labels = v.spark.createDataFrame(
        [("중구 (부산광역시)",), ("동구",), ("북시 북구",)], "label string")
    chosen = v.spark.createDataFrame([("서울특별시",), ("경기도",)], "province string")
    wide = G.resolve_region_selection(labels, chosen, places(v))
    exact = G.resolve_region_selection(labels, chosen, places(v), exact=True)
    return wide.select(F.lit("wide").alias("mode"), "province", "name").unionByName(
        exact.select(F.lit("exact").alias("mode"), "province", "name"))


@query("region_lists", """SELECT DISTINCT 'province' AS kind, province AS item FROM regions_geo
  UNION ALL SELECT 'district', sig_kor_nm FROM regions_geo WHERE full_nm LIKE '경기도%'""", "regions_geo")
def _(v):
    return G.province_list(v.regions_geo).select(
        F.lit("province").alias("kind"), F.col("province").alias("item")).unionByName(
        G.district_list(v.regions_geo, "경기도").select(
            F.lit("district").alias("kind"), F.col("sig_kor_nm").alias("item")))


_CENTROIDS = """SELECT *, CASE WHEN geometry_type = 'Polygon' THEN (4 * n_nationkey + 404) / 4.0
    ELSE (4 * n_nationkey + 406) / 7.0 END::DOUBLE AS centroid_lon,
  CASE WHEN geometry_type = 'Polygon' THEN (4 * n_nationkey + 127) / 4.0
    ELSE (4 * n_nationkey + 130) / 7.0 END::DOUBLE AS centroid_lat FROM regions_geo"""


@query("region_centroids", f"""SELECT sig_cd, round(centroid_lon, 6) AS centroid_lon,
  round(centroid_lat, 6) AS centroid_lat FROM ({_CENTROIDS})""", "regions_geo")
def _(v):
    return G.region_centroids(v.regions_geo).select(
        "sig_cd", F.round("centroid_lon", 6).alias("centroid_lon"),
        F.round("centroid_lat", 6).alias("centroid_lat"))


_VOLUME = """volumes AS (SELECT CASE sido WHEN '세종특별자치시' THEN sido ELSE sigungu END AS key,
    count(*) AS value FROM sales_parts WHERE ym = 199905 AND deal_type <> '직거래'
    AND (cancelled_on IS NULL OR cancelled_on IN ('', 'None', '-')) GROUP BY 1)"""


def _volume_values(v):
    return X.district_trade_volume(v.sales, YEAR * 100 + MONTH).select(
        F.col("sig_kor_nm").alias("key"), F.col("volume").alias("value"))


@query("regions_with_indicator", f"""WITH {_VOLUME} SELECT sig_cd, sig_kor_nm, value
  FROM regions_geo LEFT JOIN volumes ON key = sig_kor_nm""", "sales_parts regions_geo")
def _(v):
    return G.regions_with_indicator(v.regions_geo, _volume_values(v)).select(
        "sig_cd", "sig_kor_nm", "value")


@query("choropleth_feed", f"""WITH c AS ({_CENTROIDS}), r AS (SELECT substr(region_code, 1, 5) AS sig_cd, ratio
    FROM lease_ratio WHERE asset_kind = '아파트' AND date = DATE '1999-05-01'
      AND region_code NOT LIKE '%00000000')
  SELECT sig_cd, full_nm, ratio AS value, sig_kor_nm || chr(10) || printf('%.1f', ratio) || '%' AS label,
    round(centroid_lon, 6) AS centroid_lon, round(centroid_lat, 6) AS centroid_lat
  FROM c LEFT JOIN r USING (sig_cd) WHERE full_nm LIKE '서울특별시%' OR full_nm LIKE '경기도%'""",
       "regions_geo lease_ratio")
def choropleth_feed(v):
    ratio = maps(v)[list(INDICATORS)[2]].select(
        F.col("sig_cd").alias("key"), F.col("ratio").alias("value"))
    layer = feeds.choropleth_feed(v.regions_geo, ratio, ["서울특별시", "경기도"])["layer"]
    return layer.select(
        "sig_cd", "full_nm", "value", "label", F.round("centroid_lon", 6).alias("centroid_lon"),
        F.round("centroid_lat", 6).alias("centroid_lat"))
