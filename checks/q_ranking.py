"""The volume pivot, its parts, and the ranking."""

from pyspark.sql import functions as F

from checks.q_joins import DERIVED
from checks.registry import query
from checks.views import AS_OF_YEAR
from danji.operators import coords as K, ranking as R, regions as G
from danji.plans import ranking as plan

_VOLUMES = f"""volumes AS (SELECT sido, sigungu, emd, address, complex, built_year, age_band, area_band,
    contract_year, road, road_key, count(*) AS n FROM ({DERIVED.format(table='sales_parts')}) GROUP BY ALL)"""
_EMDS = """emds AS (SELECT sido, sigungu, complex, emd AS best_emd FROM
    (SELECT sido, sigungu, complex, emd, row_number() OVER (PARTITION BY sido, sigungu, complex
        ORDER BY count(*) DESC, emd) AS r FROM sales_parts WHERE emd <> ''
      GROUP BY sido, sigungu, complex, emd) WHERE r = 1)"""
_BEST = """best AS (SELECT sido, sigungu, emd, complex, road_key, min(lon) AS best_lon, min(lat) AS best_lat
  FROM sales_parts s JOIN coords ON key_prefix || ' ' || s.road = road_key WHERE emd <> '' GROUP BY ALL)"""
_BEST_ONE = f"""{_BEST.replace('best AS', 'roads AS')},
  best AS (SELECT sido, sigungu, emd, complex, road_key, best_lon, best_lat FROM
    (SELECT *, row_number() OVER (PARTITION BY sido, sigungu, emd, complex
      ORDER BY length(road_key) DESC, road_key) AS r FROM roads) WHERE r = 1)"""
_SIZES = """sizes AS (SELECT regexp_replace(lot_address, ' [0-9-]+$', '') AS lot_base,
    split_part(complex, ' ', 1) AS first_word, max(households) AS households
  FROM complexes WHERE kind_code = '1' GROUP BY 1, 2)"""


def _pivot_sql(best: str) -> str:
    return f"""{_VOLUMES}, {_EMDS}, {best}, {_SIZES},
  filled AS (SELECT v.* EXCLUDE (emd), CASE WHEN v.emd = '' THEN best_emd ELSE v.emd END AS emd, c.lon, c.lat
    FROM volumes v LEFT JOIN coords c USING (road_key) LEFT JOIN emds USING (sido, sigungu, complex)),
  pivot_rows AS (SELECT f.sido, f.sigungu, f.emd, f.complex, built_year, age_band, area_band, contract_year, n,
      households, CASE WHEN households > 0 THEN round(n * 100.0::DOUBLE / households, 2) END AS turnover,
      coalesce(best_lon, lon) AS lon, coalesce(best_lat, lat) AS lat
    FROM filled f LEFT JOIN best b ON f.sido = b.sido AND f.sigungu = b.sigungu AND f.emd = b.emd
        AND f.complex = b.complex
      LEFT JOIN sizes ON lot_base = f.sido || ' ' || f.sigungu || ' ' || f.emd AND first_word = f.complex
    WHERE coalesce(best_lon, lon) IS NOT NULL AND coalesce(best_lat, lat) IS NOT NULL)"""


_PIVOT = _pivot_sql(_BEST)
_NEED = "sales_parts coords complexes"


def pivot(v, **options):
    return plan.complex_pivot(v.sales, v.coords, v.complexes, AS_OF_YEAR, **options)


def _volumes(v):
    return R.volume_by_complex(v.sales, AS_OF_YEAR)


@query("volume_by_complex", f"WITH {_VOLUMES} SELECT * FROM volumes", "sales_parts")
def _(v):
    return _volumes(v)


@query("best_emd", f"WITH {_EMDS} SELECT * FROM emds", "sales_parts")
def _(v):
    return R.best_emd(v.sales)


@query("best_coords", f"WITH {_BEST} SELECT * FROM best", "sales_parts coords")
def _(v):
    return R.best_coords(v.sales, v.coords)


@query("best_coords_longest_road", f"WITH {_BEST_ONE} SELECT * FROM best", "sales_parts coords")
def _(v):
    return R.best_coords(v.sales, v.coords, dedupe=True)


@query("households_lookup", f"WITH {_SIZES} SELECT * FROM sizes", "complexes")
def _(v):
    return R.households_lookup(v.complexes)


@query("join_best_emd", f"""WITH {_VOLUMES}, {_EMDS} SELECT sido, sigungu, complex,
    CASE WHEN emd = '' THEN best_emd ELSE emd END AS emd, area_band, contract_year,
    CAST(sum(n) AS BIGINT) AS n FROM volumes LEFT JOIN emds USING (sido, sigungu, complex) GROUP BY ALL""",
       "sales_parts")
def _(v):
    named = R.join_best_emd(_volumes(v), R.best_emd(v.sales))
    return named.groupBy("sido", "sigungu", "complex", "emd", "area_band", "contract_year").agg(
        F.sum("n").alias("n"))


@query("join_best_coords", f"""WITH {_VOLUMES}, {_BEST} SELECT v.sido, v.sigungu, v.emd, v.complex, v.n,
    v.contract_year, coalesce(best_lon, lon) AS lon, coalesce(best_lat, lat) AS lat
  FROM volumes v LEFT JOIN coords USING (road_key) LEFT JOIN best b ON v.sido = b.sido
    AND v.sigungu = b.sigungu AND v.emd = b.emd AND v.complex = b.complex""", "sales_parts coords")
def _(v):
    located = _volumes(v).join(v.coords, "road_key", "left")
    return R.join_best_coords(located, R.best_coords(v.sales, v.coords)).select(
        "sido", "sigungu", "emd", "complex", "n", "contract_year", "lon", "lat")


@query("join_households_exact", f"""WITH {_VOLUMES}, {_SIZES} SELECT sido, sigungu, emd, complex, n,
    contract_year, households,
    CASE WHEN households > 0 THEN round(n * 100.0::DOUBLE / households, 2) END AS turnover
  FROM volumes LEFT JOIN sizes ON lot_base = sido || ' ' || sigungu || ' ' || emd AND first_word = complex""",
       "sales_parts complexes")
def _(v):
    return R.join_households_exact(_volumes(v), R.households_lookup(v.complexes)).select(
        "sido", "sigungu", "emd", "complex", "n", "contract_year", "households", "turnover")


@query("complex_pivot", f"WITH {_PIVOT} SELECT * FROM pivot_rows", _NEED)
def complex_pivot(v):
    return pivot(v)


def _lease_sql(kind: str) -> str:
    rows = f"leases_parts AS (SELECT * FROM rents_parts WHERE rent_kind = '{kind}')"
    return f"WITH {rows}, {_PIVOT.replace('sales_parts', 'leases_parts')} SELECT '{kind}' AS kind, * FROM pivot_rows"


for _kind, _name in (("전세", "complex_pivot_lease"), ("월세", "complex_pivot_monthly_rent")):
    @query(_name, _lease_sql(_kind), "rents_parts coords complexes")
    def _(v, kind=_kind):
        rents = v.rents.filter(F.col("rent_kind") == kind)
        return plan.complex_pivot(rents, v.coords, v.complexes, AS_OF_YEAR).withColumn("kind", F.lit(kind))


@query("complex_pivot_longest_road", f"WITH {_pivot_sql(_BEST_ONE)} SELECT * FROM pivot_rows", _NEED)
def _(v):
    return pivot(v, dedupe_coords=True)


@query("complex_pivot_region", f"""WITH {_PIVOT} SELECT * FROM pivot_rows WHERE sido = '서울특별시'
  AND sigungu IN ('중구', '동구') AND contract_year BETWEEN 1997 AND 1999
  AND (households IS NULL OR households BETWEEN 200 AND 1500)""", _NEED)
def _(v):
    return pivot(v, sido="서울특별시", sigungu=["중구", "동구"], year_from=1997, year_to=1999,
                 households=(200, 1500))


def _first(column: str) -> str:
    return f"""first({column} ORDER BY n DESC, contract_year DESC, area_band DESC, built_year DESC,
      lon DESC, lat DESC) FILTER (WHERE {column} IS NOT NULL) AS {column}"""


_ROLLUP = f"""{_PIVOT}, summed AS (SELECT sido, sigungu, emd, complex, CAST(sum(n) AS BIGINT) AS n,
    {_first('lon')}, {_first('lat')}, {_first('built_year')}, {_first('age_band')}, {_first('households')}
  FROM pivot_rows WHERE emd IS NOT NULL GROUP BY sido, sigungu, emd, complex),
  rolled AS (SELECT *, CASE WHEN households > 0 THEN round(n * 100.0::DOUBLE / households, 2) END AS turnover
    FROM summed)"""


@query("complex_rollup", f"WITH {_ROLLUP} SELECT * FROM rolled", _NEED)
def _(v):
    return R.complex_rollup(pivot(v))


@query("top_complexes", f"""WITH {_ROLLUP} SELECT * FROM rolled WHERE turnover IS NOT NULL
  ORDER BY turnover DESC, sido, sigungu, emd, complex LIMIT 20""", _NEED)
def _(v):
    return R.top_complexes(R.complex_rollup(pivot(v)), "turnover", 20)


_RANKED = f"""WITH {_ROLLUP} SELECT row_number() OVER (ORDER BY n DESC, sido, sigungu, emd, complex) AS rank,
    complex, sigungu, emd, built_year, age_band, n, households, turnover FROM rolled
  ORDER BY rank LIMIT {{limit}}"""


@query("complex_ranking", _RANKED.format(limit=20), _NEED)
def complex_ranking(v):
    return plan.complex_ranking(pivot(v))


@query("rank_number", _RANKED.format(limit=50), _NEED)
def _(v):
    return plan.complex_ranking(pivot(v), limit=50)


_YEARS = list(range(1995, 2002))


def _year_pivot_sql(value: str, cast: str) -> str:
    columns = ", ".join(
        f'{cast.format(f"sum({value}) FILTER (WHERE contract_year = {y})")} AS "{y}"' for y in _YEARS)
    return f"""WITH {_PIVOT} SELECT sido, sigungu, emd, complex, built_year, age_band, area_band, households,
    lon, lat, {columns} FROM pivot_rows WHERE emd IS NOT NULL AND households IS NOT NULL
  GROUP BY sido, sigungu, emd, complex, built_year, age_band, area_band, households, lon, lat"""


@query("year_pivot_volume", _year_pivot_sql("n", "CAST({} AS BIGINT)"), _NEED)
def _(v):
    return R.year_pivot(pivot(v), "n", _YEARS)


@query("year_pivot_turnover", _year_pivot_sql("turnover", "round({}, 6)"), _NEED)
def _(v):
    wide = R.year_pivot(pivot(v), "turnover", _YEARS)
    return wide.withColumns({str(y): F.round(str(y), 6) for y in _YEARS})


@query("max_households_ceil", """SELECT CAST(ceil(max(households) / 1000.0) * 1000 AS INTEGER)
  AS max_households FROM complexes""", "complexes")
def _(v):
    return R.max_households_ceil(v.complexes)


@query("region_hierarchy", """SELECT DISTINCT '매매' AS kind, sido, sigungu, emd FROM sales_parts
    WHERE sido <> '' AND sigungu <> '' AND emd <> ''
  UNION ALL SELECT DISTINCT rent_kind, sido, sigungu, emd FROM rents_parts
    WHERE sido <> '' AND sigungu <> '' AND emd <> ''""", "sales_parts rents_parts")
def _(v):
    out = R.region_hierarchy(v.sales).withColumn("kind", F.lit("매매"))
    for kind in ("전세", "월세"):
        part = R.region_hierarchy(v.rents.filter(F.col("rent_kind") == kind))
        out = out.unionByName(part.withColumn("kind", F.lit(kind)))
    return out


@query("region_tree", """SELECT sido, sigungu, string_agg(DISTINCT emd, ',' ORDER BY emd) AS emds
  FROM sales_parts WHERE sido <> '' AND sigungu <> '' AND emd <> '' GROUP BY 1, 2""", "sales_parts")
def _(v):
    tree = R.region_tree(R.region_hierarchy(v.sales))
    return tree.select("sido", F.explode("districts").alias("sigungu", "emds")).withColumn(
        "emds", F.array_join("emds", ","))


@query("distinct_regions", """SELECT DISTINCT sido, sigungu, emd FROM sales_parts""", "sales_parts")
def _(v):
    from danji.functions.address import with_region_columns

    return with_region_columns(v.sales.select("address").distinct()).select(
        "sido", "sigungu", "emd").distinct()


@query("match_coverage", f"""WITH {_PIVOT} SELECT count(*) AS total, count(households) AS with_households,
  count(lon) AS with_coords FROM pivot_rows""", _NEED)
def _(v):
    return K.match_coverage(pivot(v))


@query("map_extent", f"""WITH {_ROLLUP}, top AS (SELECT * FROM rolled
    ORDER BY n DESC, sido, sigungu, emd, complex LIMIT 20)
  SELECT round(avg(lon), 6) AS center_lon, round(avg(lat), 6) AS center_lat, min(lon) AS min_lon,
    max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat FROM top""", _NEED)
def _(v):
    extent = G.map_extent(R.top_complexes(R.complex_rollup(pivot(v))))
    return extent.withColumns({c: F.round(c, 6) for c in ("center_lon", "center_lat")})
