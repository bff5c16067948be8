"""Table profiles and top lists."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views_sql import MARKET, PYEONG_BAND
from danji.functions import filters as C, region as R
from danji.operators import index as X, profile as P


@query("distinct_code_counts", """SELECT 'length' AS kind, CAST(length(region_code) AS VARCHAR) AS item,
    count(DISTINCT region_code) AS n FROM sale_index WHERE asset_kind = '아파트' AND freq = '월간'
    GROUP BY ALL
  UNION ALL SELECT 'districts', '5', count(DISTINCT substr(region_code, 1, 5)) FROM sale_index
    WHERE region_code NOT LIKE '%00000000'
  UNION ALL SELECT 'months', asset_kind, count(DISTINCT date) FROM sale_index GROUP BY ALL""", "sale_index")
def _(v):
    lengths = P.distinct_code_counts(v.sale_index).select(
        F.lit("length").alias("kind"), F.col("code_length").cast("string").alias("item"),
        F.col("n_codes").alias("n"))
    districts = v.sale_index.filter(C.region_level("시군구")).agg(
        F.count_distinct(R.district_code(F.col("region_code"))).alias("n")).select(
        F.lit("districts").alias("kind"), F.lit("5").alias("item"), "n")
    months = P.distinct_months(v.sale_index).select(
        F.lit("months").alias("kind"), F.col("asset_kind").alias("item"), F.col("n_months").alias("n"))
    return lengths.unionByName(districts).unionByName(months)


@query("category_counts", """SELECT 'rent_kind' AS kind, rent_kind AS category, count(*) AS n FROM rents
    GROUP BY ALL
  UNION ALL SELECT 'deal_type', deal_type, count(*) FROM sales GROUP BY ALL
  UNION ALL SELECT 'freq', freq, count(*) FROM sale_index WHERE asset_kind = '아파트' GROUP BY ALL
  UNION ALL SELECT 'words', CAST(len(string_split(regexp_replace(address, '\\s+', ' ', 'g'), ' '))
    AS VARCHAR), count(*) FROM sales GROUP BY ALL""", "sales rents sale_index")
def _(v):
    def named(df, kind):
        return df.withColumn("kind", F.lit(kind))

    words = P.word_counts(v.sales).select(F.col("word_count").cast("string").alias("category"), "n")
    index = v.sale_index.filter(F.col("asset_kind") == "아파트")
    return (
        named(P.category_counts(v.rents, F.col("rent_kind")), "rent_kind")
        .unionByName(named(P.category_counts(v.sales, F.col("deal_type")), "deal_type"))
        .unionByName(named(P.category_counts(index, F.col("freq")), "freq"))
        .unionByName(named(words, "words"))
    )


@query("households_by_kind", """SELECT kind_code, count(*) AS n, CAST(sum(households) AS BIGINT) AS households
  FROM complexes GROUP BY 1""", "complexes")
def _(v):
    return P.households_by_kind(v.complexes)


@query("households_by_province", """SELECT split_part(lot_address, ' ', 1) AS sido, count(*) AS n,
  CAST(sum(households) AS BIGINT) AS households FROM complexes WHERE kind_code = '1' GROUP BY 1""",
       "complexes")
def _(v):
    return P.households_by_province(v.complexes)


@query("table_counts", """SELECT 'sales' AS table_name, count(*) AS n FROM sales
  UNION ALL SELECT 'rents', count(*) FROM rents UNION ALL SELECT 'coords', count(*) FROM coords
  UNION ALL SELECT 'complexes', count(*) FROM complexes""", "sales rents coords complexes")
def _(v):
    return P.table_counts(
        {"sales": v.sales, "rents": v.rents, "coords": v.coords, "complexes": v.complexes})


@query("index_profile", """SELECT count(*) AS n, min(date) AS first_date, max(date) AS last_date
  FROM sale_index WHERE asset_kind = '아파트' AND freq = '월간'""", "sale_index")
def _(v):
    return P.index_profile(v.sale_index)


@query("describe_metric", """WITH d AS (SELECT * FROM sale_index WHERE asset_kind = '아파트' AND freq = '월간'
    AND region_code NOT LIKE '%00000000'),
  y AS (SELECT round((c.index_value - p.index_value) / p.index_value * 100, 1) AS v
    FROM d c JOIN d p ON c.region_code = p.region_code AND c.date = CAST(p.date + INTERVAL 1 YEAR AS DATE))
  SELECT count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
    round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
    round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS max FROM y""", "sale_index")
def _(v):
    rows = P.describe_metric(X.yoy_self_join(v.sale_index, "시군구"), "yoy_pct")
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q1", "median", "q3")})


@query("filter_effect", f"""SELECT count(*) AS total, count(*) FILTER (WHERE {MARKET}) AS kept,
    count(*) - count(*) FILTER (WHERE {MARKET}) AS excluded,
    round((count(*) - count(*) FILTER (WHERE {MARKET})) * 100.0::DOUBLE / count(*), 1) AS excluded_pct
  FROM sales""", "sales")
def _(v):
    return P.filter_effect(v.sales)


@query("area_profile", f"""SELECT area_m2, CAST(floor(area_m2 * 0.4) AS INTEGER) AS pyeong,
    {PYEONG_BAND} AS pyeong_band, count(*) AS n FROM sales GROUP BY 1, 2, 3 ORDER BY 1 LIMIT 15""", "sales")
def _(v):
    return P.area_profile(v.sales)


@query("band_share", f"""SELECT {PYEONG_BAND} AS pyeong_band, count(*) AS n, min(area_m2) AS min_area,
    round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM sales), 1) AS share FROM sales GROUP BY 1""",
       "sales")
def _(v):
    return P.band_share(v.sales)


@query("code_overlap", """WITH a AS (SELECT DISTINCT substr(region_code, 1, 5) AS c FROM sale_index
    WHERE region_code NOT LIKE '%00000000' AND date = DATE '1999-05-01'),
  b AS (SELECT DISTINCT substr(region_code, 1, 5) AS c FROM lease_index
    WHERE region_code NOT LIKE '%00000000' AND date = DATE '1995-03-01')
  SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right,
    (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS n_both""",
       "sale_index lease_index")
def _(v):
    def codes(index, day):
        rows = index.filter((F.col("date") == F.lit(day).cast("date")) & C.region_level("시군구"))
        return rows.select(R.district_code(F.col("region_code")).alias("sig_cd"))

    return P.code_overlap(codes(v.sale_index, "1999-05-01"), codes(v.lease_index, "1995-03-01"))


@query("sample_rows", "SELECT 10 AS n, 0 AS n_foreign")
def _(v):
    """Ten rows, and how many of them are no rows of the table."""
    drawn = P.sample_rows(v.sales, 10, seed=7)
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in v.sales.columns]
    foreign = drawn.alias("d").join(v.sales.alias("s"), same, "left_anti")
    return drawn.select(F.lit(1).alias("n"), F.lit(0).alias("n_foreign")).unionByName(
        foreign.select(F.lit(0).alias("n"), F.lit(1).alias("n_foreign"))).agg(
        F.sum("n").alias("n"), F.sum("n_foreign").alias("n_foreign"))


@query("top_districts", """SELECT 'volume' AS kind, * FROM (SELECT CASE sido WHEN '세종특별자치시' THEN sido
      ELSE sigungu END AS name, CAST(count(*) AS DOUBLE) AS value FROM sales_parts
    WHERE ym = 199905 AND deal_type <> '직거래' AND (cancelled_on IS NULL OR cancelled_on IN ('', 'None', '-'))
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
  UNION ALL SELECT 'address', * FROM (SELECT address, CAST(count(*) AS DOUBLE) FROM sales GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 5)""", "sales_parts")
def _(v):
    volume = P.top_by(X.district_trade_volume(v.sales, 199905), "volume", 10, "sig_kor_nm").select(
        F.lit("volume").alias("kind"), F.col("sig_kor_nm").alias("name"),
        F.col("volume").cast("double").alias("value"))
    address = P.top_by(P.category_counts(v.sales, F.col("address")), "n", 5, "category").select(
        F.lit("address").alias("kind"), F.col("category").alias("name"),
        F.col("n").cast("double").alias("value"))
    return volume.unionByName(address)


@query("ordered_outputs", """SELECT ym, deal_type, count(*) AS n FROM sales GROUP BY ALL
  ORDER BY ym, n DESC, deal_type""", "sales")
def _(v):
    counted = v.sales.groupBy("ym", "deal_type").agg(F.count("*").alias("n"))
    return P.ordered_output(counted, "ym", "-n", "deal_type")
