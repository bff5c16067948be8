"""Price and volume queries."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views_sql import EOK, MARKET, PYEONG_BAND
from danji.functions import filters as C
from danji.operators import prices as P
from danji.plans import feeds

def _both(v, chosen=None):
    """Both kinds of trades; the default is all of them."""
    everything = C.trade_filter_price()
    return P.sale_and_lease(v.sales, v.rents, everything if chosen is None else chosen)


_MONTHLY = f"""SELECT 'sale' AS kind, ym, round(median(price) / 10000.0::DOUBLE, 1) AS median_eok,
    count(*) AS volume FROM sales WHERE {MARKET} GROUP BY ym
  UNION ALL SELECT 'lease', ym, round(median(deposit) / 10000.0::DOUBLE, 1), count(*)
    FROM rents WHERE rent_kind = '전세' GROUP BY ym"""


@query("monthly_median_volume", _MONTHLY, "sales rents")
def monthly_median_volume(v):
    out = None
    for kind, (trades, amount) in _both(v).items():
        part = P.monthly_median_volume(trades, amount).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out.select("kind", "ym", "median_eok", "volume")


@query("monthly_median_district", f"""SELECT ym, round(median(price) / 10000.0::DOUBLE, 1) AS median_eok,
    count(*) AS volume FROM sales_parts
  WHERE sido = '서울특별시' AND sigungu = '중구' AND {PYEONG_BAND} = '30평대' AND {MARKET}
  GROUP BY ym""", "sales_parts")
def _(v):
    chosen = C.trade_filter_price(sido="서울특별시", sigungu="중구", pyeong_bands=["30평대"])
    trades, amount = _both(v, chosen)["sale"]
    return P.monthly_median_volume(trades, amount)


@query("monthly_median_approx", f"""SELECT ym, count(*) AS volume, true AS near FROM sales
  WHERE {MARKET} GROUP BY ym""", "sales")
def _(v):
    """Beside the exact one: it is a price between neighbours of the median, so they are near."""
    trades, amount = _both(v)["sale"]
    exact = P.monthly_median_volume(trades, amount).select("ym", F.col("median_eok").alias("exact"))
    near = F.abs(F.col("median_eok") - F.col("exact")) <= F.col("exact") * 0.25
    return P.monthly_median_approx(trades, amount).join(exact, "ym").select("ym", "volume", near.alias("near"))


@query("sales_summary", f"""SELECT count(*) AS n, coalesce({EOK.format('max(price)')}, 0) AS max_eok,
    coalesce({EOK.format('min(price)')}, 0) AS min_eok FROM sales WHERE {MARKET}""", "sales")
def _(v):
    return P.sales_summary(_both(v)["sale"][0])


@query("recent_sales", f"""SELECT ym, complex, area_m2, {EOK.format('price')} AS price_eok, floor_no
  FROM sales WHERE {MARKET} ORDER BY ym DESC, price DESC, complex, area_m2, floor_no LIMIT 3""", "sales")
def _(v):
    return P.recent_sales(_both(v)["sale"][0])


@query("sales_overview", f"""WITH kept AS (SELECT * FROM sales WHERE {MARKET})
  SELECT 'summary' AS part, NULL::INTEGER AS ym, NULL AS complex, count(*) AS n,
    {EOK.format('max(price)')} AS max_eok, {EOK.format('min(price)')} AS min_eok FROM kept
  UNION ALL (SELECT 'recent', ym, complex, NULL, {EOK.format('price')}, NULL FROM kept
    ORDER BY ym DESC, price DESC, complex, area_m2, floor_no LIMIT 3)""", "sales")
def _(v):
    parts = feeds.sales_overview(v.sales, C.trade_filter_price())
    return parts["summary"].withColumn("part", F.lit("summary")).unionByName(
        parts["recent"].select(
            F.lit("recent").alias("part"), "ym", "complex", F.col("price_eok").alias("max_eok")),
        allowMissingColumns=True,
    ).select("part", "ym", "complex", "n", "max_eok", "min_eok")


_INDIVIDUAL = f"""SELECT 'sale' AS kind, ym, complex, area_m2, {EOK.format('price')} AS price_eok, floor_no,
    CAST(floor(area_m2 * 0.4) AS INTEGER) AS pyeong, {PYEONG_BAND} AS pyeong_band
  FROM sales WHERE {MARKET}
  UNION ALL SELECT 'lease', ym, complex, area_m2, {EOK.format('deposit')}, floor_no,
    CAST(floor(area_m2 * 0.4) AS INTEGER), {PYEONG_BAND}
  FROM rents WHERE rent_kind = '전세'"""


def _individual(v):
    return {k: P.individual_trades(df, amount) for k, (df, amount) in _both(v).items()}


@query("individual_trades", _INDIVIDUAL, "sales rents")
def _(v):
    parts = _individual(v)
    return parts["sale"].withColumn("kind", F.lit("sale")).unionByName(
        parts["lease"].withColumn("kind", F.lit("lease")))


@query("chart_feed", f"""WITH t AS ({_INDIVIDUAL})
  SELECT 'point' AS chart, kind, pyeong_band AS band,
    strftime(make_date(ym // 100, ym % 100, 15), '%Y-%m-%d') AS x, price_eok AS y, count(*) AS n
  FROM t GROUP BY ALL
  UNION ALL SELECT 'bar', kind, NULL, strftime(make_date(ym // 100, ym % 100, 1), '%Y-%m'),
    CAST(count(*) AS DOUBLE), 1 FROM t GROUP BY kind, ym
  UNION ALL SELECT 'line', kind, NULL, strftime(make_date(ym // 100, ym % 100, 1), '%Y-%m'),
    median_eok, 1 FROM ({_MONTHLY})""", "sales rents")
def _(v):
    points = feeds.scatter_feed(_individual(v)).groupBy(
        "kind", "band", F.date_format("x", "yyyy-MM-dd").alias("x"), "y"
    ).agg(F.count("*").alias("n")).withColumn("chart", F.lit("point"))
    bars = feeds.bar_feed({k: df for k, (df, _) in _both(v).items()}).select(
        "kind", F.col("month").alias("x"), F.col("volume").cast("double").alias("y"),
        F.lit(1).cast("bigint").alias("n"), F.lit("bar").alias("chart"))
    monthly = {k: P.monthly_median_volume(df, amount) for k, (df, amount) in _both(v).items()}
    lines = feeds.line_feed(monthly).select(
        "kind", "x", "y", F.lit(1).cast("bigint").alias("n"), F.lit("line").alias("chart"))
    return points.unionByName(bars, allowMissingColumns=True).unionByName(
        lines, allowMissingColumns=True)


@query("ym_range", """SELECT min(ym) AS min_ym, max(ym) AS max_ym FROM (SELECT ym FROM sales UNION ALL
  SELECT ym FROM rents WHERE rent_kind = '전세')""", "sales rents")
def _(v):
    return P.ym_range(v.sales, v.rents)


@query("year_range", """SELECT '매매' AS kind, min(ym // 100) AS min_year, max(ym // 100) AS max_year FROM sales
  UNION ALL SELECT rent_kind, min(ym // 100), max(ym // 100) FROM rents GROUP BY rent_kind""",
       "sales rents")
def _(v):
    out = P.year_range(v.sales).withColumn("kind", F.lit("매매"))
    for kind in ("전세", "월세"):
        part = P.year_range(v.rents.filter(F.col("rent_kind") == kind))
        out = out.unionByName(part.withColumn("kind", F.lit(kind)))
    return out


@query("yearly_median", f"""SELECT ym // 100 AS year, median(median_eok) AS median_eok_year
  FROM ({_MONTHLY}) WHERE kind = 'sale' GROUP BY 1""", "sales rents")
def _(v):
    trades, amount = _both(v)["sale"]
    return P.yearly_median(P.monthly_median_volume(trades, amount))


@query("yearly_change", f"""WITH y AS (SELECT ym // 100 AS year, median(median_eok) AS median_eok_year
    FROM ({_MONTHLY}) WHERE kind = 'lease' GROUP BY 1)
  SELECT b.year, b.median_eok_year,
    round((b.median_eok_year / a.median_eok_year - 1) * 100, 6) AS change_pct
  FROM y b LEFT JOIN y a ON a.year = b.year - 1""", "sales rents")
def _(v):
    trades, amount = _both(v)["lease"]
    yearly = P.yearly_median(P.monthly_median_volume(trades, amount))
    return P.yearly_change(yearly).withColumn("change_pct", F.round("change_pct", 6))


@query("monthly_trade_count", """SELECT strftime(make_date(ym // 100, ym % 100, 1), '%Y-%m') AS month,
  count(*) AS volume FROM sales GROUP BY 1""", "sales")
def _(v):
    return P.monthly_trade_count(v.sales)


@query("region_hierarchy_complex", """SELECT DISTINCT sido, sigungu, emd, complex FROM
    (SELECT sido, sigungu, emd, complex FROM sales_parts UNION ALL
     SELECT sido, sigungu, emd, complex FROM rents_parts WHERE rent_kind = '전세')
  WHERE sido <> '' AND sigungu <> '' AND emd <> ''""", "sales_parts rents_parts")
def _(v):
    return P.region_hierarchy_complex(v.sales, v.rents)


@query("union_sales_leases", """SELECT address, complex FROM sales UNION
  SELECT address, complex FROM rents WHERE rent_kind = '전세'""", "sales rents")
def _(v):
    return P.union_sales_leases(v.sales, v.rents)


@query("union_ym", """SELECT ym, count(*) AS n FROM (SELECT ym FROM sales UNION ALL
  SELECT ym FROM rents WHERE rent_kind = '전세') GROUP BY 1""", "sales rents")
def _(v):
    return P.union_ym(v.sales, v.rents).groupBy("ym").agg(F.count("*").alias("n"))
