"""Scans, foreign layouts and report tables."""

import uuid

from pyspark.sql import functions as F, types as T, Window as W

from checks import q_filters, q_ranking  # noqa: F401 - their SQL is used here
from checks.q_targets import PERIODS, PURCHASE_YM, roi_report, tracking_report
from checks.registry import ORACLE, query
from checks.views import AS_OF_YEAR
from danji.functions import address as A, filters
from danji.operators import ranking as R, targets as G
from danji.operators.enrich import join_coords
from danji.plans.ranking import complex_pivot
from danji.schemas import source_to_engine
from danji.sources import boundaries, names as complex_names, reports, rollups, tables, targets


@query("scan_tables", """SELECT o_orderkey AS contract_id, o_custkey AS complex_id,
  o_totalprice AS amount FROM orders""")
def _(v):
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    names = {"o_orderkey": "contract_id", "o_custkey": "complex_id", "o_totalprice": "amount"}
    return tables.scan(v.spark, f"{v.sf_dir}/orders.parquet", schema, names)


def _foreign(df, amount, header):
    """The trades in the foreign layout: address in three columns, amounts as comma text."""
    emd = F.when(F.col("emd") != "", F.col("emd"))
    return A.with_region_columns(df).select(
        F.col("sido").alias("시도"), F.col("sigungu").alias("시군구"), emd.alias("읍면동"),
        F.col("complex").alias("단지명"), F.col("area_m2").alias(tables.FOREIGN_AREA),
        F.format_number(amount, 0).alias(header), F.col("ym").alias("계약년월"),
        F.col("floor_no").alias("층"), F.col("built_year").alias("건축년도"), F.col("road").alias("도로명"),
        *[F.col(c).alias(k) for c, k in (("rent_kind", "전월세구분"), ("cancelled_on", "해제사유발생일"),
                                         ("deal_type", "거래유형")) if c in df.columns],
    )


_COMMON = "sido || ' ' || sigungu || ' ' || emd AS address, complex, area_m2, ym, floor_no, built_year, road"


@query("normalize_foreign_sales", f"SELECT {_COMMON}, price, cancelled_on, deal_type FROM sales_parts",
       "sales_parts")
def _(v):
    return tables.normalize_foreign_sales(_foreign(v.sales, "price", tables.FOREIGN_PRICE))


@query("normalize_foreign_rents", f"SELECT {_COMMON}, deposit, rent_kind FROM rents_parts", "rents_parts")
def _(v):
    return tables.normalize_foreign_rents(_foreign(v.rents, "deposit", tables.FOREIGN_DEPOSIT))


def _text_sql(report: str, headers: dict[str, str], doubles: set[str], texts: set[str]) -> str:
    """The report behind `report` with every value as text."""
    parts = []
    for name, header in headers.items():
        plain = name in reports.PLAIN_NUMBERS
        whole = f"CAST({name} AS VARCHAR)" if plain else f"format('{{:,}}', CAST({name} AS BIGINT))"
        if name in texts:
            text = name
        elif name in doubles:
            text = f"CASE WHEN {name} = floor({name}) THEN {whole} ELSE printf('%.1f', {name}) END"
        else:
            text = whole
        parts.append(f"CASE WHEN {name} IS NULL THEN '-' ELSE {text} END AS \"{header}\"")
    head, _, last = report.rpartition("\n  SELECT ")
    return f"{head},\n  report AS (SELECT {last})\n  SELECT {', '.join(parts)} FROM report"


_TEXTS = {"sido", "sigungu", "emd", "complex", "note"}
_DOUBLES = {"area_m2", "lease_ratio", "lease_ratio_change", "vs_peak", "prev_lease_ratio",
            "y2_return", "y4_return"}
_ROI_HEADERS = reports.roi_headers(PURCHASE_YM, PERIODS)


@query("export_tracking",
       _text_sql(ORACLE["tracking_report"], reports.TRACKING_HEADERS, _DOUBLES, _TEXTS))
def _(v):
    """The files as read back."""
    path = v.folder("tracking")
    reports.export_tracking(tracking_report(v), path, "2002-01-01")
    return v.spark.read.csv(path, header=True).drop(reports.STAMP)


@query("export_roi", _text_sql(ORACLE["roi_report"], _ROI_HEADERS, _DOUBLES, _TEXTS))
def _(v):
    path = v.folder("roi")
    reports.export_roi(roi_report(v), path, PURCHASE_YM, PERIODS, "2002-01-01")
    return v.spark.read.csv(path, header=True).drop(reports.STAMP)


@query("format_report_values", """SELECT DISTINCT price, CASE WHEN price IS NULL THEN '-'
    ELSE format('{:,}', price) END AS whole, CAST(price AS VARCHAR) AS plain,
    CASE WHEN price % 8 = 0 THEN format('{:,}', price // 8) ELSE printf('%.1f', price / 8.0::DOUBLE) END
      AS eighth FROM sales""", "sales")
def _(v):
    price = F.col("price")
    return v.sales.select("price").distinct().select(
        "price", reports.format_value(price, T.LongType()).alias("whole"),
        reports.format_value(price, T.LongType(), separators=False).alias("plain"),
        reports.format_value(price / 8.0, T.DoubleType()).alias("eighth"))


@query("write_targets", "SELECT address, complex, area_m2 FROM targets", "targets")
def _(v):
    """Written, read, written over itself and read again."""
    path = v.folder("targets")
    targets.write_targets(v.targets, path)
    targets.write_targets(targets.load_targets(v.spark, path), path)
    return targets.load_targets(v.spark, path)


# Entries of one array document in the check of load_targets: a document is read as a whole.
DOCUMENT = 10_000


@query("load_targets", """SELECT address, complex, area_m2,
  row_number() OVER (ORDER BY address, complex, area_m2) - 1 AS place FROM targets""", "targets")
def _(v):
    """The whole list in its order, as a folder of array documents; a place counts through all of them."""
    names = source_to_engine("targets")
    order = [F.col(c).asc_nulls_last() for c in ("address", "complex", "area_m2")]
    sorted_list = v.targets.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = sorted_list.select(
        F.monotonically_increasing_id().alias("at"), F.struct(*[F.col(eng).alias(src) for src, eng in names.items()]).alias("entry"))
    # The range a row lies in and, in it, its document.
    document = F.format_string(
        "%010d-%010d", F.shiftright("at", 33), F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / DOCUMENT))
    listed = F.sort_array(F.collect_list(F.struct("at", "entry"))).getField("entry")
    path = v.folder("targets-documents")
    numbered.groupBy(document.alias("document")).agg(F.to_json(listed).alias("value")).write.partitionBy("document").text(path)
    loaded = targets.load_targets(v.spark, path, position=True).withColumns({
        "file": F.regexp_extract("position", "^(.*)#", 1), "at": F.regexp_extract("position", r"#(\d+)$", 1).cast("bigint")})
    # One row per document.
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = loaded.groupBy("file").agg(F.count("*").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return loaded.join(F.broadcast(starts), "file").select(
        "address", "complex", "area_m2", (F.col("start") + F.col("at")).alias("place"))


@query("load_targets_lines", "SELECT address, complex, area_m2 FROM targets", "targets")
def _(v):
    """Files of one object a line, read in splits."""
    names = source_to_engine("targets")
    path = v.folder("targets-lines")
    v.targets.select(F.to_json(F.struct(*[F.col(eng).alias(src) for src, eng in names.items()])).alias("value")).write.text(path)
    return targets.load_targets(v.spark, path)


@query("scan_table", "SELECT * FROM sales", "sales")
def _(v):
    """The sales stored under their source names and read back."""
    path = v.folder("sales")
    names = source_to_engine("sales")
    v.sales.select(*[F.col(eng).alias(src) for src, eng in names.items()]).write.parquet(path)
    return tables.scan_table(v.spark, path, "sales").select(*names.values())


def _stored(v):
    path = v.folder("stored")
    tables.write_trades(v.sales, path)
    return tables.scan_trades(v.spark, path)


@query("scan_trades", """SELECT address, complex, area_m2, price, ym, emd FROM sales_parts
  WHERE sido = '경기도' AND sigungu IN ('동시 동구') AND ym BETWEEN 199607 AND 199802""", "sales_parts")
def _(v):
    chosen = filters.trade_filter_price("경기도", "동시 동구", ym_from=199607, ym_to=199802, stored=True)
    return _stored(v).filter(chosen).select("address", "complex", "area_m2", "price", "ym", "emd")


@query("complex_pivot_stored", ORACLE["complex_pivot_region"])
def _(v):
    return complex_pivot(
        _stored(v), v.coords, v.complexes, AS_OF_YEAR, sido="서울특별시", sigungu=["중구", "동구"],
        year_from=1997, year_to=1999, households=(200, 1500))


def _bucketed(v, key):
    table = f"trades_{uuid.uuid4().hex}"
    tables.write_bucketed(v.sales, table, v.folder(table), key)
    return tables.scan_bucketed(v.spark, table)


@query("join_coords_bucketed", """SELECT address, complex, s.road, price, ym, lon, lat FROM sales_parts s
  LEFT JOIN coords ON key_prefix || ' ' || s.road = road_key""", "sales_parts coords")
def _(v):
    return join_coords(_bucketed(v, "road_key"), v.coords).select(
        "address", "complex", "road", "price", "ym", "lon", "lat")


@query("latest_sale_bucketed", ORACLE["latest_sale"])
def _(v):
    """Trades stored in buckets of complexes meet the watch-list where they lie."""
    summary = G.sale_summary(v.targets, _bucketed(v, "complex"))
    return summary.filter("latest_sale IS NOT NULL").select(*G.TARGET, "latest_sale", "latest_is_direct")


def _rolled(v):
    """Partial counts of the sales: all but the last year, then the rest, then a late correction.

    At first one month holds its trades twice and another one holds trades that were withdrawn
    afterwards; the counts are refreshed for the touched months only.
    """
    path, sales = v.folder("counts"), v.sales
    twice = sales.filter("ym = 199503")
    early = sales.filter("ym < 199800").unionByName(twice).unionByName(
        sales.filter("ym = 199604").withColumn("ym", F.lit(190001)))
    rollups.refresh_counts(early, path, "first load")
    batch = sales.filter("ym >= 199800")
    rollups.refresh_counts(early.unionByName(batch), path, "append", rollups.touched_months(batch))
    wrong = sales.sparkSession.createDataFrame([(199503,), (190001,)], "ym int")
    rollups.refresh_counts(sales, path, "correction", rollups.touched_months(wrong))
    return rollups.trade_counts(sales.limit(0), path, "correction")


@query("trade_counts_stored", """SELECT ym, address, complex, road, count(*) AS n FROM sales
  GROUP BY ym, address, complex, road""", "sales")
def _(v):
    return _rolled(v)


@query("best_emd_stored", ORACLE["best_emd"])
def _(v):
    return R.best_emd_of(_rolled(v))


@query("best_coords_stored", ORACLE["best_coords"])
def _(v):
    return R.best_coords_of(_rolled(v), v.coords)


@query("region_hierarchy_stored", """SELECT DISTINCT sido, sigungu, emd FROM sales_parts
  WHERE sido <> '' AND sigungu <> '' AND emd <> ''""", "sales_parts")
def _(v):
    return R.region_hierarchy_of(_rolled(v))


@query("households_lookup_stored", ORACLE["households_lookup"])
def _(v):
    """Stored for one state of the register, stored anew for the next, and read."""
    path = v.folder("households")
    half = v.complexes.filter("households < 500")
    rollups.stored_lookup(v.spark, path, "half", lambda: R.households_lookup(half))
    rollups.stored_lookup(v.spark, path, "whole", lambda: R.households_lookup(v.complexes))
    return rollups.stored_lookup(v.spark, path, "whole", lambda: R.households_lookup(half))


@query("search_names", ORACLE["search_complex"])
def _(v):
    path = v.folder("names")
    complex_names.write_names(v.sales, path)
    return complex_names.search_names(v.spark, path, "ring")


@query("load_regions_geo", "SELECT sig_cd, sig_kor_nm, full_nm, geometry_type FROM regions_geo",
       "regions_geo")
def _(v):
    """A FeatureCollection document, written and read; it holds the districts of one country."""
    path = v.folder("regions")
    document = F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}"))
    v.features.agg(document.alias("value")).write.text(path)
    return boundaries.load_regions_geo(v.spark, path).drop("coordinates")
