"""Apartment tables that Spark derives from the given tables, for checks and the benchmark.

A part is a complex: its key places it in a nation (district) and region (province). A line item
is a sale of it, an order a rental contract. `checks/views_sql.py` says the same for a second
engine.
"""

from __future__ import annotations

import uuid
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from danji.functions import address as A
from danji.session import shared_folder

AS_OF_YEAR = 2002

# The given tables' columns that are used, so that no file is read to learn a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}

_PLACED = ["n_nationkey", "n_regionkey", "sig_cd", "district", "short_name"]


class Views:
    """Lazy stand-in tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def folder(self, name: str) -> str:
        """A new folder that all executors share, for what a query writes and reads back."""
        return f"{shared_folder(self.spark)}/checks-{uuid.uuid4()}/{name}"

    @cached_property
    def nations(self) -> DataFrame:
        """Districts with their province; 25 rows by the definition of the tables."""
        region = self.table("region").selectExpr(
            "r_regionkey AS n_regionkey",
            """CASE r_name WHEN 'AFRICA' THEN '서울특별시' WHEN 'AMERICA' THEN '경기도'
               WHEN 'ASIA' THEN '세종특별자치시' WHEN 'EUROPE' THEN '부산광역시'
               WHEN 'MIDDLE EAST' THEN '충청남도' END AS province""",
            """CASE r_name WHEN 'AFRICA' THEN '서울' WHEN 'AMERICA' THEN '경기' WHEN 'ASIA' THEN '세종'
               WHEN 'EUROPE' THEN '부산' WHEN 'MIDDLE EAST' THEN '충남' END AS short_name""",
        )
        nation = self.table("nation").selectExpr(
            "n_nationkey", "n_regionkey",
            "element_at(array('중', '동', '서', '남', '북'), CAST(n_nationkey div 5 AS INT) + 1) AS d",
            "concat(n_regionkey + 11, lpad(n_nationkey + 1, 3, '0')) AS sig_cd",
        )
        return nation.join(F.broadcast(region), "n_regionkey").selectExpr(
            "*",
            """CASE province WHEN '경기도' THEN concat(province, ' ', d, '시 ', d, '구')
               WHEN '세종특별자치시' THEN concat(province, '  ', d, '읍')
               WHEN '충청남도' THEN concat(province, ' ', d, '군 ', d, '읍')
               ELSE concat(province, ' ', d, '구') END AS base""",
            """CASE province WHEN '경기도' THEN concat(d, '시 ', d, '구')
               WHEN '세종특별자치시' THEN province
               WHEN '충청남도' THEN concat(d, '군 ', d, '읍') ELSE concat(d, '구') END AS district""",
            "IF(province IN ('세종특별자치시', '충청남도'), '리', '동') AS suffix",
        )

    @cached_property
    def parts(self) -> DataFrame:
        """What a part says of its complex; the facts join this table first, since its size is
        known from its file and Catalyst can choose the join by it."""
        return self.table("part").selectExpr(
            "p_partkey", "p_size", "CAST(p_partkey % 25 AS INT) AS n_nationkey",
            "replace(p_name, ' ', '_') AS complex",
            "replace(p_brand, 'Brand#', '제') AS town_name",
            "concat('큰길 ', p_partkey % 4) AS main_road",
            "CAST(1975 + p_partkey % 30 AS INT) AS first_year",
        )

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows of parts with their district; it has 25 rows, so the broadcast is bounded."""
        return rows.join(F.broadcast(self.nations), "n_nationkey").selectExpr(
            "*", "concat(town_name, suffix) AS town", "concat('샛길 ', n_nationkey) AS side_road"
        )

    @cached_property
    def places(self) -> DataFrame:
        """One complex per part."""
        return self._placed(self.parts)

    @cached_property
    def located_sales(self) -> DataFrame:
        """Sales with the district they lie in."""
        line = self.table("lineitem").withColumnRenamed("l_partkey", "p_partkey")
        return self._placed(line.join(self.parts, "p_partkey")).selectExpr(
            "IF(l_linenumber % 7 = 0, base, concat(base, ' ', town)) AS address",
            "complex",
            "p_size * 4.0D + (l_linenumber % 3) * 0.5D AS area_m2",
            "CAST(floor(l_extendedprice) AS BIGINT) AS price",
            "year(l_shipdate) * 100 + month(l_shipdate) AS ym",
            "day(l_shipdate) AS day",
            "l_linenumber AS floor_no",
            """CASE WHEN l_discount = 0.1D THEN 0 WHEN l_discount = 0.09D THEN NULL
               ELSE first_year END AS built_year""",
            """CASE WHEN l_tax = 0.08D THEN '' WHEN l_tax = 0.0D THEN NULL
               WHEN l_linenumber % 5 = 0 THEN side_road ELSE main_road END AS road""",
            """CASE l_returnflag WHEN 'R' THEN date_format(l_shipdate, 'yyyyMMdd') WHEN 'A' THEN
               CASE l_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN 'None' WHEN 3 THEN '-' END
               END AS cancelled_on""",
            """CASE WHEN l_linestatus = 'O' THEN '중개거래' WHEN l_tax < 0.02D THEN '직거래'
               WHEN l_orderkey % 11 != 0 THEN '중개거래' END AS deal_type""",
            *_PLACED,
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self.located_sales.drop(*_PLACED)

    @cached_property
    def located_rents(self) -> DataFrame:
        order = self.table("orders").withColumnRenamed("o_custkey", "p_partkey")
        return self._placed(order.join(self.parts, "p_partkey")).selectExpr(
            "IF(o_orderkey % 7 = 0, base, concat(base, ' ', town)) AS address",
            "complex",
            """IF(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), '전세', '월세')
               AS rent_kind""",
            "p_size * 4.0D + (o_orderkey % 3) * 0.5D AS area_m2",
            "CAST(floor(o_totalprice / 8.0D) AS BIGINT) AS deposit",
            "year(o_orderdate) * 100 + month(o_orderdate) AS ym",
            "day(o_orderdate) AS day",
            "CAST(o_orderkey % 20 + 1 AS INT) AS floor_no",
            "first_year AS built_year",
            "IF(o_orderstatus = 'P', side_road, main_road) AS road",
            *_PLACED,
        )

    @cached_property
    def rents(self) -> DataFrame:
        return self.located_rents.drop(*_PLACED)

    @cached_property
    def coords(self) -> DataFrame:
        """Full road keys (one road is not geocoded yet) and older rows under the bare road."""
        roads = self.places.selectExpr(
            "base", "province", "n_nationkey",
            """inline(array(named_struct('road', main_road, 'k', p_partkey % 4),
                            named_struct('road', side_road, 'k', 9L)))""",
        ).distinct()
        position = [
            "(12400 + n_nationkey * 10 + k) / 100.0D AS lon",
            "(3500 + n_nationkey * 10 + k) / 100.0D AS lat",
        ]
        lowest = F.min("n_nationkey").alias("n_nationkey")
        full = (
            roads.filter(
                "(k < 9 AND road != '큰길 3') OR (k = 9 AND province IN ('서울특별시', '부산광역시'))"
            )
            .groupBy(A.road_address_key(F.col("base"), F.col("road")).alias("road_key"), "k")
            .agg(lowest).selectExpr("road_key", *position)
        )
        bare = roads.groupBy("road", "k").agg(lowest).selectExpr("road AS road_key", "k", *position)
        return full.unionByName(
            bare.selectExpr("road_key", "IF(k = 9, lon, 999.0D) AS lon", "IF(k = 9, lat, 999.0D) AS lat")
        )

    @cached_property
    def complexes(self) -> DataFrame:
        """The register: a lot, a size and a kind per complex."""
        placed = A.with_region_columns(
            self.places.withColumn("whole", F.expr("concat(base, ' ', town)")), "whole"
        )
        return placed.selectExpr(
            """concat(sido, ' ', sigungu, ' ', emd, ' ', p_partkey % 50 + 1,
               IF(p_partkey % 3 = 0, '', concat('-', p_partkey % 3))) AS lot_address""",
            "IF(p_partkey % 2 = 0, concat(complex, ' 1단지'), complex) AS complex",
            """CAST(CASE WHEN p_partkey % 17 = 0 THEN 0 WHEN p_partkey % 13 = 0 THEN NULL
               ELSE 100 + p_partkey % 2000 END AS INT) AS households""",
            "IF(p_partkey % 9 = 0, '2', '1') AS kind_code",
        )

    def _monthly(self, located: DataFrame, amount: str) -> DataFrame:
        """Means per district and month and per province and month, with region code and name.

        Trades are summed per district once; each sum then counts for its district and its province.
        """
        per_district = located.groupBy("sig_cd", "district", "n_regionkey", "short_name", "ym").agg(
            F.sum(amount).alias("total"), F.count("*").alias("n")
        )
        both = per_district.selectExpr(
            "ym", "total", "n",
            """inline(array(named_struct('region_code', concat(sig_cd, '00000'), 'region_name', district),
                 named_struct('region_code', concat(n_regionkey + 11, '00000000'), 'region_name', short_name)))""",
        )
        return both.groupBy("region_code", "region_name", "ym").agg(
            (F.sum("total") / F.sum("n")).alias("mean")
        ).selectExpr(
            "region_code", "region_name", "make_date(CAST(ym div 100 AS INT), ym % 100, 1) AS date", "mean"
        )

    def _index(self, located: DataFrame, amount: str) -> DataFrame:
        return self._monthly(located, amount).selectExpr(
            "region_code", "region_name", "date", "mean",
            """inline(array(named_struct('freq', '월간', 'asset_kind', '아파트', 'shift', 0.0D),
                            named_struct('freq', '주간', 'asset_kind', '아파트', 'shift', 1.0D),
                            named_struct('freq', '월간', 'asset_kind', '연립', 'shift', 2.0D)))""",
        ).selectExpr(
            "freq", "asset_kind", "region_code", "region_name", "date", "mean + shift AS index_value"
        )

    @cached_property
    def sale_index(self) -> DataFrame:
        return self._index(self.located_sales, "price")

    @cached_property
    def lease_index(self) -> DataFrame:
        return self._index(self.located_rents, "deposit")

    @cached_property
    def lease_ratio(self) -> DataFrame:
        """Mean deposit over mean price, in percent."""
        price = self._monthly(self.located_sales, "price")
        deposit = self._monthly(self.located_rents, "deposit").selectExpr(
            "region_code", "date", "mean AS deposit"
        )
        return price.join(deposit, ["region_code", "date"]).selectExpr(
            "date", "explode(array('아파트', '연립')) AS asset_kind", "region_code", "region_name",
            "deposit / mean * 100.0D AS ratio",
        )

    @cached_property
    def targets(self) -> DataFrame:
        """Every complex name and size of the register: the longest possible watch-list."""
        return self.places.groupBy("complex", F.expr("p_size * 4.0D AS area_m2")).agg(
            F.expr("min(concat(base, ' ', town)) AS address")
        ).select("address", "complex", "area_m2")

    @cached_property
    def features(self) -> DataFrame:
        """One GeoJSON feature per district, every third a MultiPolygon."""
        shaped = self.nations.selectExpr(
            "*", "n_nationkey % 3 = 0 AS multi",
            """format_string('[[%d,%d],[%d,%d],[%d,%d],[%d,%d]]', n_nationkey + 100, n_nationkey + 30,
               n_nationkey + 102, n_nationkey + 30, n_nationkey + 102, n_nationkey + 33,
               n_nationkey + 100, n_nationkey + 34) AS ring""",
            "IF(district = province, province, concat(province, ' ', district)) AS full_nm",
        )
        return shaped.selectExpr(
            """concat('{"type":"Feature","properties":{"sig_cd":"', sig_cd, '","sig_kor_nm":"', district,
               '","full_nm":"', full_nm, '"},"geometry":{"type":"', IF(multi, 'MultiPolygon', 'Polygon'),
               '","coordinates":', IF(multi, concat('[[', ring, '],[[[0,0],[1,1],[1,2]]]]'),
               concat('[', ring, ']')), '}}') AS value"""
        )

    @cached_property
    def regions_geo(self) -> DataFrame:
        from danji.sources.boundaries import parse_features

        return parse_features(self.features)


@lru_cache(maxsize=8)
def _views(application: str, spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, sf_dir)


def views(spark: SparkSession, sf_dir: str) -> Views:
    """The views of a folder; their plans (not their data) are kept for the session."""
    return _views(spark.sparkContext.applicationId, spark, sf_dir)
