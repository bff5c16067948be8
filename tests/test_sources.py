import json

import pytest
from conftest import RENTS, SALES, TARGETS, dicts
from pyspark.sql import functions as F, types as T

from danji.operators import regions as G
from danji.plans import feeds, tracking
from danji.schemas import source_schema
from danji.sources import boundaries, reports, tables, targets


def test_scan_renames(spark, tmp_path):
    path = str(tmp_path / "coords")
    spark.createDataFrame([("길 1", 127.0, 37.0)], source_schema("coords")).write.parquet(path)
    df = tables.scan_table(spark, path, "coords")
    assert dicts(df) == [{"road_key": "길 1", "lon": 127.0, "lat": 37.0}]


def test_foreign_layout(spark):
    foreign = spark.createDataFrame(
        [("서울특별시", "강남구", None, "가", 84.0, "100,500", 202501, 3, 2010, "길", None, "중개거래")],
        "`시도` string, `시군구` string, `읍면동` string, `단지명` string, `전용면적(㎡)` double, "
        "`거래금액(만원)` string, `계약년월` int, `층` int, `건축년도` int, `도로명` string, "
        "`해제사유발생일` string, `거래유형` string")
    (row,) = dicts(tables.normalize_foreign_sales(foreign))
    assert (row["address"], row["price"], row["ym"]) == ("서울특별시 강남구 ", 100500, 202501)
    standard = spark.createDataFrame([], source_schema("sales"))
    assert not tables.is_foreign(standard)
    assert tables.normalize_foreign_sales(standard).columns == [
        f.split()[0] for f in SALES.split(", ")]
    assert tables.normalize_foreign_rents(spark.createDataFrame([], source_schema("rents"))).columns == [
        f.split()[0] for f in RENTS.split(", ")]


def test_target_list_file(spark, tmp_path):
    assert targets.load_targets(spark, str(tmp_path / "none.json")).count() == 0
    path = tmp_path / "list.json"
    path.write_text(json.dumps(
        [{"시군구": "서울특별시 강동구 고덕동", "단지명": "가", "전용면적": 84.5}], ensure_ascii=False))
    loaded = targets.load_targets(spark, str(path))
    assert dicts(loaded) == [{"address": "서울특별시 강동구 고덕동", "complex": "가", "area_m2": 84.5}]
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    out = str(tmp_path / "list")
    targets.write_targets(loaded, out)
    more = spark.createDataFrame([("서울특별시 강동구", "나", 59.0)], TARGETS)
    targets.write_targets(targets.load_targets(spark, out).unionByName(more), out)
    assert {r["complex"] for r in dicts(targets.load_targets(spark, out))} == {"가", "나"}


def test_target_list_keeps_every_row(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    rows = [(f"district {i}", f"complex {i}", 50.0 + i) for i in range(10)]
    ten = spark.createDataFrame(rows, TARGETS)
    for parts in (1, 4):  # ten rows in one file, then in several
        out = str(tmp_path / f"list{parts}")
        targets.write_targets(ten.repartition(parts), out)
        assert sorted(map(tuple, targets.load_targets(spark, out).collect())) == sorted(rows)
    targets.write_targets(ten.limit(0), out)
    assert targets.load_targets(spark, out).count() == 0
    document = tmp_path / "list.json"
    document.write_text(json.dumps([{"시군구": a, "단지명": c, "전용면적": x} for a, c, x in rows], ensure_ascii=False, indent=2))
    ordered = targets.load_targets(spark, str(document), position=True).orderBy("position")
    assert [tuple(r)[:3] for r in ordered.collect()] == rows
    broken = tmp_path / "broken.json"
    broken.write_text('{"시군구": "a", ')
    with pytest.raises(Exception):
        targets.load_targets(spark, str(broken)).collect()


def test_reports_follow_the_list(spark, tmp_path):
    columns = ", ".join(
        f"{c} {'string' if c in ('sido', 'sigungu', 'emd', 'complex', 'note') else 'bigint'}"
        for c in tracking.COLUMNS)
    rows = [tuple([f"{k}"] * 4 + [1] * 19 + [None, f"list#{9 - k}"]) for k in range(10)]
    report = spark.createDataFrame(rows, columns + ", position string").repartition(3)
    reports.export_tracking(report, str(tmp_path / "t"), "now")
    files = sorted((tmp_path / "t").glob("part-*.csv"))
    names = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert names == [str(k) for k in range(9, -1, -1)]


def geojson(tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2]]

    def feature(code, name, full, kind, coordinates):
        return {"type": "Feature", "properties": {"sig_cd": code, "sig_kor_nm": name, "full_nm": full},
                "geometry": {"type": kind, "coordinates": coordinates}}

    path = tmp_path / "regions.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        feature("11110", "종로구", "서울특별시 종로구", "Polygon", [square]),
        feature("26140", "서구", "부산광역시 서구", "MultiPolygon", [[square], [[[10, 10], [12, 12]]]]),
    ]}, ensure_ascii=False))
    return str(path)


def test_boundaries(spark, tmp_path):
    regions = boundaries.load_regions_geo(spark, geojson(tmp_path))
    got = {r["sig_cd"]: (r["centroid_lon"], r["centroid_lat"]) for r in dicts(G.region_centroids(regions))}
    assert got == {"11110": (1.0, 1.0), "26140": (26 / 6, 26 / 6)}
    values = spark.createDataFrame([("11110", 3.25), ("서구", -1.0)], "key string, value double")
    feed = feeds.choropleth_feed(regions, values)
    assert {r["sig_cd"]: r["value"] for r in dicts(feed["layer"])} == {"11110": 3.25, "26140": -1.0}
    assert tuple(feed["bounds"].first()) == (0.0, -3.25, 3.25)
    only = feeds.choropleth_feed(regions, values.limit(0), ["부산광역시"])["layer"]
    assert [(r["sig_cd"], r["value"], r["label"]) for r in dicts(only)] == [("26140", None, None)]


@pytest.mark.parametrize("value, kind, separators, text", [
    (None, T.DoubleType(), True, "-"), (84.0, T.DoubleType(), True, "84"), (53.6, T.DoubleType(), True, "53.6"),
    (-4.4, T.DoubleType(), True, "-4.4"), (12345.0, T.DoubleType(), True, "12,345"),
    (12345678.95, T.DoubleType(), True, str(round(12345678.95, 1))), (2010, T.IntegerType(), False, "2010"),
    (112000, T.LongType(), True, "112,000"), ("직거래", T.StringType(), True, "직거래"),
])
def test_report_values(spark, value, kind, separators, text):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)]))
    assert df.select(reports.format_value(F.col("v"), kind, separators)).first()[0] == text


def test_report_files(spark, tmp_path):
    columns = ", ".join(
        f"{c} {'string' if c in ('sido', 'sigungu', 'emd', 'complex', 'note') else 'bigint'}"
        for c in tracking.COLUMNS)
    report = spark.createDataFrame([tuple(["가"] * 4 + [1000] * 19 + [None])], columns)
    for _ in range(2):  # the second run replaces the first
        reports.export_tracking(report, str(tmp_path / "t"), "2025-01-01 09:00")
    back = spark.read.csv(str(tmp_path / "t"), header=True)
    assert back.columns == [*reports.TRACKING_HEADERS.values(), reports.STAMP]
    assert [r["비고"] for r in back.collect()] == ["-"] and back.first()["당월매매"] == "1,000"
    headers = reports.roi_headers(202201, [2])
    assert list(headers.values())[8:] == [
        "2022.1 매매가", "2022.1 전세가", "2022.1 갭", "2024.1 매매가", "2024.1 전세가", "2024.1 갭",
        "2년 매매차익", "2년 수익률(%)"]
    frame = report.select(*[F.lit(1).alias(c) for c in headers])
    reports.export_roi(frame, str(tmp_path / "r"), 202201, [2], "2025-01-01")
    assert spark.read.csv(str(tmp_path / "r"), header=True).columns[:-1] == list(headers.values())


def test_a_listed_null_stays_null(spark, tmp_path):
    regions = boundaries.load_regions_geo(spark, geojson(tmp_path))
    values = spark.createDataFrame([("11110", None), ("종로구", 5.0), ("서구", 2.0)], "key string, value double")
    got = {r["sig_cd"]: r["value"] for r in dicts(G.regions_with_indicator(regions, values))}
    assert got == {"11110": None, "26140": 2.0}


def test_pivots_refuse_what_is_not_listed(spark):
    from danji.operators.index import heatmap_pivot
    from danji.operators.ranking import year_pivot

    names = ["sido", "sigungu", "emd", "complex", "age_band", "area_band"]
    rows = spark.createDataFrame([(2020,), (2021,)], "contract_year int").selectExpr(
        "contract_year", *[f"'x' AS {c}" for c in names], "1 AS built_year", "2 AS households", "1.0D AS lon",
        "2.0D AS lat", "3 AS n")
    assert year_pivot(rows, "n").columns[-2:] == ["2020", "2021"]
    assert year_pivot(rows, "n", [2020, 2021, 2022]).first()["2021"] == 3
    with pytest.raises(Exception, match="not in the list"):
        year_pivot(rows, "n", [2020]).collect()
    series = spark.sql("SELECT 'a' AS region_name, '1' AS sig_cd, date'2020-03-01' AS date, 1.5D AS value")
    assert heatmap_pivot(series).columns == ["region_name", "2020-03"]
    with pytest.raises(Exception, match="not in the list"):
        heatmap_pivot(series, ["2020-04"]).collect()


def test_shipped_filters_skip_folders(spark, tmp_path):
    from danji.functions import filters
    from danji.plans.ranking import complex_pivot

    places = ("서울특별시 강남구 역삼동", "부산광역시 서구 동")
    rows = [(a, "가", 84.0, 1, ym, 1, 1, 2010, "길", None, None) for a in places for ym in (202401, 202502)]
    tables.write_trades(spark.createDataFrame(rows, SALES), str(tmp_path / "s"))
    rents = [(a, "가", "전세", 84.0, 1, ym, 1, 1, 2010, "길") for a in places for ym in (202401, 202502)]
    tables.write_trades(spark.createDataFrame(rents, RENTS), str(tmp_path / "r"))
    chosen = filters.trade_filter_price("부산광역시", "서구", ym_from=202403, ym_to=202512, stored=True)
    for name in ("s", "r"):
        kept = tables.scan_trades(spark, str(tmp_path / name)).filter(chosen)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        folders = plan[plan.index("PartitionFilters: ["):].split("]")[0]
        assert "sido" in folders and "contract_year" in folders and kept.count() == 1
    coords = spark.createDataFrame([], "road_key string, lon double, lat double")
    register = spark.createDataFrame([], "lot_address string, complex string, households int, kind_code string")
    stored = tables.scan_trades(spark, str(tmp_path / "s"))
    pivot = complex_pivot(stored, coords, register, 2025, sido="부산광역시", year_from=2025)
    plan = pivot._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(") == plan.count("FileScan parquet")


def test_stored_trades_are_pruned(spark, tmp_path):
    rows = [(a, "가", 84.0, 1, ym, 1, 1, 2010, "길", None, None)
            for a in ("서울특별시 강남구 역삼동", "부산광역시 서구 동") for ym in (202401, 202502)]
    tables.write_trades(spark.createDataFrame(rows, SALES), str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    one = stored.filter("sido = '서울특별시' AND contract_year = 2025")
    assert len(one.inputFiles()) >= 1 and one.count() == 1
    assert "PartitionFilters: [isnotnull(sido" in one._jdf.queryExecution().toString()
