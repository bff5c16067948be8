"""What the plans of the heavy questions read and shuffle, and what they do with hot keys."""

import json
import random
import re
import statistics

import pytest
from conftest import COMPLEXES, COORDS, SALES, TARGETS, dicts
from pyspark.sql import functions as F

from danji.operators import index as X, ranking as R, targets as G
from danji.operators.enrich import join_coords
from danji.operators.profile import describe_metric
from danji.operators.skew import exact_median, exact_quantiles
from danji.plans.ranking import complex_pivot
from danji.sources import names, rollups, tables, targets

CITY = "부산광역시"


def sale(complex_, ym=202401, price=1000, area=84.0, address=f"{CITY} 서구 가동", road="길 1", day=1):
    return (address, complex_, area, price, ym, day, 3, 2010, road, None, "중개거래")


def executed(df) -> str:
    """The plan as it was run, with what is read twice named once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def stored(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.schema(schema).parquet(str(path))


def test_pivot_reads_the_trades_once(spark, tmp_path):
    sales = stored(spark, [sale(f"c{i % 7}", 202300 + i % 12 + 1, road=f"길 {i % 3}") for i in range(200)], SALES, tmp_path / "sales")
    coords = stored(spark, [(f"{CITY} 서구 길 {i}", 129.0 + i, 35.0) for i in range(2)], COORDS, tmp_path / "coords")
    register = stored(spark, [(f"{CITY} 서구 가동 1", f"c{i}", 100, "1") for i in range(7)], COMPLEXES, tmp_path / "register")
    for dedupe in (False, True):
        pivot = complex_pivot(sales, coords, register, 2024, dedupe_coords=dedupe)
        # Spark writes "road_key", which only coords have, in their scan.
        scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)", executed(pivot)) if "deal_type" in s or "address#" in s and "lot_" not in s]
        assert len(scans) == 1
        assert pivot.agg(F.sum("n")).first()[0] == 200 * (1 if dedupe else 2)


def test_pivot_fills_and_locates_by_the_complex_not_by_chance(spark):
    rows = [sale("a", address=f"{CITY} 서구 가동")] * 3 + [sale("a", address=f"{CITY} 서구 나동")] * 3 + [sale("a", address=f"{CITY} 서구")]
    rows += [sale(None, address=f"{CITY} 서구"), sale(None, address=f"{CITY} 서구 다동"), sale("b", address=f"{CITY} 서구", road="길 9")]
    coords = spark.createDataFrame([(f"{CITY} 서구 길 1", 129.0, 35.0)], COORDS)
    register = spark.createDataFrame([], COMPLEXES)
    got = {(r["complex"], r["emd"]): r["n"] for r in dicts(
        complex_pivot(spark.createDataFrame(rows, SALES), coords, register, 2024).groupBy("complex", "emd").agg(F.sum("n").alias("n")))}
    # The modal sub-district by name; a trade without a complex name borrows from no other.
    assert got == {("a", "가동"): 4, ("a", "나동"): 3, (None, None): 1, (None, "다동"): 1}


def test_quantiles_equal_the_library_with_a_hot_month(spark):
    r = random.Random(4)
    rows = [(202401, r.choice([r.randrange(50_000, 90_000), -r.randrange(100), 0])) for _ in range(3000)]
    rows += [(None, r.randrange(10**12)) for _ in range(50)] + [(202402, 7)] + [(202403, None)] * 2 + [(202404, r.randrange(5)) for _ in range(6000)]
    rows += [(202405, None), (202405, 10**15 + 1), (202405, 10**15 + 4)]
    got = {row["ym"]: row for row in dicts(exact_quantiles(spark.createDataFrame(rows, "ym int, v bigint"), ["ym"], "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}))}
    for ym in (None, 202401, 202402, 202404, 202405):
        values = sorted(v for m, v in rows if m == ym and v is not None)

        def at(q):
            place = q * (len(values) - 1)
            low = int(place)
            return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)

        assert got[ym]["n"] == len(values) and got[ym]["_rows"] == sum(m == ym for m, _ in rows)
        assert [got[ym][c] for c in ("q1", "m", "q9")] == pytest.approx([at(0.25), at(0.5), at(0.9)], rel=1e-12)
        assert got[ym]["m"] == statistics.median(values)
    assert got[202403]["m"] is None and got[202403]["_rows"] == 2


def test_quantiles_of_close_doubles_and_of_nothing(spark):
    values = [100 + i * 1e-9 for i in range(999)]
    one = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), [], "v", {"m": 0.5}).first()
    assert (one["m"], one["n"]) == (values[499], 999)
    empty = spark.createDataFrame([], "k int, v double")
    assert exact_median(empty, ["k"], "v", "m", rows="rows").count() == 0
    assert describe_metric(empty, "v").first().asDict() == dict.fromkeys(("mean", "std", "min", "q1", "median", "q3", "max")) | {"n": 0}


def test_no_window_orders_all_values_of_a_month(spark, tmp_path):
    sales = stored(spark, [sale("c", price=i) for i in range(50)], SALES, tmp_path / "sales")
    plan = exact_median(sales, ["ym"], "price", "m")._jdf.queryExecution().sparkPlan().toString()
    orders = re.findall(r"windowspecdefinition\(([^()]*)", plan)
    assert orders and all("_bucket" in o or "_which" in o or "ASC" not in o for o in orders)


def test_year_over_year_reads_the_index_once(spark, tmp_path):
    rows = [("월간", "아파트", f"1110{i}00000", f"r{i}", f"{y}-0{m}-01", float(v))
            for i in range(3) for y in (2022, 2023, 2024) for m, v in ((1, 100 + y), (2, 0 if y == 2022 else 5)) if not (i == 2 and y == 2023)]
    schema = "freq string, asset_kind string, region_code string, region_name string, date string, index_value double"
    index = spark.createDataFrame(rows, schema).withColumn("date", F.to_date("date"))
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    change = X.yoy_self_join(index, "시군구")
    # Nothing before 2022, zero in February 2022, and a region without 2023.
    assert {(r["region_name"], str(r["date"])) for r in dicts(change)} == {
        (f"r{i}", d) for i in (0, 1) for d in ("2023-01-01", "2024-01-01", "2024-02-01")}
    for df in (change, X.yoy_point_join(index, 2024, 1)):
        plan = executed(df)
        assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_requested_months_see_their_neighbours_only(spark):
    trades = [("가", 84.0, ym, day, price) for ym, day, price in ((202301, 5, 10), (202303, 9, 30), (202307, 1, 70), (202309, 1, 90), (202309, 2, 95))]
    monthly = spark.createDataFrame(trades, "complex string, area_m2 double, ym int, day int, price bigint").groupBy("complex", "area_m2", "ym").agg(
        F.max(G.pack(F.col("day"), F.col("price"))).alias("last"))
    wanted = [202302, 202303, 202305, 202308, 202409, 202410, 202201, 202112]
    got = {r["target_ym"]: (r["amount"], r["distance"]) for r in dicts(G.nearest_month_price(
        spark.createDataFrame([("가", 84.0, m) for m in wanted * 2] + [("나", 84.0, 202301)], "complex string, area_m2 double, target_ym int"), monthly))}
    # Equally near: the later day of month, then the higher amount.
    assert got == {202302: (30, 1), 202303: (30, 0), 202305: (30, 2), 202308: (95, 1), 202409: (95, 12), 202201: (10, 12)}


def test_many_areas_of_one_name_are_walked_in_chains(spark):
    areas = [20 + 0.4 * i for i in range(10_000)]
    sales = spark.createDataFrame([sale("가", area=a) for a in areas] + [sale("나", area=a) for a in (30.0, 40.0, 50.0)], SALES)
    candidates = sales.select("complex", "area_m2").distinct()
    got = G.validate_targets(candidates, sales, spark.createDataFrame([], TARGETS))
    held = []
    first = sorted({min(b for b in areas[max(0, i - 3) : i + 4] if abs(b - a) < 1) for i, a in enumerate(areas)})
    for a in first:
        if not held or a - held[-1] >= 1:
            held.append(a)
    assert {r["actual_area"] for r in dicts(got.filter("complex = '가' AND status = 'accepted'"))} == set(held)
    assert got.filter("complex = '나' AND status = 'accepted'").count() == 3


def test_bucketed_trades_are_not_dealt_again(spark, tmp_path):
    rows = [sale(f"c{i % 20}", 202401 + i % 3, i, road=f"길 {i % 4}") for i in range(400)]
    sales = spark.createDataFrame(rows, SALES)
    coords = stored(spark, [(f"{CITY} 서구 길 {i}", 129.0, 35.0) for i in range(4)], COORDS, tmp_path / "coords")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        for key in ("road_key", "complex"):
            tables.write_bucketed(sales, f"trades_by_{key}", str(tmp_path / key), key)
        by_road = join_coords(tables.scan_bucketed(spark, "trades_by_road_key"), coords)
        plan = executed(by_road)
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1 and by_road.filter("lon = 129").count() == 400
        wanted = stored(spark, [(f"{CITY} 서구 가동", f"c{i}", 84.0) for i in range(20)], TARGETS, tmp_path / "targets")
        summary = G.sale_summary(wanted, tables.scan_bucketed(spark, "trades_by_complex"))
        plan = executed(summary)
        # From the trades' scan up to the watch-list's semi join there is no exchange.
        lines = plan.split("\n")
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        depth = lines[scan].index("FileScan")
        above = [line for line in lines[:scan] if "LeftSemi" in line][-1]
        between = lines[lines.index(above) + 1 : scan]
        assert not any("Exchange" in line and len(line) - len(line.lstrip(" :+-")) < depth for line in between)
        assert summary.filter("latest_sale IS NOT NULL").count() == 20
        with pytest.raises(ValueError):
            tables.write_bucketed(sales, "trades_by_price", str(tmp_path / "p"), "price")
    finally:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(c)
        for key in ("road_key", "complex"):
            spark.sql(f"DROP TABLE IF EXISTS trades_by_{key}")


def test_large_road_keys_are_dealt_to_several_buckets(spark, tmp_path, monkeypatch):
    """Trades without a road and of one road fill no bucket, and still meet their coordinates where they lie."""
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    monkeypatch.setattr(tables, "PART_ROWS", 20)
    roads = [None] * 900 + ["길 0"] * 600 + [f"길 {1 + i % 30}" for i in range(300)] + [""] * 200
    rows = [sale(f"c{i % 20}", 202401 + i % 12, i, road=road) for i, road in enumerate(roads)] + [sale("c1", 202401, 7, road="길 0")] * 2
    sales = spark.createDataFrame(rows, SALES)
    # One key twice, one without trades, a null one.
    places = [(f"{CITY} 서구 길 {i}", 129.0 + i, 35.0) for i in (*range(25), 3, 99)] + [(None, 1.0, 1.0)]
    coords = stored(spark, places, COORDS, tmp_path / "coords")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    want = sorted(map(str, join_coords(sales, coords).select(*sales.columns, "lon", "lat").collect()))
    for c in names:
        spark.conf.set(c, -1)
    try:
        tables.write_bucketed(sales, "trades_of_large_roads", str(tmp_path / "roads"), "road_key")
        kept = tables.scan_bucketed(spark, "trades_of_large_roads")
        sizes = [r["n"] for r in kept.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == len(rows) and max(sizes) < 400
        joined = join_coords(kept, coords)
        assert "road_part" not in joined.columns
        assert sorted(map(str, joined.select(*sales.columns, "lon", "lat").collect())) == want
        some = join_coords(kept.filter("ym = 202401"), coords)
        assert some.count() == sum("ym=202401" in w for w in want)
        # Nothing is dealt between the trades' scan and the join that reads all their columns.
        lines = executed(joined).split("\n")
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line and "price" in line)
        join = max(i for i, line in enumerate(lines[:scan]) if "LeftOuter" in line)
        assert not any("Exchange" in line for line in lines[join:scan])
    finally:
        for c in names:
            spark.conf.unset(c)
        spark.sql("DROP TABLE IF EXISTS trades_of_large_roads")


def test_partial_counts_follow_appends_and_corrections(spark, tmp_path):
    path = str(tmp_path / "counts")
    rows = [sale(f"c{i % 5}", 202400 + i % 12 + 1, address=f"{CITY} 서구 {'가나'[i % 2]}동", road=[None, "길 1"][i % 3 > 0]) for i in range(240)]
    early = spark.createDataFrame([r for r in rows if r[4] < 202410], SALES)
    whole = spark.createDataFrame(rows + [sale("c1", None)], SALES)

    def same(trades, source):
        stored_counts = rollups.trade_counts(trades.limit(0), path, source)
        assert sorted(map(str, dicts(stored_counts))) == sorted(map(str, dicts(rollups.trade_counts(trades))))
        assert sorted(map(str, dicts(R.best_emd_of(stored_counts)))) == sorted(map(str, dicts(R.best_emd(trades))))

    rollups.refresh_counts(early, path, "1")
    same(early, "1")
    files = {f for f in spark.read.parquet(f"{path}/counts").inputFiles() if "month=202401" in f}
    batch = whole.filter("ym >= 202410 OR ym IS NULL")
    months = rollups.touched_months(batch)
    assert months == [None, 202410, 202411, 202412]
    for _ in range(2):  # also when it is run twice
        rollups.refresh_counts(whole, path, "2", months)
        same(whole, "2")
    corrected = whole.filter("ym IS NULL OR ym <> 202403").unionByName(spark.createDataFrame([sale("new", 202404)], SALES))
    # The state before is still what the manifest names, so a reader that wants the new one computes it.
    assert rollups.trade_counts(corrected, path, "3").filter("complex = 'new'").count() == 1
    rollups.refresh_counts(corrected, path, "3", [202403, 202404])
    same(corrected, "3")
    assert files and files <= set(spark.read.parquet(f"{path}/counts").inputFiles())
    assert rollups.manifest(spark, path)["version"] == 4 and rollups.manifest(spark, path)["trades"] == corrected.count()


def test_lookups_are_stored_for_each_state(spark, tmp_path):
    path = str(tmp_path / "lookup")
    made = []

    def lookup(state, n):
        return rollups.stored_lookup(spark, path, state, lambda: made.append(state) or spark.range(n)).count()

    assert [lookup("a", 3), lookup("a", 9), lookup("b", 5), lookup("b", 1)] == [3, 3, 5, 5] and made == ["a", "b"]


def test_lists_of_lines_are_read_in_splits(spark, tmp_path):
    path = tmp_path / "list"
    path.mkdir()
    entries = [{"시군구": "서울특별시 강동구 고덕동", "단지명": f"단지 {i}", "전용면적": 50.0 + i} for i in range(3000)]
    (path / "a b.json").write_text("\n".join(json.dumps(e, ensure_ascii=False) for e in entries[:2900]) + "\n\n")
    (path / "b.json").write_text(json.dumps(entries[2900:], ensure_ascii=False, indent=1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert targets.load_targets(spark, str(path / "a b.json")).rdd.getNumPartitions() > 3
        loaded = targets.load_targets(spark, str(path), position=True).orderBy("position")
        assert [r["area_m2"] for r in loaded.collect()] == [50.0 + i for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_searches_read_the_names_only(spark, tmp_path):
    words = ["래미안 강동", "강동 래미안", "힐스", "래미", "x", "", None, "a\U0001f600b"]
    sales = spark.createDataFrame([sale(w, area=float(60 + i % 2)) for i in range(40) for w in words], SALES)
    path = str(tmp_path / "names")
    names.write_names(sales, path)
    for text in ("래미안", "강동", "래", "미안 강", "없음", "스힐", "", "\U0001f600b", "a\U0001f600b"):
        found = names.search_names(spark, path, text)
        want = {(w, a) for w in words if w is not None and text in w for a in (60.0, 61.0)}
        assert {(r["complex"], r["area_m2"]) for r in dicts(found)} == want and found.count() == len(want)
        assert all("/names/" in f for f in found.inputFiles())
    plan = names.search_names(spark, path, "래미안")._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan


def test_unreadable_amounts_are_errors(spark):
    columns = ("`시도` string, `시군구` string, `읍면동` string, `단지명` string, `전용면적(㎡)` double, `거래금액(만원)` string, "
               "`계약년월` int, `계약일` int, `층` int, `건축년도` int, `도로명` string, `해제사유발생일` string, `거래유형` string")

    def read(amount):
        rows = spark.createDataFrame([("서울", "구", "동", "가", 84.0, amount, 202401, 1, 1, 2010, "길", None, None)], columns)
        return tables.normalize_foreign_sales(rows).first()["price"]

    assert read("12,300") == 12300 and read(None) is None
    with pytest.raises(Exception, match="not an amount"):
        read("12억")
