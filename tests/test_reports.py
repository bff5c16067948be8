from conftest import COMPLEXES, RENTS, SALES, TARGETS, dicts

from danji.operators import targets as G
from danji.plans import ranking, roi, tracking
from danji.operators.ranking import complex_rollup
from pyspark.sql import functions as F

ADDRESS = "서울특별시 강동구 고덕동"


def sale(area, ym, day, price, deal="중개거래", cancelled=None, name="가단지", built=2010):
    return (ADDRESS, name, area, price, ym, day, 5, built, "길 1", cancelled, deal)


def rent(area, ym, day, deposit, kind="전세", name="가단지"):
    return (ADDRESS, name, kind, area, deposit, ym, day, 5, 2010, "길 1")


def frames(spark, sales, rents):
    return (
        spark.createDataFrame([(ADDRESS, "가단지", 84.0)], TARGETS),
        spark.createDataFrame(sales, SALES), spark.createDataFrame(rents, RENTS),
        spark.createDataFrame(
            [("서울특별시 강동구 고덕동 1-1", "가단지", 500, "1"), ("부산광역시 서구 1", "가단지", 900, "1")],
            COMPLEXES),
    )


def test_tracking_report(spark):
    targets, sales, rents, complexes = frames(
        spark,
        [sale(84.0, 202412, 20, 100000), sale(84.5, 202501, 5, 110000),
         sale(84.0, 202501, 15, 112000, "직거래", ""), sale(84.0, 202502, 1, 130000, cancelled="20250210"),
         sale(84.0, 202503, 1, 140000, cancelled="-"), sale(85.0, 202501, 30, 999999),
         sale(84.0, 202306, 10, 125000, cancelled="None")],
        [rent(84.0, 202503, 10, 60000), rent(84.0, 202504, 10, 10000, "월세"),
         rent(84.0, 202502, 28, 58000), rent(84.0, 202502, 3, 50000)],
    )
    df = tracking.tracking_report(targets, sales, rents, complexes, 2025)
    assert df.columns == tracking.COLUMNS and len(df.columns) == 24
    (row,) = dicts(df)
    expected = {
        "sido": "서울특별시", "sigungu": "강동구", "emd": "고덕동", "pyeong": 34, "households": 500,
        "built_year": 2010, "age": 15, "latest_sale": 112000, "sale_change": 12000,
        "latest_lease": 60000, "lease_change": 2000, "gap": 52000, "prev_gap": 42000,
        "gap_change": 10000, "lease_ratio": 53.6, "prev_lease_ratio": 58.0, "lease_ratio_change": -4.4,
        "peak": 125000, "vs_peak": -10.4, "note": "직거래",
    }
    assert {k: row[k] for k in expected} == expected


def test_tracking_without_trades(spark):
    targets, sales, rents, complexes = frames(
        spark, [sale(84.0, 202502, 1, 130000, cancelled="20250210")], [rent(84.0, 202504, 1, 1, "월세")])
    (row,) = dicts(tracking.tracking_report(targets, sales, rents, complexes, 2025))
    assert row["built_year"] == 2010  # from the cancelled sale
    assert all(row[c] is None for c in tracking.COLUMNS[9:])


def test_roi_report(spark):
    targets, sales, rents, complexes = frames(
        spark,
        [sale(84.0, 202112, 10, 80000), sale(84.0, 202202, 25, 82000),
         sale(84.0, 202201, 9, 70000, "직거래"), sale(84.0, 202401, 1, 90000)],
        [rent(84.0, 202201, 3, 50000), rent(84.0, 202201, 20, 52000), rent(84.0, 202301, 7, 55000)],
    )
    (row,) = dicts(roi.roi_report(targets, sales, rents, complexes, 202201, [2, 4]))
    expected = {
        "buy_sale": 82000, "buy_lease": 52000, "buy_gap": 30000, "y2_sale": 90000, "y2_lease": 55000,
        "y2_gap": 35000, "y2_gain": 8000, "y2_return": 26.7, "y4_sale": None, "y4_lease": None,
        "y4_gap": None, "y4_gain": None, "y4_return": None,
    }
    assert {k: row[k] for k in expected} == expected


def test_roi_without_a_positive_gap(spark):
    targets, sales, rents, complexes = frames(
        spark, [sale(84.0, 202201, 1, 50000), sale(84.0, 202401, 1, 90000)],
        [rent(84.0, 202201, 3, 60000)])
    (row,) = dicts(roi.roi_report(targets, sales, rents, complexes, 202201, [2]))
    assert (row["buy_gap"], row["y2_gain"], row["y2_return"]) == (-10000, 40000, None)


def test_nearest_month_both_forms_agree(spark):
    targets, sales, rents, _ = frames(
        spark, [sale(84.0 + i % 2 / 2, 202000 + i % 12 + 1, i % 28 + 1, 1000 + i) for i in range(0, 60, 7)],
        [])
    monthly = G.monthly_sales(sales)
    months = [201812, 201912, 202006, 202112, 202301]
    asked = targets.select("complex", "area_m2", F.explode(F.array(*map(F.lit, months))).alias("target_ym"))
    ranked = {r["target_ym"]: r["amount"] for r in dicts(G.nearest_month_price(asked, monthly))}
    one = G.targets_band_join(targets, monthly).agg(
        *[G.nearest_at(F.col("ym"), F.col("last"), m).alias(str(m)) for m in months]).first()
    assert {m: one[str(m)] for m in months if one[str(m)] is not None} == ranked


def test_packed_trades_hold_every_day_and_amount(spark):
    days, amounts = [0, 1, 150, 20250131, 2**31 - 1, -2], [-(2**63), -1, 0, 10**12, 2**63 - 1]
    rows = [(d, a, m) for d in days for a in amounts for m in (False, True)]
    df = spark.createDataFrame(rows, "day int, amount bigint, mark boolean")
    key = G.pack(F.col("day"), F.col("amount"), F.col("mark"))
    got = df.select(key.alias("key"), "day", "amount", "mark").select(
        "*", G.packed_amount(F.col("key")).alias("a"), G.packed_mark(F.col("key")).alias("m")).collect()
    assert all((r.a, r.m) == (r.amount, r.mark) for r in got)
    assert [tuple(r)[1:4] for r in sorted(got, key=lambda r: r.key)] == sorted(rows)
    near = df.select(F.lit(202001).alias("ym"), key.alias("last")).agg(
        G.nearest_at(F.col("ym"), F.col("last"), 202003).alias("x"))
    assert near.first()[0] == 2**63 - 1


def test_nearest_month_is_not_moved_by_the_day(spark):
    rows = [(202001, 150, 1000), (202002, 1, 2000)]
    df = spark.createDataFrame(rows, "ym int, day int, amount bigint")
    last = G.pack(F.col("day"), F.col("amount"))
    assert df.agg(G.nearest_at(F.col("ym"), last, 202002)).first()[0] == 2000


def test_a_batch_is_taken_one_by_one(spark):
    areas = [83.5, 84.2, 84.4, 85.3, 99.0]
    _, sales, _, _ = frames(spark, [sale(a, 202501, 1, 1, name="batch") for a in areas], [])
    asked = [83.0, 84.0, 84.9, 85.6, 99.5, 70.0]
    candidates = spark.createDataFrame([("batch", a) for a in asked], "complex string, area_m2 double")
    judged = G.validate_targets(candidates, sales, spark.createDataFrame([], TARGETS))
    listed, want = [], set()
    for area in sorted(asked):  # the rule: each is added, or not, before the next is looked at
        hits = [a for a in areas if abs(a - area) < 1]
        if not hits:
            want.add((area, "not_found", None))
        elif any(abs(x - min(hits)) < 1 for x in listed):
            want.add((area, "duplicate", min(hits)))
        else:
            listed.append(min(hits))
            want.add((area, "accepted", min(hits)))
    assert {(r["area_m2"], r["status"], r["actual_area"]) for r in dicts(judged)} == want
    assert sorted(r["area_m2"] for r in dicts(G.accept_targets(judged, spark.createDataFrame([], TARGETS)))) == listed


def test_only_listed_names_are_aggregated(spark):
    targets, sales, rents, complexes = frames(spark, [sale(84.0, 202501, 1, 1)], [rent(84.0, 202501, 1, 1)])
    many = sales.unionByName(spark.range(3000).select(*[
        (F.concat(F.lit("other"), F.col("id")) if f.name == "complex" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in sales.schema]))
    for report in (G.sale_summary(targets, many), roi.roi_report(targets, many, rents, complexes, 202501, [2])):
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi, (complex" in plan
        # The semi join stands below the first grouping by month.
        assert plan.index("Aggregate [complex") < plan.index("LeftSemi, (complex")


def test_ambiguous_addresses_are_listed(spark):
    _, sales, _, _ = frames(spark, [sale(84.0, 202501, 1, 1, name="twin"), sale(50.0, 202501, 1, 1, name="lone")], [])
    sales = sales.unionByName(sales.withColumn("address", F.lit("elsewhere")).filter("complex = 'twin'"))
    candidates = spark.createDataFrame([("twin", 84.5), ("lone", 50.0)], "complex string, area_m2 double")
    got = {(r["complex"], r["address"], r["actual_area"]) for r in dicts(G.ambiguous_addresses(candidates, sales))}
    assert got == {("twin", ADDRESS, 84.0), ("twin", "elsewhere", 84.0)}


def test_target_list(spark):
    _, sales, _, _ = frames(spark, [sale(84.0, 202501, 1, 1), sale(59.9, 202501, 1, 1, name="나단지")], [])
    elsewhere = sales.filter("complex = '나단지'").withColumn("address", F.lit("부산광역시 서구"))
    sales = sales.unionByName(elsewhere).unionByName(
        sales.filter("complex = '가단지'").withColumn("complex", F.lit("다단지")))
    candidates = spark.createDataFrame(
        [("가단지", 84.3), ("나단지", 60.0), ("다단지", 83.5), ("라단지", 84.0)], "complex string, area_m2 double")
    listed = spark.createDataFrame([(ADDRESS, "가단지", 84.9)], TARGETS)
    judged = G.validate_targets(candidates, sales, listed)
    assert {(r["complex"], r["status"], r["actual_area"]) for r in dicts(judged)} == {
        ("가단지", "duplicate", 84.0), ("나단지", "ambiguous", None), ("다단지", "accepted", 84.0),
        ("라단지", "not_found", None)}
    after = G.accept_targets(judged, listed)
    assert {(r["complex"], r["area_m2"]) for r in dicts(after)} == {("가단지", 84.9), ("다단지", 84.0)}
    left = G.remove_targets(after, spark.createDataFrame([("가단지", 84.0)], "complex string, area_m2 double"))
    assert [r["complex"] for r in dicts(left)] == ["다단지"]


PIVOT = (
    "sido string, sigungu string, emd string, complex string, built_year int, age_band string, "
    "area_band string, contract_year int, n bigint, households int, turnover double, lon double, lat double"
)


def test_ranking_rollup(spark):
    place = ("서울특별시", "강남구")
    rows = [
        (*place, "역삼동", "가", 2000, "x", "소형", 2024, 3, None, None, 127.0, 37.0),
        (*place, "역삼동", "가", 2000, "x", "중소형", 2024, 2, 200, 1.0, 127.5, 37.5),
        (*place, None, "나", 2000, "x", "소형", 2024, 9, 100, 9.0, 127.0, 37.0),
    ]
    pivot = spark.createDataFrame(rows, PIVOT)
    (row,) = dicts(complex_rollup(pivot))
    assert (row["n"], row["lon"], row["households"], row["turnover"]) == (5, 127.0, 200, 2.5)
    ranked = ranking.complex_ranking(pivot)
    assert ranking.display_columns(ranked).columns[-1] == "turnover"
    unknown = ranking.complex_ranking(pivot.withColumn("households", F.lit(None).cast("int")))
    assert "households" not in ranking.display_columns(unknown).columns
