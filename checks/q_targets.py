"""Watch-list queries: every (complex, area) of the register is watched."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import AS_OF_YEAR
from checks.views_sql import ACTIVE_STRICT, python_round1
from danji.operators import targets as G
from danji.plans import roi, tracking

PURCHASE_YM, PERIODS = 199703, [2, 4]

# Pairs of a target and a matching row, as a plain band join.
_SALES = """hits AS (SELECT t.complex, t.area_m2, s.ym, s.day, s.price, s.deal_type, s.built_year,
    s.cancelled_on FROM (SELECT DISTINCT complex, area_m2 FROM targets) t
    JOIN sales s ON s.complex = t.complex AND abs(s.area_m2 - t.area_m2) < 1)"""
_LEASES = """leases AS (SELECT t.complex, t.area_m2, r.ym, r.day, r.deposit
  FROM (SELECT DISTINCT complex, area_m2 FROM targets) t
    JOIN rents r ON r.complex = t.complex AND abs(r.area_m2 - t.area_m2) < 1 AND rent_kind = '전세')"""
_PREV = "CAST(strftime(make_date({0} // 100, {0} % 100, 1) - INTERVAL 1 MONTH, '%Y%m') AS INTEGER)"
_SALE_SIDE = f"""{_SALES}, active AS (SELECT * FROM hits WHERE {ACTIVE_STRICT}),
  last_sale AS (SELECT complex, area_m2, ym AS latest_ym, price AS latest_sale, deal_type FROM
    (SELECT *, row_number() OVER (PARTITION BY complex, area_m2 ORDER BY ym DESC, day DESC, price DESC,
      coalesce(deal_type = '직거래', false) DESC) AS r FROM active) WHERE r = 1),
  before_sale AS (SELECT complex, area_m2, price AS prev_sale FROM
    (SELECT a.*, row_number() OVER (PARTITION BY complex, area_m2 ORDER BY a.day DESC, a.price DESC) AS r
     FROM active a JOIN last_sale l USING (complex, area_m2)
     WHERE a.ym = {_PREV.format('latest_ym')}) WHERE r = 1),
  tops AS (SELECT complex, area_m2, max(price) AS peak FROM active GROUP BY ALL),
  built AS (SELECT complex, area_m2, min(built_year) AS built_year FROM hits GROUP BY ALL)"""
_LEASE_SIDE = f"""{_LEASES}, last_lease AS (SELECT complex, area_m2, ym AS latest_lease_ym,
    deposit AS latest_lease FROM (SELECT *, row_number() OVER (PARTITION BY complex, area_m2
      ORDER BY ym DESC, day DESC, deposit DESC) AS r FROM leases) WHERE r = 1),
  before_lease AS (SELECT complex, area_m2, deposit AS prev_lease FROM
    (SELECT a.*, row_number() OVER (PARTITION BY complex, area_m2 ORDER BY a.day DESC, a.deposit DESC) AS r
     FROM leases a JOIN last_lease l USING (complex, area_m2)
     WHERE a.ym = {_PREV.format('latest_lease_ym')}) WHERE r = 1)"""
_SIZES = """sizes AS (SELECT t.address, t.complex, t.area_m2, max(c.households) AS households
  FROM targets_parts t LEFT JOIN complexes c ON c.complex = t.complex
    AND contains(c.lot_address, CASE WHEN t.sido = '세종특별자치시' THEN t.sido ELSE t.sigungu END)
  GROUP BY ALL)"""


@query("targets_band_join", f"""WITH {_SALES} SELECT complex, area_m2, count(*) AS n,
  CAST(sum(price) AS BIGINT) AS total FROM hits GROUP BY ALL""", "targets sales")
def _(v):
    monthly = v.sales.groupBy("complex", "area_m2", "ym").agg(
        F.count("*").alias("n"), F.sum("price").alias("total"))
    return G.targets_band_join(v.targets, monthly).groupBy(*G.TARGET).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))


@query("latest_sale", f"""WITH {_SALE_SIDE} SELECT complex, area_m2, latest_sale,
  coalesce(deal_type = '직거래', false) AS latest_is_direct FROM last_sale""", "targets sales")
def _(v):
    return G.sale_summary(v.targets, v.sales).filter("latest_sale IS NOT NULL").select(
        *G.TARGET, "latest_sale", "latest_is_direct")


@query("prev_month_sale", f"WITH {_SALE_SIDE} SELECT * FROM before_sale", "targets sales")
def _(v):
    return G.sale_summary(v.targets, v.sales).select(*G.TARGET, "prev_sale").dropna()


@query("latest_lease", f"WITH {_LEASE_SIDE} SELECT complex, area_m2, latest_lease FROM last_lease",
       "targets rents")
def _(v):
    return G.lease_summary(v.targets, v.rents).select(*G.TARGET, "latest_lease")


@query("prev_month_lease", f"WITH {_LEASE_SIDE} SELECT * FROM before_lease", "targets rents")
def _(v):
    return G.lease_summary(v.targets, v.rents).select(*G.TARGET, "prev_lease").dropna()


@query("all_time_high", f"WITH {_SALE_SIDE} SELECT * FROM tops", "targets sales")
def _(v):
    return G.sale_summary(v.targets, v.sales).select(*G.TARGET, "peak").dropna()


@query("latest_ym", f"""WITH {_SALE_SIDE}, {_LEASE_SIDE} SELECT complex, area_m2, latest_ym, latest_lease_ym
  FROM last_sale FULL JOIN last_lease USING (complex, area_m2)""", "targets sales rents")
def _(v):
    sale = G.sale_summary(v.targets, v.sales).filter("latest_ym IS NOT NULL")
    lease = G.lease_summary(v.targets, v.rents)
    return sale.select(*G.TARGET, "latest_ym").join(
        lease.select(*G.TARGET, "latest_lease_ym"), G.TARGET, "full")


@query("built_year_of_target", f"WITH {_SALE_SIDE} SELECT * FROM built", "targets sales")
def _(v):
    return G.sale_summary(v.targets, v.sales).select(*G.TARGET, "built_year")


@query("households_like_join", f"""WITH {_SIZES} SELECT DISTINCT complex,
    CASE WHEN sido = '세종특별자치시' THEN sido ELSE sigungu END AS keyword, households
  FROM sizes JOIN targets_parts USING (address, complex, area_m2)
  WHERE EXISTS (SELECT 1 FROM complexes c WHERE c.complex = targets_parts.complex AND contains(c.lot_address,
    CASE WHEN sido = '세종특별자치시' THEN sido ELSE sigungu END))""", "targets_parts complexes")
def _(v):
    return G.households_like_join(v.targets, v.complexes)


@query("tracking_report", f"""WITH {_SALE_SIDE}, {_LEASE_SIDE}, {_SIZES},
  base AS (SELECT t.sido, t.sigungu, t.emd, t.complex, t.area_m2,
      CAST(round_even(t.area_m2 * 0.4, 0) AS INTEGER) AS pyeong, households, built_year,
      CASE WHEN built_year <> 0 THEN greatest(1, {AS_OF_YEAR} - built_year) END AS age,
      latest_sale, prev_sale, latest_lease, prev_lease, peak, deal_type
    FROM targets_parts t LEFT JOIN last_sale USING (complex, area_m2)
      LEFT JOIN before_sale USING (complex, area_m2) LEFT JOIN last_lease USING (complex, area_m2)
      LEFT JOIN before_lease USING (complex, area_m2) LEFT JOIN tops USING (complex, area_m2)
      LEFT JOIN built USING (complex, area_m2) LEFT JOIN sizes s ON s.address = t.address
        AND s.complex = t.complex AND s.area_m2 = t.area_m2),
  ratios AS (SELECT *, latest_sale - latest_lease AS gap, prev_sale - prev_lease AS prev_gap,
      {python_round1('latest_lease / latest_sale * 100')} AS lease_ratio,
      {python_round1('prev_lease / prev_sale * 100')} AS prev_lease_ratio FROM base)
  SELECT sido, sigungu, emd, complex, area_m2, pyeong, households, built_year, age, latest_sale,
    latest_sale - prev_sale AS sale_change, latest_lease, latest_lease - prev_lease AS lease_change, gap,
    gap - prev_gap AS gap_change, lease_ratio,
    {python_round1('lease_ratio - prev_lease_ratio')} AS lease_ratio_change, peak,
    {python_round1('(latest_sale / peak - 1) * 100')} AS vs_peak, prev_sale, prev_lease, prev_gap,
    prev_lease_ratio, CASE WHEN deal_type = '직거래' THEN '직거래' END AS note
  FROM ratios""", "targets_parts targets sales rents complexes")
def tracking_report(v):
    return tracking.tracking_report(v.targets, v.sales, v.rents, v.complexes, AS_OF_YEAR)


def _nearest(source: str, amount: str, keep: str) -> str:
    """Best row per target and requested month."""
    months = ", ".join(f"({PURCHASE_YM + 100 * n})" for n in [0, *PERIODS])
    distance = "abs((ym // 100) * 12 + ym % 100 - (target_ym // 100) * 12 - target_ym % 100)"
    return f"""(SELECT complex, area_m2, target_ym, {amount} AS amount, distance FROM
    (SELECT *, row_number() OVER (PARTITION BY complex, area_m2, target_ym
        ORDER BY distance, day DESC, {amount} DESC) AS r
     FROM (SELECT *, {distance} AS distance FROM {source}, (VALUES {months}) AS m(target_ym) WHERE {keep}))
    WHERE r = 1 AND distance <= 12)"""


_SALE_AT = _nearest("hits", "price", f"{ACTIVE_STRICT} AND deal_type <> '직거래'")
_LEASE_AT = _nearest("leases", "deposit", "true")


def _requests(v):
    months = F.explode(F.array(*[F.lit(PURCHASE_YM + 100 * n) for n in [0, *PERIODS]]))
    return v.targets.select(*G.TARGET, months.alias("target_ym"))


@query("nearest_month_price", f"""WITH {_SALES} SELECT complex, area_m2, target_ym, amount,
  CAST(distance AS INTEGER) AS distance FROM {_SALE_AT}""", "targets sales")
def nearest_month_price(v):
    market = G.monthly_sales(G.watched(v.sales, v.targets)).select(
        "complex", "area_m2", "ym", F.col("last_market").alias("last"))
    return G.nearest_month_price(_requests(v), market)


@query("nearest_rank", f"""WITH {_LEASES} SELECT complex, area_m2, target_ym, amount,
  CAST(distance AS INTEGER) AS distance FROM {_LEASE_AT}""", "targets rents")
def _(v):
    return G.nearest_month_price(_requests(v), G.monthly_leases(G.watched(v.rents, v.targets)))


def _roi_sql() -> str:
    columns, gap = [], "(buy_sale - buy_lease)"
    for n in PERIODS:
        columns.append(f"""y{n}_sale, y{n}_lease, y{n}_sale - y{n}_lease AS y{n}_gap,
      y{n}_sale - buy_sale AS y{n}_gain, CASE WHEN {gap} > 0 THEN
      {python_round1(f'(y{n}_sale - buy_sale) / {gap} * 100')} END AS y{n}_return""")
    wide = ", ".join(
        f"max(amount) FILTER (WHERE target_ym = {ym}) AS {p}_{{kind}}"
        for p, ym in roi.report_months(PURCHASE_YM, PERIODS).items())
    return f"""WITH {_SALES}, {_LEASES}, {_SIZES},
  built AS (SELECT complex, area_m2, min(built_year) AS built_year FROM hits GROUP BY ALL),
  s AS (SELECT complex, area_m2, {wide.format(kind='sale')} FROM {_SALE_AT} GROUP BY ALL),
  l AS (SELECT complex, area_m2, {wide.format(kind='lease')} FROM {_LEASE_AT} GROUP BY ALL)
  SELECT t.sido, t.sigungu, t.emd, t.complex, t.area_m2,
    CAST(round_even(t.area_m2 * 0.4, 0) AS INTEGER) AS pyeong, households, built_year, buy_sale, buy_lease,
    {gap} AS buy_gap, {', '.join(columns)}
  FROM targets_parts t LEFT JOIN s USING (complex, area_m2) LEFT JOIN l USING (complex, area_m2)
    LEFT JOIN built USING (complex, area_m2) LEFT JOIN sizes z ON z.address = t.address
      AND z.complex = t.complex AND z.area_m2 = t.area_m2"""


@query("roi_report", _roi_sql(), "targets_parts targets sales rents complexes")
def roi_report(v):
    return roi.roi_report(v.targets, v.sales, v.rents, v.complexes, PURCHASE_YM, PERIODS)


# Candidates: every (complex, area) that was rented. Listed: the entries below 100 square metres.
_CANDIDATES = """candidates AS (SELECT DISTINCT complex, area_m2 FROM rents),
  listed AS (SELECT * FROM targets WHERE area_m2 < 100),
  matched AS (SELECT c.complex, c.area_m2, count(DISTINCT s.address) AS places, min(s.address) AS address,
      min(s.area_m2) AS actual_area
    FROM candidates c LEFT JOIN sales s ON s.complex = c.complex AND abs(s.area_m2 - c.area_m2) < 1
    GROUP BY ALL),
  free AS (SELECT complex, actual_area, min(area_m2) AS area_m2 FROM matched m WHERE places = 1
    AND NOT EXISTS (SELECT 1 FROM listed l WHERE l.complex = m.complex AND abs(l.area_m2 - m.actual_area) < 1)
    GROUP BY ALL),
  -- One after another, by rising area: an entry is added when the last one added is 1 or more away.
  walked AS (SELECT complex, unnest(list_reduce(list([actual_area] ORDER BY actual_area),
    lambda kept, next: CASE WHEN next[1] - kept[-1] < 1 THEN kept ELSE kept || next END)) AS actual_area
    FROM free GROUP BY complex),
  added AS (SELECT complex, area_m2 FROM free JOIN walked USING (complex, actual_area)),
  judged AS (SELECT complex, area_m2, CASE WHEN places = 0 THEN 'not_found' WHEN places > 1 THEN 'ambiguous'
      WHEN (complex, area_m2) IN (SELECT (complex, area_m2) FROM added) THEN 'accepted'
      ELSE 'duplicate' END AS status,
      CASE WHEN places = 1 THEN address END AS address,
      CASE WHEN places = 1 THEN actual_area END AS actual_area FROM matched m)"""


def _candidates(v):
    return v.rents.select("complex", "area_m2").distinct()


def _listed(v):
    return v.targets.filter(F.col("area_m2") < 100)


@query("validate_targets", f"WITH {_CANDIDATES} SELECT * FROM judged", "targets sales rents")
def _(v):
    return G.validate_targets(_candidates(v), v.sales, _listed(v))


@query("ambiguous_addresses", f"""WITH {_CANDIDATES} SELECT DISTINCT m.complex, m.area_m2, s.address,
    s.area_m2 AS actual_area FROM matched m JOIN sales s ON s.complex = m.complex
    AND abs(s.area_m2 - m.area_m2) < 1 WHERE places > 1""", "targets sales rents")
def _(v):
    return G.ambiguous_addresses(_candidates(v), v.sales)


@query("accept_targets", f"""WITH {_CANDIDATES} SELECT address, complex, area_m2 FROM listed UNION ALL
  (SELECT DISTINCT address, complex, actual_area FROM judged WHERE status = 'accepted')""",
       "targets sales rents")
def _(v):
    listed = _listed(v)
    return G.accept_targets(G.validate_targets(_candidates(v), v.sales, listed), listed)


@query("remove_targets", """SELECT address, complex, area_m2 FROM targets t WHERE NOT EXISTS
  (SELECT 1 FROM rents r WHERE r.complex = t.complex AND abs(r.area_m2 - t.area_m2) < 1)""",
       "targets rents")
def _(v):
    return G.remove_targets(v.targets, _candidates(v))
