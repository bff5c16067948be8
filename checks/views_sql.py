"""The tables of checks/views.py as SQL for a second engine, and pieces its queries share."""

_DIRECTION = "(['중','동','서','남','북'])[(n_nationkey // 5) + 1]"

_VIEWS = {
    "nations": (
        [],
        f"""SELECT n_nationkey, n_regionkey, province, short_name, d,
    CASE province WHEN '경기도' THEN province || ' ' || d || '시 ' || d || '구'
                  WHEN '세종특별자치시' THEN province || '  ' || d || '읍'
                  WHEN '충청남도' THEN province || ' ' || d || '군 ' || d || '읍'
                  ELSE province || ' ' || d || '구' END AS base,
    CASE province WHEN '경기도' THEN d || '시 ' || d || '구'
                  WHEN '세종특별자치시' THEN province
                  WHEN '충청남도' THEN d || '군 ' || d || '읍'
                  ELSE d || '구' END AS district,
    CAST(n_regionkey + 11 AS VARCHAR) || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS sig_cd
  FROM (SELECT n_nationkey, n_regionkey, {_DIRECTION} AS d,
      CASE r_name WHEN 'AFRICA' THEN '서울특별시' WHEN 'AMERICA' THEN '경기도'
        WHEN 'ASIA' THEN '세종특별자치시' WHEN 'EUROPE' THEN '부산광역시'
        WHEN 'MIDDLE EAST' THEN '충청남도' END AS province,
      CASE r_name WHEN 'AFRICA' THEN '서울' WHEN 'AMERICA' THEN '경기' WHEN 'ASIA' THEN '세종'
        WHEN 'EUROPE' THEN '부산' WHEN 'MIDDLE EAST' THEN '충남' END AS short_name
    FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    ),
    "places": (
        ["nations"],
        """SELECT p_partkey, p_size, nations.*, replace(p_name, ' ', '_') AS complex,
    replace(p_brand, 'Brand#', '제') || CASE WHEN province IN ('세종특별자치시', '충청남도')
      THEN '리' ELSE '동' END AS town,
    '큰길 ' || (p_partkey % 4) AS main_road, '샛길 ' || n_nationkey AS side_road,
    CAST(1975 + p_partkey % 30 AS INTEGER) AS first_year
  FROM part JOIN nations ON n_nationkey = p_partkey % 25""",
    ),
    "located_sales": (
        ["places"],
        """SELECT base || CASE WHEN l_linenumber % 7 = 0 THEN '' ELSE ' ' || town END AS address,
    complex, p_size * 4.0::DOUBLE + (l_linenumber % 3) * 0.5::DOUBLE AS area_m2,
    CAST(floor(l_extendedprice) AS BIGINT) AS price,
    CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym,
    CAST(day(l_shipdate) AS INTEGER) AS day, l_linenumber AS floor_no,
    CASE WHEN l_discount = 0.1 THEN 0 WHEN l_discount = 0.09 THEN NULL ELSE first_year END AS built_year,
    CASE WHEN l_tax = 0.08 THEN '' WHEN l_tax = 0 THEN NULL
      WHEN l_linenumber % 5 = 0 THEN side_road ELSE main_road END AS road,
    CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y%m%d')
      WHEN l_returnflag = 'A' THEN CASE l_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN 'None'
        WHEN 3 THEN '-' END END AS cancelled_on,
    CASE WHEN l_linestatus = 'O' THEN '중개거래' WHEN l_tax < 0.02 THEN '직거래'
      WHEN l_orderkey % 11 <> 0 THEN '중개거래' END AS deal_type,
    n_nationkey, n_regionkey, sig_cd, district, short_name
  FROM lineitem JOIN places ON l_partkey = p_partkey""",
    ),
    "sales": (
        ["located_sales"],
        """SELECT address, complex, area_m2, price, ym, day, floor_no, built_year, road, cancelled_on,
    deal_type FROM located_sales""",
    ),
    "located_rents": (
        ["places"],
        """SELECT base || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ' ' || town END AS address,
    complex, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN '전세'
      ELSE '월세' END AS rent_kind,
    p_size * 4.0::DOUBLE + (o_orderkey % 3) * 0.5::DOUBLE AS area_m2,
    CAST(floor(o_totalprice / 8) AS BIGINT) AS deposit,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym,
    CAST(day(o_orderdate) AS INTEGER) AS day, CAST(o_orderkey % 20 + 1 AS INTEGER) AS floor_no,
    first_year AS built_year,
    CASE WHEN o_orderstatus = 'P' THEN side_road ELSE main_road END AS road,
    n_nationkey, n_regionkey, sig_cd, district, short_name
  FROM orders JOIN places ON o_custkey = p_partkey""",
    ),
    "rents": (
        ["located_rents"],
        """SELECT address, complex, rent_kind, area_m2, deposit, ym, day, floor_no, built_year, road
  FROM located_rents""",
    ),
    "coords": (
        ["places"],
        """SELECT CASE WHEN province = '세종특별자치시' THEN '세종특별자치시 세종시 ' || road
      ELSE split_part(base, ' ', 1) || ' ' || split_part(base, ' ', 2) || ' ' || road END AS road_key,
    min(12400 + n_nationkey * 10 + k) / 100.0::DOUBLE AS lon,
    min(3500 + n_nationkey * 10 + k) / 100.0::DOUBLE AS lat
  FROM (SELECT base, province, n_nationkey, main_road AS road, p_partkey % 4 AS k FROM places
    UNION ALL SELECT base, province, n_nationkey, side_road, 9 FROM places)
  WHERE (k < 9 AND road <> '큰길 3') OR (k = 9 AND province IN ('서울특별시', '부산광역시'))
  GROUP BY 1
  UNION ALL
  SELECT main_road, 999.0::DOUBLE, 999.0::DOUBLE FROM places GROUP BY 1
  UNION ALL
  SELECT side_road, min(12409 + n_nationkey * 10) / 100.0::DOUBLE,
    min(3509 + n_nationkey * 10) / 100.0::DOUBLE FROM places GROUP BY 1""",
    ),
    "complexes": (
        ["places"],
        """SELECT CASE province
      WHEN '세종특별자치시' THEN province || ' 세종시 ' || d || '읍'
      ELSE base || ' ' || town END
    || ' ' || (p_partkey % 50 + 1) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '-' || p_partkey % 3 END
      AS lot_address,
    complex || CASE WHEN p_partkey % 2 = 0 THEN ' 1단지' ELSE '' END AS complex,
    CAST(CASE WHEN p_partkey % 17 = 0 THEN 0 WHEN p_partkey % 13 = 0 THEN NULL
      ELSE 100 + p_partkey % 2000 END AS INTEGER) AS households,
    CASE WHEN p_partkey % 9 = 0 THEN '2' ELSE '1' END AS kind_code
  FROM places""",
    ),
    "sale_months": (
        ["located_sales"],
        """SELECT sig_cd || '00000' AS region_code, district AS region_name,
    make_date(ym // 100, ym % 100, 1) AS date, CAST(sum(price) AS DOUBLE) / count(*) AS mean
  FROM located_sales GROUP BY ALL
  UNION ALL
  SELECT (n_regionkey + 11) || '00000000', short_name, make_date(ym // 100, ym % 100, 1),
    CAST(sum(price) AS DOUBLE) / count(*)
  FROM located_sales GROUP BY n_regionkey, short_name, ym""",
    ),
    "lease_months": (
        ["located_rents"],
        """SELECT sig_cd || '00000' AS region_code, district AS region_name,
    make_date(ym // 100, ym % 100, 1) AS date, CAST(sum(deposit) AS DOUBLE) / count(*) AS mean
  FROM located_rents GROUP BY ALL
  UNION ALL
  SELECT (n_regionkey + 11) || '00000000', short_name, make_date(ym // 100, ym % 100, 1),
    CAST(sum(deposit) AS DOUBLE) / count(*)
  FROM located_rents GROUP BY n_regionkey, short_name, ym""",
    ),
    "sale_index": (
        ["sale_months"],
        """SELECT freq, asset_kind, region_code, region_name, date, mean + shift AS index_value
  FROM sale_months, (VALUES ('월간','아파트',0), ('주간','아파트',1), ('월간','연립',2))
    AS kinds(freq, asset_kind, shift)""",
    ),
    "lease_index": (
        ["lease_months"],
        """SELECT freq, asset_kind, region_code, region_name, date, mean + shift AS index_value
  FROM lease_months, (VALUES ('월간','아파트',0), ('주간','아파트',1), ('월간','연립',2))
    AS kinds(freq, asset_kind, shift)""",
    ),
    "lease_ratio": (
        ["sale_months", "lease_months"],
        """SELECT date, asset_kind, region_code, s.region_name, l.mean / s.mean * 100 AS ratio
  FROM sale_months s JOIN lease_months l USING (region_code, date),
    (VALUES ('아파트'), ('연립')) AS kinds(asset_kind)""",
    ),
    "targets": (
        ["places"],
        """SELECT min(base || ' ' || town) AS address, complex, p_size * 4.0::DOUBLE AS area_m2 FROM places
  GROUP BY complex, p_size""",
    ),
    "regions_geo": (
        ["nations"],
        """SELECT sig_cd, district AS sig_kor_nm,
    CASE WHEN district = province THEN province ELSE province || ' ' || district END AS full_nm,
    CASE WHEN n_nationkey % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
    n_nationkey, province
  FROM nations""",
    ),
    # Parsed address parts, by list operations on the words.
    "sales_parts": (["sales"], "PARTS sales"),
    "rents_parts": (["rents"], "PARTS rents"),
    "targets_parts": (["targets"], "PARTS targets"),
}

_PARTS = """SELECT *, w[1] AS sido,
    CASE WHEN clean LIKE '세종특별자치시%' THEN '세종시' WHEN len(w) >= 4 THEN w[2] || ' ' || w[3]
      WHEN len(w) >= 2 THEN w[2] ELSE '' END AS sigungu,
    CASE WHEN clean LIKE '세종특별자치시%' THEN coalesce(w[2], '') WHEN len(w) >= 4 THEN w[4]
      WHEN len(w) >= 3 THEN w[3] ELSE '' END AS emd,
    CASE WHEN clean LIKE '세종특별자치시%' THEN '세종특별자치시 세종시' ELSE w[1] || ' ' || w[2] END
      AS key_prefix
  FROM (SELECT *, string_split(clean, ' ') AS w FROM
    (SELECT *, trim(regexp_replace(address, '\\s+', ' ', 'g')) AS clean FROM {table}))"""


def with_views(names: list[str], body: str) -> str:
    """`body` behind a WITH clause that defines the named views and what they need.

    A body may define tables of its own by starting with "WITH".
    """
    order: list[str] = []

    def add(name: str) -> None:
        needs, _ = _VIEWS[name]
        for need in needs:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    defined = []
    for name in order:
        text = _VIEWS[name][1]
        if text.startswith("PARTS "):
            text = _PARTS.format(table=text.split()[1])
        defined.append(f"{name} AS (\n  {text}\n)")
    body = body.strip()
    head = "WITH " + ",\n".join(defined)
    if body[:5].upper() == "WITH ":
        return head + ",\n" + body[5:]
    return head + "\n" + body


# SQL spellings shared by several queries.
ACTIVE_STRICT = "(cancelled_on IS NULL OR cancelled_on IN ('', 'None'))"
ACTIVE_WIDE = "(cancelled_on IS NULL OR cancelled_on IN ('', 'None', '-'))"
MARKET = f"(deal_type IS NULL OR deal_type <> '직거래') AND {ACTIVE_WIDE}"
AREA_BAND = """CASE WHEN area_m2 <= 40 THEN '초소형' WHEN area_m2 <= 60 THEN '소형'
  WHEN area_m2 <= 85 THEN '중소형' WHEN area_m2 <= 135 THEN '중대형' ELSE '대형' END"""
PYEONG_BAND = """CASE WHEN area_m2 * 0.4 < 10 THEN '10평 미만'
  WHEN area_m2 * 0.4 >= 60 THEN '60평 이상'
  ELSE CAST(CAST(floor(area_m2 * 0.4 / 10) AS INTEGER) * 10 AS VARCHAR) || '평대' END"""
AGE_BAND = """CASE WHEN 2002 - built_year < 5 THEN '5년 미만' WHEN 2002 - built_year < 10 THEN '5~10년'
  WHEN 2002 - built_year < 20 THEN '10~20년' WHEN 2002 - built_year < 30 THEN '20~30년'
  ELSE '30년 이상' END"""
EOK = "round({} / 10000.0::DOUBLE, 1)"


def python_round1(x: str) -> str:
    """One decimal, judged on the exact binary value."""
    return f"CAST(printf('%.1f', {x}) AS DOUBLE)"
