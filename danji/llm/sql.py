"""The results of some queries as DuckDB SQL, written from the operators' definitions."""

from danji.llm.host_reputation import SUFFIXES

ORACLE = {
    "op3_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), h AS (SELECT doc_id, points, sha256(bare) AS text_sha256 FROM d),
g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM h
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 2], ' ') FOR i IN range(1, len(ws) - 1)] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 90 * (na.n + nb.n - c)
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT a, b FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
""",
}

#: Tables of op5_host_reputation: kappa of a level by the method of moments.
_KAPPA = """
{name}_kappa AS (
  SELECT 1 / (CASE WHEN m > 1 AND p > 0 AND p < 1 AND e > 0
    THEN least(greatest(((kkn - b * p) / (p * (1 - p)) - (m - 1)) / e, 0.001), 0.999) ELSE 0.5 END) - 1 AS kappa
  FROM (SELECT m, b, kkn, p, s - nn / s - (m - 1) AS e FROM (
    SELECT count(*) AS m, CAST(sum(n) AS DOUBLE) AS s, CAST(sum(k) AS DOUBLE) AS b, CAST(sum(n * n) AS DOUBLE) AS nn,
           sum(CAST(k AS DOUBLE) * k / n) AS kkn, CAST(sum(k) AS DOUBLE) / sum(n) AS p
    FROM {name} WHERE n > 0))
)"""

ORACLE["op5_host_reputation"] = (
    r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), rules(verdict, host, path, rule) AS (VALUES
  ('allow', 'com', '/', 'com/'), ('block', 'example.com', '/en/', 'example.com/en/'),
  ('allow', 'www.example.com', '/en/', 'www.example.com/en/'), ('block', 'net', '/es/', 'net/es/'), ('block', 'net', '/fr/', 'net/fr/')
), r AS (
  SELECT p.page_id, p.host, p.path, arg_max(rules.rule, length(rules.rule)) AS rule, arg_max(rules.verdict, length(rules.rule)) AS listed
  FROM p LEFT JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path)
  GROUP BY 1, 2, 3
), l AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
named AS (
  SELECT host, rtrim(regexp_extract(host, '^(?:.*@)?(\[[^\]]*\]|[^:]*)', 1), '.') AS site,
         count(bad) AS n, coalesce(sum(bad), 0) AS k
  FROM p LEFT JOIN l ON doc_id = page_id GROUP BY 1
), levels AS (
  SELECT *, regexp_matches(site, '^([0-9]+(\.[0-9]+)*|\[.*)$') AS address,
         list_contains(string_split('SUFFIXES', ' '), regexp_extract(site, '([^.]*\.)?[^.]*$')) AS listed FROM named
), hosts AS (
  SELECT site, CASE WHEN address THEN site WHEN listed THEN regexp_extract(site, '([^.]*\.){0,2}[^.]*$')
           ELSE regexp_extract(site, '([^.]*\.)?[^.]*$') END AS domain,
         CASE WHEN address THEN site WHEN listed THEN regexp_extract(site, '([^.]*\.)?[^.]*$')
           ELSE regexp_extract(site, '[^.]*$') END AS suffix, sum(n) AS n, sum(k) AS k
  FROM levels GROUP BY 1, 2, 3
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY 1),
"""
    + ",".join(_KAPPA.format(name=name) for name in ("hosts", "domains", "suffixes"))
    + r"""
, root AS (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) AS rate FROM suffixes),
s2 AS (SELECT suffix, (k + kappa * rate) / (n + kappa) AS rate FROM suffixes, suffixes_kappa, root),
d2 AS (SELECT domain, (k + kappa * s2.rate) / (n + kappa) AS rate FROM domains JOIN s2 USING (suffix), domains_kappa),
h2 AS (SELECT host, hosts.k + kappa * rate AS a, hosts.n - hosts.k + kappa * (1 - rate) AS b
  FROM levels JOIN hosts USING (site) JOIN d2 USING (domain), hosts_kappa)
SELECT page_id, r.host, path, rule,
       CASE WHEN rule IS NOT NULL THEN listed
            WHEN a / (a + b) - 1.2815515655446004 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.25 THEN 'block'
            ELSE 'allow' END AS verdict
FROM r LEFT JOIN h2 USING (host)
"""
).replace("SUFFIXES", " ".join(SUFFIXES))


def _weight(level: str, weights: dict[str, int]) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{n}' THEN {w}" for n, w in weights.items()) + " ELSE 1 END"


def _dealt(name: str, children: str, parents: list[str], child: str, weights: dict[str, int]) -> str:
    """The budgets of one level of the tree, given capacity and parent_budget."""
    over = "PARTITION BY " + (", ".join(parents) or "1")
    order = f"{over} ORDER BY CAST(capacity AS DOUBLE) / weight, {child}"
    return f"""
{name}_a AS (SELECT *, {_weight(child, weights)} AS weight FROM {children}),
{name}_b AS (SELECT *, coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM {name}_a),
{name}_c AS (SELECT *, capacity * weights <= (parent_budget - earlier) * weight OR capacity = 0 AS filled FROM {name}_b),
{name}_d AS (SELECT *, parent_budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({over}) AS spread,
  nullif(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({over}), 0) AS opened FROM {name}_c),
{name}_e AS (SELECT *, CASE WHEN filled THEN 0 ELSE spread * weight // opened END AS whole,
  CASE WHEN filled THEN -1 ELSE spread * weight % opened END AS remainder FROM {name}_d),
{name} AS (SELECT *, CASE WHEN filled THEN capacity ELSE whole + CASE WHEN row_number() OVER ({over} ORDER BY remainder DESC, {child})
    <= spread - sum(whole) OVER ({over}) THEN 1 ELSE 0 END END AS budget FROM {name}_e)"""


def mixing_sql(docs: str, weights: dict[str, dict[str, int]], max_epochs: int, seed: int, part: tuple[int, int] = (1, 1)) -> str:
    """op1 over a relation of documents; domain, lang and source are the levels of the tree."""
    return f"""
WITH t AS (
  SELECT doc_id, 'd' || coalesce(CAST(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4 AS VARCHAR), '0') AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source, (strlen(coalesce(text, '')) + 3) // 4 AS tokens
  FROM {docs}
), leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS leaf_tokens FROM t GROUP BY 1, 2, 3),
cap AS (SELECT *, leaf_tokens * {max_epochs} AS capacity FROM leaf),
total AS (SELECT least(CAST(sum(leaf_tokens) AS BIGINT) * {part[0]} // {part[1]}, CAST(sum(capacity) AS BIGINT)) AS parent_budget FROM cap),
dom0 AS (SELECT domain, CAST(sum(capacity) AS BIGINT) AS capacity, any_value(parent_budget) AS parent_budget FROM cap, total GROUP BY 1),
{_dealt("dom", "dom0", [], "domain", weights["domain"])},
lan0 AS (SELECT c.domain, c.lang, CAST(sum(c.capacity) AS BIGINT) AS capacity, any_value(dom.budget) AS parent_budget
  FROM cap c JOIN dom USING (domain) GROUP BY 1, 2),
{_dealt("lan", "lan0", ["domain"], "lang", weights["lang"])},
src0 AS (SELECT c.domain, c.lang, c.source, c.leaf_tokens, c.capacity, lan.budget AS parent_budget
  FROM cap c JOIN lan USING (domain, lang)),
{_dealt("src", "src0", ["domain", "lang"], "source", weights.get("source", {"": 1}))},
drawn AS (
  SELECT t.*, coalesce(budget // nullif(leaf_tokens, 0), 0) AS epochs, coalesce(budget % nullif(leaf_tokens, 0), 0) AS rest
  FROM t JOIN src USING (domain, lang, source)
), placed AS (SELECT *, md5(concat_ws('|', '{seed}', epochs, doc_id)) AS place FROM drawn),
run AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, tokens, doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_it FROM placed)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(epochs AS BIGINT) AS epochs,
       CAST(greatest(0, least(tokens, rest - before_it)) AS BIGINT) AS tail_tokens
FROM run
"""


ORACLE["op1_mixing"] = mixing_sql(
    "documents", {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "fr": 2, "de": 2, "es": 1}}, 4, 17
)

#: Unsigned crc32 of conv_id's decimal form, bit by bit: -1 stands for a shift, a byte for its xor.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || flatten([[ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
    FOR d IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), 4294967295)"""

ORACLE["op11_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(strlen(role)::VARCHAR || ':' || role || text)) - 1 AS place FROM t
), ids AS (SELECT DISTINCT conv_id FROM t),
h AS (SELECT conv_id, {_CRC32} % 4 AS head, conv_id - conv_id % 20 AS base FROM ids),
r AS (
  SELECT h.conv_id, 0 AS own, n.place, n.role, n.text FROM h JOIN n ON n.conv_id = h.base AND n.place < h.head
  UNION ALL SELECT h.conv_id, 1, n.place, n.role, n.text FROM h JOIN n ON n.conv_id = h.conv_id AND n.place >= h.head
), p AS (
  SELECT ids.conv_id, coalesce(list([r.role, r.text] ORDER BY own, place) FILTER (r.text IS NOT NULL), []) AS path
  FROM ids LEFT JOIN r USING (conv_id) GROUP BY 1
), s AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM p),
node AS (
  SELECT depth, path[:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN len(s.path) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM s GROUP BY 1, 2
), own AS (
  SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(path[depth][2], '[^\x20\x09-\x0D]+')) END AS saved FROM node
), up AS (SELECT depth, path, saved, unnest(range(0, depth + 1)) AS above FROM own),
kids AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
leaf AS (SELECT own.depth, own.path FROM own LEFT JOIN kids USING (path) WHERE n_children IS NULL),
sums AS (
  SELECT up.path[:above] AS path, sum(saved) AS saved_tokens, count(leaf.path) AS n_leaves
  FROM up LEFT JOIN leaf ON leaf.path = up.path GROUP BY 1
)
SELECT own.conv_id, own.depth, parent.conv_id AS parent_conv_id, own.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, own.ends_sha256
FROM own JOIN sums ON sums.path = own.path LEFT JOIN kids ON kids.path = own.path
LEFT JOIN node parent ON own.depth > 0 AND parent.path = own.path[:own.depth - 1]
"""
