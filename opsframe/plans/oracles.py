"""The same questions in plain SQL, for checking against another engine."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# One row per (order, return flag, line status), and one per order.
_MANIFESTS = """
pairs (pair, hazard, rank, place) AS (
  VALUES ('N/F', 'none', 0, 0), ('N/O', 'none', 0, 1), ('A/F', 'none', 0, 2), ('A/O', 'unknown', 1, 3),
    ('R/F', 'radiological', 2, 4), ('R/O', 'biohazard-2', 5, 5)
),
items AS (
  SELECT l_orderkey, coalesce(pair, 'other') AS item, sum(l_quantity) AS tonnes,
    coalesce(any_value(hazard), 'unknown') AS hazard, coalesce(any_value(rank), 1) AS rank,
    coalesce(any_value(place), 6) AS place
  FROM lineitem LEFT JOIN pairs ON pair = l_returnflag || '/' || l_linestatus
  GROUP BY l_orderkey, pair
),
manifests AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS manifest_id,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
      THEN 'expired' ELSE 'current' END AS pilot_certification,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'incomplete_declaration' ELSE '' END AS flags,
    CAST(count(item) AS INTEGER) AS n_items,
    coalesce(sum(tonnes), 0.0) AS tonnes,
    coalesce(string_agg(hazard, ',' ORDER BY place), '') AS hazards,
    coalesce(string_agg(item, ', ' ORDER BY place), '') AS items,
    CAST(coalesce(max(rank), -1) AS INTEGER) AS hazard_rank,
    max_by(item, (rank, item)) AS worst_item,
    max_by(hazard, (rank, item)) AS worst_class
  FROM orders LEFT JOIN items ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, o_orderstatus, o_orderpriority
),
lanes AS (
  SELECT manifest_id,
    CASE WHEN hazard_rank > 1 OR pilot_certification = 'expired' THEN 'quarantine'
      WHEN n_items = 0 OR hazard_rank = 1 OR flags <> '' THEN 'customs_review'
      ELSE 'fast_lane' END AS lane
  FROM manifests
)
"""

ORACLES["s1_load_table"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders
"""
ORACLES["s2_refresh_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}"
    for t in ("region", "nation", "supplier", "customer", "part", "orders")
)
ORACLES["s2_versions"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", 'before' AS version, count(*) AS rows FROM {t} "
    f"UNION ALL SELECT '{t}', 'current', count(*) FROM {t} WHERE {key} >= 10"
    for t, key in (("nation", "n_nationkey"), ("customer", "c_custkey"), ("orders", "o_orderkey"))
)
ORACLES["s3_registered_join"] = """
SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
"""
ORACLES["s1_rejected"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 THEN 'o_custkey' ELSE '' END AS bad_columns,
  CASE WHEN o_orderkey % 97 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'surplus')
    WHEN o_orderkey % 89 = 0 THEN concat_ws(',', o_orderkey, o_custkey) END AS broken
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0
"""
ORACLES["s1_flags"] = """
SELECT c_custkey, CASE WHEN c_acctbal > 100 THEN true WHEN c_acctbal < -100 THEN false END AS active,
  c_acctbal > 0 AND c_acctbal <= 100 AS rejected
FROM customer
"""
ORACLES["s5_large_pieces"] = """
SELECT CAST(sum(length(text) + 1) AS BIGINT) AS n_chars, true AS "full" FROM documents
"""
ORACLES["i3_cargo"] = """
WITH answers AS (
  SELECT o_orderpriority, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'urgent' WHEN contains(o_orderpriority, 'HIGH') THEN 'high'
    WHEN contains(o_orderpriority, 'LOW') THEN 'low' WHEN contains(o_orderpriority, 'MEDIUM') THEN 'medium' ELSE 'other' END AS kind
  FROM orders)
SELECT o_orderpriority, CASE kind WHEN 'urgent' THEN 'fast_lane' WHEN 'other' THEN 'customs_review' END AS lane,
  CASE kind WHEN 'urgent' THEN 'urgent' WHEN 'high' THEN 'risk_score: out of range' WHEN 'low' THEN 'lane: not allowed'
    WHEN 'medium' THEN 'reason: missing'
    ELSE (length('Which lane for ' || o_orderpriority || '?')) || ' characters' END AS reason,
  CASE kind WHEN 'urgent' THEN 0.125::DOUBLE WHEN 'other' THEN 1.0::DOUBLE END AS risk_score, count(*) AS n_orders
FROM answers GROUP BY ALL
"""
ORACLES["s4_list_files"] = """
SELECT DISTINCT 'source=' || source || '/*.parquet' AS path, 1::BIGINT AS n_files FROM documents
"""
ORACLES["s4_hidden_files"] = """
SELECT DISTINCT CASE length(source) % 2 WHEN 0 THEN '_' ELSE '.' END || source AS "at", 1::BIGINT AS n_files, true AS filled
FROM documents
"""
ORACLES["s5_text_files"] = """
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE line <> '' GROUP BY line
"""
ORACLES["s5_text_capped"] = """
SELECT doc_id, CAST(i + 1 AS INTEGER) AS piece, substr(text, i * 4096 + 1, 4096) AS text
FROM (SELECT doc_id, text, unnest(range(greatest(1, (length(text) + 4095) // 4096))) AS i FROM documents)
"""
ORACLES["s6_manifests"] = f"""
WITH {_MANIFESTS}
SELECT manifest_id, pilot_certification, n_items, tonnes, hazards, flags, false AS corrupt
FROM manifests
"""
ORACLES["s7_lane_counts"] = f"WITH {_MANIFESTS} SELECT lane, count(*) AS n FROM lanes GROUP BY lane"
ORACLES["s6_manifest_files"] = """
SELECT n_nationkey AS file, CASE WHEN n_regionkey <> 2 THEN n_name END AS manifest_id,
  CASE WHEN n_regionkey <> 2 AND n > 0 THEN n::DOUBLE END AS tonnes, n_regionkey = 2 AS corrupt
FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON n_nationkey = c_nationkey
"""
ORACLES["s7_read_lane"] = f"""
WITH {_MANIFESTS} SELECT manifest_id, lane FROM lanes WHERE lane = 'customs_review'
"""
ORACLES["s8_pick_one"] = """
SELECT doc_id FROM documents
ORDER BY md5(CAST(doc_id AS VARCHAR) || '7'), CAST(doc_id AS VARCHAR) LIMIT 1
"""

ORACLES["r1_scan"] = "SELECT * FROM nation"
ORACLES["r2_filter_optional"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P'
"""
ORACLES["r2_filter_absent"] = "SELECT o_orderkey, o_orderstatus FROM orders"
_REGION_SUPPLIERS = """
suppliers AS (
  SELECT s.*, n.n_name FROM supplier s LEFT JOIN (
    SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA'
  ) n ON s.s_nationkey = n.n_nationkey
)
"""
ORACLES["r3_count_by_unknown"] = f"""
WITH {_REGION_SUPPLIERS}
SELECT coalesce(n_name, 'unknown') AS n_name, count(*) AS n FROM suppliers GROUP BY 1
"""
ORACLES["r4_top_groups"] = """
SELECT s_nationkey, n FROM (
  SELECT s_nationkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS place
  FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey
) WHERE place = 1
"""
ORACLES["r5_counts_json"] = f"""
WITH {_REGION_SUPPLIERS}, counts AS (
  SELECT coalesce(n_name, 'unknown') AS k, count(*) AS n FROM suppliers WHERE s_acctbal > 0 GROUP BY 1
)
SELECT ('0x' || left(md5(k), 8))::BIGINT % 2 AS bucket,
  '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' AS counts_json
FROM counts GROUP BY 1
"""
ORACLES["r6_topk"] = """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
"""
ORACLES["r7_topk_join"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 3
"""
ORACLES["r7_answer"] = """
SELECT 'Which orders are the largest?' AS question,
  string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS top_routes,
  'largest o_totalprice first' AS rationale
FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, CAST(o_orderkey AS VARCHAR) LIMIT 4)
"""
ORACLES["r8_count_where"] = "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P'"
ORACLES["r9_mean_converted"] = """
SELECT round(avg(o_totalprice) * 24, 2) AS mean_value FROM orders WHERE o_orderstatus = 'O'
"""
ORACLES["r10_qualified_flag"] = """
WITH seen AS (
  SELECT DISTINCT l_suppkey FROM lineitem
  WHERE l_returnflag = 'R' AND l_discount >= 0.1 AND l_tax >= 0.08
), homes AS (
  SELECT s_nationkey, count(*) AS n_places, count(l_suppkey) AS n_evidenced
  FROM supplier LEFT JOIN seen ON s_suppkey = l_suppkey GROUP BY s_nationkey
)
SELECT c_custkey, c_nationkey, c_mktsegment, coalesce(n_places, 0) AS n_places,
  coalesce(n_evidenced, 0) AS n_evidenced, coalesce(n_evidenced, 0) > 0 AS has_evidence
FROM customer LEFT JOIN homes ON c_nationkey = s_nationkey
WHERE c_mktsegment IN ('MACHINERY', 'AUTOMOBILE')
"""
for _name, _exists in (("r10_semi", "EXISTS"), ("r10_anti", "NOT EXISTS")):
    ORACLES[_name] = f"""
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') AND {_exists} (
  SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
"""
ORACLES["r11_reroute"] = """
WITH edges AS (
  SELECT c_nationkey AS o, s_nationkey AS d, sum(l_quantity) AS cost
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY c_nationkey, s_nationkey
), places AS (
  SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
), closed AS (
  SELECT o, d FROM edges
  WHERE o IN (SELECT n_nationkey FROM places WHERE r_name = 'EUROPE')
    AND d IN (SELECT n_nationkey FROM places WHERE r_name = 'ASIA')
), usable AS (
  SELECT * FROM edges WHERE NOT EXISTS (
    SELECT 1 FROM closed WHERE closed.o = edges.o AND closed.d = edges.d)
), options AS (
  SELECT t.o AS origin, t.d AS destination, a.d AS via, a.cost AS cost_1, b.cost AS cost_2,
    a.cost + b.cost AS cost
  FROM closed t JOIN usable a ON a.o = t.o JOIN usable b ON b.o = a.d AND b.d = t.d
  WHERE a.d <> t.d AND a.d <> t.o
)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY origin, destination ORDER BY cost, via) AS INTEGER) AS rank
  FROM options) WHERE rank <= 3
"""
ORACLES["r12_hazard_ranks"] = f"""
WITH {_MANIFESTS} SELECT manifest_id, hazard_rank, worst_item, worst_class FROM manifests
"""
ORACLES["r12_max_hazard"] = f"""
WITH {_MANIFESTS} SELECT manifest_id, hazard_rank, worst_class FROM manifests
ORDER BY hazard_rank DESC, manifest_id LIMIT 1
"""
ORACLES["r13_route_lane"] = f"WITH {_MANIFESTS} SELECT manifest_id, lane FROM lanes"
ORACLES["r14_numbered"] = """
SELECT doc_id, CAST(generate_subscripts(lines, 1) AS INTEGER) AS n, unnest(lines) AS item
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
"""
ORACLES["r14_joined"] = f"WITH {_MANIFESTS} SELECT manifest_id, items FROM manifests"

ORACLES["d1_project_drift"] = """
SELECT p_partkey AS id, p_name AS title, p_brand AS maker, p_type AS kind,
  CAST(p_size AS DOUBLE) AS dimension, p_retailprice * 1000.0::DOUBLE AS price_mils
FROM part
"""
_PART_COLUMNS = (
    ("p_partkey", "CAST(p_partkey AS DOUBLE)", "id", "CAST(p_partkey AS DOUBLE)"),
    ("p_name", "p_name", "title", "p_name"),
    ("p_brand", "p_brand", "maker", "p_brand"),
    ("p_type", "p_type", "kind", "p_type"),
    ("p_size", "CAST(p_size AS DOUBLE)", "dimension", "CAST(p_size AS DOUBLE)"),
    ("p_retailprice", "p_retailprice", "price_mils", "p_retailprice * 1000.0::DOUBLE"),
)
_MATCHES = """
va AS ({}),
vb AS ({}),
na AS (SELECT col_a, count(*) AS n_a FROM va GROUP BY col_a),
nb AS (SELECT col_b, count(*) AS n_b FROM vb GROUP BY col_b),
common AS (
  SELECT col_a, col_b, count(*) AS n_common FROM va JOIN vb ON va.v = vb.v GROUP BY col_a, col_b
),
matches AS (
  SELECT col_a, col_b, n_a, n_b, n_common,
    n_common::DOUBLE / (n_a + n_b - n_common)::DOUBLE AS score
  FROM common JOIN na USING (col_a) JOIN nb USING (col_b)
)
""".format(
    " UNION ALL ".join(
        f"SELECT DISTINCT '{a}' AS col_a, CAST({x} AS VARCHAR) AS v FROM part" for a, x, _, _ in _PART_COLUMNS
    ),
    " UNION ALL ".join(
        f"SELECT DISTINCT '{b}' AS col_b, CAST({y} AS VARCHAR) AS v FROM part" for _, _, b, y in _PART_COLUMNS
    ),
)
ORACLES["d2_match_columns"] = f"""
WITH {_MATCHES}
SELECT col_a, col_b, n_a, n_b, n_common, round(score, 6) AS score FROM matches
"""
ORACLES["d2_match_sketched"] = f"WITH {_MATCHES} SELECT col_a, col_b FROM matches WHERE score >= 0.5"


def _ratio(a: str, b: str, x: str, y: str) -> str:
    """One row of the unit report for columns a and b, given their expressions."""
    r = f"({y}) / ({x})"
    return f"""
SELECT '{a}' AS col_a, '{b}' AS col_b, count(r) AS n_keys, CAST(0 AS BIGINT) AS n_conflicts,
  round(min(r), 6) AS min_ratio, round(max(r), 6) AS max_ratio,
  max(r) - min(r) <= 1e-9 * abs(max(r)) AS constant,
  max(r) - min(r) <= 1e-9 * abs(max(r)) AND abs(max(r) - 1) > 1e-9 AS changed
FROM (SELECT {r} AS r FROM orders WHERE ({x}) <> 0 AND ({y}) <> 0)
"""


ORACLES["d3_unit_drift"] = " UNION ALL ".join(
    (
        _ratio("o_totalprice", "price_mils", "o_totalprice", "o_totalprice * 1000.0::DOUBLE"),
        _ratio("o_custkey", "buyer", "o_custkey::DOUBLE", "o_custkey::DOUBLE"),
        _ratio("o_totalprice", "buyer", "o_totalprice", "o_custkey::DOUBLE"),
    )
)


def _line(a: str, b: str, x: str, y: str) -> str:
    """One row of the report on lines for columns a and b, given their expressions."""
    return f"""
SELECT '{a}' AS col_a, '{b}' AS col_b, n_keys, CAST(0 AS BIGINT) AS n_conflicts,
  CASE WHEN fits THEN round(m, 4) + 0.0::DOUBLE END AS factor, CASE WHEN fits THEN round(o, 4) + 0.0::DOUBLE END AS "offset",
  fits AS constant, fits AND (abs(m - 1) > 1e-9 OR abs(o) > 1e-9 * size) AS changed
FROM (
  SELECT *, n_keys > 2 AND r2 >= 1 - 1e-10 AS fits FROM (
    SELECT count(*) AS n_keys, regr_slope({y}, {x}) AS m, regr_intercept({y}, {x}) AS o, regr_r2({y}, {x}) AS r2,
      max(abs({y})) AS size
    FROM orders))
"""


ORACLES["d3_affine"] = " UNION ALL ".join(
    (
        _line("o_totalprice", "price_f", "o_totalprice", "o_totalprice * 1.8::DOUBLE + 32.0::DOUBLE"),
        _line("o_totalprice", "left_over", "o_totalprice", "100.0::DOUBLE - o_totalprice / 4.0::DOUBLE"),
        _line("o_totalprice", "price", "o_totalprice", "o_totalprice"),
        _line("o_totalprice", "buyer", "o_totalprice", "o_custkey::DOUBLE"),
        _line("o_custkey", "buyer", "o_custkey::DOUBLE", "o_custkey::DOUBLE"),
    )
)
_HEAT = "((p_partkey * 37 % 101)::DOUBLE / 8.0::DOUBLE - 40.0::DOUBLE)"
_OLD_PARTS = f"SELECT *, p_partkey % 7 AS p_group, 'note ' || p_partkey AS p_note, {_HEAT} AS p_celsius FROM part"
_NEW_PARTS = f"""
  SELECT p_partkey AS id, p_name AS title, p_brand AS maker, p_type AS kind, p_size::DOUBLE AS dimension,
    p_retailprice * 1000.0::DOUBLE AS price_mils, (p_partkey % 7)::VARCHAR AS p_group, 'new ' || p_partkey AS added,
    {_HEAT} * 1.8::DOUBLE + 32.0::DOUBLE AS fahrenheit FROM part"""
# DuckDB's names of column types as Spark writes them.
_SPARK_TYPE = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"
_FINDINGS = f"""
{_MATCHES},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY col_a ORDER BY score DESC, col_b) AS rank_a,
    row_number() OVER (PARTITION BY col_b ORDER BY score DESC, col_a) AS rank_b
  FROM matches WHERE score >= 0.5
),
ratio AS (
  SELECT min(r) AS lo, max(r) AS hi FROM (
    SELECT p_retailprice * 1000.0::DOUBLE / p_retailprice AS r FROM part WHERE p_retailprice <> 0)
),
line AS (
  SELECT regr_slope(f, c) AS m, regr_intercept(f, c) AS o, regr_r2(f, c) AS r2
  FROM (SELECT {_HEAT} AS c, {_HEAT} * 1.8::DOUBLE + 32.0::DOUBLE AS f FROM part)
),
old_columns AS (SELECT column_name AS name, {_SPARK_TYPE} AS type FROM (DESCRIBE {_OLD_PARTS})),
new_columns AS (SELECT column_name AS name, {_SPARK_TYPE} AS type FROM (DESCRIBE {_NEW_PARTS})),
mapped AS (
  SELECT 'renamed' AS kind, col_a, col_b, printf('overlap %.4f', score) AS detail,
    'map ' || col_a || ' to ' || col_b AS action
  FROM ranked WHERE rank_a = 1 AND rank_b = 1
  UNION ALL
  SELECT 'unit_changed', 'p_retailprice', 'price_mils', printf('factor %.6f', (lo + hi) / 2),
    printf('multiply p_retailprice by %.6f into price_mils', (lo + hi) / 2)
  FROM ratio WHERE hi - lo <= 1e-9 * abs(hi) AND abs(hi - 1) > 1e-9
  UNION ALL
  SELECT 'unit_changed', 'p_celsius', 'fahrenheit', printf('factor %.6f offset %.6f', m, o),
    printf('multiply p_celsius by %.6f and add %.6f into fahrenheit', m, o)
  FROM line WHERE r2 >= 1 - 1e-10
),
findings AS (
  SELECT * FROM mapped
  UNION ALL
  SELECT 'type_changed', name, name, o.type || ' to ' || n.type, 'cast ' || name || ' from ' || o.type || ' to ' || n.type
  FROM old_columns o JOIN new_columns n USING (name) WHERE o.type <> n.type
  UNION ALL
  SELECT 'type_changed', col_a, col_b, o.type || ' to ' || n.type,
    'cast ' || col_a || ' from ' || o.type || ' to ' || n.type || ' into ' || col_b
  FROM mapped JOIN old_columns o ON o.name = col_a JOIN new_columns n ON n.name = col_b WHERE o.type <> n.type
  UNION ALL
  SELECT 'missing', name, NULL, 'no counterpart found', 'add ' || name || ' to the target'
  FROM old_columns WHERE name NOT IN (SELECT name FROM new_columns) AND name NOT IN (SELECT col_a FROM mapped)
  UNION ALL
  SELECT 'extra', NULL, name, 'no counterpart found', 'give ' || name || ' a default'
  FROM new_columns WHERE name NOT IN (SELECT name FROM old_columns) AND name NOT IN (SELECT col_b FROM mapped)
)
"""
ORACLES["d4_findings"] = f"WITH {_FINDINGS} SELECT kind, col_a, col_b, detail, action FROM findings"
ORACLES["d4_findings_sketched"] = f"WITH {_FINDINGS} SELECT kind, col_a, col_b FROM findings"
ORACLES["d2_estimates_close"] = f"""
WITH {_MATCHES} SELECT col_a, col_b, true AS n_a_close, true AS n_b_close, true AS n_common_close
FROM matches WHERE score >= 0.5
"""
ORACLES["d4_compat"] = f"""
WITH {_FINDINGS}, lines AS (
  SELECT kind || ' ' || concat_ws(' -> ', col_a, col_b) || ' (' || detail || ')' AS mismatch, action FROM findings
)
SELECT count(*) = 0 AS compatible, string_agg(mismatch, '; ' ORDER BY mismatch) AS mismatches,
  string_agg(action, '; ' ORDER BY action) AS suggested_actions
FROM lines
"""
ORACLES["d5_diff_keyed"] = """
WITH b AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -1 - c_custkey ELSE c_custkey END AS c_custkey,
    c_name, c_nationkey, greatest(c_acctbal, 0.0::DOUBLE) AS c_acctbal, c_mktsegment
  FROM customer
)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
  CASE WHEN b.c_custkey IS NULL THEN 'removed' WHEN a.c_custkey IS NULL THEN 'added'
    WHEN a.c_acctbal <> b.c_acctbal THEN 'changed' ELSE 'copies' END AS status,
  CASE WHEN a.c_acctbal <> b.c_acctbal THEN 'c_acctbal' ELSE '' END AS changed_columns
FROM customer a FULL OUTER JOIN b ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_acctbal <> b.c_acctbal
  OR a.c_mktsegment = 'BUILDING'
"""
ORACLES["d5_diff_digests"] = ORACLES["d5_diff_keyed"]
ORACLES["d5_except_all"] = """
SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n_left,
  CAST(CASE o_orderstatus WHEN 'P' THEN 0 ELSE 2 * count(*) END AS BIGINT) AS n_right
FROM orders WHERE o_orderstatus <> 'O'
GROUP BY o_custkey, o_orderstatus, o_orderpriority
"""


def _profile(table: str, columns: tuple[tuple[str, str], ...], distinct: bool) -> str:
    extra = "count(DISTINCT {0}) AS n_distinct, " if distinct else ""
    zero = {"double": " + 0.0::DOUBLE"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        f"{extra.format(c)}CAST(min({c}){zero.get(t, '')} AS VARCHAR) AS min_value, "
        f"CAST(max({c}){zero.get(t, '')} AS VARCHAR) AS max_value "
        f"FROM {table}"
        for c, t in columns
    )


ORACLES["d6_estimates_close"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, true AS close FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
)
ORACLES["d6_profile"] = _profile(
    "orders",
    (
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "double"),
        ("o_orderdate", "timestamp_ntz"),
        ("o_orderpriority", "string"),
    ),
    True,
)
ORACLES["d6_profile_estimated"] = _profile(
    "lineitem",
    (
        ("l_orderkey", "bigint"),
        ("l_partkey", "bigint"),
        ("l_suppkey", "bigint"),
        ("l_linenumber", "int"),
        ("l_quantity", "double"),
        ("l_extendedprice", "double"),
        ("l_discount", "double"),
        ("l_tax", "double"),
        ("l_returnflag", "string"),
        ("l_linestatus", "string"),
        ("l_shipdate", "timestamp_ntz"),
    ),
    False,
)

_ANSWERS = """
answers AS (
  SELECT doc_id, text, length(text) || ' characters' AS summary,
    CASE WHEN contains(text, '@') THEN 'critical' WHEN contains(text, '***') THEN 'high'
      WHEN contains(text, 'Apache') THEN NULL WHEN contains(text, 'MIT') THEN 'unclear'
      WHEN contains(text, 'GNU') THEN 'medium' ELSE 'low' END AS severity
  FROM documents
),
described AS (
  SELECT *,
    CASE severity WHEN 'critical' THEN 'contact,privacy' WHEN 'high' THEN 'encoding'
      WHEN 'unclear' THEN 'licence' WHEN 'medium' THEN 'licence' WHEN 'low' THEN '' END AS systems,
    CASE severity WHEN 'critical' THEN 'remove the address' WHEN 'high' THEN 'clean the text'
      WHEN 'unclear' THEN 'ask' WHEN 'medium' THEN 'keep the notice' WHEN 'low' THEN 'none' END AS action
  FROM answers
),
responses AS (
  SELECT *, CASE WHEN severity IS NULL THEN 'not a record' ELSE
    '{"severity": "' || severity || '", "summary": "' || summary || '", "affected_systems": ['
    || CASE systems WHEN '' THEN '' ELSE '"' || replace(systems, ',', '", "') || '"' END
    || '], "recommended_action": "' || action || '"}' END AS response
  FROM described
)
"""
ORACLES["i1_prompts"] = """
SELECT doc_id, 'Grade this report from ' || source || '.' || chr(10) || chr(10) || text AS prompt FROM documents
"""
ORACLES["i1_record_prompts"] = """
SELECT n_nationkey, 'Plan for: {"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name
  || '","n_regionkey":' || n_regionkey || '}' AS prompt
FROM nation
"""
ORACLES["i2_infer"] = f"""
WITH {_ANSWERS}
SELECT doc_id, severity, CASE WHEN severity IS NOT NULL THEN summary END AS summary, systems, action
FROM responses
"""
ORACLES["i2_mission_steps"] = """
SELECT n_nationkey, CAST(generate_subscripts(steps, 1) AS INTEGER) AS n, unnest(steps) AS step FROM (
  SELECT n_nationkey, CASE WHEN contains(n_name, 'NATION_1') THEN ['load', 'fly', 'unload'] ELSE ['wait'] END AS steps
  FROM nation WHERE contains(n_name, 'NATION_1') OR NOT contains(n_name, 'NATION_2'))
"""
_FILE_PROMPT = "(length('List each distinct anomaly of this file.') + 2 + length(text))"
ORACLES["i3_file_findings"] = f"""
WITH graded AS (
  SELECT doc_id, text, CASE WHEN contains(text, '@') THEN 'address' WHEN contains(text, '***') THEN 'noise'
    WHEN contains(text, 'Licen') THEN 'licence' ELSE 'clean' END AS title FROM documents
)
SELECT doc_id, title, 'stars' AS anomaly_type, 0.5::DOUBLE AS confidence,
  CAST({_FILE_PROMPT} AS VARCHAR) AS notes FROM graded WHERE title = 'noise'
UNION ALL SELECT doc_id, title, 'noise', 0.25::DOUBLE, 'n' FROM graded WHERE title = 'noise'
UNION ALL SELECT doc_id, title, 'licence', 1.0::DOUBLE, 'n' FROM graded WHERE title = 'licence'
"""
ORACLES["i4_manifest_lanes"] = f"""
WITH {_MANIFESTS}, chosen AS (
  SELECT manifest_id, CASE WHEN contains(hazards, 'biohazard') THEN 'quarantine'
    WHEN contains(hazards, 'radiological') THEN 'isolation'
    WHEN contains(hazards, 'unknown') THEN 'customs_review' ELSE 'fast_lane' END AS response
  FROM manifests
)
SELECT manifest_id, response, CASE WHEN response <> 'isolation' THEN response END AS label,
  response <> 'isolation' AS accepted
FROM chosen
"""
ORACLES["i3_valid"] = f"""
WITH {_ANSWERS} SELECT doc_id, severity, summary FROM responses
WHERE severity IN ('low', 'medium', 'high', 'critical')
"""
ORACLES["i3_rejected"] = f"""
WITH {_ANSWERS} SELECT doc_id, CASE WHEN severity IS NULL THEN 'severity: missing; summary: missing; '
  || 'affected_systems: missing; recommended_action: missing' ELSE 'severity: not allowed' END AS reasons, response
FROM responses WHERE severity IS NULL OR severity = 'unclear'
"""
ORACLES["i4_label"] = """
SELECT doc_id, response, CASE WHEN response <> 'no idea' THEN response END AS label,
  response <> 'no idea' AS accepted
FROM (
  SELECT doc_id, CASE WHEN contains(text, '@') THEN 'no idea' WHEN contains(text, '***') THEN 'quarantine'
    WHEN contains(text, 'Licen') THEN 'customs_review' ELSE 'fast_lane' END AS response
  FROM documents)
"""
_RULES = (
    ("address", "[A-Za-z0-9._]+@[A-Za-z0-9.]+", 0.9),
    ("licence", "Licen[sc]ed? under [^\n]*|under the [A-Za-z ]*Licen[sc]e", 0.8),
    ("noise", "[*%#$&]{3}", 0.6),
    ("long_number", "[0-9]{3}[0-9-]*", 0.5),
)
ORACLES["i5_findings"] = " UNION ".join(
    f"SELECT doc_id, '{kind}' AS anomaly_type, {confidence}::DOUBLE AS confidence, "
    f"unnest(regexp_extract_all(text, '{pattern}', 0)) AS notes FROM documents"
    for kind, pattern, confidence in _RULES
)
ORACLES["i5_finding_lines"] = f"""
SELECT doc_id, anomaly_type || printf(' (confidence=%.2f): ', confidence) || notes AS line
FROM ({ORACLES["i5_findings"]})
"""
ORACLES["i6_escalate"] = f"""
WITH {_ANSWERS} SELECT doc_id, severity FROM responses WHERE severity IN ('high', 'critical')
"""
ORACLES["i7_cached"] = f"WITH {_ANSWERS} SELECT doc_id, response, severity FROM responses"
ORACLES["i7_bucketed"] = ORACLES["i7_cached"]
ORACLES["i2_retried"] = f"""
WITH {_ANSWERS}
SELECT doc_id,
  CASE WHEN contains(text, '@') THEN 'given up' WHEN severity IS NULL OR severity = 'unclear' THEN 'rejected'
    ELSE 'valid' END AS outcome,
  CASE WHEN contains(text, '@') THEN 'RuntimeError: addresses are not allowed'
    WHEN severity IS NULL THEN 'severity: missing; summary: missing; affected_systems: missing; recommended_action: missing'
    WHEN severity = 'unclear' THEN 'severity: not allowed' ELSE severity END AS detail,
  CASE WHEN contains(text, '@') THEN 2 ELSE 1 END AS attempt
FROM responses
"""
ORACLES["i2_telemetry"] = """
SELECT event_id, CASE WHEN k LIKE '9%' THEN 'a' ELSE 'c' END AS grade,
  CASE WHEN k LIKE '9%' THEN 'near' ELSE 'far' END AS headline,
  CASE WHEN k LIKE '9%' THEN '' ELSE 'w,x' END AS watch_items,
  CAST(length('Report on a craft at latitude ' || k || ', longitude ' || v || '.') AS VARCHAR) AS asked
FROM (SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(value AS VARCHAR) AS v FROM events)
WHERE k NOT LIKE '1%' AND k NOT LIKE '2%'
"""
ORACLES["i8_parse"] = """
SELECT event_id, latitude, longitude,
  'latitude ' || latitude || ', longitude ' || longitude AS position_line
FROM (
  SELECT event_id, json_extract_string(props, '$.k') AS latitude, CAST(value AS VARCHAR) AS longitude
  FROM events)
"""

ORACLES["f1_scalars"] = """
SELECT event_id, json_extract_string(props, '$.k') AS stripped,
  CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 AS doubled, printf('%.2f', value) AS shown,
  CAST(NULL AS BIGINT) AS unreadable
FROM events
"""
ORACLES["g1_guarded"] = """
SELECT c_mktsegment, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, count(*) AS n_orders,
  max(o_totalprice) AS highest_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""


def _states(max_iterations: int) -> str:
    return f"""
opened AS (SELECT user_id, min(ts) AS opened_at, min(ts) + INTERVAL 12 HOUR AS deadline FROM events GROUP BY user_id),
steps AS (
  SELECT e.user_id, ts, event_id, event_type, opened_at, deadline,
    sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)
      OVER (PARTITION BY e.user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS clicks
  FROM events e JOIN opened o ON e.user_id = o.user_id WHERE ts <= deadline
),
ends AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM steps
  WHERE event_type IN ('purchase', 'error') OR (event_type = 'click' AND clicks > {max_iterations})
),
states AS (
  SELECT o.user_id AS item,
    CASE e.event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected'
      WHEN 'click' THEN 'exhausted'
      ELSE CASE WHEN o.deadline < TIMESTAMP '2024-02-01' THEN 'timed_out' ELSE 'pending' END END AS state,
    coalesce(e.ts, CASE WHEN o.deadline < TIMESTAMP '2024-02-01' THEN o.deadline END) AS decided_at,
    o.opened_at
  FROM opened o LEFT JOIN (SELECT * FROM ends WHERE place = 1) e ON o.user_id = e.user_id
)
"""


for _name, _limit in (("g2_review_state", 3), ("g2_review_state_strict", 1)):
    ORACLES[_name] = f"""
WITH {_states(_limit)}
SELECT item, state, strftime(decided_at, '%Y-%m-%d %H:%M:%S.%f') AS decided_at,
  strftime(opened_at, '%Y-%m-%d %H:%M:%S.%f') AS opened_at
FROM states
"""
ORACLES["g3_approved"] = f"""
WITH {_states(3)}
SELECT event_id, user_id, event_type FROM events
WHERE user_id IN (SELECT item FROM states WHERE state = 'approved')
"""
ORACLES["g4_observed"] = """
SELECT count(*) AS n_rows, sum(l_quantity) AS quantity,
  count(*) FILTER (WHERE l_returnflag = 'R') AS returned
FROM lineitem
"""
