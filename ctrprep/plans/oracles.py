"""The same queries as plain SQL over the same tables, to check results against."""

from __future__ import annotations

from collections.abc import Sequence

_RANGE = 1 << 32
_LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_SAMPLED = f"{_LINE_KEY}, l_returnflag, l_linestatus"

_LINE = """line AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS label, l_quantity::BIGINT AS quantity,
         round(l_discount * 100)::BIGINT AS discount, round(l_tax * 100)::BIGINT AS tax
  FROM lineitem)"""
_EVENT = """event AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS label FROM events)"""
_ORDER = """ordered AS (
  SELECT *, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS label, year(o_orderdate) AS order_year
  FROM orders)"""


def _draw(purpose: str, key: str = _LINE_KEY) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '42|{purpose}', {key})), 1, 8))::BIGINT"


def _wins(purpose: str, rate: float, key: str = _LINE_KEY) -> str:
    return f"{_draw(purpose, key)} < {int(rate * _RANGE)}"


def _counts(table: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS name, {c}::VARCHAR AS value, count(*) AS pv FROM {table} GROUP BY {c}"
        for k, c in enumerate(columns)
    )


def _clicks(table: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS name, {c}::VARCHAR AS value, count(*) AS pv, "
        f"sum(CASE WHEN label = '1' THEN 1 ELSE 0 END)::BIGINT AS click FROM {table} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for k, c in enumerate(columns)
    )


def _numbered(counts: str, first: int | str = 1) -> str:
    return f"SELECT *, ({first}) - 1 + row_number() OVER (ORDER BY position, value) AS id FROM ({counts})"


def _top(table: str, n: int) -> str:
    rows = f"(SELECT count(*) FROM {table})"
    return f"{rows} // greatest({rows} // {n}, 1)"


def _index_base(table: str, columns: Sequence[tuple[str, int]]) -> str:
    """The first dictionary id behind exact buckets."""
    start = "0"
    for _, n in columns[:-1]:
        start += f" + greatest({n}, {_top(table, n)} + 1)"
    n = columns[-1][1]
    return f"greatest(1 + {start} + {n}, {start} + {_top(table, n)} + 1)"


def _bucketed(table: str, columns: Sequence[tuple[str, int]], even: bool = False) -> str:
    parts, offset = [], "0"
    for column, n in columns:
        bucket = f"(running - 1) * {n} // total" if even else f"running // greatest(total // {n}, 1)"
        parts.append(
            f"SELECT '{column}' AS name, value, ({bucket} + {offset})::BIGINT AS id, pv FROM ("
            f"SELECT value::VARCHAR AS value, pv, (sum(pv) OVER (ORDER BY value))::BIGINT AS running, "
            f"(sum(pv) OVER ())::BIGINT AS total FROM ("
            f"SELECT {column} AS value, count(*) AS pv FROM {table} GROUP BY {column}))"
        )
        offset += f" + {n}" if even else f" + greatest({n}, {_top(table, n)} + 1)"
    return " UNION ALL ".join(parts)


_INDEXED = ["l_returnflag", "l_linestatus", "l_linenumber"]
_BUCKETED = [("quantity", 7), ("discount", 10)]

_SIDE_MAP = f"""{_LINE},
sold AS (SELECT * FROM line WHERE l_quantity <= 10),
side AS ({_numbered(_clicks("sold", ["l_orderkey", "l_linenumber"]))})"""

_CUT = """cut AS (SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders)"""

# A nation's tree: features and thresholds of node 0 and of its two children.
_NATION = """tree AS (
  SELECT n_nationkey AS k, k % 3 AS f0, k % 8 + 0.5 AS t0, (k + 1) % 3 AS f1, k % 5 + 0.5 AS t1,
         (k + 2) % 3 AS f2, k % 7 + 1.5 AS t2
  FROM nation)"""


def _walk(rows: str, features: Sequence[str], offset: int, trees: str = "TRUE") -> str:
    """``r, k, leaf`` for every row of ``rows`` and tree; leaves are nodes 3 to 6."""

    def value(chosen: str) -> str:
        return f"CASE {chosen} WHEN 0 THEN {features[0]} WHEN 1 THEN {features[1]} ELSE {features[2]} END"

    return f"""SELECT r, k, {offset} + 4 * k + CASE
      WHEN {value("f0")} < t0 THEN CASE WHEN {value("f1")} < t1 THEN 0 ELSE 1 END
      ELSE CASE WHEN {value("f2")} < t2 THEN 2 ELSE 3 END END AS leaf
    FROM {rows}, tree WHERE {trees}"""


def _leaves(features: Sequence[str], offset: int = 1000) -> str:
    return f"""WITH {_LINE}, {_NATION},
rows AS (SELECT *, l_linenumber % 3 AS chosen, row_number() OVER () AS r FROM line),
walked AS ({_walk("rows", features, offset)}),
listed AS (SELECT r, string_agg(leaf::VARCHAR, ',' ORDER BY k) AS leaves FROM walked GROUP BY r)
SELECT {_LINE_KEY}, leaves FROM rows JOIN listed USING (r)"""


def _deeper(levels: int) -> str:
    """One step down the generated trees after the other, from ``step`` to ``depth<levels>``."""
    steps = []
    for k in range(1, levels + 1):
        before = "step" if k == 1 else f"depth{k - 1}"
        limit = "(t * 31 + node * 17) % 50 + 0.5"
        steps.append(
            f"depth{k} AS (SELECT r, t, f, 2 * node + CASE WHEN f[(t + node) % 7 + 1] < {limit} THEN 1 ELSE 2 END AS node FROM {before}),"
        )
    return "\n".join(steps)


_RUN = f"""WITH {_LINE},
extracted AS (
  SELECT {_LINE_KEY}, label, l_linestatus,
         floor(l_extendedprice::FLOAT::DOUBLE * 100)::BIGINT AS l_extendedprice
  FROM line WHERE l_shipdate >= TIMESTAMP '1993-01-01'),
sampled AS (
  SELECT * FROM extracted WHERE l_linenumber = 1 AND {_wins("shrink|0", 0.7)}
  UNION ALL
  SELECT * FROM extracted WHERE l_linenumber = 2 AND {_wins("shrink|1", 0.2)}),
map AS (
  SELECT name, value, id, pv FROM ({_bucketed("sampled", [("l_extendedprice", 700)])})
  UNION ALL
  SELECT name, value, id, pv FROM ({_numbered(_counts("sampled", ["l_linestatus", "l_linenumber"]), _index_base("sampled", [("l_extendedprice", 700)]))}))"""

_TEMPLATE_RUN = f"""WITH {_LINE}, {_NATION},
kept AS (
  SELECT *, CASE WHEN {_wins("noise|supplier_n", 0.1)} THEN 'unknown' ELSE l_suppkey::VARCHAR END AS supplier_n,
         row_number() OVER () AS r
  FROM line
  WHERE CASE l_linenumber WHEN 1 THEN {_wins("shrink", 0.3)} WHEN 2 THEN {_wins("shrink", 0.6)} ELSE TRUE END),
map AS ({_numbered(_counts("kept", ["supplier_n", "l_linenumber"]))}),
walked AS ({_walk("kept", ["quantity", "discount", "tax"], 100000, "k IN (0, 24)")}),
pair AS (
  SELECT r, max(leaf) FILTER (WHERE k = 0) AS leaf0, max(leaf) FILTER (WHERE k = 24) AS leaf24
  FROM walked GROUP BY r),
encoded AS (
  SELECT kept.*, s.id AS supplier_id,
         CASE WHEN {_wins("dropout|line_id", 0.2)} THEN -1 ELSE n.id END AS line_id, leaf0, leaf24
  FROM kept JOIN pair USING (r)
  JOIN map s ON s.name = 'supplier_n' AND s.value = supplier_n
  JOIN map n ON n.name = 'l_linenumber' AND n.value = l_linenumber::VARCHAR
  WHERE {_draw("residue")} % 10 < 5),
doubled AS (SELECT * FROM encoded UNION ALL SELECT * REPLACE ('0' AS label) FROM encoded WHERE label = '1')
SELECT replace(replace(label || ' ' || supplier_id || ':1 ' || line_id || ':1 ' || leaf0 || ':1 ' || leaf24 || ':1',
                       '-1:1 ', ''), '-1:1', '') AS value
FROM doubled"""

ORACLES: dict[str, str] = {
    "q01_extract_typed": """SELECT l_orderkey, l_linenumber, l_returnflag,
  floor(l_extendedprice::FLOAT::DOUBLE * 100)::BIGINT AS l_extendedprice FROM lineitem""",
    "q02_extract_since": """SELECT o_orderkey, o_orderstatus,
  floor(o_totalprice::FLOAT::DOUBLE * 100)::BIGINT AS o_totalprice
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "q02_extract_on": """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderdate = TIMESTAMP '1998-01-15'""",
    "q03_delimited_parse": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "q03_delimited_parse_short": """SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "q04_sample_union": f"""SELECT {_SAMPLED} FROM lineitem WHERE l_returnflag = 'R' AND {_wins("shrink|0", 0.5)}
UNION ALL
SELECT {_SAMPLED} FROM lineitem WHERE l_linestatus = 'O' AND {_wins("shrink|1", 0.3)}""",
    "q05_sample_any": f"""SELECT {_SAMPLED} FROM lineitem
WHERE (l_returnflag = 'R' AND {_wins("shrink|0", 0.5)}) OR (l_linestatus = 'O' AND {_wins("shrink|1", 0.3)})""",
    "q06_sample_keep_unmatched": f"""SELECT {_SAMPLED} FROM lineitem
WHERE CASE l_linenumber WHEN 1 THEN {_wins("shrink", 0.3)} WHEN 2 THEN {_wins("shrink", 0.6)} ELSE TRUE END""",
    "q07_sample_mod10": f"""SELECT event_id, event_type FROM events
WHERE {_draw("residue", "event_id")} % 10 IN (0, 3, 7)""",
    "q08_noise": f"""SELECT event_id, event_type,
  CASE WHEN {_wins("noise|event_type_n", 0.1, "event_id")} THEN 'unknown' ELSE event_type END AS event_type_n
FROM events""",
    "q09_vocab": """SELECT DISTINCT 'l_linestatus' AS name, l_linestatus AS value FROM lineitem
UNION ALL SELECT DISTINCT 'l_linenumber', l_linenumber::VARCHAR FROM lineitem
UNION ALL SELECT DISTINCT 'l_partkey', l_partkey::VARCHAR FROM lineitem""",
    "q09_field_vocab": "SELECT DISTINCT o_custkey::VARCHAR AS value FROM orders",
    "q10_index_numbering": f"""SELECT name, value, id
FROM ({_numbered(_counts("lineitem", [*_INDEXED, "l_partkey"]))})""",
    "q10_value_numbering": f"SELECT value, id FROM ({_numbered(_counts('lineitem', _INDEXED), 0)})",
    "q10_distinct_numbering": """SELECT value, row_number() OVER (ORDER BY value) - 1 AS id
FROM (SELECT DISTINCT o_custkey::VARCHAR AS value FROM orders)""",
    "q11_value_frequency": f"""WITH {_LINE}
SELECT name, value, pv FROM ({_counts("line", ["quantity", "discount"])})""",
    "q12_interval_bucket": f"""WITH {_LINE}
SELECT *, 'exact' AS mode FROM ({_bucketed("line", _BUCKETED)})
UNION ALL SELECT *, 'even' AS mode FROM ({_bucketed("line", _BUCKETED, even=True)})""",
    "q13_feature_map": f"""WITH {_LINE}
SELECT name, value, id, pv FROM ({_bucketed("line", _BUCKETED)})
UNION ALL SELECT name, value, id, pv FROM ({_numbered(_counts("line", _INDEXED), _index_base("line", _BUCKETED))})""",
    "q14_pv_click": f"""WITH {_LINE}
SELECT name, value, pv, click FROM ({_clicks("line", ["l_linestatus", "l_linenumber", "l_suppkey"])})""",
    "q14_pv_click_events": f"""WITH {_EVENT}
SELECT name, value, pv, click FROM ({_clicks("event", ["user_id", "props"])})""",
    "q15_feature_map_stats": f"""WITH {_LINE}
SELECT name, value, id, pv, click FROM ({_numbered(_clicks("line", ["l_linestatus", "l_suppkey"]))})""",
    "q16_dict_encode_inner": f"""WITH {_SIDE_MAP}
SELECT {_LINE_KEY}, o.id AS order_id, n.id AS line_id FROM lineitem
JOIN side o ON o.name = 'l_orderkey' AND o.value = l_orderkey::VARCHAR
JOIN side n ON n.name = 'l_linenumber' AND n.value = l_linenumber::VARCHAR""",
    "q17_dict_lookup_left": f"""WITH {_SIDE_MAP}
SELECT {_LINE_KEY}, o.id AS order_id, n.id AS line_id FROM lineitem
LEFT JOIN side o ON o.name = 'l_orderkey' AND o.value = l_orderkey::VARCHAR
LEFT JOIN side n ON n.name = 'l_linenumber' AND n.value = l_linenumber::VARCHAR""",
    "q18_libsvm": f"""WITH {_ORDER},
map AS ({_numbered(_counts("ordered", ["o_orderpriority", "order_year"]))})
SELECT concat_ws(chr(9), label, p.id || ':1', y.id || ':1') AS value FROM ordered
LEFT JOIN map p ON p.name = 'o_orderpriority' AND p.value = o_orderpriority
LEFT JOIN map y ON y.name = 'order_year' AND y.value = order_year::VARCHAR""",
    "q18_structured_features": f"""WITH {_ORDER},
map AS ({_numbered(_counts("ordered", ["o_orderpriority", "order_year"]))})
SELECT label, 0 AS place, id, 1.0::FLOAT AS value, count(*) AS samples FROM ordered
JOIN map ON name = 'o_orderpriority' AND map.value = o_orderpriority GROUP BY label, id
UNION ALL
SELECT label, 1, id, 1.0::FLOAT, count(*) FROM ordered
JOIN map ON name = 'order_year' AND map.value = order_year::VARCHAR GROUP BY label, id""",
    "q19_template": f"""WITH {_LINE},
map AS ({_numbered(_counts("line", ["l_linestatus", "l_linenumber"]))}),
filled AS (
  SELECT {_LINE_KEY}, replace(replace(replace('${{1}} ${{2}}:1 ${{3}}:1', '${{1}}', label), '${{2}}',
    CASE WHEN {_wins("dropout|l_linestatus_id", 0.2)} THEN '-1' ELSE s.id::VARCHAR END), '${{3}}', n.id::VARCHAR) AS value
  FROM line
  JOIN map s ON s.name = 'l_linestatus' AND s.value = l_linestatus
  JOIN map n ON n.name = 'l_linenumber' AND n.value = l_linenumber::VARCHAR)
SELECT {_LINE_KEY}, regexp_replace(regexp_replace(value, '-1:1 ', '', 'g'), '-1:1', '', 'g') AS value
FROM filled WHERE NOT contains(value, '$')""",
    "q20_duplicate_positive": f"""WITH {_EVENT}
SELECT event_id, user_id, label FROM event
UNION ALL SELECT event_id, user_id, '0' FROM event WHERE label = '1'""",
    "q20_duplicate_positive_lines": f"""WITH {_EVENT}
SELECT concat_ws(' ', label, event_id, user_id) AS value FROM event
UNION ALL SELECT concat_ws(' ', '0', event_id, user_id) FROM event WHERE label = '1'""",
    "q21_recode": f"""SELECT {_LINE_KEY},
  array_to_string(list_transform([l_partkey, l_suppkey, l_linenumber], lambda i: i + 10000), ',') AS ids
FROM lineitem""",
    "q21_recode_lines": f"""WITH {_LINE}
SELECT label || ' ' || (l_partkey + 10000) || ',' || (l_suppkey + 10000) || ' ' || l_orderkey AS value FROM line""",
    "q22_shuffle": f"SELECT {_LINE_KEY}, l_returnflag, l_extendedprice FROM lineitem",
    "q22_shuffle_by_key": "SELECT event_id, user_id, event_type FROM events",
    "q23_leaf_numbering": """WITH node AS (
  SELECT s_suppkey::INTEGER AS tree, s_suppkey % 2 = 0 AS wide, n AS node, s_acctbal
  FROM supplier, range(5) r(n) WHERE n < 3 OR s_suppkey % 2 = 0),
shaped AS (
  SELECT tree, node::INTEGER AS node,
    CASE WHEN node = 0 THEN 1 WHEN node = 2 AND wide THEN 3 ELSE -1 END AS "left",
    CASE WHEN node = 0 THEN 2 WHEN node = 2 AND wide THEN 4 ELSE -1 END AS "right",
    CASE WHEN node = 0 THEN 4 WHEN node = 2 AND wide THEN 6 ELSE -1 END AS feature,
    CASE WHEN node = 0 THEN floor(s_acctbal) WHEN node = 2 AND wide THEN 5.5 ELSE 0 END::FLOAT AS threshold
  FROM node),
leaf AS (
  SELECT tree, node, 999 + row_number() OVER (ORDER BY tree, node) AS leaf_id FROM shaped WHERE "left" = -1)
SELECT tree, node, "left", "right", feature, threshold, leaf_id FROM shaped LEFT JOIN leaf USING (tree, node)""",
    "q24_leaf_encode": _leaves(["quantity", "discount", "tax"]),
    "q24_leaf_columns": f"""WITH {_LINE}, {_NATION},
rows AS (SELECT *, row_number() OVER () AS r FROM line),
walked AS ({_walk("rows", ["quantity", "discount", "tax"], 1000)}),
wide AS (
  SELECT r, {", ".join(f"max(leaf) FILTER (WHERE k = {k}) AS leaf{k}" for k in range(25))}
  FROM walked GROUP BY r)
SELECT {", ".join(f"leaf{k}" for k in range(25))}, count(*) AS rows FROM wide GROUP BY ALL""",
    "q24_leaf_encode_sparse": _leaves([f"(CASE WHEN chosen = {k} THEN 3 ELSE 0 END)" for k in range(3)]),
    "q24_dense_walk": _leaves(["quantity", "discount", "tax"], 1001),
    "q24_sparse_walk": _leaves(["quantity", "discount", "tax"]),
    "q25_sparse_vector": f"""WITH {_LINE}
SELECT {_LINE_KEY}, 0 AS feature, quantity::FLOAT AS value FROM line
UNION ALL SELECT {_LINE_KEY}, 1, discount::FLOAT FROM line""",
    "q25_sparse_fill": f"""WITH {_LINE}
SELECT {_LINE_KEY}, l_linenumber AS feature, 1::FLOAT AS value FROM line
UNION ALL SELECT {_LINE_KEY}, 9, quantity::FLOAT FROM line""",
    "q26_reject_short_rows": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0",
    "q26_reject_counts": """SELECT count(*) AS lines,
  sum(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END)::BIGINT AS rejected FROM orders""",
    "q26_short_row_counts": f"""WITH {_CUT},
labelled AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS label FROM cut)
SELECT name, value, pv, click FROM ({_clicks("labelled", ["o_orderstatus", "o_orderpriority"])})""",
    "q27_partial_join": """SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(c_mktsegment, 'none') AS c_mktsegment,
  coalesce(c_nationkey, -1) AS c_nationkey
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON c_custkey = o_custkey""",
    "q28_feature_cross": f"""WITH crossed AS (
  SELECT l_returnflag || chr(1) || l_linestatus AS l_returnflag_x_l_linestatus,
         l_returnflag || chr(1) || l_linenumber AS l_returnflag_x_l_linenumber,
         l_linestatus || chr(1) || l_linenumber AS l_linestatus_x_l_linenumber
  FROM lineitem)
SELECT name, value, id FROM ({_numbered(_counts("crossed", [
    "l_returnflag_x_l_linestatus", "l_returnflag_x_l_linenumber", "l_linestatus_x_l_linenumber"]))})""",
    "q29_train_valid_split": f"""WITH {_EVENT}
SELECT event_id, label,
  CASE WHEN {_wins("split", 0.2, "event_id")} THEN 'valid' ELSE 'train' END AS split FROM event""",
    "q30_full_run": f"""{_RUN}
SELECT concat_ws(chr(9), label, s.id || ':1', n.id || ':1', p.id || ':1') AS value FROM sampled
JOIN map s ON s.name = 'l_linestatus' AND s.value = l_linestatus
JOIN map n ON n.name = 'l_linenumber' AND n.value = l_linenumber::VARCHAR
JOIN map p ON p.name = 'l_extendedprice' AND p.value = l_extendedprice::VARCHAR""",
    "q30_full_run_map": f"{_RUN} SELECT name, value, id, pv FROM map",
    "q31_template_run": _TEMPLATE_RUN,
    "q17_shuffled_lookup": f"""WITH {_SIDE_MAP}
SELECT {_LINE_KEY}, o.id AS order_id, n.id AS line_id FROM lineitem
LEFT JOIN side o ON o.name = 'l_orderkey' AND o.value = l_orderkey::VARCHAR
LEFT JOIN side n ON n.name = 'l_linenumber' AND n.value = l_linenumber::VARCHAR""",
    "q17_several_dictionaries": f"""WITH {_LINE},
sold AS (SELECT * FROM line WHERE l_quantity <= 10),
side AS ({_numbered(_clicks("sold", ["l_orderkey", "l_partkey", "l_suppkey"]))})
SELECT {_LINE_KEY}, l_extendedprice, o.id AS order_id, p.id AS part_id, s.id AS supplier_id FROM lineitem
LEFT JOIN side o ON o.name = 'l_orderkey' AND o.value = l_orderkey::VARCHAR
LEFT JOIN side p ON p.name = 'l_partkey' AND p.value = l_partkey::VARCHAR
LEFT JOIN side s ON s.name = 'l_suppkey' AND s.value = l_suppkey::VARCHAR""",
    "q27_chained_partials": """
WITH returned AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(o_custkey, c_custkey) AS o_custkey, c_nationkey, coalesce(n, 0) AS returned
FROM orders FULL JOIN customer ON o_custkey = c_custkey LEFT JOIN returned ON l_orderkey = o_orderkey""",
    "q32_map_round_trip": f"""WITH map AS ({_numbered(_counts("orders", ["o_orderpriority"]))})
SELECT o_orderkey, o_orderpriority, id AS priority_id FROM orders JOIN map ON value = o_orderpriority""",
    "q33_model_file": f"""WITH {_LINE},
tree AS (SELECT n_nationkey * 4 + k AS t FROM nation, generate_series(0, 3) AS s(k)),
step0 AS (
  SELECT {_LINE_KEY}, row_number() OVER () AS r,
         [quantity, discount, tax, l_linenumber, l_partkey % 50, l_suppkey % 50, l_orderkey % 50] AS f FROM line),
step AS (SELECT r, t, f, 0 AS node FROM step0, tree),
{_deeper(6)}
listed AS (
  SELECT r, string_agg((1000 + t * 64 + node - 63)::VARCHAR, ',' ORDER BY t) AS leaves FROM depth6 GROUP BY r)
SELECT {_LINE_KEY}, md5(leaves) AS leaves FROM step0 JOIN listed USING (r)""",
    "q34_given_map": f"""WITH {_ORDER},
early AS (SELECT * FROM ordered WHERE order_year < 1998),
map AS ({_numbered(_counts("early", ["o_custkey", "o_orderpriority"]))})
SELECT o_orderkey, c.id AS o_custkey_id, p.id AS o_orderpriority_id FROM ordered
LEFT JOIN map c ON c.name = 'o_custkey' AND c.value = o_custkey::VARCHAR
LEFT JOIN map p ON p.name = 'o_orderpriority' AND p.value = o_orderpriority""",
    "q35_run_statistics": f"""WITH {_ORDER}
SELECT name, value, pv, click FROM ({_clicks("ordered", ["o_custkey", "o_orderpriority"])})""",
    "q36_several_formats": f"""WITH {_ORDER},
map AS ({_numbered(_counts("ordered", ["o_custkey", "o_orderpriority"]))}),
encoded AS (
  SELECT label, o_orderkey, c.id AS c, p.id AS p FROM ordered
  JOIN map c ON c.name = 'o_custkey' AND c.value = o_custkey::VARCHAR
  JOIN map p ON p.name = 'o_orderpriority' AND p.value = o_orderpriority)
SELECT 'ids' AS format, concat_ws(chr(9), label, c || ':1', p || ':1') AS value FROM encoded
UNION ALL SELECT 'pairs', o_orderkey || ' ' || c || ':1' FROM encoded""",
}
ORACLES["q33_model_exchange"] = ORACLES["q33_model_file"]

_EARLY_PRICE = """early AS (SELECT floor(o_totalprice)::BIGINT AS price FROM orders WHERE year(o_orderdate) < 1998)"""


def _nearest(mode: str) -> str:
    """Bounds of the early prices' buckets, and the last one that each order's price reaches."""
    return f"""SELECT o_orderkey, coalesce(arg_max(id, low) FILTER (WHERE low <= price), arg_min(id, low)) AS price_id
FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS price FROM orders),
     (SELECT id, min(value::BIGINT) AS low FROM ({_bucketed("early", [("price", 50)], even=mode == "even")}) GROUP BY id)
GROUP BY o_orderkey"""


_CARRIED = ["o_custkey", "o_orderpriority"]
ORACLES |= {
    "q02_partitions": """SELECT o_orderkey, floor(o_totalprice::FLOAT::DOUBLE * 100)::BIGINT AS o_totalprice, year(o_orderdate) AS dt
FROM orders WHERE year(o_orderdate) >= 1997 OR year(o_orderdate) = 1995""",
    "q34_unseen_numbers": f"WITH {_EARLY_PRICE}\n"
    + "\nUNION ALL ".join(f"SELECT *, '{mode} {way}' AS way FROM ({_nearest(mode)})" for mode in ("exact", "even") for way in ("held", "stored")),
    "q37_carried_map": f"""WITH {_ORDER},
priced AS (SELECT *, floor(o_totalprice / 1000)::BIGINT AS price FROM ordered),
early AS (SELECT * FROM priced WHERE order_year < 1998),
late AS (SELECT * FROM priced WHERE order_year >= 1998),
old AS (
  SELECT name, value, id FROM ({_bucketed("early", [("price", 20)])})
  UNION ALL SELECT name, value, id FROM ({_numbered(_counts("early", _CARRIED), _index_base("early", [("price", 20)]))})),
low AS (SELECT id, min(value::BIGINT) AS low FROM old WHERE name = 'price' GROUP BY id),
first AS ({_clicks("early", [*_CARRIED, "price"])}),
counted AS ({_clicks("late", [*_CARRIED, "price"])}),
merged AS (
  SELECT name, value, o.id, coalesce(f.pv, 0) + coalesce(c.pv, 0) AS pv, coalesce(c.click, 0) AS click
  FROM old o FULL JOIN counted c USING (name, value) LEFT JOIN first f USING (name, value)),
fresh AS (
  SELECT name, value, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY name, value) AS id, pv, click
  FROM merged WHERE id IS NULL AND name <> 'price')
SELECT name, value, id, pv, click FROM merged WHERE id IS NOT NULL
UNION ALL SELECT name, value, id, pv, click FROM fresh
UNION ALL
SELECT 'price', value, coalesce(arg_max(low.id, low) FILTER (WHERE low <= value::BIGINT), arg_min(low.id, low)), any_value(pv), any_value(click)
FROM merged, low WHERE merged.id IS NULL AND name = 'price' GROUP BY value""",
    "q38_committed_run": f"""WITH {_ORDER},
map AS ({_numbered(_counts("ordered", ["o_custkey", "o_orderpriority"]))}),
encoded AS (
  SELECT label, o_orderkey, c.id AS c, p.id AS p FROM ordered
  JOIN map c ON c.name = 'o_custkey' AND c.value = o_custkey::VARCHAR
  JOIN map p ON p.name = 'o_orderpriority' AND p.value = o_orderpriority)
SELECT 'featuremap' AS format, concat_ws(' ', name, value, id) AS value FROM map
UNION ALL SELECT 'statistics', concat_ws(' ', name, value, pv, click) FROM ({_clicks("ordered", ["o_custkey", "o_orderpriority"])})
UNION ALL SELECT 'ids', concat_ws(chr(9), label, c || ':1', p || ':1') FROM encoded
UNION ALL SELECT 'pairs', o_orderkey || ' ' || c || ':1' FROM encoded""",
}

_CROSS_THREE = ["l_partkey", "l_suppkey", "l_linenumber"]
_CROSS_FLAGS = ["l_returnflag", "l_linestatus", "l_linenumber"]


def _pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for k, a in enumerate(columns) for b in columns[k + 1 :]]


def _crossed(table: str, columns: Sequence[str]) -> str:
    parts = ", ".join(f"{a} || chr(1) || {b} AS {a}_x_{b}" for a, b in _pairs(columns))
    return f"SELECT *, {parts} FROM {table}"


def _cross_names(columns: Sequence[str]) -> list[str]:
    return [f"{a}_x_{b}" for a, b in _pairs(columns)]


ORACLES |= {
    "q28_frequent_crossings": f"""WITH {_LINE}, crossed AS ({_crossed("line", _CROSS_THREE)})
SELECT name, value, pv, click FROM ({_clicks("crossed", _cross_names(_CROSS_THREE))}) WHERE pv >= 8""",
    "q28_crossed_map_run": f"""WITH {_LINE}, crossed AS ({_crossed(f"({_crossed('line', _CROSS_FLAGS)})", ["l_partkey", "l_suppkey"])}),
early AS (SELECT * FROM crossed WHERE year(l_shipdate) < 1998),
side AS ({_numbered(_counts("early", _cross_names(_CROSS_FLAGS)))}),
often AS (SELECT * FROM ({_clicks("crossed", ["l_partkey_x_l_suppkey"])}) WHERE pv >= 4),
map AS ({_numbered("SELECT position, name, value, pv FROM often")})
SELECT concat_ws(chr(9), label, {", ".join(f"s{k}.id || ':1'" for k in range(3))}, m.id || ':1') AS value FROM crossed
{" ".join(f"LEFT JOIN side s{k} ON s{k}.name = '{n}' AND s{k}.value = {n}" for k, n in enumerate(_cross_names(_CROSS_FLAGS)))}
LEFT JOIN map m ON m.value = l_partkey_x_l_suppkey
UNION ALL SELECT concat_ws(' ', name, replace(value, chr(1), '/'), pv, click) FROM often""",
}
