"""The queries as DuckDB SQL over the same tables. Queries without an entry have no SQL form."""

from __future__ import annotations

_DIRTY_ORDERS = """
broken AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL
         WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN ' '
         WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN ''
         ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'NaN'::DOUBLE
         ELSE o_totalprice END AS o_totalprice,
    o_orderpriority
  FROM orders),
dirty AS (SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE o_orderpriority = '1-URGENT')"""

_COMPLETE = "o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)"
_FILLED = "o_orderstatus NOT IN ('', ' ') AND o_orderpriority NOT IN ('', ' ')"
_SILVER = f"{_DIRTY_ORDERS},\nsilver AS (SELECT DISTINCT * FROM dirty WHERE {_COMPLETE} AND {_FILLED})"
_GOLD = f"""{_SILVER},
gold AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
    o_totalprice + o_custkey::DOUBLE AS composite, o_totalprice
  FROM silver)"""
_LAYER_COUNTS = f"""WITH {_GOLD}
SELECT 'bronze' AS layer, count(*) AS row_count FROM dirty
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM gold"""

_RULES = {
    "status is not null": "o_orderstatus IS NOT NULL",
    "status is not blank": "o_orderstatus != ' '",
    "status is not empty": "o_orderstatus != ''",
    "status is known": "o_orderstatus IN ('F', 'O', 'P')",
}


def _violations(source: str, action: str, null_passes: bool = False, label: str = "") -> str:
    default = "TRUE" if null_passes else "FALSE"
    return "\nUNION ALL ".join(
        f"SELECT {label}'{name}' AS rule, '{action}' AS action, count(*) AS total_rows, "
        f"count(*) FILTER (NOT coalesce({predicate}, {default})) AS violations, "
        f"count(*) FILTER (NOT coalesce({predicate}, {default})) = 0 AS passed FROM {source}"
        for name, predicate in _RULES.items()
    )


_ORDER_ROWS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
_REPRICED = """
urgent AS (
  SELECT o_orderkey, o_custkey, o_totalprice + 100 AS o_totalprice, o_orderstatus
  FROM orders WHERE o_orderpriority = '1-URGENT'),
updates AS (
  SELECT * FROM urgent
  UNION ALL SELECT o_orderkey, o_custkey + 1000000000, o_totalprice, o_orderstatus FROM urgent
  WHERE o_orderstatus = 'F')"""

_LATEST_EVENTS = """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS place FROM events)
WHERE place = 1"""

_LANDED = """
landed AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, (year(o_orderdate) - 1994)::BIGINT AS ingest_version
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice + 100, o_orderpriority, (year(o_orderdate) - 1987)::BIGINT
  FROM orders WHERE o_orderpriority = '1-URGENT')"""
_INGESTED = f"""WITH {_LANDED}
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, ingest_version FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey, o_custkey ORDER BY ingest_version DESC) AS place FROM landed)
WHERE place = 1"""


def _uniform(*keys: str) -> str:
    text = f"concat_ws('|', {', '.join(keys)})" if len(keys) > 1 else f"{keys[0]}::VARCHAR"
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0)"


def _split(*keys: str) -> str:
    drawn = _uniform(*keys)
    return f"CASE WHEN {drawn} < 0.6 THEN 'train' WHEN {drawn} < 0.8 THEN 'validation' ELSE 'test' END"


_LINE_KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
_SEGMENTS = "avg(l_extendedprice) OVER (PARTITION BY l_quantity) AS prediction"

_DAILY = f"""{_DIRTY_ORDERS},
daily AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, ' ') AS o_orderstatus, o_orderpriority FROM dirty),
training AS (
  SELECT * FROM orders WHERE o_orderpriority != '4-NOT SPECIFIED' AND o_orderstatus != 'P'),
scored AS (
  SELECT * FROM daily
  WHERE o_orderstatus IN (SELECT o_orderstatus FROM training)
    AND o_orderpriority IN (SELECT o_orderpriority FROM training))"""
_UNSEEN = f"WITH {_DAILY}\nSELECT * FROM daily EXCEPT SELECT * FROM scored"

_NUMERIC = {
    "lineitem": (
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "l_shipdate < TIMESTAMP '1998-07-01'",
    ),
    "events": (["value"], "ts < TIMESTAMP '2024-01-16'"),
}
_CATEGORICAL = {
    "lineitem": (["l_returnflag", "l_linestatus"], _NUMERIC["lineitem"][1]),
    "events": (["event_type"], _NUMERIC["events"][1]),
}


def _long(kinds: dict[str, tuple[list[str], str]]) -> str:
    """(col, value, ref) over all columns of all tables."""
    return " UNION ALL ".join(
        f"SELECT '{column}' AS col, {column} AS value, ({early}) AS ref FROM {table}"
        for table, (columns, early) in kinds.items()
        for column in columns
    )


def _numeric(kinds: dict[str, tuple[list[str], str]]) -> str:
    """CTEs ending in numeric_stats(col, n, m, ks, w, normed)."""
    return f"""
num AS ({_long(kinds)}),
num_counts AS (
  SELECT col, value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM num
  WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL),
num_running AS (
  SELECT col, value,
    sum(r) OVER run / sum(r) OVER everything AS f_ref, sum(c) OVER run / sum(c) OVER everything AS f_cur,
    lead(value) OVER run AS following,
    sum(r) OVER everything AS n, sum(c) OVER everything AS m, r
  FROM num_counts
  WINDOW run AS (PARTITION BY col ORDER BY value), everything AS (PARTITION BY col)),
num_spread AS (SELECT col, stddev_pop(value) AS sd FROM num WHERE ref GROUP BY col),
numeric_stats AS (
  SELECT col, any_value(n) AS n, any_value(m) AS m, count(*) FILTER (r > 0) AS ref_values,
    max(abs(f_ref - f_cur)) AS ks,
    sum(abs(f_ref - f_cur) * (following - value)) AS w,
    sum(abs(f_ref - f_cur) * (following - value)) / greatest(any_value(sd), 0.001) AS normed
  FROM num_running JOIN num_spread USING (col) GROUP BY col)"""


def _categorical(kinds: dict[str, tuple[list[str], str]]) -> str:
    """CTEs ending in category_stats(col, js, chi2, all_values)."""
    return f"""
cat AS ({_long(kinds)}),
cat_counts AS (
  SELECT col, value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM cat
  WHERE value IS NOT NULL GROUP BY ALL),
cat_shares AS (
  SELECT *, sum(r) OVER (PARTITION BY col) AS n, sum(c) OVER (PARTITION BY col) AS m,
    r / sum(r) OVER (PARTITION BY col) AS p, c / sum(c) OVER (PARTITION BY col) AS q
  FROM cat_counts),
category_stats AS (
  SELECT col, any_value(n) AS n, any_value(m) AS m, count(*) AS all_values,
    sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js,
    sum(pow(r - n * (r + c) / (n + m), 2) / (n * (r + c) / (n + m))
      + pow(c - m * (r + c) / (n + m), 2) / (m * (r + c) / (n + m))) AS chi2
  FROM cat_shares GROUP BY col)"""


_LINES_NUMERIC = {"lineitem": _NUMERIC["lineitem"]}
_LINES_CATEGORICAL = {"lineitem": _CATEGORICAL["lineitem"]}
_LINE_REPORT = f"""{_numeric(_LINES_NUMERIC)},{_categorical(_LINES_CATEGORICAL)},
report AS (
  SELECT '2024-01-31' AS "date", col AS "column", 'numeric' AS kind, 'wasserstein normed' AS method,
    normed AS statistic, CAST(0.1 AS DOUBLE) AS threshold, normed >= 0.1 AS drifted FROM numeric_stats
  UNION ALL
  SELECT '2024-01-31', col, 'categorical', 'jensen-shannon', js, 0.1, js >= 0.1 FROM category_stats)"""
_DATA_FLAG = """
data_flag AS (
  SELECT "date", avg(drifted::INT) >= 0.5 AS drift_detected FROM report GROUP BY "date")"""
_TARGET_FLAG = """
current_lines AS (SELECT * FROM lineitem WHERE NOT l_shipdate < TIMESTAMP '1998-07-01'),
target AS (
  SELECT l_extendedprice AS value, TRUE AS ref FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-07-01'
  UNION ALL
  SELECT avg(l_extendedprice) OVER (PARTITION BY l_quantity), FALSE FROM current_lines),
target_counts AS (
  SELECT value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM target GROUP BY value),
target_running AS (
  SELECT value, lead(value) OVER run AS following,
    sum(r) OVER run / sum(r) OVER () AS f_ref, sum(c) OVER run / sum(c) OVER () AS f_cur
  FROM target_counts WINDOW run AS (ORDER BY value)),
target_flag AS (
  SELECT '2024-01-31' AS "date",
    (SELECT sum(abs(f_ref - f_cur) * (following - value)) FROM target_running)
      / (SELECT greatest(stddev_pop(value), 0.001) FROM target WHERE ref) >= 0.1 AS model_drift_detected)"""

# The account balance has more than five values (KS), the region at most five (chi-square, four degrees of
# freedom: exp(-x/2) (1 + x/2)).
_SMALL = f"""WITH accounts AS (
  SELECT s_acctbal AS acctbal, n_regionkey AS regionkey, TRUE AS early
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT c_acctbal, n_regionkey, FALSE FROM customer JOIN nation ON c_nationkey = n_nationkey),
{_numeric({"accounts": (["acctbal"], "early")})},
{_categorical({"accounts": (["regionkey"], "early")})},
scaled AS (SELECT col, ks * sqrt(n * m / (n + m)) AS x FROM numeric_stats),
verdicts AS (
  SELECT col, 'ks p-value' AS method,
    CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum([
      CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x) FOR k IN range(1, 101)]))) END AS p
  FROM scaled
  UNION ALL
  SELECT col, 'chi-square p-value', exp(-chi2 / 2) * (1 + chi2 / 2) FROM category_stats)
SELECT '2024-01-31' AS "date", col AS "column", 'numeric' AS kind, method, round(p, 6) AS statistic,
  CAST(0.05 AS DOUBLE) AS threshold, p < 0.05 AS drifted FROM verdicts"""

_GOLD_BRONZE = f"WITH {_DIRTY_ORDERS} SELECT * FROM dirty"
_SILVER_ROWS = "SELECT DISTINCT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM merged"

_UPSERTED = f"""WITH {_REPRICED}
SELECT t.o_orderkey, t.o_custkey, coalesce(u.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
  coalesce(u.o_totalprice, t.o_totalprice) AS o_totalprice, t.o_orderpriority
FROM orders t LEFT JOIN updates u USING (o_orderkey, o_custkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL FROM updates u
WHERE NOT EXISTS (FROM orders t WHERE t.o_orderkey = u.o_orderkey AND t.o_custkey = u.o_custkey)"""

_REPORTED = f"""WITH {_LINE_REPORT}
SELECT "date", "column", kind, method, round(statistic, 6) AS statistic, threshold, drifted FROM report"""

_TURNS = """
WITH e AS (SELECT event_type AS t, CAST(ts AS DATE) AS d, ts < TIMESTAMP '2024-01-16' AS early FROM events),
days AS (SELECT unnest([DATE '2024-01-18', DATE '2024-01-19', DATE '2024-01-21', DATE '2024-01-23', DATE '2024-01-25']) AS d),
r AS (SELECT t, count(*) AS n FROM e WHERE early GROUP BY t),
c AS (SELECT d, t, count(*) AS n FROM e JOIN days USING (d) GROUP BY d, t),
cells AS (
  SELECT days.d, k.t, coalesce(r.n, 0) / sum(coalesce(r.n, 0)) OVER (PARTITION BY days.d) AS p,
    coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY days.d) AS q
  FROM days CROSS JOIN (SELECT DISTINCT t FROM e) k LEFT JOIN r ON r.t = k.t LEFT JOIN c ON c.t = k.t AND c.d = days.d),
flags AS (
  SELECT d, sqrt(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2) >= 0.045 AS is_on
  FROM cells GROUP BY d),
turns AS (SELECT *, lag(is_on, 1, false) OVER (ORDER BY d) AS was_on FROM flags)
SELECT CAST(d AS VARCHAR) AS "date", 'drift_detected' AS alert FROM turns WHERE is_on AND NOT was_on"""

ORACLES: dict[str, str] = {
    "medallion_flagship": f"WITH {_GOLD} SELECT * FROM gold",
    "medallion_tables": _LAYER_COUNTS,
    "silver_clean": f"WITH {_SILVER} SELECT * FROM silver",
    "drop_incomplete_rows": f"WITH {_DIRTY_ORDERS} SELECT * FROM dirty WHERE {_COMPLETE}",
    "drop_blank_rows": f"WITH {_DIRTY_ORDERS} SELECT o_orderkey, o_orderstatus, o_orderpriority FROM dirty WHERE {_FILLED}",
    "distinct_without_lineage": f"""
SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS delivery FROM ({_ORDER_ROWS})""",
    "nullify_blank": f"""WITH {_DIRTY_ORDERS}
SELECT o_orderkey, nullif(o_orderstatus, ' ') AS o_orderstatus, o_orderpriority FROM dirty""",
    "gold_composite_score": f"""
SELECT {_LINE_KEYS}, l_quantity, l_discount, l_tax,
  l_quantity + l_extendedprice + l_discount + l_tax AS composite, l_extendedprice FROM lineitem""",
    "gold_score_correction": f"""
SELECT {_LINE_KEYS}, (l_quantity + l_extendedprice + l_discount + l_tax) - l_extendedprice AS composite
FROM lineitem""",
    "sql_composite_function": f"""
SELECT {_LINE_KEYS}, l_quantity + l_extendedprice + l_discount + l_tax AS composite FROM lineitem""",
    "conform_schema": """
SELECT o_orderkey, o_custkey::DOUBLE AS o_custkey,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice,
  o_orderpriority
FROM orders""",
    "expect_warn_counts": f"WITH {_DIRTY_ORDERS}\n{_violations('dirty', 'warn')}",
    "expect_null_passes": f"WITH {_DIRTY_ORDERS}\n{_violations('dirty', 'warn', null_passes=True)}",
    "expect_fail_gate": f"WITH {_SILVER}\n"
    + _violations("dirty", "fail", label="'bronze' AS dataset, ")
    + "\nUNION ALL "
    + _violations("silver", "fail", label="'silver' AS dataset, "),
    "layer_row_counts": _LAYER_COUNTS,
    "upsert_composite_key": _UPSERTED,
    "bucketed_merge": _UPSERTED,
    "upsert_unique_target": f"""WITH {_REPRICED}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders t
WHERE NOT EXISTS (FROM updates u WHERE t.o_orderkey = u.o_orderkey AND t.o_custkey = u.o_custkey)
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM updates""",
    "upsert_null_keys": f"""WITH target AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority != '5-LOW' THEN o_custkey END AS o_custkey,
    o_orderstatus, o_totalprice, o_orderpriority FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' AND o_custkey IS NOT NULL THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
  o_orderpriority FROM target
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100, o_orderpriority FROM target
WHERE o_orderstatus = 'F' AND o_custkey IS NULL""",
    "upsert_hot_target_key": """WITH target AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE o_custkey END AS o_custkey,
    o_orderstatus, o_totalprice, o_orderpriority FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN c_custkey IS NULL THEN o_totalprice ELSE c_acctbal END AS o_totalprice, o_orderpriority
FROM target LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT NULL, c_custkey, NULL, c_acctbal, NULL FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM target)""",
    "upsert_ambiguous_matches": """
SELECT l_orderkey AS o_orderkey, count(*) AS update_rows FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey HAVING count(*) > 1""",
    "upsert_latest_wins": _LATEST_EVENTS,
    "create_or_upsert": _LATEST_EVENTS,
    "incremental_ingest": _INGESTED,
    "bucketed_ingest": _INGESTED,
    "maintained_gold": f"""SELECT o_orderkey, o_custkey, o_orderpriority, ingest_version,
        o_totalprice + o_custkey::DOUBLE AS composite, o_totalprice
        FROM ({_INGESTED}) WHERE o_orderpriority != '1-URGENT' OR o_orderkey % 3 != 0""",
    "stream_upsert": _INGESTED,
    "ingest_late_delivery": _INGESTED,
    "ingest_long_versions": f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
        ingest_version + 20240000000000 AS ingest_version FROM ({_INGESTED})""",
    "stream_after_snapshot": _INGESTED,
    "stream_new_checkpoint": _INGESTED,
    "stream_refused_batch": f"""WITH {_LANDED}
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, ingest_version FROM (
          SELECT *, row_number() OVER (PARTITION BY o_orderkey, o_custkey ORDER BY ingest_version DESC) AS place
          FROM landed WHERE ingest_version <= 7 OR ingest_version % 2 = 0)
        WHERE place = 1""",
    "malformed_update_keeps_row": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, FALSE AS malformed FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, NULL, o_orderpriority, TRUE FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "distinct_latest_lineage": f"""
        SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'orders_10.csv' ELSE 'orders_9.csv' END AS file,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 9 END::BIGINT AS ingest_version
        FROM ({_ORDER_ROWS})""",
    "layer_row_verdicts": f"""SELECT layer, row_count, row_count = (SELECT count(*) FROM ({_GOLD_BRONZE})) AS as_expected
        FROM ({_LAYER_COUNTS})""",
    "rejected_publish": f"""WITH {_SILVER}, violations AS ({_violations('dirty', 'fail')})
        SELECT rule, violations, (SELECT count(*) FROM silver) AS rows_kept FROM violations WHERE violations > 0""",
    "refused_rows": f"""WITH {_DIRTY_ORDERS} SELECT *, concat_ws(',', {", ".join(
        f"CASE WHEN NOT coalesce({predicate}, FALSE) THEN '{name}' END" for name, predicate in _RULES.items())})
        AS violated FROM dirty""",
    "stream_evolving": """SELECT o_orderkey, o_custkey, o_orderpriority,
        CASE WHEN o_orderstatus != 'P' THEN o_totalprice END AS o_totalprice,
        CASE WHEN o_orderstatus != 'F' THEN o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN '{"o_totalprice":"unknown"}' END AS _rescued_data,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END::BIGINT AS ingest_version FROM orders""",
    "internal_run": _LAYER_COUNTS,
    "external_run": f"""WITH merged AS ({_INGESTED}), clean AS ({_SILVER_ROWS})
        SELECT 'bronze' AS layer, count(*) AS row_count FROM merged
        UNION ALL SELECT 'silver', count(*) FROM clean UNION ALL SELECT 'gold', count(*) FROM clean""",
    "latest_model_run": """
        SELECT 'models/' || event_id AS model_path FROM events WHERE event_type = 'click' AND value > 1
        ORDER BY ts DESC, event_id::VARCHAR DESC LIMIT 1""",
    "random_split": """
        SELECT part, TRUE AS near_its_share, (SELECT count(*) FROM events) AS all_rows,
          (SELECT count(DISTINCT event_id) FROM events) AS distinct_rows
        FROM (VALUES ('train'), ('validation'), ('test')) AS parts(part)""",
    "bernoulli_sample": """
        SELECT count(*) AS all_rows, 0::BIGINT AS strange_rows, 0::BIGINT AS repeated_rows, TRUE AS near_its_share
        FROM events""",
    "skew_numeric": """
        SELECT count(*) AS all_rows, 0::BIGINT AS unfinished_rows, 0::BIGINT AS lost_keys, TRUE AS close_to_the_columns,
          4::BIGINT AS columns_that_fire
        FROM lineitem""",
    "train_and_score": f"""
        SELECT {_split(*_LINE_KEYS.split(', '))} AS split, count(*) AS rows_scored, TRUE AS error_in_bounds
        FROM lineitem GROUP BY 1""",
    "feature_importance": """
        SELECT name, idx, TRUE AS in_order, TRUE AS in_range, TRUE AS whole, name = 'l_quantity' AS foremost
        FROM (VALUES ('l_returnflag_Index', 0), ('l_linestatus_Index', 1), ('l_quantity', 2), ('l_discount', 3),
          ('l_tax', 4)) AS f(name, idx)""",
    "tune_forest": """
        SELECT 'forest' AS run_name, kind, key, entries::BIGINT AS entries, TRUE AS as_declared, value::DOUBLE AS value
        FROM (VALUES ('param', 'numTrees', 3, 1), ('param', 'numTrees', 6, 1), ('param', 'maxDepth', 10, 1),
          ('param', 'maxDepth', 17, 1), ('metric', 'rmse_train', NULL, 2), ('metric', 'rmse_validation', NULL, 2),
          ('test', 'rmse_test', NULL, 1)) AS log(kind, key, value, entries)""",
    "daily_scoring": f"""
        WITH daily AS (SELECT * FROM lineitem WHERE {_split(*_LINE_KEYS.split(', '))} = 'test'),
        daily_sides AS (
          SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, TRUE AS of_reference FROM lineitem
          UNION ALL
          SELECT CASE l_returnflag WHEN 'A' THEN 'X' WHEN 'N' THEN NULL ELSE l_returnflag END, l_linestatus, l_quantity,
            l_discount, l_tax, FALSE FROM daily),
        {_numeric({"daily_sides": (["l_quantity", "l_discount", "l_tax"], "of_reference")})},
        {_categorical({"daily_sides": (["l_returnflag", "l_linestatus"], "of_reference")})}
        SELECT 'daily' AS item, count(*)::DOUBLE AS value FROM daily
        UNION ALL SELECT 'predicted', count(*) FROM daily WHERE l_returnflag = 'R'
        UNION ALL SELECT 'unseen', count(*) FROM daily WHERE l_returnflag <> 'R'
        UNION ALL SELECT col, round(normed, 6) FROM numeric_stats
        UNION ALL SELECT col, round(js, 6) FROM category_stats
        UNION ALL SELECT 'drift_detected', (avg(drifted::INT) >= 0.5)::INT FROM (
          SELECT normed >= 0.1 AS drifted FROM numeric_stats UNION ALL SELECT js >= 0.1 FROM category_stats)
        UNION ALL SELECT 'target_verdicts', 1""",
    "stream_to_parquet": f"WITH {_LANDED} SELECT * FROM landed",
    "csv_scan_malformed": """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice,
  o_orderpriority, o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' AS malformed
FROM orders""",
    "csv_scan_strings": f"""WITH {_LANDED}
SELECT o_orderpriority, ingest_version, count(*) AS row_count FROM landed GROUP BY ALL""",
    "ingest_high_water_mark": "SELECT max(day(ts))::BIGINT AS last_version FROM events",
    "hash_split": f"SELECT event_id, {_split('event_id')} AS split FROM events",
    "hash_sample": f"SELECT event_id, event_type, value FROM events WHERE {_uniform('event_id')} < 0.1",
    "unseen_rows": _UNSEEN,
    "unscorable_rows": _UNSEEN,
    "scorable_rows": f"WITH {_DAILY}\nSELECT * FROM scored",
    "unseen_by_category": f"""WITH {_DAILY},
pairs AS (
  SELECT 'o_orderstatus' AS "column", o_orderstatus AS category FROM daily
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM daily)
SELECT "column", category, count(*) AS row_count FROM pairs
WHERE category IS NULL OR CASE "column"
  WHEN 'o_orderstatus' THEN category NOT IN (SELECT o_orderstatus FROM training)
  ELSE category NOT IN (SELECT o_orderpriority FROM training) END
GROUP BY ALL""",
    "drift_ks": f"""WITH {_numeric(_NUMERIC)}
SELECT col AS "column", round(ks, 6) AS ks FROM numeric_stats""",
    "drift_wasserstein": f"""WITH {_numeric(_NUMERIC)}
SELECT col AS "column", round(w, 6) AS wasserstein, round(normed, 6) AS wasserstein_normed FROM numeric_stats""",
    "drift_js": f"""WITH {_categorical(_CATEGORICAL)}
SELECT col AS "column", round(js, 6) AS jensen_shannon FROM category_stats""",
    "drift_chi2": f"""WITH {_categorical(_CATEGORICAL)}
SELECT col AS "column", round(chi2, 6) AS chi2 FROM category_stats""",
    "drift_report": _REPORTED,
    "drift_profile_report": _REPORTED,
    "drift_turns": _TURNS,
    "drift_small_reference": _SMALL,
    "drift_dataset_flag": f"WITH {_LINE_REPORT},{_DATA_FLAG} SELECT * FROM data_flag",
    "target_drift_flag": f"WITH {_TARGET_FLAG} SELECT * FROM target_flag",
    "drift_alerts": f"""WITH {_LINE_REPORT},{_DATA_FLAG},{_TARGET_FLAG}
SELECT "date", 'drift_detected' AS alert FROM data_flag WHERE drift_detected
UNION ALL SELECT "date", 'model_drift_detected' FROM target_flag WHERE model_drift_detected""",
    "defect_injection": f"""
SELECT * FROM ({_ORDER_ROWS})
UNION ALL
SELECT o_orderkey, o_custkey, 'No Such Status', o_totalprice, 'No Such Policy' FROM orders
WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT o_orderkey, o_custkey, NULL, o_totalprice, ' ' FROM orders WHERE o_orderpriority = '5-LOW'""",
    "category_index": """WITH counts AS (
  SELECT 'p_brand' AS "column", p_brand AS category, count(*) AS row_count FROM part GROUP BY ALL
  UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY ALL)
SELECT "column", category, row_count,
  row_number() OVER (PARTITION BY "column" ORDER BY row_count DESC, category) - 1 AS category_index
FROM counts""",
    "rmse_by_split": f"""WITH predicted AS (SELECT *, {_SEGMENTS} FROM lineitem)
SELECT {_split('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber')} AS split,
  round(sqrt(avg(pow(prediction - l_extendedprice, 2))), 4) AS rmse
FROM predicted GROUP BY ALL""",
    "predicted_target": f"""
SELECT round(prediction, 4) AS l_extendedprice FROM (SELECT {_SEGMENTS} FROM lineitem)""",
    "predictor_target_profile": """
SELECT p_size, count(*) AS row_count, round(avg(p_retailprice), 4) AS avg_target,
  min(p_retailprice) AS min_target, max(p_retailprice) AS max_target
FROM part GROUP BY p_size""",
    "newest_run_per_group": """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
WHERE place = 1""",
}
