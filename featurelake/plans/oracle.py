"""DuckDB-runnable SQL for each registered query (the correctness oracle).

Written independently of the Spark code: each string states the intended
semantics in plain SQL over the pre-registered table views.
"""

from __future__ import annotations

import math

X1 = """(SELECT l_quantity AS sepal_length, l_tax AS sepal_width, l_extendedprice AS petal_length,
        l_discount AS petal_width,
        CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS target
 FROM lineitem)"""

ENGINEERED = f"""(SELECT sepal_length, sepal_width, petal_length, petal_width, target,
   sepal_length * sepal_width AS sepal_area,
   petal_length * petal_width AS petal_area,
   sepal_length / NULLIF(sepal_width, 0) AS sepal_length_to_width_ratio,
   petal_length / NULLIF(petal_width, 0) AS petal_length_to_width_ratio,
   CASE WHEN sepal_length > -1 THEN ln(sepal_length + 1) END AS log_sepal_length,
   CASE WHEN petal_length > -1 THEN ln(petal_length + 1) END AS log_petal_length,
   sepal_length * sepal_length AS sepal_length_squared,
   petal_length * petal_length AS petal_length_squared,
   sepal_length + sepal_width + petal_length + petal_width AS feature_sum,
   (sepal_length + sepal_width + petal_length + petal_width) / 4.0 AS feature_mean
 FROM {X1})"""


def r(expr: str, digits: int = 6, name: str | None = None) -> str:
    return f"round({expr}, {digits}) AS {name or expr}"


SQL: dict[str, str] = {}

SQL["engineer_features"] = f"""
SELECT sepal_length, sepal_width, petal_length, petal_width, target,
  sepal_area, petal_area, sepal_length_to_width_ratio, petal_length_to_width_ratio,
  {r('log_sepal_length')}, {r('log_petal_length')}, sepal_length_squared, petal_length_squared,
  feature_sum, feature_mean
FROM {ENGINEERED}"""

SQL["row_stats"] = f"""
WITH x AS (SELECT *,
  coalesce(sepal_length, 0) + coalesce(sepal_width, 0) + coalesce(petal_length, 0) + coalesce(petal_width, 0)
    + coalesce(target, 0) AS s,
  (CASE WHEN sepal_length IS NULL THEN 0 ELSE 1 END) + (CASE WHEN sepal_width IS NULL THEN 0 ELSE 1 END)
  + (CASE WHEN petal_length IS NULL THEN 0 ELSE 1 END) + (CASE WHEN petal_width IS NULL THEN 0 ELSE 1 END)
  + (CASE WHEN target IS NULL THEN 0 ELSE 1 END) AS n
 FROM {X1})
SELECT sepal_length, sepal_width, petal_length, petal_width, target,
  s AS feature_sum, s / NULLIF(n, 0) AS feature_mean
FROM x"""

SQL["clean_columns"] = f"SELECT * FROM {X1}"

SQL["align_schema"] = f"""
SELECT petal_width, sepal_length, sepal_area, petal_length_to_width_ratio,
  CAST(0.0 AS DOUBLE) AS unseen_feature
FROM {ENGINEERED}"""

# ---------------------------------------------------------------- feature log / catalogue

LOG = """(SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS feature_name,
   CASE WHEN isnan(value) THEN NULL ELSE value END AS feature_value, ts AS event_ts, event_id AS seq FROM events)"""

SQL["feature_melt"] = """
SELECT 'customer_' || CAST(c_custkey AS VARCHAR) AS entity_id, name AS feature_name, val AS feature_value,
  TIMESTAMP '2024-01-31 00:00:00' AS event_ts, TIMESTAMP '2024-01-31 00:00:00' AS ingest_ts, CAST(0 AS BIGINT) AS seq
FROM (SELECT c_custkey, 'c_nationkey' AS name, CAST(c_nationkey AS DOUBLE) AS val FROM customer
      UNION ALL SELECT c_custkey, 'c_acctbal', c_acctbal FROM customer)
UNION ALL
SELECT 'supplier_' || CAST(s_suppkey AS VARCHAR), name, val,
  TIMESTAMP '2024-01-31 00:00:00', TIMESTAMP '2024-01-31 00:00:00', CAST(0 AS BIGINT)
FROM (SELECT s_suppkey, 's_nationkey' AS name, CAST(s_nationkey AS DOUBLE) AS val FROM supplier
      UNION ALL SELECT s_suppkey, 's_acctbal', s_acctbal FROM supplier)"""


def _pivot_sql(where: str, names: list[str], missing: list[str]) -> str:
    cols = ",\n  ".join(f"max(CASE WHEN feature_name = '{n}' THEN feature_value END) AS {n}" for n in names)
    miss = "".join(f",\n  CAST(NULL AS DOUBLE) AS {n}" for n in missing)
    return f"""
WITH f AS (SELECT * FROM {LOG} WHERE feature_value IS NOT NULL AND {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY event_ts DESC, seq DESC) AS rn FROM f)
SELECT entity_id,
  {cols}{miss}
FROM r WHERE rn = 1 GROUP BY entity_id"""


SQL["feature_latest_pivot"] = _pivot_sql(
    "entity_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)",
    ["click", "error", "purchase", "signup", "view"], ["unknown_feature"])

SQL["feature_as_of_pivot"] = _pivot_sql(
    "event_ts <= TIMESTAMP '2024-01-15 00:00:00'", ["click", "error", "purchase", "signup", "view"], [])

SQL["list_features"] = "SELECT DISTINCT event_type AS feature_name FROM events"

SQL["feature_search"] = """SELECT DISTINCT event_type AS feature_name, 'Real-time updated feature: ' || event_type AS description
FROM events WHERE event_type ILIKE '%purch%'"""

SQL["metadata_upsert"] = """
SELECT event_type AS feature_name, 'Real-time updated feature: ' || event_type AS description,
  'numeric' AS data_type, max(ts) AS created_at
FROM events GROUP BY event_type"""

SQL["feature_counts"] = """
WITH names AS (
  SELECT DISTINCT unnest(['sepal_length', 'sepal_width', 'petal_length', 'petal_width', 'sepal_area', 'petal_area',
    'sepal_length_to_width_ratio', 'petal_length_to_width_ratio', 'log_sepal_length', 'log_petal_length',
    'sepal_length_squared', 'petal_length_squared', 'feature_sum', 'feature_mean']) AS feature_name FROM lineitem),
g AS (SELECT CASE WHEN feature_name IN ('sepal_length', 'sepal_width', 'petal_length', 'petal_width')
        THEN 'original' ELSE 'engineered' END AS feature_group FROM names)
SELECT feature_group, count(*) AS n_features FROM g GROUP BY feature_group
UNION ALL SELECT 'total', count(*) FROM g"""

# ---------------------------------------------------------------- feature views

STATS = """(SELECT member_id, event_timestamp, event_timestamp AS created, p / n AS purchase_share,
   1.0 - e / n AS ok_share, CAST(n AS BIGINT) AS n_events
 FROM (SELECT user_id AS member_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS event_timestamp,
         count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS p,
         count(*) FILTER (WHERE event_type = 'error') AS e
       FROM events GROUP BY 1, 2))"""

SPEND = """(SELECT user_id AS member_id, date_trunc('day', ts) + INTERVAL 1 DAY AS event_timestamp, event_timestamp AS created,
   max(value) AS best_value, count(*)::BIGINT AS n_purchases FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)"""


def _signals(*kinds: str) -> str:
    return f"""(SELECT user_id AS member_id, ts AS event_timestamp, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id) AS created,
   event_type AS kind, value AS strength FROM events WHERE event_type IN {(*kinds, '')})"""


SIGNALS, PUSHED = _signals("click", "error"), _signals("signup")

ENTITIES = """(SELECT event_id AS request_id, user_id AS member_id, ts AS event_timestamp, value AS label,
   CAST(event_id % 10 AS {days}) AS horizon_days, CAST(event_id % 100 AS BIGINT) AS target_events
 FROM events WHERE event_type = 'purchase')"""


def _pit(days: str, *views: tuple[str, str, str | None]) -> str:
    """Entity rows with each view's fields; the last of a view's rows by (event_timestamp, created) wins."""
    sql, plain = f"SELECT * FROM {ENTITIES.format(days=days)}", "request_id"
    for fields, source, ttl in views:
        fresh = f"s.event_timestamp >= e.event_timestamp - INTERVAL {ttl}" if ttl else "s.event_timestamp IS NOT NULL"
        named = ", ".join(f"CASE WHEN {fresh} THEN s.{f} END AS {f}" for f in fields.split(", "))
        last = f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY member_id, event_timestamp ORDER BY created DESC) = 1)"
        sql = f"""SELECT e.*, {named} FROM ({sql}) e ASOF LEFT JOIN {last} s
          ON e.member_id = s.member_id AND e.event_timestamp >= s.event_timestamp"""
    return f"({sql})"


_PACE = ("purchase_share, ok_share, n_events", STATS, "12 HOUR")
_SPEND = ("best_value, n_purchases", SPEND, "7 DAY")
_REQUEST = "request_id, member_id, event_timestamp, label, horizon_days, target_events"
_EXPECTED = "best_value * n_purchases * horizon_days AS expected_value"
_MISSING = "CAST(target_events - n_events AS DOUBLE) AS events_missing"

SQL["pit_training_set"] = f"SELECT * FROM {_pit('BIGINT', _PACE)}"

SQL["on_demand"] = f"SELECT {_REQUEST}, n_purchases, best_value, {_EXPECTED} FROM {_pit('DOUBLE', _SPEND)}"

SQL["pit_many_views"] = f"SELECT * FROM {_pit('BIGINT', _PACE, _SPEND, ('kind, strength', SIGNALS, None))}"

SQL["feature_service_v1"] = f"""SELECT {_REQUEST}, n_events, {_MISSING}, n_events / (target_events + 1) AS pace_ratio
FROM {_pit('DOUBLE', _PACE)}"""

SQL["feature_service_v2"] = f"""SELECT {_REQUEST}, best_value, n_purchases, ok_share, purchase_share, {_EXPECTED}, {_MISSING}
FROM {_pit('DOUBLE', _SPEND, _PACE)}"""


def _latest_stats(where: str, src: str = STATS) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY member_id
      ORDER BY event_timestamp DESC, created DESC) AS rn FROM {src} WHERE {where}) WHERE rn = 1)"""


SQL["batch_scoring_features"] = f"""
SELECT ent.request_id, ent.member_id, TIMESTAMP '2024-01-30 12:00:00' AS event_timestamp, ent.label,
  ent.horizon_days, ent.target_events, l.purchase_share, l.ok_share, l.n_events
FROM {ENTITIES.format(days='BIGINT')} ent LEFT JOIN (SELECT * FROM {_latest_stats("event_timestamp <= TIMESTAMP '2024-01-30 12:00:00'")}
  WHERE event_timestamp >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY) l ON ent.member_id = l.member_id"""

_CUT_2 = "event_timestamp <= TIMESTAMP '2024-01-25 00:00:00'"
SQL["materialize_incremental"] = f"SELECT * FROM {_latest_stats(_CUT_2)}"

_ASKED = "c_custkey AS member_id, CAST(c_nationkey AS DOUBLE) AS horizon_days, CAST(c_nationkey * 10 AS BIGINT) AS target_events"
_RATIO = "l.n_events / (c_nationkey * 10 + 1) AS pace_ratio"
_ONLINE = _latest_stats("event_timestamp <= TIMESTAMP '2024-01-31 00:00:00'")
SQL["online_lookup"] = f"""
SELECT {_ASKED}, l.ok_share, CAST(c_nationkey * 10 - l.n_events AS DOUBLE) AS events_missing, {_RATIO}
FROM customer LEFT JOIN {_ONLINE} l ON c_custkey = l.member_id"""

SQL["online_point_reads"] = SQL["online_lookup"]

_PUSHED_LATEST = _latest_stats("TRUE", f"(SELECT * FROM {SIGNALS} WHERE event_timestamp <= TIMESTAMP '2024-01-31 00:00:00' UNION ALL SELECT * FROM {PUSHED})")
SQL["push_upsert"] = f"SELECT * FROM {_PUSHED_LATEST}"
SQL["push_offline"] = f"SELECT * FROM {SIGNALS} UNION ALL SELECT * FROM {PUSHED}"
SQL["online_service_v3"] = f"""
SELECT {_ASKED}, s.kind, l.ok_share, {_RATIO}
FROM customer LEFT JOIN {_PUSHED_LATEST} s ON c_custkey = s.member_id LEFT JOIN {_ONLINE} l ON c_custkey = l.member_id"""
SQL["materialize_restart"] = SQL["materialize_incremental"]

# ---------------------------------------------------------------- quality

_PROFILE_COLS = {
    "events": [("event_id", "fixed"), ("ts", "fixed"), ("user_id", "fixed"), ("event_type", "str"),
               ("value", "float"), ("props", "str")],
    "lineitem": [("l_orderkey", "fixed"), ("l_partkey", "fixed"), ("l_suppkey", "fixed"), ("l_linenumber", "fixed"),
                 ("l_quantity", "float"), ("l_extendedprice", "float"), ("l_discount", "float"), ("l_tax", "float"),
                 ("l_returnflag", "str"), ("l_linestatus", "str"), ("l_shipdate", "fixed")],
}
_FIXED_BYTES = {"events": 8 + 8 + 8 + 8, "lineitem": 8 * 3 + 4 + 8 * 4 + 8}


def _profile_sql(t: str) -> str:
    cols = _PROFILE_COLS[t]
    strs = " + ".join(f"coalesce(sum(strlen({c})), 0)" for c, k in cols if k == "str")
    parts = [f"SELECT '*' AS column_name, 'row_count' AS stat, CAST(count(*) AS DOUBLE) AS value FROM {t}",
             f"SELECT '*', 'column_count', CAST({len(cols)} AS DOUBLE)",
             f"SELECT '*', 'memory_bytes', CAST(count(*) * {_FIXED_BYTES[t]} + {strs} AS DOUBLE) FROM {t}"]
    for c, k in cols:
        cond = f"{c} IS NULL OR isnan({c})" if k == "float" else f"{c} IS NULL"
        parts.append(f"SELECT '{c}', 'null_count', CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) FROM {t}")
    return f"SELECT '{t}' AS dataset, * FROM (" + "\n UNION ALL ".join(parts) + ")"


SQL["quality_profile"] = _profile_sql("events") + "\nUNION ALL\n" + _profile_sql("lineitem")

_X1_COLS = [("sepal_length", "l_quantity"), ("sepal_width", "l_tax"), ("petal_length", "l_extendedprice"),
            ("petal_width", "l_discount"),
            ("target", "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END")]

SQL["quality_describe"] = "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS column_name, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
  round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
  round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max
FROM (SELECT CAST({e} AS DOUBLE) AS x FROM lineitem)""" for n, e in _X1_COLS)

_DRIFT_ROWS = "\n  UNION ALL ".join(
    f"""SELECT '{n}' AS column_name,
    avg(CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN {e} END) AS reference_mean,
    avg(CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN NULL ELSE {e} END) AS current_mean FROM lineitem"""
    for n, e in _X1_COLS[:4])

SQL["mean_drift"] = f"""
WITH m AS ({_DRIFT_ROWS}),
d AS (SELECT *, CASE WHEN reference_mean <> 0
        THEN abs((current_mean - reference_mean) / reference_mean) * 100 WHEN reference_mean = 0 THEN 0.0 END AS drift_percentage FROM m)
SELECT column_name, round(reference_mean, 6) AS reference_mean, round(current_mean, 6) AS current_mean,
  round(drift_percentage, 6) AS drift_percentage, coalesce(drift_percentage > 10, FALSE) AS drift_detected,
  CAST(sum(CASE WHEN drift_percentage > 10 THEN 1 ELSE 0 END) OVER () AS BIGINT) AS drifted_features
FROM d"""

# ---------------------------------------------------------------- trips

TRIPS = """(SELECT o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime, s_nationkey AS pu,
   c_nationkey AS dropoff_zone, l_quantity AS trip_distance,
   epoch_us(l_shipdate - o_orderdate) / 86400000000.0 AS duration
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
   JOIN supplier ON l_suppkey = s_suppkey)"""

PREP = f"""(SELECT CAST(pu AS VARCHAR) AS PULocationID, CAST(dropoff_zone AS VARCHAR) AS DOLocationID,
   CAST(pu AS VARCHAR) || '_' || CAST(dropoff_zone AS VARCHAR) AS PU_DO, trip_distance, pickup_datetime, duration
 FROM {TRIPS} WHERE duration BETWEEN 1 AND 60)"""

SPLIT = f"""(SELECT *, CASE WHEN pickup_datetime < TIMESTAMP '1999-01-01' THEN 'train'
   WHEN pickup_datetime < TIMESTAMP '2000-01-01' THEN 'val' WHEN pickup_datetime IS NOT NULL THEN 'test' END AS split FROM {PREP})"""

SQL["trip_prep"] = f"SELECT * FROM {PREP}"
SQL["trip_counts"] = f"""SELECT count(*) AS rows_before,
  count(*) FILTER (WHERE duration BETWEEN 1 AND 60) AS rows_after FROM {TRIPS}"""
SQL["temporal_split"] = f"SELECT * FROM {SPLIT}"
SQL["hash_split"] = """SELECT o_orderkey,
  CASE WHEN CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 80
    THEN 'train' WHEN o_orderkey IS NOT NULL THEN 'test' END AS split FROM orders"""
SQL["one_hot"] = f"""
WITH s AS (SELECT * FROM {SPLIT}),
vocab AS (SELECT PU_DO, CAST(row_number() OVER (ORDER BY PU_DO) - 1 AS BIGINT) AS pu_do_index
          FROM (SELECT DISTINCT PU_DO FROM s WHERE split = 'train'))
SELECT s.PU_DO, s.trip_distance, s.split, v.pu_do_index FROM s LEFT JOIN vocab v ON s.PU_DO = v.PU_DO
WHERE s.split <> 'train'"""

# ---------------------------------------------------------------- metrics

CLASS = """(SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS actual,
   CASE WHEN l_quantity < 17 THEN 0 WHEN l_quantity < 34 THEN 1 ELSE 2 END AS predicted FROM lineitem)"""

CLASS_METRICS = f"""(WITH cm AS (SELECT actual, predicted, count(*) AS n FROM {CLASS} GROUP BY 1, 2),
 t AS (SELECT actual AS cls, sum(n) AS support, sum(CASE WHEN actual = predicted THEN n END) AS tp FROM cm GROUP BY 1),
 p AS (SELECT predicted AS cls, sum(n) AS n_pred FROM cm GROUP BY 1),
 per AS (SELECT coalesce(t.cls, p.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
           coalesce(n_pred, 0) AS n_pred FROM t FULL JOIN p ON t.cls = p.cls),
 pr AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / NULLIF(n_pred, 0), 0.0) AS pp,
           coalesce(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0.0) AS rr FROM per)
 SELECT sum(tp) / sum(support) AS accuracy, sum(support * pp) / sum(support) AS precision,
   sum(support * rr) / sum(support) AS recall,
   sum(support * coalesce(2 * pp * rr / NULLIF(pp + rr, 0), 0.0)) / sum(support) AS f1 FROM pr)"""

SQL["class_metrics"] = f"""SELECT round(accuracy, 9) AS accuracy, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1 FROM {CLASS_METRICS}"""

SQL["metric_gate"] = f"""SELECT round(accuracy, 9) AS accuracy, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1,
  -- fixed values: the gate's status names and message texts
  CASE WHEN accuracy >= 0.9 AND f1 >= 0.9 THEN 'SUCCESS' ELSE 'WARNING' END AS status,
  CASE WHEN accuracy >= 0.9 AND f1 >= 0.9
    THEN printf('✅ Pipeline validation passed! Accuracy: %.4f, F1: %.4f', accuracy, f1)
    ELSE printf('⚠️ Pipeline validation warning! Accuracy: %.4f, F1: %.4f', accuracy, f1) END AS message,
  accuracy > 0.8 AS passes_0_8, accuracy > 0.7 AS passes_0_7
FROM {CLASS_METRICS}"""

SQL["regression_metrics"] = """
SELECT round(1.0 - avg((p - a) * (p - a)) / var_pop(a), 9) AS r2, round(avg((p - a) * (p - a)), 4) AS mse,
  round(sqrt(avg((p - a) * (p - a))), 6) AS rmse
FROM (SELECT l_extendedprice AS a, l_quantity * 1500.0 AS p FROM lineitem)"""

SQL["residuals"] = """
WITH m AS (SELECT o_orderpriority, avg(o_totalprice) AS predicted FROM orders GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, o_totalprice AS actual, round(m.predicted, 6) AS predicted,
  round(m.predicted - o_totalprice, 6) AS difference
FROM orders JOIN m ON orders.o_orderpriority = m.o_orderpriority"""

SQL["rule_score"] = "SELECT event_id, value, CAST(CASE WHEN value > 23 THEN 0.8 ELSE 0.3 END AS DOUBLE) AS score FROM events"

CANDIDATES = """(WITH x AS (SELECT p_brand, l_extendedprice / NULLIF(l_quantity, 0) AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
 g AS (SELECT p_brand AS run_id, avg(v) AS prediction FROM x GROUP BY p_brand)
 SELECT run_id, prediction, sqrt(avg((v - prediction) * (v - prediction))) AS rmse FROM g, x GROUP BY run_id, prediction)"""

SQL["topn_candidates"] = f"""SELECT run_id, round(prediction, 6) AS prediction, round(rmse, 6) AS rmse
FROM {CANDIDATES} ORDER BY rmse, run_id LIMIT 5"""
SQL["best_candidate"] = f"""SELECT run_id, round(prediction, 6) AS prediction, round(rmse, 6) AS rmse
FROM {CANDIDATES} ORDER BY rmse, run_id LIMIT 1"""

# ---------------------------------------------------------------- correlation network and graph

_ENG_COLS = ["sepal_length", "sepal_width", "petal_length", "petal_width", "target", "sepal_area", "petal_area",
             "sepal_length_to_width_ratio", "petal_length_to_width_ratio", "log_sepal_length", "log_petal_length",
             "sepal_length_squared", "petal_length_squared", "feature_sum", "feature_mean"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(_ENG_COLS):
        for b in _ENG_COLS[i + 1:]:
            xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, covar_pop({xa}, {xb}) / "
                         f"NULLIF(stddev_pop({xa}) * stddev_pop({xb}), 0) AS correlation FROM eng")
    return f"(WITH eng AS (SELECT * FROM {ENGINEERED}) " + "\n UNION ALL ".join(parts) + ")"


CORR = _corr_sql()
SQL["corr_matrix"] = f"SELECT feature_a, feature_b, round(correlation, 6) AS correlation FROM {CORR}"
SQL["corr_edges"] = f"""SELECT feature_a AS src, feature_b AS dst, round(abs(correlation), 6) AS weight,
  round(correlation, 6) AS correlation FROM {CORR} WHERE abs(correlation) > 0.3"""

GRAPH = """(WITH li AS (SELECT o_custkey * 3 AS c, l_partkey * 3 + 1 AS p, l_suppkey * 3 + 2 AS s
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 raw AS (SELECT c AS a, p AS b FROM li UNION ALL SELECT p, s FROM li UNION ALL SELECT c, s FROM li)
 SELECT least(a, b) AS src, greatest(a, b) AS dst FROM raw GROUP BY 1, 2)"""

DEG = f"""(SELECT node, count(*) AS degree FROM (SELECT src AS node FROM {GRAPH} UNION ALL SELECT dst FROM {GRAPH})
 GROUP BY node)"""

SQL["graph_metrics"] = f"""SELECT count(*) AS node_count, CAST(sum(degree) / 2 AS BIGINT) AS edge_count,
  CASE WHEN count(*) > 1 THEN 2 * CAST(sum(degree) / 2 AS BIGINT) / (count(*) * (count(*) - 1)) END AS density
FROM {DEG}"""

SQL["degree_centrality"] = f"""SELECT node, degree, degree / (count(*) OVER () - 1) AS centrality FROM {DEG}"""

SQL["clustering"] = f"""
WITH e AS (SELECT * FROM {GRAPH}),
t AS (SELECT e1.src AS a, e1.dst AS b, e2.dst AS c FROM e e1 JOIN e e2 ON e1.dst = e2.src
      JOIN e e3 ON e3.src = e1.src AND e3.dst = e2.dst),
per AS (SELECT node, count(*) AS tri FROM (SELECT a AS node FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t)
        GROUP BY node),
d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node)
SELECT round(avg(CASE WHEN degree > 1 THEN 2.0 * coalesce(tri, 0) / (degree * (degree - 1)) ELSE 0.0 END), 9)
    AS average_clustering,
  CAST(sum(coalesce(tri, 0)) / 3 AS BIGINT) AS triangles
FROM d LEFT JOIN per ON d.node = per.node"""

SQL["connected_components"] = f"""
WITH RECURSIVE e2 AS (SELECT src AS a, dst AS b FROM {GRAPH} UNION ALL SELECT dst, src FROM {GRAPH}),
r(node, label) USING KEY (node) AS (
  SELECT a, a FROM (SELECT DISTINCT a FROM e2)
  UNION
  SELECT e2.b, min(r.label) FROM r JOIN e2 ON r.node = e2.a GROUP BY e2.b
  HAVING min(r.label) < (SELECT r2.label FROM recurring.r r2 WHERE r2.node = e2.b)
)
SELECT label AS component, count(*) AS size FROM r GROUP BY label"""

# Both kinds of links stay within a customer's day: its orders, from the smallest key on, and their lines.
SQL["order_components"] = """
WITH o AS (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderdate) AS root FROM orders),
n AS (SELECT o_orderkey * 16 AS node, root * 16 AS label FROM o
        WHERE root <> o_orderkey OR o_orderkey IN (SELECT root FROM o WHERE root <> o_orderkey)
      UNION SELECT l_orderkey * 16, coalesce(root, l_orderkey) * 16 FROM lineitem LEFT JOIN o ON l_orderkey = o_orderkey
      UNION SELECT l_orderkey * 16 + l_linenumber, coalesce(root, l_orderkey) * 16 FROM lineitem LEFT JOIN o ON l_orderkey = o_orderkey)
SELECT label AS component, count(*) AS size FROM n GROUP BY label"""

# ---------------------------------------------------------------- envelopes and streams

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"

SQL["update_envelope"] = f"""SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS entity_id,
  'feature_update' AS event_type, {ISO.format('ts')} AS timestamp, event_type AS feature_name, value AS feature_value
FROM events"""

SQL["prediction_envelope"] = f"""SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS entity_id,
  CAST(CASE WHEN value > 23 THEN 0.8 ELSE 0.3 END AS DOUBLE) AS prediction, 'model_prediction' AS event_type,
  {ISO.format('ts')} AS timestamp, CAST(1 AS BIGINT) AS n_features
FROM events"""

SQL["stream_decode"] = """SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS feature_name,
  CASE WHEN isnan(value) THEN NULL ELSE value END AS feature_value, CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_ts FROM events"""

# Message texts and reasons as the input writes them and the contract names them.
SQL["stream_bad_records"] = """SELECT CASE event_type
  WHEN 'error' THEN '{bad' || event_id
  WHEN 'click' THEN '{"feature_data":{"x":' || event_id || '},"timestamp":"2024-01-01T00:00:00"}'
  WHEN 'view' THEN '{"entity_id":"' || event_id || '","feature_data":{},"timestamp":"2024-01-01T00:00:00"}'
  WHEN 'signup' THEN '{"entity_id":"' || event_id || '","timestamp":"2024-01-01T00:00:00"}'
  ELSE '{"entity_id":"' || event_id || '","feature_data":{"x":1.0},"timestamp":"not-a-time"}' END AS raw_value,
 CASE event_type WHEN 'error' THEN 'unparseable' WHEN 'click' THEN 'missing entity_id' WHEN 'view' THEN 'empty feature_data'
  WHEN 'signup' THEN 'missing feature_data' ELSE 'bad timestamp' END AS reason
FROM events WHERE value > 45 AND event_type IN ('error', 'click', 'view', 'signup', 'purchase')"""

SQL["stream_upsert"] = """SELECT entity_id, feature_name, feature_value, event_ts FROM (
  SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS feature_name, value AS feature_value,
    CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_ts,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS rn
  FROM events WHERE value IS NOT NULL AND NOT isnan(value)) WHERE rn = 1"""

SQL["stream_state_latest"] = SQL["stream_upsert"]

SQL["stream_score"] = f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS entity_id,
  CAST(CASE WHEN l_quantity < 17 THEN 0.0 WHEN l_quantity < 34 THEN 1.0 ELSE 2.0 END AS DOUBLE) AS prediction,
  'model_prediction' AS event_type, {ISO.format('l_shipdate')} AS timestamp,
  CAST(4 AS BIGINT) AS n_features
FROM lineitem"""

# ---------------------------------------------------------------- ML with closed-form answers

SQL["standard_scale"] = f"""SELECT
  round((sepal_length - avg(sepal_length) OVER ()) / stddev_samp(sepal_length) OVER (), 6) AS sepal_length_scaled,
  round((sepal_width - avg(sepal_width) OVER ()) / stddev_samp(sepal_width) OVER (), 6) AS sepal_width_scaled,
  round((petal_length - avg(petal_length) OVER ()) / stddev_samp(petal_length) OVER (), 6) AS petal_length_scaled,
  round((petal_width - avg(petal_width) OVER ()) / stddev_samp(petal_width) OVER (), 6) AS petal_width_scaled
FROM {X1}"""

_PCA_COLS = [c for c in _ENG_COLS if c != "target"]
_PCA_PAIRS = [(a, b) for i, a in enumerate(_PCA_COLS) for b in _PCA_COLS[i + 1:]]
SQL["pca_variance"] = f"""WITH e AS (SELECT {", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _PCA_COLS)} FROM {ENGINEERED})
SELECT CAST({len(_PCA_COLS)} AS BIGINT) AS n_components, round({len(_PCA_COLS)}.0, 4) AS total,
  round({len(_PCA_COLS)}.0 + 2 * ({" + ".join(f"corr({a}, {b}) * corr({a}, {b})" for a, b in _PCA_PAIRS)}), 4) AS squares FROM e"""

# The targets are functions of the inputs, so both models are to pass.
SQL["model_floors"] = """WITH x AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem),
n AS (SELECT count(*) FILTER (WHERE CAST(('0x' || substr(md5(k), 1, 8)) AS BIGINT) % 100 < 80) AS n_train,
        count(*) FILTER (WHERE CAST(('0x' || substr(md5(k), 1, 8)) AS BIGINT) % 100 >= 80) AS n_test FROM x)
SELECT model, TRUE AS passes, n_train, n_test FROM n, (VALUES ('logistic_regression'), ('random_forest')) AS m(model)"""

_LINE_KEYS = """(SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem)"""
_BUCKET = "CAST(('0x' || substr(md5({0}), 1, 8)) AS BIGINT) % 100"

# The trials are the grid's first by a hash of their parameters. The target is a function of the inputs, so each is to beat the mean.
SQL["hyper_search"] = f"""WITH g AS (SELECT d, t, l, md5('42-' || d || '-' || t || '-' || l || '-auto') AS h
  FROM range(1, 21) a(d), range(10, 51, 10) b(t), range(1, 5) c(l)),
n AS (SELECT count(*) FILTER (WHERE {_BUCKET.format("'search-' || k")} < 80) AS n_fit,
        count(*) FILTER (WHERE {_BUCKET.format("'search-' || k")} >= 80) AS n_val FROM {_LINE_KEYS} WHERE {_BUCKET.format("k")} < 80)
SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS trial, CAST(d AS INTEGER) AS max_depth, CAST(t AS INTEGER) AS num_trees,
  CAST(l AS INTEGER) AS min_instances, n_fit, n_val, TRUE AS beats_mean FROM g, n QUALIFY row_number() OVER (ORDER BY h) <= 15"""

SQL["model_selection"] = f"""WITH n AS (SELECT count(*) FILTER (WHERE {_BUCKET.format("k")} < 10) AS val_n, count(*) FILTER (WHERE {_BUCKET.format("k")} >= 80) AS test_n
  FROM {_LINE_KEYS})
SELECT CAST(place AS INTEGER) AS place, val_n, test_n, TRUE AS val_passes, TRUE AS test_passes FROM n, range(1, 6) p(place)"""

SQL["batch_score_linear"] = """WITH x AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS k,
    max(l_quantity) AS q, max(l_tax) AS t FROM lineitem GROUP BY 1)
SELECT 'test_sample_' || k AS entity_id, 'predicted_target' AS feature_name, round(3 * q - 2 * t + 5, 4) AS feature_value,
  TIMESTAMP '2024-01-31 00:00:00' AS event_ts, TIMESTAMP '2024-01-31 00:00:00' AS ingest_ts, CAST(0 AS BIGINT) AS seq
FROM x WHERE CAST(('0x' || substr(md5(k), 1, 8)) AS BIGINT) % 100 >= 80"""

_TEST_LINES = """(SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS k,
    max(l_quantity) AS q, max(l_tax) AS t FROM lineitem GROUP BY 1) WHERE CAST(('0x' || substr(md5(k), 1, 8)) AS BIGINT) % 100 >= 80)"""
SQL["guarded_score"] = f"""
SELECT 'as trained' AS frame, NULL::VARCHAR AS refused, count(*) AS n_rows, round(avg(3 * q - 2 * t + 5), 4) AS mean_prediction FROM {_TEST_LINES}
UNION ALL SELECT 'whole numbers', NULL, count(*), round(avg(3 * trunc(q) - 2 * t + 5), 4) FROM {_TEST_LINES}
UNION ALL SELECT 'tax as text', 'type of tax: string != double', count(*), NULL FROM {_TEST_LINES}
UNION ALL SELECT 'no quantity', 'missing column quantity', count(*), NULL FROM {_TEST_LINES}"""

SQL["report_retention"] = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n_events, max(ts) AS validated_at,
  max(ts) + INTERVAL 10 DAY AS expires_at FROM events GROUP BY 1, 2 HAVING max(ts) + INTERVAL 10 DAY > TIMESTAMP '2024-01-20 12:00:00'"""

SQL["schema_watch"] = """
WITH n AS (SELECT count(*) FILTER (ts < DATE '2024-01-11') AS a, count(*) FILTER (ts >= DATE '2024-01-11' AND ts < DATE '2024-01-21') AS b,
    count(*) FILTER (ts >= DATE '2024-01-21') AS c, count(value) FILTER (ts < DATE '2024-01-11') AS va, count(value) FILTER (ts >= DATE '2024-01-21') AS vc,
    count(props) FILTER (ts < DATE '2024-01-11') AS pa, count(user_id) FILTER (ts < DATE '2024-01-11') AS ua,
    count(user_id) FILTER (ts >= DATE '2024-01-11' AND ts < DATE '2024-01-21') AS ub, count(user_id) FILTER (ts >= DATE '2024-01-21') AS uc FROM events)
SELECT 'events' AS dataset, v.* FROM n, LATERAL (VALUES
  (1::BIGINT, 'user_id', 'retyped', 'bigint', 'string', ua, ub), (1, 'value', 'emptied', 'double', 'double', va, 0), (1, 'props', 'removed', 'string', NULL, pa, NULL),
  (1, 'day', 'added', NULL, 'date', NULL, b), (2, 'ts', 'removed', 'timestamp_ntz', NULL, b, NULL), (2, 'user_id', 'retyped', 'string', 'bigint', ub, uc),
  (2, 'value', 'filled', 'double', 'double', 0, vc)) AS v(run, column_name, change, type_before, type_after, filled_before, filled_after)"""

MINUTES = """(SELECT CAST(user_id AS VARCHAR) AS PULocationID, CAST(event_id % 97 AS VARCHAR) AS DOLocationID,
   CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 97 AS VARCHAR) AS PU_DO, value AS trip_distance, ts AS lpep_pickup_datetime,
   CAST(value * 60000000 AS BIGINT) / 60000000.0 AS duration FROM events)"""
SQL["trip_prep_minutes"] = f"SELECT * FROM {MINUTES} WHERE duration BETWEEN 1 AND 60"
SQL["linreg_ids"] = f"SELECT CAST(0.0 AS DOUBLE) AS train_rmse, count(*) AS n_train FROM {MINUTES} WHERE duration BETWEEN 1 AND 60"

# OLS on a one-hot encoding of a single category (with intercept) fits the per-category means.
SQL["linreg"] = f"""SELECT round(sqrt(avg((duration - m) * (duration - m))), 4) AS train_rmse, count(*) AS n_train
FROM (SELECT duration, avg(duration) OVER (PARTITION BY PU_DO) AS m FROM {SPLIT} WHERE split = 'train')"""

# ---------------------------------------------------------------- quantized rounding
# Every round(x, d) above is evaluated as round(x * 2^b) / 2^b with 2^-b just below
# 10^-d, the same quantization the Spark side applies (functions.columns.quantize).

def _quantize_sql(sql: str) -> str:
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = _quantize_sql(sql[j + 6:comma])
        digits = int(sql[comma + 1:k])
        scale = float(2 ** int(math.ceil(digits * math.log2(10))))
        out.append(sql[i:j] + f"(round(CAST({inner} AS DOUBLE) * {scale!r}) / {scale!r})")
        i = k + 1


SQL = {k: _quantize_sql(v) for k, v in SQL.items()}

_EVENTS_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
                 ("value", "double"), ("props", "string")]
SQL["quality_schema"] = "\nUNION ALL\n".join(
    f"SELECT 'events' AS dataset, {i} AS position, '{c}' AS column_name, '{t}' AS data_type, TRUE AS nullable, "
    f"count({c}) AS non_null FROM events" for i, (c, t) in enumerate(_EVENTS_TYPES))

SQL["one_hot_ids"] = f"""
WITH s AS (SELECT * FROM {SPLIT}),
pu AS (SELECT PULocationID, CAST(row_number() OVER (ORDER BY PULocationID) - 1 AS BIGINT) AS pu_index
       FROM (SELECT DISTINCT PULocationID FROM s WHERE split = 'train')),
dz AS (SELECT DOLocationID, CAST(row_number() OVER (ORDER BY DOLocationID) - 1 AS BIGINT) AS do_index
       FROM (SELECT DISTINCT DOLocationID FROM s WHERE split = 'train'))
SELECT s.PULocationID, s.DOLocationID, s.split, pu.pu_index, dz.do_index
FROM s LEFT JOIN pu ON s.PULocationID = pu.PULocationID LEFT JOIN dz ON s.DOLocationID = dz.DOLocationID
WHERE s.split <> 'train'"""
