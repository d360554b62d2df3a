"""The same queries in SQL, for the oracle engine."""

from __future__ import annotations

from entry_queries.roles import ODD_ENTRIES


def _md5(*texts: str) -> str:
    """Hash of length-prefixed texts; each text expression must already be non-null."""
    parts = " || ".join(f"length({t})::VARCHAR || ':' || {t}" for t in texts)
    return f"md5({parts})"


def _text(expr: str) -> str:
    return f"coalesce(({expr})::VARCHAR, '\\N')"


def _json(expr: str) -> str:
    return f"coalesce(to_json({expr})::VARCHAR, '[]')"


_CATALOG = f"""
raw_catalog AS (
  SELECT o_custkey AS appid, o_orderpriority AS name, o_orderdate AS last_update, o_orderkey,
         {_md5(_text('o_custkey'), _text('o_orderpriority'))} AS row_hash
  FROM orders),
stg_catalog AS (
  SELECT appid, name, row_hash, last_update FROM raw_catalog
  QUALIFY row_number() OVER (PARTITION BY appid, row_hash ORDER BY last_update, o_orderkey) = 1)
"""

_DAILY = f"""
raw_daily AS (
  SELECT user_id AS appid, event_type AS name, ts AS last_update, event_id,
         {_md5(_text('user_id'), _text('event_type'))} AS row_hash
  FROM events)
"""

_QUEUE = _CATALOG + """,
stg_sales AS (
  SELECT user_id AS appid, min(ts) AS last_update FROM events
  WHERE event_type = 'signup'
  GROUP BY user_id, CAST(ts AS DATE)),
stg_cards AS (
  SELECT success, appid, release_date, min(ts) AS last_update FROM (
    SELECT value >= 20 AS success, user_id * 3 AS appid, ts,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 <> 0 THEN ts END AS release_date
    FROM events WHERE event_type = 'purchase')
  GROUP BY success, appid, release_date),
current_cards AS (
  SELECT appid, success, release_date, last_update,
         max(last_update) OVER () AS max_last_update
  FROM stg_cards
  QUALIFY row_number() OVER (PARTITION BY appid ORDER BY last_update DESC) = 1),
recent_sales AS (
  SELECT *, row_number() OVER (PARTITION BY appid ORDER BY last_update DESC) AS nth FROM stg_sales),
latest_sales AS (
  SELECT appid, CAST(last_update AS DATE) AS last_upd FROM recent_sales WHERE nth <= 2),
failed AS (SELECT appid FROM current_cards WHERE NOT success),
eligible AS (SELECT appid, last_upd FROM latest_sales WHERE appid NOT IN (SELECT appid FROM failed)),
seen AS (
  SELECT appid, max(last_upd) AS newest, date_diff('day', min(last_upd), max(last_upd)) AS days_between
  FROM eligible GROUP BY appid),
arm_changed AS (
  SELECT appid FROM seen WHERE newest = DATE '2024-01-28' AND days_between NOT BETWEEN 1 AND 5),
arm_new AS (
  SELECT a.appid FROM stg_catalog a
  WHERE a.appid NOT IN (SELECT appid FROM current_cards)
    AND a.appid NOT IN (SELECT appid FROM stg_sales)
  ORDER BY a.last_update DESC, a.appid, a.row_hash LIMIT 2000),
arm_retry AS (
  SELECT appid FROM current_cards
  WHERE dayofweek(DATE '2024-01-28') = 0
    AND CAST(max_last_update AS DATE) <> DATE '2024-02-04'
    AND (NOT success OR release_date IS NULL)
    AND appid NOT IN (SELECT appid FROM eligible)
  ORDER BY appid DESC LIMIT 500),
queue AS (
  SELECT appid FROM arm_changed UNION ALL SELECT appid FROM arm_new
  UNION ALL SELECT appid FROM arm_retry)
"""

_PACKAGES = f"""
raw_packages AS (
  SELECT *, {_md5(*[_text(c) for c in ('appid', 'packageid', 'package_option_text', 'package_price_with_discount')])} AS row_hash
  FROM (
    SELECT l_suppkey AS appid, CAST(l_linenumber AS BIGINT) AS packageid, l_returnflag AS package_option_text,
           CAST(floor(l_discount * 20) AS BIGINT) AS package_price_with_discount,
           l_linestatus AS name, l_shipdate AS last_update
    FROM lineitem))
"""

_SNAPSHOT_COLUMNS = (
    "appid", "name", "developer", "publisher", "score_rank", "positive", "negative",
    "userscore", "owners", "price", "initialprice", "discount", "ccu",
)

_SNAPSHOTS = f"""
raw_snapshots AS (
  SELECT *, {_md5(*[_text(c) for c in _SNAPSHOT_COLUMNS])} AS row_hash
  FROM (
    SELECT o_custkey AS appid, o_orderpriority AS name, o_orderstatus AS developer,
           nullif(o_orderstatus, 'F') AS publisher, CAST(NULL AS BIGINT) AS score_rank,
           step AS positive, step + 1 AS negative, CAST(0 AS BIGINT) AS userscore,
           step::VARCHAR || ' .. ' || (step + 1)::VARCHAR AS owners,
           CAST(step AS DOUBLE) AS price, CAST(step + 1 AS DOUBLE) AS initialprice,
           CAST(0 AS DOUBLE) AS discount, CAST(NULL AS BIGINT) AS ccu, o_orderdate AS last_update
    FROM (SELECT *, CAST(floor(o_totalprice / 100000) AS BIGINT) AS step FROM orders)))
"""

_CARD_TEXT = {
    "success": _text("success::INT"),
    "is_free": _text("is_free::INT"),
    "release_date": _text("strftime(release_date, '%Y-%m-%d %H:%M:%S.%f')"),
}
_CARD_ARRAYS = (
    "developers", "publishers", "categories_id", "categories_description",
    "genres_id", "genres_description",
)
_CARD_COLUMNS = (
    "success", "appid", "name", "required_age", "is_free", "supported_languages", "website",
    "pc_requirements", "mac_requirements", "linux_requirements", *_CARD_ARRAYS, "release_date",
)
_CARD_HASH = _md5(
    *[
        _CARD_TEXT.get(c) or (c if c in _CARD_ARRAYS else _text(c))
        for c in _CARD_COLUMNS
    ]
)

_CARDS = f"""
raw_cards AS (
  SELECT *, {_CARD_HASH} AS row_hash FROM (
    SELECT o_orderstatus <> 'P' AS success, o_custkey AS appid, o_orderpriority AS name,
           CAST(NULL AS BIGINT) AS required_age, o_orderstatus = 'F' AS is_free,
           nullif(o_orderstatus, 'O') AS supported_languages, '' AS website,
           '' AS pc_requirements, CAST(NULL AS VARCHAR) AS mac_requirements,
           CAST(NULL AS VARCHAR) AS linux_requirements,
           {_json("words")} AS developers,
           {_json("CASE WHEN o_orderstatus = 'F' THEN words END")} AS publishers,
           {_json("[words[1]::BIGINT]")} AS categories_id,
           {_json("words[2:2]")} AS categories_description,
           {_json("words[1:1]")} AS genres_id,
           {_json("words[2:2]")} AS genres_description,
           CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS release_date,
           o_orderdate AS last_update
    FROM (SELECT *, string_split(o_orderpriority, '-') AS words FROM orders)))
"""


def _earliest(table: str, keys: str, columns: str) -> str:
    return f"""SELECT {columns}, row_hash, last_update FROM {table}
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY last_update) = 1"""


_PRICE_COLUMNS = ("appid", "name", "currency", "price_initial", "price_final", "discount_percent")

_LINE_METRICS = """
measured AS (
  SELECT {by}, 'row_count' AS metrics_name, 'count' AS agg_type, CAST(count(*) AS DOUBLE) AS metrics_value
  FROM loads GROUP BY ALL
  UNION ALL
  SELECT {by}, 'l_quantity', 'median', median(l_quantity) FROM loads GROUP BY ALL
  UNION ALL
  SELECT {by}, 'l_extendedprice', 'median', median(l_extendedprice) FROM loads GROUP BY ALL
  UNION ALL
  SELECT {by}, 'l_discount', 'median', median(l_discount) FROM loads GROUP BY ALL)
"""
_LOADS = "loads AS (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS load_month FROM lineitem)"

_CARD_PARTS = """
c AS (
  SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS total,
         string_split(o_orderpriority, '-') AS words,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderdate END AS released,
         CASE WHEN o_orderpriority = '5-LOW' THEN CASE WHEN o_orderstatus = 'F' THEN '' END
              ELSE o_orderpriority END AS card_name
  FROM orders)
"""

_HOURS = """hours AS (
  SELECT CAST(floor(epoch(max(ts) - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS last FROM events),
landed AS (
  SELECT DISTINCT user_id AS walk,
         CAST(floor(epoch(ts - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) * 100 AS "offset" FROM events),
walks AS (SELECT DISTINCT walk FROM landed)"""


def _odd(path: str, allowed: str, label: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') NOT IN ({allowed}, 'NULL') THEN '{label}' END"


def _odd_elements(path: str, of: str, allowed: str, label: str) -> str:
    kinds = f"list_transform(from_json(json_extract(j, '{path}'), '[\"JSON\"]'), lambda x: coalesce(json_type(x{of}), 'NULL'))"
    return (
        f"CASE WHEN json_type(j, '{path}') = 'ARRAY' AND "
        f"len(list_filter({kinds}, lambda x: x <> '{allowed}')) > 0 THEN '{label}' END"
    )


_TEXT, _LIST, _OBJECT = "'VARCHAR'", "'ARRAY'", "'OBJECT'"
_EMPTY_LIST = "'OBJECT', 'ARRAY'"  # the given lists in these places are empty
_ODD_RULES = (
    _odd("$", _OBJECT, "response:type"),
    _odd("$.data", _EMPTY_LIST, "data:type"),
    _odd("$.data.name", _TEXT, "name:type"),
    _odd("$.data.supported_languages", _TEXT, "supported_languages:type"),
    _odd("$.data.website", _TEXT, "website:type"),
    _odd("$.data.pc_requirements", _EMPTY_LIST, "pc_requirements:type"),
    _odd("$.data.mac_requirements.minimum", _TEXT, "mac_requirements:type"),
    _odd("$.data.developers", _LIST, "developers:type"),
    _odd_elements("$.data.publishers", "", "VARCHAR", "publishers:type"),
    _odd("$.data.categories", _LIST, "categories:type"),
    _odd_elements("$.data.categories", ", '$.description'", "VARCHAR", "categories_description:type"),
    _odd_elements("$.data.genres", "", "OBJECT", "genres:type"),
    _odd_elements("$.data.genres", ", '$.id'", "VARCHAR", "genres_id:type"),
    _odd_elements("$.data.genres", ", '$.description'", "VARCHAR", "genres_description:type"),
    _odd("$.data.release_date.date", _TEXT, "release_date:type"),
    _odd("$.data.price_overview", _OBJECT, "price_overview:type"),
    _odd("$.data.package_groups", _LIST, "package_groups:type"),
)
_ODD_ENTRIES = ", ".join(f"({i}, '{e}')" for i, e in enumerate(ODD_ENTRIES))

ORACLE: dict[str, str] = {
    "scan_count": "SELECT count(*) AS n, count(l_shipdate) AS n_dated FROM lineitem",
    "stg_catalog": f"WITH {_CATALOG} SELECT appid, name, row_hash, last_update FROM stg_catalog",
    "stg_daily": f"""WITH {_DAILY}
SELECT appid, name, row_hash, last_update FROM raw_daily
QUALIFY row_number() OVER (
  PARTITION BY appid, row_hash, CAST(last_update AS DATE) ORDER BY last_update, event_id) = 1""",
    "stg_cards": f"WITH {_CARDS} " + _earliest("raw_cards", "appid, row_hash", ", ".join(_CARD_COLUMNS)),
    "stg_prices": f"""WITH raw_prices AS (
  SELECT *, {_md5(*[_text(c) for c in _PRICE_COLUMNS])} AS row_hash FROM (
    SELECT CAST(l_linenumber AS BIGINT) AS appid, l_linestatus AS name, 'USD' AS currency,
           CAST(floor(l_quantity / 25) AS BIGINT) AS price_initial,
           CAST(floor(l_quantity / 25) AS BIGINT) AS price_final,
           CAST(NULL AS BIGINT) AS discount_percent, l_shipdate AS last_update
    FROM lineitem)) """
    + _earliest("raw_prices", "appid, row_hash, CAST(last_update AS DATE)", ", ".join(_PRICE_COLUMNS)),
    "stg_composite": f"WITH {_PACKAGES} " + _earliest(
        "raw_packages", "appid, packageid, row_hash",
        "appid, packageid, package_option_text, package_price_with_discount"),
    "stg_added_column": f"""WITH {_PACKAGES}
SELECT appid, packageid, package_option_text, package_price_with_discount, name, row_hash, last_update
FROM raw_packages
QUALIFY row_number() OVER (PARTITION BY appid, packageid, row_hash ORDER BY last_update, name) = 1""",
    "stg_snapshots": f"WITH {_SNAPSHOTS} " + _earliest(
        "raw_snapshots", "appid, row_hash", ", ".join(_SNAPSHOT_COLUMNS)),
    "latest_state": f"WITH {_QUEUE} SELECT appid, success, release_date, last_update FROM current_cards",
    "latest_two": f"WITH {_QUEUE} SELECT appid, last_upd FROM latest_sales",
    "global_max": f"""WITH {_QUEUE}
SELECT appid, success, last_update, max(last_update) OVER () AS max_last_update FROM stg_cards""",
    "specials_eligible": f"WITH {_QUEUE} SELECT appid, last_upd FROM eligible",
    "sale_transitions": f"WITH {_QUEUE} SELECT appid FROM arm_changed",
    "never_fetched": f"WITH {_QUEUE} SELECT appid FROM arm_new",
    "retry_failed": f"WITH {_QUEUE} SELECT appid FROM arm_retry",
    "fetch_queue": f"WITH {_QUEUE} SELECT appid FROM queue",
    "queue_export": f"WITH {_QUEUE} SELECT appid FROM queue ORDER BY appid",
    "batch_split": """WITH numbered AS (
  SELECT o_custkey AS appid, row_number() OVER (ORDER BY o_custkey) - 1 AS position FROM orders)
SELECT CAST(position // 500 AS BIGINT) AS batch, CAST(position AS BIGINT) AS position, appid FROM numbered""",
    "week_starts": """SELECT event_id,
  CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS week, dayofweek(ts) = 0 AS is_start
FROM events""",
    "state_hash": f"""SELECT c_custkey, {_md5(
        _text("nullif(c_mktsegment, 'BUILDING')"),
        _text("CASE WHEN c_nationkey <> 3 THEN c_nationkey END"),
        _text("(c_acctbal >= 0)::INT"),
        _json("string_split(c_name, '#')"))} AS row_hash
FROM customer""",
    "audit_cols": """SELECT event_id, ts AS last_update, -(epoch_us(ts) // 1000) AS ver,
  CAST(date_trunc('month', ts) AS DATE) AS load_month FROM events""",
    "compact_monthly": f"""WITH {_CATALOG}
SELECT appid, name, row_hash, last_update, -(epoch_us(last_update) // 1000) AS ver,
       CAST(date_trunc('month', last_update) AS DATE) AS load_month
FROM raw_catalog
QUALIFY row_number() OVER (
  PARTITION BY date_trunc('month', last_update), appid, row_hash ORDER BY last_update, o_orderkey) = 1""",
    "compact_late_column": f"""WITH {_PACKAGES}
SELECT appid, packageid, package_option_text, package_price_with_discount, name, row_hash, last_update,
       -(epoch_us(last_update) // 1000) AS ver,
       CAST(date_trunc('month', last_update) AS DATE) AS load_month
FROM raw_packages
QUALIFY row_number() OVER (
  PARTITION BY date_trunc('month', last_update), appid, packageid, row_hash
  ORDER BY last_update, name) = 1""",
    "compact_metrics": """WITH daily AS (
  SELECT CAST(ts AS DATE) AS day, 'row_count' AS metrics_name, 'count' AS agg_type,
         CAST(count(*) AS DOUBLE) AS metrics_value FROM events GROUP BY ALL
  UNION ALL
  SELECT CAST(ts AS DATE), 'value', 'median', median(value) FROM events GROUP BY ALL),
stamped AS (SELECT *, CAST(day AS TIMESTAMP) + INTERVAL 30 MINUTE AS last_update FROM daily)
SELECT dag_id, 'raw' AS schema_name, 'sale_log' AS table_name, metrics_name, agg_type,
       round(metrics_value, 6) AS metrics_value, last_update, -(epoch_us(last_update) // 1000) AS ver,
       CAST(date_trunc('month', day) AS DATE) AS load_month
FROM stamped, (VALUES ('events_daily'), ('events_again')) v(dag_id)""",
    "idempotent_load": f"""WITH {_DAILY}
SELECT appid, name, row_hash, last_update, -(epoch_us(last_update) // 1000) AS ver,
       CAST(date_trunc('month', last_update) AS DATE) AS load_month
FROM raw_daily
QUALIFY row_number() OVER (
  PARTITION BY CAST(last_update AS DATE), appid, row_hash ORDER BY last_update, event_id) = 1""",
    "added_column": """SELECT l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN '' ELSE l_returnflag END AS name
FROM lineitem""",
    "dq_collect": f"""WITH {_LOADS}, {_LINE_METRICS.format(by='load_month')}
SELECT load_month, metrics_name, agg_type, round(metrics_value, 6) AS metrics_value FROM measured""",
    "dq_collect_load": """SELECT 'events_all' AS dag_id, 'raw' AS schema_name, 'sale_log' AS table_name,
  metrics_name, agg_type, round(metrics_value, 6) AS metrics_value,
  TIMESTAMP '2024-01-31 00:00:00' AS last_update
FROM (SELECT 'row_count' AS metrics_name, 'count' AS agg_type, CAST(count(*) AS DOUBLE) AS metrics_value FROM events
      UNION ALL SELECT 'value', 'median', median(value) FROM events)""",
    "dq_previous": """WITH history AS (
  SELECT CAST(ts AS DATE) + INTERVAL 30 MINUTE AS last_update, 'row_count' AS metrics_name,
         CAST(count(*) AS DOUBLE) AS metrics_value FROM events GROUP BY ALL
  UNION ALL
  SELECT CAST(ts AS DATE) + INTERVAL 30 MINUTE, 'value', median(value) FROM events GROUP BY ALL)
SELECT metrics_name, round(metrics_value, 6) AS old_value FROM history
WHERE last_update = (SELECT max(last_update) FROM history
                     WHERE last_update <= TIMESTAMP '2024-01-20 12:00:00')""",
    "dq_drift": f"""WITH {_LOADS}, {_LINE_METRICS.format(by='l_returnflag, load_month')},
paired AS (
  SELECT l_returnflag, metrics_name, load_month, metrics_value AS new_value,
         lag(metrics_value) OVER (PARTITION BY l_returnflag, metrics_name ORDER BY load_month) AS old_value
  FROM measured),
drifted AS (
  SELECT *, CASE WHEN new_value <> 0 AND old_value <> 0
       THEN abs(greatest(new_value, old_value) / least(new_value, old_value) - 1) END AS drift
  FROM paired)
SELECT l_returnflag, metrics_name, load_month, round(new_value, 6) AS new_value,
       round(old_value, 6) AS old_value, round(drift, 6) AS drift,
       CASE WHEN drift IS NULL THEN 'skip' WHEN drift > 0.5 THEN 'error'
            WHEN drift > 0.2 THEN 'warn' ELSE 'ok' END AS status
FROM drifted""",
    "freshness_test": """WITH cases AS (
  SELECT 'fresh' AS case_name, (SELECT max(CAST(ts AS DATE)) FROM events) AS newest, DATE '2024-01-31' AS expected_date
  UNION ALL SELECT 'stale', (SELECT max(CAST(ts AS DATE)) FROM events), DATE '2024-02-02'
  UNION ALL SELECT 'empty', (SELECT max(CAST(ts AS DATE)) FROM events WHERE value < 0), DATE '2024-01-31')
SELECT case_name, coalesce(newest, DATE '1970-01-01') AS last_observed_date, expected_date FROM cases
WHERE abs(expected_date - coalesce(newest, DATE '1970-01-01')) > 1""",
    "test_not_null": """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
WHERE nullif(c_mktsegment, 'BUILDING') IS NULL""",
    "coerce_types": r"""WITH t AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, event_type,
         CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END AS whole FROM events)
SELECT event_id, k, whole, CASE WHEN event_type <> 'error' THEN value END AS amount,
  CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false END AS flag,
  concat_ws(',', CASE WHEN whole IS NULL THEN 'whole:type' END,
                 CASE WHEN event_type = 'error' THEN 'amount:type' END,
                 CASE WHEN event_type NOT IN ('view', 'click') THEN 'flag:type' END) AS broken
FROM t""",
    "constraint_ge": "SELECT c_custkey, c_acctbal, 'c_acctbal:ge' AS broken FROM customer WHERE c_acctbal < 0",
    "constraint_required": """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
  CAST(NULL AS VARCHAR) AS absent, 'segment:required' AS broken
FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "blank_lines": r"""SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE NOT regexp_full_match(line, '\s*')) AS n_text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
    "regex_id": r"""SELECT page_id, CAST(regexp_extract(url, '/(\d+)', 1) AS BIGINT) AS id FROM pages
WHERE regexp_extract(url, '/(\d+)', 1) <> ''""",
    "release_dates": """SELECT o_orderkey,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END AS released FROM orders""",
    "json_field": """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
  coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events""",
    "array_project": """SELECT p_partkey,
  array_to_string(range(1, len(words) + 1)::VARCHAR[], '|') AS ids,
  array_to_string(words, '|') AS names
FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)""",
    "explode_two": """SELECT l_orderkey, l_linenumber, l_suppkey AS packageid, l_returnflag AS option_text FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus FROM lineitem""",
    "flatten_cards": f"""WITH {_CARD_PARTS}
SELECT o_orderstatus <> 'P' AS success, o_orderkey AS appid,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE card_name END AS name,
  CASE WHEN o_orderstatus = 'F' THEN CAST(18 AS BIGINT) END AS required_age,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'O' END AS is_free,
  '' AS supported_languages, '' AS website,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'min ' || o_orderstatus END AS pc_requirements,
  '' AS mac_requirements, '' AS linux_requirements,
  CASE WHEN o_orderstatus = 'P' THEN '[]' ELSE to_json(words)::VARCHAR END AS developers,
  '[]' AS publishers,
  CASE WHEN o_orderstatus = 'P' THEN '[]' ELSE '[' || words[1] || ']' END AS categories_id,
  CASE WHEN o_orderstatus = 'P' THEN '[]' ELSE to_json(words[2:2])::VARCHAR END AS categories_description,
  '[]' AS genres_id, '[]' AS genres_description,
  CASE WHEN o_orderstatus <> 'P' THEN released END AS release_date, '' AS broken
FROM c""",
    "flatten_odd_shapes": f"""SELECT o_orderkey AS appid,
  array_to_string(list_sort(list_filter([{', '.join(_ODD_RULES)}], lambda x: x IS NOT NULL)), ',') AS broken
FROM orders JOIN (SELECT n, CAST(e AS JSON) AS j FROM (VALUES {_ODD_ENTRIES}) v(n, e)) ON n = o_orderkey % {len(ODD_ENTRIES)}""",
    "flatten_prices": f"""WITH {_CARD_PARTS}
SELECT o_orderkey AS appid, card_name AS name,
  CASE WHEN o_totalprice >= 100000 AND o_orderstatus = 'F' THEN 'USD' END AS currency,
  CASE WHEN o_totalprice >= 100000 THEN total END AS price_initial,
  CASE WHEN o_totalprice >= 100000 THEN total - 1 END AS price_final,
  CASE WHEN o_totalprice >= 100000 THEN CAST(10 AS BIGINT) END AS discount_percent,
  CASE WHEN card_name IS NULL THEN 'name:required' ELSE '' END AS broken
FROM c WHERE o_orderstatus <> 'P'""",
    "flatten_packages": f"""WITH {_CARD_PARTS}
SELECT o_orderkey AS appid, o_custkey AS packageid,
  CASE WHEN o_orderpriority = '2-HIGH' THEN CASE WHEN o_orderstatus = 'F' THEN '' END
       ELSE o_orderpriority END AS package_option_text,
  total AS package_price_with_discount, card_name AS name, '' AS broken
FROM c WHERE o_orderstatus <> 'P'
UNION ALL
SELECT o_orderkey, o_custkey + 1, o_orderstatus, CAST(NULL AS BIGINT), card_name, ''
FROM c WHERE o_orderstatus <> 'P'""",
    "flatten_search": """SELECT c_custkey AS appid, coalesce(nullif(c_name, 'Customer#000000007'), '') AS name
FROM customer""",
    "flatten_keyed": """SELECT c_custkey AS appid, c_name AS name, c_mktsegment AS developer,
  CAST(NULL AS VARCHAR) AS publisher, CAST(NULL AS BIGINT) AS score_rank,
  CAST(c_nationkey AS BIGINT) AS positive, CAST(NULL AS BIGINT) AS negative,
  CAST(NULL AS BIGINT) AS userscore, CAST(NULL AS VARCHAR) AS owners, CAST(NULL AS DOUBLE) AS price,
  CAST(NULL AS DOUBLE) AS initialprice, CAST(NULL AS DOUBLE) AS discount,
  CASE WHEN c_nationkey >= 5 THEN CAST(7 AS BIGINT) END AS ccu, '' AS broken
FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "page_coverage": f"""WITH {_HOURS},
expected AS (SELECT walk, CAST(h * 100 AS BIGINT) AS "offset" FROM walks, range(0, (SELECT last + 1 FROM hours)) t(h))
SELECT walk, "offset" FROM expected EXCEPT SELECT walk, "offset" FROM landed""",
    "bounded_coverage": f"""WITH {_HOURS},
expected AS (SELECT walk, CAST(h * 100 AS BIGINT) AS "offset" FROM walks, range(0, 72) t(h))
SELECT walk, "offset" FROM expected EXCEPT SELECT walk, "offset" FROM landed""",
    "empty_runs": """WITH m AS (
  SELECT user_id AS walk, CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS BIGINT) AS page,
         count(*) FILTER (WHERE event_type = 'purchase') AS n
  FROM events GROUP BY ALL),
e AS (SELECT walk, page, page - row_number() OVER (PARTITION BY walk ORDER BY page) AS g FROM m WHERE n = 0)
SELECT walk, min(page) AS first, max(page) AS last, max(page) - min(page) + 1 AS length
FROM e GROUP BY walk, g""",
    "page_truncation": """WITH m AS (
  SELECT user_id AS walk, CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS BIGINT) AS page,
         count(*) FILTER (WHERE event_type = 'purchase') AS n
  FROM events GROUP BY ALL),
e AS (SELECT walk, page - row_number() OVER (PARTITION BY walk ORDER BY page) AS g FROM m WHERE n = 0),
r AS (SELECT walk, max(c) AS longest FROM (SELECT walk, g, count(*) AS c FROM e GROUP BY ALL) GROUP BY walk),
w AS (SELECT walk, count(*) AS pages, max(page) AS last_page FROM m GROUP BY walk)
SELECT w.walk, pages, last_page, coalesce(longest, 0) AS longest_empty_run,
       last_page >= 29 AND coalesce(longest, 0) < 3 AS truncated
FROM w LEFT JOIN r ON r.walk = w.walk""",
    "fan_out_load": f"""WITH {_CARD_PARTS}, good AS (SELECT * FROM c WHERE o_orderstatus <> 'P')
SELECT 'cards' AS table_name, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS id_sum FROM c
UNION ALL SELECT 'prices', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM good WHERE card_name IS NOT NULL
UNION ALL SELECT 'packages', 2 * count(*), CAST(2 * sum(o_orderkey) AS BIGINT) FROM good""",
    "gated_loads": """WITH RECURSIVE y AS (
  SELECT yr, n, row_number() OVER (ORDER BY yr) AS nth FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM orders GROUP BY ALL)),
gate(yr, nth, n, stored, last_n) AS (
  SELECT yr, nth, n, true, n FROM y WHERE nth = 1
  UNION ALL
  SELECT y.yr, y.nth, y.n, greatest(y.n, last_n) / least(y.n, last_n) - 1 <= 0.5,
         CASE WHEN greatest(y.n, last_n) / least(y.n, last_n) - 1 <= 0.5 THEN y.n ELSE last_n END
  FROM gate JOIN y ON y.nth = gate.nth + 1)
SELECT make_timestamp(yr, 12, 31, 0, 30, 0) AS last_update, n AS n_rows,
       'row_count' AS metrics_name, CAST(n AS DOUBLE) AS metrics_value
FROM gate WHERE stored""",
    "staged_portions": """SELECT event_type AS name, count(*) AS n_rows, CAST(sum(user_id) AS BIGINT) AS id_sum
FROM events GROUP BY event_type""",
    "schema_drift": "SELECT 'name' AS column_name, 'string' AS expected, CAST(NULL AS VARCHAR) AS actual",
    "altered_column": """SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN '' ELSE l_linestatus END AS name,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS load_month, count(*) AS n_rows
FROM lineitem GROUP BY ALL""",
    "incremental_load": f"""WITH {_DAILY}
SELECT appid, name, row_hash, last_update FROM raw_daily
QUALIFY row_number() OVER (
  PARTITION BY appid, row_hash, CAST(last_update AS DATE) ORDER BY last_update, event_id) = 1""",
    "stored_failures": """SELECT 'id_not_null' AS test_name, 'pass' AS status, CAST(0 AS BIGINT) AS failures
UNION ALL SELECT 'segment_not_null', CASE WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END, count(*)
  FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'events_fresh', CASE WHEN abs(DATE '2024-02-05' - max(CAST(ts AS DATE))) > 1 THEN 'error' ELSE 'pass' END,
  CASE WHEN abs(DATE '2024-02-05' - max(CAST(ts AS DATE))) > 1 THEN 1 ELSE 0 END FROM events""",
    "resumed_load": """WITH rows AS (
  SELECT o_orderpriority AS name, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS price FROM orders)
SELECT name, CAST(count(*) AS DOUBLE) AS n_rows, CAST(sum(price) AS DOUBLE) AS total FROM rows GROUP BY name
UNION ALL SELECT 'row_count', 1.0, count(*) FROM rows
UNION ALL SELECT unnest(['price_initial', 'price_final']), 1.0, median(price) FROM rows
UNION ALL SELECT 'discount_percent', 1.0, 0.0
UNION ALL SELECT 'summary of ' || unnest(['price_initial', 'price_final', 'discount_percent']), 1.0, count(*) FROM rows""",
    "compaction_beside_append": f"""WITH {_CATALOG},
dated AS (SELECT *, CAST(date_trunc('month', last_update) AS DATE) AS load_month, appid % 5 = 0 AS late FROM raw_catalog),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY load_month, appid, row_hash ORDER BY last_update) AS nth FROM dated)
SELECT moment, load_month, count(*) AS n_rows, count(DISTINCT (appid, row_hash)) AS n_states, min(last_update) AS first_seen
FROM (SELECT unnest(['before', 'during', 'after', 'in the end']) AS moment), seen
WHERE (moment = 'before' AND NOT late) OR moment = 'during' OR (moment = 'after' AND (late OR nth = 1))
   OR (moment = 'in the end' AND nth = 1)
GROUP BY moment, load_month""",
    "span_medians": """WITH long AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS metrics_name,
         unnest([CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE), CAST(l_discount AS DOUBLE)]) AS v FROM lineitem)
SELECT year, metrics_name, count(v) AS n, round(median(v), 6) AS metrics_value, true AS held
FROM long GROUP BY year, metrics_name""",
    "clustered_reads": """WITH lines AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, l_orderkey FROM lineitem),
middle AS (SELECT min(l_partkey) + (max(l_partkey) - min(l_partkey)) // 2 AS part, min(day) + CAST((max(day) - min(day)) // 2 AS INTEGER) AS day FROM lines)
SELECT 'l_partkey' AS probe, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS order_sum, true AS few
FROM lines WHERE l_partkey = (SELECT part FROM middle)
UNION ALL SELECT 'day', count(*), CAST(sum(l_orderkey) AS BIGINT), true FROM lines WHERE day = (SELECT day FROM middle)""",
    "drift_of_files": """WITH months AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS load_month, count(*) AS n_rows FROM lineitem GROUP BY ALL)
SELECT load_month, n_rows,
       CASE WHEN year(load_month) < 1994 THEN 'name' WHEN year(load_month) < 1996 THEN 'packageid' WHEN year(load_month) = 1996 THEN 'appid' END AS column_name,
       CASE WHEN year(load_month) < 1994 THEN NULL WHEN year(load_month) < 1996 THEN 'int' WHEN year(load_month) = 1996 THEN 'string' END AS stored,
       CASE WHEN year(load_month) < 1994 THEN 'string' WHEN year(load_month) <= 1996 THEN 'bigint' END AS declared,
       CASE WHEN year(load_month) < 1994 THEN 'missing' WHEN year(load_month) < 1996 THEN 'widened' WHEN year(load_month) = 1996 THEN 'conflict' END AS verdict
FROM months""",
    "stateful_load": f"""WITH {_DAILY}
SELECT appid, name, row_hash, last_update FROM raw_daily
QUALIFY row_number() OVER (
  PARTITION BY appid, row_hash, CAST(last_update AS DATE) ORDER BY last_update, event_id) = 1""",
    "page_gaps": f"""WITH {_HOURS},
expected AS (SELECT walk, CAST(h * 100 AS BIGINT) AS "offset" FROM walks, range(0, (SELECT last + 1 FROM hours)) t(h)),
missing AS (SELECT walk, "offset" FROM expected EXCEPT SELECT walk, "offset" FROM landed),
grouped AS (SELECT *, "offset" // 100 - row_number() OVER (PARTITION BY walk ORDER BY "offset") AS g FROM missing)
SELECT walk, min("offset") AS first, max("offset") AS last, count(*) AS pages FROM grouped GROUP BY walk, g""",
    "view_of_compacted": f"""WITH {_DAILY}
SELECT appid, name, row_hash, last_update FROM raw_daily
QUALIFY row_number() OVER (
  PARTITION BY appid, row_hash, CAST(last_update AS DATE) ORDER BY last_update, event_id) = 1""",
    "drift_of_empty": """WITH m AS (
  SELECT user_id AS walk, CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS BIGINT) AS page,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS n
  FROM events GROUP BY ALL),
s AS (SELECT walk, page, n, lag(n) OVER (PARTITION BY walk ORDER BY page) AS o FROM m)
SELECT empty, walk, page, n AS new_value, o AS old_value,
       CASE WHEN empty = 'stops' AND n = 0 THEN 'error' WHEN o IS NULL OR o = 0 OR n = 0 THEN 'skip'
            WHEN greatest(n, o) / least(n, o) - 1 > 0.5 THEN 'error' WHEN greatest(n, o) / least(n, o) - 1 > 0.2 THEN 'warn'
            ELSE 'ok' END AS status
FROM (SELECT unnest(['passes', 'stops']) AS empty), s""",
}
