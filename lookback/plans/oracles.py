"""ANSI SQL for the registered queries, written against the tables directly.

The statements are independent of the operators: histories are counted with plain
interval conditions, never with the rollups and frames the operators use.
"""

from __future__ import annotations

from lookback.plans.rules import CATEGORIES

_CATEGORY = "list_extract([" + ", ".join(f"'{c}'" for c in CATEGORIES) + "], CAST(k % 7 + 1 AS INTEGER))"
_KNOWN = "value_prop IN (" + ", ".join(f"'{c}'" for c in CATEGORIES) + ")"

# The events with day, entity, position and amount; then the faulty variant.
_TYPED = f"""
ev AS (
  SELECT event_type, user_id, value, CAST(ts AS DATE) AS day,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
),
typed AS (
  SELECT event_type, day, user_id, {_CATEGORY} AS value_prop,
         CAST(k % 4 AS INTEGER) AS position, value AS total, k
  FROM ev
),
messy AS (
  SELECT event_type, day, user_id,
         CASE WHEN k >= 95 THEN NULL WHEN k >= 90 THEN 'other' ELSE value_prop END AS value_prop,
         CAST(k % 13 AS INTEGER) AS position, total - 5 AS total, k
  FROM typed
)"""

_KEY = "day, user_id, value_prop, position"

_TABLES = f"""{_TYPED},
prints AS (SELECT DISTINCT {_KEY} FROM typed WHERE event_type = 'view'),
taps AS (SELECT DISTINCT {_KEY} FROM typed WHERE event_type = 'click'),
pays AS (SELECT day, user_id, value_prop, total FROM typed WHERE event_type = 'purchase')"""

_LAST = "(SELECT max(day) FROM prints)"


def _features(name: str, last: str = _LAST, pays: str = "pays") -> str:
    """Feature CTE ``name`` over prints, taps and ``pays`` for the week up to ``last``."""

    def past(table: str, value: str) -> str:
        return (
            f"(SELECT {value} FROM {table} e WHERE e.user_id = s.user_id"
            " AND e.value_prop = s.value_prop AND e.day >= s.day - 21 AND e.day <= s.day - 1)"
        )

    count = "CAST(count(*) AS BIGINT)"
    amount = "coalesce(CAST(sum(CAST(round(total * 100) AS BIGINT)) AS DOUBLE) / 100, 0.0)"
    return f"""
{name}_raw AS (
  SELECT s.*,
    CASE WHEN EXISTS (SELECT 1 FROM taps c WHERE c.day = s.day AND c.user_id = s.user_id
                      AND c.value_prop = s.value_prop) THEN 1 ELSE 0 END AS clicked,
    {past("prints", count)} AS views_3w,
    {past("taps", count)} AS taps_3w,
    {past(pays, count)} AS pays_3w,
    {past(pays, amount)} AS amount_3w
  FROM (SELECT DISTINCT {_KEY} FROM prints WHERE day BETWEEN {last} - 6 AND {last}) s
),
{name} AS (
  SELECT {_KEY}, CAST(clicked AS INTEGER) AS clicked, views_3w, taps_3w, pays_3w, amount_3w,
    CASE WHEN views_3w > 0 THEN CAST(taps_3w AS DOUBLE) / views_3w ELSE 0.0 END AS ctr_3w,
    CASE WHEN pays_3w > 0 THEN amount_3w / pays_3w ELSE 0.0 END AS avg_ticket_3w
  FROM {name}_raw
)"""


_FEATURES = f"WITH {_TABLES}, {_features('f')} SELECT * FROM f"


def _audit_select(
    source: str, layer: str, table: str, checks: list[tuple[str, str, str]]
) -> str:
    """Audit rows of ``source``: (rule, action, predicate) each; NULL is a violation."""
    parts = [
        f"""SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS expectation,
  '{action}' AS action, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(sum(CASE WHEN ({predicate}) THEN 0 ELSE 1 END) AS BIGINT) AS failed_rows
FROM {source}"""
        for name, action, predicate in checks
    ]
    return (
        "SELECT *, CASE WHEN total_rows > 0 THEN CAST(failed_rows AS DOUBLE) / total_rows"
        " ELSE 0.0 END AS failure_rate, failed_rows = 0 AS passed FROM ("
        + "\nUNION ALL\n".join(parts)
        + ") checks"
    )


def _event_checks(soft: str = "warn") -> list[tuple[str, str, str]]:
    return [
        ("user_id_not_null", "fail", "user_id IS NOT NULL"),
        ("value_prop_not_null", "drop", "value_prop IS NOT NULL"),
        ("value_prop_known", soft, _KNOWN),
        ("day_not_null", "fail", "day IS NOT NULL"),
        ("day_not_future", "warn", "day <= DATE '2024-01-28'"),
        ("position_in_range", soft, "position BETWEEN 0 AND 10"),
    ]


_PAYMENT_CHECKS = [
    ("user_id_not_null", "fail", "user_id IS NOT NULL"),
    ("value_prop_not_null", "drop", "value_prop IS NOT NULL"),
    ("value_prop_known", "warn", _KNOWN),
    ("day_not_null", "fail", "day IS NOT NULL"),
    ("total_non_negative", "drop", "total >= 0"),
]

_FEATURE_CHECKS = [
    ("clicked_binary", "fail", "clicked IN (0, 1)"),
    ("counts_non_negative", "fail", "views_3w >= 0 AND taps_3w >= 0 AND pays_3w >= 0"),
    ("amount_non_negative", "fail", "amount_3w >= 0"),
    ("amount_matches_pays", "warn", "pays_3w > 0 OR (pays_3w = 0 AND amount_3w = 0)"),
    ("ctr_bounded", "warn", "ctr_3w BETWEEN 0 AND 1"),
    (
        "pk_complete",
        "fail",
        "day IS NOT NULL AND user_id IS NOT NULL AND value_prop IS NOT NULL"
        " AND position IS NOT NULL",
    ),
]

_VIEWS = "(SELECT * FROM messy WHERE event_type = 'view') v"
_CLICKS = "(SELECT * FROM messy WHERE event_type = 'click') c"
_PURCHASES = "(SELECT * FROM messy WHERE event_type = 'purchase') p"


def _history() -> str:
    """One audit run per event day over the faulty impressions."""
    parts = [
        f"""SELECT day AS checked_on, 'silver' AS layer, 'prints' AS table_name,
  '{name}' AS expectation, '{action}' AS action, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(sum(CASE WHEN ({predicate}) THEN 0 ELSE 1 END) AS BIGINT) AS failed_rows
FROM messy WHERE event_type = 'view' GROUP BY day"""
        for name, action, predicate in _event_checks()
    ]
    return (
        f"{_TYPED}, history AS (SELECT *, CAST(failed_rows AS DOUBLE) / total_rows AS failure_rate,"
        " failed_rows = 0 AS passed FROM (" + "\nUNION ALL\n".join(parts) + ") h),"
        " latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY layer,"
        " table_name, expectation ORDER BY checked_on DESC) AS rn FROM history) r WHERE rn = 1)"
    )


_HISTORY = _history()

# The rows that survive ingest and the drop rules of the layered job.
_JOB_TABLES = f"""{_TYPED},
prints AS (SELECT DISTINCT {_KEY} FROM messy WHERE event_type = 'view' AND value_prop IS NOT NULL),
taps AS (SELECT DISTINCT {_KEY} FROM messy WHERE event_type = 'click' AND value_prop IS NOT NULL),
pays AS (SELECT day, user_id, value_prop, total FROM messy
         WHERE event_type = 'purchase' AND value_prop IS NOT NULL AND total >= 0)"""

_ORDERS_90D = """
WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
)
SELECT a.o_orderkey, a.o_custkey, a.day,
  CAST(count(b.o_orderkey) AS BIGINT) AS orders_90d,
  coalesce(CAST(sum(CAST(round(b.o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100, 0.0) AS spent_90d
FROM o a LEFT JOIN o b
  ON b.o_custkey = a.o_custkey AND b.day BETWEEN a.day - 90 AND a.day - 1
GROUP BY a.o_orderkey, a.o_custkey, a.day"""

_SPLIT_BUCKET = (
    "CAST('0x' || substr(md5(concat_ws('|', '42', CAST(day AS VARCHAR),"
    " CAST(user_id AS VARCHAR), value_prop, CAST(position AS VARCHAR))), 1, 8) AS BIGINT) % 100"
)

_LABELLED = f"""labelled AS (
  SELECT p.*, CAST(CASE WHEN EXISTS (SELECT 1 FROM taps t WHERE t.day = p.day
    AND t.user_id = p.user_id AND t.value_prop = p.value_prop) THEN 1 ELSE 0 END AS INTEGER) AS clicked
  FROM prints p
)"""

# Purchases count as often as they occur, the other two once per key.
_UNION = """
SELECT user_id, value_prop, day AS ev_day,
  CASE event_type WHEN 'view' THEN 'print' WHEN 'click' THEN 'tap' ELSE 'pay' END AS etype,
  CASE WHEN event_type = 'purchase' THEN total ELSE 0.0 END AS amount
FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, day, user_id, value_prop, position) AS copy
  FROM typed
) t
WHERE event_type = 'purchase' OR (event_type IN ('view', 'click') AND copy = 1)"""


ORACLES: dict[str, str] = {
    "ingest_jsonl_typed": f"""WITH {_TYPED}
SELECT CASE WHEN k = 99 THEN NULL WHEN k >= 95 THEN 'not-a-day' ELSE CAST(day AS VARCHAR) END AS day,
  CASE WHEN k = 99 THEN NULL ELSE position END AS position,
  CASE WHEN k = 99 THEN NULL ELSE value_prop END AS value_prop,
  CASE WHEN k = 99 THEN NULL ELSE user_id END AS user_id
FROM typed WHERE event_type = 'view'""",
    "ingest_csv_typed": f"""WITH {_TYPED}
SELECT CAST(day AS VARCHAR) AS pay_date, CASE WHEN k >= 95 THEN NULL ELSE total END AS total,
  user_id, value_prop
FROM typed WHERE event_type = 'purchase'""",
    "ingest_csv_by_name": f"""WITH {_TYPED}
SELECT value_prop, user_id, CASE WHEN k >= 95 THEN NULL ELSE total END AS total,
  CAST(day AS VARCHAR) AS pay_date
FROM typed WHERE event_type = 'purchase'""",
    "ingest_lineage": f"""WITH {_TYPED}
SELECT CASE event_type WHEN 'view' THEN 'prints.json' WHEN 'click' THEN 'taps.json' ELSE 'pays.csv' END
  AS source, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS stamped
FROM typed WHERE event_type IN ('view', 'click', 'purchase') GROUP BY event_type""",
    "ingest_stream_available_now": f"""WITH {_TYPED}
SELECT {_KEY} FROM typed WHERE event_type = 'view'""",
    "ingest_stream_late_files": f"""WITH {_TYPED}
SELECT {_KEY} FROM typed WHERE event_type = 'view'""",
    "ingest_stream_csv": f"""WITH {_TYPED}
SELECT day, user_id, value_prop, total FROM typed WHERE event_type = 'purchase'""",
    "conform_flatten_cast": f"""WITH {_TYPED}
SELECT {_KEY} FROM typed WHERE event_type = 'view' AND k < 95""",
    "conform_dedup_set": f"WITH {_TABLES} SELECT * FROM prints",
    "conform_payments_bag": f"WITH {_TABLES} SELECT * FROM pays",
    "scalar_expressions": f"""WITH {_TYPED}
SELECT user_id, CASE WHEN k < 90 THEN day END AS parsed_day, CASE WHEN k < 95 THEN k END AS parsed_k,
  CASE WHEN k % 5 > 0 THEN total / (k % 5) ELSE 0.0 END AS ratio,
  CASE WHEN total > 50 THEN 'high' ELSE 'low' END AS band,
  round(total * 10, 0) AS tenths, day - 21 AS window_start,
  'k=' || CAST(k AS VARCHAR) AS tag, total AS exact_total
FROM typed WHERE event_type = 'purchase'""",
    "bounds_serving_window": f"""WITH {_TABLES}
SELECT * FROM prints WHERE day >= {_LAST} - 6""",
    "event_union": f"WITH {_TABLES} {_UNION}",
    "event_daily_rollup": f"""WITH {_TABLES}, u AS ({_UNION})
SELECT user_id, value_prop, ev_day,
  CAST(sum(CASE WHEN etype = 'print' THEN 1 ELSE 0 END) AS BIGINT) AS views_3w,
  CAST(sum(CASE WHEN etype = 'tap' THEN 1 ELSE 0 END) AS BIGINT) AS taps_3w,
  CAST(sum(CASE WHEN etype = 'pay' THEN 1 ELSE 0 END) AS BIGINT) AS pays_3w,
  CAST(sum(CASE WHEN etype = 'pay' THEN CAST(round(amount * 100) AS BIGINT) END) AS DOUBLE) / 100
    AS amount_3w
FROM u GROUP BY user_id, value_prop, ev_day""",
    "label_lookup": f"WITH {_TABLES}, {_LABELLED} SELECT * FROM labelled",
    "click_features": _FEATURES,
    "click_features_join": _FEATURES,
    "click_features_binned": _FEATURES,
    "click_features_sql": _FEATURES,
    "pit_orders_90d": _ORDERS_90D,
    "pit_orders_90d_binned": _ORDERS_90D,
    "pit_foreign_spine": f"""WITH {_TABLES}
SELECT t.day, t.user_id, t.value_prop, t.position, CAST(count(p.day) AS BIGINT) AS pays_7d,
  coalesce(CAST(sum(CAST(round(p.total * 100) AS BIGINT)) AS DOUBLE) / 100, 0.0) AS amount_7d
FROM taps t LEFT JOIN pays p ON p.user_id = t.user_id AND p.value_prop = t.value_prop
  AND p.day BETWEEN t.day - 7 AND t.day - 1
GROUP BY t.day, t.user_id, t.value_prop, t.position""",
    "pit_event_log": f"""WITH {_TYPED}, ids AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'
)
SELECT s.event_id, s.user_id, s.day,
  {', '.join(
    f"CAST(coalesce(sum(CASE WHEN e.event_type = '{t}' THEN 1 END), 0) AS BIGINT) AS {t}s_7d"
    for t in ('view', 'click', 'purchase', 'error', 'signup')
  )},
  coalesce(CAST(sum(CASE WHEN e.event_type = 'purchase' THEN CAST(round(e.value * 100) AS BIGINT)
    END) AS DOUBLE) / 100, 0.0) AS spent_7d
FROM ids s LEFT JOIN ev e ON e.user_id = s.user_id AND e.day BETWEEN s.day - 7 AND s.day - 1
GROUP BY s.event_id, s.user_id, s.day""",
    "band_join_keyless": f"""WITH {_TABLES}, u AS ({_UNION}),
daily AS (SELECT ev_day, sum(CASE WHEN etype = 'print' THEN 1 ELSE 0 END) AS views,
  sum(CASE WHEN etype = 'tap' THEN 1 ELSE 0 END) AS taps FROM u GROUP BY ev_day)
SELECT a.ev_day AS day, CAST(count(*) AS BIGINT) AS days_before,
  CAST(sum(b.views) AS BIGINT) AS views, CAST(sum(b.taps) AS BIGINT) AS taps
FROM daily a JOIN daily b ON b.ev_day BETWEEN a.ev_day - 21 AND a.ev_day - 1
GROUP BY a.ev_day""",
    "topk_features": f"""{_FEATURES}
ORDER BY views_3w DESC, {_KEY} LIMIT 10""",
    "preview_sorted": f"WITH {_TABLES} SELECT * FROM prints ORDER BY {_KEY} LIMIT 5",
    "dq_events": f"WITH {_TYPED} {_audit_select(_VIEWS, 'silver', 'prints', _event_checks())}",
    "dq_events_strict": f"WITH {_TYPED} {_audit_select(_CLICKS, 'silver', 'taps', _event_checks('drop'))}",
    "dq_payments": f"WITH {_TYPED} {_audit_select(_PURCHASES, 'silver', 'pays', _PAYMENT_CHECKS)}",
    "dq_payments_nan": f"WITH {_TYPED} "
    + _audit_select(
        "(SELECT * REPLACE (CASE WHEN k % 10 = 3 THEN NULL ELSE total END AS total)"
        " FROM messy WHERE event_type = 'purchase') p",
        "silver",
        "pays",
        _PAYMENT_CHECKS,
    ),
    "dq_features": f"""WITH {_TABLES}, {_features('f')}
{_audit_select('f', 'gold', 'click_features', _FEATURE_CHECKS)}""",
    "dq_declared": f"WITH {_TYPED} "
    + _audit_select(
        _PURCHASES,
        "silver",
        "pays",
        [
            ("user_id_not_null", "fail", "user_id IS NOT NULL"),
            ("total_non_negative", "drop", "total >= 0"),
            ("total_moderate", "drop", "total < 100"),
            ("value_prop_known", "warn", _KNOWN),
        ],
    ),
    "dq_drop": f"""WITH {_TYPED}
SELECT day, user_id, value_prop, position, total FROM messy
WHERE event_type = 'purchase' AND value_prop IS NOT NULL AND total >= 0""",
    "dq_quarantine": f"""WITH {_TYPED}
SELECT day, user_id, value_prop, position, total FROM messy
WHERE event_type = 'purchase' AND (value_prop IS NULL OR total < 0)""",
    "dq_pk_unique": f"""WITH {_TYPED}, groups AS (
  SELECT count(*) AS n FROM messy WHERE event_type = 'view' GROUP BY {_KEY}
)
SELECT 'silver' AS layer, 'prints' AS table_name, 'pk_unique' AS expectation, 'fail' AS action,
  CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS failed_rows,
  CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS failure_rate, sum(n - 1) = 0 AS passed
FROM groups""",
    "dq_constraints": f"""WITH {_TABLES}, {_features('f')}
{_audit_select('f', 'gold', 'click_features', [
    ("day_not_null", "fail", "day IS NOT NULL"),
    ("user_id_not_null", "fail", "user_id IS NOT NULL"),
    ("value_prop_not_null", "fail", "value_prop IS NOT NULL"),
    ("position_not_null", "fail", "position IS NOT NULL"),
    ("clicked_binary", "fail", "clicked IN (0, 1)"),
])}
UNION ALL
SELECT 'gold', 'click_features', 'pk_unique', 'fail', CAST(sum(n) AS BIGINT),
  CAST(sum(n - 1) AS BIGINT), CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE), sum(n - 1) = 0
FROM (SELECT count(*) AS n FROM f GROUP BY {_KEY}) uniq""",
    "dq_history": f"WITH {_HISTORY} SELECT * FROM history",
    "dq_latest": f"""WITH {_HISTORY}
SELECT layer, table_name, expectation, action, total_rows, failed_rows,
  round(failure_rate * 100, 2) AS failure_pct, passed, checked_on FROM latest""",
    "dq_latest_view": f"""WITH {_HISTORY}
SELECT table_name, expectation, action, failed_rows, round(failure_rate * 100, 2) AS failure_pct
FROM latest WHERE NOT passed OR action = 'fail'""",
    "dq_latest_report": f"""WITH {_HISTORY}
SELECT CAST(checked_on AS VARCHAR) AS run_id, layer, table_name, expectation, action, total_rows,
  failed_rows, failure_rate, passed, checked_on
FROM latest ORDER BY layer, table_name, expectation""",
    "dq_trend": f"""WITH {_HISTORY}
SELECT checked_on, CAST(checked_on AS VARCHAR) AS run_id, layer, table_name,
  round(avg(failure_rate) * 100, 3) AS avg_failure_pct
FROM history GROUP BY checked_on, layer, table_name ORDER BY checked_on""",
    "dq_gate": f"""WITH {_HISTORY}
SELECT CASE WHEN sum(CASE WHEN action = 'fail' AND NOT passed THEN 1 ELSE 0 END) > 0
  THEN error('critical rules violated') ELSE 'DQ OK' END AS dq_gate
FROM history WHERE checked_on = (SELECT max(checked_on) FROM history)""",
    "dq_breaches": f"""WITH {_TYPED}, a AS (
{_audit_select(_VIEWS, 'silver', 'prints', [(n, 'fail', p) for n, _, p in _event_checks()])}
)
SELECT layer, table_name, expectation, action, total_rows, failed_rows,
  round(failure_rate * 100, 2) AS failure_pct, passed FROM a WHERE NOT passed""",
    "dq_alerts": f"""WITH {_HISTORY}, v AS (
  SELECT 'dq_critical_failures' AS alert,
    CAST(sum(CASE WHEN action = 'fail' AND NOT passed THEN 1 ELSE 0 END) AS DOUBLE) AS value,
    CAST(0 AS DOUBLE) AS threshold FROM latest
  UNION ALL
  SELECT 'dq_failure_rate', max(round(failure_rate * 100, 2)), CAST(1 AS DOUBLE) FROM latest
)
SELECT alert, value, threshold, value > threshold AS triggered FROM v""",
    "publish_partition_overwrite": f"""WITH {_TABLES}, {_features('f')}
SELECT {_KEY}, clicked, CAST(views_3w + CASE WHEN day = {_LAST} THEN 100 ELSE 0 END AS BIGINT) AS views_3w,
  taps_3w, pays_3w, amount_3w, ctr_3w, avg_ticket_3w FROM f""",
    "publish_clustered": f"WITH {_TABLES} SELECT * FROM pays",
    "publish_append_evolve": f"""WITH {_TABLES}
SELECT *, CASE WHEN day >= DATE '2024-01-16' THEN 'EUR' END AS currency FROM pays""",
    "publish_table_append_evolve": f"""WITH {_TABLES}
SELECT *, CASE WHEN day >= DATE '2024-01-16' THEN 'EUR' END AS currency FROM pays""",
    "publish_table_overwrite": f"WITH {_TABLES} SELECT * FROM prints",
    "audit_log_append": f"""WITH {_TYPED}
{_audit_select(_VIEWS, 'silver', 'prints', _event_checks())}
UNION ALL
{_audit_select(_CLICKS, 'silver', 'taps', _event_checks())}""",
    "feature_snapshot_diff": f"""WITH {_TABLES},
early AS (SELECT * FROM pays WHERE total <= 50),
{_features('a', f'({_LAST} - 1)', 'early')},
{_features('b')},
gone AS (SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.day = a.day
  AND b.user_id = a.user_id AND b.value_prop = a.value_prop AND b.position = a.position)),
came AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.day = a.day
  AND b.user_id = a.user_id AND b.value_prop = a.value_prop AND b.position = a.position)),
stay AS (SELECT {_KEY} FROM a INTERSECT SELECT {_KEY} FROM b),
pre AS (SELECT a.* FROM a JOIN stay USING ({_KEY}) EXCEPT SELECT * FROM b),
post AS (SELECT b.* FROM b JOIN stay USING ({_KEY}) EXCEPT SELECT * FROM a)
SELECT 'delete' AS _change_type, * FROM gone
UNION ALL SELECT 'insert', * FROM came
UNION ALL SELECT 'update_pre', * FROM pre
UNION ALL SELECT 'update_post', * FROM post""",
    "training_set": f"""WITH {_TABLES}, {_LABELLED}, {_features('f')}
SELECT l.day, l.user_id, l.value_prop, l.position, l.clicked, f.views_3w, f.taps_3w, f.pays_3w,
  f.amount_3w, f.ctr_3w, f.avg_ticket_3w
FROM labelled l LEFT JOIN f ON f.day = l.day AND f.user_id = l.user_id
  AND f.value_prop = l.value_prop AND f.position = l.position""",
    "train_test_split_hash": f"""WITH {_TABLES}, {_LABELLED}
SELECT CASE WHEN {_SPLIT_BUCKET} < 80 THEN 'train' ELSE 'test' END AS side, day,
  CAST(count(*) AS BIGINT) AS n, CAST(sum(clicked) AS BIGINT) AS clicked
FROM labelled GROUP BY 1, 2""",
    "feature_auc": f"""WITH {_TABLES}, {_features('f')},
scores AS (
  SELECT ctr_3w, sum(clicked) AS p, sum(1 - clicked) AS n FROM f GROUP BY ctr_3w
),
below AS (
  SELECT p, n, coalesce(sum(n) OVER (ORDER BY ctr_3w ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS n_below FROM scores
)
SELECT round(CAST(sum(p * (n_below + n / 2.0)) AS DOUBLE) / CAST(sum(p) * sum(n) AS DOUBLE), 6) AS auc
FROM below""",
    "click_model_scores": f"""WITH {_TABLES}, {_features('f')}
SELECT {_KEY}, true AS is_probability, true AS is_consistent FROM f WHERE {_SPLIT_BUCKET} >= 80""",
    "click_model_auc": f"""WITH {_TABLES}, {_features('f')}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(clicked) AS BIGINT) AS clicked, true AS is_rank_sum
FROM f WHERE {_SPLIT_BUCKET} >= 80""",
    "category_index": f"""WITH {_TABLES}, ranked AS (
  SELECT value_prop, row_number() OVER (ORDER BY count(*) DESC, value_prop) - 1 AS category
  FROM prints GROUP BY value_prop
)
SELECT {_KEY}, category, [CAST(position AS BIGINT), category] AS vector
FROM prints JOIN ranked USING (value_prop)""",
    "layered_features": f"WITH {_JOB_TABLES}, {_features('f')} SELECT * FROM f",
    "layered_audit": f"""WITH {_JOB_TABLES}, {_features('f')},
uniq AS (SELECT count(*) AS n FROM f GROUP BY {_KEY})
{_audit_select(_VIEWS, 'silver', 'prints', _event_checks())}
UNION ALL
{_audit_select(_CLICKS, 'silver', 'taps', _event_checks())}
UNION ALL
{_audit_select(_PURCHASES, 'silver', 'pays', _PAYMENT_CHECKS)}
UNION ALL
{_audit_select('f', 'gold', 'click_features', _FEATURE_CHECKS)}
UNION ALL
SELECT 'gold', 'click_features', 'pk_unique', 'fail', CAST(sum(n) AS BIGINT),
  CAST(sum(n - 1) AS BIGINT), CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE), sum(n - 1) = 0
FROM uniq""",
    "layered_quarantine": f"""WITH {_TYPED}
SELECT CASE event_type WHEN 'view' THEN 'prints' WHEN 'click' THEN 'taps' ELSE 'pays' END AS source,
  day, user_id, value_prop, CAST(count(*) AS DOUBLE) AS n, 2 AS runs
FROM messy
WHERE event_type IN ('view', 'click', 'purchase')
  AND (value_prop IS NULL OR (event_type = 'purchase' AND total < 0))
GROUP BY 1, 2, 3, 4""",
    "layered_alerts": f"""WITH {_JOB_TABLES}, {_features('f')}, a AS (
{_audit_select(_VIEWS, 'silver', 'prints', _event_checks())}
UNION ALL
{_audit_select(_CLICKS, 'silver', 'taps', _event_checks())}
UNION ALL
{_audit_select(_PURCHASES, 'silver', 'pays', _PAYMENT_CHECKS)}
UNION ALL
{_audit_select('f', 'gold', 'click_features', _FEATURE_CHECKS)}
)
SELECT 'dq_critical_failures' AS alert,
  CAST(sum(CASE WHEN action = 'fail' AND failed_rows > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS value,
  CAST(0 AS DOUBLE) AS threshold, sum(CASE WHEN action = 'fail' THEN failed_rows ELSE 0 END) > 0 AS triggered
FROM a
UNION ALL
SELECT 'dq_failure_rate', max(round(failure_rate * 100, 2)), CAST(1 AS DOUBLE),
  max(round(failure_rate * 100, 2)) > 1 FROM a""",
    **dict.fromkeys(
        ("ingest_rescued", "ingest_rescued_stream"),
        f"""WITH {_TYPED}
SELECT CASE WHEN k < 98 THEN CAST(day AS VARCHAR) END AS day, CASE WHEN k < 95 THEN position END AS position,
  CASE WHEN k < 97 THEN value_prop END AS value_prop,
  CASE WHEN k < 85 OR k BETWEEN 90 AND 97 THEN user_id END AS user_id,
  CASE WHEN k BETWEEN 80 AND 84 THEN '{{"id":' || k || '}}' END AS campaign,
  CASE WHEN k BETWEEN 90 AND 94 THEN '"s' || (k % 3) || '"' END AS slot,
  CASE WHEN k BETWEEN 85 AND 89 THEN '"u' || user_id || '"' END AS odd_user,
  CASE WHEN k BETWEEN 95 AND 96 THEN position || '.5' END AS odd_position,
  CASE WHEN k = 97 THEN '"none"' END AS odd_event,
  CASE WHEN k BETWEEN 80 AND 97 THEN 1 ELSE 0 END AS n_rescued,
  CASE WHEN k = 98 THEN '[1]' WHEN k = 99 THEN substr('{{"day":"' || day, 1, 15) END AS malformed
FROM typed WHERE event_type = 'view'""",
    ),
    "ingest_rescued_fields": f"""WITH {_TYPED}, odd AS (
  SELECT CASE WHEN k <= 84 THEN 'campaign' WHEN k <= 89 THEN 'user_id' WHEN k <= 94 THEN 'event_data.slot'
    WHEN k <= 96 THEN 'event_data.position' ELSE 'event_data' END AS path
  FROM typed WHERE event_type = 'view' AND k BETWEEN 80 AND 97
)
SELECT path, CAST(count(*) AS BIGINT) AS n_rows, CASE path WHEN 'campaign' THEN 'OBJECT<id: BIGINT>'
  WHEN 'event_data.position' THEN 'DECIMAL(2,1)' ELSE 'STRING' END AS inferred
FROM odd GROUP BY path""",
    "ingest_shared_sink": f"""WITH {_TYPED}
SELECT day, user_id, value_prop, position FROM typed WHERE event_type = 'view'""",
    "feature_changes_applied": _FEATURES,
    "changes_between_days": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CAST(CASE WHEN o_orderkey % 13 = 0 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH
    ELSE date_trunc('month', o_orderdate) END AS DATE) AS month
FROM orders WHERE o_orderkey % 11 <> 0""",
    "incremental_features": f"WITH {_JOB_TABLES}, {_features('f')} SELECT * FROM f",
    "publish_z_ordered": f"WITH {_TABLES} SELECT * FROM pays",
    "publish_compacted": f"WITH {_TABLES} SELECT * FROM pays",
    "publish_versions": f"""WITH {_TABLES}
SELECT day, total, 'before' AS seen FROM pays WHERE total > 50
UNION ALL SELECT day, total, 'after' FROM pays""",
    "quarantine_replay": f"""WITH {_TYPED}, pays AS (
  SELECT day, user_id, value_prop, total FROM messy WHERE event_type = 'purchase'
)
SELECT *, 'silver' AS place FROM pays WHERE value_prop IS NOT NULL AND total >= -2
UNION ALL
SELECT *, CASE WHEN value_prop IS NOT NULL AND total >= -2 THEN 'released' ELSE 'held' END FROM pays
WHERE value_prop IS NULL OR total < 0""",
    "lookup_few_keys": f"""WITH {_TABLES}, {_features('f')}
SELECT prints.*, views_3w, taps_3w, pays_3w, amount_3w, ctr_3w, avg_ticket_3w
FROM prints LEFT JOIN f USING (day, user_id, value_prop, position) WHERE user_id % 97 = 3""",
}
