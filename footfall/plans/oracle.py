"""Independent SQL for the catalogue, written from the meaning of each query.

Sets are intersected and windows run over plain rows here, where the Spark
operators use rollups; the two forms share no shortcuts.
"""

from __future__ import annotations

_EVENTS = """
events_log AS (
  SELECT event_id, user_id,
         CAST(props->>'$.k' AS INTEGER) AS item_id,
         CAST(CAST(props->>'$.k' AS INTEGER) // 10 AS INTEGER) AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart'
              WHEN 'signup' THEN 'fav' WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "timestamp",
         CAST(epoch_us(ts) AS BIGINT) AS ts_us,
         CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour
  FROM events)"""

_ORDERS = """
orders_log AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS category_id,
         CASE l_returnflag || l_linestatus WHEN 'NO' THEN 'cart' WHEN 'RF' THEN 'fav'
              WHEN 'RO' THEN 'buy' ELSE 'pv' END AS behavior,
         CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) AS "timestamp",
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_RFM = """
rfm0 AS (
  SELECT user_id,
         CAST(date_diff('day', max(date), (SELECT max(date) FROM events_log)) AS INTEGER)
           AS recency,
         count(*) AS frequency
  FROM events_log WHERE behavior = 'buy' GROUP BY user_id),
rfm1 AS (
  SELECT *,
         CAST(CASE WHEN recency <= 1 THEN 5 WHEN recency <= 3 THEN 4 WHEN recency <= 5 THEN 3
              WHEN recency <= 7 THEN 2 ELSE 1 END AS INTEGER) AS r_score,
         CAST(CASE WHEN frequency <= 1 THEN 1 WHEN frequency <= 2 THEN 2
              WHEN frequency <= 4 THEN 3 WHEN frequency <= 9 THEN 4 ELSE 5 END AS INTEGER)
           AS f_score
  FROM rfm0),
rfm2 AS (
  SELECT *, round(r_score * CAST(0.4 AS DOUBLE) + f_score * CAST(0.6 AS DOUBLE), 2)
           AS total_score
  FROM rfm1),
rfm AS (
  SELECT *, CASE WHEN total_score >= 4.0 THEN '高价值用户' WHEN total_score >= 3.0 THEN '潜力用户'
              WHEN total_score >= 2.0 THEN '一般用户' WHEN total_score >= 1.4 THEN '预流失用户'
              ELSE '流失用户' END AS user_segment
  FROM rfm2)"""


def _rate(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN round(CAST({part} AS DOUBLE) / {whole} * 100, 2) "
        "ELSE CAST(0 AS DOUBLE) END"
    )


def _sessions(gap_minutes: int) -> str:
    gap = gap_minutes * 60 * 1000000
    return f"""
stepped AS (
  SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY user_id ORDER BY ts_us, event_id) AS idle
  FROM events_log),
numbered AS (
  SELECT *, sum(CASE WHEN idle IS NULL OR idle > {gap} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts_us, event_id
                    ROWS UNBOUNDED PRECEDING) AS k
  FROM stepped),
labelled AS (
  SELECT *, user_id || '_' || CAST(k AS BIGINT) AS session_id FROM numbered),
rolled AS (
  SELECT session_id, count(*) AS session_length, count(DISTINCT behavior) AS unique_behaviors
  FROM labelled GROUP BY session_id)"""


def _events(query: str, *more: str) -> str:
    return "WITH " + ",".join((_EVENTS, *more)) + "\n" + query


def _orders(query: str, *more: str) -> str:
    return "WITH " + ",".join((_ORDERS, *more)) + "\n" + query


def _uv(behaviors: str) -> str:
    return f"count(DISTINCT CASE WHEN behavior IN ({behaviors}) THEN user_id END)"


def _rows(behavior: str) -> str:
    return f"count(CASE WHEN behavior = '{behavior}' THEN 1 END)"


def _activity(log: str, keys: str, viewers: bool = True, where: str = "true") -> str:
    pv_uv = f"{_uv(repr('pv'))} AS pv_uv," if viewers else ""
    return f"""
  SELECT *, {_rate('buy_uv', 'interest_uv')} AS cvr FROM (
    SELECT {keys}, {_rows('pv')} AS pv, {_rows('fav')} AS fav, {_rows('cart')} AS cart,
           {_rows('buy')} AS buy, count(*) AS total, {pv_uv}
           {_uv("'pv', 'cart', 'fav'")} AS interest_uv, {_uv("'buy'")} AS buy_uv
    FROM {log} WHERE {where} GROUP BY {keys})"""


def _cvr(key: str) -> str:
    return f"""
  SELECT *, {_rate('buy', 'interest_uv')} AS pv_to_buy_rate FROM (
    SELECT *, pv + cart + fav AS interest_uv FROM (
      SELECT {key}, {_uv("'pv'")} AS pv, {_uv("'fav'")} AS fav, {_uv("'cart'")} AS cart,
             {_uv("'buy'")} AS buy, count(DISTINCT user_id) AS total_uv
      FROM orders_log GROUP BY {key}))"""


_ITEM_BASE = f"base AS (SELECT * FROM ({_cvr('item_id')}) WHERE interest_uv >= 25)"

_FIRSTS = """
firsts AS (SELECT user_id, min(date) AS first_date FROM events_log GROUP BY user_id),
days AS (SELECT DISTINCT user_id, date FROM events_log)"""


def _retention(where: str = "true") -> str:
    columns, joins = [], []
    for n in (1, 3, 7):
        columns.append(
            f"coalesce(r{n}.n, 0) AS retained_day{n}, "
            f"coalesce(round(CAST(r{n}.n AS DOUBLE) / c.new_users * 100, 2), 0.0) "
            f"AS retention_rate_day{n}"
        )
        joins.append(f"""
    LEFT JOIN (SELECT f.first_date, count(DISTINCT d.user_id) AS n
               FROM days d JOIN firsts f ON d.user_id = f.user_id
               WHERE d.date - f.first_date = {n} GROUP BY f.first_date) r{n}
      ON r{n}.first_date = c.first_date""")
    return _events(
        f"""SELECT c.first_date, c.new_users, {', '.join(columns)}
  FROM (SELECT first_date, count(*) AS new_users FROM firsts GROUP BY first_date) c
  {''.join(joins)} WHERE {where.replace('first_date', 'c.first_date')}""",
        _FIRSTS,
    )


_LIFECYCLE = f"""
lifecycle AS (
  SELECT *, total_users - new_users AS returning_users,
         {_rate('new_users', 'total_users')} AS new_user_ratio
  FROM (SELECT d.date, count(*) AS total_users,
               count(CASE WHEN d.date = f.first_date THEN 1 END) AS new_users
        FROM days d JOIN firsts f ON d.user_id = f.user_id GROUP BY d.date))"""

_DAILY = """
daily AS (
  SELECT date, count(DISTINCT user_id) AS uv,
         count(CASE WHEN behavior = 'pv' THEN 1 END) AS pv, count(*) AS total_behavior
  FROM events_log GROUP BY date)"""

_DISTRIBUTION = """
distribution AS (
  SELECT behavior, count(*) AS count,
         round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events_log) * 100, 2)
           AS percentage
  FROM events_log GROUP BY behavior)"""

_DETAIL_COLUMNS = "user_id, recency, frequency, r_score, f_score, total_score, user_segment"


def _purchase_gap(negative: str) -> str:
    return _events(
        f"""SELECT CASE WHEN gap = 0 THEN '当天购买' {negative} WHEN gap <= 1 THEN '1天内'
              WHEN gap <= 3 THEN '2-3天' WHEN gap <= 7 THEN '4-7天' ELSE '7天以上' END
              AS gap_group, count(*) AS user_count
  FROM (SELECT b.d - v.d AS gap
        FROM (SELECT user_id, min(date) d FROM events_log WHERE behavior = 'pv' GROUP BY 1) v
        JOIN (SELECT user_id, min(date) d FROM events_log WHERE behavior = 'buy' GROUP BY 1) b
          ON v.user_id = b.user_id)
  GROUP BY 1"""
    )


def _paths(steps: int, gap_minutes: int) -> str:
    over = "OVER (PARTITION BY session_id ORDER BY ts_us, event_id)"
    if steps == 2:
        text, name, count, need = "p1 || ' → ' || behavior", "path_segment", "path_count", "p1"
    else:
        text, name, count, need = "p2 || ' → ' || p1 || ' → ' || behavior", "path3", "count", "p2"
    return _events(
        f"""SELECT {text} AS {name}, count(*) AS {count}
  FROM (SELECT behavior, lag(behavior) {over} AS p1, lag(behavior, 2) {over} AS p2
        FROM labelled) WHERE {need} IS NOT NULL GROUP BY 1""",
        _sessions(gap_minutes),
    )


def _stats(gap_minutes: int) -> str:
    return _events(
        f"""SELECT 'total_sessions' AS metric, CAST(count(*) AS DOUBLE) AS value FROM rolled
  UNION ALL SELECT 'avg_session_length', round(avg(session_length), 2) FROM rolled
  UNION ALL SELECT 'gap_minutes', CAST({gap_minutes} AS DOUBLE)""",
        _sessions(gap_minutes),
    )


_STAGES = """
v AS (SELECT DISTINCT user_id FROM events_log WHERE behavior = 'pv'),
i AS (SELECT user_id FROM v INTERSECT
      SELECT user_id FROM events_log WHERE behavior IN ('cart', 'fav')),
b AS (SELECT user_id FROM i INTERSECT SELECT user_id FROM events_log WHERE behavior = 'buy'),
n AS (SELECT (SELECT count(*) FROM v) AS a1, (SELECT count(*) FROM i) AS a2,
             (SELECT count(*) FROM b) AS a3)"""


def _funnel(detail: bool) -> str:
    def step(expression: str) -> str:
        return f", {expression} AS step_conversion_rate" if detail else ""

    hundred = "CAST(100 AS DOUBLE)"
    return _events(
        f"""SELECT '浏览(pv)' AS stage, a1 AS user_count, {hundred} AS conversion_rate
         {step(hundred)} FROM n
  UNION ALL SELECT '加购/收藏(cart+fav)', a2, {_rate('a2', 'a1')} {step(_rate('a2', 'a1'))} FROM n
  UNION ALL SELECT '购买(buy)', a3, {_rate('a3', 'a1')} {step(_rate('a3', 'a2'))} FROM n""",
        _STAGES,
    )


def _overview(where: str = "true") -> str:
    return _events(
        f"""SELECT total_behavior, uv, pv, buy, {_rate('buy', 'interested')} AS cvr
  FROM (SELECT count(*) AS total_behavior, count(DISTINCT user_id) AS uv,
               {_uv("'pv'")} AS pv, {_uv("'buy'")} AS buy,
               {_uv("'pv', 'cart', 'fav'")} AS interested
        FROM events_log WHERE {where})"""
    )


def _segment(select: str, segment: str = "潜力用户", tail: str = "") -> str:
    return _events(
        f"""SELECT {select} FROM events_log
  WHERE user_id IN (SELECT user_id FROM rfm WHERE user_segment = '{segment}')
  GROUP BY ALL {tail}""",
        _RFM,
    )


_RAW = """CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id,
  CAST(category_id AS BIGINT) AS category_id, behavior,
  CAST("timestamp" AS BIGINT) AS "timestamp\""""

_LOCAL = "(TIMESTAMP '1970-01-01 08:00:00' + to_seconds(\"timestamp\"))"
_TIME_FIELDS = f"""CAST("timestamp" AS BIGINT) * 1000000 AS ts_us,
  strftime({_LOCAL}, '%Y-%m-%d %H:%M:%S') AS datetime,
  CAST(hour({_LOCAL}) AS INTEGER) AS hour, CAST({_LOCAL} AS DATE) AS date"""

_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM events"
    for c in ("event_id", "ts", "user_id", "event_type", "props")
) + (
    " UNION ALL SELECT 'value', count(CASE WHEN value IS NULL OR isnan(value) THEN 1 END)"
    " FROM events"
)


def _without_view(keys: tuple[str, ...]) -> str:
    same = " AND ".join(f"v.{k} = b.{k}" for k in keys)
    return _events(
        f"""SELECT purchases, without_view, {_rate('without_view', 'purchases')} AS share
  FROM (SELECT (SELECT count(*) FROM events_log WHERE behavior = 'buy') AS purchases,
               (SELECT count(*) FROM events_log b WHERE b.behavior = 'buy' AND NOT EXISTS
                  (SELECT 1 FROM events_log v WHERE v.behavior = 'pv' AND {same}))
                 AS without_view)"""
    )


_REPEATING = """CAST(item_id AS BIGINT) AS item_id, CAST(category_id AS BIGINT) AS category_id,
  behavior, CAST("timestamp" AS BIGINT) AS "timestamp\""""
_BROKEN = """
broken AS (
  SELECT CASE WHEN item_id % 10 = 0 THEN NULL ELSE user_id END AS user_id,
         item_id, category_id, behavior, "timestamp" FROM events_log)"""


def _report(rows: str, columns: str, start: int, end: int) -> str:
    inside = f'"timestamp" BETWEEN {start} AND {end}'
    broken = " OR ".join(f"{c} IS NULL" for c in columns.split(", "))
    return f"""SELECT raw_rows, malformed_rows, out_of_range_rows,
         raw_rows - out_of_range_rows - kept_rows AS duplicate_rows, kept_rows
  FROM (SELECT (SELECT count(*) FROM {rows}) AS raw_rows,
               (SELECT count(*) FROM {rows} WHERE {broken}) AS malformed_rows,
               (SELECT count(*) FROM {rows} WHERE ({inside}) IS NOT TRUE) AS out_of_range_rows,
               (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {rows} WHERE {inside}))
                 AS kept_rows)"""


_ALL_RAW = 'user_id, item_id, category_id, behavior, "timestamp"'
_FOUR = 'item_id, category_id, behavior, "timestamp"'
_ITEMS = """CAST(row_number() OVER (PARTITION BY category_id ORDER BY total DESC, item_id)
                AS INTEGER) AS rank"""
_WIDE = (
    _RFM.replace(
        "recency <= 1 THEN 5 WHEN recency <= 3 THEN 4 WHEN recency <= 5 THEN 3\n"
        "              WHEN recency <= 7 THEN 2",
        "recency <= 0 THEN 5 WHEN recency <= 1 THEN 4 WHEN recency <= 3 THEN 3\n"
        "              WHEN recency <= 5 THEN 2",
    )
    .replace("frequency <= 1 THEN 1", "frequency <= 9 THEN 1")
    .replace("frequency <= 2 THEN 2", "frequency <= 12 THEN 2")
    .replace("frequency <= 4 THEN 3", "frequency <= 15 THEN 3")
    .replace("WHEN frequency <= 9 THEN 4", "WHEN frequency <= 18 THEN 4")
)

ORACLE: dict[str, str] = {
    "clean_dedup_items": _orders(f"SELECT DISTINCT {_REPEATING} FROM orders_log"),
    "clean_report": _events(_report("events_log", _ALL_RAW, 1704672000, 1705449599)),
    "clean_report_items": _orders(_report("orders_log", _FOUR, 820454400, 946684799)),
    "clean_report_csv": _events(_report("broken", _ALL_RAW, 1704672000, 1705449599), _BROKEN),
    "quality_nulls_csv": _events(
        " UNION ALL ".join(
            f"SELECT '{c.strip(chr(34))}' AS column_name, count(*) - count({c}) AS null_count"
            " FROM broken"
            for c in _ALL_RAW.split(", ")
        ),
        _BROKEN,
    ),
    "quality_duplicates_items": _orders(
        f"""SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows
  FROM (SELECT (SELECT count(*) FROM orders_log) AS total_rows,
               (SELECT count(*) FROM (SELECT DISTINCT {_FOUR} FROM orders_log))
                 AS distinct_rows)"""
    ),
    "rfm_segments_wide": _events(
        "SELECT user_segment, count(*) AS user_count FROM rfm GROUP BY 1", _WIDE
    ),
    "session_stats_plain_log": _stats(30),
    "active_days_wide": _events(
        """SELECT CASE WHEN d <= 10 THEN '1-10' WHEN d <= 14 THEN '11-14' WHEN d <= 18 THEN '15-18'
              ELSE 'more than 18' END AS active_group, count(*) AS user_count
  FROM (SELECT user_id, count(DISTINCT date) AS d FROM events_log GROUP BY 1) GROUP BY 1"""
    ),
    "category_hot_rank_few": _orders(
        f"""SELECT category_id, {_rows('pv')} AS pv, {_rows('fav')} AS fav,
         {_rows('cart')} AS cart, {_rows('buy')} AS buy, count(*) AS total
  FROM orders_log GROUP BY category_id ORDER BY total DESC, category_id LIMIT 5"""
    ),
    "cohort_date_filter": _retention(
        "first_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-16'"
    ),
    "category_stats_in_dates": _events(
        _activity(
            "events_log",
            "category_id",
            where="date BETWEEN DATE '2024-01-08' AND DATE '2024-01-16'",
        )
    ),
    "item_summary_in_dates": _events(
        f"""SELECT CAST(42 AS INTEGER) AS item_id, uv, {_rate('buyers', 'interested')} AS cvr
  FROM (SELECT {_uv("'pv'")} AS uv, {_uv("'pv', 'cart', 'fav'")} AS interested,
               {_uv("'buy'")} AS buyers FROM events_log
        WHERE item_id = 42 AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-16')"""
    ),
    "segment_hourly_in_dates": _segment("hour, count(*) AS behavior_count").replace(
        "GROUP BY ALL", "AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-16' GROUP BY ALL"
    ),
    "segment_top_categories_few": _segment(
        "category_id, count(*) AS behavior_count, count(DISTINCT user_id) AS user_count",
        tail="ORDER BY behavior_count DESC, category_id LIMIT 5",
    ),
    "category_details_few": _orders(
        _activity("orders_log", "category_id") + " ORDER BY total DESC, category_id LIMIT 5"
    ),
    "category_items_nested": _orders(
        f"""SELECT category_id, string_agg(concat_ws(':', rank, item_id, pv, fav, cart, buy, total,
         interest_uv, buy_uv, CAST(round(cvr * 100) AS BIGINT)), ',' ORDER BY rank) AS items
  FROM (SELECT *, {_ITEMS} FROM ({_activity('orders_log', 'category_id, item_id', viewers=False)}))
  WHERE rank <= 20 GROUP BY category_id"""
    ),
    "ingest_csv_scan": _events(f"SELECT {_RAW} FROM events_log"),
    "clean_time_range": _events(
        f'SELECT {_RAW} FROM events_log WHERE "timestamp" BETWEEN 1704672000 AND 1705449599'
    ),
    "clean_dedup": _orders(f"SELECT DISTINCT {_RAW} FROM orders_log"),
    "clean_time_fields": _events(f"SELECT {_RAW}, {_TIME_FIELDS} FROM events_log"),
    "clean_roundtrip": _events(
        f"""SELECT {_RAW}, {_TIME_FIELDS} FROM
  (SELECT DISTINCT {_RAW} FROM events_log
   WHERE "timestamp" BETWEEN 1704672000 AND 1705449599)"""
    ),
    "result_roundtrip": _events("SELECT * FROM daily", _DAILY),
    "quality_report": _events(
        """SELECT count(*) AS total_rows,
  count(CASE WHEN "timestamp" NOT BETWEEN 1704672000 AND 1705449599 THEN 1 END)
    AS out_of_range_count FROM events_log"""
    ),
    "quality_nulls": _NULLS,
    "quality_enum": _events(
        """SELECT behavior, count(*) AS n, behavior IN ('pv', 'cart', 'fav', 'buy') AS is_valid
  FROM events_log GROUP BY behavior"""
    ),
    "quality_duplicates": _orders(
        f"""SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows
  FROM (SELECT (SELECT count(*) FROM orders_log) AS total_rows,
               (SELECT count(*) FROM (SELECT DISTINCT {_RAW} FROM orders_log))
                 AS distinct_rows)"""
    ),
    "daily_uv_pv": _events("SELECT * FROM daily", _DAILY),
    "retention": _retention(),
    "rfm_detail": _events(f"SELECT {_DETAIL_COLUMNS} FROM rfm", _RFM),
    "rfm_detail_roundtrip": _events(f"SELECT {_DETAIL_COLUMNS} FROM rfm", _RFM),
    "rfm_segments": _events(
        "SELECT user_segment, count(*) AS user_count FROM rfm GROUP BY 1", _RFM
    ),
    "rfm_score_distribution": _events(
        "SELECT total_score, count(*) AS user_count FROM rfm GROUP BY 1", _RFM
    ),
    "sessions_labelled": _events(
        'SELECT event_id, user_id, behavior, "timestamp", ts_us, session_id FROM labelled',
        _sessions(30),
    ),
    "session_rollup": _events("SELECT * FROM rolled", _sessions(30)),
    "session_stats": _stats(30),
    "session_stats_long_gap": _stats(360),
    "session_length_distribution": _events(
        "SELECT session_length, count(*) AS session_count FROM rolled GROUP BY 1", _sessions(30)
    ),
    "behavior_paths": _paths(2, 30),
    "behavior_paths_long_gap": _paths(2, 360),
    "behavior_paths_3step": _paths(3, 30),
    "behavior_paths_3step_long_gap": _paths(3, 360),
    "user_lifecycle": _events("SELECT * FROM lifecycle", _FIRSTS, _LIFECYCLE),
    "first_purchase_gap": _purchase_gap(""),
    "first_purchase_gap_split": _purchase_gap("WHEN gap < 0 THEN '先购后看'"),
    "active_days_distribution": _events(
        """SELECT CASE WHEN d = 1 THEN '仅1天' WHEN d <= 3 THEN '2-3天' WHEN d <= 5 THEN '4-5天'
              WHEN d <= 7 THEN '6-7天' ELSE '8-9天' END AS active_group, count(*) AS user_count
  FROM (SELECT user_id, count(DISTINCT date) AS d FROM events_log GROUP BY 1) GROUP BY 1"""
    ),
    "hourly_cvr": _events(
        f"""SELECT *, {_rate('buy_count', 'pv_count')} AS pv_to_buy_rate,
         {_rate('buy_uv', 'pv_uv')} AS uv_cvr
  FROM (SELECT hour, {_rows('pv')} AS pv_count, {_rows('buy')} AS buy_count,
               {_uv("'pv'")} AS pv_uv, {_uv("'buy'")} AS buy_uv, count(*) AS total_behavior
        FROM events_log GROUP BY hour)"""
    ),
    "weekday_vs_weekend": _events(
        f"""SELECT *, CAST(round_even(total_behavior / days, 0) AS BIGINT) AS daily_avg_behavior,
         {_rate('buy', 'pv')} AS buy_rate
  FROM (SELECT CASE WHEN dayofweek(date) IN (0, 6) THEN '周末' ELSE '工作日' END AS type,
               count(DISTINCT date) AS days, count(*) AS total_behavior,
               count(DISTINCT user_id) AS uv, {_rows('pv')} AS pv, {_rows('buy')} AS buy
        FROM events_log GROUP BY 1)"""
    ),
    "daily_funnel_trend": _events(
        f"""SELECT *, {_rate('interest_uv', 'pv_uv')} AS pv_to_interest_rate,
         {_rate('buy_uv', 'interest_uv')} AS interest_to_buy_rate,
         {_rate('buy_uv', 'pv_uv')} AS overall_cvr
  FROM (SELECT v.date, count(*) AS pv_uv, count(i.user_id) AS interest_uv,
               count(b.user_id) AS buy_uv
        FROM (SELECT DISTINCT date, user_id FROM events_log WHERE behavior = 'pv') v
        LEFT JOIN (SELECT DISTINCT date, user_id FROM events_log
                   WHERE behavior IN ('cart', 'fav')) i
          ON v.date = i.date AND v.user_id = i.user_id
        LEFT JOIN (SELECT DISTINCT date, user_id FROM events_log WHERE behavior = 'buy') b
          ON i.date = b.date AND i.user_id = b.user_id
        GROUP BY v.date)"""
    ),
    "item_hot_rank": _orders(
        f"""SELECT item_id, {_rows('pv')} AS pv, {_rows('fav')} AS fav, {_rows('cart')} AS cart,
         {_rows('buy')} AS buy, count(*) AS total
  FROM orders_log GROUP BY item_id ORDER BY total DESC, item_id LIMIT 50"""
    ),
    "category_hot_rank": _orders(
        f"""SELECT category_id, {_rows('pv')} AS pv, {_rows('fav')} AS fav,
         {_rows('cart')} AS cart, {_rows('buy')} AS buy, count(*) AS total
  FROM orders_log GROUP BY category_id ORDER BY total DESC, category_id LIMIT 30"""
    ),
    "item_cvr_base": _orders("SELECT * FROM base", _ITEM_BASE),
    "item_cvr_top": _orders(
        "SELECT * FROM base ORDER BY pv_to_buy_rate DESC, item_id LIMIT 50", _ITEM_BASE
    ),
    "item_low_cvr": _orders(
        """SELECT * FROM base WHERE pv >= (SELECT quantile_disc(pv, 0.8) FROM base)
  ORDER BY pv_to_buy_rate, item_id LIMIT 50""",
        _ITEM_BASE,
    ),
    "category_cvr": _orders(_cvr("category_id")),
    "conversion_funnel": _funnel(detail=False),
    "conversion_funnel_detail": _funnel(detail=True),
    "behavior_distribution": _events("SELECT * FROM distribution", _DISTRIBUTION),
    "available_dates": _events("SELECT DISTINCT date FROM events_log"),
    "result_date_filter": _events(
        "SELECT * FROM lifecycle WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-16'",
        _FIRSTS,
        _LIFECYCLE,
    ),
    "overview": _overview(),
    "overview_in_dates": _overview("date BETWEEN DATE '2024-01-08' AND DATE '2024-01-16'"),
    "category_stats": _orders(_activity("orders_log", "category_id")),
    "category_items_lookup": _orders(
        _activity("orders_log", "item_id", viewers=False, where="category_id = 3")
        + " ORDER BY total DESC, item_id LIMIT 20"
    ),
    "item_behavior_stats": _events(
        "SELECT behavior, count(*) AS count FROM events_log WHERE item_id = 42 GROUP BY 1"
    ),
    "item_daily_trend": _events(
        """SELECT date, behavior, count(*) AS count FROM events_log
  WHERE item_id = 42 GROUP BY ALL"""
    ),
    "item_hourly_dist": _events(
        "SELECT hour, count(*) AS count FROM events_log WHERE item_id = 42 GROUP BY 1"
    ),
    "item_summary": _events(
        f"""SELECT CAST(42 AS INTEGER) AS item_id, uv, {_rate('buyers', 'interested')} AS cvr
  FROM (SELECT {_uv("'pv'")} AS uv, {_uv("'pv', 'cart', 'fav'")} AS interested,
               {_uv("'buy'")} AS buyers FROM events_log WHERE item_id = 42)"""
    ),
    "segments": _events("SELECT user_segment, count(*) AS user_count FROM rfm GROUP BY 1", _RFM),
    "segment_hourly": _segment("hour, count(*) AS behavior_count"),
    "segment_top_categories": _segment(
        "category_id, count(*) AS behavior_count, count(DISTINCT user_id) AS user_count",
        tail="ORDER BY behavior_count DESC, category_id LIMIT 20",
    ),
    "segment_behavior_dist": _segment("behavior, count(*) AS count"),
    "segment_user_count": _events(
        """SELECT '潜力用户' AS user_segment, count(*) AS user_count
  FROM rfm WHERE user_segment = '潜力用户'""",
        _RFM,
    ),
    "batch_lookup": _orders(
        f"""SELECT 'item' AS kind, CAST(item_id AS BIGINT) AS id, * EXCLUDE (item_id)
  FROM ({_activity('orders_log', 'item_id')})
  UNION ALL SELECT 'category', CAST(category_id AS BIGINT), * EXCLUDE (category_id)
  FROM ({_activity('orders_log', 'category_id')})"""
    ),
    "item_details": _orders(
        _activity("orders_log", "item_id") + " ORDER BY total DESC, item_id LIMIT 200"
    ),
    "category_details": _orders(
        _activity("orders_log", "category_id") + " ORDER BY total DESC, category_id LIMIT 100"
    ),
    "category_items": _orders(
        f"""SELECT *, CAST(row_number() OVER (PARTITION BY category_id
                     ORDER BY total DESC, item_id) AS INTEGER) AS rank
  FROM ({_activity('orders_log', 'category_id, item_id', viewers=False)})
  QUALIFY rank <= 20"""
    ),
    "kpi_summary": _events(
        f"""SELECT *, {_rate('total_buy', 'total_pv')} AS avg_cvr
  FROM (SELECT CAST(sum(total_behavior) AS BIGINT) AS total_records, max(uv) AS total_uv,
               CAST(sum(pv) AS BIGINT) AS total_pv,
               (SELECT count(*) FROM events_log WHERE behavior = 'buy') AS total_buy
        FROM daily)""",
        _DAILY,
    ),
    "behavior_share": _events(
        "SELECT * FROM distribution WHERE behavior = 'buy'", _DISTRIBUTION
    ),
    "high_value_hourly": _segment("hour, count(*) AS behavior_count", "高价值用户"),
    "purchases_without_view": _without_view(("user_id", "date")),
    "purchases_without_item_view": _without_view(("user_id", "item_id", "date")),
    "buyers_without_view": _orders(
        f"""SELECT *, {_rate('without_view', 'buyers')} AS share
  FROM (SELECT b.item_id, count(*) AS buyers, count(*) - count(v.user_id) AS without_view
        FROM (SELECT DISTINCT item_id, user_id FROM orders_log WHERE behavior = 'buy') b
        LEFT JOIN (SELECT DISTINCT item_id, user_id FROM orders_log WHERE behavior = 'pv') v
          ON b.item_id = v.item_id AND b.user_id = v.user_id
        GROUP BY b.item_id)"""
    ),
    "cvr_over_100": _orders("SELECT * FROM base WHERE pv_to_buy_rate > 100", _ITEM_BASE),
    "cvr_over_threshold": _orders("SELECT * FROM base WHERE pv_to_buy_rate > 40", _ITEM_BASE),
    "behavior_level_cvr": _events(
        f"""SELECT *, {_rate('buy', 'pv')} AS cvr
  FROM (SELECT {_rows('pv')} AS pv, {_rows('buy')} AS buy FROM events_log)"""
    ),
}

TOP_5000 = ORACLE["category_items"].replace("rank <= 20", "rank <= 5000")

_UTC = _TIME_FIELDS.replace("TIMESTAMP '1970-01-01 08:00:00'", "TIMESTAMP '1970-01-01 00:00:00'")
ONE_DAY_AGAIN = _events(
    f"""SELECT {_RAW}, {_UTC} FROM
  (SELECT DISTINCT user_id, item_id, category_id, "timestamp",
          CASE WHEN date = DATE '2024-01-10' THEN behavior ELSE 'pv' END AS behavior
   FROM events_log WHERE "timestamp" BETWEEN 1704672000 AND 1705449599)"""
)
