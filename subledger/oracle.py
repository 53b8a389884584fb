"""DuckDB SQL that states, independently of the Spark plans, what every
registered query must return on the shared test tables.

The CTEs mirror the adapters in ``subledger.sources.adapters``: ``ev``/``evn``
(typed events), ``mk`` (dense daily spend), ``sub`` (clean subscriptions) and
the facts and dimensions built on them. Money is summed as DECIMAL(38,6) and
cast to DOUBLE, exactly as the Spark side does.
"""

from __future__ import annotations

NULL_LIKE = "('', 'none', 'nan', '<na>')"
DEC = "DECIMAL(38,6)"
SIGNED = (
    f"CASE WHEN event_type_norm = 'purchase' THEN COALESCE(CAST(amount_num AS {DEC}), 0) "
    f"ELSE -abs(COALESCE(CAST(amount_num AS {DEC}), 0)) END"
)

CTES: dict[str, str] = {
    "ev": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
          CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'login'
                          WHEN 'error' THEN 'refund' ELSE event_type END AS event_type,
          ts AS event_ts_utc, value AS amount_num,
          CASE WHEN event_type = 'signup' THEN 'ch' ||
            CAST(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR) END AS acquisition_channel
        FROM events""",
    "evn": f"""
        SELECT *, lower(trim(event_type)) AS event_type_norm,
          CASE WHEN lower(trim(user_id)) IN {NULL_LIKE} THEN NULL ELSE trim(user_id) END AS user_id_norm
        FROM ev""",
    # marketing: raw rows, good rows, dense grid
    "mraw": """
        SELECT CAST(o_orderdate AS DATE) AS date, 'ch' || CAST(o_orderkey % 5 AS VARCHAR) AS channel,
          CAST((o_totalprice - 5000) / 1000 AS DECIMAL(18,5)) AS spend5, o_orderkey
        FROM orders""",
    "mgood": f"SELECT date, channel, CAST(spend5 AS {DEC}) AS spend FROM mraw WHERE spend5 >= 0",
    "mb": "SELECT MIN(date) AS lo, MAX(date) AS hi FROM mgood",
    "mdays": "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM mb",
    "mch": "SELECT DISTINCT channel FROM mgood",
    "magg": "SELECT date, channel, SUM(spend) AS s FROM mgood GROUP BY date, channel",
    "mk": """
        SELECT d.date, c.channel, CAST(COALESCE(a.s, 0) AS DOUBLE) AS spend
        FROM mdays d CROSS JOIN mch c LEFT JOIN magg a ON a.date = d.date AND a.channel = c.channel""",
    # subscriptions
    "sraw": """
        SELECT CAST(o_orderkey AS VARCHAR) AS subscription_id, CAST(o_custkey AS VARCHAR) AS user_id,
          o_orderpriority AS plan_id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
          'USD' AS currency,
          CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' ELSE 'paused' END AS status,
          CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS created_at_ts,
          CAST(o_orderdate AS DATE) AS start_date,
          CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 365 AS INTEGER) END AS end_date,
          o_orderkey
        FROM orders""",
    "slag": """
        SELECT *, LAG(COALESCE(end_date, DATE '2100-01-01')) OVER (
            PARTITION BY user_id ORDER BY start_date, created_at_ts DESC, subscription_id) AS prev_end_eff
        FROM sraw""",
    "sflag": """
        SELECT *, CAST(datediff('day', prev_end_eff, start_date) - 1 AS INTEGER) AS gap_days,
          COALESCE(start_date <= prev_end_eff, false) AS is_overlap,
          COALESCE(datediff('day', prev_end_eff, start_date) - 1 > 0, false) AS reactivated
        FROM slag""",
    "sub": "SELECT * FROM sflag WHERE NOT is_overlap",
    # facts
    "dau": """
        SELECT CAST(event_ts_utc AS DATE) AS event_date, COUNT(DISTINCT user_id_norm) AS daily_active_users
        FROM evn WHERE user_id_norm IS NOT NULL AND event_type_norm IN ('login', 'page_view', 'purchase')
        GROUP BY 1""",
    "gross": f"""
        SELECT CAST(event_ts_utc AS DATE) AS event_date,
          CAST(SUM(COALESCE(CAST(amount_num AS {DEC}), 0)) AS DOUBLE) AS revenue_gross
        FROM evn WHERE event_type_norm = 'purchase' GROUP BY 1""",
    "net": f"""
        SELECT CAST(event_ts_utc AS DATE) AS event_date, CAST(SUM({SIGNED}) AS DOUBLE) AS revenue_net
        FROM evn WHERE event_type_norm IN ('purchase', 'refund') GROUP BY 1""",
    "ltv": f"""
        SELECT user_id_norm AS user_id, CAST(SUM({SIGNED}) AS DOUBLE) AS ltv
        FROM evn WHERE user_id_norm IS NOT NULL AND event_type_norm IN ('purchase', 'refund') GROUP BY 1""",
    "mb2": "SELECT MIN(start_date) AS lo, GREATEST(COALESCE(MAX(end_date), MAX(start_date)), MAX(start_date)) AS hi FROM sub",
    "sdays": "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM mb2",
    "mrr": f"""
        SELECT d.date, CAST(COALESCE(SUM(CAST(s.price AS {DEC})), 0) AS DOUBLE) AS mrr
        FROM sdays d LEFT JOIN sub s ON s.start_date <= d.date AND (s.end_date IS NULL OR s.end_date >= d.date)
        GROUP BY d.date""",
    "coh": """
        SELECT user_id_norm, CAST(date_trunc('week', MIN(event_ts_utc)) AS DATE) AS cohort_week
        FROM evn WHERE user_id_norm IS NOT NULL AND event_type_norm = 'signup' AND event_ts_utc IS NOT NULL
        GROUP BY 1""",
    "csize": "SELECT cohort_week, COUNT(*) AS cohort_size FROM coh GROUP BY 1",
    "act": """
        SELECT DISTINCT user_id_norm, CAST(date_trunc('week', event_ts_utc) AS DATE) AS activity_week
        FROM evn WHERE user_id_norm IS NOT NULL AND event_ts_utc IS NOT NULL
          AND event_type_norm IN ('login', 'page_view', 'purchase', 'trial_start', 'trial_convert')""",
    "actk": """
        SELECT cohort_week, week_index, COUNT(DISTINCT user_id_norm) AS active_users FROM (
          SELECT c.cohort_week, a.user_id_norm,
            CAST(floor(datediff('day', c.cohort_week, a.activity_week) / 7) AS INTEGER) AS week_index
          FROM act a JOIN coh c USING (user_id_norm)) t
        WHERE week_index >= 0 GROUP BY 1, 2""",
    "ret": """
        SELECT k.cohort_week, k.week_index, k.active_users, s.cohort_size,
          k.active_users / s.cohort_size AS retention_rate
        FROM actk k LEFT JOIN csize s USING (cohort_week)""",
    "sfirst": f"""
        SELECT user_id_norm, channel FROM (
          SELECT user_id_norm,
            COALESCE(CASE WHEN lower(trim(acquisition_channel)) IN {NULL_LIKE} THEN NULL
                          ELSE trim(acquisition_channel) END, 'Unknown') AS channel,
            ROW_NUMBER() OVER (PARTITION BY user_id_norm ORDER BY event_ts_utc, event_id) AS rn
          FROM evn WHERE user_id_norm IS NOT NULL AND event_type_norm = 'signup' AND event_ts_utc IS NOT NULL) t
        WHERE rn = 1""",
    "conv": """
        SELECT COALESCE(f.channel, 'Unknown') AS channel, COUNT(*) AS paid_conversions
        FROM (SELECT DISTINCT user_id_norm FROM evn
              WHERE user_id_norm IS NOT NULL AND event_type_norm = 'purchase') p
        LEFT JOIN sfirst f USING (user_id_norm) GROUP BY 1""",
    "spend": f"SELECT channel, CAST(SUM(CAST(spend AS {DEC})) AS DOUBLE) AS total_spend FROM mk GROUP BY 1",
    "cac": """
        SELECT sp.channel, sp.total_spend, CAST(COALESCE(c.paid_conversions, 0) AS BIGINT) AS paid_conversions,
          CASE WHEN COALESCE(c.paid_conversions, 0) > 0 THEN sp.total_spend / c.paid_conversions END AS cac
        FROM spend sp LEFT JOIN conv c USING (channel)""",
    "rtot": f"""
        SELECT CAST(COALESCE((SELECT SUM(CAST(ltv AS {DEC})) FROM ltv), 0) AS DOUBLE) AS total_ltv,
          CAST(COALESCE((SELECT SUM(CAST(spend AS {DEC})) FROM mk), 0) AS DOUBLE) AS total_spend,
          (SELECT COUNT(DISTINCT user_id_norm) FROM evn
           WHERE user_id_norm IS NOT NULL AND event_type_norm = 'purchase') AS paid_conversions""",
    "ratio": """
        SELECT total_ltv, total_spend, paid_conversions,
          CASE WHEN paid_conversions > 0 THEN total_spend / paid_conversions END AS cac_overall,
          CASE WHEN paid_conversions > 0 AND total_spend <> 0
               THEN total_ltv / (total_spend / paid_conversions) END AS ltv_cac_ratio
        FROM rtot""",
    # dimensions
    "ddates": """
        SELECT CAST(event_ts_utc AS DATE) AS date FROM evn UNION SELECT date FROM mk
        UNION SELECT start_date FROM sub UNION SELECT end_date FROM sub""",
    "dim_date": """
        SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
          CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) - 1 AS INTEGER) AS weekday,
          CAST(date_trunc('week', date) AS DATE) AS week_start_monday
        FROM ddates WHERE date IS NOT NULL""",
    "dim_channel": "SELECT DISTINCT channel FROM mk",
    "dim_plan": "SELECT DISTINCT plan_id, price, currency FROM sub",
    "dim_user": f"""
        SELECT user_id, MIN(CASE WHEN event_type = 'signup' THEN acquisition_channel END) AS acquisition_channel
        FROM ev WHERE user_id IS NOT NULL AND lower(trim(user_id)) NOT IN {NULL_LIKE} GROUP BY user_id""",
}


def with_ctes(select: str, replaced: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with every CTE it (transitively) needs, in order; those
    ``replaced`` stand for the ones of that name."""
    ctes = {**CTES, **(replaced or {})}
    names = list(ctes)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in needed and _mentions(text, n):
                needed.add(n)
                visit(ctes[n])

    visit(select)
    ordered = [n for n in names if n in needed]
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in ordered) + "\n" + select


def _mentions(text: str, name: str) -> bool:
    import re

    return re.search(rf"(?<![\w.']){re.escape(name)}(?![\w'])", text) is not None
