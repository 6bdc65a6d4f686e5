"""Independent DuckDB SQL for every catalogued query (the correctness oracle).

Written from the operator semantics, not from the Spark code: keep-first
uses ``row_number``, the mode uses counts ranked by (count desc, plan),
whole days use microsecond differences. Every statement starts from the
raw test tables through the same fixture mapping (``sources/fixtures.py``).
"""
from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

CTES: dict[str, str] = {}
#: Steps that are computed once, however often a statement names them.
MATERIALISED: set[str] = set()

CTES["raw_users"] = """
    SELECT c_custkey AS user_id,
           TIMESTAMP '2023-11-01' + to_days(CAST((c_custkey * 37) % 90 AS INTEGER)) AS signup_date,
           CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE n_name END AS country
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL
    SELECT c_custkey,
           TIMESTAMP '2023-11-01' + to_days(CAST((c_custkey * 37) % 90 AS INTEGER)),
           CAST(NULL AS VARCHAR)
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_custkey % 100 = 3"""

CTES["raw_sessions_base"] = """
    SELECT e.event_id AS session_id,
           CASE WHEN e.event_id % 500 = 9 THEN NULL ELSE e.user_id END AS user_id,
           CASE WHEN e.event_id % 100 = 7 THEN NULL ELSE e.ts END AS session_time,
           CASE WHEN e.event_id % 20 = 3 THEN NULL ELSE e.value END AS duration
    FROM events e
    JOIN (SELECT DISTINCT user_id, signup_date FROM raw_users) u
      ON e.user_id = u.user_id AND e.ts >= u.signup_date"""

CTES["raw_sessions"] = """
    SELECT * FROM raw_sessions_base
    UNION ALL SELECT * FROM raw_sessions_base WHERE session_id % 200 = 11"""

CTES["raw_events_base"] = """
    SELECT event_id,
           CASE WHEN event_id % 500 = 9 THEN NULL ELSE user_id END AS user_id,
           event_id AS session_id,
           event_type,
           CASE WHEN event_id % 100 = 5 THEN NULL
                ELSE CASE CAST(json_extract(props, '$.k') AS INTEGER) % 6
                     WHEN 0 THEN 'billing' WHEN 1 THEN 'reports' WHEN 2 THEN 'dashboards'
                     WHEN 3 THEN 'collaboration' WHEN 4 THEN 'alerts' WHEN 5 THEN 'integrations'
                     END END AS feature,
           ts AS event_time
    FROM events"""

CTES["raw_events"] = """
    SELECT * FROM raw_events_base
    UNION ALL SELECT * FROM raw_events_base WHERE event_id % 200 = 11"""

CTES["raw_payments"] = """
    SELECT o_custkey AS user_id,
           CASE WHEN o_orderkey % 100 = 4 THEN upper(p) ELSE p END AS plan,
           CASE WHEN p = 'free' THEN 0.0 ELSE o_totalprice END AS revenue,
           CAST(o_orderdate AS TIMESTAMP) + INTERVAL 8218 DAY AS payment_date
    FROM (SELECT *, CASE o_orderpriority WHEN '5-LOW' THEN 'free'
                                          WHEN '4-NOT SPECIFIED' THEN 'starter'
                                          WHEN '3-MEDIUM' THEN 'growth'
                                          WHEN '2-HIGH' THEN 'growth'
                                          WHEN '1-URGENT' THEN 'enterprise' END AS p
          FROM orders) o
    WHERE o_custkey % 97 <> 5"""

CTES["c_users"] = """
    SELECT user_id, signup_date, COALESCE(country, 'Unknown') AS country
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                     ORDER BY signup_date NULLS LAST, country NULLS LAST) AS rn
          FROM raw_users) WHERE rn = 1"""

CTES["c_sessions_dedup"] = """
    SELECT session_id, user_id, session_time, duration
    FROM (SELECT *, row_number() OVER (PARTITION BY session_id
                     ORDER BY session_time NULLS LAST, duration NULLS LAST, user_id NULLS LAST) AS rn
          FROM raw_sessions) WHERE rn = 1 AND user_id IS NOT NULL"""

CTES["c_sessions"] = """
    SELECT session_id, user_id, session_time,
           COALESCE(duration, (SELECT median(duration) FROM c_sessions_dedup)) AS duration
    FROM c_sessions_dedup"""

CTES["c_events"] = """
    SELECT event_id, user_id, session_id, event_type, COALESCE(feature, 'unknown') AS feature, event_time
    FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                     ORDER BY event_time NULLS LAST, user_id NULLS LAST) AS rn
          FROM raw_events) WHERE rn = 1 AND user_id IS NOT NULL"""

CTES["c_payments"] = """
    SELECT user_id, lower(plan) AS plan, CAST(revenue AS DOUBLE) AS revenue, payment_date
    FROM raw_payments"""

CTES["sm"] = """
    SELECT user_id, count(session_id) AS sessions_total,
           avg(duration) AS avg_d,
           min(session_time) AS first_session, max(session_time) AS last_session
    FROM c_sessions GROUP BY user_id"""

CTES["plan_mode"] = """
    SELECT user_id, plan FROM (
        SELECT user_id, plan, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, plan) AS rn
        FROM (SELECT user_id, plan, count(*) AS n FROM c_payments
              WHERE plan IS NOT NULL GROUP BY user_id, plan)) WHERE rn = 1"""

CTES["pm"] = f"""
    SELECT p.user_id, COALESCE(sum(revenue), 0.0) AS payments_total,
           COALESCE(max(payment_date), TIMESTAMP '1970-01-01') AS last_payment,
           count(payment_date) AS payment_count
    FROM c_payments p WHERE p.user_id IS NOT NULL GROUP BY p.user_id"""

CTES["um_base"] = f"""
    SELECT u.user_id, u.signup_date, u.country,
           COALESCE(sm.sessions_total, 0) AS sessions_total,
           round(round(COALESCE(sm.avg_d, 0.0), 9), 2) AS avg_session_duration,
           sm.first_session, sm.last_session,
           COALESCE(datediff('microsecond', sm.first_session, sm.last_session) // 86400000000, 0)
               AS session_span_days,
           COALESCE(pm.payments_total, 0.0) AS payments_total,
           pm.last_payment,
           CASE WHEN pm.user_id IS NULL THEN 'free' ELSE COALESCE(plan_mode.plan, 'free') END AS plans,
           COALESCE(pm.payment_count, 0) AS payment_count,
           CASE WHEN pm.last_payment IS NULL THEN NULL
                ELSE greatest(datediff('microsecond', pm.last_payment, {AS_OF}) // 86400000000, 0)
           END AS days_since_last_payment
    FROM c_users u
    LEFT JOIN sm ON u.user_id = sm.user_id
    LEFT JOIN pm ON u.user_id = pm.user_id
    LEFT JOIN plan_mode ON u.user_id = plan_mode.user_id"""

CTES["um"] = """
    SELECT *,
           COALESCE(days_since_last_payment > 60, false) AND payment_count > 0 AS churn_flag,
           plans <> 'free' AS is_paid_user,
           least(1.0, payment_count / greatest(1, session_span_days + 1)) AS renewal_rate
    FROM um_base"""

CTES["user_day"] = """
    SELECT DISTINCT user_id, CAST(session_time AS DATE) AS date
    FROM c_sessions WHERE session_time IS NOT NULL"""

CTES["dau"] = """
    SELECT date, count(*) AS dau FROM user_day GROUP BY date"""

CTES["country_dau"] = """
    SELECT u.country, d.date, count(*) AS dau
    FROM user_day d JOIN c_users u ON d.user_id = u.user_id
    GROUP BY u.country, d.date"""


def half_even_rounding(sql: str) -> str:
    """Rewrite each ``round(x, d)`` to ``round_even(x * 10^d, 0) / 10^d``: the
    scaled half-to-even rounding of pandas/numpy, which DuckDB's ``round``
    (half away from zero) does not give on ties."""
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
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg, digits = sql[j + 6:comma], sql[comma + 1:k - 1].strip()
        scale = f"1e{int(digits)}"
        out.append(sql[i:j] + f"(round_even(({half_even_rounding(arg)}) * {scale}, 0) / {scale})")
        i = k


def with_ctes(final_sql: str) -> str:
    body = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in MATERIALISED else ''}({sql}\n)" for name, sql in CTES.items())
    return half_even_rounding(f"WITH RECURSIVE {body}\n{final_sql}")


ORACLE: dict[str, str] = {}
FINAL: dict[str, str] = {}


def oracle(name: str, final_sql: str) -> None:
    FINAL[name] = final_sql
    ORACLE[name] = with_ctes(final_sql)


# ---- cleaning and the metrics fold -----------------------------------------
oracle("clean_users", "SELECT * FROM c_users")
oracle("clean_sessions", "SELECT session_id, user_id, session_time, round(duration, 4) AS duration FROM c_sessions")
oracle("clean_events", "SELECT * FROM c_events")
oracle("clean_payments", "SELECT * FROM c_payments")
oracle("user_metrics_table", """
SELECT user_id, signup_date, country, sessions_total, round(avg_session_duration, 4) AS avg_session_duration,
       first_session, last_session, session_span_days, round(payments_total, 4) AS payments_total,
       last_payment, plans, payment_count, days_since_last_payment, churn_flag, is_paid_user,
       round(renewal_rate, 4) AS renewal_rate
FROM um""")

# ---- SQL library ------------------------------
oracle("sql_dau", """
SELECT CAST(date_trunc('day', session_time) AS DATE) AS activity_date, COUNT(DISTINCT user_id) AS dau
FROM c_sessions WHERE session_time IS NOT NULL GROUP BY activity_date ORDER BY activity_date""")
oracle("sql_mau", """
SELECT CAST(date_trunc('month', session_time) AS DATE) AS activity_month, COUNT(DISTINCT user_id) AS mau
FROM c_sessions GROUP BY activity_month ORDER BY activity_month NULLS LAST""")
oracle("sql_retention_4w", """
SELECT week AS cohort_week, count(*) AS new_users,
       count(*) FILTER (WHERE seen < week + INTERVAL 35 DAY) AS retained_4w
FROM (SELECT CAST(date_trunc('week', u.signup_date) AS DATE) AS week,
             (SELECT min(s.session_time) FROM c_sessions s WHERE s.user_id = u.user_id) AS seen
      FROM c_users u)
WHERE seen IS NOT NULL GROUP BY week ORDER BY week""")
oracle("sql_funnel", f"""
SELECT count(*) AS signups,
       count(*) FILTER (WHERE user_id IN (SELECT user_id FROM c_sessions WHERE session_time >= {AS_OF} - INTERVAL 30 DAY))
         + (SELECT count(DISTINCT user_id) FROM c_sessions WHERE session_time >= {AS_OF} - INTERVAL 30 DAY
              AND user_id NOT IN (SELECT user_id FROM c_users)) AS active_last_30d,
       (SELECT count(*) FROM (SELECT user_id FROM c_payments GROUP BY user_id
          HAVING user_id IS NOT NULL AND bool_or(plan <> 'free' AND revenue > 0))) AS paid,
       (SELECT sum(CAST(churn_flag AS BIGINT))::BIGINT FROM um) AS churned
FROM c_users""")

# ---- activity, cohorts -------------------------------------------------------
oracle("user_day_rollup", "SELECT user_id, date FROM user_day")
CTES["weeks"] = """
    SELECT DISTINCT user_id, CAST(date_trunc('week', session_time) AS DATE) AS wk
    FROM c_sessions WHERE session_time IS NOT NULL"""
CTES["cohort_cells"] = """
    SELECT f.cohort_week, CAST((w.wk - f.cohort_week) // 7 AS INTEGER) AS week_offset, w.user_id
    FROM weeks w JOIN (SELECT user_id, min(wk) AS cohort_week FROM weeks GROUP BY user_id) f
      ON w.user_id = f.user_id"""
CTES["cohort_long"] = """
    SELECT cohort_week, week_offset, active_users,
           active_users / max(CASE WHEN week_offset = 0 THEN active_users END)
               OVER (PARTITION BY cohort_week) AS retention
    FROM (SELECT cohort_week, week_offset, count(DISTINCT user_id) AS active_users
          FROM cohort_cells WHERE week_offset >= 0 AND week_offset < 12
          GROUP BY cohort_week, week_offset)"""
oracle("cohort_retention_long",
       "SELECT cohort_week, week_offset, active_users, round(retention, 4) AS retention FROM cohort_long")
oracle("cohort_retention_wide", "SELECT cohort_week, " + ", ".join(
    f"round(COALESCE(max(CASE WHEN week_offset = {k} THEN retention END), 0.0), 4) AS w{k}"
    for k in range(12)) + " FROM cohort_long GROUP BY cohort_week")
oracle("latest_cohort", """
SELECT g.cohort_week, g.week_offset, round(COALESCE(l.retention, 0.0), 4) AS retention
FROM (SELECT max(cohort_week) AS cohort_week, CAST(unnest(range(0, 4)) AS INTEGER) AS week_offset
      FROM cohort_long) g
LEFT JOIN cohort_long l ON l.cohort_week = g.cohort_week AND l.week_offset = g.week_offset
WHERE g.cohort_week IS NOT NULL""")

# ---- KPI records -------------------------------------------------------------
oracle("conversion", """
SELECT count(*) AS total_users,
       count(DISTINCT CASE WHEN is_paid_user THEN user_id END) AS paid_users,
       CAST(printf('%.4f', count(DISTINCT CASE WHEN is_paid_user THEN user_id END) / greatest(count(*), 1)) AS DOUBLE)
           AS conversion_rate,
       CAST(printf('%.4f', count(DISTINCT CASE WHEN is_paid_user THEN user_id END)
            / greatest(count(CASE WHEN sessions_total > 5 THEN 1 END), 1)) AS DOUBLE) AS active_conversion_rate
FROM um""")
oracle("churn_summary", """
SELECT (SELECT round(avg(CAST(churn_flag AS INTEGER)), 4) FROM um) AS global_churn_rate,
       (SELECT COALESCE(string_agg(country, ',' ORDER BY n DESC, country), '') FROM (
            SELECT country, count(DISTINCT user_id) AS n FROM um WHERE churn_flag
            GROUP BY country ORDER BY n DESC, country LIMIT 3)) AS top_churn_countries""")
oracle("ltv", """
SELECT round(COALESCE(arpu, 0.0), 2) AS arpu, round(COALESCE(paid_arpu, 0.0), 2) AS paid_arpu,
       round(COALESCE(least(arpu / churn, arpu * 24), 0.0), 2) AS estimated_ltv,
       round(COALESCE(rr, 0.0), 3) AS renewal_rate_mean
FROM (SELECT greatest(COALESCE(avg(CAST(churn_flag AS DOUBLE)), 1e-6), 1e-6) AS churn,
             avg(payments_total) AS arpu,
             avg(CASE WHEN is_paid_user THEN payments_total END) AS paid_arpu,
             avg(renewal_rate) AS rr FROM um)""")
CTES["monthly"] = """
    SELECT CAST(date_trunc('month', payment_date) AS DATE) AS month, COALESCE(sum(revenue), 0.0) AS revenue
    FROM c_payments WHERE payment_date IS NOT NULL GROUP BY 1"""
oracle("monthly_revenue", "SELECT month, round(revenue, 4) AS revenue FROM monthly")
oracle("revenue_summary", """
SELECT round(COALESCE(cur, 0.0), 2) AS current_mrr, round(COALESCE(prev, 0.0), 2) AS prev_mrr,
       round(CASE WHEN COALESCE(prev, 0.0) <> 0 THEN (cur - prev) / prev ELSE 0.0 END, 4) AS mrr_growth
FROM (SELECT (SELECT revenue FROM monthly ORDER BY month DESC LIMIT 1) AS cur,
             COALESCE((SELECT revenue FROM monthly ORDER BY month DESC LIMIT 1 OFFSET 1),
                      (SELECT revenue FROM monthly ORDER BY month DESC LIMIT 1)) AS prev)""")
oracle("segment_country", """
SELECT country, count(user_id) AS total_users, round(round(avg(sessions_total), 9), 4) AS avg_sessions,
       round(round(avg(payments_total), 9), 4) AS avg_revenue, round(avg(CAST(churn_flag AS INTEGER)), 3) AS churn_rate
FROM um WHERE country IS NOT NULL GROUP BY country""")
oracle("segment_plan", """
SELECT plans, count(user_id) AS total_users, round(round(avg(payments_total), 9), 4) AS avg_payment,
       round(round(avg(sessions_total), 9), 4) AS avg_sessions, round(avg(CAST(churn_flag AS INTEGER)), 3) AS churn_rate
FROM um WHERE plans IS NOT NULL GROUP BY plans""")
oracle("insights_text", """
SELECT 1 AS rule_id, printf('Users from %s show the highest churn within the cohort.', country) AS text
FROM (SELECT country, count(DISTINCT user_id) AS n FROM um WHERE churn_flag AND country IS NOT NULL
      GROUP BY country ORDER BY n DESC, country LIMIT 1)
UNION ALL
SELECT 2, printf('Feature %s drives the most interactions and keeps users engaged.', feature)
FROM (SELECT feature, count(event_id) AS n FROM c_events WHERE feature IS NOT NULL
      GROUP BY feature ORDER BY n DESC, feature LIMIT 1) WHERE EXISTS (SELECT 1 FROM um)
UNION ALL
SELECT 3, printf('Users on %s have the strongest renewal rate (%.2f).', plans, r)
FROM (SELECT plans, avg(renewal_rate) AS r FROM um WHERE plans IS NOT NULL
      GROUP BY plans ORDER BY r DESC, plans LIMIT 1)""")

# ---- series ------------------------------------------------------------------
def _zscore(src: str, keys: str, z: float) -> str:
    on = " AND ".join(f"d.{k} = s.{k}" for k in keys.split(", ")) if keys else "true"
    sel = ", ".join(f"d.{k}" for k in keys.split(", ")) + ", " if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    return f"""
SELECT {sel}d.date, d.dau,
       round((d.dau - s.m) / CASE WHEN s.sd IS NULL OR s.sd = 0 THEN 1e-6 ELSE s.sd END, 6) AS z_score,
       abs((d.dau - s.m) / CASE WHEN s.sd IS NULL OR s.sd = 0 THEN 1e-6 ELSE s.sd END) >= {z} AS is_anomaly
FROM {src} d JOIN (
    SELECT {keys + ',' if keys else ''} CAST(sx AS DOUBLE) / CAST(n AS DOUBLE) AS m,
           sqrt(CAST(n * sxx - sx * sx AS DOUBLE) / CAST(n * n AS DOUBLE)) AS sd
    FROM (SELECT {keys + ',' if keys else ''} CAST(count(dau) AS HUGEINT) AS n,
                 CAST(sum(dau) AS HUGEINT) AS sx, CAST(sum(CAST(dau AS HUGEINT) * dau) AS HUGEINT) AS sxx
          FROM {src} {grp})) s ON {on}"""


oracle("dau_anomalies", _zscore("dau", "", 1.5))
oracle("dau_anomalies_by_country", _zscore("country_dau", "country", 1.5))


def _forecast(src: str, keys: list[str], periods: int = 14, min_points: int = 7) -> str:
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""
SELECT {k}date, dau, CAST(NULL AS DOUBLE) AS forecast
FROM (SELECT *, count(*) OVER ({part}) AS n FROM {src}) WHERE n >= {min_points}
UNION ALL
SELECT {k}CAST(last_date + CAST(h AS INTEGER) AS DATE) AS date, CAST(NULL AS BIGINT) AS dau,
       round(level, 4) AS forecast
FROM (SELECT {k}last_date, arg_min(level, [sse, alpha]) AS level FROM fit2_{src} GROUP BY {k}last_date),
     range(1, {periods + 1}) r(h)"""


def _fold(name: str, src: str, keys: list[str], seed_sql: str) -> None:
    """Recursive SES fold over the series ``ser_{src}`` for the alphas of ``seed_sql``
    (columns: keys..., n, last_date, alpha), then the closed-form fit per alpha."""
    k = "".join(f"{c}, " for c in keys)
    kf = "".join(f"f.{c}, " for c in keys)
    on = "".join(f" AND s.{c} = f.{c}" for c in keys)
    CTES[f"fold{name}_{src}"] = f"""
    SELECT {k}n, last_date, alpha, CAST(0 AS BIGINT) AS t,
           0.0::DOUBLE AS g, 1.0::DOUBLE AS c, 0.0::DOUBLE AS scy, 0.0::DOUBLE AS scc, 0.0::DOUBLE AS syy
    FROM ({seed_sql})
    UNION ALL
    SELECT {kf}f.n, f.last_date, f.alpha, f.t + 1,
           f.alpha * s.y + (1.0 - f.alpha) * f.g,
           f.c * (1.0 - f.alpha),
           f.scy + f.c * (s.y - f.g),
           f.scc + f.c * f.c,
           f.syy + (s.y - f.g) * (s.y - f.g)
    FROM fold{name}_{src} f JOIN ser_{src} s ON s.t = f.t + 1{on}"""
    CTES[f"fit{name}_{src}"] = f"""
    SELECT {k}n, last_date, alpha, syy - (scy / scc) * scy AS sse, g + c * (scy / scc) AS level
    FROM fold{name}_{src} WHERE t = n"""


def _fold_ctes(src: str, keys: list[str], grid: int = 100, refine: int = 10, min_points: int = 7) -> None:
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    CTES[f"ser_{src}"] = f"""
    SELECT {k}date, CAST(dau AS DOUBLE) AS y, row_number() OVER ({part} ORDER BY date) AS t,
           count(*) OVER ({part}) AS n, max(date) OVER ({part}) AS last_date
    FROM {src}"""
    # stage 1: alpha = a / grid
    _fold("", src, keys, f"""SELECT {k}n, last_date, CAST(a AS DOUBLE) / {grid} AS alpha
          FROM (SELECT DISTINCT {k}n, last_date FROM ser_{src} WHERE n >= {min_points}),
               range(1, {grid + 1}) r(a)""")
    # stage 2: steps of 1 / (grid * refine) around the stage-1 best, inside (0, 1]
    _fold("2", src, keys, f"""SELECT * FROM (
          SELECT {k}n, last_date, a1 + (j - {refine}) / {grid * refine} AS alpha
          FROM (SELECT {k}n, last_date, arg_min(alpha, [sse, alpha]) AS a1 FROM fit_{src}
                GROUP BY {k}n, last_date), range(0, {2 * refine + 1}) r(j))
          WHERE alpha > 0 AND alpha <= 1""")


_fold_ctes("dau", [])
_fold_ctes("country_dau", ["country"])
oracle("dau_forecast", _forecast("dau", []))
oracle("dau_forecast_by_country", _forecast("country_dau", ["country"]))


# ---- report: first three countries, all plans, whole session window ----------
CTES["sel"] = """
    SELECT * FROM um WHERE country IN (
        SELECT country FROM (SELECT DISTINCT country FROM um WHERE country IS NOT NULL
                             ORDER BY country LIMIT 3))"""
CTES["win"] = """
    SELECT * FROM c_sessions
    WHERE session_time IS NOT NULL AND user_id IN (SELECT user_id FROM sel)"""
CTES["win_dau"] = """
    SELECT CAST(session_time AS DATE) AS date, count(DISTINCT user_id) AS dau FROM win GROUP BY 1"""
CTES["win_weeks"] = """
    SELECT DISTINCT user_id, CAST(date_trunc('week', session_time) AS DATE) AS wk FROM win"""
CTES["win_cohort_long"] = """
    SELECT cohort_week, week_offset, active_users,
           active_users / max(CASE WHEN week_offset = 0 THEN active_users END)
               OVER (PARTITION BY cohort_week) AS retention
    FROM (SELECT f.cohort_week, CAST((w.wk - f.cohort_week) // 7 AS INTEGER) AS week_offset,
                 count(DISTINCT w.user_id) AS active_users
          FROM win_weeks w JOIN (SELECT user_id, min(wk) AS cohort_week FROM win_weeks GROUP BY user_id) f
            ON w.user_id = f.user_id
          GROUP BY 1, 2)
    WHERE week_offset >= 0 AND week_offset < 12"""
CTES["sel_pay"] = "SELECT * FROM c_payments WHERE user_id IN (SELECT user_id FROM sel)"
CTES["sel_monthly"] = """
    SELECT CAST(date_trunc('month', payment_date) AS DATE) AS month, sum(revenue) AS revenue
    FROM sel_pay WHERE payment_date IS NOT NULL GROUP BY 1"""
CTES["sel_mrr"] = """
    SELECT a.*, round(COALESCE(cur, 0.0), 2) AS current_mrr, round(COALESCE(prev, 0.0), 2) AS prev_mrr,
           round(CASE WHEN COALESCE(prev, 0.0) <> 0 THEN (cur - prev) / prev ELSE 0.0 END, 4) AS mrr_growth
    FROM (SELECT round(COALESCE(arpu, 0.0), 2) AS arpu, round(COALESCE(paid_arpu, 0.0), 2) AS paid_arpu,
                 round(COALESCE(least(arpu / churn, arpu * 24), 0.0), 2) AS estimated_ltv,
                 round(COALESCE(rr, 0.0), 3) AS renewal_rate_mean
          FROM (SELECT greatest(COALESCE(avg(CAST(churn_flag AS DOUBLE)), 1e-6), 1e-6) AS churn,
                       avg(payments_total) AS arpu,
                       avg(CASE WHEN is_paid_user THEN payments_total END) AS paid_arpu,
                       avg(renewal_rate) AS rr FROM sel)) a,
         (SELECT (SELECT revenue FROM sel_monthly ORDER BY month DESC LIMIT 1) AS cur,
                 COALESCE((SELECT revenue FROM sel_monthly ORDER BY month DESC LIMIT 1 OFFSET 1),
                          (SELECT revenue FROM sel_monthly ORDER BY month DESC LIMIT 1)) AS prev) m"""

oracle("report_filter_values", """
SELECT DISTINCT 'country' AS dimension, country AS value FROM um WHERE country IS NOT NULL
UNION ALL SELECT DISTINCT 'plan', plans FROM um WHERE plans IS NOT NULL""")
oracle("report_time_bounds", f"""
SELECT COALESCE(min(session_time), {AS_OF}) AS min_session_time,
       COALESCE(max(session_time), min(session_time), {AS_OF}) AS max_session_time FROM c_sessions""")
oracle("report_kpi", """
SELECT count(*) AS total_users,
       count(DISTINCT CASE WHEN is_paid_user THEN user_id END) AS paid_users,
       round(count(DISTINCT CASE WHEN is_paid_user THEN user_id END) / greatest(count(*), 1), 4)
           AS conversion_rate,
       round(avg(CAST(churn_flag AS INTEGER)), 4) AS global_churn_rate
FROM sel""")
oracle("report_funnel", """
SELECT 1 AS step, 'Signups' AS stage, (SELECT count(*) FROM sel) AS users
UNION ALL SELECT 2, 'Active (30d)', (SELECT count(DISTINCT user_id) FROM win)
UNION ALL SELECT 3, 'Paid', (SELECT count(DISTINCT user_id) FROM sel WHERE is_paid_user)
UNION ALL SELECT 4, 'Churned', (SELECT count(DISTINCT user_id) FROM sel WHERE churn_flag)""")
oracle("report_dau", "SELECT date, dau FROM win_dau")
oracle("report_segments_top", """
SELECT country, count(user_id) AS total_users, round(round(avg(sessions_total), 9), 4) AS avg_sessions,
       round(round(avg(payments_total), 9), 4) AS avg_revenue, round(avg(CAST(churn_flag AS INTEGER)), 3) AS churn_rate
FROM sel WHERE country IS NOT NULL GROUP BY country ORDER BY total_users DESC, country LIMIT 6""")
oracle("report_cohorts", """
SELECT cohort_week, week_offset, active_users, round(retention, 4) AS retention FROM win_cohort_long""")
oracle("report_insights", """
SELECT 1 AS rule_id, printf('Users from %s show the highest churn within the cohort.', country) AS text
FROM (SELECT country, count(DISTINCT user_id) AS n FROM sel WHERE churn_flag AND country IS NOT NULL
      GROUP BY country ORDER BY n DESC, country LIMIT 1)
UNION ALL
SELECT 2, printf('Feature %s drives the most interactions and keeps users engaged.', feature)
FROM (SELECT feature, count(event_id) AS n FROM c_events WHERE feature IS NOT NULL
      GROUP BY feature ORDER BY n DESC, feature LIMIT 1) WHERE EXISTS (SELECT 1 FROM sel)
UNION ALL
SELECT 3, printf('Users on %s have the strongest renewal rate (%.2f).', plans, r)
FROM (SELECT plans, avg(renewal_rate) AS r FROM sel WHERE plans IS NOT NULL
      GROUP BY plans ORDER BY r DESC, plans LIMIT 1)""")
oracle("report_insights_empty", """
SELECT country, plans, rule_id, text
FROM (SELECT * FROM (SELECT DISTINCT country FROM um WHERE country IS NOT NULL),
                    (SELECT DISTINCT plans FROM um WHERE plans IS NOT NULL))
LEFT JOIN (
  SELECT country, plans, 1 AS rule_id, printf('Users from %s show the highest churn within the cohort.', country) AS text
  FROM um GROUP BY country, plans HAVING count(*) FILTER (WHERE churn_flag) > 0
  UNION ALL
  SELECT country, plans, 2, printf('Feature %s drives the most interactions and keeps users engaged.', feature)
  FROM (SELECT DISTINCT country, plans FROM um), (
    SELECT feature, count(event_id) AS n FROM c_events WHERE feature IS NOT NULL GROUP BY feature ORDER BY n DESC, feature LIMIT 1)
  UNION ALL
  SELECT country, plans, 3, printf('Users on %s have the strongest renewal rate (%.2f).', plans, avg(renewal_rate))
  FROM um GROUP BY country, plans) s USING (country, plans)""")
oracle("report_mrr", "SELECT * FROM sel_mrr")
oracle("report_monthly_revenue", "SELECT month, round(revenue, 4) AS revenue FROM sel_monthly")
oracle("scenario_grid", """
SELECT CAST(u AS INTEGER) AS conversion_uplift_pct, CAST(c AS INTEGER) AS churn_reduction_pct,
       round(current_mrr, 4) AS current_mrr,
       round(current_mrr * (1.0 + u / 100.0) * (1.0 + c / 200.0), 4) AS projected_mrr,
       round(current_mrr * (1.0 + u / 100.0) * (1.0 + c / 200.0) - current_mrr, 4) AS mrr_delta
FROM sel_mrr, range(0, 55, 5) a(u), range(0, 55, 5) b(c)""")
oracle("report_anomaly_tail", """
SELECT *, CASE WHEN is_anomaly THEN 'Anomaly' ELSE 'Normal' END AS label FROM (""" + _zscore("win_dau", "", 2.5)
       + ") ORDER BY date DESC LIMIT 15")
_fold_ctes("win_dau", [])
oracle("report_forecast_tail", "SELECT * FROM (" + _forecast("win_dau", []) + ") ORDER BY date DESC LIMIT 10")


# ---- evaluation arithmetic on renewal_rate vs churn_flag ----------------------
CTES["cm"] = """
    SELECT sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
           sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp,
           sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn,
           sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tn
    FROM (SELECT CAST(churn_flag AS INTEGER) AS y, CASE WHEN renewal_rate >= 0.5 THEN 1 ELSE 0 END AS p
          FROM um)"""
CTES["cm_rates"] = """
    SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1,
              CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0
    FROM (SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
                 CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
                 CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
                 CAST(tp + fn AS BIGINT) AS s1, CAST(tn + fp AS BIGINT) AS s0,
                 CAST(tp + fp + fn + tn AS BIGINT) AS n,
                 (tp + tn) / (tp + fp + fn + tn) AS acc FROM cm)"""
oracle("classification_report_threshold", """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, support FROM (
    SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM cm_rates
    UNION ALL SELECT '1', p1, r1, f1, s1 FROM cm_rates
    UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM cm_rates
    UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM cm_rates
    UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                     (f0 * s0 + f1 * s1) / n, n FROM cm_rates)""")
oracle("auc_of_score", """
SELECT round(CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE)
             / CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 9) AS auc
FROM (SELECT s, pos, neg,
             COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS neg_below
      FROM (SELECT renewal_rate AS s,
                   sum(CASE WHEN churn_flag THEN 1 ELSE 0 END) AS pos,
                   sum(CASE WHEN churn_flag THEN 0 ELSE 1 END) AS neg
            FROM um GROUP BY renewal_rate))""")


# ---- data quality profile of the raw tables -----------------------------------
def _profile(table: str, src: str, cols: list[str], key: str | None, plan: bool = False) -> str:
    parts = [f"SELECT '{table}' AS \"table\", 'rows' AS metric, CAST(NULL AS VARCHAR) AS \"column\", "
             f"CAST(count(*) AS DOUBLE) AS value FROM {src}"]
    if key:
        parts.append(f"SELECT '{table}', 'dup_keys', NULL, CAST(count(*) - count(DISTINCT {key}) AS DOUBLE) FROM {src}")
    parts += [f"SELECT '{table}', 'null', '{c}', round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM {src}"
              for c in cols]
    if plan:
        parts.append(f"SELECT '{table}', 'noncanonical_plan', NULL, "
                     f"CAST(COALESCE(sum(CASE WHEN plan <> lower(plan) THEN 1 ELSE 0 END), 0) AS DOUBLE) FROM {src}")
    return "\nUNION ALL ".join(parts)


oracle("dq_profile", "\nUNION ALL ".join([
    _profile("users", "raw_users", ["user_id", "signup_date", "country"], "user_id"),
    _profile("sessions", "raw_sessions", ["session_id", "user_id", "session_time", "duration"], "session_id"),
    _profile("events", "raw_events", ["event_id", "user_id", "session_id", "event_type", "feature", "event_time"],
             "event_id"),
    _profile("payments", "raw_payments", ["user_id", "plan", "revenue", "payment_date"], None, True),
]))


oracle("report_kpi_display", """
SELECT * FROM (
    SELECT 1 AS position, 'Global Users' AS label, format('{:,}', count(*)) AS value FROM sel
    UNION ALL SELECT 2, 'Paying Users', format('{:,}', count(DISTINCT CASE WHEN is_paid_user THEN user_id END))
    FROM sel
    UNION ALL SELECT 3, 'Conversion',
        printf('%.2f%%', round(round(count(DISTINCT CASE WHEN is_paid_user THEN user_id END)
                                     / greatest(count(*), 1), 4) * 100, 2)) FROM sel
    UNION ALL SELECT 4, 'Churn', printf('%.2f%%', round(round(avg(CAST(churn_flag AS INTEGER)), 4) * 100, 2))
    FROM sel)""")


# ---- report with an explicit filter setting ------------------------------------
CTES["fsel"] = """
    SELECT * FROM um WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')
                       AND plans IN ('growth', 'enterprise')"""
CTES["fwin"] = """
    SELECT * FROM c_sessions
    WHERE session_time >= TIMESTAMP '2024-01-08 00:00:00' AND session_time <= TIMESTAMP '2024-01-21 23:59:59'
      AND user_id IN (SELECT user_id FROM fsel)"""
CTES["fwin_weeks"] = """
    SELECT DISTINCT user_id, CAST(date_trunc('week', session_time) AS DATE) AS wk FROM fwin"""
oracle("report_funnel_filtered", """
SELECT 1 AS step, 'Signups' AS stage, (SELECT count(*) FROM fsel) AS users
UNION ALL SELECT 2, 'Active (30d)', (SELECT count(DISTINCT user_id) FROM fwin)
UNION ALL SELECT 3, 'Paid', (SELECT count(DISTINCT user_id) FROM fsel WHERE is_paid_user)
UNION ALL SELECT 4, 'Churned', (SELECT count(DISTINCT user_id) FROM fsel WHERE churn_flag)""")
oracle("report_dau_filtered", """
SELECT CAST(session_time AS DATE) AS date, count(DISTINCT user_id) AS dau FROM fwin GROUP BY 1""")
oracle("report_cohorts_filtered", """
SELECT cohort_week, week_offset, active_users,
       round(active_users / max(CASE WHEN week_offset = 0 THEN active_users END)
             OVER (PARTITION BY cohort_week), 4) AS retention
FROM (SELECT f.cohort_week, CAST((w.wk - f.cohort_week) // 7 AS INTEGER) AS week_offset,
             count(DISTINCT w.user_id) AS active_users
      FROM fwin_weeks w JOIN (SELECT user_id, min(wk) AS cohort_week FROM fwin_weeks GROUP BY user_id) f
        ON w.user_id = f.user_id
      GROUP BY 1, 2)
WHERE week_offset >= 0 AND week_offset < 12""")


CTES["plan_dau"] = """
    SELECT u.plans, d.date, count(*) AS dau
    FROM user_day d JOIN um u ON d.user_id = u.user_id
    GROUP BY u.plans, d.date"""
oracle("dau_anomalies_by_plan", _zscore("plan_dau", "plans", 1.5))
oracle("mau", """
SELECT CAST(date_trunc('month', session_time) AS DATE) AS activity_month, count(DISTINCT user_id) AS mau
FROM c_sessions GROUP BY 1""")

oracle("rollup_dau", "SELECT CAST(session_time AS DATE) AS date, count(DISTINCT user_id) AS dau FROM c_sessions"
       " WHERE session_time IS NOT NULL GROUP BY 1")
oracle("rollup_mau", FINAL["mau"])
_fold_ctes("plan_dau", ["plans"])
oracle("dau_forecast_by_plan", _forecast("plan_dau", ["plans"]))


# ---- a linear model of fixed weights ---------------------------------------------
#: Weight of each feature, as the query has it (intercept -0.25); scores carry nine digits.
WEIGHTS = {"sessions_total": -0.8, "avg_session_duration": 0.15, "session_span_days": -0.35,
           "payments_total": 0.6, "payment_count": -0.45, "renewal_rate": -1.1}
CTES["feats"] = "SELECT user_id, plans, CAST(churn_flag AS INTEGER) AS churn_flag, " + ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in WEIGHTS) + " FROM um"
CTES["feat_stats"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS n, COALESCE(avg({c}), 0.0) AS mean,"
    f" CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END AS sd FROM feats" for c in WEIGHTS)
CTES["feat_long"] = " UNION ALL ".join(
    f"SELECT user_id, '{c}' AS feature, ({c} - mean) / sd AS z, CAST({w} AS DOUBLE) AS w"
    f" FROM feats, feat_stats WHERE feature = '{c}'" for c, w in WEIGHTS.items())
CTES["lin"] = """
    SELECT f.*, round(1 / (1 + exp(-(m.margin - 0.25))), 9) AS p
    FROM feats f JOIN (SELECT user_id, sum(w * z) AS margin FROM feat_long GROUP BY user_id) m USING (user_id)"""
CTES["lin_shap"] = """
    SELECT l.user_id, l.feature, w * (z - zm) AS shap_value,
           (SELECT sum(wm) FROM (SELECT any_value(w) * avg(z) AS wm FROM feat_long GROUP BY feature)) - 0.25 AS base_value
    FROM feat_long l JOIN (SELECT feature, avg(z) AS zm FROM feat_long GROUP BY feature) USING (feature)"""
CTES["lin_cm"] = """
    SELECT c, count(*) FILTER (WHERE y = c AND h = c) AS hit, count(*) FILTER (WHERE y <> c AND h = c) AS wrong,
           count(*) FILTER (WHERE y = c AND h <> c) AS miss, count(*) AS n
    FROM (SELECT churn_flag AS y, CAST(p >= 0.5 AS INTEGER) AS h FROM lin), (VALUES (0), (1)) v(c) GROUP BY c"""
CTES["lin_rates"] = """
    SELECT c, n, hit, hit + miss AS support, COALESCE(hit / nullif(hit + wrong, 0), 0.0) AS precision,
           COALESCE(hit / nullif(hit + miss, 0), 0.0) AS recall,
           COALESCE(2 * hit / nullif(2 * hit + wrong + miss, 0), 0.0) AS f1 FROM lin_cm"""
oracle("scaler_stats_table", "SELECT feature, n, round(mean, 4) AS mean, round(sd, 4) AS sd FROM feat_stats")
oracle("linear_scored_fixed", "SELECT user_id, plans, churn_flag, round(p, 6) AS churn_probability FROM lin")
oracle("linear_shap_fixed", """
SELECT user_id, feature, round(shap_value, 6) AS shap_value, round(base_value, 6) AS base_value FROM lin_shap""")
oracle("linear_report_fixed", """
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1_score, support FROM lin_rates
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / max(n), 6), max(n) FROM lin_rates
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), max(n) FROM lin_rates
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / max(n), 6), round(sum(recall * support) / max(n), 6),
                 round(sum(f1 * support) / max(n), 6), max(n) FROM lin_rates""")
oracle("linear_auc_fixed", """
SELECT round(CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 9) AS auc
FROM (SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT p AS s, sum(churn_flag) AS pos, sum(1 - churn_flag) AS neg FROM lin GROUP BY 1))""")
oracle("leaderboard_fixed", """
SELECT user_id, round(p, 6) AS churn_probability, plans, round(payments_total, 6) AS payments_total, sessions_total
FROM lin ORDER BY p DESC, user_id LIMIT 15""")
oracle("explain_top_fixed", """
SELECT s.user_id, s.feature, round(s.shap_value, 6) AS shap_value, round(s.base_value, 6) AS base_value,
       round(t.p, 6) AS churn_probability
FROM lin_shap s JOIN (SELECT user_id, p FROM lin ORDER BY p DESC, user_id LIMIT 50) t USING (user_id)""")


oracle("summary_kpis", "SELECT * FROM " + ", ".join(
    f"({FINAL[name]})" for name in ("conversion", "churn_summary", "ltv", "revenue_summary")))


# ---- the fitted logistic model: twelve Newton steps, each system solved by elimination ----------------
_Z = ["z0", "z1", "z2", "z3", "z4", "z5", "1.0"]
CTES["newton_z"] = "SELECT f.user_id, f.churn_flag AS y, " + ", ".join(
    f"(f.{c} - s{i}.mean) / s{i}.sd AS z{i}" for i, c in enumerate(WEIGHTS)) + " FROM feats f, " + ", ".join(
    f"(SELECT * FROM feat_stats WHERE feature = '{c}') s{i}" for i, c in enumerate(WEIGHTS))
CTES["beta0"] = "SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(7))


def _newton_step(t: int) -> None:
    """CTEs from beta{t} to beta{t + 1}: sums over all rows, seven rows of a system, seven pivots."""
    margin = " + ".join(f"b{i} * {z}" for i, z in enumerate(_Z))
    sums = [f"sum((p - y) * {z}) + any_value(b{i}) AS g{i}" for i, z in enumerate(_Z)]
    sums += [f"sum(p * (1 - p) * {_Z[i]} * {_Z[j]}) + {int(i == j)} AS h{i}{j}" for i in range(7) for j in range(i, 7)]
    CTES[f"sums{t}"] = f"SELECT {', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM newton_z, beta{t})"
    rows = [f"SELECT {i} AS i, " + ", ".join(f"h{min(i, j)}{max(i, j)} AS c{j}" for j in range(7)) + f", g{i} AS c7 FROM sums{t}"
            for i in range(7)]
    CTES[f"solve{t}_0"] = " UNION ALL ".join(rows)
    for k in range(7):
        cells = ", ".join(f"CASE WHEN a.i = {k} THEN a.c{j} / p.c{k} ELSE a.c{j} - a.c{k} * p.c{j} / p.c{k} END AS c{j}" for j in range(8))
        CTES[f"solve{t}_{k + 1}"] = f"SELECT a.i, {cells} FROM solve{t}_{k} a, (SELECT * FROM solve{t}_{k} WHERE i = {k}) p"
    CTES[f"beta{t + 1}"] = "SELECT " + ", ".join(
        f"(SELECT b{i} FROM beta{t}) - max(c7) FILTER (WHERE i = {i}) AS b{i}" for i in range(7)) + f" FROM solve{t}_7"


NEWTON_STEPS = 12
for _t in range(NEWTON_STEPS):
    _newton_step(_t)
MATERIALISED |= {"newton_z"} | {k for k in CTES if k.startswith(("sums", "solve", "beta"))}
CTES["fit"] = f"SELECT * FROM beta{NEWTON_STEPS}"
CTES["fit_margin"] = "SELECT user_id, y, " + ", ".join(f"z{i}" for i in range(6)) + ", " + " + ".join(
    f"b{i} * {z}" for i, z in enumerate(_Z)) + " AS m FROM newton_z, fit"
CTES["fit_terms"] = " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, b{i} AS w FROM fit" for i, c in enumerate(WEIGHTS))
CTES["fit_scored"] = "SELECT f.*, round(1 / (1 + exp(-m)), 9) AS p FROM feats f JOIN fit_margin USING (user_id)"
CTES["fit_long"] = " UNION ALL ".join(
    f"SELECT user_id, '{c}' AS feature, b{i} * z{i} AS part FROM newton_z, fit" for i, c in enumerate(WEIGHTS))
CTES["fit_shap"] = """
    SELECT user_id, feature, part - avg(part) OVER (PARTITION BY feature) AS shap_value,
           (SELECT sum(m) FROM (SELECT avg(part) AS m FROM fit_long GROUP BY feature)) + (SELECT b6 FROM fit) AS base_value
    FROM fit_long"""
CTES["fit_cm"] = """
    SELECT c, count(*) FILTER (WHERE y = c AND h = c) AS hit, count(*) FILTER (WHERE y <> c AND h = c) AS wrong,
           count(*) FILTER (WHERE y = c AND h <> c) AS miss, count(*) AS n
    FROM (SELECT churn_flag AS y, CAST(p >= 0.5 AS INTEGER) AS h FROM fit_scored), (VALUES (0), (1)) v(c) GROUP BY c"""
CTES["fit_rates"] = """
    SELECT c, n, hit, hit + miss AS support, COALESCE(hit / nullif(hit + wrong, 0), 0.0) AS precision,
           COALESCE(hit / nullif(hit + miss, 0), 0.0) AS recall,
           COALESCE(2 * hit / nullif(2 * hit + wrong + miss, 0), 0.0) AS f1 FROM fit_cm"""
oracle("churn_model_weights", "SELECT term, round(weight, 6) AS weight FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS term, b{i} AS weight FROM fit" for i, c in enumerate([*WEIGHTS, "intercept"])) + ")")
oracle("churn_scored", "SELECT user_id, plans, churn_flag, round(p, 6) AS churn_probability, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in WEIGHTS) + " FROM fit_scored")
oracle("churn_report", """
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1_score, support FROM fit_rates
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / max(n), 6), max(n) FROM fit_rates
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), max(n) FROM fit_rates
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / max(n), 6), round(sum(recall * support) / max(n), 6),
                 round(sum(f1 * support) / max(n), 6), max(n) FROM fit_rates""")
oracle("churn_auc", """
SELECT round(CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 9) AS auc
FROM (SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT p AS s, sum(churn_flag) AS pos, sum(1 - churn_flag) AS neg FROM fit_scored GROUP BY 1))""")
oracle("churn_leaderboard", """
SELECT user_id, round(p, 6) AS churn_probability, plans, round(payments_total, 6) AS payments_total, sessions_total
FROM fit_scored ORDER BY p DESC, user_id LIMIT 15""")
oracle("churn_shap", """
SELECT user_id, feature, round(shap_value, 6) AS shap_value, round(base_value, 6) AS base_value FROM fit_shap""")
oracle("churn_explain_top", """
SELECT s.user_id, s.feature, round(s.shap_value, 6) AS shap_value, round(s.base_value, 6) AS base_value,
       round(t.p, 6) AS churn_probability
FROM fit_shap s JOIN (SELECT user_id, p FROM fit_scored ORDER BY p DESC, user_id LIMIT 50) t USING (user_id)""")

#: md5 of 'seed:repeat', twelve hexadecimal digits: the seeds of the ten rotations of permutation importance.
CTES["rotated"] = """
    SELECT a.user_id, a.y, r.r, a.m, """ + ", ".join(f"a.z{i} AS z{i}, d.z{i} AS d{i}" for i in range(6)) + """
    FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || user_id), user_id) - 1 AS id, count(*) OVER () AS n FROM fit_margin) a
    JOIN (SELECT r, CAST('0x' || substr(md5('42:' || r), 1, 12) AS BIGINT) AS h FROM range(10) t(r)) r ON true
    JOIN (SELECT *, row_number() OVER (ORDER BY md5('42:' || user_id), user_id) - 1 AS id FROM fit_margin) d
      ON d.id = (a.id + CASE WHEN a.n > 1 THEN 1 + r.h % (a.n - 1) ELSE 0 END) % a.n"""
CTES["permuted"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(acc) AS acc FROM (SELECT r, avg(CASE WHEN CAST(m + b{i} * (d{i} - z{i}) > 0 AS INTEGER) = y"
    f" THEN 1.0 ELSE 0.0 END) AS acc FROM rotated, fit GROUP BY r)" for i, c in enumerate(WEIGHTS))
CTES["fit_importance"] = """
    SELECT feature, round(w, 6) AS model_importance,
           round((SELECT avg(CASE WHEN CAST(m > 0 AS INTEGER) = y THEN 1.0 ELSE 0.0 END) FROM fit_margin) - acc, 6) AS permutation_importance
    FROM fit_terms JOIN permuted USING (feature)"""
oracle("churn_importance", "SELECT * FROM fit_importance")
oracle("churn_top_drivers", "SELECT * FROM fit_importance ORDER BY abs(model_importance) DESC, feature LIMIT 8")
