"""The metric set in SQL, written the long way: windows as row copies, episodes as groups."""

from __future__ import annotations

from checks.catalog import TABLES, sql_r6
from navloom.operators.metrics import METRICS


def define_metrics(prefix: str, source: str, as_of: str, stale_days: int, latest: str | None = None) -> str:
    """Register the metric tables over `source` (fund_code, nav_date, adjusted_nav); returns the last one."""
    p = prefix
    cut = f"WHERE nav_date <= DATE '{latest}'" if latest else ""
    part = "PARTITION BY fund_code, tag ORDER BY nav_date"
    before = f"({part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    TABLES[f"{p}_series"] = f"SELECT fund_code, nav_date, adjusted_nav AS v FROM {source} {cut}"
    TABLES[f"{p}_range"] = f"""
SELECT fund_code, min(nav_date) AS s0, max(nav_date) AS e0,
       date_diff('day', max(nav_date), DATE '{as_of}') > {stale_days} AS stale
FROM {p}_series GROUP BY 1"""
    TABLES[f"{p}_tagged"] = f"""
SELECT s.fund_code AS fund_code, tag, nav_date, v, e0
FROM {p}_series s JOIN {p}_range r ON r.fund_code = s.fund_code,
     (VALUES ('a', NULL), ('3y', 3), ('1y', 1)) AS t(tag, years)
WHERE NOT stale AND (years IS NULL OR nav_date >= CAST(e0 - to_years(years) AS DATE))"""
    TABLES[f"{p}_days"] = f"""
SELECT fund_code, tag, nav_date, v, lag(v) OVER ({part}) AS pv, max(v) OVER {before} AS peak FROM {p}_tagged"""
    TABLES[f"{p}_episodes"] = f"""
SELECT fund_code, tag, episode, min(nav_date) AS first_day, min(struct_pack(v := v, d := nav_date)) AS trough
FROM (SELECT *, sum(CASE WHEN peak IS NULL OR v >= peak THEN 1 ELSE 0 END) OVER ({part}) AS episode FROM {p}_days)
GROUP BY 1, 2, 3"""
    TABLES[f"{p}_recovery"] = f"""
SELECT fund_code, tag, CAST(max(date_diff('day', d, next_day)) AS DOUBLE) AS recovery_days
FROM (SELECT fund_code, tag, trough.d AS d,
             lead(first_day) OVER (PARTITION BY fund_code, tag ORDER BY episode) AS next_day FROM {p}_episodes)
GROUP BY 1, 2"""
    TABLES[f"{p}_daily"] = f"""
SELECT fund_code, tag, count(*) AS n, arg_min(v, nav_date) AS sv, arg_max(v, nav_date) AS ev,
       date_diff('day', min(nav_date), max(nav_date)) AS span,
       max(1e0 - v / greatest(v, coalesce(peak, v))) AS drawdown, min(v / pv - 1e0) AS worst_day
FROM {p}_days GROUP BY 1, 2"""
    TABLES[f"{p}_buckets"] = f"""
SELECT fund_code, tag, ptype, bucket, arg_max(v, nav_date) AS v FROM (
  SELECT *, 'W' AS ptype, CAST(nav_date + CAST((5 - isodow(nav_date) + 7) % 7 AS INTEGER) AS DATE) AS bucket FROM {p}_tagged
  UNION ALL SELECT *, 'M', last_day(nav_date) FROM {p}_tagged
  UNION ALL SELECT *, 'Q', last_day(CAST(date_trunc('quarter', nav_date) + INTERVAL 2 MONTH AS DATE)) FROM {p}_tagged
) GROUP BY 1, 2, 3, 4"""
    TABLES[f"{p}_returns"] = f"""
SELECT fund_code, tag, ptype, bucket, lag(bucket) OVER w AS prev_bucket, v / lag(v) OVER w - 1e0 AS r FROM {p}_buckets
WINDOW w AS (PARTITION BY fund_code, tag, ptype ORDER BY bucket)"""
    TABLES[f"{p}_period"] = f"""
SELECT fund_code, tag, ptype, avg(CASE WHEN r > 0 THEN 1e0 ELSE 0e0 END) FILTER (WHERE r IS NOT NULL) AS up,
       CASE WHEN count(r) = 1 THEN 0e0 ELSE stddev_samp(r) END AS sd,
       CASE WHEN count(r) > 1 AND stddev_samp(r) > 0 THEN (avg(r) * 52e0 - 15e-3) / (stddev_samp(r) * sqrt(52e0)) END AS sharpe
FROM {p}_returns GROUP BY 1, 2, 3"""
    TABLES[f"{p}_recent"] = f"""
SELECT fund_code, CASE WHEN count(*) >= 2 THEN arg_max(v, nav_date) / arg_min(v, nav_date) - 1e0 END AS recent
FROM {p}_tagged WHERE tag = 'a' AND nav_date >= CAST(date_trunc('month', e0) - INTERVAL 1 MONTH AS DATE)
  AND nav_date < CAST(date_trunc('month', e0) AS DATE) GROUP BY 1"""
    TABLES[f"{p}_spans"] = f"""
SELECT d.fund_code AS fund_code, d.tag AS tag,
       CASE WHEN sv > 0 AND ev > 0 AND span > 0 THEN pow(ev / sv, 365e0 / span) - 1e0 END AS annual,
       drawdown, worst_day, recovery_days, w.up AS uw, w.sd AS sw, m.up AS um, m.sd AS sm, q.up AS uq, q.sd AS sq,
       w.sharpe AS sharpe
FROM {p}_daily d LEFT JOIN {p}_recovery r ON r.fund_code = d.fund_code AND r.tag = d.tag
LEFT JOIN {p}_period w ON w.fund_code = d.fund_code AND w.tag = d.tag AND w.ptype = 'W'
LEFT JOIN {p}_period m ON m.fund_code = d.fund_code AND m.tag = d.tag AND m.ptype = 'M'
LEFT JOIN {p}_period q ON q.fund_code = d.fund_code AND q.tag = d.tag AND q.ptype = 'Q'"""
    source_of = {
        "annual_return": "annual",
        "up_quarter_ratio": "uq",
        "up_month_ratio": "um",
        "up_week_ratio": "uw",
        "quarter_return_std": "sq",
        "month_return_std": "sm",
        "week_return_std": "sw",
        "max_drawdown": "drawdown",
        "sharpe_ratio": "sharpe",
        "max_drawdown_recovery_days": "recovery_days",
        "max_single_day_drop": "worst_day",
    }
    columns = []
    for name in METRICS:
        alias, base = "a", name
        for suffix, other in (("_3y", "t"), ("_1y", "o")):
            if name.endswith(suffix):
                alias, base = other, name.removesuffix(suffix)
        if base == "calmar_ratio":
            columns.append(f"CASE WHEN {alias}.drawdown > 0 THEN {alias}.annual / {alias}.drawdown END AS {name}")
        elif base == "recent_month_return":
            columns.append(f"x.recent AS {name}")
        else:
            columns.append(f"{alias}.{source_of[base]} AS {name}")
    TABLES[f"{p}_metrics"] = f"""
SELECT r.fund_code AS fund_code, s0 AS nav_start_date, e0 AS nav_end_date, stale, {", ".join(columns)}
FROM {p}_range r LEFT JOIN {p}_spans a ON a.fund_code = r.fund_code AND a.tag = 'a'
LEFT JOIN {p}_spans t ON t.fund_code = r.fund_code AND t.tag = '3y'
LEFT JOIN {p}_spans o ON o.fund_code = r.fund_code AND o.tag = '1y'
LEFT JOIN {p}_recent x ON x.fund_code = r.fund_code"""
    return f"{p}_metrics"


ROUNDED_METRICS = ", ".join(f"{sql_r6(n)} AS {n}" for n in METRICS)
