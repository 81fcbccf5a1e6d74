"""DuckDB SQL that computes every registered query independently.

Incidents are numbered by counting over whole targets, time series use as-of
and range joins, so the plans share nothing with the Spark side.
"""

from __future__ import annotations

L = "db_type, environment, host, port, instance, criticality, team"
MAXL = ", ".join(f"max({c}) AS {c}" for c in L.split(", "))
SL = "target_name, instance, db_type, environment, criticality, team"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
HIST = "TIMESTAMP '2001-08-01 00:00:00'"
START = "TIMESTAMP '2024-01-01 00:00:00'"
STORED_UNTIL = "TIMESTAMP '2024-01-21 00:00:00'"
BATCH_FROM = "TIMESTAMP '2024-01-19 00:00:00'"
DEFAULT = "'blackbox probe failed'"
_SLOW = "(is_up = 1 AND latency_ms > 3000)"


def labels(n: str) -> str:
    host = f"concat('host-', CAST({n} AS VARCHAR))"
    return f"""concat('db-', CAST({n} AS VARCHAR)) AS target_name,
      CASE WHEN {n} % 3 = 0 THEN 'postgresql' WHEN {n} % 3 = 1 THEN 'mysql' ELSE 'oracle' END AS db_type,
      CASE WHEN {n} % 2 = 0 THEN 'production' ELSE 'development' END AS environment,
      {host} AS host, CAST(5400 + {n} AS INTEGER) AS port,
      concat({host}, ':', CAST(5400 + {n} AS VARCHAR)) AS instance,
      CASE WHEN {n} <> 7 THEN CASE WHEN {n} < 3 THEN 'high' ELSE 'medium' END END AS criticality,
      CASE WHEN {n} <> 7 THEN CASE WHEN {n} % 2 = 0 THEN 'dba' ELSE 'platform' END END AS team"""


SAMPLES = f"""samples AS (
    SELECT ts AS checked_at, {labels('user_id % 8')},
      CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_up,
      CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(value * 25 AS DECIMAL(20,6)) END AS latency_ms,
      CASE WHEN event_type = 'error' AND event_id % 3 <> 0
        THEN concat('probe failed ', CAST(event_id % 4 AS VARCHAR)) END AS error_text
    FROM events)"""
_DOWN = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
HISTORY = f"""samples AS (
    SELECT o_orderdate + to_seconds(o_orderkey % 86400) AS checked_at, {labels('o_custkey % 8')},
      CASE WHEN {_DOWN} THEN 0 ELSE 1 END AS is_up,
      CAST(o_totalprice / 100 AS DECIMAL(20,6)) AS latency_ms,
      CASE WHEN {_DOWN} THEN {DEFAULT} END AS error_text
    FROM orders)"""
STORED = f"stored AS (SELECT * FROM samples WHERE checked_at < {STORED_UNTIL})"
BATCH = f"batch AS (SELECT * FROM samples WHERE checked_at >= {BATCH_FROM})"
NEW = """fresh AS (SELECT b.* FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s
    WHERE s.checked_at = b.checked_at AND s.target_name = b.target_name))"""


def pct(up: str, n: str) -> str:
    """Percentage rounded half up to two digits, in integer arithmetic."""
    return f"CASE WHEN {n} > 0 THEN CAST((20000 * CAST({up} AS HUGEINT) + {n}) // (2 * {n}) AS DOUBLE) / 100 END"


def mean(total: str, n: str) -> str:
    """Mean of a ten-digit decimal sum rounded half up to two digits, in integers."""
    units = f"CAST(CAST({total} AS DECIMAL(38,10)) * 10000000000 AS HUGEINT)"
    one = "CAST(10000000000 AS HUGEINT)"
    return f"CASE WHEN {n} > 0 THEN CAST((200 * {units} + {n} * {one}) // (2 * {n} * {one}) AS DOUBLE) / 100 END"


def kpi_raw(src: str, unit: str) -> str:
    period = "CAST(checked_at AS DATE) AS period_start" if unit == "day" else "date_trunc('hour', checked_at) AS period_hour"
    return f"""SELECT {period}, target_name, {MAXL},
      count(*) AS probes, count(*) FILTER (WHERE is_up = 1) AS up_probes,
      count(*) FILTER (WHERE is_up = 0) AS down_probes,
      count(*) FILTER (WHERE is_up = 1 AND latency_ms > 3000) AS slow_probes,
      CAST(coalesce(sum(latency_ms) FILTER (WHERE is_up = 1), 0) AS DECIMAL(38,10)) AS latency_ms_sum,
      count(latency_ms) FILTER (WHERE is_up = 1) AS latency_ms_count,
      max(latency_ms) FILTER (WHERE is_up = 1) AS max_latency_ms,
      min(checked_at) AS first_probe_at, max(checked_at) AS last_probe_at
    FROM {src} GROUP BY 1, 2"""


def minutes(src: str = "samples") -> str:
    return f"""SELECT date_trunc('minute', checked_at) AS period_minute, target_name, {MAXL},
      min(is_up) AS is_up,
      CASE WHEN min(is_up) = 1 THEN avg(latency_ms) FILTER (WHERE is_up = 1) END AS latency_ms,
      CASE WHEN min(is_up) = 1 THEN max(latency_ms) FILTER (WHERE is_up = 1) END AS max_latency_ms,
      CASE WHEN min(is_up) = 1 THEN bool_or(latency_ms > 3000) FILTER (WHERE is_up = 1 AND latency_ms IS NOT NULL)
        ELSE false END AS is_slow,
      coalesce(arg_min(error_text, checked_at) FILTER (WHERE is_up = 0 AND error_text IS NOT NULL), {DEFAULT}) AS error_text,
      min(checked_at) AS first_probe_at, max(checked_at) AS last_probe_at,
      min(checked_at) FILTER (WHERE is_up = 0) AS first_down_at,
      max(checked_at) FILTER (WHERE is_up = 0) AS last_down_at
    FROM {src} GROUP BY 1, 2"""


def kpi_norm(src: str, unit: str) -> str:
    period = "CAST(period_minute AS DATE) AS period_start" if unit == "day" else "date_trunc('hour', period_minute) AS period_hour"
    return f"""SELECT {period}, target_name, {MAXL},
      count(*) AS probes, count(*) FILTER (WHERE is_up = 1) AS up_probes,
      count(*) FILTER (WHERE is_up = 0) AS down_probes, count(*) FILTER (WHERE is_slow) AS slow_probes,
      CAST(coalesce(sum(CAST(latency_ms AS DECIMAL(24,10))) FILTER (WHERE is_up = 1), 0) AS DECIMAL(38,10)) AS latency_ms_sum,
      count(latency_ms) FILTER (WHERE is_up = 1) AS latency_ms_count,
      max(max_latency_ms) FILTER (WHERE is_up = 1) AS max_latency_ms,
      min(first_probe_at) AS first_probe_at, max(last_probe_at) AS last_probe_at
    FROM {src} GROUP BY 1, 2"""


def kpi_out(src: str, period: str) -> str:
    return f"""SELECT {period}, target_name, {L}, probes, up_probes, down_probes, slow_probes,
      CAST(latency_ms_sum AS DOUBLE) AS latency_ms_sum, latency_ms_count,
      CAST(max_latency_ms AS DOUBLE) AS max_latency_ms, first_probe_at, last_probe_at FROM {src}"""


def errors_raw(src: str) -> str:
    return f"""SELECT CAST(checked_at AS DATE) AS period_start, target_name, {MAXL},
      coalesce(error_text, {DEFAULT}) AS error_text, count(*) AS error_count,
      min(checked_at) AS first_seen_at, max(checked_at) AS last_seen_at
    FROM {src} WHERE is_up = 0 GROUP BY 1, 2, coalesce(error_text, {DEFAULT})"""


def errors_norm(src: str) -> str:
    return f"""SELECT CAST(period_minute AS DATE) AS period_start, target_name, {MAXL}, error_text,
      count(*) AS error_count, min(first_down_at) AS first_seen_at, max(last_down_at) AS last_seen_at
    FROM {src} WHERE is_up = 0 GROUP BY 1, 2, error_text"""


def merge_kpi(old: str, new: str, period: str) -> str:
    lab = ", ".join(f"CASE WHEN n.target_name IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in L.split(", "))
    add = ", ".join(f"coalesce(o.{c}, 0) + coalesce(n.{c}, 0) AS {c}" for c in
                    ["probes", "up_probes", "down_probes", "slow_probes", "latency_ms_sum", "latency_ms_count"])
    return f"""SELECT {period}, target_name, {lab}, {add},
      greatest(o.max_latency_ms, n.max_latency_ms) AS max_latency_ms,
      least(o.first_probe_at, n.first_probe_at) AS first_probe_at,
      greatest(o.last_probe_at, n.last_probe_at) AS last_probe_at
    FROM ({old}) o FULL JOIN ({new}) n USING ({period}, target_name)"""


_RATIOS = f"""CAST(sum(probes) AS BIGINT) AS probes, CAST(sum(up_probes) AS BIGINT) AS up_probes,
      CAST(sum(down_probes) AS BIGINT) AS down_probes, CAST(sum(slow_probes) AS BIGINT) AS slow_probes,
      {pct('sum(up_probes)', 'sum(probes)')} AS availability_pct,
      {mean('sum(latency_ms_sum)', 'sum(latency_ms_count)')} AS avg_latency_ms,
      CAST(round(max(max_latency_ms), 2) AS DOUBLE) AS max_latency_ms, max(last_probe_at) AS last_probe_at"""


def view(period: str) -> str:
    return f"""SELECT CAST({period} AS TIMESTAMP) AS {period}, target_name, db_type, environment, criticality,
      probes, up_probes, down_probes, slow_probes, {pct('up_probes', 'probes')} AS availability_pct,
      {mean('latency_ms_sum', 'latency_ms_count')} AS avg_latency_ms,
      CAST(round(max_latency_ms, 2) AS DOUBLE) AS max_latency_ms, last_probe_at FROM kpi"""


def rollup(unit: str) -> str:
    return f"""SELECT date_trunc('{unit}', CAST(period_start AS TIMESTAMP)) AS period_start, target_name,
      db_type, environment, criticality, {_RATIOS} FROM kpi GROUP BY 1, 2, 3, 4, 5"""


def downtime(first: str = "arg_min(error_text, checked_at) FILTER (WHERE error_text IS NOT NULL)",
             src: str = "samples", out: str = "down") -> str:
    """DOWN samples of one incident have the same number of UP samples before them."""
    return f"""{out}_placed AS (SELECT *,
        count(*) FILTER (WHERE is_up = 1) OVER (PARTITION BY target_name ORDER BY checked_at) AS ups,
        min(checked_at) FILTER (WHERE is_up = 1) OVER (PARTITION BY target_name ORDER BY checked_at
          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_up FROM {src}),
    {out} AS (SELECT target_name, min(checked_at) AS down_start, max(checked_at) AS last_down_at,
        any_value(next_up) AS down_end, {MAXL}, count(*) AS down_samples, {first} AS first_error_text,
        arg_max(error_text, checked_at) FILTER (WHERE error_text IS NOT NULL) AS last_error_text,
        max(latency_ms) AS max_latency_ms
      FROM {out}_placed WHERE is_up = 0 GROUP BY target_name, ups)"""


def latency(closes: str, src: str = "samples", out: str = "slow") -> str:
    """Slow samples of one incident have the same number of other samples before them."""
    return f"""{out}_placed AS (SELECT *, coalesce({_SLOW}, false) AS hit,
        count(*) FILTER (WHERE NOT coalesce({_SLOW}, false)) OVER (PARTITION BY target_name ORDER BY checked_at) AS others,
        min(checked_at) FILTER (WHERE {closes}) OVER (PARTITION BY target_name ORDER BY checked_at
          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_close FROM {src}),
    {out} AS (SELECT target_name, min(checked_at) AS slow_start, max(checked_at) AS last_slow_at,
        any_value(next_close) AS slow_end, {MAXL}, count(*) AS slow_samples, sum(latency_ms) AS latency_ms_sum,
        count(latency_ms) AS latency_ms_count, max(latency_ms) AS max_latency_ms
      FROM {out}_placed WHERE hit GROUP BY target_name, others)"""


_DOWN_OUT = f"""SELECT target_name, down_start, down_end, last_down_at, {L}, down_samples,
    first_error_text, last_error_text, CAST(max_latency_ms AS DOUBLE) AS max_latency_ms FROM down"""
_SLOW_OUT = f"""SELECT target_name, slow_start, slow_end, last_slow_at, CAST(3000 AS DOUBLE) AS threshold_ms, {L},
    slow_samples, CAST(latency_ms_sum AS DOUBLE) AS latency_ms_sum, latency_ms_count,
    CAST(max_latency_ms AS DOUBLE) AS max_latency_ms FROM slow"""


def duration(start: str, end: str) -> str:
    us = f"epoch_us(coalesce({end}, {AS_OF})) - epoch_us({start})"
    return f"""CASE WHEN {end} IS NULL THEN 'OPEN' ELSE 'CLOSED' END AS event_status,
      CAST(({us} + 5000) // 10000 AS DOUBLE) / 100 AS duration_seconds,
      CAST(({us} + 300000) // 600000 AS DOUBLE) / 100 AS duration_minutes"""


SUCCESS = f"""success AS (SELECT target_name, instance, db_type, environment, coalesce(criticality, '') AS criticality,
      coalesce(team, '') AS team, checked_at AS ts, CAST(is_up AS DOUBLE) AS value FROM samples)"""
DURATION = f"""duration AS (SELECT target_name, instance, db_type, environment, coalesce(criticality, '') AS criticality,
      coalesce(team, '') AS team, checked_at AS ts, CAST(latency_ms AS DOUBLE) / 1000 AS value
      FROM samples WHERE latency_ms IS NOT NULL)"""


def grid(seconds: int, start: str = START) -> str:
    return f"grid AS (SELECT unnest(generate_series({start}, {AS_OF}, INTERVAL {seconds} SECOND)) AS t)"


def instant(src: str, lookback: int = 10800, key: str = "target_name", cols: str = SL) -> str:
    lab = ", ".join(f"s.{c}" for c in cols.split(", "))
    return f"""SELECT {lab}, g.t AS eval_time, s.value
      FROM (SELECT * FROM grid, (SELECT DISTINCT {key} FROM {src})) g
      ASOF JOIN {src} s ON g.{key} = s.{key} AND g.t >= s.ts
      WHERE s.ts > g.t - INTERVAL {lookback} SECOND"""


def over(src: str, fn: str, window: int) -> str:
    lab = ", ".join(f"s.{c}" for c in SL.split(", "))
    return f"""SELECT {lab}, g.t AS eval_time, {fn}(s.value) AS value FROM grid g
      JOIN {src} s ON s.ts > g.t - INTERVAL {window} SECOND AND s.ts <= g.t GROUP BY ALL"""


def alert(condition: str, step: int, hold: int, cols: str = SL) -> str:
    """Condition rows to pending and firing rows."""
    part = f"PARTITION BY {cols}" if cols else ""
    sep = f"{cols}, " if cols else ""
    return f"""cond AS ({condition}),
    isl AS (SELECT *, eval_time - to_seconds({step} * row_number() OVER ({part} ORDER BY eval_time)) AS isl FROM cond),
    act AS (SELECT *, min(eval_time) OVER (PARTITION BY {sep}isl) AS active_at FROM isl),
    states AS (SELECT {sep}eval_time, active_at, CASE WHEN eval_time >= active_at + INTERVAL {hold} SECOND
        THEN 'firing' ELSE 'pending' END AS state FROM act)"""


TEXTS = {
    "DBPortDown": """concat('Target ', instance, ' tidak reachable via TCP selama lebih dari 3 menit. DB Type=',
      db_type, ', Env=', environment, '.')""",
    "DBPortProbeSlow": """concat('Target ', instance, ' TCP probe latency lebih dari 3 detik selama 5 menit. DB Type=',
      db_type, ', Env=', environment, '.')""",
    "DBPortProbeScrapeFailed": "concat('Prometheus gagal mengambil hasil Blackbox untuk ', instance, ' selama lebih dari 2 menit.')",
    "DBPortMetricsMissing": "'Seluruh metric probe_success tidak tersedia selama lebih dari 3 menit.'",
    "WriterDown": "'The ingest writer sent no metrics for more than 1 minute.'",
    "WriterCycleFailed": "'Ingest cycles failed for more than 1 minute.'",
    "WriterIngestStale": "'No ingest cycle succeeded for more than 3 minutes.'",
    "WriterBackfillBehind": "'The ingest backlog stayed above 5 minutes for at least 5 minutes.'",
}


def alert_out(name: str, severity: str, category: str, summary: str, cols: str = SL) -> str:
    sep = f"{cols}, " if cols else ""
    return f"""SELECT '{name}' AS alert_name, '{severity}' AS severity, '{category}' AS category, 'dba' AS alert_team,
      {sep}eval_time, active_at, state, {summary} AS summary, {TEXTS[name]} AS description FROM states"""


METRICS = """metrics AS (
    SELECT cycle_at, CAST(bad * 4 <= n AS INTEGER) AS cycle_success,
      CAST(epoch(cycle_at) AS BIGINT) - CASE WHEN bad * 4 <= n THEN 0 ELSE 7200 END AS last_success,
      n, good, bad * 100 AS backlog
    FROM (SELECT date_trunc('hour', checked_at) AS cycle_at, count(*) AS n,
        count(*) FILTER (WHERE is_up = 1) AS good, count(*) FILTER (WHERE is_up = 0) AS bad
      FROM samples GROUP BY 1))"""


def writer(column: str) -> str:
    return f"w AS (SELECT 'writer' AS instance, cycle_at AS ts, CAST({column} AS DOUBLE) AS value FROM metrics)"


def q(*parts: str) -> str:
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


_H = grid(3600)
_R = grid(1800)
_WI = instant("w", 7200, "instance", "instance")
_LATEST = f"""SELECT target_name, arg_max(struct_pack(db_type := db_type, environment := environment, host := host,
      port := port, instance := instance, criticality := criticality, team := team), checked_at) AS l,
      max(checked_at) AS checked_at FROM {{src}} GROUP BY target_name"""
_LCOLS = ", ".join(f"l.{c} AS {c}" for c in L.split(", "))
TARGETS = f"""known AS (SELECT target_name, {_LCOLS}, true AS is_active, checked_at AS first_seen_at,
      checked_at AS last_seen_at FROM ({_LATEST.format(src='stored')})),
    targets AS (SELECT * FROM known UNION ALL BY NAME
      SELECT * REPLACE ('db-idle' AS target_name, 'host-idle:5432' AS instance) FROM known WHERE target_name = 'db-0')"""
_GRADE_A = "CASE WHEN {v} IS NULL THEN NULL WHEN {v} >= 99 THEN 'green' WHEN {v} >= 95 THEN 'yellow' ELSE 'red' END"
_GRADE_L = "CASE WHEN {v} IS NULL THEN NULL WHEN {v} >= 3 THEN 'red' WHEN {v} >= 1 THEN 'yellow' ELSE 'green' END"
_GRADE_1 = "CASE WHEN {v} IS NULL THEN NULL WHEN {v} >= 1 THEN 'red' ELSE 'green' END"
_STATUS = "CASE WHEN value = 1 THEN 'UP' WHEN value = 0 THEN 'DOWN' END AS status"
_SUB = f"inner_v AS ({over('success', 'min', 3600)})"
_RNG = "WHERE eval_time > TIMESTAMP '2024-01-01 00:00:00'"
_AVAIL = f"""per_series AS (SELECT {SL}, avg(value) AS value FROM inner_v {_RNG} GROUP BY {SL})"""
_ONE = "WHERE target_name = 'db-2' AND environment = 'production' AND db_type = 'oracle'"
_DAILY = f"kpi AS ({kpi_raw('samples', 'day')})"
_CHANGES = f"""SELECT {SL}, {AS_OF} AS eval_time,
      CAST(count(*) FILTER (WHERE p IS NOT NULL AND p <> value) AS DOUBLE) AS value
    FROM (SELECT *, lag(value) OVER (PARTITION BY {SL} ORDER BY ts) AS p FROM success
      WHERE ts > {{after}} AND ts <= {AS_OF}) GROUP BY {SL}"""
_DOWN_MIN = f"""SELECT {SL}, {AS_OF} AS eval_time, CAST(count(*) FILTER (WHERE value = 0) AS DOUBLE) AS value
    FROM inner_v {_RNG} GROUP BY {SL}"""
_STATUS_EVENTS = f"""SELECT target_name, checked_at AS event_at, {L}, prev AS previous_is_up, is_up AS current_is_up,
      CAST(latency_ms AS DOUBLE) AS latency_ms, error_text
    FROM (SELECT *, lag(is_up) OVER (PARTITION BY target_name ORDER BY checked_at) AS prev FROM samples)
    WHERE prev IS DISTINCT FROM is_up"""
TIMELY = "timely AS (SELECT * FROM samples WHERE CAST(floor(epoch(checked_at)) AS BIGINT) % 50 <> 0)"


def changed(out: str, source: str) -> str:
    """Rows of ``out`` over all samples and over the timely ones, that the other does not have."""
    now, before = out, out.replace(f"FROM {source}", f"FROM timely_{source}" if source != "samples" else "FROM timely")
    return f"""SELECT *, 'added' AS change FROM (({now}) EXCEPT ALL ({before}))
      UNION ALL SELECT *, 'removed' AS change FROM (({before}) EXCEPT ALL ({now}))"""


STITCH = f"""tiers AS (
    SELECT date_trunc('minute', checked_at) AS period_start, target_name, 1 AS n, CAST(is_up = 1 AS INTEGER) AS up,
      'raw' AS tier, 'minute' AS grain, CAST({HIST} AS DATE) - 30 AS since, CAST(NULL AS DATE) AS until FROM samples
    UNION ALL SELECT date_trunc('hour', checked_at), target_name, 1, CAST(is_up = 1 AS INTEGER), 'hourly', 'hour',
      CAST({HIST} AS DATE) - 400, {{hours_until}} FROM samples
    UNION ALL SELECT date_trunc('day', checked_at), target_name, 1, CAST(is_up = 1 AS INTEGER), 'daily', 'day',
      NULL, CAST({HIST} AS DATE) - 400 FROM samples),
  chosen AS (SELECT * FROM tiers WHERE ({{grains}}) AND (since IS NULL OR period_start >= since)
    AND (until IS NULL OR period_start < until) AND period_start >= TIMESTAMP '2000-03-03 07:00:00' AND period_start < {HIST})"""


def stitched(grains: str, hours_until: str) -> str:
    return q(HISTORY, STITCH.format(grains=grains, hours_until=hours_until), f"""SELECT period_start, target_name,
      CAST(sum(n) AS BIGINT) AS probes, CAST(sum(up) AS BIGINT) AS up_probes, {pct('sum(up)', 'sum(n)')} AS availability_pct,
      tier, 'samples' AS weight, grain FROM chosen GROUP BY period_start, target_name, tier, grain""")


_SAMPLE_OUT = f"checked_at, target_name, {L}, is_up, CAST(latency_ms AS DOUBLE) AS latency_ms, error_text"
_ABSENT = """absent AS (SELECT t AS eval_time, CAST(1 AS DOUBLE) AS value FROM grid
      WHERE NOT EXISTS (SELECT 1 FROM minute_hits h WHERE h.t = grid.t))"""
# A sample covers the three grid minutes at or after it.
_HITS = """minute_hits AS (SELECT DISTINCT date_trunc('minute', ts - INTERVAL 1 MICROSECOND)
      + to_minutes(CAST(k AS BIGINT)) AS t FROM success, generate_series(1, 3) AS g(k))"""


def _success_iv(extra: str) -> str:
    return q(SAMPLES, SUCCESS, _H, f"v AS ({instant('success')})", extra)


def _both(extra: str) -> str:
    return q(SAMPLES, SUCCESS, DURATION, _H, f"v AS ({instant('success')})", f"d AS ({instant('duration')})", extra)


_D_UP = f"""SELECT d.* FROM d JOIN v USING ({SL}, eval_time) WHERE v.value = 1"""


def _report(unit: str, by: str = "") -> str:
    b = f", {by}" if by else ""
    return q(HISTORY, _DAILY, f"""SELECT date_trunc('{unit}', CAST(period_start AS TIMESTAMP)) AS period_start{b},
      {_RATIOS} FROM kpi GROUP BY ALL""")


def _break(by: str, where: str = "") -> str:
    return q(HISTORY, _DAILY, f"SELECT {by}, {_RATIOS} FROM kpi {where} GROUP BY ALL")


def _tier(unit: str, tier: str, src: str, weight: str = "samples") -> str:
    return q(SAMPLES, src, f"""SELECT date_trunc('{unit}', period) AS period_start, target_name,
      CAST(sum(n) AS BIGINT) AS probes, CAST(sum(up) AS BIGINT) AS up_probes,
      {pct('sum(up)', 'sum(n)')} AS availability_pct, '{tier}' AS tier, '{weight}' AS weight FROM src GROUP BY 1, 2""")


_BUDGET = "round(probes * 0.005, 4)"

ORACLES = {
    "high_water": q(SAMPLES, "SELECT coalesce(CAST(floor(epoch(max(checked_at))) AS BIGINT), 0) AS high_water FROM samples"),
    "raw_summary": q(SAMPLES, """SELECT count(*) AS samples, min(checked_at) AS first_checked_at,
      max(checked_at) AS last_checked_at FROM samples"""),
    "dedup_new_rows": q(SAMPLES, STORED, BATCH, """copies AS (SELECT * FROM batch UNION ALL
      SELECT * REPLACE (concat('a-', instance) AS instance) FROM batch WHERE is_up = 0)""",
      f"""SELECT {_SAMPLE_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY checked_at, target_name
        ORDER BY instance) AS rn FROM copies) b WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stored s
        WHERE s.checked_at = b.checked_at AND s.target_name = b.target_name)"""),
    "kpi_upsert_replace": q(SAMPLES, STORED, BATCH, f"o AS ({kpi_raw('stored', 'day')})", f"n AS ({kpi_raw('batch', 'day')})",
      """kpi AS (SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n
        WHERE n.period_start = o.period_start AND n.target_name = o.target_name))""", kpi_out("kpi", "period_start")),
    "kpi_merge_additive": q(SAMPLES, STORED, BATCH, NEW,
      f"kpi AS ({merge_kpi(kpi_raw('stored', 'day'), kpi_raw('fresh', 'day'), 'period_start')})", kpi_out("kpi", "period_start")),
    "kpi_merge_additive_hourly": q(SAMPLES, STORED, BATCH, NEW,
      f"kpi AS ({merge_kpi(kpi_raw('stored', 'hour'), kpi_raw('fresh', 'hour'), 'period_hour')})", kpi_out("kpi", "period_hour")),
    "errors_merge_additive": q(SAMPLES, STORED, BATCH, NEW, f"o AS ({errors_raw('stored')})", f"n AS ({errors_raw('fresh')})",
      f"""SELECT period_start, target_name, {', '.join(f'coalesce(n.{c}, o.{c}) AS {c}' for c in L.split(', '))}, error_text,
        coalesce(o.error_count, 0) + coalesce(n.error_count, 0) AS error_count,
        least(o.first_seen_at, n.first_seen_at) AS first_seen_at, greatest(o.last_seen_at, n.last_seen_at) AS last_seen_at
      FROM o FULL JOIN n USING (period_start, target_name, error_text)"""),
    "kpi_rebuild": q(SAMPLES, STORED, BATCH, f"m AS ({minutes('batch')})", f"n AS ({kpi_norm('m', 'day')})",
      f"o AS ({kpi_raw('stored', 'day')})",
      "kpi AS (SELECT * FROM n UNION ALL SELECT * FROM o WHERE period_start < (SELECT min(period_start) FROM n))",
      kpi_out("kpi", "period_start")),
    "staged_samples": q(SAMPLES, """SELECT make_timestamp((epoch_us(checked_at) + 500) // 1000 * 1000) AS checked_at, target_name,
      db_type, environment, host, port, instance, coalesce(criticality, '') AS criticality, coalesce(team, '') AS team, is_up,
      CAST(latency_ms AS DOUBLE) AS latency_ms, error_text FROM samples"""),
    "normalized_tables": q(SAMPLES, "recent AS (SELECT * FROM samples WHERE checked_at >= TIMESTAMP '2024-01-11 00:00:00')",
      "older AS (SELECT * FROM samples WHERE checked_at < TIMESTAMP '2024-01-11 00:00:00')",
      f"m AS ({minutes('recent')})", f"n AS ({kpi_norm('m', 'day')})", f"o AS ({kpi_raw('older', 'day')})",
      "kpi AS (SELECT * FROM n UNION ALL SELECT * FROM o)", kpi_out("kpi", "period_start")),
    "kpi_rebuild_hourly": q(SAMPLES, STORED, BATCH, f"m AS ({minutes('batch')})", f"n AS ({kpi_norm('m', 'hour')})",
      f"o AS ({kpi_raw('stored', 'hour')})",
      "kpi AS (SELECT * FROM n UNION ALL SELECT * FROM o WHERE period_hour < (SELECT min(period_hour) FROM n))",
      kpi_out("kpi", "period_hour")),
    "rebuild_summary": q(SAMPLES, STORED, BATCH, f"m AS ({minutes('batch')})",
      f"nd AS ({kpi_norm('m', 'day')})", f"od AS ({kpi_raw('stored', 'day')})",
      f"nh AS ({kpi_norm('m', 'hour')})", f"oh AS ({kpi_raw('stored', 'hour')})",
      f"ne AS ({errors_norm('m')})", f"oe AS ({errors_raw('stored')})",
      """SELECT (SELECT count(*) FROM m) AS normalized_minute_samples,
        (SELECT count(*) FROM nh) + (SELECT count(*) FROM oh WHERE period_hour < (SELECT min(period_hour) FROM nh)) AS hourly_kpi_rows,
        (SELECT count(*) FROM nd) + (SELECT count(*) FROM od WHERE period_start < (SELECT min(period_start) FROM nd)) AS daily_kpi_rows,
        (SELECT count(*) FROM ne) + (SELECT count(*) FROM oe
          WHERE period_start < (SELECT CAST(min(period_minute) AS DATE) FROM m)) AS daily_error_rows"""),
    "errors_rebuild": q(SAMPLES, STORED, f"""batch AS (SELECT * REPLACE (CASE WHEN CAST(checked_at AS DATE) = CAST({BATCH_FROM} AS DATE)
        THEN 1 ELSE is_up END AS is_up) FROM samples WHERE checked_at >= {BATCH_FROM})""",
      f"m AS ({minutes('batch')})", f"ne AS ({errors_norm('m')})", f"oe AS ({errors_raw('stored')})",
      """edge AS (SELECT CAST(min(checked_at) AS DATE) AS d FROM batch)""",
      "SELECT * FROM ne UNION ALL BY NAME SELECT * FROM oe WHERE period_start < (SELECT d FROM edge)"),
    "documents_to_samples": q(SAMPLES, f"""SELECT make_timestamp(((epoch_us(checked_at) + 500) // 1000) * 1000) AS checked_at, target_name,
        db_type, environment, host, port, instance, coalesce(criticality, '') AS criticality, coalesce(team, '') AS team, is_up,
        CAST(latency_ms + CASE WHEN is_up = 0 THEN 1000 ELSE 0 END AS DOUBLE) AS latency_ms,
        CASE WHEN is_up <> 1 THEN {DEFAULT} END AS error_text
      FROM samples WHERE error_text IS NULL
        AND CAST(make_timestamp(((epoch_us(checked_at) + 500) // 1000) * 1000) AS DATE) <> DATE '2024-01-10'"""),
    "rejected_documents": q(SAMPLES, """days AS (SELECT DISTINCT k.metric, CAST(make_timestamp(((epoch_us(checked_at) + 500) // 1000) * 1000) AS DATE) AS d
        FROM samples, (VALUES ('probe_success', true), ('probe_duration_seconds', false)) k(metric, always)
        WHERE k.always OR latency_ms IS NOT NULL)""",
      "SELECT concat(metric, '-', CAST(d AS VARCHAR), '.json') AS source_file, 'error' AS status FROM days WHERE d = DATE '2024-01-10'"),
    "rejected_values": q(SAMPLES, """SELECT make_timestamp(((epoch_us(checked_at) + 500) // 1000) * 1000) AS checked_at, target_name,
        concat('unreadable value: ', CASE error_text WHEN 'probe failed 0' THEN '1e400' WHEN 'probe failed 1' THEN 'x' ELSE 'NaN' END) AS error_text,
        'is_up is null' AS reason
      FROM samples WHERE error_text IN ('probe failed 0', 'probe failed 1', 'probe failed 2')"""),
    "retention_raw": q(SAMPLES, f"SELECT {_SAMPLE_OUT} FROM samples WHERE checked_at >= {AS_OF} - INTERVAL 10 DAY"),
    "retention_hourly": q(HISTORY, f"kpi AS ({kpi_raw('samples', 'hour')})",
      kpi_out("kpi", "period_hour") + f" WHERE period_hour >= {HIST} - INTERVAL 400 DAY"),
    "retention_daily": q(HISTORY, _DAILY,
      kpi_out("kpi", "period_start") + f" WHERE period_start >= CAST({HIST} AS DATE) - 2192"),
    "retention_events": q(SAMPLES, downtime(), _DOWN_OUT +
      f" WHERE NOT coalesce(down_end < {AS_OF} - INTERVAL 10 DAY, false)"),
    "retention_status_events": q(SAMPLES, _STATUS_EVENTS + f" AND checked_at >= {AS_OF} - INTERVAL 10 DAY"),
    "ingest_metrics": q(SAMPLES, STORED, BATCH, NEW, f"""SELECT {AS_OF} AS cycle_at, 1 AS cycle_success,
      CAST(epoch({AS_OF}) AS BIGINT) AS last_success_timestamp_seconds,
      (SELECT count(*) FROM batch) AS samples_fetched_last_cycle, (SELECT count(*) FROM fresh) AS rows_inserted_last_cycle,
      (SELECT greatest((epoch_us({AS_OF}) - epoch_us(max(checked_at))) // 1000000, 0) FROM batch) AS backfill_remaining_seconds"""),
    "range_window": q(SAMPLES, f"SELECT {_SAMPLE_OUT} FROM samples WHERE checked_at > {BATCH_FROM} AND checked_at <= {AS_OF}"),
    "host_port_split": q(SAMPLES, """pts AS (SELECT CASE WHEN error_text = 'probe failed 3' THEN host ELSE instance END AS instance FROM samples)""",
      """SELECT instance, CASE WHEN regexp_matches(instance, ':[0-9]+$') THEN regexp_extract(instance, '^(.*):([0-9]+)$', 1)
        ELSE instance END AS host, regexp_extract(instance, '^(.*):([0-9]+)$', 2) AS port, count(*) AS samples
      FROM pts GROUP BY 1, 2, 3"""),
    "constraint_violations": q(SAMPLES, f"""SELECT checked_at,
        CASE WHEN error_text = 'probe failed 3' THEN '' ELSE target_name END AS target_name,
        db_type, environment, host, CAST(CASE WHEN error_text = 'probe failed 0' THEN 70000 ELSE port END AS INTEGER) AS port,
        instance, criticality, team, CAST(CASE WHEN error_text = 'probe failed 1' THEN 2 ELSE is_up END AS INTEGER) AS is_up,
        CAST(CASE WHEN error_text = 'probe failed 2' THEN -1 ELSE latency_ms END AS DOUBLE) AS latency_ms, error_text,
        CASE error_text WHEN 'probe failed 0' THEN 'port out of range' WHEN 'probe failed 1' THEN 'is_up not 0 or 1'
          WHEN 'probe failed 2' THEN 'latency_ms negative' ELSE 'target_name is empty' END AS reason
      FROM samples WHERE error_text IS NOT NULL"""),
    "label_filter": q(SAMPLES, f"""SELECT {_SAMPLE_OUT} FROM samples WHERE environment = 'production'
      AND regexp_full_match(db_type, 'postgresql|ora.*')"""),
    "grade": q(SAMPLES, _DAILY, f"v AS ({view('period_start')})",
      f"""SELECT period_start, target_name, availability_pct, {_GRADE_A.format(v='availability_pct')} AS availability_grade,
        {_GRADE_L.format(v='(avg_latency_ms / 1000)')} AS latency_grade, {_GRADE_L.format(v='down_probes')} AS down_grade FROM v"""),
    "merge_success_duration": q(SAMPLES, f"""SELECT (epoch_us(checked_at) + 500) // 1000 AS checked_at_ms, target_name, db_type, environment,
        host, port, instance, coalesce(criticality, '') AS criticality, coalesce(team, '') AS team, is_up,
        CAST(latency_ms + CASE WHEN is_up = 0 THEN 1000 ELSE 0 END AS DOUBLE) AS latency_ms,
        CASE WHEN is_up <> 1 THEN {DEFAULT} END AS error_text
      FROM samples WHERE error_text IS DISTINCT FROM 'probe failed 3'"""),
    "previous_sample": q(SAMPLES, """SELECT target_name, checked_at, is_up,
      lag(is_up) OVER (PARTITION BY target_name ORDER BY checked_at) AS previous_is_up FROM samples"""),
    "target_deactivate": q(SAMPLES, STORED, BATCH, TARGETS, f"""SELECT target_name, {L},
      NOT (last_seen_at < {AS_OF} - INTERVAL 86400 SECOND AND NOT EXISTS (SELECT 1 FROM batch b
        WHERE b.target_name = targets.target_name)) AS is_active, first_seen_at, last_seen_at FROM targets"""),
    "missing_recent_targets": q(SAMPLES, STORED, TARGETS, f"""SELECT t.target_name, t.db_type, t.environment, t.instance, t.criticality,
      max(r.checked_at) AS last_probe_at,
      CAST(round((epoch_us({AS_OF}) - epoch_us(max(r.checked_at))) / 1000000.0) AS BIGINT) AS seconds_since_last_probe
      FROM targets t LEFT JOIN samples r ON r.target_name = t.target_name WHERE t.is_active
      GROUP BY 1, 2, 3, 4, 5 HAVING max(r.checked_at) IS NULL OR max(r.checked_at) < {AS_OF} - INTERVAL 3600 SECOND"""),
    "promql_and": _both(f"SELECT {SL}, eval_time, round(value, 10) AS value FROM ({_D_UP}) WHERE value > 3"),
    "instant_vector": _success_iv("SELECT * FROM v"),
    "minute_samples": q(SAMPLES, f"m AS ({minutes()})", """SELECT * REPLACE (round(latency_ms, 6) AS latency_ms,
      CAST(max_latency_ms AS DOUBLE) AS max_latency_ms) FROM m"""),
    "hourly_kpi_raw": q(SAMPLES, f"kpi AS ({kpi_raw('samples', 'hour')})", kpi_out("kpi", "period_hour")),
    "daily_kpi_raw": q(SAMPLES, _DAILY, kpi_out("kpi", "period_start")),
    "hourly_kpi_norm": q(SAMPLES, f"m AS ({minutes()})", f"kpi AS ({kpi_norm('m', 'hour')})", kpi_out("kpi", "period_hour")),
    "daily_kpi_norm": q(SAMPLES, f"m AS ({minutes()})", f"kpi AS ({kpi_norm('m', 'day')})", kpi_out("kpi", "period_start")),
    "daily_errors_raw": q(SAMPLES, errors_raw("samples")),
    "daily_errors_norm": q(SAMPLES, f"m AS ({minutes()})", errors_norm("m")),
    "daily_availability": q(SAMPLES, f"m AS ({minutes()})", f"kpi AS ({kpi_norm('m', 'day')})", view("period_start")),
    "hourly_availability": q(SAMPLES, f"kpi AS ({kpi_raw('samples', 'hour')})", view("period_hour")),
    "monthly_availability": q(HISTORY, _DAILY, rollup("month")),
    "yearly_availability": q(HISTORY, _DAILY, rollup("year")),
    "latest_per_target": q(SAMPLES, f"SELECT target_name, {_LCOLS}, checked_at FROM ({_LATEST.format(src='samples')})"),
    "target_inventory": q(SAMPLES, STORED, BATCH, TARGETS, f"n AS (SELECT target_name, {_LCOLS}, checked_at FROM ({_LATEST.format(src='batch')}))",
      f"""SELECT target_name, {', '.join(f'CASE WHEN n.target_name IS NULL THEN t.{c} ELSE n.{c} END AS {c}' for c in L.split(', '))},
        coalesce(n.target_name IS NOT NULL OR t.is_active, false) AS is_active,
        coalesce(t.first_seen_at, n.checked_at) AS first_seen_at,
        greatest(t.last_seen_at, n.checked_at) AS last_seen_at
      FROM targets t FULL JOIN n USING (target_name)"""),
    "ingest_health": q(SAMPLES, STORED, TARGETS, f"""SELECT a.n AS active_target_count, r.n AS recent_target_count,
      a.n - r.n AS missing_recent_target_count, l.m AS latest_checked_at,
      CAST(round((epoch_us({AS_OF}) - epoch_us(l.m)) / 1000000.0) AS BIGINT) AS ingest_lag_seconds
      FROM (SELECT count(*) AS n FROM targets WHERE is_active) a,
        (SELECT count(DISTINCT target_name) AS n FROM samples WHERE checked_at >= {AS_OF} - INTERVAL 3600 SECOND) r,
        (SELECT max(checked_at) AS m FROM samples) l"""),
    "status_events": q(SAMPLES, _STATUS_EVENTS),
    "downtime_events": q(SAMPLES, downtime(), _DOWN_OUT),
    "latency_events": q(SAMPLES, latency(f"NOT {_SLOW}"), _SLOW_OUT),
    "downtime_history": q(SAMPLES, downtime(), f"""SELECT target_name, environment, db_type, instance, criticality, team,
      down_start, down_end, last_down_at, {duration('down_start', 'down_end')}, down_samples, first_error_text,
      last_error_text, CAST(round(max_latency_ms, 2) AS DOUBLE) AS max_latency_ms FROM down"""),
    "latency_history": q(SAMPLES, latency(f"NOT {_SLOW}"),
      f"""SELECT target_name, environment, db_type, instance, criticality, team, CAST(3000 AS DOUBLE) AS threshold_ms,
      slow_start, slow_end, last_slow_at, {duration('slow_start', 'slow_end')}, slow_samples,
      {mean('latency_ms_sum', 'latency_ms_count')} AS avg_latency_ms,
      CAST(round(max_latency_ms, 2) AS DOUBLE) AS max_latency_ms FROM slow"""),
    "incremental_status_events": q(SAMPLES, _STATUS_EVENTS + f" AND checked_at >= {STORED_UNTIL}"),
    "incremental_downtime_events": q(SAMPLES, downtime("arg_min_null(error_text, checked_at)"), _DOWN_OUT),
    "incremental_latency_events": q(SAMPLES, latency(f"NOT coalesce({_SLOW}, false)"), _SLOW_OUT),
    "repair_events": q(SAMPLES, TIMELY, downtime(), downtime(src="timely", out="timely_down"), changed(_DOWN_OUT, "down")),
    "repair_latency_events": q(SAMPLES, TIMELY, latency(f"NOT {_SLOW}"), latency(f"NOT {_SLOW}", "timely", "timely_slow"),
      changed(_SLOW_OUT, "slow")),
    "repair_status_events": q(SAMPLES, TIMELY, changed(_STATUS_EVENTS, "samples")),
    "sliding_availability": q(SAMPLES, SUCCESS, grid(60),
      f"SELECT * REPLACE (round(value, 10) AS value) FROM ({over('success', 'avg', 86400)})"),
    "sliding_worst_latency": q(SAMPLES, DURATION, grid(420),
      f"SELECT * REPLACE (round(value, 10) AS value) FROM ({over('duration', 'max', 21600)})"),
    "availability_trend": q(SAMPLES, SUCCESS, grid(600), f"inner_v AS ({over('success', 'min', 600)})",
      f"hours AS (SELECT unnest(generate_series({START}, {AS_OF}, INTERVAL 1 HOUR)) AS h)",
      f"""SELECT {SL}, h AS eval_time, round(avg(value) * 100, 10) AS value FROM hours
        JOIN inner_v ON eval_time > h - INTERVAL 1 DAY AND eval_time <= h GROUP BY ALL"""),
    "min_over_time": q(SAMPLES, SUCCESS, _H, over("success", "min", 10800)),
    "avg_over_time": q(SAMPLES, DURATION, _H, f"SELECT * REPLACE (round(value, 10) AS value) FROM ({over('duration', 'avg', 10800)})"),
    "availability_range": q(SAMPLES, SUCCESS, _H, _SUB, _AVAIL,
      f"SELECT {SL}, {AS_OF} AS eval_time, round(value * 100, 10) AS value FROM per_series"),
    "down_minutes": q(SAMPLES, SUCCESS, _H, _SUB, _DOWN_MIN),
    "status_changes": q(SAMPLES, SUCCESS, _CHANGES.format(after=START)),
    "absent_over_time": q(SAMPLES, SUCCESS, grid(60), _HITS, _ABSENT, "SELECT * FROM absent"),
    "label_values_env": q(SAMPLES, "SELECT DISTINCT environment FROM samples"),
    "label_values_db_type": q(SAMPLES, "SELECT DISTINCT db_type FROM samples WHERE environment = 'production'"),
    "label_values_db_name": q(SAMPLES, "SELECT DISTINCT target_name FROM samples WHERE db_type IN ('mysql', 'oracle')"),
    "alert_states": q(SAMPLES, SUCCESS, _R, f"v AS ({instant('success', 7200)})",
      alert("SELECT * FROM v WHERE value = 0", 1800, 3600), f"SELECT {SL}, eval_time, active_at, state FROM states"),
    "alert_history": q(SAMPLES, SUCCESS, _R, f"v AS ({instant('success', 7200)})",
      alert("SELECT * FROM v WHERE value = 0", 1800, 3600),
      f"""SELECT {SL}, active_at, max(eval_time) AS last_active_at,
        min(eval_time) FILTER (WHERE state = 'firing') AS fired_at,
        CASE WHEN max(eval_time) < {AS_OF} THEN max(eval_time) + INTERVAL 1800 SECOND END AS resolved_at
      FROM states GROUP BY ALL"""),
    "incremental_alert_history": q(SAMPLES, DURATION, _R, f"v AS ({instant('duration', 7200)})",
      alert("SELECT * FROM v WHERE value > 3", 1800, 3600),
      f"""SELECT {SL}, active_at, max(eval_time) AS last_active_at,
        min(eval_time) FILTER (WHERE state = 'firing') AS fired_at,
        CASE WHEN max(eval_time) < {AS_OF} THEN max(eval_time) + INTERVAL 1800 SECOND END AS resolved_at
      FROM states GROUP BY ALL"""),
    "alert_port_down": q(SAMPLES, SUCCESS, _R, f"v AS ({instant('success', 7200)})",
      alert("SELECT * FROM v WHERE value = 0", 1800, 3600),
      alert_out("DBPortDown", "critical", "database", "concat('DB port down: ', target_name)")),
    "alert_probe_slow": q(SAMPLES, SUCCESS, DURATION, _R, f"v AS ({instant('success', 7200)})", f"d AS ({instant('duration', 7200)})",
      alert(f"SELECT * FROM ({_D_UP}) WHERE value > 3", 1800, 3600),
      alert_out("DBPortProbeSlow", "warning", "database", "concat('DB port probe slow: ', target_name)")),
    "alert_scrape_failed": q(SAMPLES, SUCCESS.replace("CAST(is_up AS DOUBLE)",
      "CASE WHEN is_up = 0 AND error_text IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"), _R, f"v AS ({instant('success', 7200)})",
      alert("SELECT * FROM v WHERE value = 0", 1800, 3600),
      alert_out("DBPortProbeScrapeFailed", "critical", "monitoring", "concat('DB port probe scrape failed: ', target_name)")),
    "alert_metrics_missing": q(SAMPLES, SUCCESS, grid(60), _HITS, _ABSENT, alert("SELECT * FROM absent", 60, 60, ""),
      alert_out("DBPortMetricsMissing", "critical", "monitoring", "'All DB port probe metrics are missing'", "")),
    "alert_writer_down": q(SAMPLES, METRICS, writer("CASE WHEN good < 6 THEN 0 ELSE 1 END"), _R, f"v AS ({_WI})",
      alert("SELECT * FROM v WHERE value = 0", 1800, 3600, "instance"),
      alert_out("WriterDown", "critical", "ingest", "'Ingest writer is down'", "instance")),
    "alert_cycle_failed": q(SAMPLES, METRICS, writer("cycle_success"), _R, f"v AS ({_WI})",
      alert("SELECT * FROM v WHERE value = 0", 1800, 3600, "instance"),
      alert_out("WriterCycleFailed", "critical", "ingest", "'Ingest is failing'", "instance")),
    "alert_ingest_stale": q(SAMPLES, METRICS, writer("last_success"), _R, f"v AS ({_WI})",
      alert("SELECT * FROM v WHERE epoch(eval_time) - value > 3600 AND value > 0", 1800, 3600, "instance"),
      alert_out("WriterIngestStale", "critical", "ingest", "'Ingest is stale'", "instance")),
    "alert_backfill_behind": q(SAMPLES, METRICS, writer("backlog"), _R, f"v AS ({_WI})",
      alert("SELECT * FROM v WHERE value > 300", 1800, 3600, "instance"),
      alert_out("WriterBackfillBehind", "warning", "ingest", "'Ingest has a backfill backlog'", "instance")),
    "dash_active_targets": _success_iv("SELECT eval_time, CAST(count(*) AS DOUBLE) AS value FROM v GROUP BY 1"),
    "dash_up_now": _success_iv("SELECT eval_time, sum(value) AS value FROM v GROUP BY 1"),
    "dash_down_now": q(SAMPLES, SUCCESS, _H, _SUB, f"""SELECT eval_time, value, {_GRADE_1.format(v='value')} AS grade FROM (
      SELECT eval_time, CAST(count(*) FILTER (WHERE value = 0) AS DOUBLE) AS value FROM inner_v GROUP BY 1)"""),
    "dash_availability": q(SAMPLES, SUCCESS, _H, _SUB, _AVAIL, f"""SELECT {AS_OF} AS eval_time, round(v * 100, 10) AS value,
      {_GRADE_A.format(v='(v * 100)')} AS grade FROM (SELECT avg(value) AS v FROM per_series)"""),
    "dash_avg_latency": _both(f"""SELECT eval_time, round(v, 10) AS value, {_GRADE_L.format(v='v')} AS grade
      FROM (SELECT eval_time, avg(value) AS v FROM ({_D_UP}) GROUP BY 1)"""),
    "dash_slow_probes": _both(f"""SELECT eval_time, v AS value, {_GRADE_1.format(v='v')} AS grade FROM (SELECT eval_time,
      CAST(count(*) FILTER (WHERE value > 3) AS DOUBLE) AS v FROM ({_D_UP}) GROUP BY 1)"""),
    "dash_down_by_env": _success_iv(f"""SELECT environment, eval_time, v AS value, {_GRADE_L.format(v='v')} AS grade FROM (
      SELECT environment, eval_time, CAST(count(*) FILTER (WHERE value = 0) AS DOUBLE) AS v FROM v GROUP BY 1, 2)"""),
    "dash_down_by_db_type": _success_iv(f"""SELECT db_type, eval_time, v AS value, {_GRADE_L.format(v='v')} AS grade FROM (
      SELECT db_type, eval_time, CAST(count(*) FILTER (WHERE value = 0) AS DOUBLE) AS v FROM v GROUP BY 1, 2)"""),
    "dash_availability_by_env_type": q(SAMPLES, SUCCESS, _H, _SUB, _AVAIL,
      f"""SELECT environment, db_type, {AS_OF} AS eval_time, round(v * 100, 10) AS value, {_GRADE_A.format(v='(v * 100)')} AS grade
      FROM (SELECT environment, db_type, avg(value) AS v FROM per_series GROUP BY 1, 2)"""),
    "dash_down_trend": _success_iv("""SELECT eval_time, CAST(count(*) FILTER (WHERE value = 0) AS DOUBLE) AS value
      FROM v GROUP BY 1"""),
    "dash_latency_trend": q(SAMPLES, SUCCESS, DURATION, _H, _SUB, f"lat AS ({over('duration', 'avg', 3600)})",
      f"""SELECT environment, db_type, eval_time, round(avg(lat.value), 10) AS value FROM lat
      JOIN inner_v USING ({SL}, eval_time) WHERE inner_v.value = 1 GROUP BY 1, 2, 3"""),
    "dash_current_status": q(SAMPLES, SUCCESS, grid(3600, AS_OF), f"v AS ({instant('success', 86400)})", f"SELECT *, {_STATUS} FROM v"),
    "dash_worst_availability": q(SAMPLES, SUCCESS, _H, _SUB, _AVAIL, f"""SELECT {SL}, {AS_OF} AS eval_time,
      round(value * 100, 10) AS value, {_GRADE_A.format(v='(value * 100)')} AS grade FROM per_series"""),
    "dash_target_status": _success_iv(f"SELECT *, {_STATUS} FROM v"),
    "dash_target_availability": q(SAMPLES, SUCCESS, _H, _SUB, _AVAIL,
      f"SELECT {SL}, {AS_OF} AS eval_time, round(value * 100, 10) AS value FROM per_series {_ONE}"),
    "dash_target_last_latency": _both(f"SELECT * REPLACE (round(value, 10) AS value), {_GRADE_L.format(v='value')} AS grade FROM d"),
    "dash_target_status_changes": q(SAMPLES, SUCCESS, f"SELECT * FROM ({_CHANGES.format(after=BATCH_FROM)}) {_ONE}"),
    "dash_target_timeline": _success_iv(f"""SELECT {SL}, value, min(eval_time) AS from_time, max(eval_time) AS last_time,
      min(nxt) FILTER (WHERE nv IS DISTINCT FROM value) AS until_time, count(*) AS points, {_STATUS}
      FROM (SELECT *, sum(CASE WHEN p IS DISTINCT FROM value THEN 1 ELSE 0 END) OVER (PARTITION BY {SL} ORDER BY eval_time) AS grp
        FROM (SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS nv, lead(eval_time) OVER w AS nxt FROM v
          WINDOW w AS (PARTITION BY {SL} ORDER BY eval_time))) GROUP BY {SL}, value, grp"""),
    "dash_target_latency_history": _both("SELECT * REPLACE (round(value, 10) AS value) FROM d"),
    "dash_target_success_history": _success_iv(f"SELECT * FROM v {_ONE}"),
    "dash_target_down_minutes": q(SAMPLES, SUCCESS, _H, _SUB, f"SELECT * FROM ({_DOWN_MIN}) {_ONE}"),
    "dash_target_metadata": q(SAMPLES, SUCCESS, grid(3600, AS_OF), f"v AS ({instant('success', 86400)})", f"SELECT {SL}, eval_time FROM v"),
    "dash_target_down_windows": _success_iv("SELECT * REPLACE (CASE WHEN value = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value) FROM v"),
    "report_period_daily": _report("day"),
    "report_period_weekly": _report("week"),
    "report_period": _report("month", "environment"),
    "report_filter": _break("target_name", "WHERE environment = 'production' AND coalesce(team, '') IN ('dba', 'platform')"),
    "sla_compliance": q(HISTORY, _DAILY, f"b AS (SELECT target_name, {_RATIOS} FROM kpi GROUP BY 1)",
      """SELECT target_name, probes, up_probes, availability_pct, CAST(93.5 AS DOUBLE) AS sla_pct,
      availability_pct >= 93.5 AS sla_met FROM b"""),
    "error_budget": q(HISTORY, _DAILY, f"b AS (SELECT target_name, {_RATIOS} FROM kpi GROUP BY 1)",
      f"""SELECT target_name, probes, down_probes, CAST({_BUDGET} AS DOUBLE) AS budget_probes,
      CAST({_BUDGET} - down_probes AS DOUBLE) AS remaining_probes,
      CAST((down_probes * 4000000 + probes) // (2 * probes) AS DOUBLE) / 100 AS burn_pct FROM b"""),
    "yoy": q(HISTORY, _DAILY, f"""m AS (SELECT target_name, date_trunc('month', CAST(period_start AS TIMESTAMP)) AS period_start,
      {_RATIOS} FROM kpi GROUP BY 1, 2)""",
      """SELECT m.target_name, m.period_start, m.availability_pct, p.availability_pct AS previous_availability_pct,
      round(m.availability_pct - p.availability_pct, 2) AS availability_change,
      m.avg_latency_ms, p.avg_latency_ms AS previous_avg_latency_ms
      FROM m LEFT JOIN m p ON p.target_name = m.target_name AND p.period_start = m.period_start - INTERVAL 1 YEAR"""),
    "history_coverage": q(HISTORY, _DAILY, f"""inventory AS (SELECT DISTINCT concat('db-', CAST(user_id % 8 AS VARCHAR)) AS target_name FROM events
        WHERE ts < {STORED_UNTIL} UNION SELECT 'db-idle' UNION SELECT target_name FROM kpi
        WHERE period_start BETWEEN DATE '1995-01-01' AND DATE '2001-08-01')""",
      f"""SELECT i.target_name, count(period_start) AS days_present, CAST(2405 AS BIGINT) AS days_expected,
      {pct('count(period_start)', '2405')} AS coverage_pct, min(period_start) AS first_day, max(period_start) AS last_day
      FROM inventory i LEFT JOIN kpi ON kpi.target_name = i.target_name
        AND period_start BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' GROUP BY 1"""),
    "breakdown": _break("environment, db_type"),
    "incident_report": q(SAMPLES, downtime(), f"""c AS (SELECT *, greatest(down_start, {BATCH_FROM}) AS clipped_start,
        least(coalesce(down_end, {STORED_UNTIL}), {STORED_UNTIL}) AS clipped_end FROM down
        WHERE down_start < {STORED_UNTIL} AND (down_end IS NULL OR down_end > {BATCH_FROM}))""",
      """SELECT target_name, environment, db_type, criticality, team, clipped_start, clipped_end,
        CAST((epoch_us(clipped_end) - epoch_us(clipped_start) + 5000) // 10000 AS DOUBLE) / 100 AS downtime_seconds,
        down_end IS NULL AS is_open, down_samples, last_error_text FROM c"""),
    "kpi_drift": q(SAMPLES, STORED, f"r AS ({kpi_raw('samples', 'day')})", f"k AS ({kpi_raw('stored', 'day')})",
      f"""SELECT period_start, target_name, r.probes IS NULL AS missing_raw, k.probes IS NULL AS missing_kpi,
      {', '.join(f'coalesce(r.{c}, 0) - coalesce(k.{c}, 0) AS {c}_drift' for c in
                 ['probes', 'up_probes', 'down_probes', 'slow_probes', 'latency_ms_count'])},
      {', '.join(f'CAST(coalesce(r.{c}, 0) - coalesce(k.{c}, 0) AS DOUBLE) AS {c}_drift' for c in ['latency_ms_sum', 'max_latency_ms'])},
      r.probes IS DISTINCT FROM k.probes OR r.up_probes <> k.up_probes OR r.down_probes <> k.down_probes
        OR r.slow_probes <> k.slow_probes OR r.latency_ms_count <> k.latency_ms_count
        OR r.latency_ms_sum <> k.latency_ms_sum OR coalesce(r.max_latency_ms, 0) <> coalesce(k.max_latency_ms, 0) AS has_drift
      FROM r FULL JOIN k USING (period_start, target_name)
      WHERE period_start > (SELECT CAST(min(checked_at) AS DATE) FROM samples)"""),
    "ytd": _break("target_name", "WHERE period_start BETWEEN DATE '2001-01-01' AND DATE '2001-08-01'"),
    "tiered_report_minute": _tier("minute", "raw",
      "src AS (SELECT checked_at AS period, target_name, 1 AS n, CASE WHEN is_up = 1 THEN 1 ELSE 0 END AS up FROM samples)"),
    "tiered_report_minute_weight": _tier("minute", "raw",
      f"src AS (SELECT period_minute AS period, target_name, 1 AS n, is_up AS up FROM ({minutes()}))", "minutes"),
    "tiered_report": _tier("hour", "hourly",
      f"src AS (SELECT period_hour AS period, target_name, probes AS n, up_probes AS up FROM ({kpi_raw('samples', 'hour')}))"),
    "tiered_report_stitched": stitched("true", f"CAST({HIST} AS DATE) - 30"),
    "tiered_report_stitched_hour": stitched("grain <> 'minute'", "CAST(NULL AS DATE)"),
    "tiered_report_week": _tier("week", "daily",
      f"src AS (SELECT CAST(period_start AS TIMESTAMP) AS period, target_name, probes AS n, up_probes AS up FROM ({kpi_raw('samples', 'day')}))"),
}
