"""The same answers in plain SQL, straight from the tables and by other means than the library's."""

from __future__ import annotations

from millwatch.plans.views import RULES, UNITS

NOW = 1_735_689_600_000
DAY = 86_400_000
HOUR = 3_600_000


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else (
        f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)


BASE = f"""
WITH RECURSIVE ev AS (
  SELECT event_id, event_type, value, user_id, 'MC' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS machine_id,
         epoch_us(ts) // 1000 AS ms, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k
  FROM events),
registry AS (
  SELECT DISTINCT machine_id,
         ['compressor', 'turbine', 'pump', 'generator', 'conveyor'][CAST(user_id % 5 + 1 AS INTEGER)] AS machine_type,
         ['zone_A', 'zone_B', 'zone_C', 'zone_D'][CAST(user_id % 4 + 1 AS INTEGER)] AS location
  FROM ev),
tel AS (
  SELECT machine_id,
         ['compressor', 'turbine', 'pump', 'generator', 'conveyor'][CAST(user_id % 5 + 1 AS INTEGER)] AS machine_type,
         ['zone_A', 'zone_B', 'zone_C', 'zone_D'][CAST(user_id % 4 + 1 AS INTEGER)] AS location,
         ms AS "timestamp", value AS gas_temperature, value / 8 AS gas_pressure, k AS humidity,
         k * 32 AS spin_rate, value / 4 AS torque,
         CASE WHEN event_type = 'error' THEN 'fault' ELSE 'running' END AS status,
         CASE WHEN event_type = 'error' THEN 'F000' || CAST(user_id % 4 + 1 AS VARCHAR) END AS fault_code,
         event_id AS seq
  FROM ev WHERE event_type IN ('view', 'click', 'error')),
ctx AS (
  SELECT machine_id AS device_id,
         last_value(CASE WHEN event_type = 'signup' THEN 'R' || CAST(event_id AS VARCHAR) END IGNORE NULLS)
           OVER up AS run_id,
         CASE WHEN event_type = 'signup' THEN 'trackin' ELSE 'trackout' END AS event_type,
         ms AS "timestamp",
         last_value(CASE WHEN event_type = 'signup' THEN ms END IGNORE NULLS) OVER up AS start_ts,
         CASE WHEN event_type = 'purchase' THEN ms END AS end_ts, event_id AS seq
  FROM ev WHERE event_type IN ('signup', 'purchase')
  WINDOW up AS (PARTITION BY machine_id ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING)),
placed AS (
  SELECT t.*, c.run_id, c.event_type, c.start_ts, c.end_ts, c."timestamp" AS context_ts, c.seq AS context_seq
  FROM tel t ASOF LEFT JOIN ctx c ON t.machine_id = c.device_id AND t."timestamp" >= c."timestamp"),
steps AS (
  SELECT *, lag(event_type) OVER w AS p_type, lag(run_id) OVER w AS p_run,
         lead("timestamp") OVER w AS n_ts, lead(event_type) OVER w AS n_type
  FROM ctx WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", seq)),
closes AS (
  SELECT device_id, p_run AS previous_run_id, run_id AS current_run_id, "timestamp" AS ts, seq
  FROM steps WHERE event_type = 'trackin' AND p_type = 'trackin'),
run_table AS (
  SELECT device_id, run_id, "timestamp" AS start_ts, n_ts AS end_ts,
         CASE WHEN n_type IS NULL THEN 'open' WHEN n_type = 'trackout' THEN 'trackout' ELSE 'implicit' END AS closed_by
  FROM steps WHERE event_type = 'trackin'),
inside AS (
  SELECT t.*, CASE WHEN ok THEN run END AS run_id, CASE WHEN ok THEN s END AS start_ts,
         CASE WHEN ok THEN e END AS end_ts
  FROM (SELECT t.*, r.run_id AS run, r.start_ts AS s, r.end_ts AS e,
               r.run_id IS NOT NULL AND (r.end_ts IS NULL OR t."timestamp" <= r.end_ts) AS ok
        FROM tel t ASOF LEFT JOIN run_table r ON t.machine_id = r.device_id AND t."timestamp" >= r.start_ts) t),
flagged AS (
  SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY p.machine_id, p.context_seq ORDER BY p."timestamp", p.seq) = 1
                   THEN c.previous_run_id END AS closed_run,
         CASE WHEN row_number() OVER (PARTITION BY p.machine_id, p.context_seq ORDER BY p."timestamp", p.seq) = 1
                   THEN c.ts END AS closed_ts
  FROM placed p LEFT JOIN closes c ON c.seq = p.context_seq AND c.device_id = p.machine_id),
all_rules AS (
  SELECT * FROM (VALUES {_values(RULES)}) r("offset", rule_id, device_type, measurement, condition, threshold, lo, hi,
    severity, enabled, w_type, w_size, w_slide, duration, expr, agg)),
rules AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY "offset" DESC) AS rn FROM all_rules)
  WHERE rn = 1 AND coalesce(enabled, TRUE)),
rates AS (
  SELECT *, (gas_temperature - lag(gas_temperature) OVER w)
              / nullif(("timestamp" - lag("timestamp") OVER w) / 1000.0::DOUBLE, 0) AS t_rate,
         (torque - lag(torque) OVER w) / nullif(("timestamp" - lag("timestamp") OVER w) / 1000.0::DOUBLE, 0) AS q_rate
  FROM tel WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp", seq)),
fired AS (
  SELECT t.machine_id, t."timestamp", t.seq, r.rule_id, r.condition, r.measurement, r.threshold, r.severity,
         CASE r.severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END AS rank,
         CASE r.measurement WHEN 'gas_temperature' THEN t.gas_temperature WHEN 'gas_pressure' THEN t.gas_pressure
           WHEN 'humidity' THEN t.humidity WHEN 'spin_rate' THEN t.spin_rate ELSE t.torque END AS x,
         CASE r.measurement WHEN 'gas_temperature' THEN t.t_rate WHEN 'torque' THEN t.q_rate END AS rate, r.lo, r.hi,
         t.torque > 20 AND t.humidity < 50 AS combo
  FROM rates t JOIN rules r ON (r.device_type IS NULL OR r.device_type = t.machine_type)
  WHERE r.w_type IS NULL AND r.duration IS NULL),
alerts AS (
  SELECT machine_id AS device_id, sha256(machine_id || '|' || CAST("timestamp" AS VARCHAR) || '|' || rule_id) AS alert_id,
         "timestamp" AS alert_time, rule_id, condition AS alert_type, measurement, x AS value, threshold, severity,
         'rule ' || rule_id || ' on ' || measurement || ' (' || condition || ')' AS message, rank, seq
  FROM fired WHERE CASE condition
    WHEN 'greater_than' THEN x > threshold WHEN 'less_than' THEN x < threshold
    WHEN 'between' THEN x BETWEEN lo AND hi WHEN 'outside' THEN x < lo OR x > hi
    WHEN 'rate_above' THEN rate > threshold WHEN 'rate_below' THEN rate < threshold
    WHEN 'custom' THEN combo END),
worst AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY rank DESC, rule_id) AS rn FROM alerts) WHERE rn = 1),
msgs AS (
  SELECT event_id AS "offset", event_id % 12 AS d, user_id, event_id // 1000 AS minor, event_id % 10 AS patch,
         CASE WHEN event_id % 12 > 5 THEN TRUE ELSE FALSE END AS valid,
         CASE WHEN event_id % 12 NOT IN (2, 4) THEN
           ['compressor', 'turbine', 'pump', 'generator', 'conveyor'][CAST(user_id % 5 + 1 AS INTEGER)] END AS device_type,
         CASE WHEN event_id % 12 = 0 THEN 'v1' WHEN event_id % 12 <> 4 THEN
           '1.' || CAST(event_id // 1000 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) END AS version,
         CASE event_id % 12 WHEN 0 THEN '$.version: not semver'
           WHEN 1 THEN '$.measurements: duplicate gas_temperature' WHEN 2 THEN '$.deviceType: required'
           WHEN 3 THEN '$.measurements[1].dataType: unknown' WHEN 4 THEN '$: invalid JSON'
           WHEN 5 THEN '$.kpivRules[1].threshold: not a pair of numbers' ELSE '' END AS errors
  FROM ev WHERE event_type = 'signup'),
history AS (
  SELECT *, CASE WHEN NOT valid THEN 'REJECT' WHEN top IS NULL THEN 'LOAD'
                 WHEN minor * 10 + patch >= top THEN 'UPDATE' ELSE 'REJECT' END AS event
  FROM (SELECT *, max(CASE WHEN valid THEN minor * 10 + patch END) OVER (
          PARTITION BY device_type ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
        FROM msgs)),
current AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_type ORDER BY "offset" DESC) AS rn
                 FROM history WHERE event <> 'REJECT') WHERE rn = 1),
fields AS (
  SELECT device_type, measurement, kind, unit FROM current, (VALUES
    ('gas_temperature', 'DOUBLE', 'degF'), ('gas_pressure', 'DOUBLE', 'mbar'), ('humidity', 'INT32', '%RH'),
    ('status', 'TEXT', '')) f(measurement, kind, unit))
"""

_BAD = "seq % 50 < 4"
_TYPE = ("CASE seq % 50 WHEN 0 THEN 'JSON_PARSE_ERROR' WHEN 1 THEN 'SCHEMA_VALIDATION_ERROR' "
         "WHEN 2 THEN 'TYPE_CONVERSION_ERROR' WHEN 3 THEN 'JSON_PARSE_ERROR' END")
_TEXT = ("CASE seq % 50 WHEN 0 THEN 'Invalid JSON' WHEN 1 THEN 'Missing required field: machine_id' "
         "WHEN 2 THEN 'Field ''timestamp'' must be numeric' WHEN 3 THEN 'Invalid JSON' END")
_DEVICE = "CASE WHEN seq % 50 = 2 THEN machine_id END"
_ALERT = ("device_id, alert_id, alert_time, rule_id, alert_type, measurement, value, threshold, severity, message")
_TRIM = f"""CASE WHEN start_ts IS NULL THEN 'PENDING' WHEN "timestamp" < start_ts + {HOUR} THEN 'TRIMMED_LEAD'
  WHEN end_ts IS NOT NULL AND "timestamp" > end_ts - {HOUR} THEN 'TRIMMED_TRAIL' ELSE 'KEEP' END"""
_STATS = "count(*) AS n, min({m}) AS {m}_min, max({m}) AS {m}_max, round(avg({m}), 6) AS {m}_avg"

SQL: dict[str, str] = {
    "parse_telemetry": f"SELECT * EXCLUDE seq FROM tel WHERE NOT {_BAD}",
    "parse_generic": """SELECT seq AS "offset", machine_id AS device_id, "timestamp" AS ts,
        CASE WHEN seq % 40 <> 0 THEN gas_temperature END AS temperature, CASE WHEN seq % 40 <> 0 THEN humidity END AS humidity,
        CASE WHEN seq % 40 = 0 THEN 'SCHEMA_VALIDATION_ERROR' END AS error_type,
        CASE WHEN seq % 40 = 0 THEN 'Missing required field: measurements' END AS error_message FROM tel""",
    "parse_context": """SELECT device_id, CASE WHEN event_type = 'trackin' THEN run_id END AS run_id, event_type, "timestamp",
        CASE WHEN event_type = 'trackin' THEN start_ts END AS start_ts, end_ts FROM ctx""",
    "parse_rules": """SELECT event_id AS "offset", 'rule-' || CAST(user_id AS VARCHAR) AS rule_id,
        '1.' || CAST(event_id AS VARCHAR) AS version, 'gas_temperature' AS measurement, 'greater_than' AS condition,
        value AS threshold, 'warning' AS severity,
        CASE event_id % 5 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS enabled FROM ev WHERE event_type = 'click'""",
    "error_split": f"""SELECT seq AS "offset", CASE WHEN seq % 50 NOT IN (0, 1, 3) THEN machine_id END AS machine_id,
        {_TYPE} AS error_type, {_TEXT} AS error_message FROM tel""",
    "dead_letters": f"""SELECT '2025-01-01T00:00:00Z' AS "timestamp", 'telemetry-parser' AS source, {_TYPE} AS error_type,
        {_TEXT} AS error_message, {_DEVICE} AS device_id, count(*) AS n, count(*) AS ids, CAST(0 AS BIGINT) AS traces
        FROM tel WHERE {_BAD} GROUP BY ALL""",
    "dlq_by_device": f"SELECT {_DEVICE} AS device_id, count(*) AS n FROM tel WHERE {_BAD} GROUP BY ALL",
    "dlq_by_type": f"SELECT {_TYPE} AS error_type, count(*) AS n FROM tel WHERE {_BAD} GROUP BY ALL",
    "dlq_rate_5m": f"""SELECT "timestamp" // 300000 * 300000 AS window_start, count(*) AS total,
        count(*) FILTER ({_BAD}) AS dlq, count(*) FILTER ({_BAD}) / count(*) AS dlq_rate
        FROM tel GROUP BY 1 HAVING count(*) FILTER ({_BAD}) / count(*) > 0.01""",
    "repeat_errors": f"""SELECT {_DEVICE} AS device_id, {_TYPE} AS error_type, count(*) AS n FROM tel WHERE {_BAD}
        GROUP BY ALL HAVING count(*) >= 2""",
    "safe_map": """SELECT event_id, CASE WHEN CAST(k AS BIGINT) % 10 <> 0 THEN CAST(k AS BIGINT) END AS ok,
        CASE WHEN CAST(k AS BIGINT) % 10 = 0 THEN 'ValueError: round value ' || CAST(CAST(k AS BIGINT) AS VARCHAR) END AS error
        FROM ev""",
    "scalar_functions": """SELECT event_id,
        CASE WHEN length(repeat(event_type, 5)) <= 22 THEN repeat(event_type, 5)
             ELSE substr(repeat(event_type, 5), 1, 22) || '...' END AS cut,
        'root.factory1.' || machine_id AS path, 'root.sg.weather.' || machine_id AS pattern_path,
        CASE event_id % 3 WHEN 0 THEN ms WHEN 1 THEN ms * 1000 ELSE ms // 1000 END AS millis,
        CAST(trunc(value * 1000) AS BIGINT) AS value_ms,
        strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%SZ') AS iso,
        event_id % 4 <> 0 AS semver_ok,
        CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 20 AS INTEGER) END AS semver_minor,
        CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE '' END AS repeated,
        CAST(event_id % 3 + 1 AS INTEGER) AS severity_rank,
        sha256(machine_id || '|' || CAST(ms AS VARCHAR)) AS id FROM ev""",
    "context_asof": """SELECT machine_id, "timestamp", seq, gas_temperature, run_id, event_type, start_ts, end_ts, context_ts
        FROM placed""",
    "context_active": """SELECT machine_id, CASE WHEN event_type = 'trackin' THEN run_id END AS run_id, count(*) AS n,
        max(gas_temperature) AS max_temperature FROM placed GROUP BY ALL""",
    "implicit_close": """SELECT device_id, 'IMPLICIT_RUN_CLOSE' AS type, previous_run_id, current_run_id,
        ts AS implicit_transition_ts, 'trackin of ' || current_run_id || ' before trackout of ' || previous_run_id AS reason
        FROM closes""",
    "runs": "SELECT * FROM run_table",
    "run_interval_join": 'SELECT machine_id, "timestamp", seq, run_id, start_ts, end_ts FROM inside',
    "dlq_records": f"""SELECT sha256(device_id || '|' || previous_run_id || '|' || current_run_id || '|' || CAST(ts AS VARCHAR))
        AS anomaly_id, device_id, 'SEQUENCE_ANOMALY' AS anomaly_type, 'IMPLICIT_RUN_CLOSE' AS type, previous_run_id,
        current_run_id, ts AS implicit_transition_ts,
        'trackin of ' || current_run_id || ' before trackout of ' || previous_run_id AS reason, 'UNRESOLVED' AS status,
        'MATCH_WITH_DELAYED_TRACKOUT' AS resolution_action, {NOW} AS created_ts, CAST(NULL AS BIGINT) AS resolved_ts FROM closes""",
    "reconcile_trackout": """, chain AS (
          SELECT device_id, run_id, lag(run_id) OVER (PARTITION BY device_id ORDER BY "timestamp", seq) AS prior
          FROM ctx WHERE event_type = 'trackin'),
        outs AS (
          SELECT o.device_id, CASE WHEN o.seq % 3 = 0 THEN c.prior ELSE o.run_id END AS run_id, o."timestamp" AS ts
          FROM ctx o LEFT JOIN chain c ON c.device_id = o.device_id AND c.run_id = o.run_id
          WHERE o.event_type = 'trackout')
        SELECT c.device_id, c.previous_run_id, c.current_run_id, c.ts AS implicit_transition_ts,
          CASE WHEN min(o.ts) IS NULL THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS status, min(o.ts) AS resolved_ts
        FROM closes c LEFT JOIN outs o ON o.device_id = c.device_id AND o.run_id = c.previous_run_id AND o.ts >= c.ts
        GROUP BY ALL""",
    "anomaly_dlq": """SELECT sha256(f.machine_id || '|' || c.previous_run_id || '|' || c.current_run_id || '|' ||
          CAST(c.ts AS VARCHAR)) AS anomaly_id, f.machine_id AS device_id, c.previous_run_id, c.current_run_id,
          c.ts AS implicit_transition_ts, 'UNRESOLVED' AS status
        FROM flagged f JOIN closes c ON c.device_id = f.machine_id AND c.ts = f.closed_ts""",
    "rules_latest": """SELECT rule_id, version, threshold, "offset" FROM (
          SELECT 'rule-' || CAST(user_id AS VARCHAR) AS rule_id, '1.' || CAST(event_id AS VARCHAR) AS version,
            value AS threshold, event_id AS "offset",
            row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev WHERE event_type = 'click')
        WHERE rn = 1 AND "offset" % 5 <> 0""",
    "rule_validate": """SELECT 'rule-' || CAST(event_id AS VARCHAR) AS rule_id,
        CASE event_id % 10 WHEN 0 THEN 'unknown condition' WHEN 1 THEN 'unknown measurement' WHEN 2 THEN 'missing threshold'
          WHEN 3 THEN 'missing range' WHEN 4 THEN 'unknown aggregate' WHEN 8 THEN '' WHEN 9 THEN ''
          ELSE 'unusable expression' END AS errors FROM ev WHERE event_type = 'click'""",
    "rules_in_force": """, sent AS (
          SELECT machine_type, ms, arg_max(value, event_id) AS threshold, max(event_id) % 7 <> 0 AS enabled
          FROM ev JOIN registry USING (machine_id) WHERE event_type = 'click' GROUP BY machine_type, ms)
        SELECT machine_id AS device_id, sha256(machine_id || '|' || CAST("timestamp" AS VARCHAR) || '|limit-' || t.machine_type) AS alert_id,
          "timestamp" AS alert_time, 'limit-' || t.machine_type AS rule_id, 'greater_than' AS alert_type, 'gas_temperature' AS measurement,
          gas_temperature AS value, threshold, 'warning' AS severity,
          'rule limit-' || t.machine_type || ' on gas_temperature (greater_than)' AS message
        FROM tel t ASOF JOIN sent s ON t.machine_type = s.machine_type AND t."timestamp" >= s.ms
        WHERE enabled AND gas_temperature > threshold""",
    "rule_instant": f"SELECT {_ALERT} FROM alerts WHERE alert_type NOT IN ('rate_above', 'rate_below', 'custom')",
    "rule_join": """SELECT f.machine_id, f.rule_id, count(*) AS judged, count(a.seq) AS breached
        FROM fired f LEFT JOIN alerts a ON a.seq = f.seq AND a.rule_id = f.rule_id
        WHERE f.condition IN ('greater_than', 'less_than', 'between', 'outside') GROUP BY ALL""",
    "rule_custom": f"SELECT {_ALERT} FROM alerts WHERE alert_type = 'custom'",
    "rate_of_change": """SELECT machine_id, "timestamp", seq, t_rate AS gas_temperature_rate, q_rate AS torque_rate FROM rates""",
    "rule_rate": f"SELECT {_ALERT} FROM alerts WHERE alert_type IN ('rate_above', 'rate_below')",
    "rule_sustained": f""", judged AS (
          SELECT t.machine_id, t."timestamp", t.seq, r.*,
            CASE r.measurement WHEN 'gas_temperature' THEN t.gas_temperature ELSE t.gas_pressure END AS x
          FROM tel t JOIN rules r ON (r.device_type IS NULL OR r.device_type = t.machine_type) WHERE r.duration > 0),
        hit AS (SELECT *, CASE condition WHEN 'greater_than' THEN x > threshold ELSE x < threshold END AS b FROM judged),
        isl AS (SELECT *, sum(CASE WHEN b THEN 0 ELSE 1 END) OVER (PARTITION BY machine_id, rule_id ORDER BY "timestamp", seq) AS g
                FROM hit),
        since AS (SELECT *, min("timestamp") OVER (PARTITION BY machine_id, rule_id, g) AS s FROM isl WHERE b)
        SELECT machine_id AS device_id, sha256(machine_id || '|' || CAST("timestamp" AS VARCHAR) || '|' || rule_id) AS alert_id,
          "timestamp" AS alert_time, rule_id, condition AS alert_type, measurement, x AS value, threshold, severity,
          'rule ' || rule_id || ' on ' || measurement || ' (' || condition || ')' AS message
        FROM since WHERE "timestamp" - s >= duration * 1000""",
    "rule_windowed": f"""SELECT machine_id AS device_id, 'daily' AS rule_id, "timestamp" // {DAY} * {DAY} + {DAY} AS alert_time,
          'gas_temperature' AS measurement, 'warning' AS severity, round(avg(gas_temperature), 6) AS value,
          CAST(60 AS DOUBLE) AS threshold FROM tel GROUP BY ALL HAVING avg(gas_temperature) > 60
        UNION ALL
        SELECT machine_id, 'slide', w + {DAY}, 'humidity', 'info', round(avg(humidity), 6), CAST(40 AS DOUBLE)
        FROM (SELECT *, unnest(["timestamp" // {DAY // 2} * {DAY // 2}, "timestamp" // {DAY // 2} * {DAY // 2} - {DAY // 2}]) AS w
              FROM tel) GROUP BY machine_id, w HAVING avg(humidity) < 40
        UNION ALL
        SELECT machine_id, 'peak', "timestamp" // {2 * DAY} * {2 * DAY} + {2 * DAY}, 'torque', 'critical', round(max(torque), 6),
          CAST(30 AS DOUBLE) FROM tel WHERE machine_type = 'pump'
        GROUP BY machine_id, "timestamp" // {2 * DAY} * {2 * DAY} + {2 * DAY} HAVING max(torque) > 30""",
    "evaluation": """SELECT f.machine_id AS device_id, f."timestamp", gas_temperature, gas_pressure, humidity, spin_rate,
        torque, status, fault_code, run_id, event_type, start_ts, end_ts, w.rule_id IS NULL AS passed,
        w.rule_id AS alert_rule, w.severity AS alert_severity, f.closed_run FROM flagged f LEFT JOIN worst w ON w.seq = f.seq""",
    "evaluation_messages": """SELECT t.machine_id AS device_id, t."timestamp",
        CASE WHEN w.rule_id IS NULL THEN 'true' ELSE 'false' END AS passed, w.rule_id,
        t.fault_code IS NULL AS null_kept FROM tel t LEFT JOIN worst w ON w.seq = t.seq""",
    "alerts": f"SELECT {_ALERT} FROM alerts",
    "alert_counts": "SELECT rule_id, severity, count(*) AS n FROM alerts GROUP BY ALL",
    "series_6h": f"""SELECT machine_id, "timestamp" AS event_time, gas_temperature FROM tel
        WHERE "timestamp" > (SELECT max("timestamp") FROM tel) - {6 * HOUR}""",
    "series_devices": """SELECT machine_id, "timestamp" AS event_time, gas_temperature, torque FROM tel
        WHERE machine_id BETWEEN 'MC000001' AND 'MC000010'""",
    "series_ordered": """SELECT machine_id, "timestamp" AS event_time, humidity FROM tel WHERE machine_id LIKE 'MC00000%'""",
    "series_pivot": 'SELECT "timestamp" AS event_time, ' + ", ".join(
        f"max(CASE WHEN machine_id = 'MC{i:06d}' THEN gas_temperature END) AS MC{i:06d}" for i in range(1, 11))
        + " FROM tel WHERE machine_id BETWEEN 'MC000001' AND 'MC000010' GROUP BY 1",
    "last_value": """SELECT machine_id, arg_max(gas_temperature, "timestamp") AS gas_temperature, max("timestamp") AS "timestamp"
        FROM tel GROUP BY 1""",
    "count_by_device": "SELECT machine_id, count(*) AS n FROM tel GROUP BY 1",
    "count_by_path": "SELECT 'root.factory1.' || machine_id AS device_path, count(*) AS n FROM tel GROUP BY 1",
    "timeseries_list": """SELECT DISTINCT machine_id AS device_id, m AS measurement,
        'root.factory1.' || machine_id || '.' || m AS path
        FROM tel, (VALUES ('gas_temperature'), ('gas_pressure'), ('humidity'), ('spin_rate'), ('torque')) v(m)""",
    "first_10": 'SELECT * FROM tel ORDER BY "timestamp", machine_id LIMIT 10',
    "any_message": "SELECT count(*) > 0 AS present FROM tel",
    "bronze_projection": """SELECT machine_id, machine_type, location, seq, "timestamp", gas_temperature, gas_pressure,
        humidity, spin_rate, torque, status, fault_code, 'root.factory1.' || machine_id AS device_path,
        "timestamp" AS event_time, strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') AS date FROM tel""",
    "dedupe_series": f"""SELECT * EXCLUDE rn FROM (
          SELECT * REPLACE ("timestamp" // {DAY} * {DAY} AS "timestamp"),
            row_number() OVER (PARTITION BY machine_id, "timestamp" // {DAY} ORDER BY seq DESC) AS rn FROM tel) WHERE rn = 1""",
    "color_class": """SELECT machine_id, "timestamp", seq, gas_temperature,
        CASE WHEN gas_temperature >= 80 THEN 'red' ELSE 'green' END AS color FROM tel""",
    "noisiest": "SELECT device_id, count(*) AS n FROM alerts GROUP BY 1 ORDER BY n DESC, device_id LIMIT 10",
    "stats_1m": f"""SELECT machine_id, "timestamp" // 60000 * 60000 AS window_start, "timestamp" // 60000 * 60000 + 60000
        AS window_end, count(*) AS n, """ + ", ".join(
        f"round(min({m}), 6) AS {m}_min, round(max({m}), 6) AS {m}_max, round(avg({m}), 6) AS {m}_avg, "
        f"round(stddev_samp({m}), 6) AS {m}_stddev" for m in ("gas_temperature", "humidity")) + " FROM tel GROUP BY ALL",
    "sliding_stats": f"""SELECT machine_id, w AS window_start, {_STATS.format(m="gas_temperature")},
        round(stddev_samp(gas_temperature), 6) AS gas_temperature_stddev
        FROM (SELECT *, unnest(list_transform([0, 1, 2, 3], lambda i: "timestamp" // {6 * HOUR} * {6 * HOUR} - i * {6 * HOUR})) AS w
              FROM tel) GROUP BY ALL""",
    "sessions": f""", gaps AS (
          SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w < {12 * HOUR} THEN 0 ELSE 1 END AS g FROM tel
          WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp", seq)),
        numbered AS (SELECT *, sum(g) OVER (PARTITION BY machine_id ORDER BY "timestamp", seq) AS s FROM gaps)
        SELECT machine_id, min("timestamp") AS session_start, max("timestamp") AS last_seen, count(*) AS n
        FROM numbered GROUP BY machine_id, s""",
    "shift_agg": f"""SELECT machine_id, "timestamp" // {8 * HOUR} * {8 * HOUR} AS window_start, {_STATS.format(m="gas_temperature")}
        FROM tel WHERE seq NOT IN (SELECT seq FROM alerts) GROUP BY ALL""",
    "ewma": """, numbered AS (
          SELECT machine_id, "timestamp", seq, gas_temperature AS x,
            row_number() OVER (PARTITION BY machine_id ORDER BY "timestamp", seq) AS i FROM tel),
        chain AS (
          SELECT machine_id, "timestamp", seq, i, x AS s FROM numbered WHERE i = 1
          UNION ALL
          SELECT n.machine_id, n."timestamp", n.seq, n.i, CAST(0.3 AS DOUBLE) * n.x + CAST(0.7 AS DOUBLE) * c.s
          FROM chain c JOIN numbered n ON n.machine_id = c.machine_id AND n.i = c.i + 1)
        SELECT machine_id, "timestamp", seq, round(s + 1.2345678901e-7, 6) AS gas_temperature_ewma FROM chain""",
    "cusum": """, numbered AS (
          SELECT machine_id, "timestamp", seq, gas_temperature - 55 AS d,
            row_number() OVER (PARTITION BY machine_id ORDER BY "timestamp", seq) AS i FROM tel),
        chain AS (
          SELECT machine_id, "timestamp", seq, i, greatest(d, 0) AS s FROM numbered WHERE i = 1
          UNION ALL
          SELECT n.machine_id, n."timestamp", n.seq, n.i, greatest(c.s + n.d, 0)
          FROM chain c JOIN numbered n ON n.machine_id = c.machine_id AND n.i = c.i + 1)
        SELECT machine_id, "timestamp", seq, round(s, 6) AS gas_temperature_cusum, s > 150 AS gas_temperature_alarm FROM chain""",
    "zscore": """SELECT machine_id, "timestamp", seq, round((humidity - avg(humidity) OVER w) / nullif(stddev_samp(humidity) OVER w, 0), 6)
        AS humidity_z FROM tel WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp", seq ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""",
    "latency_pct": """, lat AS (SELECT event_type, CAST(trunc(value * 1000) AS BIGINT) AS v FROM events)
        SELECT event_type, count(*) AS n, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.95) AS p95,
        quantile_disc(v, 0.99) AS p99 FROM lat GROUP BY 1""",
    "edge_trim": f"""SELECT machine_id, "timestamp", seq, run_id, start_ts, end_ts, {_TRIM} AS disposition FROM inside
        WHERE {_TRIM} NOT LIKE 'TRIMMED%'""",
    "edge_trim_tag": f"SELECT machine_id, {_TRIM} AS disposition, count(*) AS n FROM inside GROUP BY ALL",
    "edge_trim_manifest": f""", conf AS (
          SELECT device_type, (3600 + "offset" % 7 * 600) * 1000 AS lead, {HOUR} AS trail, user_id % 2 = 0 AS tag FROM current),
        cut AS (
          SELECT i.*, tag, CASE WHEN start_ts IS NULL THEN 'PENDING' WHEN "timestamp" < start_ts + lead THEN 'TRIMMED_LEAD'
            WHEN end_ts IS NOT NULL AND "timestamp" > end_ts - trail THEN 'TRIMMED_TRAIL' ELSE 'KEEP' END AS disposition
          FROM inside i JOIN conf ON conf.device_type = i.machine_type)
        SELECT machine_id, "timestamp", seq, run_id, disposition FROM cut WHERE tag OR disposition NOT LIKE 'TRIMMED%'""",
    "manifest_validate": 'SELECT "offset", version, valid, errors FROM msgs',
    "manifest_history": """SELECT "offset", device_type, version, event, CASE WHEN event = 'REJECT' THEN 'REJECTED'
        ELSE 'ACCEPTED' END AS status, CASE WHEN NOT valid THEN errors WHEN event = 'REJECT' THEN 'version downgrade' END AS reason
        FROM history""",
    "manifest_intervals": """SELECT device_type, version, "offset" AS valid_from,
        lead("offset") OVER (PARTITION BY device_type ORDER BY "offset") AS valid_to FROM history WHERE event <> 'REJECT'""",
    "manifest_versions": """SELECT device_type, version, max("offset") AS last_offset, count(*) AS loads FROM history
        WHERE event <> 'REJECT' GROUP BY ALL""",
    "manifest_current": """SELECT device_type, version, 'root.sg.plant' AS storage_group,
        CAST(3600 + "offset" % 7 * 600 AS DOUBLE) AS lead_seconds, CAST(2 AS BIGINT) AS rules FROM current""",
    "manifest_lookup": """SELECT machine_type, c.version, CASE WHEN c.version IS NOT NULL THEN 'mbar' END AS unit, count(*) AS n
        FROM tel LEFT JOIN current c ON c.device_type = machine_type GROUP BY ALL""",
    "manifest_rules": """SELECT machine_type || '/hot' AS rule_id, 'warning' AS severity, count(*) AS n FROM tel
          WHERE gas_temperature > 100 AND machine_type IN (SELECT device_type FROM current) GROUP BY ALL
        UNION ALL
        SELECT machine_type || '/band', 'warning', count(*) FROM tel
          WHERE gas_pressure BETWEEN 5 AND 8 AND machine_type IN (SELECT device_type FROM current) GROUP BY ALL""",
    "schema_requests": """, asked AS (SELECT r.machine_id, f.* FROM registry r JOIN fields f ON f.device_type = r.machine_type)
        SELECT DISTINCT 'CREATE_STORAGE_GROUP' AS kind, 'root.sg.plant' AS storage_group, CAST(NULL AS VARCHAR) AS template,
          CAST(NULL AS VARCHAR) AS device_path, CAST(NULL AS VARCHAR) AS measurement, CAST(NULL AS VARCHAR) AS data_type,
          CAST(NULL AS VARCHAR) AS encoding, CAST(NULL AS VARCHAR) AS compression FROM current
        UNION ALL SELECT 'CREATE_TEMPLATE', NULL, 'tpl_' || device_type, NULL, measurement, kind, 'GORILLA', 'SNAPPY' FROM fields
        UNION ALL SELECT 'APPLY_TEMPLATE', 'root.sg.plant', 'tpl_' || machine_type, 'root.sg.plant.' || machine_id, NULL, NULL,
          NULL, NULL FROM registry WHERE machine_type IN (SELECT device_type FROM current)
        UNION ALL SELECT 'CREATE_TIMESERIES', 'root.sg.plant', NULL, 'root.sg.plant.' || machine_id, measurement, kind, 'GORILLA',
          'SNAPPY' FROM asked""",
    "new_series": """SELECT DISTINCT machine_id AS device_id, m AS measurement
        FROM tel, (VALUES ('gas_temperature'), ('gas_pressure'), ('humidity'), ('spin_rate'), ('torque')) v(m)
        WHERE NOT EXISTS (SELECT 1 FROM fields f WHERE f.device_type = tel.machine_type AND f.measurement = v.m)""",
    "unknown_devices": """SELECT r.machine_type AS device_type, r.machine_id AS device_id FROM registry r
        JOIN current c ON c.device_type = r.machine_type
        WHERE CAST(substr(r.machine_id, 3) AS BIGINT) NOT IN (c.user_id, c.user_id + 5, c.user_id + 10)""",
    "normalize_units": f""", u AS (SELECT * FROM (VALUES {_values(UNITS)}) u(unit, canonical, scale, shift)),
        long AS (
          SELECT machine_id, machine_type, "timestamp", seq, 'gas_temperature' AS m, gas_temperature AS v, NULL AS t FROM tel
          UNION ALL SELECT machine_id, machine_type, "timestamp", seq, 'gas_pressure', gas_pressure, NULL FROM tel
          UNION ALL SELECT machine_id, machine_type, "timestamp", seq, 'humidity', CASE WHEN seq % 20 <> 0 THEN humidity END, NULL FROM tel
          UNION ALL SELECT machine_id, machine_type, "timestamp", seq, 'status', NULL, status FROM tel
          UNION ALL SELECT machine_id, machine_type, "timestamp", seq, 'torque', NULL, NULL FROM tel)
        SELECT l.machine_id AS device_id, l.machine_type AS device_type, l."timestamp", l.m AS measurement,
          l.v * coalesce(u.scale, 1.0::DOUBLE) + coalesce(u.shift, 0.0::DOUBLE) AS value, l.t AS text,
          coalesce(u.canonical, f.unit) AS unit,
          CASE WHEN f.kind IS NULL THEN 'SCHEMA_VALIDATION_ERROR'
               WHEN l.m = 'humidity' AND l.v IS NULL THEN 'TYPE_CONVERSION_ERROR' END AS error_type
        FROM long l LEFT JOIN fields f ON f.device_type = l.machine_type AND f.measurement = l.m LEFT JOIN u ON u.unit = f.unit""",
    "dim_join": """SELECT r.machine_type, r.location, count(*) AS n, max(gas_temperature) AS max_temperature
        FROM tel JOIN registry r USING (machine_id) GROUP BY r.machine_type, r.location""",
    "fault_bands": """SELECT machine_id, "timestamp", seq, concat_ws(',',
          CASE WHEN spin_rate BETWEEN 3500 AND 4200 AND torque BETWEEN 18 AND 25 THEN 'high_vibration' END,
          CASE WHEN humidity BETWEEN 5 AND 15 THEN 'low_humidity' END,
          CASE WHEN gas_temperature BETWEEN 380 AND 450 AND gas_pressure BETWEEN 6.5 AND 8 THEN 'overpressure' END,
          CASE WHEN gas_temperature BETWEEN 470 AND 520 AND gas_pressure BETWEEN 4.5 AND 6 THEN 'overtemp' END) AS profiles
        FROM tel""",
    "status_counts": "SELECT status, fault_code, count(*) AS n FROM tel GROUP BY ALL",
    "utilization": """, held AS (
          SELECT *, coalesce(lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "timestamp", seq) - "timestamp", 0) AS h FROM tel)
        SELECT machine_id, CAST(sum(CASE WHEN status = 'running' THEN h ELSE 0 END) AS BIGINT) AS running_ms,
          CAST(sum(h) AS BIGINT) AS total_ms,
          CAST(sum(CASE WHEN status = 'running' THEN h ELSE 0 END) AS DOUBLE) / nullif(CAST(sum(h) AS DOUBLE), 0) AS utilization
        FROM held GROUP BY 1""",
    "throughput": f"""SELECT device_id, end_ts // {DAY} * {DAY} AS window_start, count(*) AS runs FROM run_table
        WHERE closed_by = 'trackout' GROUP BY ALL""",
    "oee": """, held AS (
          SELECT *, coalesce(lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "timestamp", seq) - "timestamp", 0) AS h FROM tel),
        totals AS (
          SELECT machine_id, CAST(sum(CASE WHEN status = 'running' THEN h ELSE 0 END) AS DOUBLE) AS run,
            CAST(sum(h) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS n,
            CAST(count(*) FILTER (seq NOT IN (SELECT seq FROM alerts)) AS DOUBLE) AS good FROM held GROUP BY 1),
        parts AS (
          SELECT machine_id, run / nullif(total, 0) AS a, least(1.0::DOUBLE, n * 3600000.0::DOUBLE / nullif(run * 0.1::DOUBLE, 0)) AS p,
            good / n AS q FROM totals)
        SELECT machine_id, round(a, 9) AS availability, round(p, 9) AS performance, round(q, 9) AS quality,
          round(a * p * q, 9) AS oee FROM parts""",
    "counters": f"""SELECT count(*) AS total, count(*) FILTER ({_TRIM} = 'KEEP') AS kept,
        count(*) FILTER ({_TRIM} LIKE 'TRIMMED%') AS trimmed, count(*) FILTER ({_TRIM} = 'PENDING') AS pending FROM inside""",
    "manifest_counters": """SELECT count(*) AS total, count(*) FILTER (event = 'LOAD') AS loaded,
        count(*) FILTER (event = 'UPDATE') AS updated, count(*) FILTER (event = 'REJECT') AS rejected,
        count(*) FILTER (event = 'REJECT' AND valid) AS downgrades FROM history""",
    "stream_parse": f"""SELECT seq AS "offset", CASE WHEN seq % 50 NOT IN (0, 1, 3) THEN machine_id END AS machine_id,
        CASE WHEN seq % 50 NOT IN (0, 2, 3) THEN "timestamp" END AS "timestamp",
        CASE WHEN seq % 50 NOT IN (0, 3) THEN gas_temperature END AS gas_temperature, {_TYPE} AS error_type FROM tel""",
    "stream_context": """SELECT machine_id, "timestamp", seq, gas_temperature, event_type, context_ts FROM placed""",
    "stream_late": """SELECT machine_id, "timestamp", seq, event_type, context_ts,
        seq % 10 = 0 AND "timestamp" <= (SELECT max(ms) FROM ev WHERE event_type IN ('signup', 'purchase') OR
          event_type IN ('view', 'click', 'error') AND event_id % 10 <> 0) - 60000 AS late FROM placed""",
    "stream_clock": f"""SELECT seq AS "offset",
        coalesce({_TYPE}, CASE WHEN seq % 97 = 0 THEN 'CLOCK_ERROR' ELSE 'placed' END) AS outcome FROM tel""",
    "stream_trim": f"""SELECT machine_id, "timestamp", seq, run_id, start_ts, {_TRIM} AS disposition FROM inside""",
    "stream_trim_outputs": f"""SELECT machine_id, "timestamp", seq, run_id, CASE {_TRIM} WHEN 'PENDING' THEN 'pending'
        WHEN 'KEEP' THEN 'kept' ELSE 'trimmed' END AS output FROM inside""",
    "stream_guard": """SELECT device_id, previous_run_id, current_run_id, ts AS implicit_transition_ts FROM closes""",
    "stream_stats": f"""SELECT machine_id, "timestamp" // {HOUR} * {HOUR} AS window_start, count(*) AS n,
        min(gas_temperature) AS gas_temperature_min, max(gas_temperature) AS gas_temperature_max FROM tel
        GROUP BY 1, 2""",
    "stream_sessions": f""", gaps AS (
          SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w < {12 * HOUR} THEN 0 ELSE 1 END AS g FROM tel
          WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp", seq)),
        numbered AS (SELECT *, sum(g) OVER (PARTITION BY machine_id ORDER BY "timestamp", seq) AS s FROM gaps)
        SELECT machine_id, min("timestamp") AS session_start, max("timestamp") AS last_seen, count(*) AS n
        FROM numbered GROUP BY machine_id, s""",
    "stream_rules": f"""SELECT device_id, alert_time, rule_id, device_id AS key FROM alerts
        WHERE alert_type NOT IN ('rate_above', 'rate_below') AND NOT {_BAD}""",
    "stream_bronze": f"""SELECT 'root.factory1.' || machine_id AS device_path,
        strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') AS date, count(*) AS n,
        max(gas_temperature) AS max_temperature FROM tel WHERE NOT {_BAD} GROUP BY ALL""",
    "stream_dead_letters": f"""SELECT {_DEVICE} AS key, {_TYPE} AS error_type, count(*) AS n FROM tel WHERE {_BAD} GROUP BY ALL""",
    "topic_lag": """SELECT 'sensor-topic' AS topic, CAST(seq % 8 AS INTEGER) AS partition, max(seq) AS end_offset,
        max(seq) FILTER ("timestamp" < epoch_us(TIMESTAMP '2024-01-25') // 1000) AS committed,
        max(seq) - coalesce(max(seq) FILTER ("timestamp" < epoch_us(TIMESTAMP '2024-01-25') // 1000), -1) AS lag
        FROM tel GROUP BY ALL""",
}


SQL["stream_ewma"] = SQL["ewma"]
SQL["stream_manifests"] = SQL["manifest_history"]
SQL["stream_trim_manifest"] = SQL["edge_trim_manifest"]
SQL["stream_dedupe"] = SQL["dedupe_series"]
SQL["bronze_6h"] = SQL["series_6h"]
SQL["bronze_devices"] = SQL["series_devices"]
SQL["stream_evaluation"] = SQL["evaluation"]
SQL["stream_late_context"] = SQL["stream_context"]
for _kind in ("rate", "sustained", "windowed"):
    SQL[f"stream_rule_{_kind}"] = SQL[f"rule_{_kind}"]


def oracle_sql() -> dict[str, str]:
    return {name: f"{BASE.rstrip()}{body}" if body.startswith(",") else f"{BASE.rstrip()}\n{body}"
            for name, body in SQL.items()}
