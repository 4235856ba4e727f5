"""Queries for sensor and command streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import commands as C
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T
from kestrel.streaming import debounce as DB

# The fixture's readings are hours apart, so the hold is 12 hours here.
HOLD_MS = 43_200_000

_DEBOUNCE_SQL = with_views("sensor_readings") + f""",
r AS (SELECT *, sum(CASE WHEN value >= 30 THEN 1 ELSE 0 END) OVER (PARTITION BY device ORDER BY ts_ms, seq
        ROWS UNBOUNDED PRECEDING) AS island FROM sensor_readings),
d AS (SELECT *, min(ts_ms) OVER (PARTITION BY device, island) AS run_start FROM r WHERE value < 30),
t AS (SELECT *, row_number() OVER (PARTITION BY device, island ORDER BY ts_ms, seq) AS rn FROM d
      WHERE ts_ms - run_start > {HOLD_MS})
SELECT device, seq AS trigger_seq, ts_ms AS trigger_ts, run_start, ts_ms - run_start AS held_ms FROM t WHERE rn = 1"""


@register("debounce_triggers", _DEBOUNCE_SQL)
def debounce_triggers(spark, sf_dir):
    """T1 batch twin (gaps and islands): one trigger per dark run held > 12 h."""
    return DB.debounce_batch(T.sensor_readings(spark, sf_dir), 30, HOLD_MS)


@register("debounce_triggers_stream", _DEBOUNCE_SQL)
def debounce_triggers_stream(spark, sf_dir):
    """T1 as Structured Streaming (stateful per device) over the events files;
    must equal the batch twin, so it shares its oracle."""
    return DB.run_debounce_stream(spark, sf_dir, 30, HOLD_MS)


_ANG = "trim(split_part(split_part(line, 'angle=', 2), ' ', 1))"


@register("command_replies", with_views("commands") + f""",
l AS (SELECT cmd_id, split_part(request, chr(10), 1) AS line FROM commands),
a AS (SELECT cmd_id, CASE WHEN contains(line, 'GET /forward') THEN 1 WHEN contains(line, 'GET /backward') THEN 2
        WHEN contains(line, 'GET /turn') THEN 3 WHEN contains(line, 'GET /status') THEN 4 ELSE 0 END AS route,
        CASE WHEN regexp_full_match({_ANG}, '[+-]?[0-9]+') THEN CAST({_ANG} AS INTEGER) END AS ang FROM l),
b AS (SELECT cmd_id, route, CASE WHEN route = 3 THEN ang END AS angle FROM a)
SELECT cmd_id,
  CASE WHEN route IN (1, 2, 4) OR (route = 3 AND angle IS NOT NULL) THEN 'success' ELSE 'error' END AS status,
  CASE route WHEN 1 THEN 'Moved Forward 1s' WHEN 2 THEN 'Moved Backward 1s'
    WHEN 3 THEN CASE WHEN angle IS NOT NULL THEN concat('Turned ', CAST(angle AS VARCHAR), ' degrees') ELSE 'Arg Error' END
    WHEN 4 THEN 'Status OK' ELSE 'Invalid' END AS result,
  0.0 AS temp, angle,
  round(CASE WHEN angle IS NOT NULL AND angle <> 0 THEN abs(angle) * CAST({C.TIME_FOR_45 / 45.0!r} AS DOUBLE)
    + CASE WHEN abs(angle) < 45 THEN 0.05 ELSE 0.0 END ELSE 0.0 END, 6) AS turn_s,
  CASE WHEN angle IS NULL OR angle = 0 THEN 'none' WHEN angle > 0 THEN 'right' ELSE 'left' END AS direction
FROM b""")
def command_replies(spark, sf_dir):
    """P30 reply per request line and P31 turn timing for turn commands."""
    r = C.turn_timing(C.replies(T.commands(spark, sf_dir)))
    return r.select("cmd_id", "status", "result", "temp", "angle", F.round("turn_s", 6).alias("turn_s"), "direction")


@register("status_series", with_views("sensor_readings") + """
SELECT device, CAST(floor(ts_ms / 3600000) * 3600000 AS BIGINT) AS window_ms,
  round(avg(round(coalesce(value, 0.0), 2)), 6) AS avg_temp, count(*) AS n
FROM sensor_readings GROUP BY device, floor(ts_ms / 3600000)""")
def status_series(spark, sf_dir):
    """Readings rounded to 2 decimals, hourly tumbling-window mean per device."""
    s = C.status_series(T.sensor_readings(spark, sf_dir), "1 hour")
    return s.select("device", F.unix_millis("window_start").alias("window_ms"),
                    F.round("avg_temp", 6).alias("avg_temp"), "n")
