"""Command log: parse request lines, build replies, turn timing, status series
(P30, P31, T2).  All built-in string and arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values from the reference firmware: reply texts, device name and
# turn calibration (0.75 s per 45 degrees, +0.05 s below 45, 0.5 s settle).
MSG_FORWARD = "Moved Forward 1s"
MSG_BACKWARD = "Moved Backward 1s"
MSG_STATUS = "Status OK"
MSG_INVALID = "Invalid"
MSG_ARG_ERROR = "Arg Error"
DEVICE = "esp32-pet"
TIME_FOR_45 = 0.75
STARTUP_COMPENSATION = 0.05
SETTLE_S = 0.5


def first_line(request: Column) -> Column:
    return F.split(request, "\n").getItem(0)


def parse_angle(line: Column) -> Column:
    """Text after 'angle=' up to the first space, as int; NULL when absent or not an integer."""
    raw = F.split(F.split(line, "angle=").getItem(1), " ").getItem(0)
    ok = F.trim(raw).rlike("^[+-]?[0-9]+$")
    return F.when(ok, F.trim(raw).cast("int"))


def replies(df: DataFrame, request: str = "request", temp: Column | None = None) -> DataFrame:
    """Route by substring in this order: forward, backward, turn, status;
    else Invalid/error.  A turn whose angle is not an integer gives Arg Error.
    ``temp`` (sensor temperature, rounded to 2) is reported only for status,
    else 0; without a sensor it is 0.0."""
    line = first_line(F.col(request))
    angle = parse_angle(line)
    is_f = line.contains("GET /forward")
    is_b = ~is_f & line.contains("GET /backward")
    is_t = ~is_f & ~is_b & line.contains("GET /turn")
    is_s = ~is_f & ~is_b & ~is_t & line.contains("GET /status")
    msg = (F.when(is_f, F.lit(MSG_FORWARD)).when(is_b, F.lit(MSG_BACKWARD))
            .when(is_t & angle.isNotNull(), F.concat(F.lit("Turned "), angle.cast("string"), F.lit(" degrees")))
            .when(is_t, F.lit(MSG_ARG_ERROR)).when(is_s, F.lit(MSG_STATUS)).otherwise(F.lit(MSG_INVALID)))
    ok = is_f | is_b | (is_t & angle.isNotNull()) | is_s
    status = F.when(ok, F.lit("success")).otherwise(F.lit("error"))
    t = F.round(F.coalesce(temp, F.lit(0.0)), 2) if temp is not None else F.lit(0.0)
    tval = F.when(is_s, t).otherwise(F.lit(0.0))
    out = df.withColumn("status", status).withColumn("result", msg).withColumn("temp", tval) \
            .withColumn("angle", F.when(is_t, angle))
    return out.withColumn("reply", F.to_json(F.struct("status", "result", "temp", F.lit(DEVICE).alias("device"))))


def turn_timing(df: DataFrame, angle: str = "angle") -> DataFrame:
    """Open-loop turn duration |a| * 0.75/45 s (+0.05 below 45 degrees),
    direction by sign, plus the 0.5 s settle; angle 0 (or none) does nothing."""
    a = F.col(angle)
    dur = F.abs(a) * (TIME_FOR_45 / 45.0) + F.when(F.abs(a) < 45, F.lit(STARTUP_COMPENSATION)).otherwise(F.lit(0.0))
    moving = a.isNotNull() & (a != 0)
    return (df.withColumn("turn_s", F.when(moving, dur).otherwise(F.lit(0.0)))
              .withColumn("direction", F.when(~moving, F.lit("none")).when(a > 0, F.lit("right")).otherwise(F.lit("left")))
              .withColumn("busy_s", F.when(moving, dur + SETTLE_S).otherwise(F.lit(0.0))))


def status_series(readings: DataFrame, window: str = "1 hour", device: str = "device",
                  ts_ms: str = "ts_ms", value: str = "value") -> DataFrame:
    """Temperature readings rounded to 2 (0.0 when missing), averaged per
    device in tumbling event-time windows (the window is our addition)."""
    t = F.round(F.coalesce(F.col(value), F.lit(0.0)), 2)
    w = F.window(F.timestamp_millis(ts_ms), window)
    return readings.groupBy(device, w.alias("w")).agg(F.avg(t).alias("avg_temp"), F.count(F.lit(1)).alias("n")) \
                   .select(device, F.col("w.start").alias("window_start"), "avg_temp", "n")
