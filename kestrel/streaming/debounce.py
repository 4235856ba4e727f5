"""Debounced trigger over sensor readings (T1), batch and streaming.

Semantics per device, readings in (ts_ms, seq) order: a reading below the
threshold starts a dark run (if none is open); the run fires once, at the
first dark reading whose time since the run start is strictly greater than
``hold_ms``; any reading at or above the threshold closes the run.

Batch: gaps-and-islands.  The island of a row is the number of bright
readings before it (a skew-safe running sum), so each dark run is one
(device, island) group; run start and trigger are ``min`` / ``min_by``
aggregations with map-side partial aggregation.

Streaming: ``ordered_fold`` keyed by device, state = (run_start, fired).
Readings wait until the watermark has passed them, so files in any order
give what the batch twin gives; readings behind the watermark are dropped
and counted by Spark.  A device in the light keeps no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.plans.ordered import running
from kestrel.streaming.ordered import ordered_fold, run_files

# Fixed values from the reference firmware: analog threshold and hold time.
LIGHT_THRESHOLD = 30
TRIGGER_TIME_MS = 500

TRIGGER_SCHEMA = "device long, trigger_seq long, trigger_ts long, run_start long, held_ms long"


def debounce_batch(readings: DataFrame, threshold: float = LIGHT_THRESHOLD, hold_ms: int = TRIGGER_TIME_MS,
                   device: str = "device", ts: str = "ts_ms", seq: str = "seq", value: str = "value") -> DataFrame:
    """Triggers: device, trigger_seq, trigger_ts, run_start, held_ms."""
    r = running(readings, [device], [F.col(ts), F.col(seq)], rank_col=None,
                sums={"_island": (F.col(value) >= threshold).cast("long")})
    dark = r.where(F.col(value) < threshold)
    start = dark.groupBy(device, "_island").agg(F.min(ts).alias("run_start"))
    d = dark.join(start, [device, "_island"]).where(F.col(ts) - F.col("run_start") > hold_ms)
    trig = d.groupBy(device, "_island").agg(
        F.min_by(F.struct(F.col(seq).alias("s"), F.col(ts).alias("t")), F.struct(F.col(ts), F.col(seq))).alias("f"),
        F.first("run_start").alias("run_start"))
    return trig.select(F.col(device).alias("device"), F.col("f.s").alias("trigger_seq"),
                       F.col("f.t").alias("trigger_ts"), "run_start",
                       (F.col("f.t") - F.col("run_start")).alias("held_ms"))


def _fold(threshold: float, hold_ms: int):
    def fold(key, rows, state):
        start, fired = state or (None, False)
        out = []
        for device, seq, ts, value in rows:
            if value is None or value >= threshold:
                if value is not None:
                    start, fired = None, False
            elif start is None:
                start = ts
            elif ts - start > hold_ms and not fired:
                out.append((device, seq, ts, start, ts - start))
                fired = True
        return out, None if start is None else (start, fired)  # a device in the light has no state
    return fold


def debounce_stream(stream: DataFrame, threshold: float = LIGHT_THRESHOLD, hold_ms: int = TRIGGER_TIME_MS,
                    watermark: str = "1 day") -> DataFrame:
    """Streaming T1 on a stream of ``device, seq, ts_ms, value`` rows, which may come in any order within ``watermark``."""
    return ordered_fold(stream.select("device", "seq", "ts_ms", "value"), ["device"], "ts_ms", ["seq"], _fold(threshold, hold_ms), TRIGGER_SCHEMA, watermark)


def run_debounce_stream(spark: SparkSession, events_dir: str, threshold: float = LIGHT_THRESHOLD,
                        hold_ms: int = TRIGGER_TIME_MS, files_at_once: int = 1, delay_days: int = 3650) -> DataFrame:
    """T1 over the ``events*.parquet`` files of ``events_dir`` as a stream; files may come in any order within ``delay_days``."""
    from kestrel.sources.tables import event_ms

    def readings(ev: DataFrame) -> DataFrame:
        return ev.select(F.col("user_id").alias("device"), F.col("event_id").alias("seq"), event_ms(F.col("ts")).alias("ts_ms"), "value")

    schema = spark.read.option("pathGlobFilter", "events*.parquet").parquet(events_dir).schema
    return run_files(spark, events_dir, schema, lambda s: debounce_stream(s, threshold, hold_ms, f"{delay_days} days"), "ts_ms", TRIGGER_SCHEMA,
                     "events*.parquet", files_at_once, delay_days * 86_400_000, readings)
