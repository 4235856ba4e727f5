"""Driver tables and the derived views every operator family reads.

The derived views (FIXTURES.md section 2) give boxes, landmarks, point
clouds, sensor readings, commands and frame sequences deterministic
input built from the star-schema tables.  They are plain projections,
so Catalyst prunes the scan to the referenced columns and pushes any
later filter into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_row_id() -> Column:
    """Unique row id of a lineitem row (orderkey, linenumber, part, supplier, ship day).

    It is ((((orderkey * 10 + linenumber) * 100000 + part) * 10000 + supplier) * 32)
    + day.  That passes 2^63 from order key 28,823,037 on; the last factors are a
    shift, so the id then goes on from -2^63 instead of ending the query.
    """
    order = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")
    # 320000 = 625 << 9, and supplier * 32 = (supplier >> 4) << 9 | (supplier & 15) << 5; a day has 5 bits
    high = F.shiftleft(order * 625 + F.shiftright("l_suppkey", 4), 9)
    low = F.shiftleft(F.col("l_suppkey").bitwiseAND(15), 5).bitwiseOR(F.dayofmonth("l_shipdate"))
    return high.bitwiseOR(low).cast("long")


def landmarks_long(spark: SparkSession, sf_dir: str, n_points: int = 32) -> DataFrame:
    """One row per (sample, point): sample_id, class_id, pt, x, y."""
    e = table(spark, sf_dir, "embeddings")
    return (e.select(F.col("vec_id").alias("sample_id"), F.col("label").alias("class_id"), "embedding",
                     F.explode(F.sequence(F.lit(0), F.lit(n_points - 1))).alias("pt"))
             .select("sample_id", "class_id", "pt",
                     F.element_at("embedding", F.col("pt") * 2 + 1).cast("double").alias("x"),
                     F.element_at("embedding", F.col("pt") * 2 + 2).cast("double").alias("y")))


def landmarks(spark: SparkSession, sf_dir: str, n_points: int = 32) -> DataFrame:
    """One row per sample: sample_id, class_id, xs, ys (array<double>, point order).

    Built row-locally from the embedding array, so no shuffle regroups the
    points of a sample; primitive arrays keep element reads in codegen.
    """
    e = table(spark, sf_dir, "embeddings")
    idx = F.sequence(F.lit(0), F.lit(n_points - 1))
    xs = F.transform(idx, lambda p: F.element_at("embedding", p * 2 + 1).cast("double"))
    ys = F.transform(idx, lambda p: F.element_at("embedding", p * 2 + 2).cast("double"))
    return e.select(F.col("vec_id").alias("sample_id"), F.col("label").alias("class_id"),
                    xs.alias("xs"), ys.alias("ys"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("sample_id"), F.col("label"),
        F.when(F.col("vec_id") % 4 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("pred"),
        ((F.col("vec_id") % 100) / F.lit(100.0)).cast("double").alias("confidence"))


def det_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") % 2000).alias("image_id"), F.col("l_returnflag").alias("class_id"),
        lineitem_row_id().alias("det_id"),
        (F.col("l_partkey") % 50).cast("double").alias("x1"),
        (F.col("l_suppkey") % 30).cast("double").alias("y1"),
        (F.col("l_partkey") % 50 + 20 + F.col("l_quantity")).alias("x2"),
        (F.col("l_suppkey") % 30 + 20 + F.col("l_quantity") / 2).alias("y2"),
        ((F.round(F.col("l_extendedprice") * 100).cast("long") % 1000) / F.lit(1000.0)).cast("double").alias("score"))


def gt_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber").isin(1, 3))
    x1 = F.col("l_partkey") % 50 + F.col("l_discount") * 20
    y1 = F.col("l_suppkey") % 30 + F.col("l_tax") * 20
    return li.select(
        (F.col("l_orderkey") % 2000).alias("image_id"), F.col("l_returnflag").alias("class_id"),
        lineitem_row_id().alias("gt_id"), x1.alias("x1"), y1.alias("y1"),
        (x1 + 20 + F.col("l_quantity")).alias("x2"), (y1 + 20 + F.col("l_quantity") / 2).alias("y2"),
        (F.col("l_linenumber") == 3).alias("ignore_flag"))


def tracked_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections in frames: a supplier is a video; every other frame number over 60 is missing."""
    li = table(spark, sf_dir, "lineitem")
    o = F.col("l_orderkey") % 120
    x1, y1 = (F.col("l_partkey") % 50).cast("double"), (F.col("l_suppkey") % 30).cast("double")
    return li.select(F.col("l_suppkey").alias("video_id"), F.when(o < 60, o).otherwise(2 * o - 60).alias("frame_idx"), lineitem_row_id().alias("det_id"),
                     x1.alias("x1"), y1.alias("y1"), (x1 + 20 + F.col("l_quantity")).alias("x2"), (y1 + 20 + F.col("l_quantity") / 2).alias("y2"),
                     (F.col("l_linenumber") % 4 == 0).alias("few"))


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("device"), F.col("event_id").alias("seq"),
                     event_ms(F.col("ts")).alias("ts_ms"), "value")


def event_ms(ts: Column) -> Column:
    """Epoch milliseconds, microseconds floored (the same rule in the DuckDB text)."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 1000).cast("long")


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    req = (F.when(F.col("event_type") == "click", F.lit("GET /forward HTTP/1.1"))
            .when(F.col("event_type") == "view", F.lit("GET /backward HTTP/1.1"))
            .when(F.col("event_type") == "purchase",
                  F.concat(F.lit("GET /turn?angle="), (k - 50).cast("string"), F.lit(" HTTP/1.1")))
            .when(F.col("event_type") == "signup", F.lit("GET /status HTTP/1.1"))
            .otherwise(F.lit("GET /turn?angle=abc HTTP/1.1")))
    return ev.select(F.col("event_id").alias("cmd_id"), req.alias("request"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("frame_idx"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("cloud_id"), lineitem_row_id().alias("pt_id"),
                     F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"),
                     (F.col("l_tax") * 100).alias("z"), F.col("l_extendedprice").alias("feat"))


def keypoint_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth = landmarks; prediction = x shifted by 0.01*((id*31+pt)%7-3);
    visible when (id+pt)%5 <> 0.  One row per (sample, point)."""
    lm = landmarks_long(spark, sf_dir)
    shift = F.lit(0.01) * ((F.col("sample_id") * 31 + F.col("pt")) % 7 - 3)
    return lm.select("sample_id", "class_id", "pt", F.col("x").alias("gx"), F.col("y").alias("gy"),
                     (F.col("x") + shift).alias("px"), F.col("y").alias("py"),
                     ((F.col("sample_id") + F.col("pt")) % 5 != 0).alias("visible"))
