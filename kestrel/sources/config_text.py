"""Feature-config text sink and scan.

Layout: a section header line ``[angle_triplets]`` or ``[ratio_quadruplets]``,
then one line per feature ``rank<TAB>p1,p2,p3[,p4]<TAB>f_score``.  The
reader carries the last header down to its rows, skips malformed rows
(unparsable numbers) and returns ``kind, rank, idx array<int>, f_score``.
A config holds at most a few hundred selected features, so it is written
as one ordered file and read with one ordered pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_feature_config(sections: dict[str, DataFrame], path: str) -> None:
    """``sections``: kind -> DataFrame(rank, idx array<int>, f_score)."""
    parts = []
    for s_no, (kind, df) in enumerate(sections.items()):
        head = df.sparkSession.range(1).select(F.lit(s_no).alias("_s"), F.lit(0).cast("long").alias("_r"),
                                               F.lit(f"[{kind}]").alias("value"))
        rows = df.select(F.lit(s_no).alias("_s"), F.col("rank").cast("long").alias("_r"),
                         F.concat_ws("\t", F.col("rank").cast("string"),
                                     F.array_join(F.col("idx").cast("array<string>"), ","),
                                     F.col("f_score").cast("string")).alias("value"))
        parts += [head, rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out.coalesce(1).sortWithinPartitions("_s", "_r").select("value").write.mode("overwrite").text(path)


def read_feature_config(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id())
    header = F.regexp_extract("value", r"^\[(\w+)\]$", 1)
    lines = lines.withColumn("_kind", F.when(header != "", header))
    w = Window.orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("kind", F.last("_kind", ignorenulls=True).over(w)).where(F.col("_kind").isNull())
    rank = F.expr("try_cast(split(value, '\\t')[0] AS INT)")
    idx = F.expr("transform(split(split(value, '\\t')[1], ','), s -> try_cast(s AS INT))")
    score = F.expr("try_cast(split(value, '\\t')[2] AS DOUBLE)")
    out = lines.select("kind", rank.alias("rank"), idx.alias("idx"), score.alias("f_score"))
    ok = (F.col("rank").isNotNull() & F.col("f_score").isNotNull() & F.col("kind").isNotNull()
          & (F.size("idx") >= 3) & F.forall("idx", lambda x: x.isNotNull()))
    return out.where(ok)
