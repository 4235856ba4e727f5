"""Row ids of order keys whose id passes 2^63: F6-F11, F13-F18."""

import datetime

from pyspark.sql import functions as F

from kestrel.sources import tables as T

SCHEMA = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp"


def formula(order, line, part, supplier, day):
    return (((order * 10 + line) * 100000 + part) * 10000 + supplier) * 32 + day


def test_row_ids_beyond_a_long(spark):
    keys = [(o, n, p, s, d) for o in (0, 7, 149_999, 28_823_036, 28_823_037, 53_999_999) for n, p, s, d in ((1, 0, 0, 1), (7, 19_999, 999, 31), (3, 99_999, 9_999, 16), (2, 5, 17, 30))]
    rows = [(o, n, p, s, datetime.datetime(1995, 1, d)) for o, n, p, s, d in keys] + [(1, 1, 1, None, datetime.datetime(1995, 1, 1)), (1, 1, 1, 1, None), (None, 1, 1, 1, datetime.datetime(1995, 1, 1))]
    got = [r.i for r in spark.createDataFrame(rows, SCHEMA).select(T.lineitem_row_id().alias("i")).collect()]
    want = [formula(*k) for k in keys]
    assert max(want) >= 1 << 63 and got == [(v + (1 << 63)) % (1 << 64) - (1 << 63) for v in want] + [None] * 3
    assert len(set(got)) == len(keys) + 1


def test_tables_of_large_order_keys_are_read(spark, tmp_path):
    rows = [(53_999_000 + k // 4, k % 4 + 1, k % 50, k % 30, datetime.datetime(1995, 1, 1 + k % 28), 5.0, 10.0 + k, 0.05, 0.02, "AN"[k % 2]) for k in range(40)]
    schema = SCHEMA + ", l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    for read, name in ((T.det_boxes, "det_id"), (T.gt_boxes, "gt_id"), (T.tracked_boxes, "det_id"), (T.points, "pt_id")):
        df = read(spark, str(tmp_path))
        assert df.agg(F.countDistinct(name)).first()[0] == df.count() > 0
