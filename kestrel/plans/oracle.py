"""DuckDB text of the derived views, used to write oracle SQL for queries.

``with_views("landmarks", "det_boxes")`` returns a ``WITH`` prefix that
defines the named views over the driver's pre-registered tables.
"""

from __future__ import annotations

ROW_ID = ("((((l_orderkey*10 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey)*32 "
          "+ day(l_shipdate))")

VIEWS = {
    "landmarks": """SELECT vec_id AS sample_id, label AS class_id, p AS pt,
        CAST(embedding[2*p+1] AS DOUBLE) AS x, CAST(embedding[2*p+2] AS DOUBLE) AS y
        FROM embeddings, (SELECT unnest(range(0,32)) AS p)""",
    "predictions": """SELECT vec_id AS sample_id, label,
        CASE WHEN vec_id%4=0 THEN (label+1)%10 ELSE label END AS pred,
        CAST((vec_id%100)/100.0 AS DOUBLE) AS confidence FROM embeddings""",
    "det_boxes": f"""SELECT l_orderkey%2000 AS image_id, l_returnflag AS class_id, {ROW_ID} AS det_id,
        CAST(l_partkey%50 AS DOUBLE) AS x1, CAST(l_suppkey%30 AS DOUBLE) AS y1,
        l_partkey%50+20+l_quantity AS x2, l_suppkey%30+20+l_quantity/2 AS y2,
        CAST((CAST(round(l_extendedprice*100) AS BIGINT)%1000)/1000.0 AS DOUBLE) AS score FROM lineitem""",
    "gt_boxes": f"""SELECT l_orderkey%2000 AS image_id, l_returnflag AS class_id, {ROW_ID} AS gt_id,
        l_partkey%50+l_discount*20 AS x1, l_suppkey%30+l_tax*20 AS y1,
        l_partkey%50+l_discount*20+20+l_quantity AS x2, l_suppkey%30+l_tax*20+20+l_quantity/2 AS y2,
        l_linenumber=3 AS ignore_flag FROM lineitem WHERE l_linenumber IN (1,3)""",
    "tracked_boxes": f"""SELECT l_suppkey AS video_id, CASE WHEN l_orderkey%120 < 60 THEN l_orderkey%120 ELSE 2*(l_orderkey%120) - 60 END AS frame_idx,
        {ROW_ID} AS det_id, CAST(l_partkey%50 AS DOUBLE) AS x1, CAST(l_suppkey%30 AS DOUBLE) AS y1,
        l_partkey%50+20+l_quantity AS x2, l_suppkey%30+20+l_quantity/2 AS y2, l_linenumber%4 = 0 AS few FROM lineitem""",
    "sensor_readings": """SELECT user_id AS device, event_id AS seq, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ts_ms,
        value FROM events""",
    "commands": """SELECT event_id AS cmd_id, CASE event_type
        WHEN 'click' THEN 'GET /forward HTTP/1.1' WHEN 'view' THEN 'GET /backward HTTP/1.1'
        WHEN 'purchase' THEN concat('GET /turn?angle=',
             CAST(CAST(regexp_extract(props,'"k": *([0-9]+)',1) AS INT)-50 AS VARCHAR), ' HTTP/1.1')
        WHEN 'signup' THEN 'GET /status HTTP/1.1' ELSE 'GET /turn?angle=abc HTTP/1.1' END AS request
        FROM events""",
    "frames": """SELECT conv_id AS video_id, turn AS frame_idx FROM conversations""",
    "points": f"""SELECT l_suppkey AS cloud_id, {ROW_ID} AS pt_id, l_quantity AS x, l_discount*100 AS y,
        l_tax*100 AS z, l_extendedprice AS feat FROM lineitem""",
}


VIEWS["kp"] = """SELECT sample_id, class_id, pt, x AS gx, y AS gy,
        x + CAST(0.01 AS DOUBLE) * ((sample_id*31+pt)%7-3) AS px, y AS py, (sample_id+pt)%5 <> 0 AS visible
        FROM landmarks"""


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n"
