"""Compare a registered query with its oracle SQL (rounded, order-insensitive)."""

import math


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def rows_equal(sdf, duck, sql):
    scols = sdf.columns
    srows = sdf.collect()
    rel = duck.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols), (scols, dcols)
    order = sorted(scols)
    a = sorted((tuple(_norm(r[scols.index(c)]) for c in order) for r in srows), key=repr)
    b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows), key=repr)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b
    return len(a)
