"""Text quality by how much better a dictionary of good text compresses a text than one of bad text.

Two zstandard dictionaries are built from labelled texts, one for each label.
A whole text is cut into blocks small enough that a dictionary matters in every
block, each block is compressed with both, and the summed sizes B (bad) and G
(good) give the normalised difference d = (B - G) / (B + G) in (-1, 1).  A
logistic curve fitted on other labelled texts turns d into the probability of
label 1.

The fit reads a bounded sample (the parameters of ``fit``): the labelled ids
with the smallest hashes.  Scoring reads every text whole and runs where the
rows are, with the two dictionaries (``dict_bytes`` each) sent along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import text_slices

BLOCK = 512
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries as bytes, and the curve: score = 1 / (1 + exp(-(bias + slope * d)))."""

    good: bytes
    bad: bytes
    bias: float
    slope: float

    def compressors(self):
        import zstandard as zstd

        def one(raw: bytes):
            how = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if not raw:
                return zstd.ZstdCompressor(**how)
            dictionary = zstd.ZstdCompressionDict(raw)
            dictionary.precompute_compress(level=LEVEL)
            return zstd.ZstdCompressor(dict_data=dictionary, **how)

        return one(self.good).compress, one(self.bad).compress

    def score(self, d: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * d, -50, 50)))


def held_out(doc_id) -> F.Column:
    """Whether an id is kept from every fit: crc32 of its digits mod 4 is 2 (null ids carry no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def size_difference(text: bytes, good, bad) -> float:
    """(B - G) / (B + G) over all blocks of a text; 0 for an empty one."""
    blocks = [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]
    g, b = sum(map(len, map(good, blocks))), sum(map(len, map(bad, blocks)))
    return (b - g) / (b + g) if blocks else 0.0


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """Trained dictionary; of few texts, which the trainer refuses, their own bytes."""
    import zstandard as zstd

    blocks = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstd.train_dictionary(size, blocks).as_bytes()
    except zstd.ZstdError:
        return b"".join(blocks)[-size:]


def _logistic(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method with a small ridge on the slope; one class or no rows give the smoothed base rate."""
    base = (y.sum() + 1) / (len(y) + 2)
    w = np.array([np.log(base / (1 - base)), 0.0])
    if 0 < y.sum() < len(y):
        x = np.stack([np.ones_like(d), d], 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            ridge = np.array([0, 1e-3])
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, dict_rows: int = 1500, curve_rows: int = 8000, text_bytes: int = 4096,
        dict_bytes: int = 112_640, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on rows that ``held_out`` doesn't mark.

    The dictionaries see at most ``dict_rows`` texts a label and of each at most
    ``text_bytes`` bytes from the middle; the curve sees at most ``curve_rows`` other
    texts, whole.  Labels that are null, not 0 or 1, or contradict each other for
    an id are left out.  Without labels every score is 0.5.
    """
    key = F.col(f"`{id_col}`").cast("long")
    marks = (labels.select(key.alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most"))
    for_curve = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3
    pick = lambda rows, n: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = [pick(marks.where(~for_curve & (F.col("label") == k)), dict_rows).withColumn("curve", F.lit(False)) for k in (0, 1)]
    chosen.append(pick(marks.where(for_curve), curve_rows).withColumn("curve", F.lit(True)))
    sample = reduce(DataFrame.unionByName, chosen)  # at most 2 * dict_rows + curve_rows small rows
    rows = docs.select(key.alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id").where(F.length("text") > 0)

    middle = F.expr(f"substring(text, greatest(1, cast((length(text) - {text_bytes}) / 2 as int)), {text_bytes})")
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    seen = rows.where("NOT curve").select("label", "doc_id", middle.alias("part")).orderBy(F.xxhash64("doc_id"), "doc_id", "part").limit(2 * dict_rows)
    for label, _, part in seen.collect():
        texts[label].append(bytes(part))
    model = Model(_dictionary(texts[1], dict_bytes), _dictionary(texts[0], dict_bytes), 0.0, 0.0)
    points = differences(rows.where("curve").select("doc_id", "label", "text"), model, ["doc_id", "label"], "doc_id long, label int")
    got = np.array([(r.d, r.label) for r in points.orderBy(F.xxhash64("doc_id"), "doc_id", "d").limit(curve_rows).collect()]).reshape(-1, 2)
    return Model(model.good, model.bad, *_logistic(got[:, 0], got[:, 1]))


def differences(rows: DataFrame, model: Model, keep: list[str], schema: str) -> DataFrame:
    """``keep`` columns plus d, and its score under the model's curve, of the binary column ``text``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        good, bad = model.compressors()
        for columns, texts in text_slices(batches):
            d = np.array([size_difference(t, good, bad) for t in texts])
            yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)), pa.array(d), pa.array(model.score(d))],
                                             names=[*keep, "d", "score"])

    from pyspark.sql.pandas.types import to_arrow_schema

    chosen = rows.select(*keep, "text")
    fields = list(to_arrow_schema(chosen.select(*keep).schema))
    return chosen.mapInArrow(run, f"{schema}, d double, score double")


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, difference), one row per input row.

    A null text counts as empty; an empty text has difference 0 and the score
    of that.  Nothing but the text is an input of the score.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    out = differences(rows, model, ["doc_id"], "doc_id long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), F.col("d").alias("difference"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, whose text scores at least ``threshold``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        good, bad = model.compressors()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):  # few texts at a time as Python objects
                part = batch.slice(lo, 500)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                d = np.array([size_difference((t or "").encode(), good, bad) for t in texts])
                yield part.filter(pa.array(model.score(d) >= threshold))

    return docs.mapInArrow(run, docs.schema)
