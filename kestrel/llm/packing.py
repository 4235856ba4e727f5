"""Best-fit packing with certified bin counts.

``token_pieces`` turns documents into pieces of at most ``max_tokens`` ids.
``pack`` places pieces into sequences: each partition of pieces is packed by
best-fit decreasing, and dual-feasible functions give a lower bound on the
number of sequences that any packing of that partition needs.  A partition that
meets its bound is certified and done.  Partitions with a gap exchange their
pieces (all are dealt out anew among them) and run best-fit decreasing again;
a new deal is kept if it needs fewer sequences.

Partitions hold at most about ``part_rows`` pieces whatever the input's size;
pieces are dealt by a row number, so equal documents or a hot source spread.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage, text_slices

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary, little-endian 32-bit).

    A document is its text's ids and then ``end_id``; a null or empty text is
    ``end_id`` alone.  Only documents over ``max_tokens`` are cut.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from kestrel.llm.word_tokens import word_tokens

        tokens, last, step = word_tokens(tokenizer_path), int(end_id).to_bytes(4, "little"), 4 * max_tokens
        for (ids,), texts in text_slices(batches):
            rows: list[tuple] = []
            for doc, raw in zip(ids, tokens.ids(texts), strict=True):
                raw += last
                for k, lo in enumerate(range(0, len(raw), step)):
                    cut = raw[lo:lo + step]
                    rows.append((doc, k, lo // 4, len(cut) // 4, zlib.crc32(cut), cut))
            doc, k, start, length, crc, cut = zip(*rows, strict=True)
            columns = [pa.array(doc, pa.int64()), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(cut, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, _PIECE + (", ids binary" if with_ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing of ``lengths`` (1..capacity) needs, by dual-feasible functions.

    Threshold functions f_t (over capacity - t counts as a whole bin, under t as
    nothing) for every t, and the rounding functions u_k for k up to 32, whose
    sums over capacity are lower bounds; the best one counts.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    items, total = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(0, capacity // 2 + 1)
    whole = items[capacity] - items[capacity - t]
    middle = total[capacity - t] - np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    best = int((whole + -(-np.maximum(middle, 0) // capacity)).max())
    for k in range(1, 33):
        exact = (k + 1) * size % capacity == 0
        scaled = np.where(exact, k * size, ((k + 1) * size // capacity) * capacity)  # u_k times k
        best = max(best, -(-int((scaled * count).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece and the number of bins: each piece, longest first, goes to the fullest bin it fits."""
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room left
    rooms, bins = 0, 0  # rooms: bit r is set if a bin with room r exists
    for at, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, b, bins = capacity, bins, bins + 1
        place[at], offset[at] = b, capacity - room
        free[room - n].append(b)
        rooms |= 1 << (room - n)
    return place, offset, bins


def _pack_part(capacity: int):
    def run(pdf):
        lengths = pdf["length"].to_numpy()
        place, offset, bins = best_fit_decreasing(lengths, capacity)
        return pdf.assign(bin=place, offset=offset, bins=bins, bound=lower_bound(lengths, capacity))
    return run


def pack(pieces: DataFrame, max_tokens: int = 4096, part_rows: int = 100_000, rounds: int = 3) -> DataFrame:
    """``pieces`` (any columns with ``length`` in 1..max_tokens) plus sequence_id, offset, bins, bound, in place of columns of these names.

    ``bins`` and ``bound`` are those of the row's partition: where they are
    equal the partition is certified to need that many sequences.  Pieces of
    full length are sequences of their own.  Rows come back as often as they
    came; an empty table gives none.
    """
    pieces = pieces.drop("sequence_id", "offset", "bins", "bound")
    names = pieces.columns
    # names of its own within: those of the caller may be any
    rows = pieces.toDF(*["length" if c == "length" else f"c{i}" for i, c in enumerate(names)])
    rows = cut_lineage(rows.withColumn("length", F.col("length").cast("long")))
    # ids of rows in a checkpoint don't change if a task runs again
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") == max_tokens).select(
        *rows.columns, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("bins"), F.lit(1).cast("long").alias("bound"))
    rest = numbered.where(F.col("length") < max_tokens)
    n = rest.count()
    named = lambda df: df.toDF(*names, "sequence_id", "offset", "bins", "bound")
    if not n:
        return named(full)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    out = f"{fields}, _part long, bin long, offset long, bins long, bound long"
    own = rest.columns

    def packed(df: DataFrame, parts: int, deal: int) -> DataFrame:
        dealt = df.select(*own, (F.pmod(F.xxhash64("_row", F.lit(deal)), F.lit(parts)) + deal * (1 << 24)).alias("_part"))
        return cut_lineage(dealt.groupBy("_part").applyInPandas(_pack_part(max_tokens), out))

    done, now = [], packed(rest, -(-n // part_rows), 0)
    for deal in range(1, rounds + 1):
        gaps = now.where("bins > bound")
        stats = gaps.groupBy("_part").agg(F.max("bins").alias("b"), F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.sum("b"), F.sum("n")).first()
        if stats[0] < 2:  # nobody to exchange with
            break
        again = packed(gaps, -(-stats[2] // part_rows), deal)
        bins = again.groupBy("_part").agg(F.max("bins").alias("b")).agg(F.sum("b")).first()[0]
        if bins >= stats[1]:
            break
        done.append(now.where("bins <= bound"))
        now = again
    for d in done:
        now = now.unionByName(d)
    placed = now.select(*rows.columns, (F.col("_part") * (1 << 24) + F.col("bin")).alias("sequence_id"), "offset", "bins", "bound")
    return named(placed.unionByName(full))
