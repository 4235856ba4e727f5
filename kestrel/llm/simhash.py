"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into ``blocks`` blocks of about equal size.  If two
fingerprints differ in at most ``max_bits`` bits, some block differs in at most
``t = max_bits // blocks``.  Each block has a covering code as its anchors: a
perfect Hamming code (covering radius 1) on the first 2^m - 1 bits, every value
of the bits left over.  A fingerprint has its home at the nearest anchor of each
block and is replicated to every anchor within covering radius + t, so the two
fingerprints of such a pair meet at the home anchor of either.  Per anchor, home
rows are compared with replicated rows on all 64 bits.

For the default (blocks of 21, 21 and 22 bits, t = 1) a fingerprint makes about
14 copies a block, and an anchor sees 1/10,000 of the fingerprints as copies and
1/100,000 of them at home.  Only distinct
fingerprints take part, however many texts share one.  An anchor with much work
is cut into salted parts (its home rows split, its replicated rows repeated), and
a part returns a spanning forest of its links rather than all pairs, which keeps
every component and none of the quadratic output.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage, document_key, free_name, row_key, text_slices
from kestrel.llm.components import components

#: Pairs compared at once in a part, and pairs that a salted part should not exceed.
TILE = (256, 8192)
PART_PAIRS = 50_000_000
#: Fingerprints for each bucket of parts that a task takes at once (about 40 rows each).
BUCKET_FPS = 2_000


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text; 0 for a text without words."""
    import xxhash

    words = text.lower().split()  # bytes: lower() maps A-Z alone, split() cuts at x20 and x09-x0D
    if not words:
        return 0
    norm, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(norm, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts, stops = (ends - size)[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    hashes = np.array([digest(norm[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype="<u8")
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        votes += np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, key: str | None = None) -> DataFrame:
    """(doc_id, uid, fp) per row: uid is ``document_key``, or the binary column ``key``, fp the fingerprint's 64 bits as a signed long.  Null text: no words, so 0."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (ids, uids), texts in text_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(uids, pa.binary() if key else pa.int64()), pa.array(fps)], names=["doc_id", "uid", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.col(f"`{key}`") if key else document_key(id_col, text_col)).alias("uid"),
                       F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, uid {'binary' if key else 'long'}, fp long")


class Anchors:
    """Covering code of one block: the home anchor of a value, and all anchors within radius + ``spread``."""

    def __init__(self, width: int, spread: int):
        self.length = (1 << ((width + 1).bit_length() - 1)) - 1
        bits = np.arange(1 << width, dtype=np.uint32)
        syndrome = np.zeros(1 << width, np.uint32)
        for p in range(self.length):
            syndrome ^= ((bits >> p) & 1) * np.uint32(p + 1)
        self.syndrome = syndrome
        self.home_mask = np.array([0] + [1 << (s - 1) for s in range(1, self.length + 1)], np.uint32)
        free = range(self.length, width)
        masks: dict[int, set[int]] = {s: set() for s in range(self.length + 1)}
        for flips in range(spread + 1):  # of bits outside the Hamming part, whose radius is 0
            for outside in combinations(free, flips):
                for n in range(0, 2 + spread - flips):
                    for inside in combinations(range(self.length), n):
                        s = 0
                        for p in inside:
                            s ^= p + 1
                        masks[s].add(sum(1 << p for p in (*inside, *outside)))
        self.masks = {s: np.array(sorted(m), np.uint32) for s, m in masks.items()}

    def home(self, values: np.ndarray) -> np.ndarray:
        return values ^ self.home_mask[self.syndrome[values]]

    def near(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) for every anchor within reach of values[row]."""
        s, rows, out = self.syndrome[values], [], []
        for k, m in self.masks.items():
            at = np.flatnonzero(s == k)
            rows.append(np.repeat(at, len(m)))
            out.append((values[at][:, None] ^ m[None, :]).ravel())
        return np.concatenate(rows), np.concatenate(out)


@lru_cache
def anchors(width: int, spread: int) -> Anchors:
    """The code of a worker process."""
    return Anchors(width, spread)


def block_widths(blocks: int) -> list[int]:
    """Bits of each block, from the lowest."""
    return [64 * (b + 1) // blocks - 64 * b // blocks for b in range(blocks)]


def _at_anchors(blocks: int, spread: int):
    widths = block_widths(blocks)

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        codes = {w: anchors(w, spread) for w in set(widths)}
        for pdf in frames:
            for lo in range(0, len(pdf), 20_000):
                fp = pdf["fp"].to_numpy()[lo:lo + 20_000]
                parts = []
                for b, width in enumerate(widths):
                    code, low = codes[width], sum(widths[:b])
                    value = ((fp.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.uint32)
                    row, anchor = code.near(value)
                    parts += [(b << 32 | code.home(value).astype(np.int64), fp, True), (b << 32 | anchor.astype(np.int64), fp[row], False)]
                yield pd.DataFrame({"anchor": np.concatenate([p[0] for p in parts]), "fp": np.concatenate([p[1] for p in parts]),
                                    "home": np.concatenate([np.full(len(p[1]), p[2]) for p in parts])})
    return run


def _forest(here: np.ndarray, there: np.ndarray, max_bits: int) -> np.ndarray:
    """Spanning links (k, 2) of the home and replicated fingerprints of one part of an anchor."""
    nodes = np.unique(np.concatenate([here, there]))
    at_here, at_there = np.searchsorted(nodes, here), np.searchsorted(nodes, there)
    label = np.arange(len(nodes))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    links = []
    for i in range(0, len(here), TILE[0]):
        for j in range(0, len(there), TILE[1]):
            a, b = np.nonzero(np.bitwise_count(here[i:i + TILE[0], None] ^ there[None, j:j + TILE[1]]) <= max_bits)
            a, b = at_here[i + a], at_there[j + b]
            while True:  # links whose ends aren't joined yet: one of each tree at a time
                while not np.array_equal(flat := label[label], label):
                    label = flat
                open_ = label[a] != label[b]
                if not open_.any():
                    break
                a, b = a[open_], b[open_]
                _, first = np.unique(np.maximum(label[a], label[b]), return_index=True)
                for x, y in zip(a[first].tolist(), b[first].tolist(), strict=True):
                    rx, ry = root(x), root(y)
                    if rx != ry:
                        label[max(rx, ry)] = min(rx, ry)
                        links.append((x, y))
    return nodes[np.array(links, np.int64).reshape(-1, 2)]


def _forests(max_bits: int):
    def run(pdf):
        """Links of a bucket of whole (anchor, part)s."""
        import pandas as pd

        key = pdf["anchor"].to_numpy() << 20 | pdf["part"].to_numpy()  # an anchor takes 34 bits
        order = np.argsort(key, kind="stable")
        fp, home = pdf["fp"].to_numpy().view(np.uint64)[order], pdf["home"].to_numpy()[order]
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        found = [np.empty((0, 2), np.uint64)]
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
            f, h = fp[lo:hi], home[lo:hi]
            if h.any() and hi - lo > 2:  # else there is just a fingerprint and its own copy
                found.append(_forest(f[h], f[~h], max_bits))
        pairs = np.concatenate(found).view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})
    return run


def links(distinct_fps: DataFrame, max_bits: int = 4, blocks: int = 3, part_pairs: int = PART_PAIRS) -> DataFrame:
    """(u, v): links of distinct fingerprints ``fp`` that differ in at most ``max_bits`` bits.

    Every pair within ``max_bits`` is joined by a path of returned links, and
    every returned link is such a pair; ``part_pairs`` bounds the comparisons
    of one salted part and never changes the result's components.
    """
    spread = max_bits // blocks
    if max(block_widths(blocks)) > 22:
        raise ValueError("blocks must be of at most 22 bits")
    rows = distinct_fps.select("fp").mapInPandas(_at_anchors(blocks, spread), "anchor long, fp long, home boolean")
    work = rows.groupBy("anchor").agg(F.sum(F.col("home").cast("long")).alias("h"), F.count(F.lit(1)).alias("n"))
    # only anchors of more than part_pairs comparisons, of at most blocks * 2^18 whatever the input's size
    parts = work.select("anchor", F.greatest(F.lit(1), F.least(F.col("h"), F.ceil(F.col("h") * (F.col("n") - F.col("h")) / part_pairs))).cast("int").alias("parts")).where("parts > 1")
    rows = rows.join(F.broadcast(parts), "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = rows.where("home").select("anchor", "fp", "home", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"))
    copies = rows.where("NOT home").select("anchor", "fp", "home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    buckets = max(1, distinct_fps.count() // BUCKET_FPS)
    bucket = F.pmod(F.xxhash64("anchor", "part"), F.lit(buckets))
    return own.unionByName(copies).withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_forests(max_bits), "u long, v long")


def _rooted(rows: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(fp, least, root) for each distinct fingerprint of ``rows``: its smallest doc_id and its component."""
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, max_bits, blocks))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
                    blocks: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Texts of fewer than ``shingle`` words hash their whole word sequence; texts
    that are null or have no word get fingerprint zero and link like any other.
    ``component_id`` is the smallest doc_id that links reach, the row's own
    included; rows of a null doc_id take part, and a component of such rows
    alone has a null id.  Repeated rows come back as often as they came.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    rooted = cut_lineage(_rooted(rows, max_bits, blocks))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, blocks: int = 3) -> DataFrame:
    """The row of the smallest doc_id (null last, then a hash of all columns) of each component of ``docs``, with all its columns; one of equal rows."""
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, row_key(docs))
    rows = cut_lineage(fingerprints(keyed, id_col, text_col, shingle, key))
    rooted = cut_lineage(_rooted(rows, max_bits, blocks).select("fp", "root"))
    first = (rows.join(rooted, "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "uid")).alias("k"))
             .select(F.col("k.uid").alias(key)))
    return keyed.join(first, key, "left_semi").dropDuplicates([key]).drop(key)
