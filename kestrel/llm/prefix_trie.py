"""Prefix trie of conversations, its subtree totals by time-forward processing.

A turn is two 64-bit hashes of (role, text) from the scan on; texts are never
shuffled.  The prefix of a conversation's first d turns is named by d and two
running sums of hashes of (position, turn), so numbering the turns and naming the
prefixes are running sums over range chunks (``plans.ordered``) and no
conversation is gathered, however long it is.  Equal prefixes of different
conversations are one node of the trie, a grouped minimum and count.

Totals of subtrees go from children to parents.  Nodes of more members than the
square root of the number of conversations are *heavy*: there are at most
sqrt(conversations) of them at any depth.  Below them hang the *shards*, whole
subtrees of at most that many members each.

1. Within shards: the nodes of a partition's shards are sorted by falling depth
   (Spark's external sort) and streamed.  A node takes the messages addressed to
   it from a priority queue ordered like the stream, adds its own values, and
   sends the totals to its parent through the queue.  The queue spills sorted
   runs beyond ``limit`` messages.
2. Across shard roots: the totals of shard roots are added up by parent (a
   grouped sum), and the heavy nodes are processed in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage
from kestrel.plans.ordered import running

#: Messages that a queue holds in memory (about 150 bytes each).
LIMIT = 200_000
#: SHA-256 of the empty string.
NONE = hashlib.sha256(b"").hexdigest()
_FORWARD = "key binary, children long, leaves long, saved long, to_key binary"


class SpillingQueue:
    """Priority queue of tuples that keeps at most ``limit`` of them in memory; the rest lie in sorted runs.

    Runs are unnamed files of the running task: they are gone when it ends, and a
    task that is run again writes its own.
    """

    def __init__(self, limit: int = LIMIT):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, item)

    def _spill(self) -> None:
        keep = self.limit // 2  # the nearest ones are wanted soonest
        items = sorted(self.heap)
        self.heap, rest = items[:keep], items[keep:]
        run = tempfile.TemporaryFile()
        for i in range(0, len(rest), 1000):
            pickle.dump(rest[i:i + 1000], run)
        run.seek(0)
        self.spilled += len(rest)
        rows = self._read(run)
        heapq.heappush(self.runs, (next(rows), self.spilled, rows))

    @staticmethod
    def _read(run) -> Iterator[tuple]:
        with run:
            while True:
                try:
                    yield from pickle.load(run)
                except EOFError:
                    return

    def take(self, rank: tuple) -> Iterator[tuple]:
        """Remove and return the items whose first part is ``rank``; no item before it may be left."""
        while self.heap and self.heap[0][0] == rank:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][0] == rank:
            item, at, rows = self.runs[0]
            following = next(rows, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, at, rows))
            yield item


def time_forward(nodes: Iterator[tuple], limit: int = LIMIT) -> Iterator[tuple]:
    """(key, children, leaves, saved, to) for nodes that come by falling depth, then key.

    A node is (key, depth, parent, top, saved, children, leaves): ``saved`` is its
    own value, ``children`` and ``leaves`` what it has from children elsewhere.
    The totals of a node with ``top`` go out to ``to``, its parent; those of any
    other go to its parent through the queue, and ``to`` is None.
    """
    queue = SpillingQueue(limit)
    for key, depth, parent, top, saved, children, leaves in nodes:
        for _, more_leaves, more_saved in queue.take((-depth, key)):
            children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
        leaves = leaves if children else 1
        if not top:
            queue.push(((1 - depth, parent), leaves, saved))
        yield key, children, leaves, saved, parent if top else None


def _forward(limit: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        names, out = ["key", "children", "leaves", "saved", "to_key"], []

        def table(held: list):
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

        for row in time_forward(rows(), limit):
            out.append(row)
            if len(out) == 10_000:
                yield table(out)
                out = []
        if out:
            yield table(out)
    return run


def _key(depth: Column, *sums: Column) -> Column:
    """16 bytes that name a prefix by its depth and the sums of its turns' hashes."""
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), *[s.cast("decimal(38,0)").cast("string") for s in sums])))


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n, a, b, bytes) per turn: its number from 1, two hashes of (role, text) and the text's UTF-8 bytes.

    Turns go by ``turn`` (null first), turns of one number by role and hash.  A
    null role or text is empty; rows of a null conversation take no part.
    """
    role, text = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"),
                        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("a"), F.col("b")]
    return running(rows.where("conv_id IS NOT NULL"), ["conv_id"], order, rank_col="n").select("conv_id", F.col("n").cast("long").alias("n"), "a", "b", "bytes")


def shared_starts(turns: DataFrame, every: int = 5, longest: int = 9) -> DataFrame:
    """``numbered`` turns rebuilt: the start of conversation c is that of conversation c - c % every.

    The first h turns, h = crc32(c) % longest, are those of the other one (all if
    it has fewer, none if it isn't there); c's own turns after its first h follow.
    A conversation that is left without turns keeps one row, with n = 0.
    """
    c = F.col("conv_id")
    lens = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("len"))
    convs = lens.select("conv_id", (c - c % every).alias("other"), (F.crc32(c.cast("string").cast("binary")) % longest).alias("h"))
    # a conversation is the other one of at most 2 * every - 1; those that aren't there join nothing
    held = lens.select(F.col("conv_id").alias("other"), F.least("len", F.lit(longest - 1)).alias("other_len"))
    convs = cut_lineage(convs.join(held, "other", "left").withColumn("shared", F.least("h", F.coalesce("other_len", F.lit(0)))))
    own = (turns.join(convs.select("conv_id", "h", "shared"), "conv_id").where("n > h")
           .select("conv_id", (F.col("n") - F.col("h") + F.col("shared")).alias("n"), "a", "b", "bytes"))
    starts = turns.where(F.col("n") < longest).select(F.col("conv_id").alias("other"), "n", "a", "b", "bytes")
    copied = convs.select("conv_id", "other", "h").join(starts, "other").where("n <= h").select("conv_id", "n", "a", "b", "bytes")
    none = convs.select("conv_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"),
                        F.lit(0).cast("long").alias("bytes"))
    return own.unionByName(copied).unionByName(none)


def _digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of a node's ids, streamed in order; a digest is sequential, so ids alone are sorted by node."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, digest, out = None, None, []
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k == key:
                    digest.update(b",%d" % c)
                    continue
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(b"%d" % c)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["key", "ends_sha256"])
                out = []
        if digest:
            out.append((key, digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["key", "ends_sha256"])

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, ends_sha256 string")


def trie(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv_id, n, a, b, bytes): n counts a conversation's turns from 1, n = 0 marks that it is there.

    Per node: key, conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (sum over the subtree of (n_convs - 1) *
    bytes) and ends_sha256 (of the ids that end at it, ascending, with commas).
    The empty table has no node.
    """
    hashes = {s: F.when(F.col("n") > 0, F.xxhash64(F.lit(k), "n", "a", "b")).otherwise(0).cast("decimal(20,0)") for k, s in ((3, "s"), (4, "t"))}
    named = running(rows, ["conv_id"], [F.col("n")], hashes, rank_col=None)
    up = [F.col(s) - hashes[s] for s in ("s", "t")]
    paths = named.select("conv_id", F.col("n").alias("depth"), "bytes", _key(F.col("n"), F.col("s"), F.col("t")).alias("key"),
                         F.when(F.col("n") > 0, _key(F.col("n") - 1, *up)).alias("parent"))
    paths = cut_lineage(paths)
    nodes = cut_lineage(paths.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
                                                 F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes")))
    whole = paths.where("depth = 0").count()
    heavy = nodes.where(F.col("n_convs") > int(whole ** 0.5))
    # the first light node of every conversation's path names the shard of the light nodes below
    flagged = paths.select("conv_id", "depth", "key").join(heavy.select("key", F.lit(True).alias("heavy")), "key", "left")
    tops = (flagged.where("heavy IS NULL").groupBy("conv_id").agg(F.min(F.struct("depth", "key")).alias("top"))
            .select("conv_id", F.col("top.key").alias("shard")))
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    light = (nodes.join(heavy.select("key"), "key", "left_anti").join(tops, "conv_id")
             .select("key", "depth", "parent", (F.col("key") == F.col("shard")).alias("top"), own, F.lit(0).cast("long").alias("children"),
                     F.lit(0).cast("long").alias("leaves"), "shard"))
    low = (light.repartition("shard").sortWithinPartitions(F.col("depth").desc(), "key").drop("shard").mapInArrow(_forward(limit), _FORWARD))
    low = cut_lineage(low)
    sums = low.where("to_key IS NOT NULL").groupBy(F.col("to_key").alias("key")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("more"))
    upper = (heavy.join(sums, "key", "left")
             .select("key", "depth", "parent", (F.col("depth") == 0).alias("top"), (own + F.coalesce("more", F.lit(0))).alias("saved"),
                     F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("leaves", F.lit(0)).alias("leaves")))
    # at most sqrt(conversations) heavy nodes at a depth: one stream
    high = upper.repartition(1).sortWithinPartitions(F.col("depth").desc(), "key").mapInArrow(_forward(limit), _FORWARD)
    totals = low.unionByName(high).select("key", "children", "leaves", "saved")
    lasts = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("end")).select(F.col("end.key").alias("key"), "conv_id")
    least = nodes.where("depth = 0").select("key", "conv_id")
    # the root may have as many children as there are conversations: its id joins by its one row
    deeper = nodes.where("depth > 1").select("key", "parent").join(nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    first = nodes.where("depth = 1").select("key", "parent").join(F.broadcast(least.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))), "parent")
    parents = deeper.unionByName(first).select("key", "parent_conv_id")
    return (nodes.join(totals, "key").join(parents, "key", "left").join(_digests(lasts), "key", "left")
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256")))
