"""Event-time order for state machines on streams: rows wait until the watermark has passed them.

``ordered_fold`` keeps, per key, the rows that may still be overtaken and the
machine's state.  An event-time timer for the first row that waits hands the rows
up to the watermark, in order, to the machine: none before can come.  So
the outcome doesn't depend on how files or batches are cut or shuffled, as long
as no row is later than the watermark's delay.  Rows behind the watermark are
dropped by Spark and counted (``dropped_rows``).  A key that goes quiet is
released by the progress of the others; ``keep`` lets a machine forget its state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from kestrel.session import checkpoint_dir

#: A machine: (key, rows in order as tuples, state or None) -> (output tuples, new state, which is None to forget the key).
Fold = Callable[[tuple, list[tuple], object], tuple[list[tuple], object]]


#: Most rows that wait together in a list entry, and that a machine is handed at once (but for rows of one time).
TOGETHER = 4096


def _plain(column) -> list:
    """Values of a column as JSON takes them; what isn't known is None."""
    import pandas as pd

    values = column.astype(object).tolist()
    unknown = column.isna().tolist()
    return [None if gone else v.tolist() if hasattr(v, "tolist") else v for v, gone in zip(values, unknown, strict=True)]


class OrderedFold(StatefulProcessor):
    """Rows wait in a list, sorted and a few thousand in an entry with their first and last time; a key has a timer for its first row, not one for each."""

    def __init__(self, fold: Fold, columns: list[str], time: str, order: list[str], out: list[str]):
        self.fold, self.columns, self.time, self.order, self.out = fold, columns, time, order, out
        self.at = columns.index(time)
        self.places = [columns.index(c) for c in order]

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "lo long, hi long, rows string")
        self.state = handle.getValueState("state", "s string")

    def place(self, row) -> tuple:
        return (row[self.at], *[row[p] for p in self.places])

    def entries(self, rows: list) -> Iterator[tuple]:
        for k in range(0, len(rows), TOGETHER):
            some = rows[k:k + TOGETHER]
            yield some[0][self.at], some[-1][self.at], json.dumps(some)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        first = None
        for frame in rows:
            new = list(zip(*[_plain(frame[c]) for c in self.columns], strict=True))
            if new:
                # by time alone: the order within a time needn't be known of rows that wait
                new = sorted(((*r[:self.at], int(r[self.at]), *r[self.at + 1:]) for r in new), key=lambda r: r[self.at])
                self.waiting.appendList(list(self.entries(new)))
                first = new[0][self.at] if first is None else min(first, new[0][self.at])
        if first is not None:
            self.handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        # whatever the watermark has passed is due, and what comes from now on is behind none of it
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        due, left, opened = [], [], False
        for lo, hi, text in self.waiting.get():
            if lo > until:
                left.append((lo, hi, text))
                continue
            some, opened = [tuple(r) for r in json.loads(text)], True
            n = len(some) if hi <= until else sum(r[self.at] <= until for r in some)
            due += some[:n]
            left += self.entries(some[n:])
        if not opened:  # an earlier timer had them
            return
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(min(lo for lo, _, _ in left))
        else:
            self.waiting.clear()
        if any(k is None for k in key):  # rows of null keys only mark the time
            return
        due.sort(key=self.place)
        state = json.loads(self.state.get()[0]) if self.state.exists() else None
        begin = 0
        while begin < len(due):
            end = min(begin + TOGETHER, len(due))
            while end < len(due) and due[end][self.at] == due[end - 1][self.at]:  # rows of one time stay together
                end += 1
            out, state = self.fold(key, due[begin:end], state)
            begin = end
            if out:
                yield pd.DataFrame(out, columns=self.out)
        if state is None:
            self.state.clear()
        else:
            self.state.update((json.dumps(state),))

    def close(self) -> None:
        pass


def ordered_fold(stream: DataFrame, keys: list[str], time_ms: str, order: list[str], fold: Fold, out: str, delay: str) -> DataFrame:
    """``fold`` over each key's rows by ``time_ms`` (event time, long) and then ``order``, released by a watermark of ``delay``.

    Output times are not before the watermark's: a row is out as soon as nothing
    may come before it.
    """
    columns = list(stream.columns)
    timed = stream.withColumn("_event", F.timestamp_millis(time_ms)).withWatermark("_event", delay)
    names = StructType.fromDDL(out).names
    return timed.groupBy(*keys).transformWithStateInPandas(
        OrderedFold(fold, columns, time_ms, order, names), outputStructType=out, outputMode="append", timeMode="EventTime")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, which ``ordered_fold`` needs and a session doesn't have by default.

    A query keeps the settings of its start, so the session's own come back at once.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def dropped_rows(query) -> int:
    """Rows that came behind the watermark in the query's recent progress, and weren't used."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def run_files(spark: SparkSession, folder: str, schema: str, operator: Callable[[DataFrame], DataFrame], time_ms: str, out: str,
              glob: str | None = None, files_at_once: int = 1, delay_ms: int = 0, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Everything that ``operator`` makes of the Parquet files of ``folder``, read as a stream of ``files_at_once``.

    ``prepare`` brings the files' columns into the form that ``operator`` takes
    and that ``time_ms`` is in.  The input has an end here, and what waits for the
    watermark at the end must come out too: after the files a second source gives
    one row of null keys, ``delay_ms`` and more after the last time, and the query
    goes on from its checkpoint.  The result is read from the sink's folder.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    options = {"maxFilesPerTrigger": str(files_at_once)} | ({"pathGlobFilter": glob} if glob else {})
    plain = prepare or (lambda df: df)
    names = plain(spark.createDataFrame([], schema)).schema
    spark.createDataFrame([], names).write.parquet(f"{base}/end")

    def go() -> None:
        rows = plain(spark.readStream.schema(schema).options(**options).parquet(folder))
        ended = rows.unionByName(spark.readStream.schema(names).parquet(f"{base}/end"))
        sink = (operator(ended).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk")
                .outputMode("append").trigger(availableNow=True))
        with rocksdb_state(spark):
            query = sink.start()
        query.awaitTermination()

    go()
    files = spark.read.schema(schema)
    last = plain((files.option("pathGlobFilter", glob) if glob else files).parquet(folder)).agg(F.max(time_ms)).first()[0]
    if last is not None:
        end = [F.lit(last + 2 * delay_ms + 1).cast("long").alias(f.name) if f.name == time_ms else F.lit(None).cast(f.dataType).alias(f.name) for f in names]
        spark.range(1).select(*end).write.mode("append").parquet(f"{base}/end")
        go()
    return spark.read.schema(out).parquet(f"{base}/out")
