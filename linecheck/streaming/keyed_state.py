"""Verdicts from a stream of readings, with Spark's own state per history.

Every history (a machine and a model) has the rows of its open sample in the state store, and
what is known of it: its latest marker, the time that the open sample starts at and the newest time.
A micro-batch reads and writes the state of the histories that it has rows of, and no others.
Rows whose sample a later marker has closed leave the state and are judged; rows that come after
their sample was closed are late. With ``idle`` an event-time timer closes a sample whose history
has had no rows for so long.

A history's rows go through one task row by row; in memory are those of its open sample, when a marker
has come, and up to ``HELD`` new ones, so that rows which their own batch closes never go to the store.
Further ones go by way of the store. What a batch gives is stored under its number, and a batch
that is repeated after a failure overwrites its own output, so results appear once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from itertools import chain

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from linecheck import schemas as S
from linecheck.operators.check import check
from linecheck.operators.measured import written
from linecheck.operators.prepare import typed_lines
from linecheck.operators.timeline import DEFAULT_LIMIT
from linecheck.sources.tables import scan_lines

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Rows that go to the store at once.
CHUNK = 500

# New rows of a history that wait in memory for a marker; bounds memory, not results.
HELD = 20_000

# What is known of a history: latest marker, start of the open sample, newest time, and whether
# the open sample was closed for idleness.
KNOWN = "marker string, open_from string, newest string, shut boolean"

CLOSED, LATE = "closed", "late"
OUTPUT = T.StructType([*S.LINES, T.StructField("kind", T.StringType()), T.StructField("open_from", T.StringType())])

GIVEN = Row(*OUTPUT.names)

PATTERN = "%Y-%m-%d %H:%M:%S"


def _millis(time: str) -> int:
    return int(datetime.strptime(time[:19], PATTERN).replace(tzinfo=timezone.utc).timestamp() * 1000)


class OpenSamples(StatefulProcessor):
    """Keeps the rows of every history's open sample and lets go of those that are closed."""

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", KNOWN)
        self.rows = handle.getListState("rows", S.LINES)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        state = self.known.get()
        marker, open_from, newest, shut = state if state else (None, None, None, False)
        first_marker = None
        lowest = None
        held: list[tuple] = []
        for row in rows:
            row = tuple(row)
            number, time = row[0], row[3]
            if open_from is not None and time is not None and time < open_from:
                yield self._given(row, LATE, open_from)
                continue
            held.append(row)
            if len(held) >= HELD:
                self._keep(held)
                held = []
            if time is None:
                continue
            lowest = time if lowest is None else min(lowest, time)
            newest = time if newest is None else max(newest, time)
            if number == 1:
                first_marker = time if first_marker is None else min(first_marker, time)
                marker = time if marker is None else max(marker, time)
        before = open_from
        if first_marker is not None:
            open_from = marker
        elif open_from is None:
            open_from = lowest
        if shut or (first_marker is not None and open_from != before):
            # Rows before the marker that follow a sample closed for idleness are too late for it.
            bound = (first_marker or "~") if shut else ""
            yield from self._let_go(held, open_from if first_marker is not None else None, bound, before)
            shut = shut and first_marker is None
        else:
            self._keep(held)
        self.known.update((marker, open_from, newest, shut))
        if self.idle is not None and newest is not None and not shut:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(_millis(newest) + self.idle * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        state = self.known.get()
        if state:
            marker, open_from, newest, _ = state
            for row in self.rows.get():
                yield self._given(tuple(row), CLOSED, None)
            self.rows.clear()
            self.known.update((marker, open_from, newest, True))

    def _keep(self, rows: list[tuple]) -> None:
        for i in range(0, len(rows), CHUNK):
            self.rows.appendList(rows[i : i + CHUNK])

    def _let_go(self, held: list[tuple], closes: str | None, late_before: str, open_from: str | None) -> Iterator[Row]:
        """Of the stored and ``held`` rows those before ``closes`` are closed, those before ``late_before`` late; the others stay."""
        stay = []
        for row in chain(map(tuple, self.rows.get()), held):
            time = row[3]
            if late_before and (time is None or time < late_before):
                yield self._given(row, LATE, open_from)
            elif closes is not None and time is not None and time < closes:
                yield self._given(row, CLOSED, None)
            else:
                stay.append(row)
        self.rows.clear()
        self._keep(stay)

    @staticmethod
    def _given(row: tuple, kind: str, open_from: str | None) -> Row:
        return GIVEN(*row, kind, open_from)

    def close(self) -> None:
        pass


def closed_rows(readings: DataFrame, idle: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """The readings of closed samples, and late ones, as a stream: ``kind`` and ``open_from`` beside them.

    ``idle`` seconds without rows of a history, by the watermark with its ``delay``, close its sample.
    Times are texts, as in ``S.LINES``.
    """
    rows = scan_lines(readings).select(*S.LINES.names)
    if idle is None:
        mode, keyed = "none", rows
    else:
        mode = "eventTime"
        # Without the column itself, or Spark would drop rows below the watermark; they are to be late.
        marked = rows.withColumn("event_time", F.to_timestamp("datetime")).withWatermark("event_time", delay)
        keyed = marked.select(*S.LINES.names)
    return keyed.groupBy(*S.HISTORY).transformWithState(OpenSamples(idle), OUTPUT, "append", mode)


def _step(output: str, templates: DataFrame, limit: int | None) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{output}/given/batch={number}")
        rows = spark.read.schema(OUTPUT).parquet(f"{output}/given/batch={number}")
        _judge(rows.where(F.col("kind") == CLOSED), templates, f"{output}/verdicts/batch={number}", limit)

    return run


def _judge(rows: DataFrame, templates: DataFrame, path: str, limit: int | None) -> None:
    check(typed_lines(rows.select(*S.LINES.names)), templates, limit=limit).write.mode("overwrite").parquet(path)


def inspect_stream(
    readings: DataFrame,
    templates: DataFrame,
    output: str,
    checkpoint: str,
    *,
    idle: int | None = None,
    delay: str = "0 seconds",
    limit: int | None = DEFAULT_LIMIT,
) -> StreamingQuery:
    """Work off everything that is there, then stop.

    The state is in a store that writes what has changed (RocksDB), which this sets for the session.
    """
    readings.sparkSession.conf.set(STORE, ROCKS)
    writer = closed_rows(readings, idle, delay).writeStream.foreachBatch(_step(output, templates, limit))
    return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def open_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows of open samples, from the state of a stream that has stopped."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "rows").load()
    return state.select("list_element.*").select(*S.LINES.names)


def close_open_samples(
    spark: SparkSession, templates: DataFrame, output: str, checkpoint: str, *, limit: int | None = DEFAULT_LIMIT
) -> None:
    """Give verdicts to what is still open, for when no more rows will come."""
    # The check reads its rows twice; the state is read once.
    rows = written(open_rows(spark, checkpoint), "open-rows")
    _judge(rows, templates, f"{output}/verdicts/batch=open", limit)


def read_verdicts(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(S.VERDICTS).parquet(f"{output}/verdicts").select(*S.VERDICTS.names)


def read_late(spark: SparkSession, output: str) -> DataFrame:
    """The late rows, with the number of their ``batch`` and the start of the open sample that they came after."""
    schema = T.StructType([*OUTPUT, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{output}/given")
    return rows.where(F.col("kind") == LATE).drop("kind")
