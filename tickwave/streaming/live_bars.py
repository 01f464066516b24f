"""Incremental OHLCV bars from trade envelopes as they land.

The same bar operator as the batch job, run as a stateful streaming
aggregation: the envelope folder is a file source, each micro-batch explodes
and decodes its new files, and the windowed aggregate keeps per-bucket state
until the watermark passes it.  Output mode ``update`` emits every bucket whose
value changed; ``foreachBatch`` appends those versions (with the batch id) to a
table, and the current bars are the latest version per bucket.  State is
bounded by the watermark, and a restart resumes from the checkpoint location
(exactly the files not yet committed are re-read).
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickwave.functions.timefn import ms_to_ts
from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.dedup import keep_latest
from tickwave.sources import schemas as S
from tickwave.sources.bronze import decode_trades


def stream_trades(spark: SparkSession, bronze_path: str, max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(S.TRADE_ENVELOPE_DDL).option("multiLine", True)
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return decode_trades(r.json(bronze_path))


def stream_bars(trades: DataFrame, width: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    """Real bars per ``(symbol, bucket)``; rows later than the watermark are
    dropped by Spark (their bucket has been finalised) and counted by
    :class:`LateRows`, if one listens.

    Watermarks need an instant (``TIMESTAMP``), so event time is
    ``timestamp_millis(ts_ms)``; bucket starts are turned back into UTC wall
    clock (``TIMESTAMP_NTZ``) through epoch milliseconds, independent of the
    session time zone."""
    t = trades.withColumn("event_time", F.timestamp_millis("ts_ms")).withWatermark("event_time", watermark)
    bars = ohlcv_bars(t, width, keys=["symbol"], ts="event_time", as_window=True)
    return bars.withColumn("bucket", ms_to_ts(F.unix_millis("bucket.start")))


class LateRows(StreamingQueryListener):
    """Counts what the watermark drops, from the progress of every micro-batch.

    Spark adds up rows of a bucket within a task before it compares them with
    the watermark, so late trades of one bucket that arrive in one task count
    once.  Events come some time after their batch; ``dropped`` of an ended
    query waits until its last one is in."""

    def __init__(self):
        self._dropped = defaultdict(dict)
        self._ended = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._dropped[str(p.runId)][p.batchId] = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def dropped(self, query, timeout: float = 60) -> int:
        """Rows dropped by this run of ``query`` up to now."""
        run = str(query.runId)
        if not query.isActive and not self._ended[run].wait(timeout):
            raise TimeoutError(f"no end of the stream's run {run} was reported")
        return sum(self._dropped[run].values())


def run_incremental(spark: SparkSession, bronze_path: str, out_path: str, checkpoint: str,
                    width: str = "1 minute", watermark: str = "10 minutes",
                    max_files: int | None = None, available_now: bool = True):
    """Start (and with ``available_now`` drain) the incremental bar job."""
    bars = stream_bars(stream_trades(spark, bronze_path, max_files), width, watermark)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")) \
            .write.mode("append").parquet(out_path)

    w = bars.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def current_bars(spark: SparkSession, out_path: str) -> DataFrame:
    """Latest emitted version of every bucket."""
    versions = spark.read.parquet(out_path)
    return keep_latest(versions, ["symbol", "bucket"], ["batch_id"]).drop("batch_id")
