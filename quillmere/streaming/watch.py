"""Watch-mode ingestion as Structured Streaming with a status table for retries."""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def watch(spark: SparkSession, folder: str, schema, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True, every: str = "5 seconds", fmt: str = "parquet") -> StreamingQuery:
    """New files of ``folder`` go through ``process`` and are written once per batch.

    Each batch writes its own folder, replaced if the batch is run again after a failure,
    so no row comes twice. ``once`` handles what is there and ends; else it keeps watching.
    """

    def each(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = spark.readStream.format(fmt).schema(schema).load(folder).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (q.trigger(availableNow=True) if once else q.trigger(processingTime=every)).start()


def record_status(spark: SparkSession, batch: DataFrame, key: str, ok, method: str, path: str, number: int) -> None:
    """Status rows of a batch: failures stay pending, since a file source never shows a file twice."""
    s = batch.select(key, F.when(ok, "ok").otherwise("error").alias("status"), F.lit(method).alias("method"), F.lit(number).alias("attempt"))
    s.write.mode("overwrite").parquet(f"{path}/batch={number}")


def run_pending(spark: SparkSession, items: DataFrame, key: str, process: Callable[[DataFrame], DataFrame], status: str, method: str, rounds: int = 3) -> DataFrame:
    """Items through ``process`` until each has an 'ok' of the method or the rounds are over; gives the status rows.

    ``process`` adds a boolean ``ok``. A round takes only what no earlier round, or run, has
    finished: failures stay pending, as a file source never shows a file twice.
    """
    from ..operators.changes import retry
    from ..session import cut_lineage

    schema = f"{key} {items.schema[key].dataType.simpleString()}, status string, method string, attempt int"
    known = spark.read.schema(schema).option("recursiveFileLookup", "true")
    first = 0
    if _exists(spark, status):
        first = (known.parquet(status).agg(F.max("attempt").alias("a")).first().a or 0) + 1
    for n in range(first, first + rounds):
        left = items if n == 0 else retry(items, known.parquet(status), key, method)
        left = cut_lineage(left)
        if left.isEmpty():
            break
        record_status(spark, process(left), key, F.col("ok"), method, status, n)
    return known.parquet(status)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class Snapshots(StreamingQueryListener):
    """Counters of a streaming query: totals, and a history point at most every ``every`` seconds, thinned beyond ``most``."""

    def __init__(self, every: float = 15.0, most: int = 500, clock: Callable[[], float] = time.monotonic):
        self.every, self.most, self.clock = every, most, clock
        self.began, self.last, self.rows, self.batches = clock(), -math.inf, 0, 0
        self.history: list[dict] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.began = self.clock()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.count(event.progress.numInputRows)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def count(self, rows: int) -> None:
        self.rows, self.batches = self.rows + rows, self.batches + 1
        now = self.clock()
        if now - self.last >= self.every:
            self.last = now
            self.history.append({"elapsed": round(now - self.began, 1), "rows": self.rows, "batches": self.batches})
            if len(self.history) > self.most:
                self.history = self.history[::2]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(h["elapsed"], h["rows"], h["batches"]) for h in self.history], "elapsed double, rows bigint, batches bigint")


def tumbling_counts(events: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window and kind; works on batch and streaming frames alike (an addition)."""
    d = events.withWatermark(ts, late) if events.isStreaming else events
    return d.groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")


def rates(snapshots: DataFrame, order: str, done: str, elapsed: str) -> DataFrame:
    """Rate per minute between consecutive snapshots, null where no time passed."""
    from pyspark.sql import Window

    w = Window.orderBy(order)  # snapshots of one run
    d, t = F.col(done) - F.lag(done).over(w), F.col(elapsed) - F.lag(elapsed).over(w)
    return snapshots.withColumn("rate", F.when(t > 0, F.round(d / t * 60, 4)))
