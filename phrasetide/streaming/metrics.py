"""Progress counters and timings."""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("messages", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("durations", T.StringType()),
])


def counted(messages: DataFrame, name: str = "messages") -> tuple[DataFrame, Observation]:
    """``messages`` with a running count that is known once an action has run.

    The count is taken on the way, without a pass of its own.
    """
    seen = Observation(name)
    return messages.observe(seen, F.count(F.lit(1)).alias("messages")), seen


# A batch's delays as a quantile sketch; its ranks are off by less than this share.
SKETCH_ERROR = 0.02
SKETCHES = T.StructType([T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())])


def millis_between(since: Column, until: Column) -> Column:
    return F.unix_millis(until) - F.unix_millis(since)


def quantile_sketch(rows: DataFrame, value: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of ``value``s (whole numbers) and their quantile sketch, per ``by``.

    A sketch has a few kilobytes whatever it counts. Tasks sketch their rows and
    only sketches are shuffled.
    """
    return rows.groupBy(*by).agg(F.count(value).alias("n"),
                                 F.kll_sketch_agg_bigint(value).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The ``value`` at each of ``shares`` of all that the ``sketches`` have counted."""
    merged = (sketches.filter("n > 0")
              .agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
              .filter("n > 0"))
    wanted = F.array(*map(F.lit, shares))
    found = F.arrays_zip(wanted.alias("share"),
                         F.kll_sketch_get_quantile_bigint("sketch", wanted).alias("value"))
    return merged.select("n", F.explode(found).alias("q")).select("q.share", "q.value", "n")


class ProgressLog(StreamingQueryListener):
    """Reports of every batch of the queries that run while it listens.

    Spark itself remembers the latest hundred of a query only. A report is one
    small row; a log is read with :meth:`table` and freed with :meth:`close`.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.rows, self.ended = spark, [], threading.Condition()
        self.finished: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        times = {k: int(v) for k, v in report.durationMs.items()}
        self.rows.append((str(report.runId), report.batchId, report.numInputRows,
                          times.get("triggerExecution"), json.dumps(times, sort_keys=True)))

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.finished.add(str(event.runId))
            self.ended.notify_all()

    def table(self, query: StreamingQuery, timeout: float = 30) -> DataFrame:
        """All batches of ``query``; of one that has ended, once its last report is in."""
        run = str(query.runId)
        if not query.isActive:
            with self.ended:
                if not self.ended.wait_for(lambda: run in self.finished, timeout):
                    raise TimeoutError(f"no end of run {run} reported")
        return self.spark.createDataFrame([r[1:] for r in self.rows if r[0] == run], PROGRESS)

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def batch_sizes(batches: DataFrame) -> DataFrame:
    """Rows per batch of a stored table (see ``tables.read_batches``)."""
    return batches.groupBy("batch_id").agg(F.count("*").alias("rows"))


def show(rows: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` rows; the rest stays on the cluster."""
    rows.show(n, truncate=False)
