"""The heaviest requests of each time window, kept up to date while a stream runs.

Two levels: requests are dealt by hash into buckets of their window, and each bucket keeps its
best ``k`` in state; the best ``k`` of a window are among those of its buckets. So a
window's state is at most buckets x k rows however many requests it has, and a hot window or session is
spread over tasks. When the watermark has passed a window its state goes.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from lakeaudit.streaming import run

# Fixed value: requests that the live view lists.
TOP = 15
BUCKETS = 8


def _order(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]


def top_per_window(df: DataFrame, ts: str, width: str, order: Sequence[tuple[str, bool]], k: int = TOP) -> DataFrame:
    """Add ``window_start`` and ``rank``: the best ``k`` rows of each window, in batch.

    ``order`` lists columns and whether they descend; they should tell all rows apart. Spark cuts
    each task's rows to ``k`` per window before the shuffle. Rows without a time are left out.
    """
    timed = df.where(F.col(ts).isNotNull()).withColumn("window_start", F.window(ts, width)["start"])
    best = Window.partitionBy("window_start").orderBy(*_order(order))
    return timed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


class BestRows(StatefulProcessor):
    """Keeps the best ``k`` rows of one bucket of one window, and emits them when they change."""

    def __init__(self, order: Sequence[tuple[str, bool]], k: int, columns: list[str], state: str, out: list[str]):
        self.by, self.down, self.k = [c for c, _ in order], [d for _, d in order], k
        self.columns, self.schema, self.out = columns, state, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.best.get()) if self.best.exists() else [], columns=self.columns)

    def handleInputRows(self, key, rows, timerValues):
        before = self._held()
        best = before
        for frame in rows:
            own = frame[self.columns].astype(object)
            best = pd.concat([best, own]) if len(best) else own
            best = best.sort_values(self.by, ascending=[not d for d in self.down], na_position="last", kind="stable").head(self.k)
        if not before.reset_index(drop=True).equals(best.reset_index(drop=True)):
            start, end, bucket = key
            if not len(before):
                self.handle.registerTimer(int(end))
            # Missing numbers and texts alike are stored as null.
            self.best.put([tuple(None if pd.isna(v) else v for v in line) for line in best.itertuples(index=False)])
            heads = pd.DataFrame({"window_start": [start] * len(best), "bucket": [bucket] * len(best), "place": range(1, len(best) + 1)})
            yield pd.concat([heads, best.reset_index(drop=True)], axis=1)[self.out]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.best.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def bucket_tops(
    stream: DataFrame, ts: str, width: str, order: Sequence[tuple[str, bool]], spread: str, k: int = TOP, buckets: int = BUCKETS, delay: str = "1 hour"
) -> DataFrame:
    """(window_start, bucket, place, columns of the stream but ``ts``) in update mode: what each bucket holds now.

    ``spread`` is the column whose hash deals rows to buckets. Rows that come later than the
    delay are dropped. The session needs the RocksDB state store.
    """
    columns = [f for f in stream.schema.fields if f.name != ts]
    dealt = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay).withColumn("_window", F.window(ts, width))
    # The time stays: by it Spark drops what is later than the watermark.
    dealt = dealt.select(ts, *[c.name for c in columns], F.col("_window.start").alias("window_start"), F.unix_millis("_window.end").alias("_end_ms"), F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("int").alias("bucket"))
    head = [T.StructField("window_start", T.TimestampType()), T.StructField("bucket", T.IntegerType()), T.StructField("place", T.IntegerType())]
    out = T.StructType([*head, *columns])
    state = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    processor = BestRows(order, k, [f.name for f in columns], state, out.names)
    return dealt.groupBy("window_start", "_end_ms", "bucket").transformWithStateInPandas(processor, out, "Update", "EventTime")


def window_tops(tops: DataFrame, order: Sequence[tuple[str, bool]], k: int = TOP) -> DataFrame:
    """The best ``k`` rows of each window of what its buckets hold: at most buckets x k rows each."""
    best = Window.partitionBy("window_start").orderBy(*_order(order))
    return tops.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("bucket", "place")


def run_live_top(
    spark: SparkSession, stream: DataFrame, ts: str, width: str, order: Sequence[tuple[str, bool]], spread: str, k: int = TOP,
    buckets: int = BUCKETS, delay: str = "1 hour", path: str | None = None,
) -> DataFrame:
    """Process all that is there, and return each window's list as it stands then.

    Run again with the same ``path`` it goes on where it stopped.
    """
    with run.state_store(spark):
        tops = bucket_tops(stream, ts, width, order, spread, k, buckets, delay)
        return window_tops(run.run_updates(tops, ["window_start", "bucket", "place"], "live-top", path), order, k)
