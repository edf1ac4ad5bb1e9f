"""Alarms as state machines over a stream of metric points (W2): OK / ALARM transitions per rule.

Points are added up per rule and period inside each task before the shuffle; one state per rule holds the
open periods, the run of breaching periods, and whether the alarm is on.  A period closes when the watermark
passes its end (an event-time timer).  While an alarm is on or a run has begun, the next period's timer is
set as well, so that a period without points, which does not breach, ends it.  Points that come later than
the delay find their period closed and change nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerline.schemas import ALARM_RULES

COMPARE = {">": lambda v, t: v > t, ">=": lambda v, t: v >= t, "<": lambda v, t: v < t, "<=": lambda v, t: v <= t}
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rule of the points that no rule reads.
CLOCK = ""
PARTIAL = "rule string, bucket long, n long, cents long, low double, high double, at timestamp"
TRANSITION = "rule string, metric string, state string, bucket_start timestamp, stat_value double"


def partial_sums(points: DataFrame, rules: dict) -> DataFrame:
    """Per Arrow batch, rule and period: points, exact sum, least, greatest, newest time.  Points of other
    metrics keep their time only (rule ``CLOCK``): they move the watermark."""
    by_metric: dict[str, list] = {}
    for name, (metric, _, period, *_) in rules.items():
        by_metric.setdefault(metric, []).append((name, period))
    cents = (F.col("value").cast("decimal(18,2)") * 100).cast("long")
    rows = points.select("metric", F.col("ts").cast("timestamp").alias("at"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"),
                         F.col("value").cast("double").alias("value"), cents.alias("cents"))

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            parts = []
            for metric, own in f.groupby("metric", dropna=False):
                for name, period in by_metric.get(metric, [(CLOCK, 1 << 40)]):
                    sums = own.groupby(own["s"] // period).agg(n=("cents", "size"), cents=("cents", "sum"), low=("value", "min"),
                                                               high=("value", "max"), at=("at", "max"))
                    parts.append(sums.rename_axis("bucket").reset_index().assign(rule=name))
            if parts:
                out = pd.concat(parts)[["rule", "bucket", "n", "cents", "low", "high", "at"]]
                yield out.assign(cents=out["cents"].fillna(0).astype("int64"))

    return rows.mapInPandas(each, PARTIAL)


class AlarmMachine(StatefulProcessor):
    """State of one rule."""

    def __init__(self, rules: dict):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "bucket long", "n long, cents long, low double, high double")
        self.run = handle.getValueState("run", "length int, last long, alarm boolean")

    def _period(self, key) -> int:
        return self.rules[key[0]][2]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] == CLOCK:
            return
        period = self._period(key)
        for f in rows:
            for bucket, n, cents, low, high in zip(f["bucket"].tolist(), f["n"].tolist(), f["cents"].tolist(), f["low"].tolist(), f["high"].tolist()):
                if (bucket + 1) * period * 1000 <= timerValues.getCurrentWatermarkInMs():
                    continue  # its period is closed
                if self.open.containsKey((bucket,)):
                    m, c, lo, hi = self.open.getValue((bucket,))
                    n, cents, low, high = n + m, cents + c, min(low, lo), max(high, hi)
                self.open.updateValue((bucket,), (n, cents, low, high))
                self.handle.registerTimer((bucket + 1) * period * 1000)
        return
        yield  # transitions come with the timers

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        metric, stat, period, compare, threshold, periods = self.rules[key[0]]
        bucket = expiredTimerInfo.getExpiryTimeInMs() // 1000 // period - 1
        length, last, alarm = self.run.get() if self.run.exists() else (0, bucket - 1, False)
        if bucket <= last:  # a period without points that a later one has closed meanwhile
            return
        found, value = [], None
        if last < bucket - 1:  # no points in between
            if alarm:
                found.append((key[0], metric, "OK", pd.Timestamp((last + 1) * period, unit="s"), None))
            length, alarm = 0, False
        if self.open.containsKey((bucket,)):
            n, cents, low, high = self.open.getValue((bucket,))
            value = {"sum": cents / 100, "avg": cents / 100 / n, "min": low, "max": high}[stat]
            self.open.removeKey((bucket,))
        breach = value is not None and COMPARE[compare](value, threshold)
        length = length + 1 if breach else 0
        on = length >= periods
        if on != alarm:
            found.append((key[0], metric, "ALARM" if on else "OK", pd.Timestamp(bucket * period, unit="s"), value))
        after = (bucket + 2) * period * 1000
        if length and after <= timerValues.getCurrentWatermarkInMs() and not self.open.containsKey((bucket + 1,)):
            bucket += 1  # the next period is over, too, and had no points
            if on:
                found.append((key[0], metric, "OK", pd.Timestamp(bucket * period, unit="s"), None))
            length, on = 0, False
        elif length:
            self.handle.registerTimer(after)
        self.run.update((min(length, periods), bucket, on))
        if found:
            yield pd.DataFrame(found, columns=["rule", "metric", "state", "bucket_start", "stat_value"]).astype(
                {"bucket_start": "datetime64[ns]", "stat_value": float})

    def close(self) -> None:
        pass


def stream_alarms(spark: SparkSession, points: DataFrame, out: str, checkpoint: str, rules: dict | None = None, delay: str = "5 minutes",
                  available_now: bool = True):
    """Transitions of all rules over a streaming DataFrame (metric, ts, value), written to ``out`` by micro-batch."""
    rules = ALARM_RULES if rules is None else rules
    # the process that opens the state on the driver does not have the package on its path
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    sums = partial_sums(points, rules).withWatermark("at", delay)
    changes = sums.groupBy("rule").transformWithStateInPandas(AlarmMachine(rules), TRANSITION, "Append", "EventTime")

    def per_batch(batch: DataFrame, epoch_id: int):
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/epoch={epoch_id}")

    writer = changes.writeStream.outputMode("append").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 seconds")).start()
    if available_now:
        query.awaitTermination()
    return query


def transitions(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(TRANSITION).option("recursiveFileLookup", True).parquet(out)
