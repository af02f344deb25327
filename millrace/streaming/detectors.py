"""Detectors that keep state per customer over a stream."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.fraud import RAPID
from millrace.streaming.jobs import event_time

# The state store of keyed state, which the session has to name before the stream starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Use that store for streams started inside, and the session's own one afterwards."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class RapidSuccession(StatefulProcessor):
    """Alerts once when a customer's transactions of the last ``seconds`` reach ``count``.

    State per customer: the seconds still in sight with their counts (a list, at most
    ``seconds`` + 1 rows) and their sum (a value). A timer of event time fires when the last of
    them goes out of sight, and clears both.
    """

    def __init__(self, count: int, seconds: int):
        self.count = count
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "second long, n long")
        self.total = handle.getValueState("total", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = sorted((int(s), int(n)) for frame in rows for s, n in zip(frame["second"], frame["n"]))
        recent = deque((int(s), int(n)) for s, n in self.recent.get()) if self.recent.exists() else deque()
        total = int(self.total.get()[0]) if self.total.exists() else 0
        alerts = []
        for second, n in new:
            while recent and recent[0][0] < second - self.seconds:
                total -= recent.popleft()[1]
            if total < self.count <= total + n:
                alerts.append((key[0], second, total + n))
            recent.append((second, n))
            total += n
        self.recent.put(list(recent))
        self.total.update((total,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((recent[-1][0] + self.seconds + 1) * 1000)
        yield pd.DataFrame({
            "customer": [a[0] for a in alerts], "epoch": pd.Series([a[1] for a in alerts], dtype="int64"),
            "n_recent": pd.Series([a[2] for a in alerts], dtype="int64"),
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        self.total.clear()
        return iter(())


def rapid_succession_stream(
    df: DataFrame, customer: str, ts: str, count: int = RAPID[0], seconds: int = RAPID[1], delay: str = "10 minutes",
    transaction: str | None = None,
) -> DataFrame:
    """Alerts of ``fraud.rapid_alerts`` over a stream, each once.

    Transactions are counted per customer and second first, so that a busy customer's rows are
    summed up before they meet in one state, and a second is passed on only when the watermark
    has closed it: what comes out of order within ``delay`` still counts in its own second, what comes
    later is left out. ``transaction`` names an id; what is sent again with it within ``delay``
    counts once. Rows without customer or time are no one's. After a restart from its
    checkpoint the query goes on with the state it had. Start it within ``keyed_state``.
    """
    rows = event_time(df, ts, delay).where(F.col(customer).isNotNull() & F.col(ts).isNotNull())
    if transaction:
        rows = rows.dropDuplicatesWithinWatermark([transaction])
    per_second = rows.groupBy(F.col(customer).alias("customer"), F.window(ts, "1 second").alias("w")).agg(F.count("*").alias("n"))
    seen = per_second.select("customer", F.window_time("w").alias("closed"), F.unix_timestamp("w.start").alias("second"), "n")
    kind = df.schema[customer].dataType.simpleString()
    out = seen.groupBy("customer").transformWithStateInPandas(
        RapidSuccession(count, seconds), f"customer {kind}, epoch long, n_recent long", "Append", "EventTime"
    )
    return out.withColumnRenamed("customer", customer)
