"""Velocity on arrival: state per destination instead of windows that wait.

:mod:`txrisk.streaming.velocity` gives a (destination, hour) value once the
watermark has passed the hour, and its scoring job reads the landed files of that
hour again.  Here every row leaves in the micro-batch that brings it: the state of
a destination holds one cell (rows, cents) per hour of the lookback, a row's value
is the sum of the cells of its hour and of the ``lookback`` hours before it, and no
landed file is opened twice.

A row counts what has arrived by the end of its micro-batch.  For input in order,
with the rows of a destination's hour in one micro-batch, that is the batch frame
of :func:`txrisk.operators.velocity.with_velocity`; a peer that arrives later does
not change a row that has left.  A late row within the watermark is counted in its
hour's cell and gets that hour's frame as known by then.  Spark drops rows behind
the watermark before they reach the state.

State is bounded: cells of hours that no row within the watermark can reach are
removed by the destination's timer, and a destination without cells has no state
left.  The state store must be RocksDB (``STATE_STORE``), as ``transformWithState``
asks; the caller's session is never changed, :func:`state_session` derives one.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from txrisk import schema as S
from txrisk.functions.numeric import cents
from txrisk.streaming.velocity import EVENT_TIME, default_checkpoint, read_event_stream, score_stream

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows without a step (no event time) or destination meet under these.
_NO_KEY = "\x00"
_HOUR_MS = 3_600_000
#: Whole microseconds, so that a row leaves as it came.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose state store is RocksDB."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.streams  # noqa: B018 - the coordinator of state stores starts with it, also for tables
    return own


def _rolling(cells: dict[int, tuple[int, int, int]], hours: pd.Series, lookback: int) -> tuple[list[int], list[str | None]]:
    """Rows and cents (none without any amount) of the frame that ends at each hour;
    one sum per distinct hour."""
    sums = {}
    for h in hours.unique().tolist():
        n, amounts, total = map(sum, zip(*[cells[k] for k in range(h - lookback, h + 1) if k in cells]))
        sums[h] = n, str(total) if amounts else None
    return [sums[h][0] for h in hours.tolist()], [sums[h][1] for h in hours.tolist()]


class _HourlyCells(StatefulProcessor):
    """Cells by hour of one destination: rows, rows with an amount, cents."""

    def __init__(self, lookback: int, timers: bool):
        self.lookback, self.timers = lookback, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "hour long", "n long, amounts long, cents string")  # exact beyond a long

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)  # the rows of one key in one micro-batch, or a part of them
        new = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        held = {int(k[0]): (int(v[0]), int(v[1]), int(v[2])) for k, v in self.cells.iterator()}
        for hour, part in new.groupby("hour"):
            n, amounts, total = held.get(int(hour), (0, 0, 0))
            held[int(hour)] = n + len(part), amounts + int(part["amounts"].sum()), total + sum(part["value"].tolist())
            n, amounts, total = held[int(hour)]
            self.cells.updateValue((int(hour),), (n, amounts, str(total)))
        new["n"], new["total"] = _rolling(held, new["hour"], self.lookback)
        if self.timers:
            self._wake(held)
        yield new[["payload", "n", "total"]]

    def _wake(self, held) -> None:
        """One timer: when the oldest cell can no longer be in any row's frame."""
        at = (min(held) + self.lookback + 1) * _HOUR_MS
        if at not in {int(t) for t in self.handle.listTimers()}:
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // _HOUR_MS - self.lookback
        held = [int(k[0]) for k, _ in self.cells.iterator()]
        for hour in held:
            if hour < passed:
                self.cells.removeKey((hour,))
        left = [h for h in held if h >= passed]
        if left:
            self._wake(left)
        return iter(())

    def close(self) -> None:
        pass


def with_arrival_velocity(tx: DataFrame, watermark: str | None = "1 hour", lookback: int = S.LOOKBACK_STEPS,
                          time_col: str = EVENT_TIME) -> DataFrame:
    """``tx`` (a stream, or a table with ``watermark=None``) with the velocity
    columns; needs a session with the state store of :func:`state_session`.

    A row travels as one text column beside its hour and cents, so pandas never
    touches its types.  The rows of one destination in one micro-batch meet in one
    task's memory: bound a micro-batch with ``max_files_per_trigger``."""
    src = tx.withWatermark(time_col, watermark) if watermark else tx
    hour = F.floor(F.unix_seconds(F.col(time_col)) / 3600).cast("long")
    names = tx.columns
    keyed = src.select(
        F.coalesce(F.col(S.DEST), F.lit(_NO_KEY)).alias("key"), time_col, F.coalesce(hour, F.lit(-1 << 40)).alias("hour"),
        F.coalesce(cents(S.AMOUNT), F.lit(0)).alias("value"), F.col(S.AMOUNT).isNotNull().cast("int").alias("amounts"), F.to_json(F.struct(*names), _JSON).alias("payload"))
    out = keyed.groupBy("key").transformWithStateInPandas(
        _HourlyCells(lookback, bool(watermark)), "payload string, n long, total string", "Append", "EventTime" if watermark else "None")
    row = F.from_json("payload", tx.schema, _JSON)
    return out.select(row.alias("r"), "n", "total").select(
        "r.*", F.col("n").alias(S.VELOCITY_COUNT), 
        (F.col("total").cast("decimal(28,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)").alias(S.VELOCITY_AMOUNT))


def run_arrival_scoring(spark: SparkSession, in_path: str, out_path: str, model: PipelineModel,
                        checkpoint: str | None = None, watermark: str = "1 hour",
                        available_now: bool = False, max_files_per_trigger: int | None = None):
    """Start the job: event files in ``in_path`` -> velocity on arrival ->
    reconciliation -> scores -> Parquet in ``out_path``, each row in the micro-batch
    that brings it, exactly once (the file sink and the state share one
    checkpoint, named after ``out_path`` unless given).  Returns the query."""
    from txrisk.operators.balances import reconcile

    checkpoint = checkpoint or default_checkpoint(spark, "arrival", out_path)
    stream = read_event_stream(state_session(spark), in_path, max_files_per_trigger=max_files_per_trigger)
    scored = score_stream(model, reconcile(with_arrival_velocity(stream, watermark)))
    writer = (scored.select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.DEST, S.VELOCITY_COUNT, S.VELOCITY_AMOUNT, S.LABEL,
                            "prediction", "fraud_prob")
              .writeStream.outputMode("append").format("parquet")
              .option("path", out_path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
