"""Rolling destination velocity on a stream (event time).

The batch feature counts, for a row in hour ``h``, the rows of the same
destination in hours ``h-24 .. h`` (25 hours, peers included).  On a stream
that is a sliding event-time window of 25 hours moving by 1 hour over
hourly totals: the window that ends at ``h + 1`` holds exactly those rows.  Range frames over
rows are not supported on streams; the windowed aggregation is, with a
watermark bounding the state (one partial aggregate per destination and
open window) and emitting each window once, when the watermark passes its
end (append mode) -- by then every peer of the hour has arrived.  Rows later
than the watermark are dropped by Spark; the watermark delay is the knob.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.sources.events import EPOCH, EVENTS_SCHEMA, events_to_transactions, type_source_predicate

EVENT_TIME = "event_time"


def default_checkpoint(spark: SparkSession, job: str, out_path: str) -> str:
    """The query checkpoint of a job that writes to ``out_path``: always the
    same folder for the same output, so a restarted job resumes."""
    from txrisk.session import ensure_checkpoint_dir

    # the session's own folder within it has another name in each run
    base = ensure_checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]
    name = hashlib.sha256(out_path.rstrip("/").encode()).hexdigest()[:24]
    return f"{base}/txrisk-{job}-{name}"


def read_event_stream(spark: SparkSession, path: str, types=S.RISKY_TYPES,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of transactions from Parquet files of ``events`` arriving in
    ``path``; declared schema, type filter at the source, event time kept."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(path)
    if types is not None:
        events = events.where(type_source_predicate(types))
    return events_to_transactions(events, event_time=EVENT_TIME)


def velocity_windows(tx: DataFrame, key: str = S.DEST, time_col: str = EVENT_TIME,
                     lookback_hours: int = S.LOOKBACK_STEPS, watermark: str | None = "1 hour",
                     value: str = S.AMOUNT) -> DataFrame:
    """Per (key, hour): count and value sum over the trailing
    ``lookback_hours + 1`` hours, from event-time windows.

    Two chained aggregations: rows are first counted per key and 1-hour
    tumbling window (each row is touched once and a hot key collapses
    map-side to one row per task and hour); the hourly rows are then summed
    over sliding windows of ``lookback_hours + 1`` hours moving by one hour
    (``window_time`` carries the event time from the first aggregation to
    the second).  Sliding windows directly over the rows would copy every
    raw row into each of its ``lookback_hours + 1`` windows first.

    Only windows whose last hour has rows are returned (the others are of no
    use to scoring and would be up to ``lookback_hours + 1`` times as many).

    ``hour`` is the last hour the window covers (window end minus one hour).
    Works on batch and streaming DataFrames; ``watermark=None`` for batch."""
    src = tx.withWatermark(time_col, watermark) if watermark else tx
    hourly = (src.groupBy(F.col(key), F.window(time_col, "1 hour").alias("_h"))
                 .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s")))
    w = F.window(F.window_time("_h"), f"{lookback_hours + 1} hours", "1 hour")
    return (hourly.groupBy(F.col(key), w.alias("_w"))
                  .agg(F.sum("_n").alias(S.VELOCITY_COUNT), F.sum("_s").alias(S.VELOCITY_AMOUNT),
                       F.max("_h.end").alias("_last"))
                  .where(F.col("_last") == F.col("_w.end"))
                  .select(key,
                          (F.col("_w.end") - F.expr("INTERVAL 1 HOUR")).alias("hour"),
                          S.VELOCITY_COUNT, S.VELOCITY_AMOUNT))


def step_of_hour(hour: str = "hour") -> Column:
    """Step number (hours since 2024-01-01 00:00 UTC, plus 1) of an hour
    instant, the same rule that maps ``events.ts`` to ``step``.  Computed from
    epoch hours, so the session time zone plays no part."""
    first = (EPOCH - date(1970, 1, 1)).days * 24
    return (F.floor(F.unix_seconds(F.col(hour)) / 3600) - first + 1).cast("int")


def score_stream(model: PipelineModel, enriched_stream: DataFrame) -> DataFrame:
    """Score a stream of enriched rows with a fitted pipeline (stateless
    per-row transform; indexer, assembler and trees all apply row by row)."""
    from txrisk.functions.numeric import decimals_to_double
    from txrisk.functions.vectors import positive_probability

    return (model.transform(decimals_to_double(enriched_stream))
                 .withColumn("fraud_prob", positive_probability()))


def run_velocity_stream(spark: SparkSession, in_path: str, out_path: str,
                        checkpoint: str | None = None, watermark: str = "1 hour",
                        available_now: bool = False, max_files_per_trigger: int | None = None):
    """Start the streaming job: events files in ``in_path`` -> rolling
    destination velocity -> Parquet files in ``out_path`` (append mode, one
    row per destination and hour once the watermark has passed it).

    The query checkpoint defaults to a folder named after ``out_path`` beside
    the session's checkpoint directory, so a restarted job resumes where it
    stopped.  Returns the ``StreamingQuery``."""
    checkpoint = checkpoint or default_checkpoint(spark, "velocity", out_path)
    stream = read_event_stream(spark, in_path, max_files_per_trigger=max_files_per_trigger)
    out = velocity_windows(stream, watermark=watermark).withColumn(S.STEP, step_of_hour())
    writer = (out.writeStream.outputMode("append").format("parquet")
                 .option("path", out_path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _utc_wall_clock(epoch_seconds: int) -> Column:
    """A TIMESTAMP_NTZ literal: the UTC wall clock of an epoch second."""
    from datetime import datetime, timezone

    t = datetime.fromtimestamp(epoch_seconds, tz=timezone.utc)
    return F.make_timestamp_ntz(F.lit(t.year), F.lit(t.month), F.lit(t.day), F.lit(t.hour),
                                F.lit(t.minute), F.lit(t.second))


def hour_start(col: str = EVENT_TIME) -> Column:
    """The UTC hour an instant falls in (epoch arithmetic, no time zone)."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(F.col(col)) / 3600) * 3600)


def run_scoring_stream(spark: SparkSession, in_path: str, out_path: str, model: PipelineModel,
                       checkpoint: str | None = None, watermark: str = "1 hour",
                       available_now: bool = False, max_files_per_trigger: int | None = None):
    """Streaming enrichment and scoring of the risky rows landing in ``in_path``.

    The velocity stream emits a (destination, hour) value only once the
    watermark has passed the hour, i.e. when it is final.  Each micro-batch of
    those values is joined to the rows of exactly those hours -- read from the
    landed files with an event-time range filter that reaches the Parquet
    scan -- then reconciled, scored, and written to ``out_path/epoch=<id>``
    (overwritten on replay, so a restarted epoch does not duplicate rows).
    The checkpoint defaults to a folder named after ``out_path``.

    Late rows: a row that has landed when its hour becomes final is scored,
    with the velocity of the rows that were in time (a row behind the
    watermark is not counted in it).  A row that lands later is not scored;
    :func:`unscored_rows` lists these."""
    from txrisk.operators.balances import reconcile
    from txrisk.operators.model import score

    checkpoint = checkpoint or default_checkpoint(spark, "scoring", out_path)
    vel = velocity_windows(read_event_stream(spark, in_path, max_files_per_trigger=max_files_per_trigger),
                           watermark=watermark)

    def score_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()  # the stateful plan runs once per epoch, two actions read it
        try:
            _score_epoch(batch, epoch_id)
        finally:
            batch.unpersist()

    def _score_epoch(batch: DataFrame, epoch_id: int) -> None:
        # the hour range of this epoch: two epoch-second values to the driver
        lo, hi = batch.agg(F.min(F.unix_seconds("hour")), F.max(F.unix_seconds("hour"))).first()
        if lo is None:
            return
        events = spark.read.schema(EVENTS_SCHEMA).parquet(in_path)
        # range on the raw wall-clock column, so Parquet skips other row groups
        events = events.where(type_source_predicate(S.RISKY_TYPES)
                              & (F.col("ts") >= _utc_wall_clock(lo))
                              & (F.col("ts") < _utc_wall_clock(hi + 3600)))
        rows = events_to_transactions(events, event_time=EVENT_TIME)
        rows = rows.withColumn("hour", hour_start())
        enriched = reconcile(rows.join(batch, [S.DEST, "hour"], "inner"))
        (score(model, enriched)
            .select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.DEST, S.VELOCITY_COUNT,
                    S.VELOCITY_AMOUNT, S.LABEL, "prediction", "fraud_prob")
            .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}"))

    writer = vel.writeStream.foreachBatch(score_epoch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def unscored_rows(spark: SparkSession, in_path: str, out_path: str, types=S.RISKY_TYPES) -> DataFrame:
    """Landed rows up to the last scored step that no epoch has scored: they
    landed after their hour was final.  Count them to watch for late input."""
    scored = spark.read.parquet(out_path)
    events = spark.read.schema(EVENTS_SCHEMA).parquet(in_path).where(type_source_predicate(types))
    last = scored.agg(F.max(S.STEP)).scalar()
    landed = events_to_transactions(events).where(F.col(S.STEP) <= last)
    return landed.join(scored.select(S.TX_ID), S.TX_ID, "left_anti")
