import tempfile

from pyspark.sql import functions as F

from conftest import SF001, SF01
from txrisk import schema as S
from txrisk.operators.velocity import rolling_totals
from txrisk.plans import stages
from txrisk.sources.events import load_transactions
from txrisk.streaming import read_event_stream, score_stream, step_of_hour, velocity_windows


def _write_daily_files(spark, src, out, days_per_file=4):
    """The events as one file per few days, so the stream sees several
    triggers and the watermark advances between them."""
    ev = spark.read.parquet(f"{src}/events.parquet")
    days = sorted(r[0] for r in ev.select(F.dayofyear("ts")).distinct().collect())
    chunks = [days[i:i + days_per_file] for i in range(0, len(days), days_per_file)]
    for c in chunks:
        ev.where(F.dayofyear("ts").isin(c)).coalesce(1).write.mode("append").parquet(out)
    return len(chunks)


def test_stream_velocity_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="txrisk-stream-")
    n_files = _write_daily_files(spark, SF001, f"{d}/in")
    stream = read_event_stream(spark, f"{d}/in", max_files_per_trigger=1)
    q = (velocity_windows(stream, watermark="1 hour")
         .writeStream.outputMode("append").format("memory").queryName("vel_stream")
         .option("checkpointLocation", f"{d}/ckpt").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert n_files >= 5
    got = spark.table("vel_stream").select(S.DEST, step_of_hour().alias(S.STEP),
                                           F.col(S.VELOCITY_COUNT).alias("c"),
                                           F.col(S.VELOCITY_AMOUNT).alias("s"))
    batch = rolling_totals(load_transactions(spark, SF001, types=S.RISKY_TYPES))
    j = batch.join(got, [S.DEST, S.STEP], "inner")
    # every emitted window that lands on a step with rows equals the batch frame
    assert j.count() > 0
    assert j.where((F.col("c") != F.col(S.VELOCITY_COUNT))
                   | ~F.col("s").eqNullSafe(F.col(S.VELOCITY_AMOUNT))).count() == 0
    # windows are emitted only once the watermark has passed them
    max_step = batch.agg(F.max(S.STEP)).first()[0]
    assert got.agg(F.max(S.STEP)).first()[0] <= max_step + 24


def test_score_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="txrisk-score-")
    enr = stages.enriched_from_dir(spark, SF01)
    run = stages.model_run(spark, enr, maxIter=5)
    run.test.write.parquet(f"{d}/test")
    stream = spark.readStream.schema(run.test.schema).parquet(f"{d}/test")
    q = (score_stream(run.model, stream).select(S.TX_ID, "prediction", "fraud_prob")
         .writeStream.format("memory").queryName("scored").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(tuple(r) for r in spark.table("scored").collect())
    want = sorted(tuple(r) for r in run.predictions.select(S.TX_ID, "prediction", "fraud_prob").collect())
    assert got == want


def test_velocity_stream_job_resumes(spark):
    from txrisk.streaming import run_velocity_stream

    d = tempfile.mkdtemp(prefix="txrisk-job-")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.where(F.dayofyear("ts") <= 15).write.parquet(f"{d}/in/part1")
    q = run_velocity_stream(spark, f"{d}/in/*", f"{d}/out", checkpoint=f"{d}/ckpt",
                            available_now=True)
    q.awaitTermination(300)
    first = spark.read.parquet(f"{d}/out").count()
    assert first > 0
    # more files arrive; the restarted job continues from its checkpoint
    ev.where(F.dayofyear("ts") > 15).write.parquet(f"{d}/in/part2")
    q = run_velocity_stream(spark, f"{d}/in/*", f"{d}/out", checkpoint=f"{d}/ckpt",
                            available_now=True)
    q.awaitTermination(300)
    out = spark.read.parquet(f"{d}/out")
    assert out.count() > first
    assert out.groupBy(S.DEST, "hour").count().where("count > 1").count() == 0
    batch = rolling_totals(load_transactions(spark, SF001, types=S.RISKY_TYPES))
    j = batch.join(out.select(S.DEST, S.STEP, F.col(S.VELOCITY_COUNT).alias("c")), [S.DEST, S.STEP])
    assert j.count() > 0 and j.where(F.col("c") != F.col(S.VELOCITY_COUNT)).count() == 0


def test_scoring_stream_equals_batch(spark):
    from txrisk.streaming import run_scoring_stream

    d = tempfile.mkdtemp(prefix="txrisk-scorestream-")
    _write_daily_files(spark, SF01, f"{d}/in", days_per_file=8)
    enr = stages.enriched_from_dir(spark, SF01)
    run = stages.model_run(spark, enr, maxIter=5)
    q = run_scoring_stream(spark, f"{d}/in", f"{d}/out", run.model, checkpoint=f"{d}/ckpt",
                           available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(f"{d}/out")
    n = got.count()
    assert n > 0
    assert got.select(S.TX_ID).distinct().count() == n  # each row scored once
    want = stages.ML.score(run.model, enr)
    cols = [S.TX_ID, S.VELOCITY_COUNT, "prediction", "fraud_prob"]
    joined = got.select(*cols).join(want.select(*[F.col(c).alias("w_" + c) if c != S.TX_ID else F.col(c)
                                                  for c in cols]), S.TX_ID)
    assert joined.count() == n
    assert joined.where((F.col(S.VELOCITY_COUNT) != F.col("w_" + S.VELOCITY_COUNT))
                        | (F.col("prediction") != F.col("w_prediction"))
                        | (F.col("fraud_prob") != F.col("w_fraud_prob"))).count() == 0
    # only the last hours, whose windows the final watermark has not passed, wait
    assert n >= 0.9 * enr.count()


def test_jobs_restart_without_a_checkpoint_argument(spark):
    """Stopped and started again, with no checkpoint given: no row twice, none lost."""
    from txrisk.streaming import run_scoring_stream, run_velocity_stream

    d = tempfile.mkdtemp(prefix="txrisk-restart-")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    run = stages.model_run(spark, stages.enriched_from_dir(spark, SF01), maxIter=2)
    for k, part in enumerate((F.dayofyear("ts") <= 12, F.dayofyear("ts") > 12)):
        ev.where(part).coalesce(1).write.mode("append").parquet(f"{d}/in")
        for job, out in ((lambda o: run_velocity_stream(spark, f"{d}/in", o, available_now=True), "vel"),
                         (lambda o: run_scoring_stream(spark, f"{d}/in", o, run.model, available_now=True), "scored")):
            job(f"{d}/{out}").awaitTermination(300)
    vel = spark.read.parquet(f"{d}/vel")
    assert vel.groupBy(S.DEST, "hour").count().where("count > 1").count() == 0
    scored = spark.read.parquet(f"{d}/scored")
    assert scored.select(S.TX_ID).distinct().count() == scored.count()
    last = scored.agg(F.max(S.STEP)).first()[0]
    risky = load_transactions(spark, SF001, types=S.RISKY_TYPES)
    assert scored.count() == risky.where(F.col(S.STEP) <= last).count()
    assert vel.where(F.col(S.STEP) <= last).count() == risky.where(F.col(S.STEP) <= last).select(S.DEST, S.STEP).distinct().count()


def test_rows_that_land_after_their_hour_is_final(spark):
    from txrisk.streaming import run_scoring_stream, unscored_rows

    d = tempfile.mkdtemp(prefix="txrisk-late-")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    late = (F.dayofyear("ts") == 3) & (F.col("event_id") % 2 == 0)
    run = stages.model_run(spark, stages.enriched_from_dir(spark, SF01), maxIter=2)
    for part in (~late, late):
        ev.where(part).coalesce(1).write.mode("append").parquet(f"{d}/in")
        run_scoring_stream(spark, f"{d}/in", f"{d}/out", run.model, available_now=True).awaitTermination(300)
    scored = spark.read.parquet(f"{d}/out")
    risky = load_transactions(spark, SF001, types=S.RISKY_TYPES)
    missed = {r[0] for r in risky.join(ev.where(late).select(F.col("event_id").alias(S.TX_ID)), S.TX_ID)
              .select(S.TX_ID).collect()}
    assert missed and {r[0] for r in unscored_rows(spark, f"{d}/in", f"{d}/out").select(S.TX_ID).collect()} == missed
    assert not missed & {r[0] for r in scored.select(S.TX_ID).collect()}
