"""A destination holding a third of all rows: the velocity plan stays exact,
the window never sees the hot key's raw rows, and AQE splits the hot
partition of the join back."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_text
from txrisk import schema as S
from txrisk.operators.velocity import with_velocity

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed(spark, n=30000):
    # every third row goes to destination HOT, in only three steps
    return spark.range(n).select(
        F.col("id").alias(S.TX_ID),
        F.when(F.col("id") % 3 == 0, (F.col("id") % 3 + 1)).otherwise(F.col("id") % 700 + 1)
         .cast("int").alias(S.STEP),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .otherwise(F.concat(F.lit("M"), (F.col("id") % 97).cast("string"))).alias(S.DEST),
        (F.col("id") % 1000).cast("decimal(18,2)").alias(S.AMOUNT),
    )


def test_hot_destination(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = _skewed(spark)
        out = with_velocity(df)
        w = Window.partitionBy(S.DEST).orderBy(S.STEP).rangeBetween(-24, 0)
        direct = df.select(S.TX_ID, F.count(F.lit(1)).over(w).alias("c"), F.sum(S.AMOUNT).over(w).alias("s"))
        j = out.join(direct, S.TX_ID)
        assert j.count() == df.count()
        assert j.where((F.col(S.VELOCITY_COUNT) != F.col("c"))
                       | ~F.col(S.VELOCITY_AMOUNT).eqNullSafe(F.col("s"))).count() == 0
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        final = plan_text(out).split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final
        assert "skew=true" in final or "isSkewJoin=true" in final
        # the window input is the per-(destination, step) table, not the rows
        assert "HashAggregate" in final and final.index("Window") < final.rindex("HashAggregate")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
