"""MLlib model stages.

The estimator work is MLlib's (distributed tree learning); this module
prepares the inputs, fits, scores and turns the results into DataFrames.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.vectors import positive_probability

# The model's feature sets and GBT settings.
FULL_FEATURES = [
    "type_idx",
    "amount",
    "oldbalanceOrg", "newbalanceOrig",
    "oldbalanceDest", "newbalanceDest",
    "orig_balance_diff", "dest_balance_diff",
    "orig_balance_mismatch", "dest_balance_mismatch",
    "dest_tx_last_24h", "dest_amount_last_24h",
]
FEATURE_SETS = {
    "full": FULL_FEATURES,
    "no_balance_diffs": ["type_idx", "amount", "oldbalanceOrg", "newbalanceOrig",
                         "oldbalanceDest", "newbalanceDest",
                         "dest_tx_last_24h", "dest_amount_last_24h"],
    "no_balance_at_all": ["type_idx", "amount",
                          "dest_tx_last_24h", "dest_amount_last_24h"],
}
GBT_PARAMS = {"maxIter": 50, "maxDepth": 5, "seed": 42}
WEIGHT = "class_weight"
TYPE_INDEX = "type_idx"


def class_weight_value(train: DataFrame, label: str = S.LABEL):
    """negatives / positives of ``train`` as a scalar subquery column
    (NULL when there are no positives)."""
    stats = train.agg(F.count_if(F.col(label) == 1).alias("p"),
                      F.count_if(F.col(label) != 1).alias("n"))
    return stats.select(
        F.when(F.col("p") > 0, F.col("n").cast("double") / F.col("p").cast("double"))
    ).scalar()


def with_class_weight(train: DataFrame, label: str = S.LABEL, out: str = WEIGHT) -> DataFrame:
    """Weight positives by negatives/positives of the same split, 1.0 else."""
    w = class_weight_value(train, label)
    return train.withColumn(out, F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))


def model_inputs(df: DataFrame) -> DataFrame:
    """Money and other decimals become DOUBLE at the ML boundary."""
    from txrisk.functions.numeric import decimals_to_double
    return decimals_to_double(df)


def type_indexer(input_col: str = S.TYPE, output_col: str = TYPE_INDEX) -> StringIndexer:
    """Frequency-descending index (ties alphabetical); unseen and NULL map
    to the number of labels."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid="keep")


def build_pipeline(features=FULL_FEATURES, label: str = S.LABEL, weight: str | None = WEIGHT,
                   estimator=None, **gbt_params) -> Pipeline:
    """Indexer -> assembler -> classifier (GBT by default)."""
    params = {**GBT_PARAMS, **gbt_params}
    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid="keep")
    if estimator is None:
        estimator = GBTClassifier(labelCol=label, featuresCol="features", **params)
        if weight:
            estimator.setWeightCol(weight)
    return Pipeline(stages=[type_indexer(), assembler, estimator])


#: Rows of a partition of the train table, and its least number of partitions.  The
#: learner samples rows per partition for its split points, so a model depends on
#: the layout: that follows from the rows and these numbers, never from the cluster.
TRAIN_ROWS_PER_PARTITION, LEAST_TRAIN_PARTITIONS = 200_000, 8


def train_partitions(rows: int) -> int:
    return max(LEAST_TRAIN_PARTITIONS, -(-rows // TRAIN_ROWS_PER_PARTITION))


def prepare_train(train: DataFrame, label: str = S.LABEL, key: str = S.TX_ID,
                  partitions: int | None = None) -> DataFrame:
    """Doubles at the ML boundary, written once as a table in the session's
    checkpoint directory (``spark.checkpoint.dir``; a shared folder on a
    cluster), plus the class weight taken from the written table.

    The tree learner makes many passes over it; the written copy cuts the
    lineage so a lost executor re-reads files instead of recomputing the
    window and join that produced the rows.  Rows are dealt by a hash of
    ``key`` to a number of partitions that follows from the row count (or to
    ``partitions``) and sorted within them, so the same rows give the same
    layout, and thereby the same model, on any number of cores."""
    from txrisk.session import materialize

    rows = materialize(model_inputs(train), "train")
    n, positives = rows.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1)).first()
    if not positives:
        raise ValueError("train split has no positive rows; the class weight is undefined")
    weighted = laid_out(with_class_weight(rows, label), key, partitions or train_partitions(n))
    weighted._txrisk_path = rows._txrisk_path
    return weighted


def laid_out(rows: DataFrame, key: str = S.TX_ID, partitions: int | None = None) -> DataFrame:
    """``rows`` (of a written table) dealt by a hash of ``key`` and sorted within
    partitions; by default as :func:`train_partitions` has it."""
    partitions = partitions or train_partitions(rows.count())
    order = [c for c in (key, *sorted(rows.columns)) if c in rows.columns]
    by = [key] if key in rows.columns else sorted(rows.columns)
    return rows.repartition(partitions, *by).sortWithinPartitions(*dict.fromkeys(order))


def fit_prepared(weighted: DataFrame, features=FULL_FEATURES, label: str = S.LABEL,
                 **gbt_params) -> PipelineModel:
    """Fit the pipeline on a split prepared by :func:`prepare_train`."""
    return build_pipeline(features, label, **gbt_params).fit(weighted)


def fit(train: DataFrame, features=FULL_FEATURES, label: str = S.LABEL,
        **gbt_params) -> PipelineModel:
    """Weight the train split and fit the pipeline."""
    return fit_prepared(prepare_train(train, label), features, label, **gbt_params)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Scored rows plus ``fraud_prob`` (class-1 probability)."""
    return model.transform(model_inputs(df)).withColumn("fraud_prob", positive_probability())


def importances(spark: SparkSession, model: PipelineModel, features=FULL_FEATURES) -> DataFrame:
    """Feature importances of the fitted trees, aligned by name, sorted
    descending (ties by name).  One row per feature column."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(list(features), [float(v) for v in values]))
    return (spark.createDataFrame(rows, "feature string, importance double")
                 .orderBy(F.desc("importance"), "feature"))


def type_index(model_or_indexer, df: DataFrame) -> DataFrame:
    """Label -> index of a fitted indexer, with each label's row count in
    ``df`` (the fitted split)."""
    idx = model_or_indexer.stages[0] if isinstance(model_or_indexer, PipelineModel) else model_or_indexer
    return (idx.transform(df.select(S.TYPE))
               .groupBy(S.TYPE, F.col(TYPE_INDEX).cast("int").alias(TYPE_INDEX))
               .agg(F.count(F.lit(1)).alias("count")))


def baseline_estimators(label: str = S.LABEL, weight: str = WEIGHT) -> dict:
    """The estimators compared against each other on the same features and
    weights: the GBT above, logistic regression and a random forest of the
    same depth."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

    common = {"labelCol": label, "featuresCol": "features", "weightCol": weight}
    return {
        "gbt": GBTClassifier(**common, **GBT_PARAMS),
        "logistic_regression": LogisticRegression(**common, maxIter=100),
        "random_forest": RandomForestClassifier(**common, numTrees=GBT_PARAMS["maxIter"],
                                                maxDepth=GBT_PARAMS["maxDepth"],
                                                seed=GBT_PARAMS["seed"]),
    }
