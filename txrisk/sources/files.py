"""File scans and sinks (CSV, partitioned Parquet, flat Parquet, models).

Reads declare their schema so no inference pass is run; ``infer=True`` keeps
the header-and-inference behaviour for ad-hoc files.  Partitioned reads keep
``type`` as a directory column so ``type IN (...)`` filters prune folders.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from txrisk import schema as S


def read_csv(spark: SparkSession, path: str, schema: StructType | None = S.RAW_CSV_SCHEMA,
             infer: bool = False, on_bad_row: str = "fail") -> DataFrame:
    """CSV with a header line.  By default the declared raw schema is used;
    ``infer=True`` (or ``schema=None``) runs Spark's type inference instead.

    ``on_bad_row``, for rows with a field that isn't of its declared type or
    has more decimals than it: ``"fail"`` stops the read, ``"null"`` makes the
    field NULL (too many decimals are rounded), ``"keep"`` does that too and
    adds the column ``bad_row`` with the raw line, so such rows can be counted."""
    reader = spark.read.option("header", "true")
    if schema is not None and not infer:
        return _declared_csv(reader, path, schema, on_bad_row)
    return reader.option("inferSchema", "true").csv(path)


BAD_ROW = "bad_row"


def _declared_csv(reader, path: str, schema: StructType, on_bad_row: str) -> DataFrame:
    """Fields are read as text and cast, as the CSV reader itself rounds
    decimals without a word.  The header names are checked against the schema
    instead of silently mapping columns by position."""
    if on_bad_row not in ("fail", "null", "keep"):
        raise ValueError(f"on_bad_row: {on_bad_row}")
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = reader.schema(text).option("enforceSchema", "false").csv(path)
    bad = F.lit(False)
    cols = []
    for f in schema.fields:
        field = F.trim(F.col(f.name))
        value = field.try_cast(f.dataType)
        wrong = field.isNotNull() & value.isNull()
        if isinstance(f.dataType, DecimalType):
            exact = field.try_cast(DecimalType(38, 18))
            wrong = wrong | (exact != value)
        bad = bad | F.coalesce(wrong, F.lit(False))
        if isinstance(f.dataType, StringType):
            value = F.col(f.name)
        if on_bad_row == "fail":
            said = F.concat(F.lit(f"malformed {f.name}: "), field)
            value = F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(said).cast(f.dataType)).otherwise(value)
        cols.append(value.alias(f.name))
    if on_bad_row == "keep":
        cols.append(F.when(bad, F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields]))
                    .alias(BAD_ROW))
    return raw.select(*cols)


def with_tx_id(df: DataFrame) -> DataFrame:
    """Add a unique ``tx_id`` to a raw table that has none (raw CSV).

    ``monotonically_increasing_id`` depends on the input split layout, so the
    ids are stable for a given file set; they only need to be unique."""
    if S.TX_ID in df.columns:
        return df
    return df.select(F.monotonically_increasing_id().alias(S.TX_ID), *df.columns)


def read_tx(spark: SparkSession, path: str) -> DataFrame:
    """Transactions written by :func:`write_tx` (hive-partitioned by ``type``).

    The partition column comes back last; callers select by name."""
    return spark.read.option("basePath", path).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A flat Parquet table (enriched transactions, predictions, features)."""
    return spark.read.parquet(path)


def write_tx(df: DataFrame, path: str, by: str = S.TYPE, mode: str = "overwrite",
             max_records_per_file: int | None = None) -> None:
    """Partitioned Parquet, one folder per value of ``by``.

    Rows are rebalanced by ``by`` first: AQE gathers the small pieces of a value
    and splits those of a large one over several tasks by size, so there are
    few files per value (not one per task and value) and no value is funnelled
    through one task.  ``max_records_per_file`` caps file size."""
    w = df.hint("rebalance", by).write.mode(mode).partitionBy(by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


PREDICTION_COLUMNS = (S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL, S.RULE, "prediction", "probability", "margin")


def write_predictions(predictions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The scored test split, projected to the columns downstream reports use."""
    cols = [c for c in PREDICTION_COLUMNS if c in predictions.columns]
    predictions.select(*cols).write.mode(mode).parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
