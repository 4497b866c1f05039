"""Column roles and the declared transaction schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the transaction fact table, the five
# transaction types and the two types in which fraud occurs.
TX_ID = "tx_id"
STEP = "step"
TYPE = "type"
AMOUNT = "amount"
ORIG = "nameOrig"
OLD_ORIG = "oldbalanceOrg"
NEW_ORIG = "newbalanceOrig"
DEST = "nameDest"
OLD_DEST = "oldbalanceDest"
NEW_DEST = "newbalanceDest"
LABEL = "isFraud"
RULE = "isFlaggedFraud"

TX_TYPES = ("TRANSFER", "CASH_OUT", "PAYMENT", "DEBIT", "CASH_IN")
RISKY_TYPES = ("TRANSFER", "CASH_OUT")

MONEY = T.DecimalType(18, 2)
MONEY_COLUMNS = (AMOUNT, OLD_ORIG, NEW_ORIG, OLD_DEST, NEW_DEST)

# Column order of the fact table (``tx_id`` is ours; the raw CSV lacks it).
TX_COLUMNS = (TX_ID, STEP, TYPE, AMOUNT, ORIG, OLD_ORIG, NEW_ORIG,
              DEST, OLD_DEST, NEW_DEST, LABEL, RULE)

TX_SCHEMA = T.StructType([
    T.StructField(TX_ID, T.LongType(), True),
    T.StructField(STEP, T.IntegerType(), True),
    T.StructField(TYPE, T.StringType(), True),
    T.StructField(AMOUNT, MONEY, True),
    T.StructField(ORIG, T.StringType(), True),
    T.StructField(OLD_ORIG, MONEY, True),
    T.StructField(NEW_ORIG, MONEY, True),
    T.StructField(DEST, T.StringType(), True),
    T.StructField(OLD_DEST, MONEY, True),
    T.StructField(NEW_DEST, MONEY, True),
    T.StructField(LABEL, T.IntegerType(), True),
    T.StructField(RULE, T.IntegerType(), True),
])

# Raw CSV layout (no tx_id), as the upstream simulator writes it.
RAW_CSV_SCHEMA = T.StructType([f for f in TX_SCHEMA.fields if f.name != TX_ID])

# Columns added by the enrichment stage.
VELOCITY_COUNT = "dest_tx_last_24h"
VELOCITY_AMOUNT = "dest_amount_last_24h"
ORIG_DIFF = "orig_balance_diff"
DEST_DIFF = "dest_balance_diff"
ORIG_MISMATCH = "orig_balance_mismatch"
DEST_MISMATCH = "dest_balance_mismatch"

# The step at which training ends and the window lookback.
SPLIT_STEP = 600
LOOKBACK_STEPS = 24
