import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txrisk.session import local_session
    s = local_session("*", shuffle_partitions=8, app="txrisk-tests")
    yield s
    s.stop()


def tx_frame(spark, rows):
    """Transactions from tuples in schema order (tx_id first); money as str."""
    from decimal import Decimal

    from txrisk import schema as S
    money = set(S.MONEY_COLUMNS)
    conv = []
    for r in rows:
        conv.append(tuple(Decimal(v) if (S.TX_COLUMNS[i] in money and v is not None) else v
                          for i, v in enumerate(r)))
    return spark.createDataFrame(conv, S.TX_SCHEMA)


def tx_row(tx_id, step, dest="M1", amount="10.00", type_="TRANSFER", fraud=0, flagged=0,
           orig=None, old_orig="100.00", new_orig="90.00", old_dest="0.00", new_dest="10.00"):
    return (tx_id, step, type_, amount, orig or f"C{tx_id}", old_orig, new_orig, dest,
            old_dest, new_dest, fraud, flagged)


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
