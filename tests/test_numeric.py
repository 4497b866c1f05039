from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txrisk.functions.numeric import half_up_ratio, money_from_cents, sample_stddev_cents


def test_half_up_tie(spark):
    df = spark.createDataFrame([(1005, 1000), (-1005, 1000), (1, 0), (5, None)], "p long, q long")
    got = [r[0] for r in df.select(half_up_ratio("p", "q", 2)).collect()]
    assert got == [1.01, -1.01, None, None]


def test_half_up_decimal_input(spark):
    df = spark.sql("SELECT CAST(10.05 AS DECIMAL(18,2)) AS s, 2L AS n")
    assert df.select(half_up_ratio("s", "n", 2, num_scale=2)).first()[0] == 5.03


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=20),
       st.integers(0, 4))
def test_half_up_matches_python_decimal(spark, pairs, digits):
    df = spark.createDataFrame(pairs, "p long, q long")
    got = [r[0] for r in df.select(half_up_ratio("p", "q", digits)).collect()]
    q = Decimal(1).scaleb(-digits)
    want = [float((Decimal(p) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP))
            if abs(Decimal(p) / Decimal(d)) < 10**20 else None for p, d in pairs]
    # Decimal division above is at 28 significant digits: enough for these ranges.
    assert got == want


def test_stddev_single_row_is_null(spark):
    df = spark.createDataFrame([(1, 100, 10000)], "n long, s1 long, s2 long")
    assert df.select(sample_stddev_cents("n", "s1", "s2")).first()[0] is None


def test_stddev_matches_definition(spark):
    vals = [125, 250, 1000, 7]  # cents
    n, s1, s2 = len(vals), sum(vals), sum(v * v for v in vals)
    df = spark.createDataFrame([(n, s1, s2)], "n long, s1 long, s2 long")
    got = df.select(sample_stddev_cents("n", "s1", "s2")).first()[0]
    mean = s1 / n
    sd = (sum((v - mean) ** 2 for v in vals) / (n - 1)) ** 0.5
    assert abs(got - round(sd) / 100) < 1e-12


def test_money_from_cents(spark):
    df = spark.createDataFrame([(12345,), (-1,)], "c long")
    got = [r[0] for r in df.select(money_from_cents("c")).collect()]
    assert got == [Decimal("123.45"), Decimal("-0.01")]
    assert df.select(money_from_cents(F.col("c"))).schema[0].dataType.simpleString() == "decimal(18,2)"
