"""Float-text grammar: the edge list of a strict float parser."""

import pytest

from stategrid.functions.values import float_value

CASES = [
    ("1", 1.0), ("-1", -1.0), ("+3", 3.0), (".5", 0.5), ("5.", 5.0), ("1e5", 1e5),
    ("1E-2", 0.01), ("1_000", 1000.0), ("1_000.5", 1000.5), ("0x1p-2", 0.25),
    ("0x_1p0", 1.0), ("1e-400", 0.0),
    ("inf", float("inf")), ("+Inf", float("inf")), ("-Infinity", float("-inf")),
    ("NaN", "nan"), ("nan", "nan"),
    (" 1 ", None), ("1 ", None), ("1\n", None), ("1d", None), ("1.5f", None), ("0x10", None),
    ("1e400", None), ("-nan", None), ("_1", None), ("1_", None), ("1__0", None), ("", None),
    ("abc", None), ("1e", None), (".", None), ("e5", None),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_float_grammar(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(float_value("t")).first()[0]
    if expected == "nan":
        assert got != got
    else:
        assert got == expected
