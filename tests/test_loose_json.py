"""Lenient JSON reading: what fits is read, the rest is NULL field by field."""

from pyspark.sql import functions as F

from stategrid.functions.values import read_loose_json


def test_fields_that_fit(spark):
    rows = ['{"a": 24, "n": 5}', '{"a": true, "n": "x"}', '{"a": [1,2], "more": {"n": 1}}',
            '{"a": {"k":1}, "n": null}', '{"a": "text"}', "{}", "[1]", "7", "no json", "", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    got = [r.r for r in df.select("i", read_loose_json(F.col("c"), "a string, n long").alias("r"))
           .orderBy("i").collect()]
    assert [r and tuple(r) for r in got] == [
        ("24", 5), ("true", None), ("[1,2]", None), ('{"k":1}', None), ("text", None), (None, None),
        None, None, None, None, None]
