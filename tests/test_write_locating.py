"""Which row makes a write fail, found by writing halves."""
import math

import pytest
from pyspark.sql import functions as F

from feedloom.operators.validate import write_locating


def _sink(path, bad):
    """A table that takes no row of ``bad``."""
    def write(df):
        checked = F.when(F.col("k").isin(*bad), F.raise_error(F.concat(F.lit("row "), F.col("k").cast("string"))).cast("long")).otherwise(F.col("k"))
        df.withColumn("k", checked).write.mode("overwrite").parquet(path)
    return write


def test_first_failing_row(spark, tmp_path):
    rows = spark.range(300).select((F.col("id") * 7 % 300).alias("k"), F.lit("v").alias("v")).repartition(5)
    path = str(tmp_path / "t")
    for bad in ([217], [299, 41, 40], [0], [299]):
        found = write_locating(rows, ["k"], _sink(path, bad))
        assert found["position"] == min(bad) and found["row"] == {"k": min(bad), "v": "v"} and f"row {min(bad)}" in found["error"]
        assert found["writes"] <= math.ceil(math.log2(300)) + 2
    assert write_locating(rows, ["k"], _sink(path, [1000])) is None
    assert spark.read.parquet(path).count() == 300


def test_failures_of_no_row(spark):
    rows = spark.range(20).withColumnRenamed("id", "k")
    calls = []

    def gone(df):
        calls.append(df.count())
        if len(calls) == 1:
            raise OSError("the sink is gone")
    with pytest.raises(RuntimeError, match="no single row"):
        write_locating(rows, ["k"], gone)

    def always(df):
        raise OSError("closed")
    with pytest.raises(RuntimeError, match="without rows"):
        write_locating(rows.limit(0), ["k"], always)
