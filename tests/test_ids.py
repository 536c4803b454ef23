"""The bucketed positional index equals a plain row_number."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.operators.ids import positional_index


def test_positional_index_matches_row_number(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None])   # one group holds a third of the rows
        rows.append((g, rnd.choice(["p", "q", None]), i * 3 + rnd.randint(0, 2)))
    df = spark.createDataFrame(rows, "g string, p string, o bigint")
    got = positional_index(df, ["g"], ["p", "o"], "pos", bucket_bits=4)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("p", "o")) - 1)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_positional_index_global_with_base(spark):
    df = spark.range(0, 500).withColumn("o", (F.col("id") * 7) % 1009)
    got = positional_index(df, [], ["o"], "pos", bucket_bits=3, base=1)
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("o")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_positional_index_negative_and_null_order(spark):
    rows = [("g", v) for v in [-70000, -5, -1, 0, 3, 65535, 65536, 200000, None]]
    df = spark.createDataFrame(rows, "g string, o bigint")
    got = {r.o: r.pos for r in positional_index(df, ["g"], ["o"], "pos", bucket_bits=4).collect()}
    # Spark sorts NULL first in ascending order; buckets keep that order.
    assert got == {None: 0, -70000: 1, -5: 2, -1: 3, 0: 4, 3: 5, 65535: 6, 65536: 7, 200000: 8}


def test_global_index_of_any_types(spark):
    from feedloom.operators.ids import global_index

    rows = [(None if i % 11 == 0 else f"f{i % 5}", ["a", str(i)], i) for i in range(300)]
    df = spark.createDataFrame(rows, "f string, p array<string>, i int").repartition(7)
    got = [r.pos for r in global_index(df, ["f", "p", "i"], "pos", base=1).orderBy(F.col("f").asc_nulls_first(), "p", "i").collect()]
    assert got == list(range(1, 301))
    assert global_index(df.limit(0), ["f", "i"], "pos").count() == 0


def test_clean_scratch(spark, monkeypatch):
    import pytest

    from feedloom import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    df = session.stage_table(spark.range(3), "probe")
    assert df.count() == 3
    path = session._SCRATCH[0]
    assert session.clean_scratch(spark) == 1 and session._SCRATCH == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
