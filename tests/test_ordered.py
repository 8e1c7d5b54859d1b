"""Ranged windows equal plain windows, however narrow the ranges are."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from codeweft.operators.counts import same_rows
from codeweft.operators.digest import table_digest
from codeweft.operators.keyed import first_per_key, latest_per_key
from codeweft.operators.ordered import carry_forward, next_value, ordinal, ordinal_by_size


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for key, count in (("hot", 300), ("small", 5), ("one", 1)):
        for at in rng.sample(range(-50, 1000), count):
            data.append((key, at, rng.choice([None, None, f"v{at}"])))
    return spark.createDataFrame(data, "k string, at int, v string").cache()


def equal(left, right):
    columns = sorted(left.columns)
    assert same_rows(left, right, columns).first().same


@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_ranged_windows(rows, width):
    w = Window.partitionBy("k").orderBy("at")
    equal(
        ordinal(rows, ["k"], "at", "n", width),
        rows.withColumn("n", (F.row_number().over(w) - 1).cast("bigint")),
    )
    equal(next_value(rows, ["k"], "at", "v", "n", width), rows.withColumn("n", F.lead("v").over(w)))
    earlier = w.rangeBetween(Window.unboundedPreceding, -1)
    equal(
        carry_forward(rows, ["k"], "at", F.col("v"), "n", width),
        rows.withColumn("n", F.last("v", ignorenulls=True).over(earlier)),
    )


def test_ordinal_by_text(rows):
    named = rows.withColumn("name", F.sha2(F.col("at").cast("string"), 256))
    w = Window.partitionBy("k").orderBy("name")
    equal(
        ordinal(named, ["k"], "name", "n", cut_by=F.substring("name", 1, 1)),
        named.withColumn("n", (F.row_number().over(w) - 1).cast("bigint")),
    )


def test_first_and_latest(rows):
    got = {r.k: r["at"] for r in latest_per_key(rows, ["k"], "at").collect()}
    low = {r.k: r["at"] for r in first_per_key(rows, ["k"], "at").collect()}
    want = rows.groupBy("k").agg(F.max("at").alias("hi"), F.min("at").alias("lo")).collect()
    assert got == {r.k: r.hi for r in want} and low == {r.k: r.lo for r in want}


def test_digest_sees_every_change_and_no_order(rows):
    def of(df):
        return table_digest(df, ["k", "at", "v"]).first().digest

    base = of(rows)
    assert of(rows.orderBy(F.desc("at")).repartition(5)) == base
    assert of(rows.where("at != (SELECT 1)").limit(0)) != base
    assert of(rows.union(rows.limit(1))) != base
    assert of(rows.withColumn("v", F.coalesce("v", F.lit("")))) != base


@pytest.mark.parametrize("width", [1, 7, 299, 300, 1 << 16])
def test_place_by_size(spark, width):
    rng = random.Random(5)
    counts = (("hot", 300), ("small", 5), ("one", 1), (None, 40))
    data = [(k, p, f"{rng.randrange(1 << 40):010x}") for k, n in counts for p in [rng.randrange(3) for _ in range(n)]]
    rows = spark.createDataFrame(data, "k string, phase int, at string").cache()
    cut = F.concat(F.col("phase").cast("string"), F.substring("at", 1, 1))
    w = Window.partitionBy("k").orderBy("phase", "at")
    got = ordinal_by_size(rows, ["k"], ["phase", "at"], "n", cut, width)
    equal(got, rows.withColumn("n", (F.row_number().over(w) - 1).cast("bigint")))


def test_place_by_size_of_nothing(spark):
    rows = spark.createDataFrame([], "k string, phase int, at string")
    assert ordinal_by_size(rows, ["k"], ["phase", "at"], "n", F.col("at")).count() == 0
