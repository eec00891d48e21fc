import pytest
from conftest import rows

from papyrine.operators import deliveries
from papyrine.session import spread


@pytest.mark.parametrize("most", [100, 1])
def test_once(spark, monkeypatch, most):
    monkeypatch.setattr(deliveries, "MAX_REPEATED", most)
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "b", 1), (3, None, 1), (3, None, 5), (None, "x", 1)], "id long, t string, loaded int")
    assert rows(deliveries.once(df, "id", "t")) == [(1, "a"), (2, "b"), (3, None)]
    assert rows(deliveries.once(df.where("id = 2"), "id", "t")) == [(2, "b")] and rows(deliveries.once(df.where("false"), "id", "t")) == []
    assert rows(deliveries.once(df, "t", "id")) == [("a", 1), ("b", 2), ("x", None)]
    assert rows(deliveries.distinct_rows(df.select("id", "t"))) == sorted([(1, "a"), (2, "b"), (3, None), (None, "x")], key=repr)


def test_spread(spark):
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, 64)
    assert spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(many, "id").rdd.getNumPartitions() == 64
    assert spread(few, "id").count() == 100
