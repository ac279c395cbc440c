import pytest
from pyspark.sql import functions as F
from shopperflow.plans.hot_keys import SHARE, hot_keys, measured_hot_keys, unique_join

from .conftest import rows


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of all rows have one key, some have none."""
    ids = spark.range(9000)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 2000)
    return ids.select("id", key.cast("long").alias("k")), spark.range(0, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_as_a_plain_join(lopsided, how):
    facts, names = lopsided
    found = unique_join(facts, names, ["k"], measured_hot_keys(facts, "k"), how)
    plain = facts.join(names, ["k"], how)
    assert found.columns == plain.columns
    assert sorted(rows(found), key=str) == sorted(rows(plain), key=str)


def test_hot_keys_are_few(lopsided):
    facts, _ = lopsided
    assert rows(measured_hot_keys(facts, "k")) == [(7,)]
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    assert hot_keys(counts, "n", 9000, 100_000).count() < 100_000
    assert hot_keys(counts, "n", 9000).count() < SHARE


def test_no_task_of_the_shuffle_gets_the_hot_key(lopsided, spark):
    facts, names = lopsided
    spread = facts.join(F.broadcast(measured_hot_keys(facts, "k")), "k", "left_anti")
    sizes = [r["count"] for r in spread.repartition(16, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.15 * facts.count()
    found = unique_join(facts, names, ["k"], measured_hot_keys(facts, "k"))
    assert "BroadcastHashJoin" in found._jdf.queryExecution().toString()


def test_other_joins_are_refused(lopsided):
    facts, names = lopsided
    with pytest.raises(ValueError, match="outer"):
        unique_join(facts, names, ["k"], names, "outer")
