"""The split paths for hot keys give the rows of the plain ones."""

from types import SimpleNamespace

import pytest
from conftest import rows
from cohortloom.operators import scale
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    """1,200 rows, a third of them of key 0; position is unique per key, with tied starts."""
    return spark.range(1200).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        F.floor(F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("a"),
        F.col("id").alias("b"),
        (F.col("id") % 5).alias("v"),
    )


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_total_in_buckets(skewed, keys):
    split = scale.running_total(skewed, F.col("v"), "t", keys, ["a", "b"], rows_per_task=10)
    data = sorted(tuple(r) for r in skewed.select("k", "a", "b", "v").collect())
    sums, expected = {}, []
    for k, a, b, v in sorted(data, key=lambda r: (r[1], r[2])):
        group = k if keys else None
        expected.append((k, a, b, v, sums.get(group, 0)))
        sums[group] = sums.get(group, 0) + v
    assert rows(split.select("k", "a", "b", "v", "t")) == sorted(expected, key=repr)


def test_running_total_plain_equals_buckets(skewed):
    plain = scale.running_total(skewed, F.lit(1), "t", ["k"], ["a", "b"])
    split = scale.running_total(skewed, F.lit(1), "t", ["k"], ["a", "b"], rows_per_task=7)
    assert rows(plain) == rows(split.select(*plain.columns))


def test_running_total_one_value(spark):
    same = spark.range(40).select(F.lit(1.0).alias("a"), "id")
    out = scale.running_total(same, F.lit(1), "t", order=["a", "id"], rows_per_task=3)
    assert [r.t for r in out.orderBy("id").collect()] == list(range(40))


def test_running_total_of_hot_keys_in_separate_ranges(spark, monkeypatch):
    """Every key lies in a range of its own; no (key, bucket) is much larger than asked."""
    apart = spark.range(4000).select(
        F.floor(F.col("id") / 400).alias("k"), F.floor(F.col("id") / 2).alias("a"), F.col("id").alias("b")
    )
    bounds = []
    plain = scale.order_bounds
    monkeypatch.setattr(scale, "order_bounds", lambda *a: bounds.append(plain(*a)) or bounds[-1])
    split = scale.running_total(apart, F.lit(1), "t", ["k"], ["a", "b"], rows_per_task=100)
    assert [r.t for r in split.orderBy("b").collect()] == [i % 400 for i in range(4000)]
    edges = bounds[0][1:-1]
    placed = apart.groupBy("k", sum((F.col("a") >= e).cast("int") for e in edges)).count()
    assert placed.agg(F.max("count")).head()[0] <= 200


def test_running_total_of_nothing(spark):
    empty = spark.range(0).select(F.col("id").alias("a"))
    assert scale.running_total(empty, F.lit(1), "t", order=["a"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join_paths_agree(spark, skewed, how):
    big = skewed.unionByName(
        skewed.limit(5).withColumn("k", F.lit(None).cast("long"))
    )
    small = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("s"))
    plain = big.join(small, ["k"], how)
    hot = scale.skew_join(big, small, ["k"], how, hot_rows=20, broadcast_rows=0)
    sent = scale.skew_join(big, small, ["k"], how)
    cold = scale.skew_join(big, small, ["k"], how, broadcast_rows=0)
    expected = rows(plain)
    for joined in (hot, sent, cold):
        assert rows(joined.select(*plain.columns)) == expected
    assert "xxhash64" in hot._jdf.queryExecution().toString()


def session(setting, master):
    context = SimpleNamespace(
        master=master, applicationId="app-x", getCheckpointDir=lambda: None
    )
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: setting or default), sparkContext=context
    )


def test_scratch_is_shared():
    path = scale.scratch_path(session("hdfs://shared/x/", "yarn"), "t")
    assert path.startswith("hdfs://shared/x/t-")
    assert scale.scratch_path(session(None, "local[2]"), "t").startswith("/")
    with pytest.raises(RuntimeError):
        scale.scratch_path(session(None, "spark://host:7077"), "t")


def test_written_table_has_no_lineage(spark):
    table = scale.written_table(spark.range(100).where("id > 94"), "five")
    assert sorted(r.id for r in table.collect()) == [95, 96, 97, 98, 99]
    assert "Range" not in table._jdf.queryExecution().toString()


def test_spread_leaves_large_scans_alone(spark):
    wide = spark.range(0, 100, 1, 50)
    assert scale.spread(wide) is wide
    assert scale.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 8
