"""Keyed permutations: one to one, the same from both sides, and no sort in the plan of an epoch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplelake.functions import permutation
from samplelake.operators import batches


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 1000, 4097])
def test_every_place_is_taken_once(spark, n):
    placed = spark.range(n).select("id", permutation.permuted(F.col("id"), n, 5, 2).alias("at")).collect()
    assert sorted(r["at"] for r in placed) == list(range(n))
    assert all(permutation.index_at(r["at"], n, 5, 2) == r["id"] for r in placed)


def test_orders_differ_and_look_drawn(spark):
    n = 20_000
    orders = []
    for seed, epoch in [(1, 0), (1, 1), (2, 0)]:
        rows = spark.range(n).select("id", permutation.permuted(F.col("id"), n, seed, epoch).alias("at")).orderBy("id").collect()
        orders.append(np.array([r["at"] for r in rows]))
    ids = np.arange(n)
    for k, one in enumerate(orders):
        assert abs(np.corrcoef(ids, one)[0, 1]) < 0.05
        assert abs(np.corrcoef(one[:-1], one[1:])[0, 1]) < 0.05
        assert all((one == other).mean() < 0.01 for other in orders[:k])


def test_large_counts_stay_in_range_and_lead_back():
    for n in (10**11 + 3, 2**61 + 1):
        keys = permutation.network_keys(3, 4)
        values = np.array([0, 1, n // 2, n - 1], dtype=np.int64)
        a, b = permutation.sides(n)
        assert n <= a * b < n + a + 1
        moved = permutation.forward(values, n, keys)
        assert ((moved >= 0) & (moved < a * b)).all()
        assert [permutation.backward(int(m), n, keys) for m in moved] == list(values)


def test_no_number_or_too_many_are_refused():
    for n in (0, -1, 2**62 + 2**40):
        with pytest.raises(ValueError):
            permutation.sides(n)


def test_an_epoch_has_no_sort_and_no_shuffle(spark):
    samples = spark.range(1000).select(F.col("id").alias("idx"))
    planned = batches.epoch_batches(samples, 32, epoch=1, seed=5, total=1000)
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_padding_repeats_the_last_sample(spark):
    samples = spark.range(70).select(F.col("id").alias("idx"))
    rows = batches.epoch_batches(samples, 32, epoch=1, seed=5, pad_last=True).collect()
    last = {r["batch_pos"]: r["idx"] for r in rows if r["batch_id"] == 2}
    assert sorted(last) == list(range(32)) and {last[p] for p in range(5, 32)} == {last[5]}


def test_an_empty_table_has_no_batches(spark):
    assert batches.epoch_batches(spark.range(0).withColumnRenamed("id", "idx"), 32, pad_last=True).count() == 0
