"""Ranks, quantiles, running sums and first-n rows against plain computations."""

import datetime
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vidpulse.operators import order
from vidpulse.operators.order import (
    approx_quantile,
    exact_quantiles,
    kth_smallest,
    kth_values,
    take_smallest,
    with_global_rank,
    with_running_sums,
)

numbers = st.lists(
    st.one_of(
        st.floats(-1e6, 1e6, allow_nan=False), st.sampled_from([0.0, 1.0, 1.0 + 2**-52, -1.7e308, 1.7e308, 5e-324])
    ),
    min_size=1,
    max_size=60,
)
few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@few
@given(numbers, st.data())
def test_kth_smallest_by_narrowing(spark, values, data):
    k = data.draw(st.integers(0, len(values) - 1))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert kth_smallest(df, "v", k, finish_rows=2, bins=4) == sorted(values)[k]


@few
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=60), st.data())
def test_kth_smallest_of_large_integers(spark, values, data):
    k = data.draw(st.integers(0, len(values) - 1))
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert kth_smallest(df, "v", k, finish_rows=0, bins=8) == sorted(values)[k]


@few
@given(numbers, st.data())
def test_many_ranks_at_once(spark, values, data):
    other = [-v / 3 for v in values]
    ranks = data.draw(st.lists(st.integers(0, len(values) - 1), min_size=1, max_size=6))
    df = spark.createDataFrame(list(zip(values, other)), "a double, b double")
    wanted = [(c, k) for c in "ab" for k in ranks]
    expected = [sorted(values if c == "a" else other)[k] for c, k in wanted]
    assert kth_values(df, wanted, finish_rows=3, bins=16) == expected


def test_kth_smallest_refuses_a_rank_outside(spark):
    with pytest.raises(ValueError):
        kth_smallest(spark.range(3), "id", 3)


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = random.Random(1)
    values = [rng.choice([0.25, rng.random()]) for _ in range(700)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "v double, g int")
    wanted = {f"q{q}": (F.col("v"), q) for q in (0.0, 0.5, 0.95, 0.99, 1.0)}
    wanted["third"] = (F.when(F.col("g") == 1, F.col("v")), 0.9)
    wanted["none"] = (F.when(F.col("g") == 7, F.col("v")), 0.9)
    found = exact_quantiles(df, wanted)
    for q in (0.0, 0.5, 0.95, 0.99, 1.0):
        assert found[f"q{q}"] == pytest.approx(np.quantile(values, q), abs=1e-15)
    assert found["third"] == pytest.approx(np.quantile(values[1::3], 0.9), abs=1e-15)
    assert found["none"] is None


def test_approx_quantile_is_an_existing_value_near_the_rank(spark):
    cut = approx_quantile(spark.range(100_000).select(F.col("id").cast("double").alias("v")), "v", 0.99)
    assert cut == int(cut) and abs(cut - 99_000) <= 200
    assert approx_quantile(spark.range(0).select(F.col("id").cast("double").alias("v")), "v", 0.99) is None


@pytest.mark.parametrize("partitions", [1, 7])
def test_global_rank_equals_row_number(spark, partitions):
    # Half of the rows share one score, so ties must be split by the other keys.
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 2 == 0, 0.5).otherwise((F.col("id") % 97) / 97.0).alias("score")
    )
    order = [F.col("score").desc(), F.col("id")]
    ranked = with_global_rank(df, order, "rank", partitions)
    expected = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert ranked.exceptAll(expected).count() == 0 and expected.exceptAll(ranked).count() == 0


def test_global_rank_of_nothing(spark):
    assert with_global_rank(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("block_rows", [1, 37, 10_000])
def test_running_sums_do_not_depend_on_blocks(spark, block_rows):
    df = spark.range(1, 501).select(F.col("id").alias("pos"), (F.col("id") % 11).alias("v"))
    rows = with_running_sums(df, "pos", {"s": F.col("v")}, block_rows).orderBy("pos").collect()
    assert [r["s"] for r in rows] == list(np.cumsum([r["v"] for r in rows]))


def test_running_sums_of_nothing(spark):
    empty = spark.range(0).select(F.col("id").alias("pos"), F.col("id").alias("v"))
    assert with_running_sums(empty, "pos", {"s": F.col("v")}).count() == 0


@pytest.mark.parametrize("n", [0, 1, 40, 150, 205, 260, 300, 999])
def test_take_smallest_with_ties_and_nulls(spark, n):
    rows = [(None if i % 6 == 5 else i % 3, i * 7919 % 300) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b bigint")
    got = take_smallest(df, n, ["a", "b"])
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:n]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_take_smallest_by_time(spark, kind):
    start = F.lit("2024-01-01 00:00:00").cast(kind)
    df = spark.range(500).select(
        "id", (start + F.make_dt_interval(secs=F.pmod(F.col("id") * 37, F.lit(100)))).alias("t")
    )
    got = take_smallest(df, 123, ["t", "id"])
    expected = sorted(((i * 37 % 100, i) for i in range(500)))[:123]
    base = datetime.datetime(2024, 1, 1)
    assert sorted(((r["t"] - base).seconds, r["id"]) for r in got.collect()) == expected


@pytest.mark.parametrize("n", [1_000, 300_000])
def test_nan_and_infinite_values_are_ordinary(spark, n):
    value = F.when(F.col("id") % 10 == 0, float("nan")).when(F.col("id") % 10 == 1, float("-inf"))
    value = value.when(F.col("id") % 10 == 2, float("inf")).otherwise(F.col("id") % 7)
    df = spark.range(n).select(value.alias("v"), F.lit(None).cast("double").alias("none"))
    found = exact_quantiles(df, {q: (F.col("v"), float(q)) for q in ("0", "0.05", "0.5", "0.85", "0.95", "1")})
    assert found["0"] == found["0.05"] == float("-inf") and found["0.85"] == float("inf")
    middle = [float("-inf")] * (n // 10) + sorted(i % 7 for i in range(n) if i % 10 > 2) + [float("inf")] * (n // 10)
    low, high = middle[int(0.5 * (n - 1))], middle[int(0.5 * (n - 1)) + 1]
    assert found["0.5"] == (low + high) / 2 and np.isnan(found["0.95"]) and np.isnan(found["1"])


def test_first_rows_are_sorted_at_every_size(spark):
    df = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(500))).alias("a"), "id").repartition(7)
    for n in (0, 5, 1500, 3000, 9999):
        rows = [tuple(r) for r in take_smallest(df, n, ["a", "id"]).collect()]
        assert rows == sorted(tuple(r) for r in df.collect())[:n]
    text = df.select(F.col("a").cast("string").alias("a"), "id")
    rows = [tuple(r) for r in take_smallest(text, 40, ["a"]).collect()]
    assert rows == sorted(tuple(r) for r in text.collect())[:40]


@pytest.mark.parametrize("n", [1, 5, 11, 20, 27, 30, 99])
def test_best_rows_of_any_number(spark, monkeypatch, n):
    values = [None, None, float("nan"), float("nan"), float("inf"), float("-inf"), 2.0] + [float(i % 4) for i in range(20)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int")
    expected = df.orderBy(F.col("v").desc_nulls_last(), "i").limit(n).collect()
    monkeypatch.setattr(order, "REPORT_ROWS", 4)
    found = order.take_best(df, n, "v", ["i"])
    assert list(map(str, found.collect())) == list(map(str, expected))
