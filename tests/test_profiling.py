from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidpulse.operators import profiling


def test_describe_matches_numpy(spark):
    values = [float(v * v % 101) for v in range(200)]
    df = spark.createDataFrame([(v, str(v)) for v in values] + [(None, None)], "v double, s string")
    row = profiling.describe_numeric(df).first()
    assert row["column"] == "v" and row["count"] == 200
    assert row["mean"] == pytest.approx(np.mean(values), abs=1e-4)
    assert row["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-4)
    assert [row["min"], row["q25"], row["q50"], row["q75"], row["max"]] == pytest.approx(
        list(np.quantile(values, [0, 0.25, 0.5, 0.75, 1])), abs=1e-4
    )


def test_describe_text(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "x string, y string")
    rows = {r["column"]: r for r in profiling.describe_text(df).collect()}
    assert (rows["x"]["count"], rows["x"]["unique"], rows["x"]["top"], rows["x"]["freq"]) == (4, 2, "a", 2)
    assert (rows["y"]["count"], rows["y"]["unique"], rows["y"]["top"]) == (0, 0, None)


def plain_text_profile(column, values):
    held = [v for v in values if v is not None]
    counts = Counter(held)
    top = min(counts, key=lambda v: (-counts[v], v), default=None)
    return {"column": column, "count": len(held), "unique": len(counts), "top": top, "freq": counts.get(top)}


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_describe_text_against_plain_counts(spark, monkeypatch, buckets):
    monkeypatch.setattr(profiling, "BUCKETS", buckets)
    monkeypatch.setattr(profiling, "FIRST_BUCKETS", 2)
    rng = np.random.default_rng(5)
    columns = {
        "keys": [f"k{i}" for i in range(3000)],
        "pairs": [f"p{i // 2}" for i in range(3000)],
        "heavy": ["x" if rng.random() < 0.4 else f"v{i}" for i in range(3000)],
        "tied": [f"t{i % 5}" for i in range(3000)],
        "odd": [None if i % 3 else ("" if i % 2 else "ü") for i in range(3000)],
        "none": [None] * 3000,
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    found = {r["column"]: r.asDict() for r in profiling.describe_text(df).collect()}
    assert found == {c: plain_text_profile(c, v) for c, v in columns.items()}
    near = {r["column"]: r.asDict() for r in profiling.describe_text(df, exact_unique=False).collect()}
    for name, row in near.items():
        exact = found[name]
        assert abs(row.pop("unique") - exact["unique"]) <= 0.1 * exact["unique"]
        assert row == {k: v for k, v in exact.items() if k != "unique"}


def test_a_frequent_value_spares_the_others_the_count(spark):
    values = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, "x").otherwise(F.col("id").cast("string")).alias("v"))
    sizes = profiling._bucket_sizes(profiling._text_pairs(values, ["v"])).collect()
    assert len(sizes) <= profiling.BUCKETS
    assert [r["rows"] for r in sizes if r["rows"] >= 5000] == [max(r["rows"] for r in sizes)]


def test_describe_text_of_no_rows(spark):
    df = spark.createDataFrame([], "a string, b string")
    for exact in (True, False):
        found = {r["column"]: r.asDict() for r in profiling.describe_text(df, exact_unique=exact).collect()}
        assert found == {c: {"column": c, "count": 0, "unique": 0, "top": None, "freq": None} for c in "ab"}


def test_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "x")], "a int, b string")
    assert {r["column"]: r["nulls"] for r in profiling.null_profile(df).collect()} == {"a": 1, "b": 2}
    assert profiling.null_profile(df.dropna()).count() == 0
    row = profiling.duplicate_profile(df).first()
    assert (row["rows"], row["duplicates"], row["percent"]) == (4, 1, 25.0)
    empty = profiling.duplicate_profile(df.filter("false")).first()
    assert (empty["rows"], empty["duplicates"], empty["percent"]) == (0, 0, 0.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 9, 10)], "v double")
    rows = {r["bin"]: r["rows"] for r in profiling.histogram(df, "v", 5).collect()}
    assert rows == {1: 2, 2: 2, 5: 2}  # 10 is in the last bin
    clipped = {r["bin"]: r["rows"] for r in profiling.histogram(df, "v", 2, clip_low=1, clip_high=3).collect()}
    assert clipped == {1: 2, 2: 4}
    flat = profiling.histogram(df.withColumn("v", F.lit(4.0)), "v", 5).collect()
    assert [(r["bin"], r["rows"]) for r in flat] == [(1, 6)]
    assert profiling.histogram(df.filter("false"), "v", 5).count() == 0


def test_rates_range_days_and_shape(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 1)], "is_click int, is_like int")
    assert {r["flag"]: r["percent"] for r in profiling.interaction_rates(df).collect()} == {
        "is_click": 66.67, "is_like": 33.33,
    }
    counts = profiling.table_counts({"a": df, "b": df.limit(1)}).collect()
    assert [(r["table_name"], r["rows"], r["columns"]) for r in counts] == [("a", 3, 2), ("b", 1, 2)]


def test_ratio_profile(spark):
    df = spark.createDataFrame([(5, 10), (30, 10), (7, 0), (0, 4)], "play_time_ms bigint, duration_ms bigint")
    row = profiling.ratio_profile(df).first()
    assert (row["count"], row["over_one"], row["null_ratio"], row["max"]) == (3, 1, 1, 3.0)


def test_fingerprints_tell_nulls_and_places_apart(spark):
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), (None, None, None), (None, None, None), ("", None, 1.0), ("a", "a", 0.0), ("a", "a", -0.0)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    found = profiling.duplicate_profile(df).first()
    assert (found["rows"], found["duplicates"]) == (8, 3)
    plan = profiling.duplicate_profile(df)._jdf.queryExecution().executedPlan().toString()
    exchange = next(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    assert exchange.count("_groupingexpression") == 2 and "x#" not in exchange
