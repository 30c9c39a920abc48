"""Data profiling as long tables: one row per column, bin, day or category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.functions import clamp, ratio
from vidpulse.operators.order import exact_quantiles
from vidpulse.session import stage

#: Hash buckets of a column's values, and how many of the largest are counted first.
BUCKETS = 4_096
FIRST_BUCKETS = 16
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(row: DataFrame, entries: list[Column]) -> DataFrame:
    """A one-row table to one row per struct."""
    return row.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def value_counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``value_counts`` of several text columns in one pass, as (column, value, rows)."""
    long = df.select(*columns).unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def describe_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    places: int = 4,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the number columns.

    ``extra`` adds further aggregates (name -> expression) to every row.
    """
    names = list(columns or numeric_columns(df))
    narrow = df.select(*names)
    quartiles = exact_quantiles(
        narrow,
        {f"{c}.{q}": (F.col(c), at) for c in names for q, at in QUARTILES.items()},
    )
    row = narrow.agg(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.round(F.avg(c), places).alias("mean"),
                F.round(F.stddev_samp(c), places).alias("std"),
                F.min(c).cast("double").alias("min"),
                *(
                    F.round(F.lit(quartiles[f"{c}.{q}"]).cast("double"), places).alias(q)
                    for q in QUARTILES
                ),
                F.max(c).cast("double").alias("max"),
                *(column.alias(name) for name, column in (extra or {}).items()),
            ).alias(f"d{i}")
            for i, c in enumerate(names)
        )
    )
    return _long(row, [F.col(f"d{i}") for i in range(len(names))])


def _text_pairs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value) of every value that is not null, as text."""
    pairs = (F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names)
    return df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())


def _bucket() -> Column:
    return F.pmod(F.xxhash64("value"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _bucket_sizes(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("column", _bucket()).agg(F.count(F.lit(1)).alias("rows"))


def frequent_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column, top, freq``: the most frequent value of each column; equal frequencies go to the smaller value.

    Exact in three passes. The first counts rows per hash bucket, so a task sends at most
    ``BUCKETS`` rows for a column. The second counts the values of the ``FIRST_BUCKETS``
    largest buckets. A value can't be more frequent than its bucket, so the third counts
    only buckets that hold as many rows as the best value so far: none or few where a value
    stands out, all where no value does. A column without a value has no row.
    """
    pairs = _text_pairs(df, names)
    sizes = stage(_bucket_sizes(pairs), "buckets")
    # A column has at most BUCKETS rows here, whatever the table holds.
    largest = Window.partitionBy("column").orderBy(F.col("rows").desc(), "bucket")
    placed = sizes.withColumn("place", F.row_number().over(largest))

    def best(buckets: DataFrame) -> DataFrame:
        # At most BUCKETS pairs of numbers for a column.
        chosen = pairs.withColumn("bucket", _bucket()).join(F.broadcast(buckets), ["column", "bucket"], "left_semi")
        counted = chosen.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        first = F.min(F.struct((-F.col("n")).alias("below"), F.col("value").alias("top"))).alias("first")
        return counted.groupBy("column").agg(first).select("column", "first.*")

    found = stage(best(placed.filter(F.col("place") <= FIRST_BUCKETS).select("column", "bucket")), "frequent")
    rest = placed.filter(F.col("place") > FIRST_BUCKETS).join(F.broadcast(found), "column")
    rest = rest.filter(F.col("rows") >= -F.col("below")).select("column", "bucket")
    first = F.min(F.struct("below", "top")).alias("first")
    both = found.unionByName(best(rest)).groupBy("column").agg(first)
    return both.select("column", "first.top", (-F.col("first.below")).alias("freq"))


def describe_text(df: DataFrame, columns: Sequence[str] | None = None, exact_unique: bool = True) -> DataFrame:
    """Count, distinct values, the most frequent value and its frequency (see ``frequent_values``).

    Distinct values are counted by fingerprints of 128 bits, 16 bytes for each distinct value
    of a task; without ``exact_unique`` by a sketch of bounded size with some 5 % of error.
    """
    names = list(columns or [c for c in df.columns if c not in numeric_columns(df)])
    held = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count")).alias(f"d{i}") for i, c in enumerate(names)]
    counts = _long(df.agg(*held), [F.col(f"d{i}") for i in range(len(names))])
    pairs = _text_pairs(df, names)
    if exact_unique:
        first, second = fingerprint(["value"])
        distinct = pairs.groupBy("column", first.alias("_a"), second.alias("_b")).agg(F.lit(1).alias("_one"))
        unique = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("unique"))
    else:
        unique = pairs.groupBy("column").agg(F.approx_count_distinct("value").alias("unique"))
    rows = counts.join(unique, "column", "left").join(frequent_values(df, names), "column", "left")
    return rows.select("column", "count", F.coalesce("unique", F.lit(0)).alias("unique"), "top", "freq")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of each column that has nulls."""
    row = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return _long(row, entries).filter(F.col("nulls") > 0)


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row, in which nulls count by their place."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, and their share in percent.

    Rows are told apart by fingerprints of 128 bits, which each task counts before 16
    bytes and a count of each go out. Two different rows share one with a probability of
    about rows ** 2 / 2 ** 129.
    """
    first, second = fingerprint(df.columns)
    distinct = df.groupBy(first.alias("_a"), second.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return distinct.agg(
        total.alias("rows"),
        extra.alias("duplicates"),
        F.round(F.coalesce(F.try_divide(extra * 100.0, total), F.lit(0.0)), 2).alias("percent"),
    )


def with_raw_ratio(source: DataFrame) -> DataFrame:
    """Play time over duration of the source log; null for a zero duration."""
    return source.withColumn(
        "watch_ratio_raw", ratio(F.col("play_time_ms").cast("double"), F.col("duration_ms").cast("double"))
    )


def ratio_profile(source: DataFrame, places: int = 6) -> DataFrame:
    """Describe row of the raw ratio with the counts above 1 and of nulls."""
    rated = with_raw_ratio(source).select("watch_ratio_raw")
    value = F.col("watch_ratio_raw")
    counts = {"over_one": F.count_if(value > 1), "null_ratio": F.count_if(value.isNull())}
    return describe_numeric(rated, ["watch_ratio_raw"], places, counts)


def histogram(
    df: DataFrame,
    column: str,
    bins: int = 50,
    *,
    clip_low: float | None = None,
    clip_high: float | None = None,
    clip_q: float | None = None,
) -> DataFrame:
    """Equal-width bins between the smallest and largest value after clipping.

    ``clip_q`` cuts at that quantile. The largest value belongs to the last bin;
    empty bins have no row. Bins count from 1.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    if clip_q is not None:
        clip_high = exact_quantiles(values, {"q": (F.col("v"), clip_q)})["q"]
    low = F.lit(float("-inf") if clip_low is None else float(clip_low))
    high = F.lit(float("inf") if clip_high is None else float(clip_high))
    clipped = values.select(clamp(F.col("v"), low, high).alias("v"))
    ends = clipped.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if ends["lo"] is None or ends["lo"] == ends["hi"]:
        number = F.lit(1)
        lo, width = ends["lo"] or 0.0, 0.0
    else:
        lo, width = ends["lo"], (ends["hi"] - ends["lo"]) / bins
        number = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins))
    return (
        clipped.groupBy(number.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "bin",
            (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_low"),
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_high"),
            "rows",
        )
    )


def interaction_rates(
    df: DataFrame, flags: Sequence[str] = ("is_click", "is_like", "is_forward")
) -> DataFrame:
    """Mean of the flags present, in percent."""
    present = [c for c in flags if c in df.columns]
    row = df.agg(*(F.avg(c).alias(c) for c in present))
    return _long(
        row,
        [F.struct(F.lit(c).alias("flag"), F.round(F.col(c) * 100, 2).alias("percent")) for c in present],
    )


def time_range(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.agg(F.min(column).alias("first_event"), F.max(column).alias("last_event"))


def events_per_day(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.groupBy(F.to_date(column).alias("day")).agg(F.count(F.lit(1)).alias("events")).orderBy("day")


def run_summary(features: DataFrame, predictions: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Row counts of the outputs, total views, and rows by label and decision."""

    rows = F.count(F.lit(1))

    def items(row: DataFrame) -> DataFrame:
        return row.unpivot([], row.columns, "item", "value")

    def by(df: DataFrame, column: str) -> DataFrame:
        return value_counts(df, column).select(
            F.concat(F.lit(f"{column}="), F.col(column)).alias("item"), F.col("rows").alias("value")
        )

    return (
        items(
            features.agg(
                rows.alias("feature_rows"),
                F.coalesce(F.sum("views_count"), F.lit(0)).alias("sum_views_count"),
            )
        )
        .unionByName(items(predictions.agg(rows.alias("prediction_rows"))))
        .unionByName(items(recommendations.agg(rows.alias("cache_rows"))))
        .unionByName(by(predictions, "hot_label"))
        .unionByName(by(recommendations, "cache_decision"))
    )
