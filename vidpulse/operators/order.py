"""Order-based results over whole tables without a single-task sort.

* ``kth_values`` / ``exact_quantiles`` narrow value ranges by counting rows per
  bin: every pass is one partial aggregation with at most ``BINS`` result rows.
* ``with_global_rank`` numbers rows with one range exchange.
* ``with_running_sums`` is a two-level prefix sum over a dense row number.

All of them read their input several times; give them a written table (see
``session.stage``) when the input is expensive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.session import stage

BINS = 16_384  # bins of one counting pass, shared by the ranges in question
FINISH_ROWS = 10_000  # rows in question that are counted by value in the last pass
RANGE_ROWS = 250_000  # rows of one sorted range of a global rank
MAX_RANGES = 20_000  # ranges of a global rank; their starts enter the plan as one literal
BLOCK_ROWS = 10_000  # consecutive rows of a running sum that are added up together
REPORT_ROWS = 10_000  # first rows that one task merges; of more, only a filter is left
MAX_BLOCKS = 1_000_000  # blocks of a running sum; their totals (about 40 bytes) are broadcast


class Bounds(NamedTuple):
    """What one column holds: non-null rows, the least and greatest finite value, and the rest.

    In order of size: ``low`` rows of minus infinity, the finite ones, ``high`` rows of
    plus infinity, then NaN.
    """

    valid: int
    lo: float | int | None
    hi: float | int | None
    low: int = 0
    high: int = 0
    nan: int = 0


def _bounds(df: DataFrame, names: Sequence[str]) -> dict[str, Bounds]:
    """The bounds of each column, from one aggregation."""
    infinity, parts = float("inf"), []
    for i, n in enumerate(names):
        value = F.col(n)
        parts += [F.count(value).alias(f"valid_{i}")]
        if isinstance(df.schema[n].dataType, T.FractionalType) and not isinstance(df.schema[n].dataType, T.DecimalType):
            parts += [
                F.count_if(value == -infinity).alias(f"low_{i}"),
                F.count_if(value == infinity).alias(f"high_{i}"),
                F.count_if(F.isnan(value)).alias(f"nan_{i}"),
            ]
            value = F.when((value > -infinity) & (value < infinity), value)
        parts += [F.min(value).alias(f"lo_{i}"), F.max(value).alias(f"hi_{i}")]
    row = df.agg(*parts).first().asDict()
    return {n: Bounds(**{k: row[f"{k}_{i}"] for k in Bounds._fields if f"{k}_{i}" in row}) for i, n in enumerate(names)}


def kth_values(
    df: DataFrame,
    wanted: Sequence[tuple[str, int]],
    *,
    bounds: dict[str, Bounds] | None = None,
    bins: int = BINS,
    finish_rows: int = FINISH_ROWS,
    places: list | None = None,
) -> list:
    """For each (column, k) the 0-based ``k``-th smallest non-null value.

    The columns share one number type. Every round counts rows per bin of each
    range still in question, all ranges in one pass, and keeps the bin that holds
    the wanted rank; min and max of its members are the next range. Rounds shrink
    a range by the number of bins, whatever the number of rows is. NaN counts as the
    largest value, and infinite values are ordinary ones; both are counted apart.
    ``places`` receives (rows below the value, rows with it) for each wanted rank.
    """
    names = list(dict.fromkeys(n for n, _ in wanted))
    bounds = bounds or _bounds(df, names)
    ranges: dict[tuple, tuple[int, int, list[int]]] = {}  # (column, lo, hi) -> below, inside, targets
    found: list = [None] * len(wanted)
    places = [] if places is None else places
    places[:] = found
    for i, (name, k) in enumerate(wanted):
        held = bounds[name]
        if not 0 <= k < held.valid:
            raise ValueError(f"rank {k} of {name} outside 0..{held.valid - 1}")
        finite = held.valid - held.low - held.high - held.nan
        if k < held.low:
            found[i], places[i] = -math.inf, (0, held.low)
        elif k < held.low + finite:
            ranges.setdefault((name, held.lo, held.hi), (held.low, finite, []))[2].append(i)
        elif k < held.low + finite + held.high:
            found[i], places[i] = math.inf, (held.low + finite, held.high)
        else:
            found[i], places[i] = math.nan, (held.valid - held.nan, held.nan)
    while True:
        open_ranges = {}
        for (name, lo, hi), state in ranges.items():
            if lo == hi:
                for i in state[2]:
                    found[i], places[i] = lo, state[:2]
            else:
                open_ranges[name, lo, hi] = state
        if not open_ranges:
            return found
        last = sum(inside for _, inside, _ in open_ranges.values()) <= finish_rows
        cells = _count_cells(df, list(open_ranges), max(2, bins // len(open_ranges)), by_value=last)
        ranges = {}
        for number, ((name, _, _), (below, _, targets)) in enumerate(open_ranges.items()):
            waiting = sorted(targets, key=lambda i: wanted[i][1])
            for cell in sorted((c for c in cells if c["t"] == number), key=lambda c: c["lo"]):
                while waiting and below + cell["n"] > wanted[waiting[0]][1]:
                    key = (name, cell["lo"], cell["hi"])
                    ranges.setdefault(key, (below, cell["n"], []))[2].append(waiting.pop(0))
                below += cell["n"]


def _count_cells(df: DataFrame, ranges: list[tuple], bins: int, by_value: bool) -> list:
    """Rows, min and max per range and bin (or per value): at most ranges x bins rows."""

    def cell(name: str, lo, hi) -> Column:
        # The bin number never decreases as the value grows.
        value, span = F.col(name), hi - lo
        if isinstance(lo, int) and span >= 2**63:
            value, lo = value.cast("double"), float(lo)
        elif isinstance(span, float) and math.isinf(span):
            value, lo, span = value / 2, lo / 2, hi / 2 - lo / 2
        share = (value - F.lit(lo)).cast("double") / F.lit(float(span))
        return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")

    if len(ranges) == 1:  # a plain filter, which the scan can use to skip row groups
        ((name, lo, hi),) = ranges
        inside = df.filter(F.col(name).between(lo, hi))
        long = inside.select(F.lit(0).alias("t"), cell(name, lo, hi).alias("bin"), F.col(name).alias("v"))
    else:
        entries = [
            F.when(
                F.col(name).between(lo, hi),
                F.struct(F.lit(t).alias("t"), cell(name, lo, hi).alias("bin"), F.col(name).alias("v")),
            )
            for t, (name, lo, hi) in enumerate(ranges)
        ]
        long = df.select(F.explode(F.array(*entries)).alias("c")).filter(F.col("c").isNotNull()).select("c.*")
    n = F.count(F.lit(1)).alias("n")
    if by_value:
        counted = long.groupBy("t", "v").agg(n)
        return counted.select("t", "n", F.col("v").alias("lo"), F.col("v").alias("hi")).collect()
    return long.groupBy("t", "bin").agg(n, F.min("v").alias("lo"), F.max("v").alias("hi")).collect()


def kth_smallest(df: DataFrame, name: str, k: int, **options):
    """The 0-based ``k``-th smallest non-null value of one column."""
    return kth_values(df, [(name, k)], **options)[0]


def exact_quantiles(
    df: DataFrame,
    wanted: dict[str, tuple[Column, float]],
) -> dict[str, float | None]:
    """Linearly interpolated quantiles, name -> value (null when there are no rows).

    ``wanted`` maps a name to (expression, q); rows whose expression is null do
    not count, so a condition is written as ``F.when(condition, column)``. All ranks
    are narrowed together by counting, at every size.
    """
    expressions: dict[str, Column] = {}
    column_of: dict[str, str] = {}
    for name, (expression, _) in wanted.items():
        column = column_of[name] = f"q_{str(expression)}"
        expressions.setdefault(column, expression)
    plain = {c: f"c{i}" for i, c in enumerate(expressions)}
    values = df.select(*(expressions[c].cast("double").alias(p) for c, p in plain.items()))
    bounds = _bounds(values, list(plain.values()))
    places: dict[str, float] = {}
    ranks: list[tuple[str, int]] = []
    for n, (_, q) in wanted.items():
        column = plain[column_of[n]]
        if bounds[column].valid:
            places[n] = q * (bounds[column].valid - 1)
            ranks += [(column, math.floor(places[n])), (column, math.ceil(places[n]))]
    ranks = list(dict.fromkeys(ranks))
    value_of = dict(zip(ranks, kth_values(values, ranks, bounds=bounds))) if ranks else {}
    found: dict[str, float | None] = {}
    for n in wanted:
        if n not in places:
            found[n] = None
            continue
        column, place = plain[column_of[n]], places[n]
        low, high = value_of[column, math.floor(place)], value_of[column, math.ceil(place)]
        weight = place - math.floor(place)
        found[n] = low if low == high else (1 - weight) * low + weight * high
    return found


def approx_quantile(df: DataFrame, name: str, q: float, relative_error: float = 0.001) -> float | None:
    """Quantile sketch with a relative rank error; an existing value."""
    return df.agg(
        F.percentile_approx(name, F.lit(q), F.lit(round(1 / relative_error))).alias("q")
    ).first()["q"]


def _as_number(df: DataFrame, name: str) -> Column | None:
    """An order-preserving number for a number or time column, else None."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(name))
    return None


def take_smallest(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The ``n`` rows that come first by ``keys`` (ascending, nulls last), in that order.

    A filter below the n-th key, so no task gathers n rows; only rows equal to that
    key go on to the next key, and rows equal in all keys to the other columns. A text
    key ranks the rows that it has to decide.
    """
    return _first(df, n, keys).orderBy(*(F.col(k).asc_nulls_last() for k in keys))


def _first(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    number = _as_number(df, keys[0]) if keys else None
    if number is None:
        order = [*keys, *(c for c in df.columns if c not in keys)]
        ranked = with_global_rank(df, [F.col(c).asc_nulls_last() for c in order], "_place")
        return ranked.filter(F.col("_place") <= n).drop("_place")
    keyed = df.withColumn("_number", number)
    held = _bounds(keyed, ["_number"])["_number"]
    if n >= held.valid:
        nulls = df.filter(number.isNull())
        if held.valid and n == held.valid:
            return df.filter(number.isNotNull())
        return df.filter(number.isNotNull()).unionByName(_first(nulls, n - held.valid, keys[1:]))
    if n <= 0:
        return df.limit(0)
    places: list = []
    cut = F.lit(kth_smallest(keyed, "_number", n - 1, bounds={"_number": held}, places=places))
    below, at = places[0]
    missing = n - below
    if missing == at:
        return df.filter(number <= cut)
    return df.filter(number < cut).unionByName(_first(df.filter(number == cut), missing, keys[1:]))


def take_best(df: DataFrame, n: int, by: str, ties: Sequence[Column | str]) -> DataFrame:
    """The ``n`` rows with the greatest ``by`` (nulls last), best first; equal ones in the order of ``ties``.

    Up to ``REPORT_ROWS`` every task keeps its own n best and one task merges them. For more,
    rows below the n-th best value are filtered out, and only the others are ranked, so
    no task gathers them; ``df`` is written once for that.
    """
    order = [F.col(by).desc_nulls_last(), *ties]
    if n <= REPORT_ROWS:
        return df.orderBy(*order).limit(n)
    rows = stage(df, "best")
    valid = _bounds(rows, [by])[by].valid
    if n < valid:
        rows = rows.filter(F.col(by) >= F.lit(kth_smallest(rows, by, valid - n)))
    return with_global_rank(rows, order, "_place").filter(F.col("_place") <= n).orderBy("_place").drop("_place")


def with_global_rank(
    df: DataFrame, order: Sequence[Column | str], name: str = "rank", partitions: int | None = None
) -> DataFrame:
    """Dense 1-based number of each row in ``order``."""
    return ranked_rows(df, order, name, partitions)[0]


def ranked_rows(
    df: DataFrame, order: Sequence[Column | str], name: str = "rank", partitions: int | None = None
) -> tuple[DataFrame, int]:
    """The rows with a dense 1-based number in ``order``, and how many there are.

    The rows are range-partitioned by the whole order key (ties of the first
    column are therefore split too), sorted inside their partitions and written
    once; the position inside a partition comes from its running id and the
    start of each partition from the row counts. Unless given, the number of
    partitions follows from the counted rows.
    """
    if partitions is None:
        partitions = min(max(1, -(-df.count() // RANGE_ROWS)), MAX_RANGES)
    running = F.monotonically_increasing_id()  # partition in the upper bits, row in the lower 33
    sorted_rows = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", running)
        .select(
            *df.columns,
            F.shiftright("_id", 33).cast("int").alias("_part"),
            F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        )
    )
    written = stage(sorted_rows, "ranked")
    counts = {r["_part"]: r["n"] for r in written.groupBy("_part").agg(F.max("_pos").alias("n")).collect()}
    starts, total = [], 0
    for part in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(part, -1) + 1
    start = F.element_at(F.expr(f"array({','.join(f'{s}L' for s in starts)})"), F.col("_part") + 1)
    return written.withColumn(name, start + F.col("_pos") + 1).drop("_part", "_pos"), total


def with_running_sums(
    df: DataFrame,
    position: str,
    sums: dict[str, Column],
    block_rows: int = BLOCK_ROWS,
    last: int | None = None,
) -> DataFrame:
    """Running sums from the first row up to each row, by a 1-based row number.

    Blocks of consecutive numbers are summed first (at most ``MAX_BLOCKS``
    totals, which are broadcast); each block then adds up its own rows. Blocks
    have equal size whatever the values are, so no task gets more than its share.
    ``last`` is the largest number where the caller knows it.
    """
    if last is None:
        last = df.agg(F.max(position).alias("last")).first()["last"] or 0
    block_rows = max(block_rows, -(-last // MAX_BLOCKS))
    block = F.expr(f"CAST((`{position}` - 1) DIV {block_rows} AS INT)")
    names = list(sums)
    blocked = df.select("*", block.alias("_block"), *(sums[n].alias(f"_in_{n}") for n in names))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocked.groupBy("_block")
        .agg(*(F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in names))
        .select(
            "_block",
            *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in names),
        )
    )
    upto = (
        Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    )
    return blocked.join(F.broadcast(totals), "_block").select(
        *df.columns,
        *((F.col(f"_start_{n}") + F.sum(f"_in_{n}").over(upto)).alias(n) for n in names),
    )
