"""Nearest neighbours by inner product: cross-polytope hashing with several probes.

A pseudo-rotation (random signs and a fast Hadamard transform, three times) turns a unit
vector, and the signed axis nearest to it is its cell. Each table has rotations of its
own. Where cells of one rotation would hold too many vectors, further rotations add
levels, so that cells shrink as the data grow. A query probes the cells whose axes lie
nearest to it in every table; all vectors in them are compared exactly, in double
precision, on the original vectors. One rule says how many cells at every size: the share
``sqrt(MET / vectors)`` of them, all where there are fewer vectors than ``MET``.

Equal vectors are one class with its ``k + 1`` smallest ids, which is all that a result
can hold of them. Neighbouring cells make a region of about ``PART`` vectors. A vector goes
to its region once a table, and so does a query, with the list of its cells there, however
many these are. A task holds the vectors of one region and streams the queries past them.
Regions with many vectors or queries are cut into parts, and every part of the one side
meets every part of the other, so no task holds a whole hot region. What a part emits is
its ``k + 1`` best classes of each query, equal ones by id; more can never be needed.
Queries that find fewer than ``k`` neighbours in their cells probe all cells.

Vectors of different lengths are brought onto the sphere by one more coordinate, which
turns the largest inner product into the smallest angle.

Defined results: vectors that are null, zero, of another dimension than most, or with a
null or non-finite component take no part, and neither do rows with a null id; ties go
to the smaller id; repeated rows count once; a query without any candidate has no rows;
an empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.session import stage

K = 20
TABLES = 4
#: Vectors of a table up to which a query meets all; of more it meets the share ``sqrt(MET / vectors)``.
MET = 4096
#: Vectors per cell that further levels aim at.
CELL = 512
#: Vectors of a part of a region, which a task holds, and queries that it streams past them.
PART, QUERY_PART = 131_072, 1_048_576
#: Bytes of a part's vectors, which make parts of long vectors smaller.
PART_BYTES = 1 << 25
#: Numbers that one step of a task works on.
STEP = 1 << 22
ROUNDS = 3
#: Relative difference of lengths from which vectors are brought onto the sphere.
EVEN = 1e-4


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row, scaled to keep its length."""
    n, width = x.shape
    h = 1
    while h < width:
        pairs = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


@lru_cache(maxsize=256)
def signs(table: int, level: int, width: int) -> np.ndarray:
    draw = np.random.Generator(np.random.PCG64([table, level, width]))
    return draw.integers(0, 2, (ROUNDS, width)).astype(np.float64) * 2 - 1


def rotate(x: np.ndarray, table: int, level: int) -> np.ndarray:
    for row in signs(table, level, x.shape[1]):
        x = hadamard(x * row)
    return x


def level_widths(n: int, width: int, cell: int = CELL) -> list[int]:
    """Axes that each level tells apart: whole rotations, and a last one as fine as ``n`` needs."""
    widths, cells = [width], 2 * width
    while cells * cell < n:
        more = min(width, max(2, 1 << (int(np.ceil(n / (cells * cell))) - 1).bit_length() >> 1))
        widths.append(more)
        cells *= 2 * more
    return widths


class Hashing:
    def __init__(self, n: int, dimension: int, longest: float, even: bool):
        self.dimension, self.longest, self.even = dimension, longest, even
        self.width = 1 << (dimension + (not even) - 1).bit_length()
        self.levels = level_widths(n, self.width)
        self.cells = int(np.prod([2 * w for w in self.levels]))
        self.probes = int(np.ceil(self.cells * min(1.0, np.sqrt(MET / max(1, n)))))
        self.part = max(1, min(PART, PART_BYTES // (8 * dimension)))
        self.regions = min(self.cells, max(1, -(-n // self.part)))

    def on_sphere(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        length = np.sqrt((x * x).sum(1, keepdims=True))
        out[:, : self.dimension] = x / (length if query or self.even else self.longest)
        if not query and not self.even:
            out[:, self.dimension] = np.sqrt(np.maximum(0, 1 - (length[:, 0] / self.longest) ** 2))
        return out

    def nearness(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        """How near each signed axis of a level is: 2 * axis for the negative, 2 * axis + 1 for the positive side."""
        turned = rotate(x, table, level)[:, : self.levels[level]]
        return np.stack([-turned, turned], 2).reshape(len(x), -1)

    def cell(self, x: np.ndarray, table: int) -> np.ndarray:
        found = np.zeros(len(x), np.int64)
        for level, width in enumerate(self.levels):
            found = found * (2 * width) + self.nearness(x, table, level).argmax(1)
        return found

    def probe(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` cells of each row whose axes are nearest in sum."""
        score = np.zeros((len(x), 1))
        cells = np.zeros((len(x), 1), np.int64)
        for level, width in enumerate(self.levels):
            near = self.nearness(x, table, level)
            score = (score[:, :, None] + near[:, None, :]).reshape(len(x), -1)
            cells = (cells[:, :, None] * (2 * width) + np.arange(2 * width)).reshape(len(x), -1)
            if score.shape[1] > probes:
                best = np.argpartition(-score, probes - 1, axis=1)[:, :probes]
                score, cells = np.take_along_axis(score, best, 1), np.take_along_axis(cells, best, 1)
        return cells

    def region(self, cells: np.ndarray) -> np.ndarray:
        return cells * self.regions // self.cells


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vec: Column) -> Column:
    """Not null, not zero, and every component finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)


def hashed(rows: DataFrame, hashing: Hashing, tables: int, probes: int | None) -> DataFrame:
    """``rows`` once per table and region: with their own cell, or for queries with the probed ones.

    Queries that probe every cell name none.
    """
    finest = 2 * max(hashing.levels)
    step = 4096 if probes is None else max(1, STEP // (max(probes, 1) * finest))

    def places(x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Row, region and cells of each row to send."""
        if probes is None:
            cells = hashing.cell(x, t)
            return np.arange(len(x)), hashing.region(cells), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1), pa.int32()), cells)
        if probes >= hashing.cells:
            at, region = np.repeat(np.arange(len(x)), hashing.regions), np.tile(np.arange(hashing.regions), len(x))
            return at, region, pa.ListArray.from_arrays(pa.array(np.zeros(len(at) + 1), pa.int32()), pa.array([], pa.int64()))
        cells = np.sort(hashing.probe(x, t, probes), axis=1)
        row, region = np.repeat(np.arange(len(x)), probes), hashing.region(cells.reshape(-1))
        starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (region[1:] != region[:-1])])
        ends = pa.array(np.r_[starts, len(row)], pa.int32())
        return row[starts], region[starts], pa.ListArray.from_arrays(ends, cells.reshape(-1))

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(a, step) for a in range(0, whole.num_rows, step)):
                x = hashing.on_sphere(matrix(batch.column("vec")), probes is not None)
                for t in range(tables):
                    at, region, cells = places(x, t)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), t, np.int64)),
                            pa.array(region.astype(np.int64)),
                            cells,
                            batch.column("class").take(pa.array(at)),
                            batch.column("vec").take(pa.array(at)),
                        ],
                        ["tab", "region", "cells", "class", "vec"],
                    )

    kind = rows.schema["vec"].dataType.simpleString()
    return rows.select("class", "vec").mapInArrow(run, f"tab long, region long, cells array<long>, class long, vec {kind}")


def first_places(query: np.ndarray, classes: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the ``k + 1`` best of their query, equal scores by class."""
    order = np.lexsort((classes, -score, query))
    ranked = query[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place <= k]


def best_of_cell(ask: np.ndarray, near: np.ndarray, owner: np.ndarray, k: int):
    """``(row of ask, class, score)`` of the ``k + 1`` best vectors of a cell for each query."""
    longest = np.sqrt((near * near).sum(1).max())
    for a in range(0, len(ask), max(1, STEP // len(near))):
        own = ask[a : a + max(1, STEP // len(near))]
        score = own @ near.T
        if score.shape[1] > k + 1:
            cut = np.partition(score, -(k + 1), axis=1)[:, -(k + 1)]
            # The product may differ in its last bits from the sums that decide below.
            slack = 1e-12 * longest * np.sqrt((own * own).sum(1))
            row, column = np.nonzero(score >= (cut - slack)[:, None])
        else:
            row, column = (x.reshape(-1) for x in np.indices(score.shape))
        step = max(1, STEP // near.shape[1])
        exact = np.concatenate([(own[row[i : i + step]] * near[column[i : i + step]]).sum(1) for i in range(0, len(row), step)])
        kept = first_places(row, owner[column], exact, k)
        yield a + row[kept], owner[column[kept]], exact[kept]


class Block:
    """The vectors of a part of a region, by cell."""

    def __init__(self, cells: np.ndarray, classes: np.ndarray, vectors: np.ndarray):
        order = np.argsort(cells, kind="stable")
        self.classes, self.vectors = classes[order], vectors[order]
        self.cells, starts = np.unique(cells[order], return_index=True)
        self.ends = np.r_[starts, len(order)]

    def answer(self, asker: np.ndarray, ask: np.ndarray, counts: np.ndarray, cells: np.ndarray, k: int) -> pa.RecordBatch | None:
        """The ``k + 1`` best classes of each query in its cells, of which it names ``counts``; none for all."""
        everywhere = np.flatnonzero(counts == 0)
        row = np.r_[np.repeat(np.arange(len(ask)), counts), np.repeat(everywhere, len(self.cells))]
        cells = np.r_[cells, np.tile(self.cells, len(everywhere))]
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        met = self.cells[at] == cells
        row, at = row[met], at[met]
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        found = []
        cuts = np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]]), len(at)] if len(at) else np.zeros(1, int)
        for a, b in zip(cuts, cuts[1:]):
            lo, hi = self.ends[at[a]], self.ends[at[a] + 1]
            for own, classes, score in best_of_cell(ask[row[a:b]], self.vectors[lo:hi], self.classes[lo:hi], k):
                found.append((row[a:b][own], classes, score))
        if not found:
            return None
        row, classes, score = (np.concatenate(x) for x in zip(*found))
        kept = first_places(row, classes, score, k)
        return pa.RecordBatch.from_arrays([pa.array(asker[row[kept]]), pa.array(classes[kept]), pa.array(score[kept])], ["query", "class", "score"])


def compared(index: DataFrame, queries: DataFrame, part: int, k: int) -> DataFrame:
    """``(query, class, score)``: the best ``k + 1`` classes of each query over the cells it probes."""
    region = ["tab", "region"]
    asked = queries.groupBy(*region).agg(F.ceil(F.count("*") / QUERY_PART).alias("lots"))
    held = index.groupBy(*region).agg(F.ceil(F.count("*") / part).alias("parts"))
    cuts = stage(asked.join(held, region), "regions")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    of = lambda n: F.pmod(F.xxhash64("class"), F.col(n))
    index = index.join(cuts, region).select(*region, of("parts").alias("part"), every("lots").alias("lot"), F.lit(False).alias("ask"), "cells", "class", "vec")
    queries = queries.join(cuts, region).select(*region, every("parts").alias("part"), of("lots").alias("lot"), F.lit(True).alias("ask"), "cells", "class", "vec")
    keys = ["tab", "region", "part", "lot"]

    def run(batches):
        key, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy() for c in keys], 1)
            asks = batch.column("ask").to_numpy(zero_copy_only=False)
            changed = (names[1:] != names[:-1]).any(1) | (asks[1:] != asks[:-1])
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                rows = batch.slice(a, b - a)
                if tuple(names[a]) != key:
                    key, held, block = tuple(names[a]), [], None
                lists, classes, vectors = rows.column("cells"), rows.column("class").to_numpy(), matrix(rows.column("vec"))
                cells = lists.flatten().to_numpy()
                if not asks[a]:
                    held.append((cells, classes, vectors))
                    continue
                if block is None and held:
                    block, held = Block(*(np.concatenate(x) for x in zip(*held))), []
                if block is not None:
                    answer = block.answer(classes, vectors, lists.value_lengths().to_numpy(), cells, k)
                    if answer is not None:
                        yield answer

    both = index.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys, "ask")
    found = both.select(*keys, "ask", "cells", "class", "vec").mapInArrow(run, "query long, class long, score double")
    found = found.groupBy("query", "class").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).drop("place")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    tables: int = TABLES,
    probes: int | None = None,
    vec_id: str = "vec_id",
    vec: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows found for each query row."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).alias("vec"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    dimension = sizes[0]["size"] if sizes else 1
    rows = rows.filter(F.size("vec") == dimension)

    smallest = Window.partitionBy("vec").orderBy("id")
    heads = rows.select("id", "vec").withColumn("rank", F.dense_rank().over(smallest)).filter(F.col("rank") <= k + 1)
    classes = heads.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    classes = stage(classes.select(F.col("ids")[0].alias("class"), "vec", "ids"), "classes")
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, longest, shortest = classes.agg(F.count("*"), F.sqrt(F.max(squares)), F.sqrt(F.min(squares))).first()
    hashing = Hashing(n, dimension, longest or 1.0, not n or longest <= shortest * (1 + EVEN))

    asking = rows.filter("asks").select("id", "vec").distinct()
    asking = stage(asking.join(classes.select("vec", "class"), "vec").select(F.col("id").alias("query_id"), "class"), "queries")
    asked = classes.join(asking.select("class").distinct(), "class", "left_semi")
    probes = min(probes or hashing.probes, hashing.cells)
    tables = 1 if probes == hashing.cells else tables
    found = compared(hashed(classes, hashing, tables, None), hashed(asked, hashing, tables, probes), hashing.part, k)
    found = stage(found, "found")
    held = classes.select("class", F.size("ids").alias("held"))
    counts = found.join(held, "class").groupBy("query").agg(F.sum("held").alias("held")).filter(F.col("held") > k)
    short = asked.join(counts.select(F.col("query").alias("class")), "class", "left_anti")
    if probes < hashing.cells and not short.isEmpty():
        whole = compared(hashed(classes, hashing, 1, None), hashed(short, hashing, 1, hashing.cells), hashing.part, k)
        found = stage(found.unionByName(whole).groupBy("query", "class").agg(F.max("score").alias("score")), "found")

    members = found.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    members = members.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    results = asking.join(members, asking["class"] == members["query"]).filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return results.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
