"""Exact Jaccard join of documents by their word n-grams, as a blocked sparse product.

Documents are the rows and n-grams the columns of a sparse 0/1 matrix; overlaps are
entries of its product with its transpose. Only blocks that can hold a link are
multiplied, and within them pairs that their sizes rule out are left out:

1. Rows with equal n-gram sets are one class. Columns that many documents share are
   counted, so that columns can be ordered from rare to frequent.
2. Two sets with a similarity of ``t`` or more share at least ``least_shared`` of the
   first ``size - ceil(t * size) + least_shared`` columns of each in that order. Pairs that
   share a column of few documents are counted, and pairs with too low a count dropped.
   A column of many documents is not paired: its documents, sorted by size, fall into
   runs that no link can cross, and a run becomes one block under its smallest document,
   its pivot. Documents with too few shared columns of either kind leave.
3. Candidates are multiplied in blocks: the pivot's row with all rows, and the rows it
   isn't linked with with the whole block. Overlap counts add up over the columns, and what
   stays under the bound of both sizes is dropped. A spanning set of the links leaves the
   block. Blocks of many n-grams or rows are cut into chunks that all get the pivot; rows that it
   isn't linked with then meet the other chunks, too, in lots of the same size. This is done twice: first every document with its
   smallest pivot alone, which joins most groups; then all candidates that are still apart.
4. Links become components by minimum labels and pointer jumping.

No pair of classes with a link is lost; neither groups nor candidates are capped.

Words are runs without ASCII white space, A to Z in lower case; fewer than ``GRAM`` words
are one n-gram. Defined results: a null, empty or wordless text has no n-gram, is linked
with nothing and is its own component; rows with words that share a ``doc_id`` are one
document, so their classes are linked; rows with a null ``doc_id`` take no part in links and have no
component; repeated rows get a row each; an empty table gives an empty result. Only
``doc_id`` and the text are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.llm.common import coded, put_file, slices, split_words, texts_of
from vidpulse.session import stage

GRAM = 5
#: A link needs ``100 * overlap >= THRESHOLD * union``.
THRESHOLD = 75
#: Columns whose order is known at most (16 bytes each), and the count from which one is frequent.
FREQUENT_COLUMNS = 1 << 18
FREQUENT_MIN = 4
#: Documents of a column that are paired with each other; columns of more make blocks.
PAIRED = 32
#: Of a set's columns, one in so many more must be shared among the first.
SHARED_STEP = 50
#: N-grams that a task counts at a time.
COUNT_BUFFER = 4 << 20
#: N-grams and rows in a chunk of a block, and documents of a column from which its run is split.
CHUNK_GRAMS, CHUNK_ROWS = 1 << 20, 1024
SPLIT_RUN = 50_000

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text (no nulls)."""
    offsets, words = split_words(pc.ascii_lower(texts))
    codes, distinct = coded(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))[codes]
    n = max(0, len(hashes) - GRAM + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(GRAM):
        rolled += hashes[k : k + n] * ODD[k]
    rolled = _mix(rolled).view(np.int64)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= GRAM:
            out.append(np.unique(rolled[a : b - GRAM + 1]))
        elif b > a:
            short = (hashes[a:b] * ODD[: b - a]).sum(dtype=np.uint64, keepdims=True) + ODD[4:] * np.uint64(b - a)
            out.append(_mix(short).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def class_hash(grams: np.ndarray) -> int:
    """A signed 64-bit hash of a sorted set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))


def signatures(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles, class)`` of every row, and ``(column, documents)`` of columns seen again.

    A column's documents are added up over the buffers in which it occurs at least
    twice; the result only orders columns, so links don't depend on it.
    """

    def run(batches):
        held: list[np.ndarray] = []
        known: set[int] = set()

        def counted():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            found, n = found[n > 1], n[n > 1]
            nothing = pa.nulls(len(found), pa.int64())
            return pa.RecordBatch.from_arrays([nothing, nothing, nothing, pa.array(found), pa.array(n)], names)

        names, size = ["doc_id", "n_shingles", "class", "column", "documents"], 0
        for batch in batches:
            for part in slices(batch, text):
                sets = gram_sets(texts_of(part, text))
                marks = [class_hash(s) for s in sets]
                nothing = pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.int64()), nothing, nothing],
                    names,
                )
                for own, mark in zip(sets, marks):
                    if mark not in known and len(own):
                        known.add(mark)
                        held.append(own)
                        size += len(own)
                if size > COUNT_BUFFER:
                    yield counted()
                    held, size, known = [], 0, set()
        if held:
            yield counted()

    schema = "doc_id long, n_shingles long, class long, column long, documents long"
    both = stage(docs.select("doc_id", text).mapInArrow(run, schema), "signatures")
    columns = both.filter("column is not null").groupBy("column").agg(F.sum("documents").alias("documents"))
    return both.filter("column is null").select("doc_id", "n_shingles", "class"), columns


def frequent_columns(spark: SparkSession, columns: DataFrame, most: int = FREQUENT_COLUMNS) -> str:
    """Write the at most ``most`` most frequent columns, sorted, with their counts; returns the file's name."""
    columns = stage(columns.filter(F.col("documents") >= FREQUENT_MIN), "columns")
    least, total = None, 0
    for n, found in sorted(columns.groupBy("documents").count().collect(), reverse=True):
        total += found
        if total > most:
            break
        least = n
    rows = columns.filter(F.col("documents") >= least).toArrow() if least is not None else None
    keys = rows["column"].to_numpy() if rows else np.empty(0, np.int64)
    counts = rows["documents"].to_numpy() if rows else np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")
    return put_file(spark, np.concatenate([[len(keys)], keys[order], counts[order]]).astype(np.int64).tobytes(), "columns")


@lru_cache(maxsize=2)
def mapped_columns(name: str) -> tuple[np.ndarray, np.ndarray]:
    whole = np.memmap(SparkFiles.get(name), np.int64, "r")
    n = int(whole[0])
    return whole[1 : n + 1], whole[n + 1 :]


def column_counts(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, counts = frequent
    if not len(keys):
        return np.zeros(len(grams), np.int64)
    at = np.searchsorted(keys, grams).clip(max=len(keys) - 1)
    return np.where(keys[at] == grams, counts[at], 0)


def least_shared(n: int) -> int:
    """Columns that a set of ``n`` and a linked one no smaller share among the first of both."""
    return 1 + n // SHARED_STEP


def prefix_size(n: int, threshold: int = THRESHOLD) -> int:
    """Of ``n`` columns, those of which a linked set must share ``least_shared``."""
    return min(n, n - -(-threshold * n // 100) + least_shared(n))


def prefix_rows(docs: DataFrame, frequent: str, threshold: int, split_run: int, text: str = "text") -> DataFrame:
    """``(column, part, n, class)``: the rarest columns of each class; ``part`` splits very frequent ones."""

    def run(batches):
        order_of, known = mapped_columns(frequent), set()
        for batch in batches:
            for rows in slices(batch, text):
                rows = rows.filter(pc.is_valid(rows.column("doc_id")))
                found, sizes, marks, parts = [], [], [], []
                for own in gram_sets(texts_of(rows, text)):
                    mark = class_hash(own)
                    if not len(own) or mark in known:
                        continue
                    known.add(mark)
                    counts = column_counts(own, order_of)
                    rarest = np.lexsort((own, counts))[: prefix_size(len(own), threshold)]
                    found.append(own[rarest])
                    split = -(-counts[rarest] // split_run)
                    parts.append(np.where(split > 1, mark % np.maximum(split, 1), -1))
                    sizes.append(np.full(len(rarest), len(own)))
                    marks.append(np.full(len(rarest), mark))
                if len(known) > 1 << 20:
                    known.clear()
                if found:
                    arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in (found, parts, sizes, marks)]
                    yield pa.RecordBatch.from_arrays(arrays, ["column", "part", "n", "class"])

    return docs.select("doc_id", text).mapInArrow(run, "column long, part long, n long, class long")


RUNS = "pivot long, pivot_n long, class long, n long, column long, part long, paired boolean"


def column_runs(prefixes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``RUNS``: pairs of classes of a column with few of them, or a run's classes under its first.

    Rows stream by in order of column and size, and a column's first ``PAIRED`` rows are held.
    """

    def told(left, right, paired):
        c, p, n, k = right
        columns = [pa.array(x) for x in (left[3], left[2], k, n, c, p, np.full(len(c), paired))]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in RUNS.split(", ")])

    def apart(left, right):
        """Whether sizes rule a link out."""
        return threshold * right[2] > 100 * left[2]

    def pairs(rows):
        """All pairs of each run of at most ``PAIRED`` rows that sizes allow."""
        starts = np.flatnonzero(np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(0)]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.shape[1])))
        for step in range(1, PAIRED):
            same = np.flatnonzero(run[step:] == run[:-step])
            if not len(same):
                return
            left, right = rows[:, same], rows[:, same + step]
            able = ~apart(left, right)
            if able.any():
                yield told(left[:, able], right[:, able], True)

    def run(batches):
        held, pivot, last = np.empty((4, 0), np.int64), None, None  # of the column at hand
        for batch in batches:
            rows = np.stack([batch.column(x).to_numpy() for x in ("column", "part", "n", "class")])
            rows = np.concatenate([held, rows], 1)
            if last is not None and rows.shape[1]:  # the column goes on as a block
                more = int((rows[:2] == last[:2, None]).all(0).argmin()) if not (rows[:2] == last[:2, None]).all() else rows.shape[1]
                yield from block(rows[:, :more], state := [pivot, last])
                pivot, last = state
                rows = rows[:, more:]
                if not rows.shape[1]:
                    held = rows
                    continue
                pivot = last = None
            if not rows.shape[1]:
                continue
            fresh = np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])
            rows = rows[:, fresh]
            starts = np.flatnonzero(np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(0)]))
            sizes = np.diff(np.append(starts, rows.shape[1]))
            whole = np.ones(len(starts), bool)
            whole[-1] = False  # the last one may go on
            large = (sizes > PAIRED) | (rows[1, starts] >= 0)
            small = np.repeat(whole & ~large, sizes)
            yield from pairs(rows[:, small])
            for a, n in zip(starts[large].tolist(), sizes[large].tolist()):
                state = [None, None]
                yield from block(rows[:, a : a + n], state)
            held = rows[:, starts[-1] :]
            if large[-1]:
                (pivot, last), held = state, held[:, :0]
        if held.shape[1]:
            yield from pairs(held)

    def block(rows, state):
        """Each row under the first of its run; ``state`` is the run's first and the row before."""
        if not rows.shape[1]:
            return
        pivot, last = state
        before = np.concatenate([rows[:, :1] if last is None else last[:, None], rows[:, :-1]], 1)
        # Of a split column a gap in one part may be none in the whole.
        head = apart(before, rows) & (rows[1] < 0)
        head[0] |= last is None
        at = np.maximum.accumulate(np.where(head, np.arange(len(head)), -1))
        left = np.where(at >= 0, rows[:, at], rows[:, :1] if pivot is None else pivot[:, None])
        yield told(left, rows, False)
        state[0], state[1] = left[:, -1], rows[:, -1]

    ordered = prefixes.repartition("column", "part").sortWithinPartitions("column", "part", "n", "class")
    return ordered.mapInArrow(run, RUNS)


def candidates(prefixes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``pivot, class, pivot_n, n, paired``: pairs that share enough, and blocks of frequent columns."""
    runs = column_runs(prefixes, threshold)
    key = F.when(F.col("part") >= 0, F.col("column"))
    ends = ["pivot", "pivot_n", "class", "n", "paired", key.alias("split")]
    found = stage(runs.select(*ends).groupBy("pivot", "pivot_n", "class", "n", "paired", "split").agg(F.count("*").alias("shared")), "runs")

    pairs = found.filter("paired").groupBy("pivot", "pivot_n", "class", "n").agg(F.sum("shared").alias("shared"))
    split = found.filter("split is not null")
    first = split.groupBy("split").agg(F.min(F.struct("pivot_n", "pivot")).alias("first"))
    split = split.join(first, "split").select(F.col("first.pivot"), F.col("first.pivot_n"), "class", "n", "shared")
    whole = found.filter("not paired and split is null").select("pivot", "pivot_n", "class", "n", "shared")
    lots = whole.unionByName(split).groupBy("pivot", "pivot_n", "class", "n").agg(F.sum("shared").alias("shared"))

    # Columns that a class shares with any other, in pairs and in blocks.
    sides = pairs.select("class", "shared").unionByName(pairs.select(F.col("pivot").alias("class"), "shared"))
    able = sides.unionByName(lots.select("class", "shared")).groupBy("class").agg(F.sum("shared").alias("of_class"))
    least = lambda n: 1 + F.floor(n / SHARED_STEP)
    # The smallest set that one of ``n`` can be linked with asks for the least.
    lots = lots.join(able, "class").filter(F.col("of_class") >= least(F.col("n") * threshold / 100)).drop("of_class")
    pairs = pairs.filter(F.col("shared") >= least(F.least("pivot_n", "n")))
    return pairs.withColumn("paired", F.lit(True)).unionByName(lots.withColumn("paired", F.lit(False))).drop("shared")


def links(row: np.ndarray, block: list[np.ndarray], sizes: np.ndarray, threshold: int) -> np.ndarray:
    """Which sets of ``block`` are linked with ``row``; sizes alone rule most others out."""
    n = len(row)
    able = np.flatnonzero((threshold * n <= 100 * sizes) & (threshold * sizes <= 100 * n))
    if not len(able):
        return able
    flat = np.concatenate([block[i] for i in able.tolist()])
    at = np.searchsorted(row, flat).clip(max=n - 1)
    overlap = np.add.reduceat((row[at] == flat).astype(np.int64), np.cumsum(sizes[able]) - sizes[able])
    return able[100 * overlap >= threshold * (n + sizes[able] - overlap)]


class Forest:
    """Disjoint sets of numbers."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(self.top(x), x) for x in self.up if self.top(x) != x]


def multiply(ids: list[int], sets: list[np.ndarray], pivot: int, threshold: int):
    """``(spanning links of a chunk, positions that its pivot isn't linked with)``."""
    forest, sizes = Forest(), np.array([len(s) for s in sets], np.int64)
    near = links(sets[pivot], sets, sizes, threshold)
    for j in near.tolist():
        forest.join(ids[pivot], ids[j])
    far = np.setdiff1d(np.arange(len(ids)), near)
    _rows_against(forest, far.tolist(), ids, sets, ids, sets, sizes, threshold)
    return forest.edges(), far


def _rows_against(forest, rows, row_ids, row_sets, ids, sets, sizes, threshold) -> None:
    """Multiply some rows with a block; the columns of the block are sorted once."""
    if not rows:
        return
    if len(rows) < 4:
        for i in rows:
            for j in links(row_sets[i], sets, sizes, threshold).tolist():
                forest.join(row_ids[i], ids[j])
        return
    columns = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    for i in rows:
        own = row_sets[i]
        a = np.searchsorted(columns, own, "left")
        runs = np.searchsorted(columns, own, "right") - a
        ends = np.cumsum(runs)
        at = np.arange(ends[-1]) + np.repeat(a - ends + runs, runs)
        overlap = np.bincount(owner[at], minlength=len(sets))
        linked = (100 * overlap >= threshold * (len(own) + sizes - overlap)) & (overlap > 0)
        for j in np.flatnonzero(linked).tolist():
            forest.join(row_ids[i], ids[j])


EDGES = "a long, b long, chunk long, far boolean"


def _groups(batches, keys: list[str], text: str):
    """``(key, flags, doc_ids, sets)`` of consecutive rows with equal keys, over all batches."""
    key, rows = None, ([], [], [])
    for batch in batches:
        for part in slices(batch, text):
            sets = gram_sets(texts_of(part, text))
            names = zip(*(part.column(k).to_pylist() for k in keys))
            for own, flag, doc, grams in zip(names, part.column("flag").to_pylist(), part.column("doc_id").to_pylist(), sets):
                if not len(grams):  # another row of a repeated id, without words
                    continue
                if own != key:
                    if key is not None:
                        yield (key, *rows)
                    key, rows = own, ([], [], [])
                for x, y in zip(rows, (flag, doc, grams)):
                    x.append(y)
    if key is not None:
        yield (key, *rows)


def _edge_batch(a, b, chunk, far) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((a, b, chunk, far), kinds)], ["a", "b", "chunk", "far"])


def link_edges(
    docs: DataFrame, members: DataFrame, threshold: int, chunk_grams: int, chunk_rows: int, text: str = "text"
) -> DataFrame:
    """``(a, b)``: links between representatives that span every linked group.

    ``members`` has ``(pivot, doc_id, n)`` with representatives' ids, pivots included. Blocks
    are cut into chunks, and the rows that meet other chunks into lots, both by n-grams and rows.
    """
    pieces = F.greatest(F.ceil(F.sum("n") / chunk_grams), F.ceil(F.count("*") / chunk_rows))
    sizes = members.groupBy("pivot").agg(pieces.alias("chunks"))
    dealt = members.join(sizes, "pivot").withColumn("flag", F.col("doc_id") == F.col("pivot"))
    every = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    one = F.array(F.pmod(F.xxhash64("doc_id"), F.col("chunks")))
    dealt = dealt.select("pivot", "chunks", "doc_id", "n", "flag", F.explode(F.when(F.col("flag"), every).otherwise(one)).alias("chunk"))
    dealt = stage(dealt, "blocks")
    # Members grow with the documents, so their texts are joined in the same way at every size.
    texts = docs.select("doc_id", text).hint("merge")

    def first(batches):
        for (pivot, chunk, chunks), flags, ids, sets in _groups(batches, ["pivot", "chunk", "chunks"], text):
            if len(ids) < 2 and chunks == 1:
                continue
            edges, far = multiply(ids, sets, flags.index(True), threshold)
            if edges:
                yield _edge_batch([e[0] for e in edges], [e[1] for e in edges], [chunk] * len(edges), [False] * len(edges))
            if chunks > 1 and len(far):
                told = [ids[i] for i in far.tolist()]
                yield _edge_batch([pivot] * len(told), told, [chunk] * len(told), [True] * len(told))

    rows = dealt.join(texts, "doc_id").repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk")
    found = stage(rows.mapInArrow(first, EDGES), "links")
    edges = found.filter(~F.col("far")).select("a", "b")
    far = found.filter("far").select(F.col("a").alias("pivot"), F.col("b").alias("doc_id"), F.col("chunk").alias("own"))
    if far.isEmpty():
        return edges

    # Rows that a pivot of several chunks isn't linked with meet every other chunk.
    lots = dealt.filter("chunks > 1")
    far = stage(far.distinct().join(lots.filter(~F.col("flag")).select("pivot", "doc_id", "n"), ["pivot", "doc_id"]), "far")
    far = far.join(far.groupBy("pivot").agg(pieces.alias("lots")), "pivot")
    far = far.withColumn("lot", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("lots"))).select("pivot", "doc_id", "own", "lot")
    pairs = lots.select("pivot", "chunk").distinct().join(far.select("pivot", "lot").distinct(), "pivot")
    rows = pairs.join(lots.filter(~F.col("flag")), ["pivot", "chunk"]).select("pivot", "chunk", "lot", "doc_id", F.lit(False).alias("flag"))
    asking = pairs.join(far, ["pivot", "lot"]).filter("own != chunk")
    rows = rows.unionByName(asking.select("pivot", "chunk", "lot", "doc_id", F.lit(True).alias("flag")))

    def second(batches):
        for _, flags, ids, sets in _groups(batches, ["pivot", "chunk", "lot"], text):
            asking = [i for i, f in enumerate(flags) if f]
            block = [i for i, f in enumerate(flags) if not f]
            if not asking or not block:
                continue
            forest = Forest()
            own = [sets[i] for i in block]
            counts = np.array([len(s) for s in own], np.int64)
            _rows_against(forest, asking, ids, sets, [ids[i] for i in block], own, counts, threshold)
            edges = forest.edges()
            yield _edge_batch([e[0] for e in edges], [e[1] for e in edges], [0] * len(edges), [False] * len(edges))

    keys = ["pivot", "chunk", "lot"]
    rows = rows.join(texts, "doc_id").repartition(*keys).sortWithinPartitions(*keys)
    return edges.unionByName(stage(rows.mapInArrow(second, EDGES).select("a", "b"), "links"))


def components(edges: DataFrame) -> DataFrame:
    """``(doc_id, component_id)`` of all ends of edges: the smallest id that is reachable.

    Each round takes the smallest label around and then the label's own label, so
    the number of rounds grows with the logarithm of the longest path.
    """
    both = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(around, "a").select("a", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("a").alias("low"), F.col("label").alias("next"))
        moved = lower.join(jump, "low").select("a", F.col("label").alias("before"), F.least("low", "next").alias("label"))
        moved = stage(moved, "labels")
        labels = moved.select("a", "label")
        if moved.filter(F.col("before") != F.col("label")).isEmpty():
            return labels.select(F.col("a").alias("doc_id"), F.col("label").alias("component_id"))


def jaccard_components(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    text: str = "text",
    chunk_grams: int = CHUNK_GRAMS,
    split_run: int = SPLIT_RUN,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    rows, columns = signatures(docs, text)
    frequent = frequent_columns(spark, columns)
    sized = rows.filter("doc_id is not null and n_shingles > 0")
    classes = stage(sized.groupBy("class").agg(F.min("doc_id").alias("first")), "classes")

    found = candidates(prefix_rows(docs, frequent, threshold, split_run, text), threshold)
    first = classes.select(F.col("class").alias("pivot"), F.col("first").alias("head"))
    found = found.join(classes, "class").join(first, "pivot")
    ends = [F.col("head").alias("pivot"), F.col("first").alias("doc_id"), "pivot_n", "n", "paired"]
    found = stage(found.select(*ends).filter("pivot <> doc_id"), "candidates")

    def blocks(rows):
        """The rows with their pivots as members of their own blocks."""
        pivots = rows.select("pivot", F.col("pivot").alias("doc_id"), F.col("pivot_n").alias("n"))
        return rows.select("pivot", "doc_id", "n").unionByName(pivots).groupBy("pivot", "doc_id").agg(F.max("n").alias("n"))

    smallest = F.min(F.struct("pivot_n", "pivot", "n")).alias("s")
    nearest = found.groupBy("doc_id").agg(smallest).select("doc_id", "s.*")
    edges = link_edges(docs, blocks(nearest), threshold, chunk_grams, chunk_rows, text)

    label = components(edges)
    of_pivot = label.select(F.col("doc_id").alias("pivot"), F.col("component_id").alias("y"))
    placed = found.join(label, "doc_id", "left").join(of_pivot, "pivot", "left")
    placed = placed.withColumn("x", F.coalesce("component_id", "doc_id")).withColumn("y", F.coalesce("y", "pivot"))
    apart = placed.filter("not paired").groupBy("pivot").agg(F.max(F.col("x") != F.col("y")).alias("apart")).filter("apart")
    lots = placed.filter("not paired").join(apart, "pivot", "left_semi")
    rest = placed.filter("paired and x <> y").unionByName(lots).select("pivot", "doc_id", "pivot_n", "n")
    edges = edges.unionByName(link_edges(docs, blocks(stage(rest, "apart")), threshold, chunk_grams, chunk_rows, text))

    # Classes of one doc_id are one document's.
    shared = sized.groupBy("doc_id").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x < y")
    shared = sized.join(shared.select("doc_id"), "doc_id").join(classes, "class")
    edges = edges.unionByName(shared.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct())

    label = components(edges).withColumnRenamed("doc_id", "first")
    of_class = classes.join(label, "first", "left").select("class", F.coalesce("component_id", "first").alias("component_id"))
    out = rows.withColumn("class", F.expr("if(doc_id is null or n_shingles = 0, null, class)")).join(of_class, "class", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", own).alias("component_id"))


def one_of_each(docs: DataFrame, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of one document of each component, the one with the smallest id; all their columns.

    Rows with a null ``doc_id`` stay. Of repeated rows with that id one stays.
    """
    found = stage(jaccard_components(docs, threshold, text), "components")
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(stage(gone, "gone"), "doc_id", "left_anti").select(*docs.columns)
    again = found.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id")
    again = stage(again, "again")
    if again.isEmpty():
        return kept
    single = kept.join(again, "doc_id", "left_anti").select(*docs.columns)
    repeated = kept.join(again, "doc_id", "left_semi").select(*docs.columns)
    return single.unionByName(repeated.dropDuplicates(["doc_id"]))
