"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's hash names one of ``SLOTS`` virtual slots for good. Bytes and rows are
aggregated per slot, and a small table, kept in numbered versions, says which shard owns
each slot. Rebalancing and growing write a new version in which only some slots have
another owner; records of all other slots stay where they are.

* ``first_map`` deals slots out evenly, ``rebalance`` moves and swaps slots until no
  exchange brings the fullest shard nearer to the emptiest, ``grow`` gives new shards
  slots of the old ones and moves nothing between old shards.
* ``write_shards`` writes the records to a folder per shard in one shuffle on the slot.
  A record's place in its shard is the number of rows of the shard's slots before its
  own, plus its number in its slot, so no task sees a whole shard.

The hash is of id and text, so neither one id nor null ids make a slot large; equal rows
share a slot. The law that holds is ``bytes``: sizes of shards differ by less than any
exchange of two slots could mend, unless one slot alone outweighs a shard.

Defined results: a null text has no bytes and counts as size 1, its checksum is that of
no bytes; an empty text likewise; null ids and repeated rows are records like others, and
ties within a slot are ordered by id, checksum and size, which equal rows share; very long texts are
one record each; an empty table gives an empty result. Columns other than the id and the
text are written through unchanged unless they have the name of one of the added columns,
which then hold the operator's values.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidpulse.llm.common import new_folder
from vidpulse.session import hadoop_path

SLOTS = 4096
#: Columns that the writer adds; ``shard`` is the folder.
ADDED = ("shard", "place", "virtual_slot", "map_version")
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, rows long"
#: Slots one partition of the written shards holds on average at most.
PARTITION_BYTES = 256 << 20


def size_of(text: str = "text") -> Column:
    """Bytes of the text and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_of(key: tuple[str, ...], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_totals(docs: DataFrame, text: str = "text", slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, rows)`` of every slot. Tasks add up first; at most ``slots`` rows come to the driver."""
    keyed = docs.select(slot_of(("doc_id", text), slots).alias("slot"), size_of(text).alias("size"))
    totals = np.zeros((2, slots), np.int64)
    for slot, size, rows in keyed.groupBy("slot").agg(F.sum("size"), F.count(F.lit(1))).collect():
        totals[:, slot] = size, rows
    return totals[0], totals[1]


def first_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """The owner of each slot before anything is known of its bytes."""
    return np.arange(slots) % shards


def rebalance(owner: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """A new map with shards of nearly equal size; most slots keep their owner.

    The fullest shard gives the emptiest the slot, or exchanges with it the two slots,
    that bring both closest together. When nothing does, the fullest is left alone (one slot
    may be most of it) and the others go on.
    """
    owner = owner.copy()
    load = np.bincount(owner, size, shards).astype(np.int64)
    open_ = list(range(shards))
    while len(open_) > 1:
        full = max(open_, key=lambda s: (load[s], -s))
        for empty in sorted(open_, key=lambda s: (load[s], s)):
            gap = int(load[full] - load[empty])
            moved = _exchange(size, np.flatnonzero(owner == full), np.flatnonzero(owner == empty), gap)
            if moved is not None:
                give, take = moved
                shift = int(size[give]) - (int(size[take]) if take is not None else 0)
                owner[give] = empty
                if take is not None:
                    owner[take] = full
                load[full] -= shift
                load[empty] += shift
                break
        else:
            open_.remove(full)
    return owner


def _exchange(size: np.ndarray, mine: np.ndarray, yours: np.ndarray, gap: int):
    """``(slot to give, slot to take or None)`` that shrinks ``gap`` most, None if none does.

    A shift of ``s`` bytes leaves a gap of ``|gap - 2 s|``.
    """
    yours = yours[np.argsort(size[yours], kind="stable")]
    taken = np.concatenate([[0], size[yours]])
    wanted = size[mine] - gap / 2
    best, found = gap, None
    after = np.searchsorted(taken, wanted)
    for at in (np.maximum(after - 1, 0), np.minimum(after, len(taken) - 1)):
        left = np.abs(gap - 2 * (size[mine] - taken[at]))
        if len(left) and left.min() < best:
            k = int(left.argmin())
            best = int(left[k])
            found = int(mine[k]), (int(yours[at[k] - 1]) if at[k] else None)
    return found


def grow(owner: np.ndarray, size: np.ndarray, shards: int, more: int = 1) -> np.ndarray:
    """A map with ``more`` new shards: each old shard gives slots up to its even share, none takes any."""
    owner = owner.copy()
    share = size.sum() / (shards + more)
    load = np.zeros(shards + more, np.int64)
    for shard in range(shards):
        own = np.flatnonzero(owner == shard)
        own = own[np.argsort(-size[own], kind="stable")]
        excess = size[own].sum() - share
        for slot in own.tolist():
            if 0 < size[slot] <= excess:
                new = shards + int(load[shards:].argmin())
                owner[slot], excess = new, excess - size[slot]
                load[new] += size[slot]
    return owner


def store_map(
    spark: SparkSession, folder: str, owner: np.ndarray, size: np.ndarray, rows: np.ndarray
) -> int:
    """Write the map as the next version and return its number; earlier versions stay."""
    version = max(map_versions(spark, folder), default=0) + 1
    table = [(k, *map(int, x)) for k, x in enumerate(zip(owner, size, rows))]
    spark.createDataFrame(table, MAP_SCHEMA).coalesce(1).write.parquet(f"{folder}/version={version}")
    return version


def map_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions that were written whole."""
    fs, path = hadoop_path(spark, folder)
    if not fs.exists(path):
        return []
    paths = [x.getPath() for x in fs.listStatus(path)]
    whole = [p for p in paths if fs.exists(hadoop_path(spark, f"{p.toString()}/_SUCCESS")[1])]
    return sorted(int(p.getName().removeprefix("version=")) for p in whole)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``virtual_slot, shard, bytes, rows``, a row for each slot, of one version or the latest."""
    version = version or max(map_versions(spark, folder))
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}")


def plan_shards(
    docs: DataFrame, shards: int, folder: str, text: str = "text", slots: int = SLOTS
) -> int:
    """Aggregate the slots, store the even map (or take the stored one) and its rebalanced edit.

    Returns the version of the edit. At most ``slots`` rows pass through the driver.
    """
    spark = docs.sparkSession
    size, rows = slot_totals(docs, text, slots)
    if not map_versions(spark, folder):
        store_map(spark, folder, first_map(shards, slots), size, rows)
    before = np.zeros(slots, np.int64)
    for r in load_map(spark, folder).collect():
        before[r.virtual_slot] = r.shard
    if before.max() >= shards:
        raise ValueError(f"the stored map has more than {shards} shards")
    if before.max() < shards - 1:
        before = grow(before, size, int(before.max()) + 1, shards - 1 - int(before.max()))
    return store_map(spark, folder, rebalance(before, size, shards), size, rows)


def sharded(docs: DataFrame, folder: str, version: int, text: str = "text", slots: int = SLOTS) -> DataFrame:
    """The records with ``shard, place, virtual_slot, map_version``; places of a shard run from 0 without gaps."""
    spark = docs.sparkSession
    owned = load_map(spark, folder, version)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = owned.select(
        F.col("virtual_slot").alias("_slot"),
        F.col("shard").alias("_shard"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_base"),
    )
    total = owned.agg(F.sum("bytes")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_BYTES))
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(*kept, slot_of(("doc_id", text), slots).alias("_slot"))
    rows = rows.join(F.broadcast(bases), "_slot")  # one row for each slot
    order = Window.partitionBy("_slot").orderBy("doc_id", F.crc32(F.coalesce(text, F.lit(""))), size_of(text))
    return rows.repartition(int(min(partitions, slots)), "_slot").select(
        *kept,
        F.col("_shard").alias("shard"),
        (F.col("_base") + F.row_number().over(order) - 1).alias("place"),
        F.col("_slot").alias("virtual_slot"),
        F.lit(version).alias("map_version"),
    )


def write_shards(
    docs: DataFrame, shards: int, folder: str | None = None, text: str = "text", slots: int = SLOTS
) -> str:
    """Plan, then write ``folder/map/version=N`` and ``folder/records-N/shard=K``; returns the records' folder."""
    folder = folder or new_folder(docs.sparkSession, "shards")
    version = plan_shards(docs, shards, f"{folder}/map", text, slots)
    records = f"{folder}/records-{version}"
    sharded(docs, f"{folder}/map", version, text, slots).write.partitionBy("shard").parquet(records)
    return records


def read_shards(spark: SparkSession, records: str, docs: DataFrame) -> DataFrame:
    """The written records, with the types of the table ``docs`` that they come from."""
    kept = [f for f in docs.schema.fields if f.name not in ADDED]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    added = "place long, virtual_slot int, map_version int, shard int"
    return spark.read.schema(f"{schema}, {added}").parquet(records)
