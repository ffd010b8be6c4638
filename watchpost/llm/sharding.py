"""Sharding over fixed virtual slots, with a versioned map from slots to shards.

A hash deals records over a fixed number of slots, thousands; bytes and records are summed per
slot; and a stored map says which shard has which slot.  Rebalancing, or adding a shard, writes a
new version of the map that moves as few slots as the balance needs; records never change slots.
The law is ``bytes``: shards of nearly equal size.

The map and the sums have one row for each slot, a number that is a parameter and doesn't grow
with the data; only they come to the driver.  A record's number in its shard is where its slot
begins there, which the map knows, plus its number in the slot.  That takes one shuffle by slot
of three numbers a record, never of texts; a slot is a few thousandths of the data.

Records are hashed by id and checksum of the text, so that neither a source nor a group of equal
texts nor rows without an id meet in a slot.  ``digests`` also numbers records that are equal in
both, and hashes the number with them: one that makes up a third of all rows is spread too.
One record larger than a shard's share makes its shard as large as it is.

Edge cases: a null text has 0 bytes and checksum 0; an empty table has an empty result; a null id
is hashed like any other; very long texts only count by their size; records of equal hash share a
slot.  Other columns are carried along untouched; ``with_slots`` refuses one that is named like a
result, ``with_shards`` renames it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchpost.llm.ranking import repeated
from watchpost.llm.storage import written

SLOTS = 4096
SHARDS = 40
OVERHEAD = 16  # bytes of each record besides its text
MAP_SCHEMA = "version int, slot int, shard int"


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def record_crc32(text: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long")


def slot_of(key: Sequence[Column], slots: int = SLOTS) -> Column:
    """The record's slot: a hash of its key, the same in every version of the map."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


# --- the map ----------------------------------------------------------------------------


def first_map(slots: int, shards: int) -> np.ndarray:
    """Version 0, made before anything is known of the data: slots in turn."""
    return np.arange(slots) % shards


def rebalance(shard_of: np.ndarray, slot_bytes: np.ndarray, shards: int) -> np.ndarray:
    """An edited copy of the map with shards of nearly equal bytes.

    Shards above the mean give up the largest slots that their excess holds, so that few slots move,
    and the lightest shards take them; new shards begin empty.  Then slots are moved or swapped
    between the heaviest and the lightest shard while that evens them out.
    """
    edited = shard_of.copy()
    kept = edited < shards
    load = np.bincount(edited[kept], slot_bytes[kept], shards).astype(np.int64)
    excess = load - slot_bytes.sum() / shards
    given = []
    for slot in np.argsort(-slot_bytes, kind="stable").tolist():
        if not kept[slot] or slot_bytes[slot] <= excess[edited[slot]]:
            given.append(slot)
            if kept[slot]:
                excess[edited[slot]] -= slot_bytes[slot]
                load[edited[slot]] -= slot_bytes[slot]
    for slot in given:  # still largest first
        edited[slot] = np.argmin(load)
        load[edited[slot]] += slot_bytes[slot]
    for _ in range(4 * len(edited)):
        if not _even_out(edited, slot_bytes, load):
            break
    return edited


def _even_out(shard_of: np.ndarray, slot_bytes: np.ndarray, load: np.ndarray) -> bool:
    """The move or swap between the heaviest and the lightest shard that evens them out most."""
    heavy, light = int(np.argmax(load)), int(np.argmin(load))
    gap = load[heavy] - load[light]
    out = np.flatnonzero(shard_of == heavy)
    back = np.r_[-1, np.flatnonzero(shard_of == light)]  # -1: nothing comes back
    moved = slot_bytes[out][:, None] - np.r_[0, slot_bytes[back[1:]]]
    left = np.abs(gap - 2 * moved)
    i, j = np.unravel_index(np.argmin(left), left.shape)
    if left[i, j] >= gap:
        return False
    shard_of[out[i]] = light
    if back[j] >= 0:
        shard_of[back[j]] = heavy
    load[heavy] -= moved[i, j]
    load[light] += moved[i, j]
    return True


def slot_sums(records: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and records of each slot, from ``records(virtual_slot, size)``."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))
    nbytes, counts = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for row in sums.collect():  # a row for each slot at most
        nbytes[row["virtual_slot"]], counts[row["virtual_slot"]] = row["bytes"], row["records"]
    return nbytes, counts


def store_map(spark, versions: Sequence[np.ndarray]) -> DataFrame:
    """The versions of the map as a written table, the number of the version in each row."""
    rows = [(v, slot, int(shard)) for v, m in enumerate(versions) for slot, shard in enumerate(m)]
    return written(spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1), "slot-map")


# --- records ------------------------------------------------------------------------------


def with_slots(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32`` and ``virtual_slot``."""
    clash = {"size", "text_crc32", "virtual_slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"the documents already have columns {sorted(clash)}")
    text = F.col(text_col)
    sized = docs.withColumns({"size": record_size(text), "text_crc32": record_crc32(text)})
    return sized.withColumn("virtual_slot", slot_of([F.col(id_col), F.col("text_crc32")], slots))


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``(id_col, size, text_crc32, copy, virtual_slot)`` for each row, without texts.

    Equal records are counted before they are shuffled, and then numbered from 1 as ``copy``.
    """
    text = F.col(text_col)
    counted = (
        docs.select(F.col(id_col), record_size(text).alias("size"), record_crc32(text).alias("text_crc32"))
        .groupBy(id_col, "size", "text_crc32")
        .agg(F.count("*").alias("rows"))
    )
    copies = repeated(counted, "rows", "copy").drop("rows")
    key = [F.col(id_col), F.col("text_crc32"), F.col("copy")]
    return copies.withColumn("virtual_slot", slot_of(key, slots))


def balanced_map(records: DataFrame, *, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``(slot, shard, first)`` of the latest version of a map made for these records.

    ``first`` is the number, in the shard, of the slot's first record.
    """
    nbytes, counts = slot_sums(records, slots)
    versions = [first_map(slots, shards)]
    versions.append(rebalance(versions[0], nbytes, shards))
    table = store_map(records.sparkSession, versions)
    latest = table.where(F.col("version") == len(versions) - 1)
    sums = records.sparkSession.createDataFrame(list(enumerate(counts.tolist())), "slot int, records long")
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return latest.join(sums, "slot").select(
        "slot", "shard", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("first")
    )


def sharded(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records``, as ``with_slots`` gives them, with their ``shard``."""
    own = slot_map.select(F.col("slot").alias("virtual_slot"), "shard")
    return records.join(F.broadcast(own), "virtual_slot")  # a row for each slot


def numbered(records: DataFrame, slot_map: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``records``, as ``digests`` gives them, with ``shard`` and ``slot``, their number in the shard
    without gaps from 0."""
    own = slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "first")
    order = Window.partitionBy("virtual_slot").orderBy(id_col, "text_crc32", "size", "copy")
    number = F.col("first") + F.row_number().over(order) - 1
    return records.join(F.broadcast(own), "virtual_slot").withColumn("slot", number.cast("long")).drop("first")


def _with_room(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """``docs`` with columns of these names called ``own_`` and the name; once more where that exists."""
    taken, renamed = set(docs.columns), {}
    for name in names:
        if name in taken:
            new = f"own_{name}"
            while new in taken:
                new = f"own_{new}"
            taken.add(new)
            renamed[name] = new
    return docs.withColumnsRenamed(renamed)


def with_shards(docs: DataFrame, *, shards: int = SHARDS, slots: int = SLOTS, **columns: str) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``virtual_slot`` and ``shard``.

    A column of ``docs`` that has one of these names is kept as ``own_size`` and so on.
    """
    records = with_slots(_with_room(docs, ["size", "text_crc32", "virtual_slot", "shard"]), slots=slots, **columns)
    narrow = records.select("virtual_slot", "size")
    return sharded(records, balanced_map(narrow, shards=shards, slots=slots))
