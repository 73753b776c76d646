"""Sharding over fixed virtual slots, on DataFrame functions alone.

Records hash into a fixed number of slots; bytes are summed per slot; a versioned map sends slots to
shards. Moving load means editing the map, never hashing records anew.

Law: ``bytes``. Shard sizes are as near equal as whole slots allow; slots go in falling order of size to
the lightest shard so far. With many more records than slots the difference is below one slot.

Nulls: a null text has no bytes; a null id hashes like any value, together with its text, so a third of all
rows may share an id. Empty table: an empty result. Rows alike in id and text share a slot. Other columns,
whatever their names, are not read. Ties in size go to the lower slot and the lower shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.session import scratch_path

SLOTS = 16384
ROW_BYTES = 16
#: Slots whose choices are appended together while the map is folded.
_RUN = 128


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row."""
    text = docs[text_col]
    return docs.select(
        docs[id_col].alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64(docs[id_col], text), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_totals(rows: DataFrame) -> DataFrame:
    """Bytes and rows per slot; at most one row per slot."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def slot_map(totals: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """``version, virtual_slot, shard``: the heaviest slot left goes to the lightest shard.

    The fold runs over one array with an entry per slot, whose number is fixed.
    """
    heaviest = totals.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("slot_bytes")).alias("neg"), F.col("virtual_slot").alias("slot")))).alias("items")
    )
    picked = f"""
        aggregate(
          sequence(0, int(ceil(size(items) / {_RUN}))),
          named_struct(
            'loads', transform(sequence(0, {shards - 1}), s -> named_struct('load', 0L, 'shard', s)),
            'picked', cast(array() AS array<int>)),
          (a, c) -> aggregate(
            slice(items, c * {_RUN} + 1, {_RUN}),
            named_struct('loads', a.loads, 'picked', cast(array() AS array<int>)),
            (b, x) -> named_struct(
              'loads', array_sort(concat(
                slice(b.loads, 2, {shards - 1}),
                array(named_struct('load', b.loads[0].load - x.neg, 'shard', b.loads[0].shard)))),
              'picked', concat(b.picked, array(b.loads[0].shard))),
            b -> named_struct('loads', b.loads, 'picked', concat(a.picked, b.picked))),
          a -> a.picked)"""
    return (
        heaviest.select(F.explode(F.arrays_zip(F.col("items.slot").alias("slot"), F.expr(picked).alias("shard"))).alias("m"))
        .select(F.lit(version).alias("version"), F.col("m.slot").alias("virtual_slot"), F.col("m.shard").alias("shard"))
    )


def rebalanced(current: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, for ``shards`` shards of which the last ones may be new.

    Each shard keeps slots up to its fair share of the bytes; slots beyond that, and only those, move on to
    the shards with room, heaviest first. Slots not in the map yet are placed the same way.
    """
    known = totals.join(F.broadcast(current), "virtual_slot", "left")
    total, seen = known.agg(F.sum("slot_bytes"), F.max("version")).first()
    fair = (total or 0) / shards
    order = Window.partitionBy("shard").orderBy(F.desc("slot_bytes"), "virtual_slot")
    fits = F.sum("slot_bytes").over(order) <= fair
    ranked = known.withColumn("stays", fits & F.col("shard").isNotNull() & (F.col("shard") < shards))
    loads = dict(ranked.where("stays").groupBy("shard").agg(F.sum("slot_bytes")).collect())  # a row per shard
    ends, end = [], 0.0
    for shard in range(shards):
        end += max(0.0, fair - (loads.get(shard) or 0))
        ends.append(end)
    moved = Window.orderBy(F.desc("slot_bytes"), "virtual_slot")  # over the fixed number of slots
    middle = F.sum("slot_bytes").over(moved) - F.col("slot_bytes") / 2
    target = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("middle")))
    version = F.lit((seen or 0) + 1).alias("version")
    moving = ranked.where(~F.coalesce("stays", F.lit(False))).withColumn("middle", middle)
    kept = ranked.where("stays").select(version, "virtual_slot", "shard")
    return kept.unionByName(moving.select(version, "virtual_slot", F.least(target, F.lit(shards - 1)).alias("shard")))


def stored_map(mapping: DataFrame, path: str) -> DataFrame:
    """Add the map to the table of versions at ``path``; returns all versions."""
    mapping.write.mode("append").partitionBy("version").parquet(path)
    return mapping.sparkSession.read.schema("virtual_slot int, shard int, version int").parquet(path)


def placed(rows: DataFrame, totals: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every record with its shard and its place in the shard, counted from 0 without gaps.

    Places are counted slot by slot, so no task sees a whole shard. The map has a bounded number of rows.
    """
    first = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.join(F.broadcast(mapping), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("slot_rows").over(first), F.lit(0)).alias("first_place")
    )
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), "virtual_slot")
        .withColumn("slot", F.col("first_place") + F.col("place"))
        .drop("first_place", "place")
    )


def shard_documents(
    docs: DataFrame, shards: int = 40, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None
) -> DataFrame:
    """Shard all rows by bytes; the slot map is stored at ``map_path`` as its first version."""
    rows = records(docs, slots, id_col, text_col)
    totals = slot_totals(rows)
    path = map_path or scratch_path(docs.sparkSession, "slot-map")
    versions = stored_map(slot_map(totals, shards), path)
    current = versions.where(F.col("version") == F.lit(1)).select("virtual_slot", "shard")
    return placed(rows, totals, current)
