"""Sharding by fixed virtual slots.

Every record hashes into one of ``n_slots`` virtual slots for good. Bytes and rows are
summed for each slot, and a small versioned map says which shard a slot belongs to. Only the
map changes when shards are added or loads drift: records of slots that did not move stay.

Nulls: a null text has no bytes, a null id hashes like any value (the text's checksum spreads
rows that share an id). Equal rows share a slot. An empty table gives an empty result and a
map that deals the slots evenly. Columns other than the id and the text are ignored.
"""

import heapq

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.llm.common import keep, utf8_bytes

N_SLOTS = 4096
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, n_rows long"


def sized(docs, key="doc_id", text="text", n_slots=N_SLOTS):
    """(key, size, text_crc32, vslot) of each record; size is UTF-8 bytes plus one."""
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")))
    return docs.select(
        F.col(key), (utf8_bytes(F.col(text)) + 1).alias("size"), crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(key), crc), F.lit(n_slots)).cast("int").alias("vslot"))


def slot_loads(rows):
    """Bytes and rows of each slot in use: at most as many rows as there are slots."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"),
                                     F.count(F.lit(1)).alias("n_rows"))


def new_map(loads, n_shards, n_slots=N_SLOTS):
    """First map: slots in order of falling bytes, each to the shard with the fewest bytes.

    ``loads`` is {slot: (bytes, rows)}; the map is {slot: shard} for all slots.
    """
    heap = [(0, 0, shard) for shard in range(n_shards)]
    found = {}
    for slot in sorted(range(n_slots), key=lambda s: (-loads.get(s, (0, 0))[0], s)):
        total, slots, shard = heapq.heappop(heap)
        found[slot] = shard
        heapq.heappush(heap, (total + loads.get(slot, (0, 0))[0], slots + 1, shard))
    return found


def rebalanced(slot_map, loads, n_shards):
    """The map edited for ``n_shards``: slots leave only shards above the mean.

    Slots of shards that are gone move first; then the fullest shard hands its smallest
    fitting slot to the emptiest while that narrows the gap. Added shards thus take slots
    and old ones trade none among themselves but to level what was uneven.
    """
    weight = {s: loads.get(s, (0, 0))[0] for s in slot_map}
    found = dict(slot_map)
    total = dict.fromkeys(range(n_shards), 0)
    owned = {shard: [] for shard in total}
    homeless = []
    for slot, shard in found.items():
        if shard in total:
            total[shard] += weight[slot]
            owned[shard].append(slot)
        else:
            homeless.append(slot)

    def place(slot, shard):
        found[slot] = shard
        total[shard] += weight[slot]
        owned[shard].append(slot)

    for slot in sorted(homeless, key=lambda s: (-weight[s], s)):
        place(slot, min(total, key=lambda x: (total[x], x)))
    for _ in range(len(found)):
        high = max(total, key=lambda x: (total[x], -x))
        low = min(total, key=lambda x: (total[x], x))
        gap = total[high] - total[low]
        fitting = [s for s in owned[high] if 0 < weight[s] < gap]
        if not fitting:
            break
        # The slot closest to half the gap levels the two shards best.
        slot = min(fitting, key=lambda s: (abs(2 * weight[s] - gap), s))
        owned[high].remove(slot)
        total[high] -= weight[slot]
        place(slot, low)
    return found


def map_table(spark, slot_map, loads, version):
    rows = [(version, slot, shard, *loads.get(slot, (0, 0)))
            for slot, shard in sorted(slot_map.items())]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def save_map(table, folder):
    """Adds the map as a version of its own; a version is never replaced."""
    version = table.first()["version"]
    table.drop("version").coalesce(1).write.parquet(f"{folder.rstrip('/')}/version={version}")


def load_map(spark, folder, version=None):
    """The map of that version, or the newest."""
    maps = spark.read.parquet(folder)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version).select(
        F.col("version").cast("int"), "vslot", "shard", "bytes", "n_rows")


def assign(rows, table, key="doc_id"):
    """Each record with its shard and its slot, its gapless place from 0 within the shard.

    The map has one row for each virtual slot, a fixed number, so it is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = table.select("vslot", "shard",
                           F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("vslot").orderBy(key, "text_crc32", "size"))
    return (rows.join(F.broadcast(offsets), "vslot")
            .withColumn("slot", (F.col("_offset") + place - 1).cast("long")).drop("_offset"))


def shard_documents(docs, n_shards, maps, key="doc_id", text="text", n_slots=N_SLOTS):
    """Shards of equal bytes: sizes the records, makes map version 1 in folder ``maps``."""
    spark = docs.sparkSession
    rows = keep(sized(docs, key, text, n_slots), "shard-rows")
    loads = {r["vslot"]: (r["bytes"], r["n_rows"]) for r in slot_loads(rows).collect()}
    save_map(map_table(spark, new_map(loads, n_shards, n_slots), loads, 1), maps)
    return assign(rows, load_map(spark, maps, 1), key)


def write_shards(docs, assigned, path, key="doc_id"):
    """Writes the records as one folder for each shard, in several files each.

    Ids must be unique and not null here, as records find their shard by them.
    """
    placed = docs.join(assigned.select(key, "shard", "slot"), key)
    placed.repartition("shard", F.pmod(F.xxhash64("slot"), F.lit(64))).write.partitionBy(
        "shard").parquet(path)
