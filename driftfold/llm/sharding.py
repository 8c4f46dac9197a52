"""Sharding by fixed virtual slots and a versioned slot-to-shard map, which is stored and edited.

A record's virtual slot is a hash of its doc_id, so it never changes. A map says which shard has which slot. Its
versions are tables in a store; a version is written once, and an edit makes the next one from it:

* growing by a shard moves slots from the fullest shards to the new one until that holds its share. Such an edit
  only ever moves slots into the new shard, and depends on nothing but the numbers of slots and shards: maps that
  were only ever grown keep the law `key`;
* rebalancing moves slots from heavy to light shards by the bytes measured in each slot: from then on the law is
  `bytes`.

The query writes the grown map of its shard count with the measured bytes of each slot, grows it by a shard, and
reads both versions back.

Edge cases: a null doc_id hashes as the empty string; null text has no bytes; repeated rows share a shard
and get different positions; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import atexit
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.llm.common import _remove, materialize, shared_dir, sized

SLOTS = 8192
SHARDS = 40
ROW_BYTES = 16


def grown(shard_of: list[int]) -> list[int]:
    """The map with one more shard, made of slots of the fullest ones."""
    n = max(shard_of) + 2
    owned: list[list[int]] = [[] for _ in range(n - 1)]
    for slot, shard in enumerate(shard_of):
        owned[shard].append(slot)
    after = list(shard_of)
    for _ in range(len(shard_of) // n):
        fullest = max(range(n - 1), key=lambda s: (len(owned[s]), -s))
        after[owned[fullest].pop()] = n - 1
    return after


@cache
def slot_map(shards: int, slots: int = SLOTS) -> tuple[int, ...]:
    """The shard of every virtual slot after growing from one shard to that many."""
    shard_of = [0] * slots
    for _ in range(1, shards):
        shard_of = grown(shard_of)
    return tuple(shard_of)


def rebalanced(version: list[int], slot_bytes: list[int], tolerance: float = 0.02) -> list[int]:
    """The next version of a map: slots moved from the heaviest to the lightest shard until their bytes differ by the tolerance at most.

    Each move lessens the difference, so the edit ends; a slot that alone outweighs the rest stays where it is.
    """
    shard_of, shards = list(version), max(version) + 1
    held: list[set[int]] = [set() for _ in range(shards)]
    load = [0] * shards
    for slot, shard in enumerate(shard_of):
        held[shard].add(slot)
        load[shard] += slot_bytes[slot]
    while True:
        heavy = max(range(shards), key=lambda s: (load[s], -s))
        light = min(range(shards), key=lambda s: (load[s], s))
        gap = load[heavy] - load[light]
        moves = [s for s in held[heavy] if 0 < slot_bytes[s] < gap]
        if gap <= tolerance * sum(load) / shards or not moves:
            return shard_of
        slot = min(moves, key=lambda s: (abs(2 * slot_bytes[s] - gap), s))
        held[heavy].remove(slot)
        held[light].add(slot)
        load[heavy] -= slot_bytes[slot]
        load[light] += slot_bytes[slot]
        shard_of[slot] = light


def virtual_slot(doc_id: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def record_sizes(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every record; texts end here."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), virtual_slot(F.col("doc_id"), slots).alias("vslot"))


@dataclass(frozen=True)
class SlotMaps:
    """The versions of a map, each in a folder of its own below `path`: (version, law, vslot, shard, bytes)."""

    spark: SparkSession
    path: str

    def write(self, version: int, law: str, shard_of: list[int], load: dict[int, int] | None = None) -> None:
        """Store a version; one that is there already is never replaced. load: bytes measured in each slot."""
        rows = [(version, law, slot, shard, (load or {}).get(slot, 0)) for slot, shard in enumerate(shard_of)]
        self.spark.createDataFrame(rows, "version int, law string, vslot int, shard int, bytes long").coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/version-{version}")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("version int, law string, vslot int, shard int, bytes long").parquet(f"{self.path}/version-{version}")

    def _held(self, version: int) -> tuple[str, list[int]]:
        rows = sorted((r.vslot, r.shard, r.law) for r in self.read(version).collect())
        return rows[0][2], [shard for _, shard, _ in rows]

    def grow(self, version: int, load: dict[int, int] | None = None) -> int:
        """Write the next version, with one more shard; its number."""
        law, shard_of = self._held(version)
        self.write(version + 1, law, grown(shard_of), load)
        return version + 1

    def rebalance(self, version: int, load: dict[int, int], tolerance: float = 0.02) -> int:
        """Write the next version, its shards evened by the bytes of their slots; its number."""
        _, shard_of = self._held(version)
        self.write(version + 1, "bytes", rebalanced(shard_of, [load.get(slot, 0) for slot in range(len(shard_of))], tolerance), load)
        return version + 1


def own_maps(spark: SparkSession) -> SlotMaps:
    """A store in the shared folder that goes when the session ends."""
    path = f"{shared_dir(spark)}/driftfold/maps-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return SlotMaps(spark, path)


def ordered_records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, copies, piece): equal records once, written in range partitions by slot, then id; piece numbers these.

    A slot with very many records, as that of a null doc_id may be, spans several pieces.
    """
    same = record_sizes(docs, slots).groupBy("vslot", "doc_id", "text_crc32", "size").agg(F.count("*").alias("copies"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(same.repartitionByRange(parts, "vslot", "doc_id", "text_crc32", "size").withColumn("piece", F.spark_partition_id()), "records")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes in each virtual slot, at most as many rows as there are slots whatever the input."""
    return {r["vslot"]: r["bytes"] for r in records.groupBy("vslot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")).collect()}


def place(records: DataFrame, maps: SlotMaps, version: int, bigger: int | None = None, slots: int = SLOTS) -> DataFrame:
    """Every record's shard by that version, its position there, and its shard by the version with one more.

    Rows are numbered inside the pieces of their slot, and a piece's first number is the count of rows in the
    pieces before it in its shard; so no task ever sorts a whole shard, nor a slot that holds a large part of all rows.
    """
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mapped = maps.read(version).select("vslot", "version", "law", "shard")
    more = maps.read(bigger).select("vslot", F.col("shard").alias("grown_shard")) if bigger else mapped.select("vslot", F.lit(None).cast("int").alias("grown_shard"))
    pieces = records.groupBy("vslot", "piece").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("vslot", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.join(sized(mapped.join(sized(more, "grown map", slots, 8), "vslot"), "slot map", slots, 32), "vslot").select("vslot", "piece", "version", "law", "shard", "grown_shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("vslot", "piece").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = records.withColumn("nth", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    # A slot is in one piece, or in as many as it fills: slots and partitions bound their number.
    placed = numbered.join(sized(starts, "slot starts", slots + parts, 48), ["vslot", "piece"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return placed.select("*", copy.alias("copy")).select("doc_id", "size", "text_crc32", "law", "shard", (F.col("first") + F.col("nth") + F.col("copy")).cast("long").alias("slot"), "grown_shard", "vslot", F.col("version").alias("map_version"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Every record's shard and its position there by a map grown to that many shards, and its shard in one of one more."""
    records = ordered_records(docs, slots)
    load, maps = slot_bytes(records), own_maps(docs.sparkSession)
    maps.write(shards, "key", list(slot_map(shards, slots)), load)
    return place(records, maps, shards, maps.grow(shards, load), slots)


def crc32_table() -> list[int]:
    """The 256 remainders of the reflected CRC-32 polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def sharding_sql(shards: int = SHARDS, slots: int = SLOTS) -> str:
    """DuckDB SQL for shard_documents."""
    now, grown = (f"[{', '.join(map(str, slot_map(n, slots)))}]" for n in (shards, shards + 1))
    return f"""
        with t as (select [{', '.join(map(str, crc32_table()))}] as tab),
        b as (
            select doc_id, strlen(coalesce(text, '')) + {ROW_BYTES} as size,
                   list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: cast('0x' || h as bigint)) as bytes,
                   cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) % {slots} as v
            from documents),
        r as (
            select doc_id, size, v, xor(list_reduce(list_prepend(cast(4294967295 as bigint), bytes),
                       lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1])), cast(4294967295 as bigint)) as text_crc32
            from b, t),
        m as (select *, ({now})[v + 1] as shard, ({grown})[v + 1] as grown_shard from r)
        select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'key' as law,
               cast(shard as integer) as shard,
               cast(row_number() over (partition by shard order by v, doc_id, text_crc32, size) - 1 as bigint) as slot,
               cast(grown_shard as integer) as grown_shard, cast(v as integer) as vslot, cast({shards} as integer) as map_version
        from m"""
