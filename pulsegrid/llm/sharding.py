"""Sharding through fixed virtual slots and a versioned slot-to-shard map.

Records are hashed by their text into a fixed number of slots that never changes. Bytes and rows are added up per
slot, and a stored map says which shard holds which slot. Rebalancing edits the map: it
moves as few slots as bring the shards' bytes together, and stores the result as the next version.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import cut_lineage, id_and_text, shared_folder

N_SLOTS = 4096
#: Rows of a slot are numbered in so many cells apart, by id, so no task numbers a whole group of equal texts.
CELLS = 16


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot, in one version of the map."""

    version: int
    shards: int
    shard_of: tuple[int, ...]
    moved: tuple[int, ...] = field(default=())

    @staticmethod
    def initial(shards: int, n_slots: int = N_SLOTS) -> SlotMap:
        return SlotMap(1, shards, tuple(k % shards for k in range(n_slots)))

    def loads(self, sizes: dict[int, int]) -> list[int]:
        out = [0] * self.shards
        for slot, size in sizes.items():
            out[self.shard_of[slot]] += size
        return out

    def rebalanced(self, sizes: dict[int, int], shards: int | None = None) -> SlotMap:
        """The next version: slots move from the fullest to the emptiest shard while that narrows the gap."""
        n = shards or self.shards
        held: list[dict[int, int]] = [{} for _ in range(n)]
        homeless = []
        for slot, shard in enumerate(self.shard_of):
            if shard < n:
                held[shard][slot] = sizes.get(slot, 0)
            else:
                homeless.append(slot)
        load = [sum(h.values()) for h in held]
        where = list(self.shard_of)
        moved = []

        def put(slot: int, to: int) -> None:
            held[to][slot] = sizes.get(slot, 0)
            load[to] += sizes.get(slot, 0)
            where[slot] = to
            moved.append(slot)

        for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
            put(slot, min(range(n), key=lambda k: (load[k], k)))
        for _ in range(8 * len(where)):
            full, bare = max(range(n), key=lambda k: (load[k], -k)), min(range(n), key=lambda k: (load[k], k))
            gap = load[full] - load[bare]
            fits = [(abs(gap / 2 - size), slot) for slot, size in held[full].items() if 0 < size < gap]
            if not fits:
                break
            slot = min(fits)[1]
            load[full] -= held[full].pop(slot)
            put(slot, bare)
        return SlotMap(self.version + 1, n, tuple(where), tuple(dict.fromkeys(moved)))

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row per slot: version, shards, virtual_slot, shard."""
        return spark.createDataFrame([(self.version, self.shards, k, s) for k, s in enumerate(self.shard_of)], "version int, shards int, virtual_slot int, shard int")

    def write(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the stored map; earlier versions stay, and a version is never written twice."""
        self.frame(spark).coalesce(1).write.parquet(f"{path.rstrip('/')}/version={self.version}")

    @staticmethod
    def latest(spark: SparkSession, path: str) -> SlotMap | None:
        """The newest stored version, if there is any."""
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return None
        return SlotMap.read(spark, path, spark.read.parquet(path).agg(F.max("version")).first()[0])

    @staticmethod
    def read(spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path.rstrip('/')}/version={version}").orderBy("virtual_slot").collect()  # bounded by the number of slots
        return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows))


def large_groups(records: DataFrame, share: float) -> list[int]:
    """Hashes of texts whose copies together hold more than this share of all bytes; fewer than 1 / share."""
    sums = cut_lineage(records.groupBy(F.xxhash64("text").alias("h")).agg(F.sum("size").alias("size")))
    total = sums.agg(F.sum("size")).first()[0] or 0
    return [r.h for r in sums.where(F.col("size") > total * share).collect()]


def slot_of(n_slots: int, large: list[int]) -> Column:
    """Slot of a record: from its text, so that equal texts share it; for texts in large from their id too."""
    text = F.xxhash64("text")
    return F.pmod(F.when(text.isin(large), F.xxhash64("doc_id", "text")).otherwise(text), F.lit(n_slots)).cast("int")


def slot_sizes(records: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Bytes and rows per slot and cell; at most as many rows reach the driver as there are of them."""
    found = records.groupBy("virtual_slot", "cell").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    return {(r.virtual_slot, r.cell): (r.size, r.n) for r in found}


def shard(docs: DataFrame, *, shards: int = 8, n_slots: int = N_SLOTS, map_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, SlotMap]:
    """Puts every record into a shard so that the shards' bytes are nearly equal.

    Returns the records (doc_id, text, size, virtual_slot, cell, shard, begins) and the map used: the newest one stored under
    map_path (or an even one) rebalanced for the bytes found, which is stored there as the next version and read
    back. numbered adds a record's place in its shard.

    A group of equal texts stays in one shard, unless it holds more than a quarter of a shard's bytes: such a group
    is spread over the slots by doc_id, as the shards could not be even otherwise.

    A record's size is its text's UTF-8 bytes plus 1; null text has none and counts as equal to empty text. Null ids
    and repeated rows are records like others; an empty table gives no rows and an unchanged assignment.
    """
    spark = docs.sparkSession
    records = id_and_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("size", (F.octet_length("text") + 1).cast("long"))
    slot, cell = slot_of(n_slots, large_groups(records, 0.25 / shards)), F.pmod(F.xxhash64(F.lit("cell"), "doc_id"), F.lit(CELLS)).cast("int")
    records = records.select("*", slot.alias("virtual_slot"), cell.alias("cell"))
    found = slot_sizes(records)
    sizes: dict[int, int] = {}
    for (k, _), (size, _) in found.items():
        sizes[k] = sizes.get(k, 0) + size
    current = (SlotMap.latest(spark, map_path) if map_path else None) or SlotMap.initial(shards, n_slots)
    used = current.rebalanced(sizes, shards)
    if map_path:
        used.write(spark, map_path)
        used = SlotMap.read(spark, map_path, used.version)
    begins, at = [], [0] * shards
    for (k, c), (_, n) in sorted(found.items()):
        s = used.shard_of[k]
        begins.append((k, c, s, at[s]))
        at[s] += n
    places = spark.createDataFrame(begins, "virtual_slot int, cell int, shard int, begins long")  # at most n_slots times CELLS rows
    return records.join(F.broadcast(places), ["virtual_slot", "cell"]), used


def numbered(placed: DataFrame, *order: str) -> DataFrame:
    """Adds slot, the gapless place of a row in its shard. Rows that are equal in all of order take places in any way."""
    within = Window.partitionBy("virtual_slot", "cell").orderBy(*order)
    return placed.withColumn("slot", F.col("begins") + F.row_number().over(within) - 1).drop("begins", "cell")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: all documents into shards 0 to 7 by law `bytes`; equal texts share a shard (see shard for groups too large for
    that). Texts shrink to digests before any shuffle. The slot map is stored in the shared folder and read from there."""
    from .tables import table

    placed, used = shard(table(spark, sf_dir, "documents"), map_path=f"{shared_folder(spark)}/slot-map-{uuid4().hex}")
    digest = placed.withColumn("text_crc32", F.crc32(F.col("text").cast("binary"))).drop("text")
    columns = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(used.version).alias("map_version")]
    return numbered(digest, "doc_id", "text_crc32", "size").select(*columns)
