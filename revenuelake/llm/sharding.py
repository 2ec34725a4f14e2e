"""Sharding through fixed virtual slots, with DataFrame functions only.

Records are hashed into a fixed number of slots. The bytes of each slot are summed, and a small map, stored with a
version, says which shard holds which slot. A first map deals the slots, largest first, each to the lightest shard.
Rebalancing edits the map: slots stay where they are unless their shard holds more than its share; only the
slots beyond it move. Records never need to be hashed anew. The law is ``bytes``: sizes near equal.

The map has one row for each slot, a fixed number; only it is gathered in one row, to be dealt by a fold. Records
are numbered within their shard from the counts of fine buckets, whose number follows the shuffle partitions, so
no task ever holds a shard.

Defined results: a null text is empty (16 bytes); equal texts are spread by their ids, null ids by their text; repeated
rows share a slot but have numbers of their own; an empty table gives an empty result and an even map. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revenuelake.llm.common import shuffle_partitions
from revenuelake.session import materialize, scratch_path

SLOTS = 8192
SHARDS = 40
RECORD_BYTES = 16
LAW = "bytes"
MAP_SCHEMA = "version int, vslot int, shard int"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every document."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    crc = F.crc32(body)
    return docs.select(
        "doc_id",
        (F.octet_length(body) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", crc), F.lit(slots)).cast("int").alias("vslot"),
    )


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row for each slot, also the empty ones: vslot, bytes."""
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(F.broadcast(sums), "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0)).alias("bytes"))  # fixed number of rows


def _deal(waiting: DataFrame, shards: int, held: str | None = None) -> DataFrame:
    """Give each waiting slot (vslot, bytes), largest first, to the shard that is lightest then.

    ``held`` names a column with the same map of shard to bytes in every row. One row and as many steps as there are
    slots: a fixed number.
    """
    order = F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("_b"), F.col("vslot"))))
    gathered = waiting.agg(order.alias("_order"), (F.first(held) if held else F.lit(None).cast("map<int,bigint>")).alias("_held"))
    zero = F.lit(0).cast("long")
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.element_at(F.col("_held"), s), zero))
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("shards"))

    def step(state: Column, slot: Column) -> Column:
        at = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        heavier = F.transform(state["loads"], lambda x, i: F.when(i + 1 == at, x - slot["_b"]).otherwise(x))
        return F.struct(heavier.alias("loads"), F.concat(state["shards"], F.array(at - 1)).alias("shards"))

    dealt = gathered.select("_order", F.aggregate("_order", start, step)["shards"].alias("_to"))
    return dealt.select(F.explode(F.arrays_zip(F.col("_order.vslot").alias("vslot"), F.col("_to").alias("shard"))).alias("_m")).select(
        "_m.vslot", "_m.shard"
    )


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: version, vslot, shard."""
    return _deal(sizes, shards).select(F.lit(1).alias("version"), "vslot", "shard")


def rebalance(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for new slot sizes or another number of shards.

    A shard keeps slots, in a fixed order, while they fit its share; the rest, and the slots of shards that are no
    more, are dealt to the lightest shards.
    """
    placed = slot_map.join(F.broadcast(sizes), "vslot")
    share = placed.agg((F.sum("bytes") / shards).alias("_share"))  # one row
    running = Window.partitionBy("shard").orderBy(F.xxhash64("vslot"), "vslot")  # slots of one shard
    judged = placed.crossJoin(F.broadcast(share)).withColumn("_sum", F.sum("bytes").over(running))
    judged = materialize(judged.withColumn("_stays", (F.col("shard") < shards) & (F.col("_sum") <= F.col("_share"))), "slot-moves")
    kept = judged.where("_stays")
    loads = kept.groupBy("shard").agg(F.sum("bytes").alias("_b"))
    by_shard = loads.agg(F.map_from_entries(F.collect_list(F.struct("shard", "_b"))).alias("_loads"))  # one row
    moved = _deal(judged.where("not _stays").crossJoin(F.broadcast(by_shard)), shards, "_loads")
    version = slot_map.agg((F.max("version") + 1).cast("int").alias("version"))
    both = kept.select("vslot", "shard").unionByName(moved)
    return both.crossJoin(F.broadcast(version)).select("version", "vslot", "shard")


def latest_version(spark: SparkSession, path: str) -> int:
    """The latest version of the map stored at ``path``, 0 if there is none."""
    try:
        return spark.read.schema(MAP_SCHEMA).parquet(path).agg(F.max("version")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add a version of the map to the table at ``path``. A version that is not later than all stored ones is an error."""
    spark = slot_map.sparkSession
    latest, given = latest_version(spark, path), slot_map.agg(F.min("version")).first()[0]
    if given is not None and given <= latest:
        raise ValueError(f"version {given} of the slot map is not later than version {latest}, which is stored")
    slot_map.write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the latest by default."""
    wanted = version if version is not None else latest_version(spark, path)
    return spark.read.schema(MAP_SCHEMA).parquet(path).where(F.col("version") == wanted)


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The shard of each record and its number within the shard, gapless from 0."""
    buckets = shuffle_partitions(rows.sparkSession)
    placed = rows.join(F.broadcast(slot_map.select("vslot", "shard")), "vslot").withColumn(  # one row for each slot
        "_bucket", F.pmod(F.xxhash64("text_crc32", "doc_id", "vslot"), F.lit(buckets)).cast("int")
    )
    counts = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("_i", F.row_number().over(within))
    return numbered.join(offsets, ["shard", "_bucket"]).select(
        "doc_id", "size", "text_crc32", "vslot", "shard", (F.col("_before") + F.col("_i") - 1).cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Place all documents by the map at ``map_path`` (a new shared folder by default).

    Where a map is stored already, it is edited for the new sizes and stored as its next version.
    """
    spark = docs.sparkSession
    rows = materialize(records(docs, slots), "slot-records")
    path = map_path or scratch_path(spark, "slot-map")
    sizes = slot_bytes(rows, slots)
    stored = map_path is not None and latest_version(spark, path) > 0
    # The next version is written beside the table that it is read from, before it is added to it.
    following = materialize(rebalance(load_map(spark, path), sizes, shards), "slot-map-next") if stored else first_map(sizes, shards)
    store_map(following, path)
    return place(rows, load_map(spark, path))
