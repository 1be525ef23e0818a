"""Operator 9: sharding by fixed virtual slots and a versioned slot map.

Every record is hashed by its id and its text's checksum and size into one of
``slots`` virtual slots, whose number never changes.  The bytes of each slot
are summed (map-side combined), and a slot-to-shard map is stored as a table
with a version column: version 1 gives each slot, heaviest first, to the
lightest shard; a rebalancing adds the next version with as few slots moved as
level the shards again.  The law that holds is ``bytes``: the shards' sizes are
near equal.

Rows equal in id and text share a slot, which can't be cut by what they hold.
A slot of several rows that has more than a ``HEAVY``-th of all bytes is marked
so in the map (it has no shard), and its rows are dealt out over as many spare
slots by a salt that is written with the records.

Only the map (twice ``slots`` rows, a fixed bound) is folded in one row; records are
joined to it by broadcast and never gathered.  A row's place in its shard is
its place in its sub-slot plus the counts of the sub-slots before it, so no
window spans a shard; sub-slots cut a virtual slot by the text's hash.

Defined cases: a null id counts as the empty text; null text has size 1 and
checksum 0; repeated rows are placed one by one; rows that tie in slot, id and
text take consecutive places; extra columns are ignored; an empty table gives
an empty result and a map of zero bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.runtime import saved, shared_folder

SLOTS = 4096
SUB_SLOTS = 8
SHARDS = 16
#: A slot with more than this share (1 / HEAVY) of all bytes is heavy.
HEAVY = 512


def virtual_slot(doc_id: str = "doc_id", slots: int = SLOTS) -> Column:
    """By id, checksum and size (columns ``text_crc32`` and ``size``)."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "text_crc32", "size"), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes) for each of the slots, zero for empty ones."""
    spark = records.sparkSession
    own = records.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(own, "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def first_map(weights: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map: heaviest slot first, each to the lightest shard
    (the lowest number of those that tie)."""
    packed = weights.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("w"), "vslot"))).alias("s"))
    loads = "transform(sequence(1, {n}), i -> 0L)".format(n=shards)
    folded = packed.selectExpr("s", f"""
        aggregate(s, named_struct('load', {loads}, 'to', cast(array() as array<int>)), (acc, x) ->
            named_struct(
              'load', transform(acc.load, (l, i) -> if(i + 1 = array_position(acc.load, array_min(acc.load)), l - x.w, l)),
              'to', concat(acc.to, array(cast(array_position(acc.load, array_min(acc.load)) - 1 as int)))
            )).to AS to""")
    return (folded.select(F.explode(F.arrays_zip("s", "to")).alias("z"))
            .select(F.lit(1).alias("version"), F.col("z.s.vslot").alias("vslot"), F.col("z.to").alias("shard"),
                    (-F.col("z.s.w")).alias("bytes")))


def rebalanced_map(current: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version: slots keep their shard while it stays within the mean
    (counted lightest slot first); the others, and those of shards that are no
    more, go heaviest first to the lightest shard."""
    newest = current.agg(F.max("version").alias("v"))
    old = (current.join(F.broadcast(newest), current.version == F.col("v"))
           .select("vslot", "shard", "v").join(F.broadcast(weights), "vslot"))
    mean = F.broadcast(weights.agg((F.sum("bytes") / F.lit(shards)).alias("mean")))
    run = Window.partitionBy("shard").orderBy("bytes", "vslot").rowsBetween(Window.unboundedPreceding, 0)
    stays = (F.col("shard") < shards) & (F.sum("bytes").over(run) <= F.col("mean"))
    marked = old.join(mean, F.col("mean") >= 0, "left").withColumn("stays", F.coalesce(stays, F.lit(True)))
    packed = marked.agg(
        F.first("v").alias("v"),
        F.collect_list(F.when(F.col("stays"), F.struct("vslot", "shard", "bytes"))).alias("kept"),
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("w"), "vslot")))).alias("s"))
    folded = packed.selectExpr("v", "kept", "s", f"""
        aggregate(s, named_struct(
              'load', transform(sequence(0, {shards - 1}), i -> aggregate(kept, 0L, (a, k) -> a + if(k.shard = i, k.bytes, 0L))),
              'to', cast(array() as array<int>)), (acc, x) ->
            named_struct(
              'load', transform(acc.load, (l, i) -> if(i + 1 = array_position(acc.load, array_min(acc.load)), l - x.w, l)),
              'to', concat(acc.to, array(cast(array_position(acc.load, array_min(acc.load)) - 1 as int)))
            )).to AS to""")
    moved = F.transform(F.arrays_zip("s", "to"), lambda z: F.struct(
        z["s"]["vslot"].alias("vslot"), z["to"].alias("shard"), (-z["s"]["w"]).alias("bytes")))
    return (folded.select((F.col("v") + 1).alias("version"), F.explode(F.concat("kept", moved)).alias("z"))
            .select("version", "z.vslot", "z.shard", "z.bytes"))


def store_map(table: DataFrame, path: str) -> None:
    """Append a version to the stored map."""
    table.coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version (the newest by default): (vslot, shard), a row per slot;
    heavy slots have no shard."""
    stored = spark.read.parquet(path)
    want = version or stored.agg(F.max("version")).head()[0]
    return stored.filter(F.col("version") == want).select("vslot", "shard", "version")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The narrow facts of each row: id, size, checksum, virtual slot, and a
    salt that tells equal rows apart."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    facts = docs.select("doc_id", (F.octet_length(data) + F.lit(1)).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    return facts.withColumn("vslot", virtual_slot("doc_id", slots)).withColumn("salt", F.monotonically_increasing_id())


def heavy_slots(rec: DataFrame) -> DataFrame:
    """(vslot) of the slots to be dealt out again: fewer than ``HEAVY``."""
    own = rec.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    whole = F.broadcast(rec.agg((F.sum("size") / F.lit(HEAVY)).alias("most")))
    return own.join(whole, (F.col("n") > 1) & (F.col("bytes") > F.col("most"))).select("vslot")


def dealt(rec: DataFrame, heavy: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Records of heavy slots go to the spare slots, by their salt."""
    few = F.broadcast(heavy.withColumn("heavy", F.lit(True)))
    spare = F.lit(slots) + F.pmod(F.xxhash64("vslot", "salt"), F.lit(slots)).cast("int")
    return rec.join(few, "vslot", "left").withColumn("vslot", F.when(F.col("heavy"), spare).otherwise(F.col("vslot"))).drop("heavy")


def assign(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
           map_path: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, slot): ``slot`` is the
    row's place in its shard, gapless from 0.  The map is taken from
    ``map_path`` if it holds one; else version 1 is made and stored."""
    rec = saved(spark, records(docs, slots), "records")
    if map_path is None:
        map_path = shared_folder(spark, "slot-map")
        heavy = saved(spark, heavy_slots(rec), "heavy-slots")
        one = first_map(slot_bytes(dealt(rec, heavy, slots), 2 * slots), shards)
        marked = one.join(F.broadcast(heavy.withColumn("heavy", F.lit(True))), "vslot", "left")
        store_map(marked.select("version", "vslot", F.when(F.col("heavy").isNull(), F.col("shard")).alias("shard"), "bytes"), map_path)
    where = load_map(spark, map_path)
    rec = dealt(rec, where.filter("shard IS NULL").select("vslot"), slots)
    sub = F.pmod(F.xxhash64("text_crc32", "size"), F.lit(SUB_SLOTS)).cast("int")
    rec = rec.withColumn("sub", sub)
    # 2 x slots x SUB_SLOTS counts at most: a fixed bound, summed up in order.
    counts = rec.groupBy("vslot", "sub").count().join(F.broadcast(where), "vslot")
    per_slot = counts.groupBy("shard", "vslot").agg(F.sum("count").alias("n"))
    before_slot = per_slot.select("vslot", (F.sum("n").over(Window.partitionBy("shard").orderBy("vslot")) - F.col("n")).alias("slot_base"))
    before_sub = counts.select("vslot", "sub", "shard", (F.sum("count").over(Window.partitionBy("vslot").orderBy("sub")) - F.col("count")).alias("sub_base"))
    base = before_sub.join(before_slot, "vslot").select("vslot", "sub", "shard", (F.col("slot_base") + F.col("sub_base")).alias("base"))
    place = F.row_number().over(Window.partitionBy("vslot", "sub").orderBy("doc_id", "text_crc32", "size", "salt")) - 1
    numbered = rec.withColumn("place", place)
    return (numbered.join(F.broadcast(base), ["vslot", "sub"])
            .select("doc_id", "size", "text_crc32", F.col("vslot").alias("virtual_slot"), F.col("shard"),
                    (F.col("base") + F.col("place")).cast("long").alias("slot")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return (assign(spark, docs).withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot"))
