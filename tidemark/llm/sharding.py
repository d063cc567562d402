"""Contiguous shards of equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import stage

#: Bytes of a row besides its text.
ROW_BYTES = 8


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row of docs.

    The rows in the order of doc_id are cut where the bytes before a row reach the next of
    `shards` equal targets, so a shard is a range of doc_id and differs from the mean by less
    than its last row.  Rows of one doc_id, repeated rows too, are ordered by checksum and size
    and may be cut apart; a null doc_id comes first; a null text has size 8 and checksum 0.  An
    empty table gives no rows.  Other columns of docs are left out.

    The order is by range partitions of narrow rows, staged with the number of their partition.
    Only the totals of the partitions, a row each, are summed up in one task and broadcast:
    their number is that of the shuffle partitions, however many documents there are.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(docs["text"], F.lit(""))
    narrow = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    keys = ["doc_id", "text_crc32", "size", "row"]
    ranged = stage(
        narrow.repartitionByRange(partitions, *keys)
        .select("*", F.spark_partition_id().alias("part")),
        "ranged",
    )
    parts = ranged.groupBy("part").agg(F.sum("size").alias("bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*keys)
    start = F.col("start") + F.coalesce(
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = ranged.join(F.broadcast(starts), "part").withColumn(
        "shard", F.floor(start.cast("decimal(38,0)") * shards / F.col("total")).cast("int")
    )
    # The slot in the shard: rows of the shard in earlier partitions, then those before in this one.
    placed = stage(
        placed.withColumn("rank", F.row_number().over(Window.partitionBy("part", "shard").orderBy(*keys))),
        "placed",
    )
    counts = placed.groupBy("part", "shard").agg(F.count("*").alias("rows"))
    earlier = counts.select(
        "part",
        "shard",
        F.coalesce(
            F.sum("rows").over(
                Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("earlier"),
    )
    return placed.join(F.broadcast(earlier), ["part", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("earlier") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
