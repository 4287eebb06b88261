"""Sharding by bytes, with DataFrame functions only.

Method: the documents are range partitioned by doc_id and stored, so that a row's place is its
partition and its row number in the file. Totals per partition give global prefix sums of bytes and
rows; cutting these at equal targets gives contiguous shards of equal size. Only the chunks of rows
that contain a cut are looked at row by row; all other rows get their shard from their partition.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.rows import put_back, set_aside
from evalspark.session import materialise

#: Added to the UTF-8 bytes of each text.
OVERHEAD = 16
CHUNK_ROWS = 1024


def shard_by_bytes(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with size (bytes of the text and 16), text_crc32, shard (0 to `shards` - 1)
    and slot (place in the shard, gapless from 0), in the order of doc_id, size and checksum.

    A document belongs to the shard in which its middle byte falls, so a shard is off the equal
    target by less than one document. Null texts have 16 bytes. A null doc_id comes first; rows
    equal in doc_id, size and checksum may change places. With fewer documents than shards some
    shards stay empty; an empty table gives no rows. Columns of `docs` named like a result are
    replaced, all others kept, whatever their names.
    """
    results = ("size", "text_crc32", "shard", "slot")
    kept = docs.drop(*results).columns
    rows = docs.count()
    # As many partitions as a sixteenth of the square root: their number and their size both stay small.
    ranges = max(1, ceil(sqrt(rows) / 4))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sized = docs.select(
        *set_aside(kept),
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + OVERHEAD).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    order = ("doc_id", "size", "text_crc32")
    placed = sized.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("doc_id")
    staged = materialise(placed.withColumn("_part", F.spark_partition_id()), "shards")
    at = staged.select("*", F.col("_metadata.row_index").alias("_row"))
    chunk = F.expr(f"_row div {CHUNK_ROWS}").alias("chunk")
    chunks = at.groupBy(F.col("_part").alias("part"), chunk).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    chunks = materialise(chunks, "chunks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = chunks.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    zero = F.lit(0).cast("long")
    parts = materialise(
        parts.select(
            "part",
            F.coalesce(F.sum("bytes").over(before), zero).alias("part_bytes"),
            F.coalesce(F.sum("rows").over(before), zero).alias("part_rows"),
            F.sum("bytes").over(Window.partitionBy()).alias("total"),
        ),
        "parts",
    )
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.join(parts, "part").withColumn("begin", F.col("part_bytes") + F.coalesce(F.sum("bytes").over(inside), zero))
    # The shard in which a byte falls; half bytes, as the middle of a document may be one.
    low = F.expr(f"(2 * begin * {shards}) div (2 * total)")
    high = F.expr(f"(2 * (begin + bytes) * {shards} - 1) div (2 * total)")
    chunks = chunks.withColumns({"low": low, "high": high})
    whole = chunks.where("low = high").select("part", F.expr(f"chunk * {CHUNK_ROWS}").alias("row"), F.col("low").alias("shard"), "part_rows")
    cut = chunks.where("low < high").select("part", "chunk", "begin", "total", "part_rows")
    rows_in = at.select(F.col("_part").alias("part"), chunk, F.col("_row").alias("row"), "size").join(cut, ["part", "chunk"])
    run = Window.partitionBy("part", "chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("begin") + F.coalesce(F.sum("size").over(run), zero)
    rows_in = rows_in.withColumn("start", start)
    middle = F.expr(f"((2 * start + size) * {shards}) div (2 * total)")
    rows_in = rows_in.select("part", "row", middle.alias("shard"), "part_rows")
    # The first row of each shard; all later rows of the partition belong to it until the next cut.
    first = whole.union(rows_in).groupBy("shard").agg(F.min(F.struct("part", "row", "part_rows")).alias("at"))
    first = first.select("at.part", "at.row", F.struct(F.col("shard"), (F.col("at.part_rows") + F.col("at.row")).alias("first")).alias("begins"))
    cuts = first.groupBy("part").agg(F.collect_list(F.struct("row", "begins")).alias("cuts"), F.max("begins").alias("latest"))
    plan = parts.join(cuts, "part", "left").select(
        F.col("part").alias("_part"),
        "part_rows",
        F.coalesce("cuts", F.array().cast("array<struct<row: bigint, begins: struct<shard: bigint, first: bigint>>>")).alias("cuts"),
        F.max("latest").over(before).alias("earlier"),
    )
    mine = F.expr("array_max(transform(filter(cuts, c -> c.row <= _row), c -> c.begins))")
    # One row per partition: the square root of the documents, at most.
    found = at.join(F.broadcast(plan), "_part").withColumn("mine", F.coalesce(mine, "earlier"))
    return found.select(
        *put_back(kept),
        "size",
        "text_crc32",
        F.col("mine.shard").cast("int").alias("shard"),
        (F.col("part_rows") + F.col("_row") - F.col("mine.first")).alias("slot"),
    )
