"""Exact dedup as a stateful stream.

Method: the documents are streamed; a keyed state on disk (RocksDB, checkpointed in the shared
folder, never expired) retains for each digest the stable identifier of the row to keep, its
content locator (file and row) and the count. A later run with the same folder goes on from that
state. Groups with more than one row are hits: their full contents are read again and compared.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.session import materialise, scratch_path

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: without this each one reserves megabytes of disk ahead.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Bytes of files in one micro-batch.
BATCH_BYTES = 8 << 30


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: str):
    """The text without the six white-space characters; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", "")


def _rows(read: DataFrame, doc_id: str, text: str, *more) -> DataFrame:
    """What the state needs of each row: digest, size, identifier, locator."""
    return read.select(
        *more,
        F.sha2(normalised(text), 256).alias("digest"),
        F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("points"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


#: Smallest first: most code points, then the smallest doc_id (null last), then the locator.
BEST = "struct(-points AS less, doc_id IS NULL AS unnamed, doc_id, file, row)"


def streamed_state(spark: SparkSession, source: str, schema, doc_id: str, text: str, folder: str, batch: int) -> DataFrame:
    """Run the stream over all files not seen yet; (digest, n, best) of every digest so far."""

    def put(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    read = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch).parquet(source)
    state = _rows(read, doc_id, text).groupBy("digest").agg(F.count("*").alias("n"), F.min(F.expr(BEST)).alias("best"))
    with _settings(spark, ROCKSDB):
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(put)
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    changes = spark.read.parquet(f"{folder}/changes").drop("batch")
    # The state only grows, so the latest change of a digest has the largest count.
    return changes.groupBy("digest").agg(F.max("n").alias("n"), F.min("best").alias("best"))


def exact_dedup(
    spark: SparkSession,
    source: str,
    doc_id: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    batch: int = BATCH_BYTES,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text) of every row of
    the Parquet files at `source`. Equal are texts that agree without white space; the row with
    the most code points stays, then the smallest doc_id, then the first in file order.

    Null texts count as empty and are all equal. A null doc_id ranks last; it may be a keep_id if
    no other row is as long. Repeated rows are members of their group, one stays. Other columns are not
    read; files without rows give none. `folder` (a shared one, made if unset) holds the state:
    give it again to add new files without streaming the old ones once more. Texts whose digest
    agrees but whose bytes do not are told apart by their full contents.
    """
    batch_read = spark.read.parquet(source)
    folder = folder or scratch_path(spark, "exact-dedup")
    # A glob pattern, so that a single file can be streamed like a folder.
    path = source.rstrip("/")
    if not path.endswith("*"):
        path = f"{path[:-1]}[{path[-1]}]"
    state = streamed_state(spark, path, batch_read.schema, doc_id, text, folder, batch)
    state = materialise(state, "state")
    rows = materialise(_rows(batch_read, doc_id, text), "rows")
    found = rows.join(state, "digest").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.expr("file = best.file AND row = best.row").alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    # Full bytes of the hits: a group is equal if its least and its greatest contents are.
    hits = state.where("n > 1").select("digest")
    texts = batch_read.select(F.sha2(normalised(text), 256).alias("digest"), normalised(text).alias("body"))
    differ = (
        texts.join(hits, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
        .where("lo <> hi")
        .select("digest")
    )
    differ = materialise(differ, "collisions")
    if differ.isEmpty():
        return found
    clash = _rows(batch_read, doc_id, text, normalised(text).alias("body"))
    clash = clash.join(differ, "digest", "left_semi")
    best = clash.groupBy("digest", "body").agg(F.count("*").alias("n"), F.min(F.expr(BEST)).alias("best"))
    told = clash.join(best, ["digest", "body"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.expr("file = best.file AND row = best.row").alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    same = found.join(differ.withColumnRenamed("digest", "text_sha256"), "text_sha256", "left_anti")
    return same.select(told.columns).union(told)
