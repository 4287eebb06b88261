"""Sinks. Data is written by the executors; only names and counts pass the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.operators import keys, ordering, shards, summaries, validation
from evalspark.operators.validation import Refused
from evalspark.session import materialise
from evalspark.sources import readers, schemas


# Rows that a task writes where the shards are many, and tasks up to which each may write one shard.
TASK_ROWS, SHARD_TASKS = 1 << 18, 64


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def publish(spark: SparkSession, staged: str, final: str) -> str:
    """Rename a complete staged directory into place; an existing target is refused."""
    fs, source = _filesystem(spark, staged)
    _, target = _filesystem(spark, final)
    if fs.exists(target):
        raise Refused(f"{final} already exists")
    if not fs.rename(source, target):
        raise Refused(f"could not publish {final}")
    return final


def position_shards(
    df: DataFrame, path: str, size: int, game: str = "game_id", ordinal: str = "ordinal"
) -> str:
    """Shards of about `size` rows that never split a game: rows grouped by game in
    first-appearance order, plies ordered. One directory per shard. The rows are range partitioned
    in that order, so a shard's files follow it too: one or two for usual shards, and as many as
    its rows need for a giant game, which no task has to write alone. Beyond SHARD_TASKS shards a
    task writes about TASK_ROWS rows, so tasks and the sample of the ranges do not grow with the
    number of shards."""
    placed = materialise(shards.sharded_rows(df, game, ordinal, size), "placed")
    order = ("shard", "start", "ply", ordinal)
    rows = placed.count()
    tasks = max(1, min(-(-rows // size), max(SHARD_TASKS, -(-rows // max(size, TASK_ROWS)))))
    (
        placed.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .drop("start", "stop", ordinal)
        .write.mode("errorifexists")
        .partitionBy("shard")
        .parquet(path)
    )
    return path


def bundle_rows(enriched: DataFrame, columns=schemas.S0) -> DataFrame:
    """The public row shape: id = game:ply, the group is the game, features in declared order."""
    return enriched.select(
        F.concat_ws(":", "game_id", F.col("ply").cast("string")).alias("id"),
        F.col("game_id").alias("group_id"),
        "game_id",
        F.lit(None).cast("string").alias("root_id"),
        "fen",
        "side",
        "ply",
        F.col("result").cast("double").alias("result"),
        F.array(*[F.col(c).cast("float") for c in columns]).alias("features"),
    )


def bundle(rows: DataFrame, path: str, record: dict[str, str]) -> dict:
    """Write rows and manifest to a staging directory, re-admit them by reading them back, then
    publish by rename. Rows are range-partitioned by (game, ply, id), so files follow the order."""
    spark = rows.sparkSession
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    if exists(spark, path):
        raise Refused(f"{path} already exists")
    rows.orderBy("game_id", "ply", "id").write.mode("errorifexists").json(f"{staged}/rows")
    stored = readers.bundle_stored(spark, staged)
    found = summaries.content_digest(stored).first()
    manifest = {**record, "rows": found["rows"], "rows_digest": found["digest"]}
    spark.createDataFrame([manifest]).repartition(1).write.json(f"{staged}/manifest")
    readers.judge_bundle(stored, spark.read.json(f"{staged}/manifest").first().asDict(), found)
    publish(spark, staged, path)
    return manifest


def enriched(df: DataFrame, path: str, columns, identity: dict[str, str]) -> str:
    """Base + feature columns as snappy parquet. The identity rides on the first field's metadata,
    which round-trips through the file schema; one that names other columns or another feature set
    than those written is refused."""
    named = identity.get("columns")
    if named is not None and named != ",".join(columns):
        raise Refused("enriched sink refused: identity names other columns")
    layout = schemas.FEATURE_SETS.get(identity.get("feature_schema"))
    if layout is not None and tuple(layout) != tuple(columns):
        raise Refused("enriched sink refused: feature schema has other columns")
    first, *rest = list(schemas.POSITION_COLUMNS)
    out = df.select(
        F.col(first).alias(first, metadata=identity),
        *rest,
        *[F.col(c).cast("float").alias(c) for c in columns],
    )
    out.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return path


def roots(df: DataFrame, path: str) -> str:
    """Header TSV in selection order; a separator inside a field refuses the whole file."""
    fields = ["game_id", "fen", "dice", "side"]
    validation.require_clean(
        validation.violations(df, validation.separator_rules(fields), "order_key"), "roots"
    )
    df.orderBy("order_key").select(*fields).write.mode("errorifexists").option(
        "sep", "\t"
    ).option("header", True).option("quote", "").csv(path)
    return path


def read_roots(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .schema("game_id string, fen string, dice string, side string")
        .csv(path)
    )


def fingerprint_lines(
    cands: DataFrame, fingerprint: str = "sha", group: str = "group_id", tie: str = "cand_idx",
    per_line: int = 4096,
) -> DataFrame:
    """(group_id, part, candidate_state_sha256): a list's fingerprints in candidate order. Lists
    longer than `per_line` continue on further lines, so no list has to fit one row."""
    numbered = ordering.row_numbers(cands.select(group, tie, fingerprint), [group], [tie], "_rn")
    part = F.floor((F.col("_rn") - 1) / per_line).cast("int")
    packed = numbered.groupBy(group, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_rn", fingerprint))).alias("_s")
    )
    return packed.select(
        group, "part", F.transform("_s", lambda x: x[fingerprint]).alias("candidate_state_sha256")
    )


def fingerprints(cands: DataFrame, path: str, **kw) -> str:
    fingerprint_lines(cands, **kw).write.mode("errorifexists").json(path)
    return path


def root_record(
    source: DataFrame, roots_df: DataFrame, rule: str, limit: int | None = None
) -> DataFrame:
    """One row: rows read, distinct roots, coverage of the selection, its digest and the rule."""
    roots_df = materialise(roots_df, "roots")
    chosen = roots_df if limit is None else materialise(keys.sample_roots(roots_df, limit), "sample")
    out = summaries.coverage(chosen)
    digest = summaries.content_digest(chosen.select("game_id", "fen", "dice", "side"))
    return (
        out.withColumn("rows_read", source.agg(F.count(F.lit(1)).alias("n")).scalar())
        .withColumn("distinct_roots", roots_df.agg(F.count(F.lit(1)).alias("n")).scalar())
        .withColumn("roots_digest", digest.select("digest").scalar())
        .withColumn("selection", F.lit(rule))
        .withColumn("limit", F.lit(limit).cast("long"))
    )


def record(df: DataFrame, path: str) -> str:
    df.repartition(1).write.mode("errorifexists").json(path)
    return path


def tidy(section: str, df: DataFrame, key: str | None, metrics: list[str]) -> DataFrame:
    """(section, key, metric, value) from a wide report."""
    name = F.col(key).cast("string") if key else F.lit("all")
    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ]
    return df.select(
        F.lit(section).alias("section"), name.alias("key"), F.inline(F.array(*entries))
    )


def report(tables: list[DataFrame], path: str, overwrite: bool = False) -> str:
    """All report sections as one tidy table; exclusive unless told otherwise."""
    keys.union_all(tables).repartition(1).write.mode(
        "overwrite" if overwrite else "errorifexists"
    ).parquet(path)
    return path
