"""Scans. Each one checks names and types before any row is read; row rules are separate
violation tables (operators.validation)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.operators import keys, summaries
from evalspark.operators.validation import (
    Refused,
    bundle_rules,
    metadata_rules,
    require_clean,
    require_layout,
    violations,
)
from evalspark.session import materialise
from evalspark.sources import schemas


def require_schema(df: DataFrame, expected: T.StructType, what: str) -> DataFrame:
    """Names and exact types must be present; nullability is a row rule, because file readers
    relax it. Returns the expected columns in order."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in actual:
            problems.append(f"missing {f.name}")
        elif actual[f.name] != f.dataType:
            problems.append(
                f"{f.name} is {actual[f.name].simpleString()}, expected {f.dataType.simpleString()}"
            )
    if problems:
        raise Refused(f"{what} refused: " + "; ".join(problems))
    return df.select(*expected.names)


def positions(spark: SparkSession, *paths: str, version: str | None = None) -> DataFrame:
    """Position shards of one or more directories. Every file must have all columns in their exact
    types; with `version`, every file's footer must carry it."""
    df = require_schema(spark.read.parquet(*paths), schemas.POSITION, "position shards")
    for variant in file_layouts(spark, *paths).collect():
        problems = [
            f"missing {f.name}" if f.name not in variant.columns
            else f"{f.name} is {variant.columns[f.name]} in a file"
            for f in schemas.POSITION.fields
            if variant.columns.get(f.name) != ARROW_NAMES[f.dataType.simpleString()]
        ]
        if problems:
            raise Refused("position shards refused: " + "; ".join(problems))
    if version is not None:
        bad = footers(spark, *paths).where(
            ~F.coalesce(F.try_element_at("metadata", F.lit("schema_version")) == version, F.lit(False))
        )
        if not bad.isEmpty():
            raise Refused("position shards refused: unknown schema version")
    return df


def with_ordinal(df: DataFrame) -> DataFrame:
    """Attach the encounter order of a file scan: (file name, row index) as one comparable
    struct `ordinal`."""
    return df.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("ordinal"))


def export(spark: SparkSession, *paths: str) -> DataFrame:
    """Header CSV, plain or gzip. Columns are found by name, whatever their order, which must be
    the same in all files: every file's own header is compared when it is read, and one that
    differs fails the job. A value that does not parse becomes null and is caught by the row
    rules."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(list(paths))
    missing = [c for c in schemas.EXPORT_COLUMNS if c not in raw.columns]
    if missing:
        raise Refused(f"export refused: missing {missing}")
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.EXPORT.fields]
    )


def export_rules():
    return {
        "result_domain": F.col("result").isNull()
        | ~F.col("result").isin(*schemas.WHITE_RESULTS),
    }


def to_positions(export_df: DataFrame) -> DataFrame:
    """White's point of view becomes the mover's; the roll is upper-cased."""
    white = (F.col("result") + 1) / 2
    return export_df.select(
        F.col("game_id").cast("string"),
        F.col("turn_number").cast("int").alias("ply"),
        "fen",
        F.upper("dice").alias("dice"),
        "side",
        F.when(F.col("side") == "b", 1 - white).otherwise(white).cast("float").alias("result"),
    )


# How a footer names the types of the position columns.
ARROW_NAMES = {"string": "string", "int": "int32", "float": "float"}
# Encodings of a string column that Spark reads as a string.
STRING_NAMES = ("large_string", "string_view")
ROW_METADATA = "org.apache.spark.sql.parquet.row.metadata"


def file_layouts(spark: SparkSession, *paths: str) -> DataFrame:
    """(columns, identity, files): the distinct layouts of all parquet files. `columns` maps names
    to types, `identity` is the stored row schema with its field metadata. A healthy table has one."""
    text = F.lit("string")
    plain = lambda k, v: F.when(v.isin(*STRING_NAMES) | v.rlike(r"^dictionary<values=(large_)?string"), text).otherwise(v)
    found = footers(spark, *paths).withColumn("columns", F.transform_values("columns", plain))
    layout = F.sort_array(F.map_entries("columns")).alias("layout")
    identity = F.try_element_at("metadata", F.lit(ROW_METADATA)).alias("identity")
    distinct = found.groupBy(layout, identity).agg(F.count(F.lit(1)).alias("files"))
    return distinct.select(F.map_from_entries("layout").alias("columns"), "identity", "files")


def footers(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, rows, metadata, columns): key/value metadata and column types of every file that a
    parquet scan of the paths reads, whatever its name, read by the executors.

    Only file listings and footers are touched; file contents are not loaded. Names that start with
    `_` or `.` are left out, as scans leave them out.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select("path")
    )

    def read(batches):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                system, inner = pafs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as handle:
                    opened = pq.ParquetFile(handle)
                    footer = opened.metadata
                    columns = {f.name: str(f.type) for f in opened.schema_arrow}
                pairs = {
                    k.decode(): v.decode("utf-8", "replace")
                    for k, v in (footer.metadata or {}).items()
                }
                out.append((path, footer.num_rows, pairs, columns))
            yield pd.DataFrame(out, columns=["path", "rows", "metadata", "columns"])

    ddl = "path string, rows long, metadata map<string,string>, columns map<string,string>"
    return listed.mapInPandas(read, ddl)


def metadata_violations(spark: SparkSession, expected: dict[str, str], *paths: str) -> DataFrame:
    return violations(footers(spark, *paths), metadata_rules(expected), "path")


def field_metadata(df: DataFrame) -> dict[str, str]:
    """Identity written by `writers.enriched`: metadata of the first field."""
    return dict(df.schema.fields[0].metadata or {})


def enriched(
    spark: SparkSession, *paths: str, columns=schemas.S0, expected: dict[str, str] | None = None
) -> DataFrame:
    """Enriched shards of one feature schema and engine. The identity is taken from the field
    metadata and must match exactly; so must the column layout, in every file."""
    df = spark.read.parquet(*paths)
    if len(file_layouts(spark, *paths).take(2)) > 1:
        raise Refused("enriched shards refused: files differ in identity or layout")
    actual = field_metadata(df)
    for k, v in (expected or {}).items():
        if actual.get(k) != v:
            raise Refused(f"enriched shards refused: {k} is {actual.get(k)!r}, expected {v!r}")
    return require_layout(df, columns)


def bundle(
    spark: SparkSession, path: str, expected: dict[str, str] | None = None
) -> tuple[DataFrame, dict]:
    """A rows bundle: `rows/` (JSON lines) with its `manifest/` record, judged as a whole: the
    manifest's identity against `expected`, its row count and digest against the rows found, every
    row rule, unique row ids, and one group per game and root. An empty bundle is refused. The JSON is
    parsed once: what is judged is what is returned."""
    manifest = spark.read.json(f"{path}/manifest").first()
    if manifest is None:
        raise Refused("bundle refused: no manifest")
    declared = manifest.asDict()
    for k, v in (expected or {}).items():
        if declared.get(k) != v:
            raise Refused(f"bundle refused: {k} is {declared.get(k)!r}, expected {v!r}")
    rows = bundle_stored(spark, path)
    judge_bundle(rows, declared, summaries.content_digest(rows).first())
    return rows, declared


def bundle_stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bundle, parsed once and stored; the checks and the caller read the same ones."""
    return materialise(spark.read.schema(schemas.ROWS).json(f"{path}/rows"), "bundle-rows")


def judge_bundle(rows: DataFrame, declared: dict, found: Row) -> None:
    """Action: the rows of a bundle, their count and digest as `found`, against its record and rules."""
    if found["rows"] == 0:
        raise Refused("bundle refused: no rows")
    if declared.get("rows") != found["rows"]:
        raise Refused(
            f"bundle refused: manifest says {declared.get('rows')} rows, found {found['rows']}"
        )
    if declared.get("rows_digest") != found["digest"]:
        raise Refused("bundle refused: rows differ from their digest")
    require_clean(violations(rows, bundle_rules(), "id"), "bundle")
    if not keys.duplicates(rows, ["id"]).isEmpty():
        raise Refused("bundle refused: duplicate row identity")
    if not keys.ownership(rows, "group_id", ["game_id", "root_id"]).isEmpty():
        raise Refused("bundle refused: a game or root crosses groups")


def rows_array(spark: SparkSession, path: str) -> DataFrame:
    """A small bundle kept as one JSON array per file. One task per file: convert at ingest."""
    return spark.read.schema(schemas.ROWS).option("multiLine", True).json(path)


def groups(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Nested candidate lists; they stay nested at rest."""
    return spark.read.schema(schemas.GROUPS).option("multiLine", multiline).json(path)


def flatten_groups(nested: DataFrame) -> DataFrame:
    """(group_id, game_id, cand_idx, moves, result_fen, features, target), a narrow generator."""
    return nested.select(
        "group_id", "game_id", "side", F.posexplode("candidates").alias("cand_idx", "c")
    ).select("group_id", "game_id", "side", "cand_idx", "c.*")


def group_counts(nested: DataFrame) -> DataFrame:
    """(groups, candidates) as found, for comparison with a producer record."""
    return nested.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.size("candidates")), F.lit(0)).cast("long").alias("candidates"),
    )


def admit_groups(nested: DataFrame, declared: dict[str, int]) -> DataFrame:
    """Action: the producer's counts must equal the data."""
    found = group_counts(nested).first().asDict()
    for k in ("groups", "candidates"):
        if declared.get(k) != found[k]:
            raise Refused(f"{k}: declared {declared.get(k)}, found {found[k]}")
    return nested


def probes(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(id, fen, side, tags, note, columns, features), one row per probe. `multiline` reads one
    object per file; otherwise one object per line, which splits."""
    doc = spark.read.schema(schemas.PROBES).option("multiLine", multiline).json(path)
    return doc.select("columns", F.explode("probes").alias("p")).select("p.*", "columns")


def probe_features(probe_rows: DataFrame) -> DataFrame:
    """(id, feature, value): the vector spelled out by its declared column names."""
    pairs = F.arrays_zip(F.col("columns").alias("feature"), F.col("features").alias("value"))
    return probe_rows.select("id", F.inline(pairs))


def cost_evidence(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(probe, fen, schema, min_us, median_us, p95_us, max_us) from the nested maps."""
    doc = spark.read.schema(schemas.COST_EVIDENCE).option("multiLine", multiline).json(path)
    per_probe = doc.select(F.explode("probes").alias("probe", "v"))
    per_schema = per_probe.select(
        "probe", "v.fen", F.explode("v.schemas").alias("schema", "m")
    )
    return per_schema.select("probe", "fen", "schema", "m.*")


def feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """(group_id, cand_idx, a, b, c, target, terminal, moves) from one list per line."""
    lines = spark.read.schema(schemas.FEATURE_LINES).json(path)
    return lines.select("group_id", F.posexplode("rows").alias("cand_idx", "r")).select(
        "group_id", "cand_idx", "r.*"
    )


def split_map(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """(group_id, split) from one JSON object per file, or per line."""
    text = spark.read.text(path, wholetext=whole)
    pairs = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return text.select(F.explode(pairs).alias("group_id", "split"))


def frozen_splits(cands: DataFrame, assigned: DataFrame, group: str = "group_id") -> DataFrame:
    """One row: assigned lists found, lists without a split, assignments without a list,
    assignments outside the allowed names, and lists assigned more than once."""
    found = cands.select(group).distinct().select(
        group, F.lit(None).cast("string").alias("split"), F.lit(1).alias("here")
    )
    both = found.unionByName(assigned.select(group, "split", F.lit(0).alias("here")))
    per = both.groupBy(group).agg(
        F.max("here").alias("here"),
        F.max("split").alias("split"),
        F.count_if(F.col("here") == 0).alias("times"),
    )
    return per.agg(
        F.count_if((F.col("here") == 1) & F.col("split").isNotNull()).alias("assigned"),
        F.count_if(F.col("split").isNull()).alias("unassigned"),
        F.count_if(F.col("here") == 0).alias("unknown_groups"),
        F.count_if(
            F.col("split").isNotNull() & ~F.col("split").isin(*schemas.FROZEN_SPLITS)
        ).alias("bad_split"),
        F.count_if(F.col("times") > 1).alias("repeated"),
    )
