"""Dataset summaries and digests: coverage, latency tables, standardisation, content identity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import hashing
from evalspark.functions import scoring as sx
from evalspark.operators import ordering
from evalspark.session import materialise

# Upper edges of the latency report's list-size bands.
SIZE_BANDS = (64, 128, 256, 512, 1024, 2048, 4096)
QUANTILES = {"median": 0.5, "p95": 0.95}


def coverage(roots: DataFrame) -> DataFrame:
    """One row: roots, distinct games, roots per split and side, ply quantiles.

    The selection is written once, narrowed to what is counted. Games are counted per distinct
    game first, so the split hash is evaluated once per game."""
    roots = materialise(roots.select("game_id", "ply", "side"), "root-coverage")
    per_game = roots.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("side") == "w").alias("w"),
        F.count_if(F.col("side") == "b").alias("b"),
    )
    per_game = per_game.withColumn("split", hashing.split_for("game_id"))
    out = per_game.agg(
        F.sum("n").alias("roots"),
        F.count(F.lit(1)).alias("games"),
        *[
            F.sum(F.when(F.col("split") == s, F.col("n")).otherwise(0)).alias(s)
            for s in hashing.SPLITS
        ],
        F.sum("w").alias("side_w"),
        F.sum("b").alias("side_b"),
    )
    ply = ordering.nearest_rank(roots, [], "ply", QUANTILES)
    names = ("min", "median", "p95", "max")
    return out.withColumn("_ply", ordering.one_row(ply)).select(
        *out.columns, *[F.col("_ply")[name].alias(f"ply_{name}") for name in names]
    )


def sample_summary(samples: DataFrame, key: list[str], value: str) -> DataFrame:
    """min, nearest-rank median and p95, max of a samples table per key."""
    return ordering.nearest_rank(samples, key, value, QUANTILES)


def size_band(size: Column, edges=SIZE_BANDS) -> Column:
    """Upper edge of the band holding `size`; null means above the last edge."""
    band = F.lit(None).cast("int")
    for edge in reversed(edges):
        band = F.when(size <= edge, F.lit(edge)).otherwise(band)
    return band


def latency_bands(samples: DataFrame, size: str, columns: list[str], edges=SIZE_BANDS) -> DataFrame:
    """Per size band: rows, mean size, nearest-rank median of every column, and the median of the
    last column per item."""
    banded = samples.withColumn("band", F.coalesce(size_band(F.col(size), edges), F.lit(0)))
    out = banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(size).alias("mean_size")
    )
    for c in columns:
        median = ordering.nearest_rank(banded.select("band", c), ["band"], c, {"median": 0.5})
        out = out.join(median.select("band", F.col("median").alias(f"{c}_median")), "band")
    return out.withColumn("per_item", F.col(f"{columns[-1]}_median") / F.col("mean_size"))


def extreme_cases(samples: DataFrame, key: str, size: str, cost: str) -> DataFrame:
    """(case, key, size, cost): the widest row and the one at the nearest-rank median size; the
    smallest key decides between equals."""
    middle = ordering.nearest_rank(samples, [], size, {"median": 0.5}).select("median").scalar()
    at = samples.withColumn("_middle", middle)
    row = F.struct(F.col(key).alias("key"), F.col(size).alias("size"), F.col(cost).alias("cost"))
    both = at.agg(
        F.min(F.struct((-F.col(size)).alias("o"), row.alias("r"))).alias("w"),
        F.min(F.when(F.col(size) == F.col("_middle"), row)).alias("m"),
    )
    cases = F.array(
        F.struct(F.lit("widest").alias("case"), F.col("w.r").alias("r")),
        F.struct(F.lit("median").alias("case"), F.col("m").alias("r")),
    )
    return both.select(F.inline(cases)).select("case", "r.key", "r.size", "r.cost")


def extraction_overhead(
    costs: DataFrame, baseline: str, probe: str = "probe", schema: str = "schema",
    value: str = "median_us",
) -> DataFrame:
    """(probe, schema, overhead): cost relative to the baseline schema on the same probe."""
    base = costs.where(F.col(schema) == baseline).select(probe, F.col(value).alias("_base"))
    return (
        costs.where(F.col(schema) != baseline)
        .join(base, probe)
        .select(probe, schema, sx.relative_overhead(F.col(value), F.col("_base")).alias("overhead"))
    )


def overhead_gate(overheads: DataFrame, limit: float = 0.1, schema: str = "schema") -> DataFrame:
    return overheads.groupBy(schema).agg(
        F.count(F.lit(1)).alias("probes"),
        F.avg("overhead").alias("mean_overhead"),
        F.max("overhead").alias("max_overhead"),
    ).withColumn("cleared", F.col("mean_overhead") <= limit)


def column_statistics(train: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, scale): population statistics of the train rows; zero or non-finite scales
    become one."""
    sums = []
    for i, c in enumerate(columns):
        sums += [
            F.avg(F.col(c).cast("double")).alias(f"m{i}"),
            F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"m{i}").alias("mean"),
            F.when(sx.finite(F.col(f"s{i}")) & (F.col(f"s{i}") > 0), F.col(f"s{i}"))
            .otherwise(1.0)
            .alias("scale"),
        )
        for i, c in enumerate(columns)
    ]
    return train.agg(*sums).select(F.inline(F.array(*entries)))


#: A row digest is summed as so many whole numbers of 32 bits.
LANES = 8


def row_body(df: DataFrame, names: list[str]) -> Column:
    """A row as JSON text, in the order of `names`."""
    kinds = dict(df.dtypes)
    cells = [F.hex(F.col(c)) if kinds[c] == "binary" else F.col(c).alias(c) for c in names]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def digest_tree(
    df: DataFrame, key: str, columns: list[str] | None = None, depth: int = 3, spread: int = 0
) -> DataFrame:
    """(level, path, digest, rows): a Merkle tree over the table, one row per node, level 0 the root.

    A row's path is the first `depth` digits of the SHA-256 of its key, then `spread` digits of the
    SHA-256 of the row; `spread` cuts the leaf of a key that holds a large part of the rows. A leaf's
    digest is the SHA-256 of its rows' digests with their counts, in sorted order; a node's that of
    its children's digits and digests. So it does not depend on row order, layout or column order,
    repeated rows count, and edits cannot cancel out as they can in a sum. Equal rows are counted
    before a leaf is gathered, so a leaf holds rows / 16 ** (depth + spread) digests. The root of an
    empty table is the digest of nothing. A null key is the text `null`.
    """
    names = sorted(columns or df.columns)
    row = F.sha2(row_body(df, names), 256).alias("row")
    place = F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("null")), 256).alias("place")
    each = df.select(place, row)
    path = F.concat(F.substring("place", 1, depth), F.substring("row", 1, spread))
    counted = each.groupBy(path.alias("path"), "row").agg(F.count(F.lit(1)).alias("n"))

    def folded(rows: DataFrame, at: Column, entry: Column, n: str) -> DataFrame:
        body = F.concat_ws(",", F.sort_array(F.collect_list(entry)))
        found = rows.groupBy(at.alias("path")).agg(F.sha2(body, 256).alias("digest"), F.sum(n).alias("rows"))
        return materialise(found, "digest-tree")

    entry = F.concat_ws(":", "row", F.col("n").cast("string"))
    level = depth + spread
    nodes = [folded(counted, F.col("path"), entry, "n")]
    for short in range(level - 1, 0, -1):
        child = F.concat_ws(":", F.substring("path", -1, 1), "digest")
        nodes.append(folded(nodes[-1], F.substring("path", 1, short), child, "rows"))
    body = F.concat_ws(",", F.sort_array(F.collect_list(F.concat_ws(":", F.substring("path", -1, 1), "digest"))))
    root = nodes[-1].agg(F.sha2(body, 256).alias("digest"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    parts = [root.select(F.lit(0).alias("level"), F.lit("").alias("path"), "digest", "rows")]
    parts += [t.select(F.lit(i).alias("level"), "path", "digest", "rows") for i, t in zip(range(level, 0, -1), nodes)]
    return reduce(DataFrame.unionByName, parts)


def tree_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(level, path, rows_a, rows_b): the leaves in which two trees of one shape differ, found by
    descent: a level looks only at children of nodes that differ. No rows: equal tables."""
    a, b = materialise(a, "digest-tree"), materialise(b, "digest-tree")
    depth = max(a.agg(F.max("level")).first()[0], b.agg(F.max("level")).first()[0])
    open_ = None
    for level in range(depth + 1):
        x, y = (t.where(F.col("level") == level).drop("level") for t in (a, b))
        if open_ is not None:
            parent = F.substring("path", 1, level - 1)
            x, y = (t.join(open_, parent.eqNullSafe(F.col("parent")), "left_semi") for t in (x, y))
        both = x.select("path", F.col("digest").alias("da"), F.col("rows").alias("rows_a")).join(
            y.select("path", F.col("digest").alias("db"), F.col("rows").alias("rows_b")), "path", "full"
        )
        found = both.where(~F.col("da").eqNullSafe(F.col("db")))
        open_ = materialise(found.select(F.col("path").alias("parent")), "open-nodes")
    return found.select(
        F.lit(depth).alias("level"), "path", F.coalesce("rows_a", F.lit(0)).alias("rows_a"), F.coalesce("rows_b", F.lit(0)).alias("rows_b")
    )


def content_digest(
    df: DataFrame, columns: list[str] | None = None, metadata: dict[str, str] | None = None
) -> DataFrame:
    """(digest, rows): identity of a table's contents, independent of file layout, row order and
    column order; repeated rows count.

    Each row's SHA-256 is read as LANES numbers, and these are summed over all rows: one partial
    aggregate of fixed width for a table of any size. The digest is the SHA-256 of a label (table
    metadata, then column names and types) and the sums. It finds losses and edits; it is no
    signature against rows forged to cancel out.
    """
    names = sorted(columns or df.columns)
    kinds = dict(df.dtypes)
    body = row_body(df, names)
    label = "|".join(f"{k}={v}" for k, v in sorted((metadata or {}).items()))
    label += "||" + ",".join(f"{c}:{kinds[c]}" for c in names)
    lanes = [
        F.conv(F.substring("_d", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)") for i in range(LANES)
    ]
    sums = [F.coalesce(F.sum(x), F.lit(0)).cast("string").alias(f"s{i}") for i, x in enumerate(lanes)]
    totals = df.select(F.sha2(body, 256).alias("_d")).agg(F.count(F.lit(1)).alias("rows"), *sums)
    parts = [F.lit(label), F.col("rows").cast("string"), *[f"s{i}" for i in range(LANES)]]
    return totals.select(F.sha2(F.concat_ws("|", *parts), 256).alias("digest"), "rows")


def key_set_digest(df: DataFrame, key: str) -> DataFrame:
    """(digest, rows): identity of the distinct values of one key column."""
    return content_digest(df.select(key).distinct(), [key])


def combined_digest(parts: DataFrame, digest: str = "digest") -> DataFrame:
    """(digest, parts): digest of a table of digests, one row per shard or table."""
    return content_digest(parts, [digest]).withColumnRenamed("rows", "parts")


def hash_collisions(df: DataFrame, identity: str, full: str) -> DataFrame:
    """Identities shared by more than one full value (a truncated hash that collided)."""
    return (
        df.groupBy(identity)
        .agg(F.min(full).alias("lo"), F.max(full).alias("hi"))
        .where(F.col("lo") != F.col("hi"))
    )
