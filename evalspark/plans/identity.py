"""Keys, leakage, roots, shards, digests, sets (D1-D6, D13, E16, E20, E21, E25, F2-F4, F10, G, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import fen as fx
from evalspark.functions import hashing
from evalspark.operators import keys, ordering, ranking, scoring, shards, summaries
from evalspark.plans.expressions import KEY, P
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R

S = "WITH " + bridge.SCORED_SQL
KEYED = S + f", keyed AS (SELECT *, {KEY} AS key FROM scored)"


def keyed(spark, sf):
    return bridge.scored(spark, sf).withColumn("key", fx.position_key("fen"))


@query(
    "d1_exclude_seen",
    KEYED + """ SELECT row_id, key FROM keyed k WHERE split = 'test'
      AND NOT EXISTS (SELECT 1 FROM keyed t WHERE t.split = 'train' AND t.key = k.key)""",
)
def exclude_seen(spark, sf):
    rows = keyed(spark, sf)
    return keys.exclude_seen(
        rows.where("split = 'test'"), rows.where("split = 'train'"), "key"
    ).select("row_id", "key")


@query(
    "d1_exclude_seen_prefiltered",
    KEYED + """ SELECT row_id, key FROM keyed k WHERE split = 'test'
      AND NOT EXISTS (SELECT 1 FROM keyed t WHERE t.split = 'train' AND t.key = k.key)""",
)
def exclude_seen_prefiltered(spark, sf):
    """The same exclusion, the rows that are surely unseen not shuffled."""
    rows = keyed(spark, sf).select("row_id", "key", "split")
    return keys.exclude_seen_prefiltered(
        rows.where("split = 'test'"), rows.where("split = 'train'"), "key"
    ).select("row_id", "key")


@query(
    "d1_exclusion_counts",
    """WITH d AS (SELECT lower(trim(text)) AS key, lang FROM documents),
    seen AS (SELECT DISTINCT key FROM d WHERE lang = 'en')
    SELECT count(*)::BIGINT AS input_rows,
      count(*) FILTER (WHERE key IN (SELECT key FROM seen))::BIGINT AS removed_rows,
      count(*) FILTER (WHERE key NOT IN (SELECT key FROM seen))::BIGINT AS kept_rows FROM d""",
)
def exclusion_counts(spark, sf):
    docs = bridge.read(spark, sf, "documents").select(
        F.lower(F.trim("text")).alias("key"), "lang"
    )
    return keys.exclusion_counts(docs, docs.where("lang = 'en'"), "key")


@query(
    "d2_hold_out_games",
    """WITH games AS (SELECT DISTINCT o_custkey FROM orders), n AS (
      SELECT greatest(1, floor(count(*) * 0.2::DOUBLE))::BIGINT AS wanted FROM games), drawn AS (
      SELECT o_custkey, row_number() OVER (ORDER BY sha256('7|' || o_custkey::VARCHAR)) AS rn
      FROM games)
    SELECT CASE WHEN rn <= wanted THEN 'validation' ELSE 'train' END AS side,
      count(*)::BIGINT AS rows, count(DISTINCT o_custkey)::BIGINT AS games
    FROM orders JOIN drawn USING (o_custkey), n GROUP BY 1""",
)
def hold_out_games(spark, sf):
    rows = bridge.read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    train, validation = keys.hold_out_games(rows, "o_custkey", 0.2, 7)
    both = train.withColumn("side", F.lit("train")).unionByName(
        validation.withColumn("side", F.lit("validation"))
    )
    per_game = both.groupBy("side", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_game.groupBy("side").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("games")
    )


@query(
    "d3_exact_unseen",
    KEYED + """, train_keys AS (SELECT DISTINCT key FROM keyed WHERE split = 'train' AND y IN (0,1))
    SELECT row_id, key NOT IN (SELECT key FROM train_keys) AS unseen FROM keyed
    WHERE split = 'validation' AND y IN (0, 1)""",
)
def exact_unseen(spark, sf):
    rows = scoring.decisive(keyed(spark, sf), "y")
    return keys.mark_unseen(
        rows.where("split = 'validation'"), rows.where("split = 'train'"), "key"
    ).select("row_id", "unseen")


OVERLAP = """, per_key AS (SELECT key, bool_or(split='train') AS a, bool_or(split='validation') AS b,
  bool_or(split='test') AS c FROM keyed {where} GROUP BY key)
  SELECT 'train:validation' AS pair, count(*) FILTER (WHERE a AND b)::BIGINT AS shared FROM per_key
  UNION ALL SELECT 'train:test', count(*) FILTER (WHERE a AND c)::BIGINT FROM per_key
  UNION ALL SELECT 'validation:test', count(*) FILTER (WHERE b AND c)::BIGINT FROM per_key"""


@query("d4_overlap_all_rows", KEYED + OVERLAP.format(where=""))
def overlap_all(spark, sf):
    return keys.overlap_counts(keyed(spark, sf), "key")


@query("d4_overlap_decisive", KEYED + OVERLAP.format(where="WHERE y IN (0, 1)"))
def overlap_decisive(spark, sf):
    return keys.overlap_counts(scoring.decisive(keyed(spark, sf), "y"), "key")


@query(
    "d5_sealed_disjointness",
    KEYED + f""", sides AS (SELECT *, split = 'test' AS final,
      key || '|' || {bridge.ROLL_SQL.format('dice')} AS root,
      {bridge.GROUP_ID_SQL} AS group_id
      FROM keyed JOIN (SELECT row_id, dice FROM positions) USING (row_id))
    SELECT 'group' AS field, count(*)::BIGINT AS shared FROM (
      SELECT group_id FROM sides GROUP BY 1 HAVING bool_or(final) AND bool_or(NOT final))
    UNION ALL SELECT 'root', count(*)::BIGINT FROM (
      SELECT root FROM sides GROUP BY 1 HAVING bool_or(final) AND bool_or(NOT final))
    UNION ALL SELECT 'game' AS field, count(*)::BIGINT AS shared FROM (
      SELECT game_id FROM sides GROUP BY 1 HAVING bool_or(final) AND bool_or(NOT final))
    UNION ALL SELECT 'position', count(*)::BIGINT FROM (
      SELECT key FROM sides GROUP BY 1 HAVING bool_or(final) AND bool_or(NOT final))""",
)
def sealed_disjointness(spark, sf):
    rows = bridge.positions(spark, sf).withColumns(
        {"key": fx.position_key("fen"), "split": hashing.split_for("game_id")}
    )
    return keys.disjointness(
        rows.where("split = 'test'"),
        rows.where("split <> 'test'"),
        {
            "game": F.col("game_id"),
            "position": F.col("key"),
            "group": hashing.group_id_for(F.col("key"), fx.canonical_dice("dice")),
            "root": F.concat_ws("|", "key", fx.canonical_dice("dice")),
        },
    )


@query(
    "d6_ownership",
    """WITH claims AS (SELECT 'part' AS field, l_partkey::VARCHAR AS value,
        l_suppkey AS g FROM lineitem
      UNION ALL SELECT 'order', l_orderkey::VARCHAR, l_suppkey FROM lineitem)
    SELECT field, value, min(g) AS first_group, max(g) AS last_group FROM claims
    GROUP BY field, value HAVING min(g) <> max(g)""",
)
def ownership(spark, sf):
    rows = bridge.read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("order"), "l_suppkey"
    )
    return keys.ownership(rows, "l_suppkey", ["part", "order"])


@query(
    "d13_frozen_splits",
    "WITH " + bridge.CANDIDATES_SQL + """, g AS (SELECT DISTINCT group_id FROM candidates), m AS (
      SELECT 's' || s_suppkey::VARCHAR AS group_id, CASE s_suppkey % 3 WHEN 0 THEN 'train'
        WHEN 1 THEN 'early_stop' ELSE CASE WHEN s_suppkey % 5 = 2 THEN 'other' ELSE 'screen' END END
        AS split FROM supplier WHERE s_suppkey % 11 <> 4
      UNION ALL SELECT 'x' || s_suppkey::VARCHAR, 'train' FROM supplier WHERE s_suppkey % 13 = 5)
    SELECT count(*) FILTER (WHERE g.group_id IS NOT NULL AND m.group_id IS NOT NULL)::BIGINT
      AS assigned, count(*) FILTER (WHERE m.group_id IS NULL)::BIGINT AS unassigned,
      count(*) FILTER (WHERE g.group_id IS NULL)::BIGINT AS unknown_groups,
      count(*) FILTER (WHERE split = 'other')::BIGINT AS bad_split,
      (SELECT count(*) FROM supplier WHERE s_suppkey % 11 <> 4 AND s_suppkey % 17 = 6)::BIGINT
        AS repeated
    FROM g FULL JOIN m USING (group_id)""",
)
def frozen_splits(spark, sf):
    from evalspark.sources import readers

    k = F.col("s_suppkey")
    suppliers = bridge.read(spark, sf, "supplier")
    named = F.when(k % 3 == 0, "train").when(k % 3 == 1, "early_stop").when(
        k % 5 == 2, "other"
    ).otherwise("screen")
    known = suppliers.where(k % 11 != 4).select(
        F.concat(F.lit("s"), k.cast("string")).alias("group_id"), named.alias("split")
    )
    foreign = suppliers.where(k % 13 == 5).select(
        F.concat(F.lit("x"), k.cast("string")).alias("group_id"), F.lit("train").alias("split")
    )
    again = suppliers.where((k % 11 != 4) & (k % 17 == 6)).select(
        F.concat(F.lit("s"), k.cast("string")).alias("group_id"), named.alias("split")
    )
    assigned = known.unionByName(foreign).unionByName(again)
    return readers.frozen_splits(bridge.candidates(spark, sf), assigned)


ROOTS = P + f""", rooted AS (
  SELECT game_id, ply, fen, {bridge.ROLL_SQL.format('dice')} AS dice, side,
    sha256('prerank-roots-v1:' || {KEY} || '|' || {bridge.ROLL_SQL.format('dice')}) AS order_key,
    {bridge.GROUP_ID_SQL} AS group_id FROM positions
), roots AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_key
    ORDER BY game_id, ply, fen) AS rn, count(*) OVER (PARTITION BY order_key)::BIGINT AS occurrences
  FROM rooted) WHERE rn = 1)"""


@query("f2_distinct_roots", ROOTS + " SELECT * FROM roots")
def distinct_roots(spark, sf):
    return keys.distinct_roots(bridge.positions(spark, sf))


SAMPLE = 500


@query(
    "g1_hash_ordered_sample",
    ROOTS + f" SELECT order_key, game_id, dice FROM roots ORDER BY order_key LIMIT {SAMPLE}",
)
def hash_ordered_sample(spark, sf):
    roots = keys.distinct_roots(bridge.positions(spark, sf))
    return keys.sample_roots(roots, SAMPLE).select("order_key", "game_id", "dice")


@query(
    "g2_stable_order",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY
      l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)::BIGINT AS place
    FROM lineitem""",
)
def stable_order(spark, sf):
    rows = bridge.read(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return ordering.row_numbers(
        rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], "place"
    ).drop("l_extendedprice")


@query(
    "g3_seeded_group_sample",
    """SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
    ORDER BY sha256('13|' || o_custkey::VARCHAR) LIMIT 200""",
)
def seeded_group_sample(spark, sf):
    games = bridge.read(spark, sf, "orders").select("o_custkey").distinct()
    keyed_games = games.withColumn("_order", hashing.seeded_key(13, "o_custkey"))
    return ordering.ordered_prefix(keyed_games, "_order", 200).select("o_custkey")


@query(
    "i3_growing_sample",
    ROOTS + f""" SELECT order_key, game_id FROM (SELECT order_key, game_id FROM roots
      ORDER BY order_key LIMIT {2 * SAMPLE}) WHERE order_key NOT IN (
      SELECT order_key FROM roots ORDER BY order_key LIMIT {SAMPLE})""",
)
def growing_sample(spark, sf):
    roots = keys.distinct_roots(bridge.positions(spark, sf))
    done = keys.sample_roots(roots, SAMPLE)
    return keys.extend_sample(roots, done, 2 * SAMPLE).select("order_key", "game_id")


@query(
    "e16_root_coverage",
    ROOTS + f""", per AS (SELECT *, {bridge.sql_split(bridge.sql_bucket('game_id'))} AS split
      FROM roots), plies AS (SELECT ply, row_number() OVER (ORDER BY ply) - 1 AS i,
      count(*) OVER () AS n FROM roots)
    SELECT count(*)::BIGINT AS roots, count(DISTINCT game_id)::BIGINT AS games,
      count(*) FILTER (WHERE split='train')::BIGINT AS train,
      count(*) FILTER (WHERE split='validation')::BIGINT AS validation,
      count(*) FILTER (WHERE split='test')::BIGINT AS test,
      count(*) FILTER (WHERE side='w')::BIGINT AS side_w,
      count(*) FILTER (WHERE side='b')::BIGINT AS side_b,
      min(ply) AS ply_min, (SELECT ply FROM plies WHERE i = n // 2) AS ply_median,
      (SELECT ply FROM plies WHERE i = floor(n * 0.95::DOUBLE)) AS ply_p95, max(ply) AS ply_max
    FROM per""",
)
def root_coverage(spark, sf):
    return summaries.coverage(keys.distinct_roots(bridge.positions(spark, sf)))


def digest_sql(source: str, body: str, label: str) -> str:
    """(digest, rows) of a source with one JSON text `body` per row; label and lanes as in
    `summaries.content_digest`."""
    lanes = ", ".join(
        f"sum(('0x' || substr(d, {1 + 8 * i}, 8))::BIGINT)::VARCHAR" for i in range(summaries.LANES)
    )
    return f"""(SELECT sha256(concat_ws('|', '{label}', count(*)::VARCHAR, {lanes})) AS digest,
      count(*)::BIGINT AS rows FROM (SELECT sha256({body}) AS d FROM {source}))"""


@query(
    "e20_group_set_identity",
    S + f""", games AS (SELECT DISTINCT game_id FROM scored WHERE split = 'train')
    SELECT digest AS digest_a, rows, true AS same FROM """
    + digest_sql("games", """'{"game_id":"' || game_id || '"}'""", "||game_id:string"),
)
def group_set_identity(spark, sf):
    """Digest of the distinct train groups; must not depend on partitioning."""
    rows = bridge.scored(spark, sf).where("split = 'train'").select("game_id")
    a = summaries.key_set_digest(rows, "game_id").select(
        F.col("digest").alias("digest_a"), "rows"
    )
    b = summaries.key_set_digest(rows.repartition(7, "game_id"), "game_id")
    return a.withColumn("same", F.col("digest_a") == b.select("digest").scalar())


ORDER_BODY = """'{"cents":' || (o_totalprice * 100)::BIGINT || ',"o_custkey":' || o_custkey
  || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}'"""
ORDER_LABEL = "||cents:bigint,o_custkey:bigint,o_orderkey:bigint,o_orderpriority:string"


@query(
    "e21_content_digest",
    """WITH edited AS (SELECT * REPLACE (CASE WHEN o_orderkey = 1 THEN 0.0 ELSE o_totalprice END
      AS o_totalprice) FROM orders), parts AS (
      SELECT 'plain' AS part, digest FROM """ + digest_sql("orders", ORDER_BODY, ORDER_LABEL) + """
      UNION ALL SELECT 'turned', digest FROM """ + digest_sql("orders", ORDER_BODY, ORDER_LABEL) + """
      UNION ALL SELECT 'edited', digest FROM """ + digest_sql("edited", ORDER_BODY, ORDER_LABEL) + """)
    SELECT digest, count(*)::BIGINT AS tables, min(part) AS first FROM parts GROUP BY digest""",
)
def content_digest(spark, sf):
    """Per-table digests; layout changes leave them alone, data changes do not."""
    orders = bridge.read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    turned = orders.repartition(5).select(*reversed(orders.columns))
    edited = orders.withColumn(
        "cents", F.when(F.col("o_orderkey") == 1, 0).otherwise(F.col("cents")).cast("long")
    )
    parts = [
        summaries.content_digest(t).withColumn("part", F.lit(name))
        for name, t in (("plain", orders), ("turned", turned), ("edited", edited))
    ]
    table = keys.union_all(parts)
    return table.groupBy("digest").agg(
        F.count(F.lit(1)).alias("tables"), F.min("part").alias("first")
    )


TREE_KEY = "sha256(o_orderkey::VARCHAR)"


def tree_sql(name: str, source: str) -> str:
    """Leaves, inner nodes and root of `summaries.digest_tree` at depth 2, as CTEs named by `name`."""
    kids = "sha256(string_agg(right(path, 1) || ':' || digest, ',' ORDER BY path))"
    return f"""{name}_rows AS (SELECT left({TREE_KEY}, 2) AS path, sha256({ORDER_BODY}) AS r, count(*) AS n
      FROM {source} GROUP BY ALL),
    {name}_2 AS (SELECT path, sha256(string_agg(r || ':' || n, ',' ORDER BY r || ':' || n)) AS digest,
      sum(n)::BIGINT AS rows FROM {name}_rows GROUP BY 1),
    {name}_1 AS (SELECT left(path, 1) AS up, {kids} AS digest, sum(rows)::BIGINT AS rows
      FROM {name}_2 GROUP BY 1),
    {name} AS (SELECT 0 AS level, '' AS path, {kids} AS digest, sum(rows)::BIGINT AS rows
      FROM (SELECT up AS path, digest, rows FROM {name}_1)
      UNION ALL SELECT 1, up, digest, rows FROM {name}_1
      UNION ALL SELECT 2, path, digest, rows FROM {name}_2)"""


def _orders(spark, sf):
    return bridge.read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )


@query("e21_digest_tree", "WITH " + tree_sql("tree", "orders") + " SELECT * FROM tree")
def digest_tree(spark, sf):
    """Every node of the Merkle tree over the orders, by key."""
    return summaries.digest_tree(_orders(spark, sf).repartition(5), "o_orderkey", depth=2)


@query(
    "e21_tree_differences",
    """WITH edited AS (SELECT * REPLACE (CASE WHEN o_orderkey % 5000 = 1 THEN 0.0 ELSE o_totalprice END
      AS o_totalprice) FROM orders WHERE o_orderkey % 7000 <> 3),
    """ + tree_sql("a", "orders") + ", " + tree_sql("b", "edited") + """
    SELECT 2 AS level, path, coalesce(a_2.rows, 0)::BIGINT AS rows_a, coalesce(b_2.rows, 0)::BIGINT AS rows_b
    FROM a_2 FULL JOIN b_2 USING (path) WHERE a_2.digest IS DISTINCT FROM b_2.digest""",
)
def tree_differences(spark, sf):
    """The leaves that hold edited and lost orders, found by descent from the roots."""
    orders = _orders(spark, sf)
    price = F.when(F.col("o_orderkey") % 5000 == 1, 0).otherwise(F.col("cents")).cast("long")
    edited = orders.where("o_orderkey % 7000 <> 3").withColumn("cents", price)
    trees = [summaries.digest_tree(t, "o_orderkey", depth=2) for t in (orders, edited)]
    return summaries.tree_differences(*trees)


@query(
    "e25_uniqueness",
    """SELECT count(*)::BIGINT AS keys, count(*) FILTER (WHERE n > 1)::BIGINT AS repeated_keys,
      sum(n - 1)::BIGINT AS extra_rows FROM (
      SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def uniqueness(spark, sf):
    return keys.uniqueness(bridge.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "e25_prefix_collisions",
    ROOTS + """ SELECT substr(order_key, 1, 4) AS prefix, min(order_key) AS lo,
      max(order_key) AS hi FROM roots GROUP BY 1 HAVING min(order_key) <> max(order_key)""",
)
def prefix_collisions(spark, sf):
    roots = keys.distinct_roots(bridge.positions(spark, sf)).withColumn(
        "prefix", F.substring("order_key", 1, 4)
    )
    return summaries.hash_collisions(roots, "prefix", "order_key")


@query(
    "f3_group_by_game",
    """SELECT o_custkey, o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first
    FROM orders""",
)
def group_by_game(spark, sf):
    rows = bridge.read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return shards.grouped_rows(rows, "o_custkey", "o_orderkey", "o_orderkey")


SHARD_ROWS = 1000


def _shards_sql(size: int) -> str:
    return f"""WITH RECURSIVE games AS (
      SELECT o_custkey, min(o_orderkey) AS first, count(*) AS n FROM orders GROUP BY 1
    ), spans AS (SELECT o_custkey, (sum(n) OVER (ORDER BY first) - n)::BIGINT AS start,
      (sum(n) OVER (ORDER BY first))::BIGINT AS stop FROM games
    ), cuts AS (SELECT 0::BIGINT AS start, 0 AS shard UNION ALL
      SELECT nxt, shard + 1 FROM (SELECT (SELECT min(s.start) FROM spans s
        WHERE s.start >= c.start + {size}) AS nxt, shard FROM cuts c) WHERE nxt IS NOT NULL)"""


@query(
    "f4_shard_numbers",
    _shards_sql(SHARD_ROWS) + """ SELECT o_custkey, start, stop,
      (SELECT max(shard) FROM cuts WHERE cuts.start <= spans.start) AS shard FROM spans""",
)
def shard_numbers(spark, sf):
    rows = bridge.read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return shards.assign_shards(rows, "o_custkey", "o_orderkey", SHARD_ROWS)


@query(
    "f10_list_offsets",
    "WITH " + bridge.CANDIDATES_SQL + """ SELECT group_id, count(*)::BIGINT AS size,
      (sum(count(*)) OVER (ORDER BY group_id))::BIGINT AS stop FROM candidates GROUP BY group_id""",
)
def list_offsets(spark, sf):
    return ranking.list_offsets(bridge.candidates(spark, sf))


@query(
    "h1_union",
    """SELECT source, count(*)::BIGINT AS rows, sum(id)::BIGINT AS ids FROM (
      SELECT 'orders' AS source, o_orderkey AS id FROM orders
      UNION ALL SELECT 'events', event_id FROM events
      UNION ALL SELECT 'documents', doc_id FROM documents) GROUP BY 1""",
)
def union(spark, sf):
    parts = [
        bridge.read(spark, sf, t).select(F.lit(t).alias("source"), F.col(k).alias("id"))
        for t, k in (("orders", "o_orderkey"), ("events", "event_id"), ("documents", "doc_id"))
    ]
    return (
        keys.union_all(parts)
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))
    )


ACTIVE = (
    "WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), "
    "b AS (SELECT DISTINCT event_id AS k FROM events)"
)


def _two_sets(spark, sf):
    a = bridge.read(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = bridge.read(spark, sf, "events").select(F.col("event_id").alias("k"))
    return a, b


@query(
    "h2_intersection",
    ACTIVE + " SELECT count(*)::BIGINT AS shared FROM (SELECT k FROM a INTERSECT SELECT k FROM b)",
)
def intersection(spark, sf):
    a, b = _two_sets(spark, sf)
    return keys.set_counts(a, b, "k").select(F.col("both").alias("shared"))


@query(
    "h3_difference",
    ACTIVE + " SELECT 'missing' AS side, k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL "
    "SELECT 'extra', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)",
)
def difference(spark, sf):
    a, b = _two_sets(spark, sf)
    return keys.set_difference(a, b, "k")


@query(
    "h4_set_equality",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders),
      b AS (SELECT c_custkey AS k FROM customer)
    SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL)::BIGINT AS both,
      count(*) FILTER (WHERE b.k IS NULL)::BIGINT AS missing,
      count(*) FILTER (WHERE a.k IS NULL)::BIGINT AS extra,
      count(*) FILTER (WHERE a.k IS NULL OR b.k IS NULL) = 0 AS equal
    FROM a FULL JOIN b ON a.k = b.k""",
)
def set_equality(spark, sf):
    a = bridge.read(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = bridge.read(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return keys.set_counts(a, b, "k")


@query("h5_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def distinct(spark, sf):
    return bridge.read(spark, sf, "lineitem").select("l_partkey", "l_returnflag").distinct()
