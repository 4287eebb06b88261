"""Line dedup: a line that stood in an earlier document goes, with DataFrame functions only.

Method: documents name their lines as narrow rows (hash, document, position). The rows are range
partitioned by hash and sorted by document and position inside it; each hash streams its lines and
the first document keeps them. What comes back to the documents is not text but a bitmap of kept
lines, one word of 64 lines where any line goes.

A line that a third of all documents hold would be one sorted run. Such hashes are found by a count
over a bounded sample and get a salt, so that every part streams its own first document; the parts'
first documents, few rows, then meet. The sample steers balance only, the result is exact for any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.session import materialise

#: Fixed value: what is stripped from a line's ends.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_POINTS = 10
#: Lines counted to find hot hashes, and how often one must be met: at most SAMPLE / MET hot hashes.
SAMPLE, MET = 1 << 21, 16
HASHES = ["h1", "h2"]
#: What names a document: its id and two hashes of its text. Rows equal in all have equal lines.
IDENTITY = ["doc", "d1", "d2"]


def _identified(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc"), body.alias("body"), *more)
    return rows.withColumns({"d1": F.xxhash64("body"), "d2": F.xxhash64(F.lit(1), "body")})


def line_keys(docs: DataFrame, doc_id: str, text: str, least_points: int) -> DataFrame:
    """One row per line whose key (blanks stripped, A-Z lower-cased) is long enough: its document,
    position and a 128-bit hash of the key."""
    lines = F.split(F.translate("body", UPPER, UPPER.lower()), "\n")
    rows = _identified(docs, doc_id, text).select(*IDENTITY, F.posexplode(lines).alias("pos", "line"))
    rows = rows.withColumn("key", F.trim("line", F.lit(BLANKS))).where(F.char_length("key") >= least_points)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), *IDENTITY, "pos")


def _salts(lines: DataFrame, row: Column) -> DataFrame:
    """h1, h2, salts of hashes with more than a task's share of the lines; SAMPLE / MET rows at most."""
    spark = lines.sparkSession
    rows = lines.count()
    one_in = max(1, rows // SAMPLE)
    share = max(1, rows // int(spark.conf.get("spark.sql.shuffle.partitions")))
    sample = lines.where(F.pmod(F.xxhash64(row), F.lit(one_in)) == 0)
    met = sample.groupBy(*HASHES).agg(F.count("*").alias("n")).where((F.col("n") >= MET) & (F.col("n") * one_in > share))
    return met.select(*HASHES, F.ceil(F.col("n") * one_in / share).cast("long").alias("salts"))


def repeated_lines(docs: DataFrame, doc_id: str, text: str, least_points: int) -> DataFrame:
    """doc, d1, d2, pos of every line whose key an earlier document holds."""
    lines = materialise(line_keys(docs, doc_id, text, least_points), "lines")
    row = F.struct("_metadata.file_path", "_metadata.row_index")
    hot = materialise(_salts(lines, row), "hot-lines")
    # Proven bound: SAMPLE / MET rows.
    dealt = lines.select("*", F.xxhash64(row).alias("at")).join(F.broadcast(hot), HASHES, "left")
    salt = F.when(F.col("salts").isNotNull(), F.pmod("at", "salts")).otherwise(F.lit(-1))
    dealt = dealt.select(*HASHES, salt.alias("salt"), *IDENTITY, "pos")
    run = Window.partitionBy(*HASHES, "salt").orderBy(F.col("doc").asc_nulls_last(), "pos")
    run = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.struct("doc")).over(run)
    streamed = dealt.repartitionByRange(*HASHES, "salt").withColumn("first", first)
    later = ~F.col("doc").eqNullSafe(F.col("first.doc"))
    streamed = streamed.withColumn("later", later).where(F.col("later") | (F.col("salt") >= 0))
    streamed = materialise(streamed.select(*HASHES, *IDENTITY, "pos", "later"), "repeated-lines")
    # Lines that are first in their part of a hot hash: first of all only in the least document.
    open_ = streamed.where(~F.col("later"))
    least = open_.groupBy(*HASHES).agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc")).alias("least"))
    parts = open_.join(F.broadcast(least), HASHES).where(~F.col("doc").eqNullSafe(F.col("least.doc")))
    return streamed.where("later").select(*IDENTITY, "pos").union(parts.select(*IDENTITY, "pos"))


def line_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_points: int = LEAST_POINTS) -> DataFrame:
    """doc, d1, d2 (see IDENTITY) and `words`, the keep bitmap of each document that loses a line:
    structs of word (lines 64 * word to 64 * word + 63) and keep (bit b: line 64 * word + b stays).
    Words whose lines all stay are left out, so a bitmap is as long as what goes."""
    gone = repeated_lines(docs, doc_id, text, least_points)
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = gone.groupBy(*IDENTITY, F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("gone"))
    words = words.groupBy(*IDENTITY).agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("keep")))).alias("words"))
    return materialise(words, "bitmaps")


def _dropped(words: str) -> Column:
    """Positions that a bitmap drops, ascending; none for a null bitmap."""
    lines = "filter(sequence(0, 63), b -> (shiftright(w.keep, b) & 1) = 0)"
    return F.expr(f"coalesce(flatten(transform({words}, w -> transform({lines}, b -> w.word * 64 + b))), cast(array() as array<int>))")


def _judged(docs: DataFrame, doc_id: str, text: str, least_points: int, *more: Column) -> DataFrame:
    bitmaps = line_bitmaps(docs, doc_id, text, least_points)
    rows = _identified(docs, doc_id, text, *more).alias("r")
    same = F.expr("r.doc <=> b.doc AND r.d1 = b.d1 AND r.d2 = b.d2")
    rows = rows.join(bitmaps.alias("b"), same, "left").select("r.*", _dropped("b.words").alias("dropped"))
    rows = rows.withColumn("lines", F.split("body", "\n"))
    stay = "transform(array_except(sequence(0, size(lines) - 1), dropped), i -> lines[i])"
    kept = F.expr(f"if(size(dropped) = 0, body, array_join({stay}, '\n'))")
    return rows.withColumns({"n_lines": F.size("lines").cast("long"), "n_dropped": F.size("dropped").cast("long"), "kept": kept})


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_points: int = LEAST_POINTS) -> DataFrame:
    r"""doc_id, n_lines, n_dropped and kept (the text of the lines that stay) of every row.

    Texts are split at \n; a line's key is the line without the blanks at its ends and A-Z
    lower-cased. Keys of at least `least_points` code points lose all their lines except in the
    smallest doc_id that holds them. Null and empty texts are one empty line, which stays. Rows that
    share a doc_id count as one document; a null doc_id comes after all others. Repeated rows are
    judged alike. Other columns of `docs` are ignored, whatever their names; an empty table gives no
    rows.
    """
    return _judged(docs, doc_id, text, least_points).select(F.col("doc").alias("doc_id"), "n_lines", "n_dropped", "kept")


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_points: int = LEAST_POINTS) -> DataFrame:
    """`docs` in its own columns, the text cut to the lines that stay (a null text stays null)."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    cut = F.when(F.col("row")[text].isNotNull(), F.col("kept"))
    judged = _judged(docs, doc_id, text, least_points, row)
    return judged.select(*[cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
