"""Candidate lists packed for many passes, and one pass that measures any number of linear models.

A list is one row of a packed table, its features one array; a list above PIECE_ROWS is cut into
pieces by a hash of the candidate index. Packing is the only shuffle of the rows. A pass is a map
over the packed table: a matrix of weights (a model per row) goes to the tasks, and each returns one
row of sums per model. Only pieces of cut lists return rows of their own, which are combined per
list; so a pass costs the same one job for one model and for many.

What a pass costs is the bytes it sends to Python. So the stored table has the features of a list
compressed, one feature after the other, and they are opened again in slices by the tasks of a pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.operators import ordering
from evalspark.session import materialise

PIECE_ROWS = 4096
#: Candidates whose arrays are held at once; a piece of a list stays whole.
SLICE_ROWS = 1 << 15
CODEC = "zstd"
STORED = "list string, held boolean, pieces int, size int, x binary, tie array<bigint>, best array<boolean>"
OUT = "list string, held boolean, model int, n long, sums array<double>, tie long, best boolean"
OUT_ARROW = pa.schema(
    [
        ("list", pa.string()),
        ("held", pa.bool_()),
        ("model", pa.int32()),
        ("n", pa.int64()),
        ("sums", pa.list_(pa.float64())),
        ("tie", pa.int64()),
        ("best", pa.bool_()),
    ]
)


@dataclass
class Measured:
    """Per model: mean log-sum-exp and mean softmax-weighted features of the train lists, share of
    the held lists whose first k keep a best candidate (not a number without lists)."""

    lse: np.ndarray
    means: np.ndarray
    recall: np.ndarray


def pack(
    rows: DataFrame, group: str, x: list[Column], tie: str, held: Column, best: Column,
    size: Column, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """(list, held, pieces, x, tie, best): the candidates of a list, or of a piece of one, in the
    order of `tie`; x lays their features end to end. `size` is the rows of a list, the same on all
    of them. Not stored."""
    cell = F.struct(F.col(tie).cast("long").alias("tie"), best.alias("best"), F.array(*x).alias("x"))
    pieces = F.ceil(size / piece_rows).cast("int").alias("pieces")
    rows = rows.select(F.col(group).cast("string").alias("list"), held.alias("held"), pieces, cell.alias("cell"))
    piece = F.pmod(F.xxhash64("cell.tie", "list"), F.col("pieces")).alias("piece")
    cells = F.sort_array(F.collect_list("cell")).alias("cells")
    placed = rows.groupBy("list", "held", "pieces", piece).agg(cells)
    return placed.select(
        "list",
        "held",
        "pieces",
        F.flatten("cells.x").alias("x"),
        F.col("cells.tie").alias("tie"),
        F.col("cells.best").alias("best"),
    )


def _closed(width: int):
    def run(batches):
        codec = pa.Codec(CODEC)
        for batch in _slices(batches, SLICE_ROWS):
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            sizes = batch["tie"].value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            shut = [codec.compress(np.ascontiguousarray(x[b - n : b].T), asbytes=True) for b, n in zip(ends, sizes)]
            held = batch["held"].to_numpy(zero_copy_only=False)
            cut = held & (batch["pieces"].to_numpy(zero_copy_only=False) > 1)
            # Read of held lists only, the tie of those in pieces only.
            tie, best = (batch[c].take(pa.array(np.arange(len(m)), mask=~m)) for c, m in (("tie", cut), ("best", held)))
            columns = [batch["list"], batch["held"], batch["pieces"], pa.array(sizes, pa.int32()), pa.array(shut, pa.binary()), tie, best]
            yield pa.RecordBatch.from_arrays(columns, ["list", "held", "pieces", "size", "x", "tie", "best"])

    return run


def closed(packed: DataFrame, width: int) -> DataFrame:
    """A table of `pack` with its features compressed, as `measure` reads it. Not stored."""
    return packed.select("list", "held", "pieces", "x", "tie", "best").mapInArrow(_closed(width), STORED)


def _opened(batches, width: int):
    """The features of a table of `closed` as lists again, in slices."""
    codec = pa.Codec(CODEC)
    for batch in _slices(batches, SLICE_ROWS):
        ends = np.concatenate(([0], np.cumsum(batch["size"].to_numpy())))
        x = np.empty((ends[-1], width))
        for shut, a, b in zip(batch["x"], ends[:-1], ends[1:]):
            plain = codec.decompress(shut.as_buffer(), (b - a) * width * 8)
            x[a:b] = np.frombuffer(plain, np.float64).reshape(width, b - a).T
        lists = pa.ListArray.from_arrays(pa.array((ends * width).astype(np.int32)), pa.array(x.reshape(-1)))
        yield batch.set_column(batch.schema.get_field_index("x"), "x", lists)


def _softened(weights: np.ndarray, x: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """lists x models x (2 + width): highest score, and relative to it the sum of exp(score) and
    the features weighted by it."""
    z = x @ weights.T
    top = np.maximum.reduceat(z, at, axis=0)
    e = np.exp(z - np.repeat(top, sizes, axis=0))
    parts = [top[:, :, None], np.add.reduceat(e, at, axis=0)[:, :, None]]
    parts.append(np.stack([np.add.reduceat(e[:, [m]] * x, at, axis=0) for m in range(len(weights))], axis=1))
    return np.concatenate(parts, axis=2)


def _kept(z: np.ndarray, best: np.ndarray, at: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """lists x models: fewer than k candidates stand ahead of the first best one."""
    i = np.arange(len(z))[:, None]
    lead = np.maximum.reduceat(np.where(best[:, None], z, -np.inf), at, axis=0)
    lead = np.repeat(lead, sizes, axis=0)
    place = np.minimum.reduceat(np.where(best[:, None] & (z == lead), i, len(z)), at, axis=0)
    ahead = (z > lead) | ((z == lead) & (i < np.repeat(place, sizes, axis=0)))
    return np.add.reduceat(ahead, at, axis=0, dtype=np.int64) < k


def _slices(batches, rows: int):
    """The batches in slices of about `rows` candidates; one piece of a list at least."""
    for batch in batches:
        sizes = batch["size"] if "size" in batch.schema.names else batch["tie"].value_lengths()
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + rows, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _pass(weights: np.ndarray, k: int):
    models, width = weights.shape

    def run(batches):
        totals, lists = np.zeros((2, models, 1 + width)), [0, 0]
        for batch in _slices(batches, SLICE_ROWS):
            held = np.array(batch["held"].to_pylist(), bool)
            cut = np.array(batch["pieces"].to_pylist()) > 1
            out = {name: [] for name in OUT_ARROW.names}

            def add(*row):
                for name, value in zip(out, row):
                    out[name].append(value)

            for side in (False, True):
                rows = np.flatnonzero(held == side)
                if not len(rows):
                    continue
                part = batch.take(pa.array(rows))
                x = part["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                sizes = part["x"].value_lengths().to_numpy(zero_copy_only=False) // width
                at, whole = np.cumsum(sizes) - sizes, ~cut[rows]
                lists[side] += int(whole.sum())
                if not side:
                    got = _softened(weights, x, at, sizes)
                    one = got[whole]
                    totals[0, :, 0] += (one[:, :, 0] + np.log(one[:, :, 1])).sum(axis=0)
                    totals[0, :, 1:] += (one[:, :, 2:] / one[:, :, 1:2]).sum(axis=0)
                    for row in np.flatnonzero(~whole):
                        for m in range(models):
                            add(part["list"][row].as_py(), False, m, 1, got[row, m].tolist(), None, None)
                    continue
                z = x @ weights.T
                best = part["best"].flatten().to_numpy(zero_copy_only=False)
                totals[1, :, 0] += _kept(z, best.astype(bool), at, sizes, k)[whole].sum(axis=0)
                for row in np.flatnonzero(~whole):
                    a, b, tie = at[row], at[row] + sizes[row], part["tie"][row].values
                    for m in range(models):
                        # Ties keep the order of the candidate index.
                        for i in a + np.argsort(-z[a:b, m], kind="stable")[:k]:
                            add(part["list"][row].as_py(), True, m, 1, [float(z[i, m])], tie[i - a].as_py(), bool(best[i]))
            if out["list"]:
                yield pa.RecordBatch.from_pydict(out, OUT_ARROW)
        ends = [(None, bool(s), m, lists[s], totals[s, m].tolist(), None, None) for s in (0, 1) for m in range(models)]
        yield pa.RecordBatch.from_pydict(dict(zip(OUT_ARROW.names, map(list, zip(*ends)))), OUT_ARROW)

    return run


def _cut_lists(out: DataFrame, width: int, k: int) -> list[DataFrame]:
    """(held, model, n, s0, s1, ...) of the lists that were cut, from their pieces."""
    names, pieces = ["list", "model"], out.where("list IS NOT NULL")
    train = pieces.where("NOT held").select(*names, F.col("sums")[0].alias("top"), "sums")
    high = train.groupBy(*names).agg(F.max("top").alias("high"))
    scaled = train.join(high, names).withColumn("w", F.exp(F.col("top") - F.col("high")))
    per = scaled.groupBy(*names).agg(
        F.first("high").alias("high"),
        *[F.sum(F.col("sums")[i + 1] * F.col("w")).alias(f"e{i}") for i in range(1 + width)],
    )
    trained = per.groupBy(F.lit(False).alias("held"), "model").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("high") + F.ln("e0")).alias("s0"),
        *[F.sum(F.col(f"e{i}") / F.col("e0")).alias(f"s{i}") for i in range(1, 1 + width)],
    )
    first = ordering.top_rows(pieces.where("held"), names, [-F.col("sums")[0], F.col("tie")], k)
    kept = first.groupBy(*names).agg(F.max(F.col("best").cast("double")).alias("kept"))
    measured = kept.groupBy(F.lit(True).alias("held"), "model").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("kept").alias("s0"),
        *[F.lit(0.0).alias(f"s{i}") for i in range(1, 1 + width)],
    )
    return [trained, measured]


def measure(packed: DataFrame, weights: np.ndarray, k: int, cut: bool) -> Measured:
    """Every model (row of `weights`) on all lists, in one job. `cut`: some list has several
    pieces; their rows are stored and combined per list."""
    models, width = weights.shape
    run = _pass(weights, k)
    out = packed.mapInArrow(lambda batches: run(_opened(batches, width)), OUT)
    if cut:
        out = materialise(out, "list-pass")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(1 + width)]
    found = out.where("list IS NULL").groupBy("held", "model").agg(F.sum("n").alias("n"), *sums)
    for more in _cut_lists(out, width, k) if cut else ():
        found = found.unionByName(more)
    totals, lists = np.zeros((2, models, 1 + width)), np.zeros((2, models))
    for row in found.collect():
        side, m = int(row["held"]), row["model"]
        lists[side, m] += row["n"]
        totals[side, m] += [row[f"s{i}"] for i in range(1 + width)]
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = totals / lists[:, :, None]
    return Measured(mean[0, :, 0], mean[0, :, 1:], mean[1, :, 0])
