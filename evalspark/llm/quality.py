"""Quality classifier: a byte-level convolutional network in numpy.

Method: bytes are embedded, learned filters of WIDTH bytes run over the whole document, and the
activations are max-pooled over overlapping chunks of CHUNK bytes that cover all of it. The pooled
activations of all chunks combine (their greatest, mean and least) into one probability. The network
is fitted on the driver, on a bounded sample of labelled documents; scoring is a map over all
documents, and the model is a few KB.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.rows import put_back, set_aside
from evalspark.llm.texts import slices, texts_of

CHUNK = 512  # bytes; the next chunk starts half of it later
HALF = CHUNK // 2
WIDTH, STEP = 8, 4
EMBEDDING, FILTERS = 8, 24
#: Bound of the sample that the network is fitted on: labelled documents, whole texts of them.
SAMPLE_ROWS = 3000
#: Bytes of texts whose activations are held at once; one document at least.
PASS_BYTES = 1 << 18
#: Steps of BATCH documents, however many there are.
STEPS, BATCH, RATE, DECAY = 400, 64, 0.01, 1e-5
PAD = 256
THRESHOLD = 0.7


@dataclass
class Model:
    embedding: np.ndarray  # 257 x EMBEDDING; the last is the filling behind a document
    filters: np.ndarray  # WIDTH * EMBEDDING x FILTERS
    shift: np.ndarray
    weights: np.ndarray  # 3 * FILTERS
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.shift, self.weights, self.bias]


def initial(seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    scale = np.sqrt(2.0 / (WIDTH * EMBEDDING))
    return Model(
        *(
            x.astype(np.float32)
            for x in (
                rng.normal(0, 1, (PAD + 1, EMBEDDING)),
                rng.normal(0, scale, (WIDTH * EMBEDDING, FILTERS)),
                np.zeros(FILTERS),
                rng.normal(0, 0.1, 3 * FILTERS),
                np.zeros(1),
            )
        )
    )


def laid_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Documents laid into whole half chunks (two at least), and each document's first one."""
    halves = np.maximum(2, -(-(ends - starts) // HALF))
    first = np.concatenate(([0], np.cumsum(halves)))
    cells = np.full(first[-1] * HALF + STEP, PAD, np.int16)
    size = ends - starts
    at = np.repeat(first[:-1] * HALF - (np.cumsum(size) - size), size) + np.arange(size.sum())
    source = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    cells[at] = data[source]
    return cells, first


def pooled(model: Model, cells: np.ndarray, first: np.ndarray):
    """Activations of each half chunk. The last window of a document ends in filling, whatever is
    laid behind it."""
    groups = model.embedding[cells].reshape(-1, STEP * EMBEDDING)
    k = STEP * EMBEDDING
    hidden = groups[:-1] @ model.filters[:k]
    behind = groups[1:].copy()
    behind[first[1:] * (HALF // STEP) - 1] = np.tile(model.embedding[PAD], STEP)
    hidden += behind @ model.filters[k:]
    return hidden.reshape(-1, HALF // STEP, FILTERS)


def document_features(half: np.ndarray, first: np.ndarray):
    """Per document the greatest, mean and least of its chunks' maxima; a chunk is two halves."""
    chunk = np.maximum(half[:-1], half[1:])
    inside = np.ones(len(half), bool)
    inside[first[1:-1] - 1] = False  # no chunk spans two documents
    inside[-1] = False
    chunk = chunk[np.flatnonzero(inside)]
    count = np.diff(first) - 1
    edge = np.cumsum(count) - count
    return chunk, edge, count


def probability(model: Model, cells: np.ndarray, first: np.ndarray) -> np.ndarray:
    half = np.maximum(pooled(model, cells, first).max(axis=1) + model.shift, 0)
    chunk, edge, count = document_features(half, first)
    features = np.hstack(
        (
            np.maximum.reduceat(chunk, edge),
            np.add.reduceat(chunk, edge) / count[:, None],
            np.minimum.reduceat(chunk, edge),
        )
    )
    z = features.astype(np.float64) @ model.weights + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gradients(model: Model, cells: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    hidden = pooled(model, cells, first)
    top = hidden.argmax(axis=1)
    raw = np.take_along_axis(hidden, top[:, None, :], axis=1)[:, 0] + model.shift
    half = np.maximum(raw, 0)
    chunk, edge, count = document_features(half, first)
    doc = np.repeat(np.arange(len(count)), count)
    great, mean, least = np.maximum.reduceat(chunk, edge), np.add.reduceat(chunk, edge) / count[:, None], np.minimum.reduceat(chunk, edge)
    features = np.hstack((great, mean, least))
    p = 1 / (1 + np.exp(-np.clip(features @ model.weights + model.bias, -30, 30)))
    dz = ((p - labels) * weight / len(labels)).astype(np.float32)
    g_weights, g_bias = features.T @ dz, dz.sum(keepdims=True)
    df = dz[:, None] * model.weights
    a, b, c = df[:, :FILTERS], df[:, FILTERS : 2 * FILTERS], df[:, 2 * FILTERS :]
    is_great, is_least = chunk == great[doc], chunk == least[doc]
    ties_a, ties_c = np.add.reduceat(is_great, edge, dtype=np.float32), np.add.reduceat(is_least, edge, dtype=np.float32)
    d_chunk = is_great * (a / ties_a)[doc] + (b / count[:, None])[doc] + is_least * (c / ties_c)[doc]
    # A chunk's gradient goes to the half that holds its maximum.
    left = np.arange(len(chunk)) + doc
    from_left = half[left] >= half[left + 1]
    d_half = np.zeros_like(half)
    d_half[left] += d_chunk * from_left
    d_half[left + 1] += d_chunk * ~from_left
    d_half *= raw > 0
    rows, f = np.nonzero(d_half)
    g = d_half[rows, f]
    at = (rows * (HALF // STEP) + top[rows, f]) * STEP
    bytes_at = cells[at[:, None] + np.arange(WIDTH)]
    last = np.isin(at + STEP, first[1:] * HALF)
    bytes_at[last, STEP:] = PAD
    seen = model.embedding[bytes_at].reshape(len(at), -1)
    g_filters = np.zeros_like(model.filters)
    for k in range(FILTERS):
        own = f == k
        g_filters[:, k] = g[own] @ seen[own]
    d_seen = (g[:, None] * model.filters[:, f].T).reshape(-1, EMBEDDING)
    g_embedding = np.zeros_like(model.embedding)
    flat = bytes_at.ravel()
    for e in range(EMBEDDING):
        g_embedding[:, e] = np.bincount(flat, d_seen[:, e], PAD + 1)
    return [g_embedding, g_filters, d_half.sum(axis=0), g_weights, g_bias]


def train(texts: list[bytes], labels: list[int], seed: int = 0) -> Model:
    """Fit the network by Adam; both labels weigh the same in all. Without examples of both labels
    it returns the share of label 1 for everything (one half without any)."""
    model = initial(seed)
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        model.weights[:] = 0
        model.bias[:] = 0 if not len(y) else (4 if y[0] else -4)
        return model
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in model.parts()]
    step = 0
    while step < STEPS:
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            if step == STEPS:
                break
            rows = order[at : at + BATCH]
            size = np.array([len(texts[i]) for i in rows], np.int64)
            passes = np.split(rows, np.flatnonzero(np.diff(np.cumsum(size) // PASS_BYTES)) + 1)
            total = [np.zeros_like(x) for x in model.parts()]
            for own in passes:  # long texts of a batch do not lie in memory together
                data = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
                size = np.array([len(texts[i]) for i in own], np.int64)
                cells, first = laid_out(data, np.cumsum(size) - size, np.cumsum(size))
                for t, g in zip(total, _gradients(model, cells, first, y[own], weight[own])):
                    t += g * np.float32(len(own) / len(rows))
            step += 1
            rate = RATE * (1 - step / (STEPS + 1))
            for x, g, (m, v) in zip(model.parts(), total, moments):
                g = g + DECAY * x
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    # Equal weights moved the odds; move them back to those of the labels seen.
    model.bias += np.float32(np.log(share / (1 - share)))
    return model


def held_out(doc_id: str):
    """Rows whose labels are never learned: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on the whole texts of at most SAMPLE_ROWS labelled documents that are not held out, in
    the order of a hash of id and text. Rows with a null id, label or text teach nothing; of repeated
    labels of an id the greatest counts, rows equal in id and text are one."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(doc_id)).groupBy(doc_id).agg(F.max(label).cast("int").alias("y"))
    names = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("body")).where("id IS NOT NULL AND body IS NOT NULL")
    digest = F.sha2("body", 256).alias("digest")
    found = names.join(known.withColumnRenamed(doc_id, "id"), "id").select("id", digest, "y").distinct()
    # At most SAMPLE_ROWS rows; the documents stay where they are.
    chosen = found.orderBy(F.xxhash64("id", "digest"), "id", "digest").limit(SAMPLE_ROWS)
    rows = names.withColumn("digest", digest).join(F.broadcast(chosen), ["id", "digest"])
    rows = rows.groupBy("id", "digest", "y").agg(F.first("body").alias("body")).orderBy("id", "digest").collect()
    return train([r.body.encode() for r in rows], [r.y for r in rows])


def _score(model: Model):
    def batches(parts):
        for batch in parts:
            column, out = batch["body"], []
            for a, b in slices(column, 1 << 19):
                texts = texts_of(column.slice(a, b - a))
                out.append(probability(model, *laid_out(texts.data, texts.starts, texts.ends)))
            scores = np.concatenate(out) if out else np.zeros(0)
            i = batch.schema.get_field_index("score")
            yield batch.set_column(i, batch.schema.field(i), pa.array(scores, pa.float64()))

    return batches


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with `score`, the probability of label 1, from the bytes of the whole text.

    Null and empty texts are scored as filling only. Repeated rows score alike; a score depends on
    nothing but the text (up to the rounding of float32 sums). A column of `docs` named
    score is replaced, all others are kept, whatever their names.
    """
    kept = docs.drop("score").columns
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body")
    blank = F.coalesce(F.lit(None).cast("double"), F.lit(0.0)).alias("score")
    ready = docs.select(*set_aside(kept), body, blank)
    return ready.mapInArrow(_score(model), ready.schema).select(*put_back(kept), "score")
