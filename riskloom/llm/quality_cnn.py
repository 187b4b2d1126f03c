"""Byte-level convolutional quality classifier, trained and applied in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Every byte gives a learned embedding and, for
a range of lags, whether it repeats the byte that many places before. Learned filters of eight bytes slide over a
chunk; each filter keeps its maximum over the chunk; a linear layer turns the maxima into the chunk's logit, and the
mean logit of the chunks, weighted by their bytes, into one probability. Only the winning window of a filter gets
a gradient, so a training step costs little more than a forward pass.

The model is fitted on the driver on a bounded sample: at most SAMPLE_ROWS labelled rows a class and SAMPLE_CHUNKS
chunks a row. Every whole text is scored in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_batches

#: Labelled rows a class, and chunks a row, that the model is fitted on at most; chosen by a hash of doc_id.
SAMPLE_ROWS, SAMPLE_CHUNKS = 1500, 6
CHUNK, OVERLAP, STRIDE, WIDTH = 1024, 64, 4, 8
EMBEDDING, LAGS, FILTERS, PAD = 8, tuple(range(2, 22)), 16, 256
CHANNELS = EMBEDDING + len(LAGS)
STEPS, BATCH_DOCS, RATE = 1000, 16, 0.01
#: A logit of a chunk counts within these bounds, so that no single chunk decides a long text.
LOGIT_BOUND = 8.0
CUTOFF = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def chunks_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Chunks as rows of byte values, PAD after the end, and their lengths in bytes."""
    step = CHUNK - OVERLAP
    count = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.full(count * step + OVERLAP, PAD, np.int16)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]
    return rows, np.clip(len(data) - np.arange(count) * step, 0, CHUNK)


class Network:
    """Parameters and passes of the classifier."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        normal = lambda *shape: draw.normal(0, 1, shape).astype(np.float32)
        self.embedding = normal(PAD + 1, EMBEDDING) * 0.5
        self.embedding[PAD] = 0
        self.filters = normal(WIDTH * CHANNELS, FILTERS) * 0.1
        self.filter_bias = np.zeros(FILTERS, np.float32)
        self.weights = normal(FILTERS) * 0.1
        self.bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.filter_bias, self.weights, self.bias]

    def channels(self, chunks: np.ndarray) -> np.ndarray:
        out = np.zeros((*chunks.shape, CHANNELS), np.float32)
        out[..., :EMBEDDING] = self.embedding[chunks]
        for k, lag in enumerate(LAGS):
            out[:, lag:, EMBEDDING + k] = (chunks[:, lag:] == chunks[:, :-lag]) & (chunks[:, lag:] != PAD)
        return out

    def pooled(self, chunks: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maxima of the filters, where they are, and the channels."""
        channels = self.channels(chunks)
        steps = channels.reshape(len(chunks), CHUNK // STRIDE, STRIDE * CHANNELS)
        half = STRIDE * CHANNELS
        values = steps[:, :-1] @ self.filters[:half] + steps[:, 1:] @ self.filters[half:]
        ends = np.maximum(1, -(-lengths // STRIDE))
        values[np.arange(values.shape[1])[None, :] >= ends[:, None]] = -1e9
        place = values.argmax(axis=1)
        return np.take_along_axis(values, place[:, None], 1)[:, 0] + self.filter_bias, place, channels

    def logits(self, chunks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(chunks), np.float32)
        for start in range(0, len(chunks), 64):
            top, _, _ = self.pooled(chunks[start : start + 64], lengths[start : start + 64])
            out[start : start + 64] = np.maximum(top, 0) @ self.weights + self.bias
        return LOGIT_BOUND * np.tanh(out / LOGIT_BOUND)

    def gradients(self, chunks: np.ndarray, lengths: np.ndarray, doc: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted log loss; ``doc`` numbers the document of each chunk."""
        top, place, channels = self.pooled(chunks, lengths)
        active = np.maximum(top, 0)
        squashed = np.tanh((active @ self.weights + self.bias) / LOGIT_BOUND)
        share = np.maximum(lengths, 1) / np.bincount(doc, np.maximum(lengths, 1))[doc]
        logit = np.bincount(doc, LOGIT_BOUND * squashed * share)
        error = (1 / (1 + np.exp(-logit)) - labels) * weight
        back = (error[doc] * share * (1 - squashed**2)).astype(np.float32)
        by_filter = back[:, None] * self.weights * (top > 0)
        at = place[:, :, None] * STRIDE + np.arange(WIDTH)
        windows = channels[np.arange(len(chunks))[:, None, None], at]
        filters = np.einsum("cf,cfwk->wkf", by_filter, windows).reshape(WIDTH * CHANNELS, FILTERS)
        own = self.filters.reshape(WIDTH, CHANNELS, FILTERS)[:, :EMBEDDING]
        to_bytes = np.einsum("cf,wef->cfwe", by_filter, own).reshape(-1, EMBEDDING)
        seen = chunks[np.arange(len(chunks))[:, None, None], at].ravel()
        embedding = np.stack([np.bincount(seen, to_bytes[:, e], PAD + 1) for e in range(EMBEDDING)], axis=1)
        embedding[PAD] = 0
        return [embedding, filters, by_filter.sum(axis=0), active.T @ back, back.sum(keepdims=True)]

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, float, float]], seed: int = 7) -> Network:
        """Adam over rows of (chunks, lengths, label, weight)."""
        draw, parameters = np.random.default_rng(seed), self.parameters()
        first, second, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
        while step < STEPS:
            order = draw.permutation(len(rows))
            for start in range(0, len(order), BATCH_DOCS):
                batch = [rows[i] for i in order[start : start + BATCH_DOCS]]
                doc = np.repeat(np.arange(len(batch)), [len(r[0]) for r in batch])
                found = self.gradients(
                    np.concatenate([r[0] for r in batch]), np.concatenate([r[1] for r in batch]), doc,
                    np.array([r[2] for r in batch]), np.array([r[3] for r in batch]),
                )
                step += 1
                rate = RATE * max(0.01, 1 - step / STEPS)
                for p, g, a, b in zip(parameters, found, first, second, strict=True):
                    g = g / len(batch)
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities that texts are good."""
        cut = [chunks_of((text or "").encode()) for text in texts]
        if not cut:
            return np.zeros(0)
        doc = np.repeat(np.arange(len(cut)), [len(c) for c, _ in cut])
        lengths = np.concatenate([n for _, n in cut])
        logits = np.concatenate([self.logits(c, n) for c, n in _groups(cut)])
        weight = np.maximum(lengths, 1)
        return 1 / (1 + np.exp(-np.bincount(doc, logits * weight) / np.bincount(doc, weight)))


def _groups(cut: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of neighbouring documents together; a very long document goes piece by piece."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for chunks, lengths in cut:
        for start in range(0, len(chunks), 512):
            held.append((chunks[start : start + 512], lengths[start : start + 512]))
            if sum(len(n) for _, n in held) >= 512:
                yield np.concatenate([c for c, _ in held]), np.concatenate([n for _, n in held])
                held = []
    if held:
        yield np.concatenate([c for c, _ in held]), np.concatenate([n for _, n in held])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[np.ndarray, np.ndarray, float, float]]:
    """Chunks, lengths, label and weight of the sampled labelled rows.

    A class weighs as much as all its labelled rows, so the fitted probabilities keep the shares of the classes.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id").cast("long")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("quality").alias("__label"))
    sizes = dict(known.groupBy("__label").count().collect())  # two rows
    # at most 2 * rows ids: small enough to go to every task
    parts = [known.where(F.col("__label") == c).orderBy(F.xxhash64("__id"), "__id").limit(rows) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text")).join(chosen, "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            packed, sizes_ = [], []
            for text in batch["text"].to_pylist():
                chunks, lengths = chunks_of((text or "").encode())
                pick = np.unique(np.linspace(0, len(chunks) - 1, SAMPLE_CHUNKS).round().astype(int))
                packed.append(chunks[pick].tobytes())
                sizes_.append(lengths[pick].tolist())
            arrays = [batch["__id"], batch["__label"].cast(pa.int64()), pa.array(packed, pa.binary()), pa.array(sizes_, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "chunks", "lengths"])

    # at most 2 * rows rows of SAMPLE_CHUNKS chunks, or more rows only where the table repeats a doc_id
    found = texts.mapInArrow(run, "id long, label long, chunks binary, lengths array<long>").dropDuplicates(["id"]).collect()
    found = sorted(found, key=lambda r: r.id)
    drawn = {c: sum(r.label == c for r in found) for c in (0, 1)}
    scale = sum(sizes.values()) / max(1, len(found))
    return [
        (np.frombuffer(r.chunks, np.int16).reshape(-1, CHUNK), np.array(r.lengths), float(r.label), sizes[r.label] / drawn[r.label] / scale)
        for r in found
    ]


def fitted(docs: DataFrame, labels: DataFrame) -> Network:
    """The classifier; without labelled rows, one that gives every text 0.5."""
    rows = training_rows(docs, labels)
    network = Network()
    if not rows:
        network.weights[:] = 0
        return network
    return network.fit(rows)


def quality_scores(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document row: doc_id, held_out, score and predicted.

    Null and empty texts are scored like any other (one chunk without bytes). A null doc_id is held out. Repeated
    rows give equal scores; label rows that contradict each other count as quality 0; other columns are ignored.
    """
    network = fitted(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 128):
            score = pa.array(network.score(batch["text"].to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], score], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= cutoff).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def drop_low_quality(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``cutoff``, with all columns; the verdict falls where the row is read."""
    network = fitted(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 128):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(network.score(texts) >= cutoff, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
