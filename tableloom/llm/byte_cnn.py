"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A text is covered by overlapping chunks of bytes. Every byte is embedded, learned
filters run over the chunk, and each filter keeps its largest response. The
chunks of a text are combined by their mean and their maximum into one
probability. The network is trained here, on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.tables import keep_rows, texts
from tableloom.llm.words import in_pieces

#: Bytes of a chunk, and from the start of a chunk to the next one's.
CHUNK, CHUNK_STEP = 1024, 896
#: Bytes of a filter, and from one place of it to the next.
WIDTH, STEP = 8, 4
DIMENSIONS, FILTERS = 6, 24
#: Bounds of the training sample: rows, and UTF-8 bytes of a row taken for training.
TRAIN_ROWS, TRAIN_BYTES = 3_000, 16_384
EPOCHS, LEAST_STEPS, BATCH, RATE, SEED = 6, 500, 32, 0.01, 7
#: Chunks scored at once; bounds the memory of very long texts.
CHUNKS_AT_ONCE = 256


@dataclass
class Network:
    """Learned arrays; ``bytes_`` embeds byte values, row 256 the padding."""

    bytes_: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.bytes_, self.filters, self.filter_bias, self.weights, self.bias]


def untrained(seed: int = SEED) -> Network:
    draw = np.random.default_rng(seed)
    return Network(
        draw.normal(0, 0.5, (257, DIMENSIONS)).astype(np.float32),
        draw.normal(0, 0.2, (WIDTH * DIMENSIONS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )


def chunk_starts(size: int) -> range:
    """Starts that cover ``size`` bytes; the last chunk ends at or beyond the end."""
    return range(0, max(size - (CHUNK - CHUNK_STEP), 1), CHUNK_STEP)


def chunks_of(data: bytes, first: int, last: int) -> np.ndarray:
    """Chunks ``first`` to ``last`` as byte values, padded with 256."""
    starts = chunk_starts(len(data))[first:last]
    made = np.full((len(starts), CHUNK), 256, dtype=np.int16)
    for row, start in zip(made, starts, strict=True):
        part = np.frombuffer(data, np.uint8, min(CHUNK, len(data) - start), start)
        row[: len(part)] = part
    return made


def windows(network: Network, chunks: np.ndarray) -> np.ndarray:
    """Embedded bytes under each place of the filters: chunks x places x (bytes of a filter)."""
    embedded = network.bytes_[chunks].reshape(len(chunks), CHUNK * DIMENSIONS)
    places = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * DIMENSIONS, axis=1)
    return places[:, :: STEP * DIMENSIONS]


def pooled(network: Network, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each chunk, at least 0, and its place."""
    held = np.ascontiguousarray(windows(network, chunks))
    responses = held @ network.filters
    best = responses.argmax(axis=1)
    top = np.take_along_axis(responses, best[:, None, :], axis=1)[:, 0] + network.filter_bias
    return np.maximum(top, 0), best


def text_features(network: Network, data: bytes) -> np.ndarray:
    """Mean and maximum over all chunks."""
    total = np.zeros(FILTERS, np.float64)
    highest = np.zeros(FILTERS, np.float32)
    n = len(chunk_starts(len(data)))
    for first in range(0, n, CHUNKS_AT_ONCE):
        values, _ = pooled(network, chunks_of(data, first, first + CHUNKS_AT_ONCE))
        total += values.sum(axis=0)
        highest = np.maximum(highest, values.max(axis=0))
    return np.concatenate([total / n, highest]).astype(np.float32)


def probability(network: Network, features: np.ndarray) -> np.ndarray:
    logits = features.astype(np.float64) @ network.weights + network.bias[0]
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def scores(network: Network, data: Sequence[bytes]) -> np.ndarray:
    """One probability per text; the chunks of short texts are computed together."""
    features = np.zeros((len(data), 2 * FILTERS), np.float32)
    waiting: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        nonlocal waiting, held
        if waiting:
            values, _ = pooled(network, np.concatenate([chunks for _, chunks in waiting]))
            sizes = np.array([len(chunks) for _, chunks in waiting])
            begins = np.cumsum(sizes) - sizes
            means = np.add.reduceat(values, begins, axis=0) / sizes[:, None]
            tops = np.maximum.reduceat(values, begins, axis=0)
            features[[i for i, _ in waiting]] = np.concatenate([means, tops], axis=1)
        waiting, held = [], 0

    for i, one in enumerate(data):
        n = len(chunk_starts(len(one)))
        if n > CHUNKS_AT_ONCE // 4:
            features[i] = text_features(network, one)
            continue
        if held + n > CHUNKS_AT_ONCE:
            flush()
        waiting.append((i, chunks_of(one, 0, n)))
        held += n
    flush()
    return probability(network, features)


def gradients(network: Network, data: list[bytes], targets: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy, by every array of the network."""
    parts = [chunks_of(one, 0, len(chunk_starts(len(one)))) for one in data]
    sizes = np.array([len(part) for part in parts])
    begins = np.cumsum(sizes) - sizes
    chunks = np.concatenate(parts)
    values, best = pooled(network, chunks)
    owners = np.repeat(np.arange(len(data)), sizes)
    tops = np.maximum.reduceat(values, begins, axis=0)
    means = np.add.reduceat(values, begins, axis=0) / sizes[:, None]
    features = np.concatenate([means, tops], axis=1)
    error = ((probability(network, features) - targets) / len(data)).astype(np.float32)

    by_feature = error[:, None] * network.weights
    by_mean, by_top = by_feature[:, :FILTERS], by_feature[:, FILTERS:]
    is_top = values == tops[owners]
    shared = np.add.reduceat(is_top, begins, axis=0, dtype=np.float32)
    by_value = by_mean[owners] / sizes[owners][:, None] + is_top * (by_top / shared)[owners]
    by_value = by_value * (values > 0)

    rows = np.arange(len(chunks))[:, None]
    places = best[:, :, None] * STEP + np.arange(WIDTH)
    codes = chunks[rows[:, :, None], places]
    seen = network.bytes_[codes].reshape(len(chunks), FILTERS, WIDTH * DIMENSIONS)
    by_filters = np.einsum("cf,cfk->kf", by_value, seen)
    by_seen = by_value[:, :, None] * network.filters.T[None]
    by_bytes = np.zeros_like(network.bytes_)
    np.add.at(by_bytes, codes.reshape(-1), by_seen.reshape(-1, DIMENSIONS))
    by_bytes[256] = 0
    return [
        by_bytes,
        by_filters.astype(np.float32),
        by_value.sum(axis=0),
        features.T @ error,
        error.sum(keepdims=True),
    ]


def train(data: list[bytes], labels: Sequence[int], seed: int = SEED) -> Network:
    """Fit by Adam on equally many rows of both labels, then shift to their real shares.

    Equal input gives an equal network.
    Without rows of both labels nothing can be learned: then every text gets
    the share of label 1, or one half without any row.
    """
    network = untrained(seed)
    network.bytes_[256] = 0
    truth = np.array(labels, dtype=np.float64)
    if len(truth) == 0 or truth.min() == truth.max():
        share = np.clip(truth.mean() if len(truth) else 0.5, 0.01, 0.99)
        network.weights[:] = 0
        network.bias[0] = np.log(share / (1 - share))
        return network
    draw = np.random.default_rng(seed)
    good, bad = np.flatnonzero(truth == 1), np.flatnonzero(truth == 0)
    arrays = network.arrays()
    first = [np.zeros_like(a) for a in arrays]
    second = [np.zeros_like(a) for a in arrays]
    steps = max(LEAST_STEPS, EPOCHS * len(data) // BATCH)
    for step in range(1, steps + 1):
        picked = np.concatenate([draw.choice(good, BATCH // 2), draw.choice(bad, BATCH // 2)])
        found = gradients(network, [data[i] for i in picked], truth[picked])
        rate = RATE * (1 - step / (steps + 1))
        for array, g, m, v in zip(arrays, found, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            array -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    network.bias += np.float32(np.log(len(good) / len(bad)))
    return network


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on at most ``TRAIN_ROWS`` labelled texts that are not held out.

    The sample takes the rows of smallest hashed id, among texts of at most
    ``TRAIN_BYTES`` bytes, so what reaches the driver is bounded. Equal
    rows count as often as they occur.
    """
    known = texts(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    rows = texts(docs, "doc_id", "text").where(F.octet_length("text") <= TRAIN_BYTES)
    order = F.xxhash64("doc_id", F.lit(SEED))
    picked = known.where(~held_out()).orderBy(order, "doc_id", "quality").limit(TRAIN_ROWS)
    sample = (
        rows.join(F.broadcast(picked), "doc_id")
        .orderBy(order, "doc_id", "quality", "text")
        .limit(TRAIN_ROWS)
        .select("text", "quality")
        .collect()
    )
    data = [row["text"].encode("utf-8", "replace") for row in sample]
    return train(data, [row["quality"] for row in sample])


def text_scores(network: Network, batch: pa.Array) -> np.ndarray:
    """Null and empty texts are one chunk of padding and get its score."""
    data = [text.encode("utf-8", "replace") if text else b"" for text in batch.to_pylist()]
    return scores(network, data)


def classify(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every whole text.

    Only the bytes of the text enter a score, other columns are not read. Rows
    are neither merged nor shuffled.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = text_scores(network, batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": made,
                    "predicted": pa.array((made >= 0.5).astype(np.int32)),
                }
            )

    rows = texts(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(score, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, network: Network) -> DataFrame:
    """Whole rows whose text is predicted to be good."""
    return keep_rows(docs, lambda batch: text_scores(network, batch) >= 0.5)
