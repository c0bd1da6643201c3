"""Quality score by a byte-level convolutional network, in numpy.

A filter of ``WIDTH`` bytes is a table of one number per place and byte value,
so a convolution is a sum of table rows. Each filter keeps its maximum in each
chunk of ``CHUNK`` bytes; chunks overlap by half and cover the whole text. A
small dense layer reads every chunk, and the mean and the maximum over all
chunks make one probability.

The network learns from a bounded sample of labelled rows (``SAMPLE`` a class,
texts up to ``SAMPLE_CHARS`` characters) and scores whole texts, a block of
bytes at a time, so that memory does not grow with the text. The dense layer
is also told how much of a chunk is text: few matches mean little in a short one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.toxicity import labelled_sample

WIDTH = 4
FILTERS = 32
HIDDEN = 16
CHUNK = 512
HALF = CHUNK // 2
BLOCK = 16  # halves of a chunk that are convolved at once
SAMPLE = 1500
SAMPLE_CHARS = 4000
EPOCHS = 10
BATCH = 16


class Network(NamedTuple):
    table: np.ndarray  # WIDTH x 256 x FILTERS
    offset: np.ndarray  # FILTERS
    dense: np.ndarray  # FILTERS + 1 x HIDDEN; the last is for how full a chunk is
    dense_offset: np.ndarray  # HIDDEN
    out: np.ndarray  # 2 * HIDDEN
    bias: np.ndarray  # 1


def fresh(rng: np.random.Generator) -> Network:
    return Network(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 1 / math.sqrt(FILTERS), (FILTERS + 1, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    )


def padded(data: np.ndarray) -> np.ndarray:
    """At least one whole window: texts shorter than a filter end in zero bytes."""
    short = WIDTH - len(data)
    return np.concatenate([data, np.zeros(short, np.uint8)]) if short > 0 else data


def convolve(net: Network, data: np.ndarray) -> np.ndarray:
    """windows x FILTERS"""
    n = len(data) - WIDTH + 1
    total = net.table[0].take(data[:n], axis=0)
    for k in range(1, WIDTH):
        total += net.table[k].take(data[k : k + n], axis=0)
    return total


def half_maxima(net: Network, data: np.ndarray) -> np.ndarray:
    """halves x FILTERS: each filter's maximum in each half of a chunk."""
    windows = len(data) - WIDTH + 1
    found = []
    for start in range(0, windows, HALF * BLOCK):
        end = min(windows, start + HALF * BLOCK)
        total = convolve(net, data[start : end + WIDTH - 1])
        found.append(np.maximum.reduceat(total, np.arange(0, end - start, HALF), axis=0))
    return np.concatenate(found)


def chunks(halves: np.ndarray) -> np.ndarray:
    """Two neighbouring halves make a chunk; a text of one half is one chunk."""
    return np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves


def with_fill(pooled: np.ndarray, windows: int) -> np.ndarray:
    """``pooled`` and a last column: the share of each chunk that is text."""
    starts = np.arange(len(pooled)) * HALF
    fill = np.minimum(windows - starts, CHUNK).astype(np.float32) / CHUNK
    return np.hstack([pooled, np.sqrt(fill)[:, None]])


def probability(net: Network, data: np.ndarray) -> float:
    """Probability of label 1 for the bytes of a whole text."""
    data = padded(data)
    pooled = np.maximum(chunks(half_maxima(net, data)) + net.offset, 0)
    pooled = with_fill(pooled, len(data) - WIDTH + 1)
    hidden = np.maximum(pooled @ net.dense + net.dense_offset, 0)
    z = float(np.concatenate([hidden.mean(0), hidden.max(0)]) @ net.out + net.bias[0])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def gradients(net: Network, data: np.ndarray, label: int, into: Network) -> None:
    """Adds one text's gradient of the log loss to ``into``."""
    data = padded(data)
    total = convolve(net, data)
    starts = np.arange(0, len(total), HALF)
    places = np.stack([s + total[s : s + HALF].argmax(0) for s in starts])  # halves x FILTERS
    filters = np.arange(FILTERS)
    halves = total[places, filters]
    if len(halves) > 1:
        second = halves[1:] > halves[:-1]
        places = np.where(second, places[1:], places[:-1])
    raw = chunks(halves) + net.offset
    pooled = with_fill(np.maximum(raw, 0), len(total))
    before = pooled @ net.dense + net.dense_offset
    hidden = np.maximum(before, 0)
    top = hidden.argmax(0)
    features = np.concatenate([hidden.mean(0), hidden.max(0)])
    z = float(features @ net.out + net.bias[0])
    error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - label
    into.out[:] += error * features
    into.bias[:] += error
    back = np.repeat(error * net.out[None, :HIDDEN] / len(hidden), len(hidden), axis=0)
    back[top, np.arange(HIDDEN)] += error * net.out[HIDDEN:]
    back = back * (before > 0)
    into.dense[:] += pooled.T @ back
    into.dense_offset[:] += back.sum(0)
    back = (back @ net.dense[:FILTERS].T) * (raw > 0)  # chunks x FILTERS
    into.offset[:] += back.sum(0)
    which = np.broadcast_to(filters, places.shape)
    for k in range(WIDTH):
        np.add.at(into.table[k], (data[places + k], which), back)


def train(texts: list[bytes], labels: list[int], share: float, seed: int = 5) -> Network:
    """Adam over ``EPOCHS`` rounds; ``share`` of label 1 among all rows sets the bias right.

    Without texts of both labels there is nothing to tell apart: the score is
    then ``share`` for every text, or a half.
    """
    rng = np.random.default_rng(seed)
    net = fresh(rng)
    ones = sum(labels)
    if not 0 < ones < len(labels):
        even = share if 0 < share < 1 else 0.5
        return net._replace(out=net.out * 0, bias=np.array([math.log(even / (1 - even))], np.float32))
    data = [np.frombuffer(t, np.uint8) for t in texts]
    first = [np.zeros_like(p) for p in net]
    second = [np.zeros_like(p) for p in net]
    step = 0
    steps = EPOCHS * (len(data) // BATCH + 1)
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            total = Network(*(np.zeros_like(p) for p in net))
            for i in batch:
                gradients(net, data[i], labels[i], total)
            step += 1
            rate = 0.01 * (1 - 0.9 * step / steps)
            for p, g, m, v in zip(net, total, first, second, strict=True):
                g = g / len(batch) + 1e-5 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    shift = math.log(share / (1 - share)) - math.log(ones / (len(labels) - ones)) if 0 < share < 1 else 0.0
    return net._replace(bias=net.bias + np.float32(shift))


def train_on(docs: DataFrame, labels: DataFrame) -> Network:
    """Learns ``labels.quality`` from the texts of a bounded sample of rows."""
    good, bad, share = labelled_sample(docs, labels, "quality", SAMPLE, SAMPLE_CHARS)
    texts = [t.encode() for t in (*good, *bad)]
    return train(texts, [1] * len(good) + [0] * len(bad), share)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` (doc_id, text, anything else) with ``score``, the probability of label 1.

    Whole texts are read. A null text scores like an empty one. Repeated rows
    score alike, no rows give no rows, and a column named score is replaced.
    """
    docs = docs.drop("score")
    schema = docs.withColumn("score", F.lit(0.0)).schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in batch.column(at):
                raw = text.as_buffer() if text.is_valid else None
                data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
                scores.append(probability(net, data))
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, schema)
