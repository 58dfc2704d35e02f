"""Language of whole texts with a byte convolutional network.

The network reads a window of bytes: each byte's embedding, filters of several widths over neighbouring
bytes, the largest response of each filter in the window (max pooling), and a softmax over languages.
It is trained in numpy on the driver from a bounded sample of labelled text, and applied to all
windows of each text, one after another, so that no byte of a text is left out; a text's
probabilities are the means over its windows, weighted by the bytes they hold.

To apply it, a filter's response is a sum of table entries, one for each pair of neighbouring bytes,
so a batch costs a few look-ups a byte. Letters A-Z and Latin-1 capitals are taken as small ones.

``und`` with score 0 stands for null text, text without a letter, and any text if there was nothing to
learn from. Rows with null language or id are not learned from. Repeated rows count as often as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.tokens import ragged
from tidemark.llm.words import LOWER, slices, text_bytes

#: Bytes of a window, size of an embedding, filter widths and filters of each width.
LENGTH, EMBEDDING, WIDTHS, FILTERS = 128, 8, (2, 3, 4), 16
#: Documents of each language at most, and windows of each, that the network is trained on.
SAMPLE, SNIPPETS = 1000, 2
EPOCHS, BATCH, RATE = 5, 64, 0.004
UNKNOWN = "und"


def small(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin-1 capitals (C3 80 - C3 9E) made small."""
    low = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] < 0x9F) & (data[after] != 0x97)]
    low[after] += 0x20
    return low


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of each text, padded with zeros; each one's text and number of bytes."""
    sizes = np.diff(offsets)
    count = -(-sizes // LENGTH)
    text = np.repeat(np.arange(len(sizes)), count)
    begin = offsets[text] + LENGTH * ragged(np.zeros(len(sizes), np.int64), count)
    held = np.minimum(LENGTH, offsets[text + 1] - begin)
    at = begin[:, None] + np.arange(LENGTH)
    windows = np.where(np.arange(LENGTH) < held[:, None], data[np.minimum(at, max(0, len(data) - 1))] if len(data) else 0, 0)
    return windows.astype(np.uint8), text, held


@dataclass
class Network:
    """Weights, and the steps of training them."""

    classes: list[str]
    embedding: np.ndarray = field(default=None)
    filters: list[np.ndarray] = field(default=None)
    bias: np.ndarray = field(default=None)
    dense: np.ndarray = field(default=None)
    offset: np.ndarray = field(default=None)

    def __post_init__(self):
        r = np.random.default_rng(5)
        self.embedding = r.normal(0, 0.3, (256, EMBEDDING)).astype(np.float32)
        self.filters = [r.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = r.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(self.classes))).astype(np.float32)
        self.offset = np.zeros(len(self.classes), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.dense, self.offset]

    def gradient(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        n = len(windows)
        embedded = self.embedding[windows]  # n, LENGTH, EMBEDDING
        pooled, places = [], []
        for w, f in zip(WIDTHS, self.filters, strict=True):
            response = sum(embedded[:, k : LENGTH - w + 1 + k] @ f[k * EMBEDDING : (k + 1) * EMBEDDING] for k in range(w))
            places.append(response.argmax(axis=1))
            pooled.append(np.take_along_axis(response, places[-1][:, None], axis=1)[:, 0])
        sums = np.concatenate(pooled, axis=1) + self.bias
        hidden = np.maximum(sums, 0)
        wrong = softmax(hidden @ self.dense + self.offset)
        wrong[np.arange(n), target] -= 1
        wrong /= n
        back = (wrong @ self.dense.T) * (sums > 0)
        to_embedding = np.zeros_like(self.embedding)
        to_filters = []
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            grown = np.zeros_like(f)
            for j in range(w):  # only the place of the largest response learns
                byte = np.take_along_axis(windows, places[k] + j, axis=1)
                rows = slice(j * EMBEDDING, (j + 1) * EMBEDDING)
                grown[rows] = np.einsum("nf,nfe->ef", part, self.embedding[byte])
                np.add.at(to_embedding, byte, part[:, :, None] * f[rows].T[None])
            to_filters.append(grown)
        return [to_embedding, *to_filters, back.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0)]

    def train(self, windows: np.ndarray, target: np.ndarray) -> "Network":
        """Adam over shuffled batches; the order rests on a fixed seed."""
        r = np.random.default_rng(11)
        first = [np.zeros_like(x) for x in self.weights()]
        second = [np.zeros_like(x) for x in self.weights()]
        step = 0
        for _ in range(EPOCHS):
            order = r.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                step += 1
                for x, g, a, b in zip(self.weights(), self.gradient(windows[some], target[some]), first, second, strict=True):
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.999
                    b += 0.001 * g * g
                    x -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return self

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Responses by pairs of bytes: what pair (i, i+1) gives to all filters, byte i+2 to those of
        width 3, and pair (i+2, i+3) to those of width 4."""
        one = [[self.embedding @ f[k * EMBEDDING : (k + 1) * EMBEDDING] for k in range(w)] for w, f in zip(WIDTHS, self.filters, strict=True)]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        return np.concatenate([pair(x[0], x[1]) for x in one], axis=1), one[1][2], pair(one[2][2], one[2][3])

    def apply(self, windows: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Probabilities of each window's languages."""
        pairs, third, last = tables
        out = np.empty((len(windows), len(self.classes)), np.float32)
        for at in range(0, len(windows), 32):
            some = windows[at : at + 32].astype(np.int32)
            both = some[:, :-1] * 256 + some[:, 1:]
            sums = pairs[both]
            pooled = np.empty((len(some), len(WIDTHS) * FILTERS), np.float32)
            pooled[:, :FILTERS] = sums[:, :, :FILTERS].max(axis=1)
            pooled[:, FILTERS : 2 * FILTERS] = (sums[:, :-1, FILTERS : 2 * FILTERS] + third[some[:, 2:]]).max(axis=1)
            pooled[:, 2 * FILTERS :] = (sums[:, :-2, 2 * FILTERS :] + last[both[:, 2:]]).max(axis=1)
            out[at : at + 32] = softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.offset)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def snippets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, snippet) of at most ``sample`` documents of each language, chosen by a hash of their text, with
    SNIPPETS stretches of each long enough for a window."""
    rows = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    counts = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
    # a share of each language first, so that few rows are ranked; twice as many as are kept
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    rows = rows.select("lang", "text", draw.alias("draw")).join(F.broadcast(counts), "lang").where(F.col("draw").cast("double") * F.col("n") < F.lit(2.0 * sample * (1 << 30)))
    spare = F.greatest(F.lit(1), F.length("text") - LENGTH + 1)
    pieces = [F.substring(F.col("text"), 1 + F.pmod(F.xxhash64("text", F.lit(k)), spare).cast("int"), F.lit(LENGTH)) for k in range(SNIPPETS)]
    rows = rows.select("lang", "draw", F.array(*pieces).alias("pieces"))
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "pieces")))
    return ranked.where(F.col("place") <= sample).select("lang", F.explode("pieces").alias("snippet"))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network trained on ``docs`` (doc_id, text, lang); None if no row is labelled."""
    rows = snippets(docs, sample).toPandas().sort_values(["lang", "snippet"], kind="stable")
    if not len(rows):
        return None
    target, classes = pd.factorize(rows["lang"], sort=True)
    windows = np.zeros((len(rows), LENGTH), np.uint8)
    for k, text in enumerate(rows["snippet"]):
        data = small(np.frombuffer(text.encode()[:LENGTH], np.uint8))
        windows[k, : len(data)] = data
    return Network(list(classes)).train(windows, target)


def predict(docs: DataFrame, network: Network | None, *keep: Column | str) -> DataFrame:
    """doc_id, ``keep``, lang_pred and score of each row, from its text alone."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), *keep, "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    names = [x for x in rows.columns if x not in ("text", "_letters")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else None
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                letters = part.column("_letters").to_numpy(zero_copy_only=False)
                best, score = np.full(len(part), -1), np.zeros(len(part))
                if network:
                    data, offsets = text_bytes(part.column("text"))
                    windows, text, held = cut(small(data), offsets)
                    shares = np.zeros((len(part), len(network.classes)))
                    np.add.at(shares, text, network.apply(windows, tables) * held[:, None])
                    shares /= np.maximum(1, np.diff(offsets))[:, None]
                    best = np.where(letters, shares.argmax(axis=1), -1)
                    score = np.where(letters, np.clip(shares.max(axis=1), 0, 1), 0.0)
                named = pa.array([*network.classes, UNKNOWN] if network else [UNKNOWN], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), named.take(pa.array(best % len(named))), pa.array(score)], [*names, "lang_pred", "score"])

    return rows.mapInArrow(judge, f"{schema}, lang_pred string, score double")
