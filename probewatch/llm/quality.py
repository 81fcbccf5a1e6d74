"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are embedded and convolved with learned filters; every response is taken
once, over the whole text.  Responses are max-pooled over overlapping chunks, a small layer
turns each chunk's maxima into a log-odds, and the mean over all chunks of the document
gives one probability.  The mean does not depend on the length of the text.

The network is trained on the driver from a bounded sample of labelled rows
(``SAMPLE`` per class, ``CHUNKS`` chunks spread evenly over the whole text of each);
scoring covers every byte of every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import tidy

#: Labelled rows per class and chunks per row that training takes; rows in the order of a hash.
SAMPLE, CHUNKS = 1500, 6
#: Bytes of a chunk, of its half (the step) and of a position; dimensions; filters; hidden units.
CHUNK, HALF, STRIDE, DIM, FILTERS, HIDDEN = 256, 128, 4, 4, 32, 16
PAD = 256  # the symbol after a text's end
EPOCHS, BATCH, RATE = 14, 48, 0.01
#: Symbols that are scored at a time.
BLOCK = 1 << 18


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        f = np.float32
        self.p = {
            "embed": rng.normal(0, 0.5, (PAD + 1, DIM)).astype(f),
            # filters of two positions: weights of the first and of the second
            "conv": (rng.normal(0, 1, (STRIDE * DIM, 2 * FILTERS)) / np.sqrt(2 * STRIDE * DIM)).astype(f),
            "bias": np.zeros(FILTERS, f),
            "hidden": (rng.normal(0, 1, (FILTERS, HIDDEN)) / np.sqrt(FILTERS)).astype(f),
            "shift": np.zeros(HIDDEN, f),
            "out": (rng.normal(0, 1, HIDDEN) / np.sqrt(HIDDEN)).astype(f),
            "level": np.zeros(1, f),
        }
        self.constant: float | None = None

    def log_odds(self, maxima: np.ndarray) -> np.ndarray:
        p = self.p
        return np.maximum(maxima @ p["hidden"] + p["shift"], 0) @ p["out"] + p["level"]

    def fit(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5):
        """``chunks`` (n, CHUNK) of symbols, ``owner`` the document of each, ``labels`` per document."""
        if len(labels) == 0 or labels.min() == labels.max():
            self.constant = float(labels[0]) if len(labels) else 0.5
            return self
        rng = np.random.Generator(np.random.PCG64(seed))
        p = self.p
        weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)).astype(np.float32)
        by_owner = np.argsort(owner, kind="stable")
        edge = np.searchsorted(owner[by_owner], np.arange(len(labels) + 1))
        m = {k: np.zeros_like(v) for k, v in p.items()}
        v = {k: np.zeros_like(x) for k, x in p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                docs = order[at:at + BATCH]
                rows = np.concatenate([by_owner[edge[d]:edge[d + 1]] for d in docs])
                local = np.repeat(np.arange(len(docs)), [edge[d + 1] - edge[d] for d in docs])
                if not len(rows):
                    continue
                grads = self._gradients(chunks[rows], local, labels[docs], weight[docs])
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self

    def _gradients(self, chunks, local, labels, weight):
        p, n = self.p, len(chunks)
        symbols = np.concatenate([chunks, np.full((n, STRIDE), PAD, chunks.dtype)], 1)
        blocks = p["embed"][symbols].reshape(n, -1, STRIDE * DIM)
        y = blocks @ p["conv"]
        response = y[:, :-1, :FILTERS] + y[:, 1:, FILTERS:]
        best = response.argmax(1)
        maxima = np.take_along_axis(response, best[:, None, :], 1)[:, 0] + p["bias"]
        live = maxima > 0
        maxima = np.maximum(maxima, 0)
        inner = maxima @ p["hidden"] + p["shift"]
        h = np.maximum(inner, 0)
        z = h @ p["out"] + p["level"]
        size = np.bincount(local, minlength=len(labels))
        mean = np.bincount(local, z, len(labels)) / np.maximum(size, 1)
        error = (1 / (1 + np.exp(-mean)) - labels) * weight / len(labels)
        dz = (error / np.maximum(size, 1))[local].astype(np.float32)
        dh = np.outer(dz, p["out"]) * (inner > 0)
        dmax = (dh @ p["hidden"].T) * live
        at = np.arange(n)[:, None]
        first, second = blocks[at, best], blocks[at, best + 1]  # (n, filters, width)
        conv = np.concatenate([np.einsum("nfw,nf->wf", first, dmax), np.einsum("nfw,nf->wf", second, dmax)], 1)
        embed = np.zeros_like(p["embed"])
        grid = symbols.reshape(n, -1, STRIDE)
        for part, weights in ((best, p["conv"][:, :FILTERS]), (best + 1, p["conv"][:, FILTERS:])):
            back = (dmax[:, :, None] * weights.T[None]).reshape(-1, DIM)
            np.add.at(embed, grid[at, part].reshape(-1), back)
        return {"embed": embed, "conv": conv, "bias": dmax.sum(0), "hidden": maxima.T @ dh, "shift": dh.sum(0),
                "out": h.T @ dz, "level": dz.sum(keepdims=True)}

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each whole text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out, group, held = [], [], 0
        for text in texts:
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            group.append(data)
            held += len(data) + CHUNK
            if held >= BLOCK:
                out.append(self._score(group))
                group, held = [], 0
        if group:
            out.append(self._score(group))
        return np.concatenate(out) if out else np.zeros(0)

    def _score(self, group):
        halves = np.array([max(2, -(-len(d) // HALF)) for d in group])
        end = np.cumsum(halves)
        symbols = np.full(end[-1] * HALF + STRIDE, PAD, np.int16)
        for d, k, e in zip(group, halves, end):
            symbols[(e - k) * HALF:(e - k) * HALF + len(d)] = d
        per_half = HALF // STRIDE
        highest = np.empty((end[-1], FILTERS), np.float32)
        step = BLOCK // HALF  # halves at a time, so that a very long text takes no more memory
        for a in range(0, end[-1], step):
            b = min(a + step, end[-1])
            y = self.p["embed"][symbols[a * HALF:b * HALF + STRIDE]].reshape(-1, STRIDE * DIM) @ self.p["conv"]
            response = y[:-1, :FILTERS] + y[1:, FILTERS:]
            last = end[(end > a) & (end <= b)] - a
            response[last * per_half - 1] = -np.inf  # it would read the next text
            highest[a:b] = response.reshape(b - a, per_half, FILTERS).max(1)
        chunk = np.maximum(highest[:-1], highest[1:])
        inside = np.ones(len(chunk), bool)
        inside[end[:-1] - 1] = False  # a chunk does not span two texts
        z = self.log_odds(np.maximum(chunk[inside] + self.p["bias"], 0))
        mean = np.add.reduceat(z, np.concatenate([[0], np.cumsum(halves - 1)[:-1]])) / (halves - 1)
        return 1 / (1 + np.exp(-mean.astype(np.float64)))


def _chunks(batches):
    """Chunks spread evenly over the whole of each sampled text, as bytes padded by symbols."""
    for batch in batches:
        rows = []
        for doc, label, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            data = (text or "").encode("utf-8", "surrogatepass")
            n = max(1, -(-len(data) // HALF) - 1)
            for k in sorted({round(i * (n - 1) / max(CHUNKS - 1, 1)) for i in range(CHUNKS)}):
                rows.append((doc, label, data[k * HALF:k * HALF + CHUNK]))
        doc, label, data = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(label, pa.int32()), pa.array(data, pa.binary())],
                                         ["doc_id", "label", "chunk"])


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Fit on at most ``sample`` labelled rows of each class that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = known.where("label = 0").orderBy(*order).limit(sample).unionByName(known.where("label = 1").orderBy(*order).limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text").mapInArrow(
        _chunks, "doc_id long, label int, chunk binary").toPandas()
    rows = rows.sort_values(["doc_id", "label", "chunk"], ignore_index=True)
    chunks = np.full((len(rows), CHUNK), PAD, np.int16)
    for k, data in enumerate(rows["chunk"]):
        chunks[k, :len(data)] = np.frombuffer(bytes(data), np.uint8)
    # a document with both labels is two samples
    key = rows["doc_id"].astype(str) + ":" + rows["label"].astype(str)
    owner, first = key.factorize()
    label = np.array([int(k.rsplit(":", 1)[1]) for k in first], np.float64)
    return Network().fit(chunks, owner, label)


def _score(table, text_at):
    def run(batches):
        network = table.value
        for batch in batches:
            scores = network.score(batch.column(text_at).to_pylist())
            kept = [k for k in range(batch.num_columns) if k != text_at]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(scores, pa.float64())],
                                             [*[batch.schema.names[k] for k in kept], "score"])
    return tidy(run)


def _keep(table, text_at, threshold):
    def run(batches):
        network = table.value
        for batch in batches:
            good = network.score(batch.column(text_at).to_pylist()) >= threshold
            yield batch.filter(pa.array(good))
    return tidy(run)


THRESHOLD = 0.3


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts are scored like any other, as one chunk of padding.  Labels that are
    null or neither 0 nor 1 are not learned from; with labels of one class only, every score
    is that class, and without labels 0.5.  Repeated rows score equally; only doc_id and text
    are read; an empty table gives an empty result.
    """
    table = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(table, 1), "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""
    table = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.mapInArrow(_keep(table, docs.columns.index("text"), threshold), docs.schema)
