"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Words fall into `BUCKETS` by hash, so tables have a fixed size whatever the corpus holds. Each has
a sparse ternary index vector; its context vector is the sum of the index vectors of the two words
before and after, over all occurrences in all documents. These are whole numbers, summed within a
task and then by bucket, so the result doesn't depend on the order of tasks. A document is the mean
of its words' vectors, weighted down for frequent words, with the mean index vector of word shapes
and a few figures on length and repetition. A network with one hidden layer, trained in numpy on
the driver on `TRAIN_ROWS` labelled documents at most, gives logits; a temperature fitted on a part
it was not trained on makes them probabilities.

Labels are learned only where crc32(doc_id as text) mod 5 is not 0. Labels, lang, source and doc_id
are no inputs of a score.

Edge cases: a null or empty text pools to zeros and is scored like any other. Null labels are
ignored, repeated ones count each; without labels every score is 0.5, with labels of one kind it is
near that kind. A null doc_id is never labelled nor held out. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bpe import Memo, id_text
from riskloom.llm.scratch import written

BUCKETS, SHAPES, DIMS = 8192, 64, 32
NONZERO = 4            # entries of an index vector that aren't 0
REACH = 2              # words before and after that are context
CHUNK = 200_000        # words summed together
TRAIN_ROWS = 20_000    # labelled documents the network sees, those of the smallest id hashes
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 30, 128, 2e-3, 1e-4
FOLDS, CUT = 5, 0.3


def index_vectors(rows: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors, the same in every process; the last row is zero."""
    random = np.random.default_rng(seed)
    out = np.zeros((rows + 1, DIMS), np.int16)
    for i in range(rows):
        out[i, random.choice(DIMS, NONZERO, replace=False)] = random.choice((-1, 1), NONZERO)
    return out


def _shape(word: str) -> str:
    """How a word is written: case, digits, and the marks around it."""
    first, last = word[0], word[-1]
    return "".join((
        "U" if word.isupper() and len(word) > 1 else "l" if word.islower() else "m",
        "d" if any(c.isdigit() for c in word) else "", "" if first.isalnum() else first,
        "|", "" if last.isalnum() else last))


def _place(word: str) -> int:
    """Bucket and shape of a word in one number."""
    return (xxhash.xxh3_64_intdigest(word) % BUCKETS) * SHAPES + (
        xxhash.xxh3_64_intdigest(_shape(word)) % SHAPES)


_PLACES = Memo(_place)


def places(text: str | None) -> np.ndarray:
    words = (text or "").split()
    return np.fromiter(map(_PLACES.__getitem__, words), np.int64, len(words))


def context_sums(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(context vectors, number of occurrences) of all buckets, over all documents."""
    names = [f"c{d}" for d in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors(BUCKETS, 1)
        sums, counts = np.zeros((BUCKETS + 1, DIMS), np.int64), np.zeros(BUCKETS + 1, np.int64)
        gap = np.full(REACH, BUCKETS)
        held, size = [], 0

        def add() -> None:
            words = np.concatenate([gap, *held, gap])
            vectors = index[words]
            middle = words[REACH:-REACH]
            context = np.zeros((len(middle), DIMS), np.int16)
            for shift in range(2 * REACH + 1):
                if shift != REACH:
                    context += vectors[shift:shift + len(middle)]
            order = np.argsort(middle.astype(np.int16), kind="stable")
            seen, starts = np.unique(middle[order], return_index=True)
            sums[seen] += np.add.reduceat(context[order], starts, axis=0, dtype=np.int64)
            counts[:] += np.bincount(middle, minlength=BUCKETS + 1)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held += [places(text) // SHAPES, gap]
                size += len(held[-2])
                if size >= CHUNK:
                    add()
                    held, size = [], 0
        if held:
            add()
        used = np.flatnonzero(counts[:BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used]),
             *[pa.array(sums[used, d]) for d in range(DIMS)]], ["bucket", "n", *names])

    schema = ", ".join(f"{c} bigint" for c in ["bucket", "n", *names])
    table = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, schema).groupBy(
        "bucket").agg(*[F.sum(c).alias(c) for c in ["n", *names]]).toArrow()
    sums, counts = np.zeros((BUCKETS, DIMS)), np.zeros(BUCKETS)
    at = table.column("bucket").to_numpy()
    counts[at] = table.column("n").to_numpy()
    for d, name in enumerate(names):
        sums[at, d] = table.column(name).to_numpy()
    return sums, counts


def word_vectors(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Context vectors of unit length, weighted down for frequent words; buckets x DIMS."""
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    share = counts / max(counts.sum(), 1)
    return (sums / np.maximum(length, 1) * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


def pooled(place: np.ndarray, words: np.ndarray, index: np.ndarray,
           shapes: np.ndarray) -> np.ndarray:
    """The inputs of the network for one document."""
    n = len(place)
    if not n:
        return np.zeros(2 * DIMS + 3, np.float32)
    bucket, shape = place // SHAPES, place % SHAPES
    mean_index = index[bucket].mean(axis=0, dtype=np.float64)
    by_shape = np.bincount(shape, minlength=SHAPES) @ shapes[:SHAPES] / n
    figures = (np.log1p(n), np.linalg.norm(mean_index), len(np.unique(bucket)) / n)
    return np.concatenate([words[bucket].mean(axis=0), by_shape, figures]).astype(np.float32)


def document_vectors(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """doc_id, x (array<float>), one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, shapes = index_vectors(BUCKETS, 1), index_vectors(SHAPES, 2)
        for batch in batches:
            rows = [pooled(places(t), shared.value, index, shapes)
                    for t in batch.column(1).to_pylist()]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * (2 * DIMS + 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc_id", "x"])

    return id_text(docs).mapInArrow(run, "doc_id bigint, x array<float>")


class Network:
    """Standardised inputs, one hidden layer, one logit, a temperature."""

    def __init__(self, inputs: int):
        random = np.random.default_rng(3)
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.w = [random.normal(0, (2 / inputs) ** 0.5, (inputs, HIDDEN)), np.zeros(HIDDEN),
                  random.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0

    def _layers(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(z @ self.w[0] + self.w[1], 0)
        return hidden, hidden @ self.w[2] + self.w[3]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._layers(np.clip((x - self.mean) / self.scale, -8, 8))[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        """Adam on the log loss of the first four fifths, the temperature on the rest."""
        random = np.random.default_rng(4)
        order = random.permutation(len(x))
        split = len(x) - len(x) // 5
        train, rest = order[:split], order[split:]
        self.mean, self.scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
        z, t = np.clip((x[train] - self.mean) / self.scale, -8, 8), y[train]
        first, second = [[np.zeros_like(w) for w in self.w] for _ in range(2)]
        step = 0
        for _ in range(EPOCHS):
            shuffled = random.permutation(len(z))
            for at in range(0, len(z), BATCH):
                rows = shuffled[at:at + BATCH]
                hidden, logit = self._layers(z[rows])
                error = (sigmoid(logit) - t[rows]) / len(rows)
                back = np.outer(error, self.w[2]) * (hidden > 0)
                gradients = [z[rows].T @ back + DECAY * self.w[0], back.sum(axis=0),
                             hidden.T @ error + DECAY * self.w[2], error.sum(keepdims=True)]
                step += 1
                for w, g, m, v in zip(self.w, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9 ** step)) / (
                        np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        if len(rest):
            logit = self.logits(x[rest])
            self.temperature = min(np.geomspace(0.25, 8, 61), key=lambda c: log_loss(
                logit / c, y[rest]))
        return self


def sigmoid(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def log_loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0,
                      F.lit(False))


def train(vectors: DataFrame, labels: DataFrame) -> Network | None:
    known = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("quality").cast("double").alias("y")).where(~held_out())
    sample = vectors.join(known, "doc_id").select(
        "x", "y", F.xxhash64("doc_id").alias("draw"), "doc_id").orderBy(
        "draw", "doc_id", "y").limit(TRAIN_ROWS).select("x", "y").toArrow()
    if not sample.num_rows:
        return None
    x = np.array(sample.column("x").to_pylist(), np.float64)
    return Network(x.shape[1]).fit(x, sample.column("y").to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per document."""
    vectors = written(document_vectors(docs, word_vectors(*context_sums(docs))), "quality-vectors")
    model = docs.sparkSession.sparkContext.broadcast(train(vectors, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model.value
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().astype(np.float64)
            x = flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
            score = np.full(len(x), 0.5) if network is None or not len(x) else network.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)],
                                             ["doc_id", "score"])

    scored = vectors.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
