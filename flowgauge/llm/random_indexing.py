"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated probabilities.

A token's index vector is a sparse ternary one drawn from its hash. The context
vector of a token is the sum of the index vectors of its neighbours over the
whole corpus, held by hash slot: SLOTS x (DIMENSIONS + 1) whole numbers, a bound
that no corpus passes. Tasks sum their documents and Spark sums the tasks. A
document is pooled from the context vectors of all its tokens: their mean, their
spread and their mean step from one token to the next.

Labels are read only outside the held-out fold, from at most `most_rows` labelled
rows with the least hash of their id. A fifth of these fits the temperature, the
rest the network; both are numpy on the driver, on that bounded sample. Every
document is scored in tasks from its text alone.

Null and empty texts have no tokens and score as the zero vector. A document
whose labels contradict each other does not train. Without labels of both
classes the score is the mean label, or 0.5 without any. Repeated rows are scored
alike, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.llm.words import Words, mix, pieces, text_bytes, word_numbers

SLOTS = 1 << 15
DIMENSIONS = 32
NONZERO = 2
REACH = 2
POOLED = 3 * DIMENSIONS
SHRINK = 10.0
GROUPS = 32
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
PIECE_BYTES = 1 << 21

FOLDS, HELD_OUT, CALIBRATION = 4, 2, 5
ACCEPTED = 0.7

SPACE, LETTER, DIGIT, SIGN = range(4)
_KIND = np.full(256, SIGN, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = SPACE
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = LETTER


def tokens_of(column: pa.Array) -> Words:
    """Runs of letters, runs of digits and single signs of each text."""
    data, offsets = text_bytes(column)
    kind = _KIND[data]
    border = np.ones(len(data) + 1, bool)
    border[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == SIGN)
    border[offsets] = True
    seen = kind != SPACE
    start, end = np.flatnonzero(seen & border[:-1]), np.flatnonzero(seen & border[1:]) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def _slots(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Slot and hash of each token."""
    numbers, hashes = word_numbers(words)
    each = hashes[numbers]
    return (each % np.uint64(SLOTS)).astype(np.int64), each


def _index_vectors(hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Place and sign of each nonzero of the index vectors."""
    out = []
    for i in range(NONZERO):
        drawn = mix(hashes + np.uint64(i + 1))
        out.append(((drawn % np.uint64(DIMENSIONS)).astype(np.int64), np.where(drawn >> np.uint64(63), 1.0, -1.0)))
    return out


def _context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a whole partition, in groups of slots; the last column counts tokens."""
    width = DIMENSIONS + 1
    sums = np.zeros(SLOTS * width, np.int64)
    for batch in pieces(batches, PIECE_BYTES):
        words = tokens_of(batch.column("text"))
        slots, hashes = _slots(words)
        owner = words.owner()
        vectors = _index_vectors(hashes)
        cells, signs = [slots * width + DIMENSIONS], [np.ones(len(slots))]
        for far in range(1, REACH + 1):
            both = np.flatnonzero(owner[far:] == owner[:-far])
            for place, sign in vectors:
                cells += [slots[both] * width + place[both + far], slots[both + far] * width + place[both]]
                signs += [sign[both + far], sign[both]]
        for cell, sign in zip(cells, signs):
            sums += np.bincount(cell, sign, len(sums)).astype(np.int64)
    group = SLOTS // GROUPS * width
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array(range(GROUPS), pa.int32()), "sums": pa.array([s.tobytes() for s in sums.reshape(-1, group)], pa.binary())}
    )


def _add_up(names: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of the neighbouring rows with equal names, as a stream: one sum is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        schema = pa.schema([*[(n, pa.int32()) for n in names], ("sums", pa.binary())])

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], k.type) for v, k in zip((*now, total.tobytes()), schema)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                here = tuple(batch.column(n)[i].as_py() for n in names)
                sums = np.frombuffer(batch.column("sums")[i].as_buffer(), np.int64)
                if here == now:
                    total += sums
                    continue
                if now is not None:
                    yield closed()
                now, total = here, sums.copy()
        if now is not None:
            yield closed()

    return run


def summed(parts: DataFrame) -> DataFrame:
    """Rows (part, sums) of all map tasks summed to one row a part, in two levels: tasks are dealt to blocks first."""
    blocks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.withColumn("task", (F.spark_partition_id() % blocks).cast("int"))
    some = dealt.repartition("part", "task").sortWithinPartitions("part", "task").mapInArrow(_add_up(("part", "task")), "part int, task int, sums binary")
    return some.repartition("part").sortWithinPartitions("part").mapInArrow(_add_up(("part",)), "part int, sums binary")


def context_vectors(documents: DataFrame, text: str = "text") -> np.ndarray:
    """SLOTS x DIMENSIONS: how the neighbours of a slot's tokens differ from those of any token."""
    named = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = summed(named.mapInArrow(_context_batches, "part int, sums binary"))
    sums = np.zeros((GROUPS, SLOTS // GROUPS * (DIMENSIONS + 1)))
    for row in parts.collect():  # GROUPS rows of a fixed size
        sums[row["part"]] = np.frombuffer(row["sums"], np.int64)
    sums = sums.reshape(SLOTS, DIMENSIONS + 1)
    count = sums[:, DIMENSIONS:]
    mean = sums[:, :DIMENSIONS] / np.maximum(count, 1)
    common = sums[:, :DIMENSIONS].sum(0) / max(count.sum(), 1)
    return np.where(count > 0, (mean - common) * count / (count + SHRINK), 0.0).astype(np.float32)


def document_vectors(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the context vectors of each text's tokens, and their mean step from token to token."""
    words = tokens_of(column)
    counts = np.diff(words.first)
    out = np.zeros((len(counts), POOLED))
    some = np.flatnonzero(counts)
    if len(some):
        each = vectors[_slots(words)[0]].astype(np.float64)
        n = counts[some][:, None]
        mean = np.add.reduceat(each, words.first[some]) / n
        square = np.add.reduceat(each * each, words.first[some]) / n
        step = np.zeros_like(each)
        step[1:] = np.abs(each[1:] - each[:-1])
        step[words.first[some]] = 0
        steps = np.add.reduceat(step, words.first[some]) / n
        out[some] = np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0)), steps], axis=1)
    return out


@dataclass
class Network:
    """Standardised inputs, one hidden layer, a logit divided by the temperature."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.center) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, calibration: np.ndarray) -> Network | float:
    """The network for labels y, calibrated on the marked rows; the mean label if there is one class only."""
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    train = ~calibration if len(set(y[~calibration].tolist())) == 2 else np.ones(len(y), bool)
    draw = np.random.default_rng(9)
    scale = x[train].std(0)
    net = Network(
        x[train].mean(0), np.where(scale > 0, scale, 1.0), draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    )
    z, t = (x[train] - net.center) / net.scale, y[train]
    weights = [net.w1, net.b1, net.w2, net.b2]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(z @ net.w1 + net.b1)
        error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -500, 500))) - t) / len(t)
        back = np.outer(error, net.w2) * (1 - hidden * hidden)
        slopes = [z.T @ back + 1e-3 * net.w1, back.sum(0), hidden.T @ error + 1e-3 * net.w2, error.sum(keepdims=True)]
        for w, g, a, b in zip(weights, slopes, m, v):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            w -= 0.02 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    if calibration.any():
        logits, truth = net.logits(x[calibration]), y[calibration]
        choices = np.geomspace(0.25, 16, 97)
        losses = [np.logaddexp(0, -np.where(truth == 1, 1, -1) * logits / c).mean() for c in choices]
        net.temperature = float(choices[int(np.argmin(losses))])
    return net


def id_remainder(row_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit(""))) % folds


def _vector_batches(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE_BYTES):
            rows = document_vectors(batch.column("text"), vectors.value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(list(rows))], ["id", "label", "x"])

    return run


def _score_batches(vectors, net: Network | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE_BYTES):
            constant = isinstance(net, float)
            scores = np.full(batch.num_rows, net) if constant else net.scores(document_vectors(batch.column("text"), vectors.value))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], ["id", "score"])

    return run


def classify(
    documents: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", row_id: str = "doc_id",
    most_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(id, held_out, score) of every document."""
    context = documents.sparkSession.sparkContext
    vectors = context.broadcast(context_vectors(documents, text))
    named = documents.select(F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = labels.select(F.col(row_id).alias("id"), F.col(label).cast("double").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(id_remainder(F.col("id"), FOLDS) != HELD_OUT).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    sample = known.where("label = other").drop("other").orderBy(F.xxhash64("id"), "id").limit(most_rows)
    # A repeated id trains once, with its least text, so the driver holds `most_rows` vectors at most.
    labelled = named.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = sorted(labelled.mapInArrow(_vector_batches(vectors), "id long, label double, x array<double>").collect())
    seen = dict((r["id"], (r["label"], r["x"])) for r in rows)
    x = np.array([v[1] for v in seen.values()]).reshape(len(seen), POOLED)
    y = np.array([v[0] for v in seen.values()])
    calibration = mix(np.array(list(seen), np.int64).view(np.uint64)) % np.uint64(CALIBRATION) == 0
    net = fit(x, y, calibration)
    scored = named.mapInArrow(_score_batches(vectors, net), f"id {named.schema['id'].dataType.simpleString()}, score double")
    return scored.select("id", (id_remainder(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"), "score")


@query("op9_random_indexing")
def op9(spark, sf_dir):
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", predicted)
